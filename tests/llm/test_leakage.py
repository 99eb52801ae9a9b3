import random

import numpy as np
import pytest

from strataq.llm import leakage as lk

D, I = "doc_id long, text string, item_id long", "item_id long, text string, doc_id long"


def brute(docs, items, n):
    out = set()
    for d, t, *_ in docs:
        for i, s, *_ in items:
            if None in (d, t, i, s):
                continue
            a, b = lk.words_of(t), lk.words_of(s)
            grams = {tuple(b[k : k + n]) for k in range(len(b) - n + 1)}
            if any(tuple(a[k : k + n]) in grams for k in range(len(a) - n + 1)):
                out.add((d, i))
    return sorted(out, key=repr)


def case(seed=1):
    r = random.Random(seed)
    v = [f"w{i}" for i in range(60)] + ["Straße", "über"]
    items = [(i, " ".join(r.choice(v) for _ in range(r.randrange(3, 30))), 9) for i in range(25)] + [(3, "doppelt w1", 9), (None, "x", 9), (77, None, 9), (78, "", 9)]
    docs = []
    for d in range(60):
        w = [r.choice(v) for _ in range(40)]
        s = r.choice(items[:25])[1].split()
        k = r.randrange(0, max(1, len(s) - 4))
        w[10:10] = s[k : k + r.randrange(3, 16)]
        docs.append((d, ", ".join(w).upper().replace("Ü", "UE") if d % 2 else " ".join(w), 5))
    return docs + [(None, items[0][1], 5), (100, None, 5), (101, "", 5), (102, "w1 " * 100_000 + items[0][1], 5), (0, docs[0][1], 5)], items


@pytest.mark.parametrize("words", [lk.SLICE_WORDS, 60])
def test_against_brute_force_in_one_and_in_many_slices(spark, rows, monkeypatch, words):
    docs, items = case()
    a, b = spark.createDataFrame(docs, D), spark.createDataFrame(items, I)
    monkeypatch.setattr(lk, "SLICE_WORDS", words)
    monkeypatch.setattr(lk, "SEGMENT_WORDS", 20)
    want = brute(docs, items, 6)
    assert (len(list(lk._indexes(b, "item_id", "text", 6))) > 1) == (words == 60)
    assert want and rows(lk.leaks(a, b, 6)) == want
    assert lk.leaks(a.limit(0), b, 6).count() == 0 and lk.leaks(a, b.limit(0), 6).count() == 0
    assert lk.remove_leaks(a.limit(0), b, 6).count() == 0 and lk.remove_leaks(a, b.limit(0), 6).count() == 0


def test_a_hit_is_verified_by_its_words(monkeypatch):
    """With hashes that are all equal, only n-grams that stand in an item are hits."""
    monkeypatch.setattr(lk, "_grams", lambda ids, n: np.zeros(max(0, len(ids) - n + 1), dtype=np.uint64))
    index = lk.ItemIndex([(1, "a b c d".split()), (2, "c d a".split()), (3, ["a"])], 3)
    t, pos, item = index.hits(["x a b c d".split(), "d c b a".split(), [], "c d a b c".split()])
    assert sorted(zip(t.tolist(), pos.tolist(), item.tolist())) == [(0, 1, 1), (0, 2, 1), (3, 0, 2), (3, 2, 1)]


def test_long_items_lose_no_gram_between_segments():
    text = " ".join(f"w{i}" for i in range(101))
    grams = [tuple(s[k : k + 5]) for s in lk.segments_of(text, 5, 7) for k in range(len(s) - 4)]
    assert grams == [tuple(f"w{j}" for j in range(i, i + 5)) for i in range(97)]
    assert lk.segments_of("zu kurz", 5) == []


def test_words_and_spans_are_the_same_words():
    for text in ("İstanbul ist schön.", "Größe ǅ ﬁn İİ x", "A\u0308rger über STRAẞE", "", "Ⅷ ΑΣ, ΑΣ.", "e\u0301 İ\u0307a"):
        assert [w for w, *_ in lk.spans_of(text)] == lk.words_of(text)
        t = lk._composed(text)
        for w, i, j in lk.spans_of(text):
            assert lk.words_of(t[i:j])[:1] == [w] or "i" in w
    assert [(a, b) for _, a, b in lk.spans_of("İb cd")][-1] == (3, 5)


def test_spans_behind_letters_that_grow(spark):
    """The capital dotted I is two signs long in lower case."""
    leaked = "eins zwei drei vier fünf sechs sieben acht neun zehn elf zwölf"
    docs = [(1, f"İstanbul ist schön. {leaked} dreizehn Ende.", 0), (2, f"{'İ' * 50} {leaked}", 0)]
    got = {r["doc_id"]: r for r in lk.remove_leaks(spark.createDataFrame(docs, D), spark.createDataFrame([(1, leaked, 0)], I)).collect()}
    assert got[1]["clean_text"] == "İstanbul ist schön.  dreizehn Ende." and got[1]["removed_chars"] == len(leaked)
    assert got[2]["clean_text"] == "İ" * 50 + " "


def test_normalisation():
    assert lk.words_of("Über STRASSE, Fässer-1") == lk.words_of("ueber Straße faesser 1") == ["ueber", "strasse", "faesser", "1"]


@pytest.mark.parametrize("words", [lk.SLICE_WORDS, 60])
def test_removed_spans_leave_no_leak(spark, rows, monkeypatch, words):
    monkeypatch.setattr(lk, "SLICE_WORDS", words)
    docs, items = case(2)
    a, b = spark.createDataFrame(docs, D), spark.createDataFrame(items, I)
    clean = lk.remove_leaks(a, b, 6)
    assert {r["doc_id"] for r in clean.collect()} == {d for d, _ in brute(docs, items, 6)}
    for r in clean.collect():
        text = next(t for d, t, _ in docs if d == r["doc_id"])
        assert len(text) - r["removed_chars"] == len(r["clean_text"]) and r["n_spans"] >= 1
    one = lk.remove_leaks(spark.createDataFrame([(1, "Vorher. Eins zwei, drei VIER! Nachher.", 0)], D), spark.createDataFrame([(1, "eins zwei drei vier", 0)], I), 4)
    assert [r["clean_text"] for r in one.collect()] == ["Vorher. ! Nachher."]
