import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataq.functions import editing as ed


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab \n", max_size=40), st.text(alphabet="ab \n", max_size=40))
def test_diff_keeps_every_character(a, b):
    parts = ed.word_diff(a, b)
    assert "".join(t for k, t in parts if k != "new") == a and "".join(t for k, t in parts if k != "gone") == b
    assert all(x[0] != y[0] for x, y in zip(parts, parts[1:]))


def test_diff():
    assert ed.word_diff("Die alte Frist gilt", "Die neue Frist gilt") == [("same", "Die "), ("gone", "alte"), ("new", "neue"), ("same", " Frist gilt")]
    big = " ".join(f"w{i}" for i in range(700))
    assert [k for k, _ in ed.word_diff("a " + big, "b " + big[::-1], 250_000)] == ["gone", "new"]
    long = [f"w{i}" for i in range(3000)]
    parts = ed.word_diff(" ".join(long), " ".join(w for i, w in enumerate(long) if i % 10))
    assert {t.strip() for k, t in parts if k == "gone"} == {w for i, w in enumerate(long) if i % 10 == 0} and not any(k == "new" for k, _ in parts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=14), st.lists(st.sampled_from("abc"), max_size=14))
def test_diff_is_longest(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    x, y = (np.array([ord(c) for c in s], dtype=np.int64) for s in (a, b))
    pairs = ed._matched(x, y, 0, 0)
    assert len(pairs) == best[-1][-1] and all(a[i] == b[j] for i, j in pairs) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def test_sentences():
    assert ed.sentences("Nach Abs. 2 gilt das. Es endet am 3. Mai. Ende") == ["Nach Abs. 2 gilt das.", "Es endet am 3. Mai.", "Ende"]
    assert ed.sentences("Offen (Klammer. Ende") is None and ed.sentences("") == []
    assert ed.sentences("Er sagte „Halt. Sofort.“ Dann ging er.") == ["Er sagte „Halt. Sofort.“", "Dann ging er."]


def test_replacements():
    rules = [("a", "Amt", "Behörde"), ("b", "Amt (\\w+)", r"Stelle \1")]
    text = "Amt West und „Amt Ost“ und Amt"
    plan = ed.plan_replacements(text, rules, ["„[^“]*“"])
    assert ed.apply_replacements(text, plan) == "Behörde West und „Amt Ost“ und Behörde"
    assert ed.plan_replacements("", rules, []) == []


@pytest.mark.parametrize("text, kind", [("§ 3 wird aufgehoben.", "repeal"), ("In § 1 wird das Wort A durch B ersetzt.", "replace"), ("Nach § 1 wird folgender § 2 eingefügt", "insert"), ("Es werden Sätze angefügt", "append"), ("Die Anlage wird in Muster umbenannt", "rename"), ("Nichts.", None), ("", None), (None, None), ("Der Satz „wird aufgehoben“ bleibt.", None), ("In § 1 werden " + "die Wörter und " * 90 + "ersetzt.", "replace")])
def test_commands(spark, text, kind):
    assert spark.createDataFrame([(text,)], "t string").select(ed.command_of(F.col("t")).alias("k")).first()["k"] == kind
