import json

import pytest

from strataq.operators import quality as ql
from strataq.operators import reconstruct as rc

TEXT = "Der Rat tagt im Mai. Die Kosten trägt der Bund."
CHANGES = [
    ({"kind": "replace", "old": "im Mai", "new": "im Juni"}, "Der Rat tagt im Juni. Die Kosten trägt der Bund."),
    ({"kind": "delete", "old": "tagt im Mai", "context": "Rat |. Die"}, "Der Rat . Die Kosten trägt der Bund."),
    ({"kind": "insert-after", "anchor": "Mai", "new": " und Juni"}, "Der Rat tagt im Mai und Juni. Die Kosten trägt der Bund."),
    ({"kind": "insert-before", "anchor": "Kosten", "new": "halben "}, "Der Rat tagt im Mai. Die halben Kosten trägt der Bund."),
    ({"kind": "append", "new": " Ende."}, TEXT + " Ende."),
]


@pytest.mark.parametrize("change, after", CHANGES)
def test_forth_and_back(change, after):
    assert rc.apply_change(TEXT, change) == after and rc.apply_change(after, change, back=True) == TEXT
    sure = change | {"before": rc.fingerprint(TEXT), "after": rc.fingerprint(after)}
    assert rc.apply_change(rc.apply_change(TEXT, sure), sure) == after  # twice is once
    assert rc.apply_change(rc.apply_change(after, sure, True), sure, True) == TEXT
    with pytest.raises(rc.DoesNotFit):
        rc.apply_change(TEXT + "x", sure)


@pytest.mark.parametrize("change", [{"kind": "replace", "old": "Der", "new": "x", "after": "0"}, {"kind": "replace", "old": "er", "new": "x"}, {"kind": "replace", "old": "fehlt", "new": "x"}, {"kind": "x"}, {}])
def test_what_does_not_fit(change):
    with pytest.raises(rc.DoesNotFit):
        rc.apply_change(TEXT, change)


def test_walks(spark, rows):
    steps = [("a", "2026-01-01", 1, {"kind": "replace", "old": "Mai", "new": "Juni"}), ("a", "2026-02-01", 1, {"kind": "append", "new": " Ende."}), ("b", "2026-01-01", 1, {"kind": "append", "new": "!"}), ("b", "2026-01-01", 2, {"kind": "replace", "old": "fehlt", "new": "x"}), ("b", "2026-03-01", 1, {"kind": "append", "new": "?"}), ("c", "2026-01-01", 1, {"kind": "append", "new": "?"})]
    changes = spark.createDataFrame([(*s[:3], json.dumps(s[3])) for s in steps] + [(None, "x", 1, "{}"), ("a", "2027-01-01", 1, None)], "k string, day string, seq int, change_json string")
    texts = spark.createDataFrame([("a", TEXT), ("b", TEXT), ("d", TEXT), (None, TEXT), ("c", None)], "k string, text string")
    forth = rc.walk(texts, changes, "k")
    assert rows(forth, "k", "step", "status") == [("a", 1, "reached"), ("a", 2, "reached"), ("b", 1, "reached"), ("b", 2, "refused")]
    last = forth.where("k = 'a' AND step = 2").select("k", "text")
    back = rc.walk(last, changes, "k", back=True).collect()
    assert [(r["day"], r["status"]) for r in sorted(back, key=lambda r: r["step"])] == [("2026-02-01", "reached"), ("2026-01-01", "reached")] and max(back, key=lambda r: r["step"])["text"] == TEXT
    assert rc.walk(texts.limit(0), changes, "k").count() == 0


def test_grouped_diff(spark, rows):
    old = spark.createDataFrame([(1, "a", 1, "x"), (2, "a", 1, "x"), (3, "a", None, "x"), (4, "a", 1, "x")], "k int, t string, n int, s string")
    new = spark.createDataFrame([(1, "a", 1, "x"), (2, "b", 1, "y"), (3, "a", 5, "x"), (5, "a", 1, "x")], "k int, t string, n int, s string")
    got = ql.grouped_diff(old, new, "k", {"meta": ["t", "n"], "search": ["s"]})
    assert rows(got) == [(1, "unchanged", []), (2, "changed", ["meta", "search"]), (3, "changed", ["meta"]), (4, "removed", []), (5, "added", [])]
