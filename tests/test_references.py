from datetime import datetime

from strataq.operators import references as rf

P = "parent_table string, parent_key string, first_seen timestamp_ntz, extra int"
C = "ref_table string, ref_field string, ref_key string, parent_table string, parent_key string, first_seen timestamp_ntz, guard_table string, guard_key string, reason string, salt int"
R = "parent_table string, parent_key string, removed_at timestamp_ntz"


def day(n):
    return datetime(2026, 1, n)


def child(key, parent, seen=day(5), table="t", guard=None):
    return ("c", "f", key, table, parent, seen, "g" if guard else None, guard, "clash", 99)


def run(spark, parents, children, removals=()):
    return rf.orphan_references(spark.createDataFrame(list(parents), P), spark.createDataFrame(list(children), C), spark.createDataFrame(list(removals), R))


def test_reasons_and_earliest_delivery(spark, rows):
    parents = [("t", "ok", day(1), 1), ("t", "late", day(9), 1), ("t", "late", day(8), 1), ("t", "tie", day(5), 1), ("t", None, day(1), 1), ("u", "gone", day(1), 1)]
    children = [child("1", "ok"), child("2", "late"), child("2", "late", day(3)), child("3", "tie"), child("4", "gone"), child("5", "none"), child("6", None), child("7", "late", day(9)), child("7", "late", None)]
    found = run(spark, parents, children, [("t", "gone", day(2)), ("t", "ok", day(2)), ("t", None, None)])
    assert rows(found, "ref_key", "reason", "period") == [("2", "late", "2026-01"), ("4", "deleted", "2026-01"), ("5", "missing", "2026-01")]


def test_unknown_times_are_never_late(spark, rows):
    found = run(spark, [("t", "a", None, 1), ("t", "b", day(9), 1)], [child("1", "a"), child("2", "b", None), child("3", "x", None)])
    assert rows(found, "ref_key", "reason", "period") == [("3", "missing", None)]


def test_guard(spark, rows):
    found = run(spark, [("g", "n1", day(1), 1)], [child("1", "v", guard="n1"), child("2", "v", guard="n2"), child("2", "n2", table="g")])
    assert rows(found, "ref_key", "parent_table" if False else "reason") == [("1", "missing"), ("2", "missing")]
    assert found.count() == 2  # the guarded one of 2 is left out, its missing norm is reported


def test_hot_key_and_brute_force(spark, rows):
    children = [child(str(i), "hot" if i % 3 == 0 else f"k{i % 40}") for i in range(600)]
    parents = [("t", f"k{i}", day(1 + i % 10), 1) for i in range(0, 40, 2)]
    first = {p[1]: p[2] for p in parents}
    want = sorted((c[2], "late" if c[4] in first else "missing") for c in children if c[4] not in first or first[c[4]] > c[5])
    assert rows(run(spark, parents, children), "ref_key", "reason") == want
    counts = rf.orphan_counts(run(spark, parents, children)).collect()
    assert sum(r["n"] for r in counts) == len(want)


def test_empty(spark):
    assert run(spark, [], []).count() == 0
    assert run(spark, [], [child("1", "a")]).count() == 1
    assert run(spark, [("t", "a", day(1), 1)], []).count() == 0
