import pytest
from pyspark.sql import functions as F

from strataq.operators import resolve as rs
from strataq.operators import temporal as tm
from strataq.plans import guard
from strataq.sources import runs


def test_runs_take_up_what_is_pending(spark, tmp_path, rows):
    root, seen = str(tmp_path / "run"), []

    def process(df):
        seen.append(sorted(r["k"] for r in df.collect()))
        bad = F.col("v") == "schlecht"
        return df.select("k", F.when(bad, "failed").otherwise("done").alias("status"), F.when(bad, "Grund").alias("note"), F.upper("v").alias("result"))

    items = spark.createDataFrame([(1, "a"), (2, "b"), (3, "schlecht"), (None, "x"), (4, None)], "k int, v string")
    assert runs.run_pending(items, "k", process, root) == {"done": 3, "failed": 1}
    assert runs.run_pending(items, "k", process, root) == {} and seen[-1] == []
    changed = items.withColumn("v", F.when(F.col("k") == 2, "neu").otherwise(F.col("v")))
    assert runs.run_pending(changed, "k", process, root) == {"done": 1} and seen[-1] == [2]
    assert runs.run_pending(changed, "k", process, root, retry_failed=True, most_failed=1) == {"failed": 1} and seen[-1] == [3]
    assert rows(runs.read_log(spark, root), "key", "status") == [("1", "done"), ("2", "done"), ("3", "failed"), ("4", "done")]
    worse = spark.createDataFrame([(i, "schlecht") for i in range(10, 20)], "k int, v string")
    with pytest.raises(runs.SystemicStop):
        runs.run_pending(worse, "k", process, root)
    assert runs.pending(worse, "k", root).count() == 10  # nothing was logged
    assert runs.run_pending(items.limit(0), "k", process, str(tmp_path / "none")) == {}


@pytest.mark.parametrize("sql", ["SELECT 1", "with x as (select 1) select * from x;", "SELECT 'drop table x; delete' -- insert\n FROM t", "select replace(a, 'x', 'y') from t /* update; */", "VALUES (1)"])
def test_queries_pass(sql):
    assert guard.assert_read_only(sql) == sql.strip().removesuffix(";")


@pytest.mark.parametrize("sql", ["", "DROP TABLE t", "SELECT 1; SELECT 2", "WITH x AS (DELETE FROM t RETURNING *) SELECT * FROM x", "select 'offen", "SELECT 1 /* offen", "EXPLAIN SELECT 1", "insert into t select 1"])
def test_others_do_not(sql):
    with pytest.raises(guard.NotReadOnly):
        guard.assert_read_only(sql)


def test_page_windows():
    assert guard.page_windows(0, 1) == [1] and guard.page_windows(100, 9) == [1, 2]
    assert guard.page_windows(1000, 10) == [1, None, 8, 9, 10, 11, 12, None, 20] and guard.page_windows(1000, 4) == [1, 2, 3, 4, 5, 6, None, 20]


def test_tiers(spark, rows):
    refs = spark.createDataFrame([(1, "x", "t"), (2, "doppelt", "t"), (3, None, "nichts"), (4, "y", None)], "n int, a string, b string")
    targets = spark.createDataFrame([("A", "x", "u"), ("B", "doppelt", "t"), ("C", "doppelt", "w"), ("D", "y", None), ("D", "y", None)], "id string, a string, b string")
    got = rs.resolve_by_tiers(refs, targets, "id", [("first", "a", "a"), ("second", "b", "b")])
    assert rows(got, "n", "resolved", "tier") == [(1, "A", "first"), (2, "B", "second"), (3, None, "none"), (4, "D", "first")]


def test_equal_word_sets_are_matched_once(spark, rows):
    left = spark.createDataFrame([(i, ["alpha", "beta", "gamma"]) for i in range(200)] + [(900, ["delta"])], "l int, w array<string>")
    right = spark.createDataFrame([(1, ["gamma", "beta", "alpha"]), (2, ["omega"]), (3, ["delta"]), (4, ["delta"])], "r int, w array<string>")
    got = rs.overlap_match(left, right, "l", "r", "w", 0.75)
    assert rows(got, "l", "r") == sorted(((i, 1) for i in range(200)), key=repr)  # two rows have delta, so it refuses


def test_systemic_stop(spark):
    codes = ["a"] * 4 + [None] + ["a", "b"] * 4
    df = spark.createDataFrame([("u", i, c) for i, c in enumerate(codes)] + [("v", 0, None)], "u string, i int, c string")
    got = {(r["u"], r["i"]): r for r in tm.systemic_stop(df, ["u"], ["i"], "c", in_row=8, same=6, window=9).collect()}
    assert got["u", 3]["in_row"] == 4 and got["u", 4]["in_row"] == 0 and got["u", 12]["in_row"] == 8 and got["u", 12]["stop"]
    assert got["u", 7]["same_code"] == 6 and got["u", 7]["stop"] and got["u", 8]["same_code"] == 2 and not got["v", 0]["stop"]
