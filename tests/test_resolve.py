import random

from pyspark.sql import functions as F

from strataq.operators import resolve as rs


def test_unique_key(spark, rows):
    df = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3"), ("b", "3"), (None, "4")], "k string, i string")
    assert rows(rs.unique_key(df, "k", "i", "hit")) == [("b", "3")]


def test_overlap_against_all_pairs(spark, rows):
    r = random.Random(6)
    v = [f"w{i}" for i in range(25)] + ["the"] * 3
    make = lambda n, p: [(f"{p}{i}", sorted({r.choice(v) for _ in range(r.randrange(0, 7))})) for i in range(n)]
    left, right = make(80, "l"), make(60, "r")
    want = []
    for i, a in left:
        best = sorted(((len(set(a) & set(b)) / min(len(a), len(b)), len(set(a) & set(b)), j) for j, b in right if a and b), reverse=True)
        best = [x for x in best if x[0] >= 0.75]
        if best and (len(best) == 1 or best[0][:2] > best[1][:2]):
            want.append((i, best[0][2]))
    got = rs.overlap_match(spark.createDataFrame(left, "i string, w array<string>"), spark.createDataFrame(right, "j string, w array<string>"), "i", "j", "w", 0.75)
    assert want and rows(got, "i", "j") == sorted(want, key=repr)
    empty = spark.createDataFrame([], "i string, w array<string>")
    assert rs.overlap_match(empty, empty.withColumnRenamed("i", "j"), "i", "j", "w", 0.75).count() == 0


def test_beginnings_against_all_pairs(spark, rows):
    r = random.Random(7)
    keys = ["".join(r.choice("ab") for _ in range(r.randrange(1, 9))) for _ in range(300)] + ["a"] * 5 + ["ab*", "ab 1", "", "ä", "äb", "😀", "😀b"]
    data = [(i, k) for i, k in enumerate(keys)] + [(None, "a"), (999, None)]
    want = sorted((i, j) for i, a in enumerate(keys) for j, b in enumerate(keys) if i < j and (a.startswith(b) or b.startswith(a)))
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    for coalesced in ("true", "false"):  # one partition, or keys that stay open over several
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesced)
        got = rs.beginning_pairs(spark.createDataFrame(data, "i int, k string"), "i", "k").select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"))
        assert sorted(map(tuple, got.collect())) == want
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    assert rs.beginning_pairs(spark.createDataFrame([], "i int, k string"), "i", "k").count() == 0


def test_titles_are_not_written_out_for_each_beginning(spark, tmp_path):
    """A row for each beginning of each title is more than any budget, and is not seen by the planner, which sent it to all executors."""
    from strataq.queries.quality import prefix_title_match

    spark.read.parquet("/root/testdata/sf0.001/law_norms.parquet").write.parquet(str(tmp_path / "law_norms.parquet"))
    assert "Generate" not in prefix_title_match(spark, str(tmp_path))._jdf.queryExecution().toString()


def test_signals(spark):
    df = spark.createDataFrame([(True, True, True), (True, False, True), (False, True, True), (None, None, None), (True, None, False)], "a boolean, b boolean, c boolean")
    assert [x[0] for x in df.select(rs.signal_level([F.col("a"), F.col("b"), F.col("c")])).collect()] == ["exact", "strong", "weak", None, "weak"]
