"""Search plans, text functions, quality operators, streams and the whole catalogue on the smallest tables."""

import random

import pytest
from pyspark.sql import functions as F

from strataq.functions import text as tx
from strataq.operators import listing, quality
from strataq.plans import search as ps
from strataq.queries import catalogue
from strataq.streaming import events as ev

SF = "/root/testdata/sf0.001"


def test_plans():
    p = ps.build_plan('§ 5 Abs. 2 "im Wald" Bürgerbus')
    assert [(a.kind, a.number, a.subsection) for a in p.addresses] == [("paragraph", "5", "2")]
    assert p.phrases == ["im Wald"] and p.tokens[0].prefix and not p.identity
    assert [a.number for a in ps.build_plan("§§ 1, 2a und 3").addresses] == ["1", "2a", "3"]
    assert ps.build_plan("Art. IV").addresses[0].number == "iv" and not ps.build_plan("Artikel vom Mai").addresses
    assert ps.build_plan("Nr. 2.3").addresses == [ps.Address("number", "2.3")] and ps.build_plan("§ 1 Nr. 2").addresses == [ps.Address("paragraph", "1")]
    assert not ps.build_plan("Wald zur").tokens[-1].prefix and not ps.build_plan("Wald 2024").tokens[-1].prefix and ps.build_plan("bau* wald", "or-prefix").tokens[0].prefix
    assert ps.variants("Bussgeld") == ["bussgeld", "bußgeld"] and ps.variants("Bürger") == ["burger", "buerger"] and "burger" in ps.variants("Buerger")
    assert ps.clamp("x", 0, 10, 5) == 5 and ps.clamp("99", 0, 10, 5) == 10
    assert ps.build_plan("") == ps.Plan([], [], [], [], [], "and-first") and not ps.build_plan("").free_text


def test_text_functions(spark):
    words = ["Straßenbau", "Bürger", "Buerger", "Çédille Ñ", "", None, "ÄÖÜ 12*", "  a  b "]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = df.select("w", tx.normalise(F.col("w")).alias("n"), tx.variants(F.col("w")).alias("v"), tx.fnv1a(F.col("w")).alias("h"), tx.index_letter(F.col("w")).alias("i")).collect()
    for r in got:
        if r["w"] is not None:
            assert r["n"] == ps.normalise(r["w"]) and r["v"] == ps.variants(r["w"])
            h = 2166136261
            for b in r["w"].encode():
                h = (h ^ b) * 16777619 & 0xFFFFFFFF
            assert r["h"] == h
    assert got[6]["i"] == "A" and got[4]["i"] == "#"
    s = spark.createDataFrame([("§ 1", "Titel", "§ 1 Titel: " + "wort " * 80), ("", "", "kurz"), ("", "kurz", "kurzum")], "l string, h string, b string").select(tx.snippet(F.col("l"), F.col("h"), F.col("b")).alias("s")).collect()
    assert s[0]["s"].endswith("wort…") and len(s[0]["s"]) <= 301 and s[0]["s"].startswith("wort") and s[1]["s"] == "kurz" and s[2]["s"] == "kurzum"


def test_quality(spark, rows):
    df = spark.createDataFrame([(i, ["a", "b", "c"][i % 3] if i % 7 else None) for i in range(200)], "id long, g string")
    one = quality.stratified_sample(df, "id", "g", 40, 5, "s")
    assert rows(one) == rows(quality.stratified_sample(df.repartition(7), "id", "g", 40, 5, "s")) and one.count() == 40
    ranks = {r["id"]: r["rank"] for r in quality.global_rank(df.repartition(5), ["g", "id"]).collect()}
    order = sorted(range(200), key=lambda i: ((["a", "b", "c"][i % 3] if i % 7 else ""), i))
    assert [ranks[i] for i in order] == list(range(1, 201))
    assert quality.strided_sample(df, ["id"], 20).count() == 20 and quality.strided_sample(df.limit(0), ["id"], 20).count() == 0
    a = quality.table_fingerprint(df, ["id", "g"]).first()
    assert a == quality.table_fingerprint(df.repartition(9), ["id", "g"]).first() != quality.table_fingerprint(df.where("id > 0"), ["id", "g"]).first()
    new = df.where("id < 190").withColumn("g", F.when(F.col("id") == 5, "z").otherwise(F.col("g"))).union(spark.createDataFrame([(999, "n")], "id long, g string"))
    diff = quality.snapshot_diff(df, new, "id", ["g"])
    assert {r["change"]: r["count"] for r in diff.groupBy("change").count().collect()} == {"removed": 10, "changed": 1, "added": 1, "unchanged": 189}
    assert rows(quality.apply_changes(df, new, diff, "id")) == rows(new)


def test_listing(spark):
    df = spark.createDataFrame([(i, f"b{i % 3}", i % 5) for i in range(60)], "id int, b string, s int")
    f = {(r["facet"], r["value"]): r["n"] for r in listing.disjunctive_facets(df, {"b": F.col("b"), "s": F.col("s")}, {"b": F.col("b") == "b1", "s": F.col("s") < 2}).collect()}
    assert f["b", "b0"] == sum(i % 3 == 0 and i % 5 < 2 for i in range(60)) and f["s", "4"] == sum(i % 5 == 4 and i % 3 == 1 for i in range(60)) and f["total", None] == sum(i % 3 == 1 and i % 5 < 2 for i in range(60))
    assert [r["id"] for r in listing.page(df, [F.desc("id")], -5, 1000).collect()] == list(range(59, -1, -1))
    assert [r["id"] for r in listing.page_after(df, "id", 10, 3).orderBy("id").collect()] == [11, 12, 13]
    parts = listing.split_parts(df, ["id"], 4)
    assert parts.count() == 60 and {r["part"] for r in parts.collect()} <= {0, 1, 2, 3}


def test_stream_upsert(spark, tmp_path):
    r = random.Random(1)
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    data = [(i, r.randrange(5), i) for i in range(40)]
    for k in range(2):
        spark.createDataFrame(data[k * 20 : k * 20 + 20], "event_id int, user_id int, ts int").coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema("event_id int, user_id int, ts int").option("maxFilesPerTrigger", 1).parquet(src)
    ev.run_available(stream, "append", ev.upsert_batches(out, "user_id", "ts"))
    last = {u: max(t for _, v, t in data if v == u) for u in {x[1] for x in data}}
    sink = ev.upsert_batches(out, "user_id", "ts")
    schema = "event_id int, user_id int, ts int"
    read = lambda: {x["user_id"]: x["ts"] for x in ev.read_upserted(spark, out, schema).collect()}
    assert read() == last
    sink(spark.createDataFrame([(1, 3, 999), (2, 77, 5)], schema), 2)
    sink(spark.createDataFrame([(1, 3, 999), (2, 77, 5)], schema), 2)  # run again
    assert read() == last | {3: 999, 77: 5}
    import pathlib

    assert len(list(pathlib.Path(out, "generation=2").glob("key_bucket=*"))) <= 2
    assert ev.read_upserted(spark, out + "/none", schema).count() == 0


def test_catalogue_has_sql_for_most():
    assert len(catalogue.QUERIES) > 100
    assert set(catalogue.SQL) <= set(catalogue.QUERIES)
    assert len(catalogue.SQL) / len(catalogue.QUERIES) > 0.9


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_equals_sql(spark, name):
    from tests.oracle import connect, spark_rows, sql_rows

    got, want = spark_rows(catalogue.QUERIES[name](spark, SF)), sql_rows(connect(SF), catalogue.SQL[name])
    assert got == want


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_query_runs(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() >= 0
