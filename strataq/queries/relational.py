"""Scans, filters, joins, facets, paging, sets and upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataq.operators import listing, quality
from strataq.queries.temporal import norms_now
from strataq.session import table

#: A type stands for its family in filters.
FAMILIES = {"verwaltungsvorschrift": ["verwaltungsvorschrift", "runderlass", "richtlinie", "bekanntmachung"], "gesetz": ["gesetz", "zustimmungsgesetz"]}
DEFAULT_SCOPE = ["verfassung", "gesetz", "zustimmungsgesetz", "verordnung"]


def expand_types(types: list[str], scope: str | None = None) -> list[str]:
    """Explicit types before the scope's default, then families."""
    chosen = types or (DEFAULT_SCOPE if scope == "gesetze" else [])
    return sorted({m for t in chosen for m in FAMILIES.get(t, [t])})


def scan_project_filter(spark, d):
    return table(spark, d, "orders").where("o_orderstatus IN ('O', 'P') AND o_orderdate >= '1999-01-01'").select("o_orderkey", "o_custkey", "o_totalprice")


def family_filter(spark, d):
    return table(spark, d, "law_norms").where(F.col("type").isin(expand_types(["verwaltungsvorschrift"]))).select("id", "type").distinct()


def default_scope_filter(spark, d):
    return table(spark, d, "law_norms").where(F.col("type").isin(expand_types([], "gesetze"))).select("id", "type").distinct()


def subject_contains(spark, d):
    return norms_now(spark, d, "subjects").where(F.arrays_overlap("subjects", F.array(F.lit("Umwelt"), F.lit("Energie")))).select("id")


def letter_filter(spark, d):
    return norms_now(spark, d, "index_letter", "status").where("index_letter = 'B' AND status = 'in-force'").select("id")


def count_by_type(spark, d):
    return norms_now(spark, d, "type").groupBy("type").agg(F.count("*").alias("n"))


def facets_disjunctive(spark, d):
    p = table(spark, d, "part")
    return listing.disjunctive_facets(p, {"brand": F.col("p_brand"), "type": F.col("p_type"), "size": F.col("p_size")}, {"brand": F.col("p_brand").isin("Brand#4", "Brand#8"), "type": F.col("p_type") == "PROMO", "size": F.col("p_size") <= 25})


def facets_conditional_sum(spark, d):
    """Conditional sums per flag, with assigned and unassigned."""
    l = table(spark, d, "lineitem")
    return l.groupBy("l_linestatus").agg(
        F.count_if(F.col("l_returnflag") == "A").alias("a"), F.count_if(F.col("l_returnflag") == "R").alias("r"), F.count_if(F.col("l_returnflag").isin("A", "R")).alias("assigned"), F.count_if(~F.col("l_returnflag").isin("A", "R")).alias("unassigned")
    )


def facets_pivot(spark, d):
    """Category by decision counts as a matrix."""
    r = table(spark, d, "feedback_reports").select("id", "category", "priority").distinct()
    return r.groupBy("category").pivot("priority", ["P1", "P2", "P3"]).agg(F.count(F.lit(1))).select("category", *[F.coalesce(c, F.lit(0)).alias(c.lower()) for c in ("P1", "P2", "P3")])


def subject_facets(spark, d):
    n = norms_now(spark, d, "subjects", "jurisdiction")
    return n.select("jurisdiction", F.explode_outer("subjects").alias("subject")).groupBy("jurisdiction", "subject").agg(F.count("*").alias("n"))


def topk_per_group(spark, d):
    l = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    # equal rows exist, so the price itself is what the order decides on
    return listing.top_per_group(l, ["l_orderkey"], [F.desc("l_extendedprice"), F.asc("l_linenumber")], 3).select("l_orderkey", "rank", "l_extendedprice")


def first_blocks(spark, d):
    b = table(spark, d, "law_version_blocks").where("part_index = 0").select("norm_id", "version_id", "block_index").distinct()
    return listing.top_per_group(b, ["norm_id", "version_id"], [F.asc("block_index")], 8)


def paging_offset(spark, d):
    return listing.page(table(spark, d, "customer").select("c_custkey", "c_acctbal"), [F.desc("c_acctbal"), F.asc("c_custkey")], 40, 20)


def paging_keyset(spark, d):
    return listing.page_after(table(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey", 500, 50)


def federated_topk(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    parts = [c.where(F.col("c_nationkey") % 4 == k) for k in range(4)]
    return listing.federated_top(parts, [F.desc("c_acctbal"), F.asc("c_custkey")], 10, 20)


def german_sort(spark, d):
    """Every norm's position by area and short title in German dictionary order (umlauts as their vowels, sharp s as ss); ties by id."""
    fold = F.replace(F.translate(F.lower("short_title"), "äöü", "aou"), F.lit("ß"), F.lit("ss"))
    n = norms_now(spark, d, "short_title", "jurisdiction").withColumn("k", fold)
    return quality.global_rank(n, ["jurisdiction", "k", "id"]).select("jurisdiction", "id", F.col("rank").alias("position"))


def natural_order(spark, d):
    p = table(spark, d, "part").select("p_brand").distinct()
    return p.select("p_brand", F.regexp_extract("p_brand", "(\\d+)", 1).cast("int").alias("number")).withColumn("position", F.row_number().over(Window.orderBy("number", "p_brand")))  # a row per brand


def round_robin_sample(spark, d):
    return listing.round_robin(table(spark, d, "documents").where("doc_type IS NOT NULL").select("doc_id", "doc_type"), "doc_type", [F.asc("doc_id")], 40).select("doc_id", "doc_type", "turn")


def semi_exists(spark, d):
    o = table(spark, d, "orders").where("o_totalprice > 400000").select("o_custkey")
    return table(spark, d, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_mktsegment")


def anti_not_exists(spark, d):
    o = table(spark, d, "orders").where("o_orderdate >= '2000-01-01'").select("o_custkey")
    return table(spark, d, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


def stale_index(spark, d):
    """Norms by whether their current version is named, has a version row, and has stored blocks: what an index lacks or would keep too long."""
    n = norms_now(spark, d, "current_version_id").select(F.col("id").alias("norm_id"), F.col("current_version_id").alias("version_id"))
    flag = lambda t, c: table(spark, d, t).select("norm_id", "version_id").distinct().withColumn(c, F.lit(True))
    j = n.join(flag("law_versions", "v"), ["norm_id", "version_id"], "left").join(flag("law_version_blocks", "b"), ["norm_id", "version_id"], "left")
    state = F.when(F.col("version_id").isNull(), "no-current").when(F.col("v").isNull(), "no-version").when(F.col("b").isNull(), "no-blocks").otherwise("indexed")
    left_over = flag("law_version_blocks", "b").join(table(spark, d, "law_versions").select("norm_id", "version_id"), ["norm_id", "version_id"], "left_anti")
    return j.select(state.alias("state")).unionByName(left_over.select(F.lit("blocks-without-version").alias("state"))).groupBy("state").agg(F.count("*").alias("n"))


def four_way_join_min_rank(spark, d):
    l, o, c, n = (table(spark, d, t) for t in ("lineitem", "orders", "customer", "nation"))
    j = l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("n_name").agg(F.min("l_discount").alias("best"), F.max((F.col("l_returnflag") == "R").cast("int")).alias("any_return"), F.countDistinct("o_orderkey", "l_linenumber").alias("n_pairs"))


def correlated_latest(spark, d):
    """Latest order per customer: one aggregation instead of a correlated subquery."""
    o = table(spark, d, "orders")
    return o.groupBy("o_custkey").agg(F.max(F.struct("o_orderdate", "o_orderkey")).alias("x"), F.count("*").alias("n")).select("o_custkey", F.col("x.o_orderkey").alias("latest"), F.col("x.o_orderdate").alias("day"), "n")


def source_crosscheck(spark, d):
    """Which norms the sources, the versions and the norm table know."""
    a = table(spark, d, "law_norms").select(F.col("id").alias("k")).distinct().withColumn("a", F.lit(True))
    b = table(spark, d, "law_source_objects").select(F.col("norm_id").alias("k")).distinct().withColumn("b", F.lit(True))
    flag = F.when(F.col("a") & F.col("b"), "both").when(F.col("a"), "only-left").otherwise("only-right")
    return a.join(b, "k", "full_outer").groupBy(flag.alias("side")).agg(F.count("*").alias("n"))


def set_difference(spark, d):
    a = table(spark, d, "orders").select(F.col("o_custkey").alias("k")).where("o_orderdate < '1996-01-01'").distinct()
    b = table(spark, d, "orders").where("o_orderdate >= '2001-01-01'").select(F.col("o_custkey").alias("k")).distinct()
    return a.exceptAll(b).withColumn("side", F.lit("early")).unionByName(b.exceptAll(a).withColumn("side", F.lit("late")))


def relation_merge(spark, d):
    """Two relation lists merged by key; the left note wins, the right one fills."""
    a = table(spark, d, "part").where("p_size < 20").select("p_partkey", F.col("p_type").alias("note_a"))
    b = table(spark, d, "part").where("p_size BETWEEN 10 AND 30").select("p_partkey", F.col("p_brand").alias("note_b"))
    return a.join(b, "p_partkey", "full_outer").select("p_partkey", F.coalesce("note_a", "note_b").alias("note"), (F.col("note_a").isNotNull() & F.col("note_b").isNotNull()).alias("both"))


def duplicate_keys(spark, d):
    return table(spark, d, "law_versions").groupBy("norm_id", "version_id").agg(F.count("*").alias("n")).where("n > 1")


def upsert_latest_wins(spark, d):
    e = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.max(F.struct("ts", "event_id", "value")).alias("x"))
    return e.select("user_id", "event_type", F.col("x.event_id").alias("event_id"), F.col("x.value").alias("value"))


def insert_ignore(spark, d):
    e = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.min(F.struct("ts", "event_id")).alias("x"))
    return e.select("user_id", "event_type", F.col("x.event_id").alias("event_id"))


def json_extract_explode(spark, d):
    e = table(spark, d, "events").select("event_type", F.get_json_object("props", "$.k").cast("int").alias("k"))
    return e.groupBy("event_type", "k").agg(F.count("*").alias("n"))


def grouping_sets(spark, d):
    l = table(spark, d, "lineitem")
    return l.rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


def relation_targets(spark, d):
    """Which targets of a batch of references exist."""
    s = table(spark, d, "law_versions").select("norm_id").distinct()
    n = table(spark, d, "law_norms").select(F.col("id").alias("norm_id"), F.lit(True).alias("there")).distinct()
    return s.join(n, "norm_id", "left").select("norm_id", F.coalesce("there", F.lit(False)).alias("there"))


def range_join(spark, d):
    """Orders in price bands: the interval join, by a bounded table of bands."""
    bands = spark.createDataFrame([(i, i * 50000.0, (i + 1) * 50000.0) for i in range(10)], "band int, low double, high double")
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return o.join(F.broadcast(bands), (F.col("o_totalprice") >= F.col("low")) & (F.col("o_totalprice") < F.col("high"))).groupBy("band").agg(F.count("*").alias("n"))


_LN = "WITH ln AS (SELECT * FROM law_norms QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) = 1) "

QUERIES = {
    f.__name__: f
    for f in (
        scan_project_filter, family_filter, default_scope_filter, subject_contains, letter_filter, count_by_type, facets_disjunctive, facets_conditional_sum, facets_pivot, subject_facets, topk_per_group,
        first_blocks, paging_offset, paging_keyset, federated_topk, german_sort, natural_order, round_robin_sample, semi_exists, anti_not_exists, stale_index, four_way_join_min_rank, correlated_latest,
        source_crosscheck, set_difference, relation_merge, duplicate_keys, upsert_latest_wins, insert_ignore, json_extract_explode, grouping_sets, relation_targets, range_join,
    )
}

_PART = "p_brand IN ('Brand#4', 'Brand#8')", "p_type = 'PROMO'", "p_size <= 25"

SQL = {
    "scan_project_filter": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus IN ('O', 'P') AND o_orderdate >= '1999-01-01'",
    "family_filter": "SELECT DISTINCT id, type FROM law_norms WHERE type IN ('verwaltungsvorschrift', 'runderlass', 'richtlinie', 'bekanntmachung')",
    "default_scope_filter": "SELECT DISTINCT id, type FROM law_norms WHERE type IN ('verfassung', 'gesetz', 'zustimmungsgesetz', 'verordnung')",
    "subject_contains": _LN + "SELECT id FROM ln WHERE list_has_any(subjects, ['Umwelt', 'Energie'])",
    "letter_filter": _LN + "SELECT id FROM ln WHERE index_letter = 'B' AND status = 'in-force'",
    "count_by_type": _LN + "SELECT type, count(*) AS n FROM ln GROUP BY type",
    "facets_disjunctive": f"SELECT 'brand' AS facet, p_brand AS value, count(*) AS n FROM part WHERE {_PART[1]} AND {_PART[2]} GROUP BY ALL UNION ALL SELECT 'type', p_type, count(*) FROM part WHERE {_PART[0]} AND {_PART[2]} GROUP BY ALL UNION ALL SELECT 'size', CAST(p_size AS VARCHAR), count(*) FROM part WHERE {_PART[0]} AND {_PART[1]} GROUP BY ALL UNION ALL SELECT 'total', NULL, count(*) FROM part WHERE {_PART[0]} AND {_PART[1]} AND {_PART[2]}",
    "facets_conditional_sum": "SELECT l_linestatus, count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_returnflag = 'R') AS r, count(*) FILTER (l_returnflag IN ('A', 'R')) AS assigned, count(*) FILTER (l_returnflag NOT IN ('A', 'R')) AS unassigned FROM lineitem GROUP BY ALL",
    "facets_pivot": "SELECT category, count(*) FILTER (priority = 'P1') AS p1, count(*) FILTER (priority = 'P2') AS p2, count(*) FILTER (priority = 'P3') AS p3 FROM (SELECT DISTINCT id, category, priority FROM feedback_reports) GROUP BY ALL",
    "subject_facets": _LN + "SELECT jurisdiction, subject, count(*) AS n FROM (SELECT jurisdiction, unnest(CASE WHEN subjects IS NULL OR len(subjects) = 0 THEN [NULL] ELSE subjects END) AS subject FROM ln) GROUP BY ALL",
    "topk_per_group": "SELECT l_orderkey, rank, l_extendedprice FROM (SELECT l_orderkey, l_extendedprice, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS rank FROM lineitem) WHERE rank <= 3",
    "first_blocks": "SELECT norm_id, version_id, block_index, rank FROM (SELECT norm_id, version_id, block_index, row_number() OVER (PARTITION BY norm_id, version_id ORDER BY block_index) AS rank FROM (SELECT DISTINCT norm_id, version_id, block_index FROM law_version_blocks WHERE part_index = 0)) WHERE rank <= 8",
    "paging_offset": "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20 OFFSET 40",
    "paging_keyset": "SELECT c_custkey, c_name FROM customer WHERE c_custkey > 500 ORDER BY c_custkey LIMIT 50",
    "federated_topk": "SELECT c_custkey, c_nationkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20 OFFSET 10",
    "german_sort": _LN + "SELECT jurisdiction, id, row_number() OVER (ORDER BY jurisdiction NULLS FIRST, replace(translate(lower(short_title), 'äöü', 'aou'), 'ß', 'ss') NULLS FIRST, id) AS position FROM ln",
    "natural_order": "SELECT *, row_number() OVER (ORDER BY number, p_brand) AS position FROM (SELECT DISTINCT p_brand, CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INTEGER) AS number FROM part)",
    "round_robin_sample": "SELECT doc_id, doc_type, turn FROM (SELECT doc_id, doc_type, row_number() OVER (PARTITION BY doc_type ORDER BY doc_id) AS turn FROM documents WHERE doc_type IS NOT NULL) ORDER BY turn, doc_type, doc_id LIMIT 40",
    "semi_exists": "SELECT c_custkey, c_mktsegment FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)",
    "anti_not_exists": "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= '2000-01-01')",
    "stale_index": _LN + ", v AS (SELECT DISTINCT norm_id, version_id FROM law_versions), b AS (SELECT DISTINCT norm_id, version_id FROM law_version_blocks) SELECT state, count(*) AS n FROM (SELECT CASE WHEN current_version_id IS NULL THEN 'no-current' WHEN v.norm_id IS NULL THEN 'no-version' WHEN b.norm_id IS NULL THEN 'no-blocks' ELSE 'indexed' END AS state FROM ln LEFT JOIN v ON v.norm_id = id AND v.version_id = current_version_id LEFT JOIN b ON b.norm_id = id AND b.version_id = current_version_id UNION ALL SELECT 'blocks-without-version' FROM b ANTI JOIN v USING (norm_id, version_id)) GROUP BY state",
    "four_way_join_min_rank": "SELECT n_name, min(l_discount) AS best, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS any_return, count(DISTINCT (o_orderkey, l_linenumber)) AS n_pairs FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
    "correlated_latest": "SELECT o_custkey, o_orderkey AS latest, o_orderdate AS day, n FROM (SELECT *, count(*) OVER (PARTITION BY o_custkey) AS n, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1",
    "source_crosscheck": "SELECT CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL THEN 'both' WHEN a.k IS NOT NULL THEN 'only-left' ELSE 'only-right' END AS side, count(*) AS n FROM (SELECT DISTINCT id AS k FROM law_norms) a FULL JOIN (SELECT DISTINCT norm_id AS k FROM law_source_objects) b ON a.k = b.k GROUP BY ALL",
    "set_difference": "WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderdate < '1996-01-01'), b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderdate >= '2001-01-01') SELECT k, 'early' AS side FROM (SELECT k FROM a EXCEPT SELECT k FROM b) UNION ALL SELECT k, 'late' FROM (SELECT k FROM b EXCEPT SELECT k FROM a)",
    "relation_merge": "SELECT coalesce(a.p_partkey, b.p_partkey) AS p_partkey, coalesce(a.n, b.n) AS note, a.n IS NOT NULL AND b.n IS NOT NULL AS both FROM (SELECT p_partkey, p_type AS n FROM part WHERE p_size < 20) a FULL JOIN (SELECT p_partkey, p_brand AS n FROM part WHERE p_size BETWEEN 10 AND 30) b ON a.p_partkey = b.p_partkey",
    "duplicate_keys": "SELECT norm_id, version_id, count(*) AS n FROM law_versions GROUP BY ALL HAVING n > 1",
    "upsert_latest_wins": "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1",
    "insert_ignore": "SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1",
    "json_extract_explode": "SELECT event_type, CAST(props ->> '$.k' AS INTEGER) AS k, count(*) AS n FROM events GROUP BY ALL",
    "grouping_sets": "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)",
    "relation_targets": "SELECT DISTINCT norm_id, norm_id IN (SELECT id FROM law_norms) AS there FROM law_versions",
    "range_join": "SELECT CAST(floor(o_totalprice / 50000) AS INTEGER) AS band, count(*) AS n FROM orders WHERE o_totalprice >= 0 AND o_totalprice < 500000 GROUP BY ALL",
}
