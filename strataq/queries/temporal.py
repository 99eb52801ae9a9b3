"""Temporal queries over versions, orders and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataq.operators import temporal as tm
from strataq.session import table

BASELINE, AS_OF = "2023-12-01", "2026-09-01"
_DATES = ["simulation_valid_from", "simulation_valid_to", "source_valid_from", "source_valid_to"]


def versions_now(spark: SparkSession, d: str, *more: str) -> DataFrame:
    """Latest row of each version, narrow columns."""
    cols = [*_DATES, *more]
    g = table(spark, d, "law_versions").groupBy("norm_id", "version_id").agg(F.max(F.struct("updated_at", *cols)).alias("x"))
    return g.select("norm_id", "version_id", *[F.col(f"x.{c}").alias(c) for c in cols])


def norms_now(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    g = table(spark, d, "law_norms").groupBy("id").agg(F.max(F.struct("updated_at", *cols)).alias("x"))
    return g.select("id", *[F.col(f"x.{c}").alias(c) for c in cols])


def _with_norms(spark: SparkSession, d: str) -> DataFrame:
    n = norms_now(spark, d, "status", "expiry_date").withColumnRenamed("id", "norm_id")
    return versions_now(spark, d).where("simulation_valid_from IS NOT NULL").join(n, "norm_id")


def _order_days(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("valid_from")).distinct()


def interval_derive(spark, d):
    return tm.derive_ends(_order_days(spark, d), "o_custkey", "valid_from")


def interval_neighbour_findings(spark, d):
    return tm.neighbour_findings(versions_now(spark, d), "norm_id", "version_id", "simulation_valid_from", "simulation_valid_to")


def interval_selection(spark, d):
    return tm.select_at(versions_now(spark, d), "norm_id", "version_id", "simulation_valid_from", "simulation_valid_to", BASELINE)


def asof_resolve(spark, d):
    return tm.as_of(versions_now(spark, d), "norm_id", "version_id", "simulation_valid_from", "simulation_valid_to", [BASELINE, "2025-01-01", AS_OF])


def asof_latest_start(spark, d):
    return tm.latest_start_or_earliest(versions_now(spark, d), "norm_id", "version_id", "simulation_valid_from", "2025-01-01")


def _classified(spark, d):
    kind = tm.kind_of(F.col("status"), F.col("simulation_valid_from"), F.col("simulation_valid_to"), F.lit(AS_OF).cast("date"))
    return _with_norms(spark, d).withColumn("kind", kind)


def temporal_classify(spark, d):
    return _classified(spark, d).select("norm_id", "version_id", "kind")


def applicable_version(spark, d):
    return tm.applicable(_classified(spark, d), "norm_id", "version_id", "simulation_valid_from", "kind")


def change_classify(spark, d):
    return tm.change_kinds(_with_norms(spark, d), "norm_id", "simulation_valid_from", "status", "expiry_date", BASELINE)


def baseline_align(spark, d):
    v = versions_now(spark, d).where("source_valid_from IS NOT NULL")
    return tm.align_to(v, "source_valid_from", "source_valid_to", BASELINE).select("norm_id", "version_id", "source_valid_from", "source_valid_to")


def last_change_activity(spark, d):
    """Latest legal change (order placed) and latest activity (anything shipped too) up to a day."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    ship = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max(F.when(F.col("l_shipdate") <= "2000-01-01", F.col("l_shipdate").cast("date"))).alias("ship"))
    day = F.when(F.col("day") <= "2000-01-01", F.col("day"))
    return o.join(ship, F.col("o_orderkey") == F.col("l_orderkey"), "left").groupBy("o_custkey").agg(F.max(day).alias("last_change"), F.greatest(F.max(day), F.max("ship")).alias("last_activity"))


def history_entries(spark, d):
    """Order events per customer, undated last, in one total order."""
    w = Window.partitionBy("o_custkey").orderBy(F.coalesce(F.col("day"), F.lit("9999-12-31").cast("date")), "o_orderkey")
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date")).alias("day"))
    return o.withColumn("entry_index", F.row_number().over(w))


def gaps_and_islands(spark, d):
    """Runs of equal event types per user."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, d, "events").select("user_id", "event_id", "ts", "event_type")
    e = e.withColumn("fresh", F.when(F.col("event_type") == F.lag("event_type").over(w), 0).otherwise(1)).withColumn("run", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return e.groupBy("user_id", "run", "event_type").agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def prev_next_navigation(spark, d):
    w = Window.partitionBy("norm_id").orderBy("simulation_valid_from", "version_id")
    v = versions_now(spark, d).where("simulation_valid_from IS NOT NULL")
    return v.select("norm_id", "version_id", F.lag("version_id").over(w).alias("previous"), F.lead("version_id").over(w).alias("next"))


def end_effective_day(spark, d):
    """Day after termination, else effective day, else document day."""
    n = norms_now(spark, d, "expiry_date", "effective_date", "document_date")
    return n.select("id", F.coalesce(F.date_add("expiry_date", 1), "effective_date", "document_date").alias("end_effective"), (F.col("expiry_date") > AS_OF).alias("future_termination"))


def relative_commencement(spark, d):
    """Day after publication, and first day of the month after it."""
    n = norms_now(spark, d, "publication_date")
    return n.select("id", F.date_add("publication_date", 1).alias("day_after"), F.add_months(F.trunc("publication_date", "month"), 1).alias("next_month"))


def version_runs(spark, d):
    """Versions of a norm without a break between them form one run."""
    f = versions_now(spark, d).where("simulation_valid_from IS NOT NULL")
    w = Window.partitionBy("norm_id").orderBy("simulation_valid_from", "version_id")
    f = f.withColumn("fresh", F.when(F.col("simulation_valid_from") == F.date_add(F.lag("simulation_valid_to").over(w), 1), 0).otherwise(1))
    f = f.withColumn("run", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return f.groupBy("norm_id", "run").agg(F.count("*").alias("n_versions"), F.min("simulation_valid_from").alias("run_from"), F.max(F.struct("simulation_valid_from", "version_id")).alias("x")).select("norm_id", "run", "n_versions", "run_from", F.col("x.version_id").alias("last_version"))


_NOW = """WITH lv AS (SELECT * FROM law_versions QUALIFY row_number() OVER (PARTITION BY norm_id, version_id ORDER BY updated_at DESC) = 1),
ln AS (SELECT * FROM law_norms QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) = 1),
vn AS (SELECT lv.norm_id, lv.version_id, simulation_valid_from AS s, simulation_valid_to AS e, status, expiry_date FROM lv JOIN ln ON ln.id = lv.norm_id WHERE simulation_valid_from IS NOT NULL),
cl AS (SELECT *, CASE WHEN status = 'pending-effective' THEN 'unknown-effective' WHEN s > DATE '2026-09-01' THEN 'future' WHEN status IN ('repealed', 'historical') THEN 'historical' WHEN e < DATE '2026-09-01' THEN 'historical' ELSE 'current' END AS kind FROM vn)
"""

QUERIES = {f.__name__: f for f in (interval_derive, interval_neighbour_findings, interval_selection, asof_resolve, asof_latest_start, temporal_classify, applicable_version, change_classify, baseline_align, last_change_activity, history_entries, gaps_and_islands, prev_next_navigation, end_effective_day, relative_commencement, version_runs)}

SQL = {
    "interval_derive": "SELECT o_custkey, valid_from, CAST(lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from) - INTERVAL 1 DAY AS DATE) AS valid_to FROM (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS valid_from FROM orders)",
    "interval_neighbour_findings": _NOW + """, p AS (SELECT norm_id, version_id, simulation_valid_from AS this_start, simulation_valid_to AS this_end, lead(simulation_valid_from) OVER (PARTITION BY norm_id ORDER BY simulation_valid_from, version_id) AS next_start FROM lv WHERE simulation_valid_from IS NOT NULL)
SELECT *, CASE WHEN this_start = next_start THEN 'same-start' WHEN this_end < this_start THEN 'contradictory' WHEN this_end IS NULL OR this_end >= next_start THEN 'overlap' WHEN this_end + 1 <> next_start THEN 'gap' ELSE 'contiguous' END AS finding FROM p WHERE next_start IS NOT NULL""",
    "interval_selection": _NOW + """, r AS (SELECT norm_id, version_id AS v, simulation_valid_from AS s, simulation_valid_to AS e, count(*) OVER (PARTITION BY norm_id, simulation_valid_from) > 1 AS same,
lag(simulation_valid_from) OVER w AS ps, lag(simulation_valid_to) OVER w AS pe, lead(simulation_valid_from) OVER w AS ns, lead(simulation_valid_to) OVER w AS ne FROM lv WINDOW w AS (PARTITION BY norm_id ORDER BY simulation_valid_from NULLS FIRST, version_id)),
b AS (SELECT *, coalesce(e < s, false) AS bad, (NOT coalesce(e < s, false)) AND s <= DATE '2023-12-01' AND (e IS NULL OR e >= DATE '2023-12-01') AS hit,
CASE WHEN same THEN 'ambiguous'
WHEN ps IS NOT NULL AND ps <> s AND pe < ps THEN 'inconsistent-interval' WHEN ps IS NOT NULL AND ps <> s AND (pe IS NULL OR pe >= s) THEN 'overlap' WHEN ps IS NOT NULL AND ps <> s AND pe + 1 <> s THEN 'gap'
WHEN ns IS NOT NULL AND ns <> s AND ne < ns THEN 'inconsistent-interval' WHEN ns IS NOT NULL AND ns <> s AND (e IS NULL OR e >= ns) THEN 'overlap' WHEN ns IS NOT NULL AND ns <> s AND e + 1 <> ns THEN 'gap' ELSE 'selected' END AS blk FROM r),
g AS (SELECT norm_id, bool_or(s IS NULL) AS undated, count(*) FILTER (hit) AS n, count(DISTINCT s) FILTER (hit) AS ds, max(blk) FILTER (hit) AS blk, max(v) FILTER (hit) AS v, arg_max(bad, (s, v)) FILTER (s <= DATE '2023-12-01') AS lastbad, count(*) FILTER (s <= DATE '2023-12-01') AS nl, count(*) FILTER (s > DATE '2023-12-01') AS nn FROM b GROUP BY norm_id),
st AS (SELECT norm_id, v, CASE WHEN undated THEN 'missing-dates' WHEN n > 1 AND ds < n THEN 'ambiguous' WHEN n > 1 THEN 'overlap' WHEN n = 0 AND nl > 0 AND lastbad THEN 'inconsistent-interval' WHEN n = 0 AND nl > 0 AND nn > 0 THEN 'gap' WHEN n = 0 THEN 'no-version-at-baseline' ELSE blk END AS status FROM g)
SELECT norm_id, status, CASE WHEN status = 'selected' THEN v END AS version FROM st""",
    "asof_resolve": _NOW + ", x AS (SELECT * FROM lv, (VALUES (DATE '2023-12-01'), (DATE '2025-01-01'), (DATE '2026-09-01')) t(day)) SELECT norm_id, day, arg_max(version_id, (simulation_valid_from, version_id)) FILTER (simulation_valid_from <= day AND (simulation_valid_to IS NULL OR simulation_valid_to >= day)) AS version FROM x GROUP BY ALL",
    "asof_latest_start": _NOW + "SELECT norm_id, coalesce(arg_max(version_id, (simulation_valid_from, version_id)) FILTER (simulation_valid_from <= DATE '2025-01-01'), arg_max(version_id, (-date_diff('day', DATE '2025-01-01', simulation_valid_from), version_id))) AS version FROM lv WHERE simulation_valid_from IS NOT NULL GROUP BY norm_id",
    "temporal_classify": _NOW + "SELECT norm_id, version_id, kind FROM cl",
    "applicable_version": _NOW + "SELECT norm_id, version_id AS version, kind FROM cl QUALIFY row_number() OVER (PARTITION BY norm_id ORDER BY CASE kind WHEN 'current' THEN 0 WHEN 'future' THEN 1 WHEN 'unknown-effective' THEN 2 ELSE 3 END, CASE WHEN kind = 'historical' THEN -date_diff('day', DATE '1970-01-01', s) ELSE date_diff('day', DATE '1970-01-01', s) END, version_id) = 1",
    "change_classify": _NOW + """, g AS (SELECT norm_id, min(s) AS lo, max(s) AS hi, count(*) FILTER (s = DATE '2023-12-01') AS n_base, count(*) FILTER (s > DATE '2023-12-01') AS n_later, min(s) FILTER (s > DATE '2023-12-01') AS fl, max(status) AS st, max(expiry_date) AS ex FROM vn GROUP BY norm_id),
h AS (SELECT *, coalesce(st = 'repealed' AND ex >= DATE '2023-12-01' AND n_base > 0, false) AS rep, CASE WHEN lo < DATE '2023-12-01' THEN 'before-baseline' WHEN n_base > 1 THEN 'two-at-baseline' END AS problem FROM g)
SELECT norm_id, CASE WHEN problem IS NOT NULL THEN NULL WHEN n_base = 0 THEN 'simulation-new' WHEN n_later > 0 OR rep THEN 'baseline-changed' ELSE 'baseline-unchanged' END AS change_kind,
CASE WHEN problem IS NOT NULL THEN NULL WHEN n_base = 0 THEN lo WHEN n_later > 0 OR rep THEN least(fl, CASE WHEN rep THEN ex END) END AS first_change,
CASE WHEN problem IS NOT NULL THEN NULL WHEN n_base = 0 THEN hi WHEN n_later > 0 OR rep THEN greatest(CASE WHEN n_later > 0 THEN hi END, CASE WHEN rep THEN ex END) END AS last_change, n_later, problem FROM h""",
    "baseline_align": _NOW + "SELECT norm_id, version_id, greatest(source_valid_from, DATE '2023-12-01') AS source_valid_from, source_valid_to FROM lv WHERE source_valid_from IS NOT NULL AND (source_valid_to IS NULL OR source_valid_to >= DATE '2023-12-01')",
    "last_change_activity": "SELECT o_custkey, max(CASE WHEN o_orderdate <= TIMESTAMP '2000-01-01' THEN CAST(o_orderdate AS DATE) END) AS last_change, max(greatest(CASE WHEN o_orderdate <= TIMESTAMP '2000-01-01' THEN CAST(o_orderdate AS DATE) END, CASE WHEN l_shipdate <= TIMESTAMP '2000-01-01' THEN CAST(l_shipdate AS DATE) END)) AS last_activity FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey",
    "history_entries": "SELECT o_custkey, o_orderkey, day, row_number() OVER (PARTITION BY o_custkey ORDER BY coalesce(day, DATE '9999-12-31'), o_orderkey) AS entry_index FROM (SELECT o_custkey, o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS day FROM orders)",
    "gaps_and_islands": "SELECT user_id, run, event_type, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, CASE WHEN event_type = lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY ALL",
    "prev_next_navigation": _NOW + "SELECT norm_id, version_id, lag(version_id) OVER w AS previous, lead(version_id) OVER w AS next FROM lv WHERE simulation_valid_from IS NOT NULL WINDOW w AS (PARTITION BY norm_id ORDER BY simulation_valid_from, version_id)",
    "end_effective_day": _NOW + "SELECT id, coalesce(expiry_date + 1, effective_date, document_date) AS end_effective, expiry_date > DATE '2026-09-01' AS future_termination FROM ln",
    "relative_commencement": _NOW + "SELECT id, publication_date + 1 AS day_after, CAST(date_trunc('month', publication_date) + INTERVAL 1 MONTH AS DATE) AS next_month FROM ln",
    "version_runs": _NOW + ", f AS (SELECT *, CASE WHEN simulation_valid_from = lag(simulation_valid_to) OVER (PARTITION BY norm_id ORDER BY simulation_valid_from, version_id) + 1 THEN 0 ELSE 1 END AS fresh FROM lv WHERE simulation_valid_from IS NOT NULL), r AS (SELECT *, sum(fresh) OVER (PARTITION BY norm_id ORDER BY simulation_valid_from, version_id ROWS UNBOUNDED PRECEDING) AS run FROM f) SELECT norm_id, run, count(*) AS n_versions, min(simulation_valid_from) AS run_from, arg_max(version_id, (simulation_valid_from, version_id)) AS last_version FROM r GROUP BY ALL",
}
