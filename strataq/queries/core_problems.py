"""Queries of the general data problems: unresolved references (p1) and version intervals (p5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataq.operators import intervals, references
from strataq.session import table


def _reference_inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    norms, versions = table(spark, d, "law_norms"), table(spark, d, "law_versions")
    sources, reports, log = table(spark, d, "law_source_objects"), table(spark, d, "feedback_reports"), table(spark, d, "projection_removals")
    version_key = F.concat_ws("|", "norm_id", "version_id")
    parents = norms.select(F.lit("law_norms").alias("parent_table"), F.col("id").alias("parent_key"), F.col("updated_at").alias("first_seen")).unionByName(
        versions.where(F.col("norm_id").isNotNull() & F.col("version_id").isNotNull()).select(F.lit("law_versions").alias("parent_table"), version_key.alias("parent_key"), F.col("updated_at").alias("first_seen"))
    )
    removals = log.where(F.col("norm_id").isNotNull()).select(
        F.when(F.coalesce("version_id", F.lit("")) == "", "law_norms").otherwise("law_versions").alias("parent_table"),
        F.when(F.coalesce("version_id", F.lit("")) == "", F.col("norm_id")).otherwise(version_key).alias("parent_key"),
    )
    none = F.lit(None).cast("string")

    def child(df, ref_table, ref_field, ref_key, parent_table, parent_key, seen, guard=None):
        return df.select(
            F.lit(ref_table).alias("ref_table"), F.lit(ref_field).alias("ref_field"), ref_key.alias("ref_key"), F.lit(parent_table).alias("parent_table"), parent_key.alias("parent_key"),
            F.col(seen).alias("first_seen"), (F.lit("law_norms") if guard is not None else none).alias("guard_table"), (guard if guard is not None else none).alias("guard_key"),
        )

    # a null part of a referrer's own key stays visible as an empty one
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    norm_of_report = F.concat_ws(":", "jurisdiction", F.lower(F.trim("norm_slug")))
    named = reports.where(F.trim("norm_slug") != "")
    children = (
        child(versions, "law_versions", "norm_id", F.concat_ws("|", part("norm_id"), part("version_id")), "law_norms", F.col("norm_id"), "updated_at")
        .unionByName(child(sources.where((F.col("version_id") != "") & F.col("norm_id").isNotNull()), "law_source_objects", "version_id", F.concat_ws("|", part("norm_id"), part("version_id"), part("source_index")), "law_versions", version_key, "updated_at"))
        .unionByName(child(named, "feedback_reports", "norm_slug", F.col("id"), "law_norms", norm_of_report, "created_at"))
        .unionByName(child(named.where(F.col("version_id").isNotNull()), "feedback_reports", "version_id", F.col("id"), "law_versions", F.concat_ws("|", norm_of_report, F.col("version_id")), "created_at", norm_of_report))
    )
    return parents, children, removals


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return references.orphan_references(*_reference_inputs(spark, d))


def p1_by_period(spark: SparkSession, d: str) -> DataFrame:
    return references.orphan_counts(p1_found(spark, d))


def latest_intervals(versions: DataFrame) -> DataFrame:
    """norm_id, axis, start_day, end_day of the latest row of each version; of rows equally late the one with the latest days holds."""
    days = ["simulation_valid_from", "simulation_valid_to", "source_valid_from", "source_valid_to"]
    last = versions.groupBy("norm_id", "version_id").agg(F.max(F.struct("updated_at", *days)).alias("v"))
    axis = F.explode(
        F.array(
            F.struct(F.lit("simulation").alias("axis"), F.col("v.simulation_valid_from").alias("f"), F.col("v.simulation_valid_to").alias("t")),
            F.struct(F.lit("source").alias("axis"), F.col("v.source_valid_from").alias("f"), F.col("v.source_valid_to").alias("t")),
        )
    )
    return intervals.closed_intervals(last.select("norm_id", axis.alias("x")).select("norm_id", "x.axis", "x.f", "x.t"), ["norm_id", "axis"], "f", "t")


def _days_as_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in ("start_day", "end_day")})


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    iv = latest_intervals(table(spark, d, "law_versions"))
    return _days_as_text(intervals.interval_findings(iv, ["norm_id", "axis"])).select("norm_id", "axis", "finding", "start_day", "end_day")


def p5_periods(spark: SparkSession, d: str) -> DataFrame:
    iv = latest_intervals(table(spark, d, "law_versions"))
    return _days_as_text(intervals.merge_intervals(iv, ["norm_id", "axis"])).select("norm_id", "axis", "start_day", "end_day")


_REFS = """
WITH n AS (SELECT id, min(updated_at) AS f FROM law_norms WHERE id IS NOT NULL GROUP BY id),
v AS (SELECT norm_id, version_id, min(updated_at) AS f FROM law_versions GROUP BY ALL),
lv AS (SELECT norm_id, version_id, min(updated_at) AS f FROM law_versions GROUP BY ALL),
so AS (SELECT norm_id, version_id, source_index, min(updated_at) AS f FROM law_source_objects WHERE version_id <> '' GROUP BY ALL),
fb AS (SELECT id, jurisdiction || ':' || lower(trim(norm_slug)) AS norm_id, version_id, min(created_at) AS f FROM feedback_reports WHERE trim(norm_slug) <> '' GROUP BY ALL),
r AS (SELECT DISTINCT norm_id, version_id FROM projection_removals),
found AS (
SELECT 'law_versions' AS ref_table, 'norm_id' AS ref_field, lv.norm_id || '|' || lv.version_id AS ref_key, n.f AS pf, n.id IS NOT NULL AS there, r.norm_id IS NOT NULL AS gone, lv.f
FROM lv LEFT JOIN n ON n.id = lv.norm_id LEFT JOIN r ON r.norm_id = lv.norm_id AND r.version_id = ''
UNION ALL
SELECT 'law_source_objects', 'version_id', so.norm_id || '|' || so.version_id || '|' || so.source_index, v.f, v.norm_id IS NOT NULL, r.norm_id IS NOT NULL, so.f
FROM so LEFT JOIN v ON v.norm_id = so.norm_id AND v.version_id = so.version_id LEFT JOIN r ON r.norm_id = so.norm_id AND r.version_id = so.version_id
UNION ALL
SELECT 'feedback_reports', 'norm_slug', fb.id, n.f, n.id IS NOT NULL, r.norm_id IS NOT NULL, fb.f
FROM fb LEFT JOIN n ON n.id = fb.norm_id LEFT JOIN r ON r.norm_id = fb.norm_id AND r.version_id = ''
UNION ALL
SELECT 'feedback_reports', 'version_id', fb.id, v.f, v.norm_id IS NOT NULL, r.norm_id IS NOT NULL, fb.f
FROM fb JOIN n ON n.id = fb.norm_id LEFT JOIN v ON v.norm_id = fb.norm_id AND v.version_id = fb.version_id LEFT JOIN r ON r.norm_id = fb.norm_id AND r.version_id = fb.version_id
WHERE fb.version_id IS NOT NULL),
res AS (SELECT ref_table, ref_field, ref_key, CASE WHEN there THEN 'late' WHEN gone THEN 'deleted' ELSE 'missing' END AS reason, strftime(f, '%Y-%m') AS period
FROM found WHERE NOT there OR pf > f)
"""

_AXES = """
WITH last AS (SELECT *, row_number() OVER (PARTITION BY norm_id, version_id ORDER BY updated_at DESC, simulation_valid_from DESC) AS rn FROM law_versions),
iv AS (SELECT norm_id, 'simulation' AS axis, simulation_valid_from AS s, coalesce(simulation_valid_to, DATE '9999-12-31') AS e FROM last WHERE rn = 1 AND simulation_valid_from IS NOT NULL
UNION ALL SELECT norm_id, 'source', source_valid_from, coalesce(source_valid_to, DATE '9999-12-31') FROM last WHERE rn = 1 AND source_valid_from IS NOT NULL),
ev AS (SELECT norm_id, axis, s AS d, 1 AS k FROM iv WHERE e >= s UNION ALL SELECT norm_id, axis, e + 1, -1 FROM iv WHERE e >= s),
st AS (SELECT norm_id, axis, CAST(d AS DATE) AS d, sum(k) AS k FROM ev GROUP BY ALL),
seg AS (SELECT norm_id, axis, d, sum(k) OVER w AS depth, lead(d) OVER (PARTITION BY norm_id, axis ORDER BY d) AS nd FROM st WINDOW w AS (PARTITION BY norm_id, axis ORDER BY d ROWS UNBOUNDED PRECEDING))
"""


def _runs(condition: str, finding: str) -> str:
    """Runs of neighbouring segments that meet the condition."""
    return f"""SELECT norm_id, axis, '{finding}' AS finding, CAST(min(d) AS VARCHAR) AS start_day, CAST(CAST(max(nd) - INTERVAL 1 DAY AS DATE) AS VARCHAR) AS end_day FROM (
SELECT *, sum(fresh) OVER (PARTITION BY norm_id, axis ORDER BY d ROWS UNBOUNDED PRECEDING) AS g FROM (
SELECT *, CASE WHEN lag(nd) OVER (PARTITION BY norm_id, axis ORDER BY d) = d THEN 0 ELSE 1 END AS fresh FROM seg WHERE nd IS NOT NULL AND {condition})) GROUP BY norm_id, axis, g"""


QUERIES = {"p1_found": p1_found, "p1_by_period": p1_by_period, "p5_found": p5_found, "p5_periods": p5_periods}

SQL = {
    "p1_found": _REFS + "SELECT * FROM res",
    "p1_by_period": _REFS + "SELECT ref_table, ref_field, reason, period, count(*) AS n FROM res GROUP BY ALL",
    "p5_found": _AXES + _runs("depth = 0", "gap") + " UNION ALL " + _runs("depth >= 2", "overlap"),
    "p5_periods": _AXES + "SELECT norm_id, axis, start_day, end_day FROM (" + _runs("depth > 0", "x") + ")",
}
