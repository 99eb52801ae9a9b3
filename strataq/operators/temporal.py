"""Version intervals, states as of a day, and change kinds.

Intervals are closed on both ends and an open end is null. Every operator is a
window or one aggregation over the entity key; equal starts are broken by the
version id, so results do not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def contains(day: Column, start: Column, end: Column) -> Column:
    """The closed interval holds the day; a null end is open."""
    return (start <= day) & (end.isNull() | (end >= day))


def derive_ends(df: DataFrame, key: str, start: str, last_end: Column | None = None) -> DataFrame:
    """Adds valid_to: the day before the next start of the key; for the last one ``last_end`` or null. Starts must be distinct within a key."""
    w = Window.partitionBy(key).orderBy(start)
    end = F.date_sub(F.lead(start).over(w), 1)
    return df.withColumn("valid_to", end if last_end is None else F.coalesce(end, last_end))


def neighbour_findings(df: DataFrame, key: str, ident: str, start: str, end: str) -> DataFrame:
    """key, this_start, this_end, next_start, finding of successive versions by start: same-start, overlap, gap or contiguous; contradictory where the end precedes the start. Null starts are left out."""
    w = Window.partitionBy(key).orderBy(start, ident)
    nxt = F.lead(start).over(w)
    s, e, n = F.col("this_start"), F.col("this_end"), F.col("next_start")
    finding = (
        F.when(s == n, "same-start").when(e < s, "contradictory").when(e.isNull() | (e >= n), "overlap").when(e != F.date_sub(n, 1), "gap").otherwise("contiguous")
    )
    rows = df.where(F.col(start).isNotNull()).select(F.col(key), F.col(ident), F.col(start).alias("this_start"), F.col(end).alias("this_end"), nxt.alias("next_start"))
    return rows.where("next_start IS NOT NULL").withColumn("finding", finding)


def as_of(versions: DataFrame, key: str, ident: str, start: str, end: str, days: list[str]) -> DataFrame:
    """key, day, version: per requested day the version whose interval holds it (latest start first), null if none does. One aggregation, no join."""
    exploded = versions.select(key, ident, start, end, F.explode(F.array(*[F.lit(d).cast("date") for d in days])).alias("day"))
    hit = contains(F.col("day"), F.col(start), F.col(end))
    return exploded.groupBy(key, "day").agg(F.max(F.when(hit, F.struct(F.col(start), F.col(ident)))).alias("v")).select(key, "day", F.col(f"v.{ident}").alias("version"))


def latest_start_or_earliest(versions: DataFrame, key: str, ident: str, start: str, day: str) -> DataFrame:
    """key, version: latest start up to the day, else the earliest start of all."""
    d = F.lit(day).cast("date")
    rank = F.struct((F.col(start) <= d).alias("a"), F.when(F.col(start) <= d, F.datediff(F.col(start), d)).otherwise(F.datediff(d, F.col(start))).alias("b"), F.col(ident).alias("c"))
    return versions.where(F.col(start).isNotNull()).groupBy(key).agg(F.max(rank).alias("v")).select(key, F.col("v.c").alias("version"))


def kind_of(status: Column, start: Column, end: Column, day: Column) -> Column:
    """unknown-effective, future, historical or current, in this order of precedence."""
    return (
        F.when(status == "pending-effective", "unknown-effective")
        .when(start > day, "future")
        .when(status.isin("repealed", "historical"), "historical")
        .when(end < day, "historical")
        .otherwise("current")
    )


def applicable(classified: DataFrame, key: str, ident: str, start: str, kind: str) -> DataFrame:
    """key, version, kind: the current version; else the earliest future one; else one of unknown effect; else the latest start."""
    day = F.unix_date(start)
    order = (
        F.when(F.col(kind) == "current", F.struct(F.lit(0).alias("p"), day.alias("d"), F.col(ident).alias("v"), F.col(kind).alias("k")))
        .when(F.col(kind) == "future", F.struct(F.lit(1).alias("p"), day.alias("d"), F.col(ident).alias("v"), F.col(kind).alias("k")))
        .when(F.col(kind) == "unknown-effective", F.struct(F.lit(2).alias("p"), day.alias("d"), F.col(ident).alias("v"), F.col(kind).alias("k")))
        .otherwise(F.struct(F.lit(3).alias("p"), (-day).alias("d"), F.col(ident).alias("v"), F.col(kind).alias("k")))
    )
    return classified.groupBy(key).agg(F.min(order).alias("x")).select(key, F.col("x.v").alias("version"), F.col("x.k").alias("kind"))


def change_kinds(versions: DataFrame, key: str, start: str, status: str, expiry: str, baseline: str) -> DataFrame:
    """key, change_kind, first_change, last_change, n_later, problem: unchanged, changed or new against the baseline day.

    A version before the baseline, or two on it, is a ``problem`` (kind null).
    Repealed with an expiry on or after the baseline counts as a change at the
    expiry where there is no other repeal.
    """
    b = F.lit(baseline).cast("date")
    g = versions.groupBy(key).agg(
        F.min(start).alias("lo"), F.max(start).alias("hi"), F.count_if(F.col(start) == b).alias("n_base"), F.count_if(F.col(start) > b).alias("n_later"),
        F.min(F.when(F.col(start) > b, F.col(start))).alias("first_later"), F.max(status).alias("st"), F.max(expiry).alias("ex"),
    )
    repealed = F.coalesce((F.col("st") == "repealed") & (F.col("ex") >= b) & (F.col("n_base") > 0), F.lit(False))
    problem = F.when(F.col("lo") < b, "before-baseline").when(F.col("n_base") > 1, "two-at-baseline")
    new, changed = F.col("n_base") == 0, (F.col("n_later") > 0) | repealed
    out = g.withColumn("repealed", repealed).withColumn("problem", problem)
    end = F.when(F.col("repealed"), F.col("ex"))
    return out.select(
        key,
        F.when(problem.isNotNull(), F.lit(None)).when(new, "simulation-new").when(changed, "baseline-changed").otherwise("baseline-unchanged").alias("change_kind"),
        F.when(problem.isNull(), F.when(new, F.col("lo")).when(changed, F.least(F.col("first_later"), end))).alias("first_change"),
        F.when(problem.isNull(), F.when(new, F.col("hi")).when(changed, F.greatest(F.when(F.col("n_later") > 0, F.col("hi")), end))).alias("last_change"),
        "n_later",
        "problem",
    )


def align_to(versions: DataFrame, start: str, end: str, baseline: str) -> DataFrame:
    """Foreign versions cut to the baseline: those that ended before it go, the one that holds it starts on it."""
    b = F.lit(baseline).cast("date")
    return versions.where(F.col(end).isNull() | (F.col(end) >= b)).withColumn(start, F.greatest(F.col(start), b))


def select_at(candidates: DataFrame, key: str, ident: str, start: str, end: str, day: str) -> DataFrame:
    """key, status, version: the one version that holds the day, or why there is none.

    missing-dates if a start is null; ambiguous or overlap if several hold it;
    inconsistent-interval, gap or no-version-at-baseline if none does. A single
    hit is still blocked by its neighbours: ambiguous (same start),
    inconsistent-interval, overlap or gap, the predecessor's finding first.
    """
    d = F.lit(day).cast("date")
    s, e = F.col("s"), F.col("e")
    rows = candidates.select(key, F.col(ident).alias("v"), F.col(start).alias("s"), F.col(end).alias("e"))
    wk = Window.partitionBy(key).orderBy("s", "v")
    ws = Window.partitionBy(key, "s")
    rows = (
        rows.withColumn("undated", F.max(s.isNull().cast("int")).over(Window.partitionBy(key)) == 1)
        .withColumn("same", F.count("*").over(ws) > 1)
        .withColumn("ps", F.lag("s").over(wk)).withColumn("pe", F.lag("e").over(wk)).withColumn("ns", F.lead("s").over(wk)).withColumn("ne", F.lead("e").over(wk))
    )
    bad = lambda a, b: F.coalesce(b < a, F.lit(False))
    hit = ~bad(s, e) & contains(d, s, e)
    before = F.when(F.col("ps").isNotNull() & (F.col("ps") != s), F.when(bad(F.col("ps"), F.col("pe")), "inconsistent-interval").when(F.col("pe").isNull() | (F.col("pe") >= s), "overlap").when(F.col("pe") != F.date_sub(s, 1), "gap"))
    after = F.when(F.col("ns").isNotNull() & (F.col("ns") != s), F.when(bad(F.col("ns"), F.col("ne")), "inconsistent-interval").when(e.isNull() | (e >= F.col("ns")), "overlap").when(e != F.date_sub(F.col("ns"), 1), "gap"))
    block = F.coalesce(F.when(F.col("same"), "ambiguous"), before, after, F.lit("selected"))
    g = rows.groupBy(key).agg(
        F.bool_or("undated").alias("undated"), F.count_if(hit).alias("n"), F.countDistinct(F.when(hit, s)).alias("ds"), F.max(F.when(hit, block)).alias("block"), F.max(F.when(hit, F.col("v"))).alias("version"),
        F.max(F.when(s <= d, F.struct("s", "v", bad(s, e).alias("b")))).alias("last"), F.min(F.when(s > d, s)).alias("nxt"),
    )
    status = (
        F.when(F.col("undated"), "missing-dates")
        .when((F.col("n") > 1) & (F.col("ds") < F.col("n")), "ambiguous")
        .when(F.col("n") > 1, "overlap")
        .when((F.col("n") == 0) & F.col("last.b"), "inconsistent-interval")
        .when((F.col("n") == 0) & F.col("last").isNotNull() & F.col("nxt").isNotNull(), "gap")
        .when(F.col("n") == 0, "no-version-at-baseline")
        .otherwise(F.col("block"))
    )
    return g.withColumn("status", status).select(key, "status", F.when(F.col("status") == "selected", F.col("version")).alias("version"))


def systemic_stop(df: DataFrame, keys: list[str], order: list[str], code: str, in_row: int = 20, same: int = 15, window: int = 25) -> DataFrame:
    """Adds in_row (failures up to here without a success between), same_code (rows of this code among the last ``window``) and stop: a run of ``in_row`` failures, or one code in ``same`` of the last ``window`` rows. ``code`` is null where a row did not fail."""
    w = Window.partitionBy(*keys).orderBy(*order)
    failed = F.col(code).isNotNull()
    last = F.collect_list(code).over(w.rowsBetween(1 - window, 0))
    x = df.withColumns({"_island": F.count_if(~failed).over(w.rowsBetween(Window.unboundedPreceding, 0)), "_last": last})
    run = F.count_if(failed).over(Window.partitionBy(*keys, "_island").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    same_code = F.when(failed, F.size(F.filter("_last", lambda c: c == F.col(code)))).otherwise(0)
    x = x.withColumns({"in_row": run, "same_code": same_code}).drop("_island", "_last")
    return x.withColumn("stop", (F.col("in_row") >= in_row) | (F.col("same_code") >= same))
