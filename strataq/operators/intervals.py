"""Merging, gaps and overlaps of closed day intervals per key.

Intervals become event-time sessions: a row opens a session at its first day
whose length is the row's own duration, and Spark's session windows merge the
overlapping ones. Before any exchange the intervals are reduced to one row per
(key, first day) or per (key, day), so what one task may hold of a hot key is
bounded by the number of days, not by its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: End of an interval that is still open.
OPEN_END = "9999-12-31"


def closed_intervals(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """keys, start_day, end_day (date) of the rows that cover at least one day: null start is left out, null end is open, end before start covers nothing."""
    return (
        df.select(*keys, F.col(start).cast("date").alias("start_day"), F.coalesce(F.col(end).cast("date"), F.lit(OPEN_END).cast("date")).alias("end_day"))
        .where(F.col("start_day").isNotNull() & (F.col("end_day") >= F.col("start_day")))
    )


def merge_intervals(iv: DataFrame, keys: list[str]) -> DataFrame:
    """Continuous periods of keys, start_day, end_day; touching ones (next day) are one period. Null keys form a key of their own."""
    one = iv.groupBy(*keys, "start_day").agg(F.max("end_day").alias("end_day"))
    length = F.concat((F.datediff("end_day", "start_day") + 1).cast("string"), F.lit(" days"))
    sessions = (
        one.select(*keys, F.col("start_day").cast("timestamp_ntz").alias("_at"), length.alias("_len"))
        .groupBy(*keys, F.session_window("_at", F.col("_len")).alias("_s"))
        .agg(F.count("*").alias("_n"))
        .select(*keys, F.col("_s.start").cast("date").alias("start_day"), F.date_sub(F.col("_s.end").cast("date"), 1).alias("end_day"))
    )
    w = Window.partitionBy(*keys).orderBy("start_day")
    fresh = F.when(F.col("start_day") <= F.date_add(F.lag("end_day").over(w), 1), 0).otherwise(1)
    return (
        sessions.withColumn("_f", fresh)
        .withColumn("_g", F.sum("_f").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "_g")
        .agg(F.min("start_day").alias("start_day"), F.max("end_day").alias("end_day"))
        .drop("_g")
    )


def gaps(periods: DataFrame, keys: list[str]) -> DataFrame:
    """Uncovered days between the periods of ``merge_intervals``."""
    w = Window.partitionBy(*keys).orderBy("start_day")
    nxt = F.lead("start_day").over(w)
    return (
        periods.select(*keys, F.date_add("end_day", 1).alias("start_day"), F.date_sub(nxt, 1).alias("_to"))
        .where(F.col("_to").isNotNull())
        .withColumnRenamed("_to", "end_day")
    )


def overlaps(iv: DataFrame, keys: list[str], depth: int = 2) -> DataFrame:
    """Longest runs of days that at least ``depth`` intervals cover: the day balance is summed before the exchange, then the covered segments are merged."""
    steps = (
        iv.select(*keys, F.col("start_day").alias("day"), F.lit(1).alias("d"))
        .unionByName(iv.select(*keys, F.date_add("end_day", 1).alias("day"), F.lit(-1).alias("d")))
        .groupBy(*keys, "day")
        .agg(F.sum("d").alias("d"))
    )
    w = Window.partitionBy(*keys).orderBy("day")
    deep = (
        steps.withColumn("_depth", F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("end_day", F.date_sub(F.lead("day").over(w), 1))
        .where(F.col("_depth") >= depth)
        .select(*keys, F.col("day").alias("start_day"), "end_day")
    )
    return merge_intervals(deep, keys)


def interval_findings(iv: DataFrame, keys: list[str]) -> DataFrame:
    """keys, finding (``gap`` or ``overlap``), start_day, end_day."""
    found = gaps(merge_intervals(iv, keys), keys).withColumn("finding", F.lit("gap"))
    return found.unionByName(overlaps(iv, keys).withColumn("finding", F.lit("overlap")))
