"""Runs that can be taken up again: a log of what was done to which state of a record, and only what is pending is worked on.

Each run writes one generation of results below the root, in one piece; a run
that broke off has written none and is simply run again. What failed stays in
the log with its error and is left alone until it is asked for.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataq.operators.quality import row_fingerprint

LOG = "run long, key string, state string, status string, note string"


class SystemicStop(RuntimeError):
    """So large a part of a run failed that it counts for nothing."""


def read_log(spark: SparkSession, root: str) -> DataFrame:
    """The latest entry of each key: run, key, state (fingerprint of the record worked on), status, note."""
    try:
        log = spark.read.schema(LOG).parquet(f"{root}/log")
        log.isEmpty()
    except Exception as x:
        if "PATH_NOT_FOUND" not in str(x):
            raise
        return spark.createDataFrame([], LOG)
    w = Window.partitionBy("key").orderBy(F.desc("run"))
    return log.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def pending(items: DataFrame, key: str, root: str, retry_failed: bool = False) -> DataFrame:
    """The items, with ``state``, that the log does not know in that state, or knows as failed if asked for. Null keys are no items."""
    columns = sorted(c for c in items.columns if c != key)
    rows = items.where(F.col(key).isNotNull()).withColumn("state", row_fingerprint(*columns) if columns else F.lit(""))
    done = read_log(items.sparkSession, root)
    if retry_failed:
        done = done.where("status != 'failed'")
    done = done.select(F.col("key").alias("_k"), F.col("state").alias("_s"))
    return rows.join(done, (F.col(key).cast("string") == F.col("_k")) & (F.col("state") == F.col("_s")), "left_anti")


def run_pending(items: DataFrame, key: str, process: Callable[[DataFrame], DataFrame], root: str, retry_failed: bool = False, most_failed: float = 0.5) -> dict[str, int]:
    """Works on what is pending and logs it; gives the number of entries by status.

    ``process`` turns items into rows with the key, ``status`` ("done", "failed"
    or another word) and ``note``; other columns are results and lie below
    root/results. If more than ``most_failed`` of a run fails, SystemicStop is
    raised and nothing is logged.
    """
    spark = items.sparkSession
    run = (read_log(spark, root).agg(F.max("run")).first()[0] or 0) + 1
    todo = pending(items, key, root, retry_failed)
    out = f"{root}/results/run={run}"
    process(todo.drop("state")).join(todo.select(key, "state"), key).write.mode("overwrite").parquet(out)
    done = spark.read.parquet(out)
    counts = {r["status"]: r["count"] for r in done.groupBy("status").count().collect()}
    if counts.get("failed", 0) > most_failed * sum(counts.values()):
        raise SystemicStop(f"{counts['failed']} of {sum(counts.values())} failed")
    if counts:
        done.select(F.lit(run).cast("long").alias("run"), F.col(key).cast("string").alias("key"), "state", "status", "note").write.mode("append").parquet(f"{root}/log")
    return counts
