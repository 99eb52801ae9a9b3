"""Event streams: windows, late data, deduplication, keyed state and upserts.

The same functions serve batch and stream; a watermark is only set on streams.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataq.session import _shared_dir


def _marked(df: DataFrame, ts: str, late: str) -> DataFrame:
    return df.withWatermark(ts, late) if df.isStreaming else df


def tumbling(df: DataFrame, ts: str, keys: list[str], size: str, late: str = "1 hour") -> DataFrame:
    """keys, window_start, n, total of the column value per tumbling window."""
    g = _marked(df, ts, late).groupBy(F.window(ts, size).alias("w"), *keys).agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return g.select(*keys, F.col("w.start").alias("window_start"), "n", "total")


def sliding(df: DataFrame, ts: str, keys: list[str], size: str, step: str, late: str = "1 hour") -> DataFrame:
    g = _marked(df, ts, late).groupBy(F.window(ts, size, step).alias("w"), *keys).agg(F.count("*").alias("n"))
    return g.select(*keys, F.col("w.start").alias("window_start"), "n")


def sessions(df: DataFrame, ts: str, keys: list[str], gap: str, late: str = "1 hour") -> DataFrame:
    """keys, session_start, session_end (last event), n: a session ends when nothing follows within the gap."""
    g = _marked(df, ts, late).groupBy(F.session_window(ts, gap).alias("w"), *keys).agg(F.count("*").alias("n"), F.max(ts).alias("session_end"))
    return g.select(*keys, F.col("w.start").alias("session_start"), "session_end", "n")


def deduplicate(df: DataFrame, ts: str, keys: list[str], late: str = "1 hour") -> DataFrame:
    """First event of each key; on a stream, repeats within the watermark."""
    if df.isStreaming:
        return df.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)
    w = Window.partitionBy(*keys).orderBy(ts, "event_id")
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def running_totals(df: DataFrame) -> DataFrame:
    """user_id, n, total after each micro-batch, in keyed state that survives restarts; input columns user_id and value."""
    import pandas as pd

    def of(key, batches, state):
        n, total = state.get if state.exists else (0, 0.0)
        for b in batches:
            n, total = n + len(b), total + float(b["value"].sum())
        state.update((n, total))
        yield pd.DataFrame({"user_id": [key[0]], "n": [n], "total": [round(total, 2)]})

    return df.groupBy("user_id").applyInPandasWithState(of, "user_id long, n long, total double", "n long, total double", "update", "NoTimeout")


def run_available(stream: DataFrame, mode: str = "append", sink: Callable[[DataFrame, int], None] | None = None) -> str:
    """Runs a stream over what is there and returns the folder of its parquet output; folder and checkpoint lie in the shared folder."""
    base = os.path.join(_shared_dir(stream.sparkSession), f"stream-{uuid.uuid4().hex}")
    w = stream.writeStream.outputMode(mode).option("checkpointLocation", base + "/state").trigger(availableNow=True)
    out = base + "/out"
    if sink is None and mode == "append":
        q = w.format("parquet").option("path", out).start()
    else:
        q = w.foreachBatch(sink or (lambda df, i: df.write.mode("overwrite").parquet(f"{out}/batch={i}"))).start()
    q.awaitTermination()
    return out


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    rows = spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))  # watermarks need a zoned time


#: Buckets of an upserted table.
BUCKETS, BUCKET = 64, "key_bucket"


def _latest(spark: SparkSession, target: str, before: int | None) -> dict[int, str]:
    """Of each bucket the folder of its latest generation, or of the latest one before."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/generation=*/{BUCKET}=*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    out: dict[int, tuple[int, str]] = {}
    for f in found:
        path = f.getPath().toString()
        generation, bucket = (int(x.split("=")[1]) for x in path.split("/")[-2:])
        if (before is None or generation < before) and generation >= out.get(bucket, (-1, ""))[0]:
            out[bucket] = (generation, path)
    return {b: p for b, (_, p) in out.items()}


def read_upserted(spark: SparkSession, target: str, schema) -> DataFrame:
    """The rows of an upserted table, each bucket from its latest generation."""
    paths = list(_latest(spark, target, None).values())
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def upsert_batches(target: str, key: str, order: str) -> Callable[[DataFrame, int], None]:
    """A sink that keeps the latest row per key in a table of key buckets: batch i reads and writes only the buckets it has rows for, as generation i, so a batch that is run again gives the same generation."""

    def sink(batch: DataFrame, i: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")).persist()
        try:
            touched = {r[0] for r in rows.select(BUCKET).distinct().collect()}  # no more than BUCKETS
            paths = [p for b, p in _latest(spark, target, i).items() if b in touched]
            if paths:
                old = spark.read.schema(batch.schema).parquet(*paths)
                rows_all = rows.unionByName(old.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")))
            else:
                rows_all = rows
            others = [c for c in batch.columns if c not in (key, order)]
            last = rows_all.groupBy(BUCKET, key).agg(F.max(F.struct(order, *others)).alias("_x")).select(BUCKET, key, *[F.col(f"_x.{c}").alias(c) for c in (order, *others)])
            last.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{target}/generation={i}")
        finally:
            rows.unpersist()

    return sink
