"""Writers: full and incremental publication of tables, bounded files, identity written last.

A published table is cut into buckets by its key; the metadata names for every
bucket the generation that holds it, with its number of rows and fingerprint.
So an incremental publication finds what to write from one pass over the new
rows, writes the touched buckets only, and one that breaks off half-way is never
seen; one that is run again writes the same generation.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataq.operators.quality import row_fingerprint

META = "generation long, fingerprint string, tables string"
#: Buckets of a table, and the column they are in.
BUCKETS, BUCKET = 64, "key_bucket"


class StaleBase(ValueError):
    """The published state is not the one that the change was made against."""


def current(spark: SparkSession, root: str) -> dict | None:
    """The newest complete generation: generation, fingerprint, tables (as JSON: key, schema and buckets of each); None if there is none."""
    try:
        r = spark.read.schema(META).json(f"{root}/_meta").orderBy(F.desc("generation")).first()
    except Exception as x:
        if "PATH_NOT_FOUND" in str(x):
            return None
        raise
    return r.asDict() if r else None


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The published rows of a table, from the generation of each bucket."""
    now = current(spark, root)
    tables = json.loads(now["tables"]) if now else {}
    if name not in tables:
        raise ValueError(f"{name} is not published")
    schema = T.StructType.fromJson(tables[name]["schema"])
    paths = [f"{root}/{name}/generation={g}/{BUCKET}={b}" for b, (g, *_) in tables[name]["buckets"].items()]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def bucketed(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int"))


def _prints(df: DataFrame) -> dict[str, list]:
    """Number of rows and fingerprint of each bucket, independent of the order of rows; a row per bucket."""
    piece = F.conv(F.substring(row_fingerprint(*sorted(c for c in df.columns if c != BUCKET)), 1, 12), 16, 10).cast("decimal(38,0)")
    return {str(r[BUCKET]): [r["n"], str(r["s"])] for r in df.groupBy(BUCKET).agg(F.count("*").alias("n"), F.sum(piece).alias("s")).collect()}


def _write(df: DataFrame, path: str) -> None:
    df.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def _finish(spark: SparkSession, root: str, generation: int, tables: dict[str, dict]) -> dict:
    content = {n: [t["key"], sorted((b, *x[1:]) for b, x in t["buckets"].items())] for n, t in tables.items()}
    fingerprint = hashlib.sha256(json.dumps(content, sort_keys=True).encode()).hexdigest()
    row = {"generation": generation, "fingerprint": fingerprint, "tables": json.dumps(tables, sort_keys=True)}
    spark.createDataFrame([tuple(row.values())], META).coalesce(1).write.mode("append").json(f"{root}/_meta")
    return row


def publish(root: str, tables: dict[str, DataFrame], keys: dict[str, str] | None = None) -> dict:
    """Writes all tables anew, the metadata last. The key of a table is its first column if ``keys`` does not say."""
    spark = next(iter(tables.values())).sparkSession
    now = current(spark, root)
    generation = (now["generation"] if now else 0) + 1
    done = {}
    for name, df in tables.items():
        key = (keys or {}).get(name, df.columns[0])
        rows = bucketed(df, key)
        _write(rows, f"{root}/{name}/generation={generation}")
        done[name] = {"key": key, "schema": df.schema.jsonValue(), "buckets": {b: [generation, *x] for b, x in _prints(rows).items()}}
    return _finish(spark, root, generation, done)


def publish_changes(root: str, tables: dict[str, DataFrame], keys: dict[str, str], base: str) -> dict:
    """Writes only the buckets whose rows differ; no change writes nothing and gives no new generation. ``base``: fingerprint that the caller worked against; StaleBase if another is published, before anything is written."""
    spark = next(iter(tables.values())).sparkSession
    now = current(spark, root)
    done = json.loads(now["tables"]) if now else {}
    if now is None or now["fingerprint"] != base or sorted(done) != sorted(tables) or any(done[n]["key"] != keys[n] for n in tables):
        raise StaleBase(f"published: {now and now['fingerprint']}")
    generation, changed = now["generation"] + 1, False
    for name, df in tables.items():
        rows, old = bucketed(df, keys[name]), done[name]["buckets"]
        same_schema = df.schema.jsonValue() == done[name]["schema"]
        new = _prints(rows)
        touched = [b for b, x in new.items() if not same_schema or old.get(b, [None])[1:] != x]
        if touched:
            _write(rows.where(F.col(BUCKET).isin([int(b) for b in touched])), f"{root}/{name}/generation={generation}")
        changed = changed or bool(touched) or set(old) != set(new)
        done[name] = {"key": keys[name], "schema": df.schema.jsonValue(), "buckets": {b: [generation, *x] if b in touched else old[b] for b, x in new.items()}}
    return _finish(spark, root, generation, done) if changed else now


def bounded_files(df: DataFrame, group: str, size: str, most_rows: int, most_size: int) -> DataFrame:
    """Adds file (partition and number): groups are packed in order into files of at most ``most_rows`` rows and ``most_size`` in all, a group never split (one larger than a file has its own). Rows of a group must lie together: the table is partitioned by the group and packed within each partition, in a stream."""
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, rows, total, held = 0, 0, 0, []

        def place() -> pd.DataFrame:
            nonlocal number, rows, total
            g = pd.concat(held)
            n, s = len(g), int(g[size].sum())
            if rows and (rows + n > most_rows or total + s > most_size):
                number, rows, total = number + 1, 0, 0
            rows, total = rows + n, total + s
            return g.assign(file_number=number)

        for b in batches:
            for _, g in b.groupby(group, sort=False, dropna=False):
                same = held and (held[0][group].iat[0] == g[group].iat[0] or (pd.isna(held[0][group].iat[0]) and pd.isna(g[group].iat[0])))
                if held and not same:
                    yield place()
                    held = []
                held.append(g)
        if held:
            yield place()

    sorted_ = df.repartition(group).sortWithinPartitions(group)
    schema = T.StructType([*df.schema.fields, T.StructField("file_number", T.IntegerType())])
    return sorted_.mapInPandas(of, schema).withColumn("file", F.concat_ws("-", F.spark_partition_id().cast("string"), F.col("file_number").cast("string"))).drop("file_number")
