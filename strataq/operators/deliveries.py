"""The row that holds among repeated deliveries of a key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataq.session import cut

#: Most repeated keys (as hashes) that are broadcast; beyond, all rows are grouped.
BROADCAST_KEYS = 1_000_000


def latest_rows(df: DataFrame, keys: list[str], by: str, values: list[str]) -> DataFrame:
    """keys, values of the row with the greatest ``by`` per key; of rows equally late the greatest values hold. Null ``by`` comes before any other; null keys are keys.

    Keys delivered once, usually almost all, keep their row where it is: only
    key hashes are shuffled to find the others, and only the others' rows are
    grouped (combined map-side, so a hot key is no hot task).
    """
    rows = df.select(*keys, by, *values).withColumn("_h", F.xxhash64(*keys))
    repeated = cut(rows.groupBy("_h").agg(F.count("*").alias("_n")).where("_n > 1").select("_h"))

    def grouped(x: DataFrame) -> DataFrame:
        return x.groupBy(*keys).agg(F.max(F.struct(by, *values)).alias("_v")).select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])

    if repeated.count() > BROADCAST_KEYS:
        return grouped(rows)
    few = F.broadcast(repeated)
    return rows.join(few, "_h", "left_anti").select(*keys, *values).unionByName(grouped(rows.join(few, "_h", "left_semi")))
