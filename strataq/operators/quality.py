"""Comparison, sampling, ranks and fingerprints for data-quality work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataq.functions.text import fnv1a
from strataq.operators.listing import top_per_group
from strataq.session import cut


def multiset_difference(left: DataFrame, right: DataFrame, keys: list[str], item: str) -> DataFrame:
    """keys, item, missing, extra: by how much each item occurs more often on the left or on the right; signed counts are summed once, without a join."""
    both = left.select(*keys, item, F.lit(1).alias("d")).unionByName(right.select(*keys, item, F.lit(-1).alias("d")))
    return both.groupBy(*keys, item).agg(F.sum("d").alias("d")).where("d != 0").select(*keys, item, F.greatest("d", F.lit(0)).alias("missing"), F.greatest(-F.col("d"), F.lit(0)).alias("extra"))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all distinct words; 0 if there are none."""
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / both)


def containment(a: Column, b: Column) -> Column:
    """Share of a's distinct words in b; 0 if either is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_distinct(a)))


def overlap(a: Column, b: Column) -> Column:
    """Shared over the smaller set; 1 where nothing can be compared."""
    small = F.least(F.size(F.array_distinct(a)), F.size(F.array_distinct(b)))
    return F.when(small == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / small)


def seeded(key: Column, seed: str) -> Column:
    return fnv1a(F.concat(F.lit(seed + "\x00"), key.cast("string")))


def stratified_sample(df: DataFrame, key: str, stratum: str, size: int, quota: int, seed: str) -> DataFrame:
    """``quota`` rows of each stratum in the order of a seeded hash, the rest filled in that order up to ``size``. Same seed and rows, same sample. No stratum can give more than its first ``size`` rows, so no more leave a task."""
    h = df.withColumn("order_hash", seeded(F.col(key), seed))
    return top_per_group(h, [stratum], [F.asc("order_hash"), F.asc(key)], max(size, quota), "_r").orderBy((F.col("_r") > quota).cast("int"), "order_hash", key).limit(size).drop("_r")


def global_rank(df: DataFrame, order: list[str], out: str = "rank") -> DataFrame:
    """Adds the position (1 …) in a total order, without a window over everything: rows are range-partitioned and ranked there, and one count per partition shifts the ranks."""
    ranged = cut(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    counts = ranged.groupBy("_p").agg(F.count("*").alias("_n"))
    before = counts.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    w = Window.partitionBy("_p").orderBy(*order)
    return ranged.withColumn("_r", F.row_number().over(w)).join(F.broadcast(before), "_p").withColumn(out, F.col("_r") + F.col("_before")).drop("_p", "_r", "_before")  # a row per partition


def strided_sample(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """Every k-th row of the order, k being the number of rows over n, at least 1."""
    total = df.count()
    return global_rank(df, order, "_rank").where((F.col("_rank") - 1) % max(1, total // n) == 0).drop("_rank")


def row_fingerprint(*columns: str) -> Column:
    """SHA-256 of the columns, nulls kept apart from empty texts."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]), 256)


def table_fingerprint(df: DataFrame, columns: list[str]) -> DataFrame:
    """n_rows, fingerprint: independent of row order and partitioning, sums combine map-side. The sum of 48-bit pieces of the row hashes."""
    piece = F.conv(F.substring(row_fingerprint(*columns), 1, 12), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("n_rows"), F.sum(piece).cast("string").alias("fingerprint"))


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """key, change: added, removed, changed or unchanged. Both sides are reduced to key and hash before the join."""
    a = old.select(key, row_fingerprint(*columns).alias("h"), F.lit(1).alias("o"), F.lit(0).alias("n"))
    b = new.select(key, row_fingerprint(*columns).alias("h"), F.lit(0).alias("o"), F.lit(1).alias("n"))
    g = a.unionByName(b).groupBy(key).agg(F.sum("o").alias("o"), F.sum("n").alias("n"), F.min("h").alias("h1"), F.max("h").alias("h2"))
    change = F.when(F.col("o") == 0, "added").when(F.col("n") == 0, "removed").when(F.col("h1") == F.col("h2"), "unchanged").otherwise("changed")
    return g.select(key, change.alias("change"))


def grouped_diff(old: DataFrame, new: DataFrame, key: str, groups: dict[str, list[str]]) -> DataFrame:
    """key, change (added, removed, changed or unchanged), changed: the names of the column groups that differ, in their order. Both sides are reduced to a hash a group before the exchange."""
    side = lambda df, n: df.select(key, F.lit(n).alias("side"), *[row_fingerprint(*cols).alias(g) for g, cols in groups.items()])
    both = side(old, 0).unionByName(side(new, 1)).groupBy(key).agg(F.min("side").alias("_lo"), F.max("side").alias("_hi"), *[(F.min(g) != F.max(g)).alias(g) for g in groups])
    in_both = F.col("_lo") != F.col("_hi")
    changed = F.when(in_both, F.array_compact(F.array(*[F.when(F.col(g), F.lit(g)) for g in groups]))).otherwise(F.array().cast("array<string>"))
    change = F.when(~in_both & (F.col("_lo") == 0), "removed").when(~in_both, "added").when(F.size(changed) > 0, "changed").otherwise("unchanged")
    return both.select(key, change.alias("change"), changed.alias("changed"))


def apply_changes(old: DataFrame, new: DataFrame, diff: DataFrame, key: str) -> DataFrame:
    """The old snapshot with the changes of ``diff`` taken from the new one: untouched rows stay, touched keys are replaced."""
    touched = diff.where("change != 'unchanged'").select(key)
    return old.join(touched, key, "left_anti").unionByName(new.join(diff.where("change IN ('added', 'changed')").select(key), key, "left_semi"))
