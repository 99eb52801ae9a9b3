"""Listings: facets, paging, top-k, federation, sampling across groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def disjunctive_facets(df: DataFrame, facets: dict[str, Column], conditions: dict[str, Column]) -> DataFrame:
    """facet, value, n: counts per facet value under all conditions but the facet's own; plus facet ``total`` with value null under all of them.

    One scan and one aggregation: each row is expanded once per facet it
    counts for, and the counts combine before the exchange.
    """
    both = reduce(lambda a, b: a & b, conditions.values(), F.lit(True))
    entries = []
    for name, value in facets.items():
        other = reduce(lambda a, b: a & b, [c for k, c in conditions.items() if k != name], F.lit(True))
        entries.append(F.when(F.coalesce(other, F.lit(False)), F.struct(F.lit(name).alias("facet"), value.cast("string").alias("value"))))
    entries.append(F.when(F.coalesce(both, F.lit(False)), F.struct(F.lit("total").alias("facet"), F.lit(None).cast("string").alias("value"))))
    return df.select(F.explode(F.array_compact(F.array(*entries))).alias("x")).groupBy("x.facet", "x.value").agg(F.count("*").alias("n"))


def page(df: DataFrame, order: list[Column], offset: int, limit: int, most: int = 100, furthest: int = 5000) -> DataFrame:
    """One page in a total order, with offset and limit clamped; a top-(offset + limit) per task, never a full sort."""
    return df.orderBy(*order).offset(max(0, min(furthest, offset))).limit(max(1, min(most, limit)))


def page_after(df: DataFrame, key: str, last: object, limit: int) -> DataFrame:
    """The page behind the last key of the page before (keyset paging); the filter reaches the scan."""
    rows = df if last is None else df.where(F.col(key) > F.lit(last))
    return rows.orderBy(key).limit(limit)


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """First k rows per key; the rank limit also applies before the exchange, so a hot key sends k rows per task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def federated_top(parts: list[DataFrame], order: list[Column], offset: int, limit: int) -> DataFrame:
    """Every source gives its first offset + limit rows; these are merged in the same order and the page is cut."""
    heads = [p.orderBy(*order).limit(offset + limit) for p in parts]
    return reduce(DataFrame.unionByName, heads).orderBy(*order).offset(offset).limit(limit)


def round_robin(df: DataFrame, category: str, order: list[Column], least: int) -> DataFrame:
    """Picks across categories in turn until ``least`` rows: adds turn (1 … within the category) and keeps the first in (turn, category). No more than ``least`` rows of a category leave a task."""
    return top_per_group(df, [category], order, least, "turn").orderBy("turn", category, *order).limit(least)


def split_parts(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """Adds part (0 … n-1): rows dealt out in turn by a hash of the order key, without a global sort."""
    return df.withColumn("part", F.pmod(F.crc32(F.concat_ws("|", *[F.col(c).cast("string") for c in order])), F.lit(n)).cast("int"))
