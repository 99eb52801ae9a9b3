"""Resolving records to each other: unique keys, word overlap, signals."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataq.session import cut

#: Pairs that are given out at once.
PAIRS = 50_000


def unique_key(df: DataFrame, key: str, ident: str, out: str) -> DataFrame:
    """key, out: the one row that has the key; keys of several rows are left out, so nothing is guessed."""
    g = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(ident).alias(out), F.countDistinct(ident).alias("_n"))
    return g.where("_n = 1").select(key, out)


def overlap_match(left: DataFrame, right: DataFrame, left_id: str, right_id: str, words: str, least: float) -> DataFrame:
    """left_id, right_id, score: the one row on the right whose words overlap the left's by at least ``least`` of the smaller set and more than any other's; ties refuse.

    left(left_id, words), right(right_id, words), words being distinct. Exact,
    by prefixes: a pair that reaches the threshold shares one of the rarest
    words of its smaller set, so only those words are joined, never all. Equal
    sets of words are matched once, for all rows that have them.
    """
    lefts = left.select(F.col(left_id).alias("id"), F.array_sort(words).alias("w")).where(F.size("w") > 0).withColumn("l", F.xxhash64("w"))
    a = lefts.groupBy("l").agg(F.first("w").alias("wl"))
    rights = right.select(F.col(right_id).alias("id"), F.array_sort(words).alias("w")).where(F.size("w") > 0).groupBy(F.xxhash64("w").alias("r")).agg(F.first("w").alias("wr"), F.min("id").alias("first"), F.countDistinct("id").alias("ids"))
    b = rights.select("r", "wr")
    df = b.select(F.explode("wr").alias("w")).unionByName(a.select(F.explode("wl").alias("w"))).groupBy("w").agg(F.count("*").alias("n"))

    def prefixes(x: DataFrame, i: str, w: str) -> DataFrame:
        t = x.select(i, F.size(w).alias("k"), F.explode(w).alias("w")).join(df, "w")
        rank = F.row_number().over(Window.partitionBy(i).orderBy("n", "w"))
        return t.withColumn("p", rank).where(F.col("p") <= F.col("k") - F.ceil(F.lit(least) * F.col("k")) + 1).select(i, "w")

    every = lambda x, i, w: x.select(i, F.explode(w).alias("w"))
    pairs = prefixes(a, "l", "wl").join(every(b, "r", "wr"), "w").select("l", "r").unionByName(prefixes(b, "r", "wr").join(every(a, "l", "wl"), "w").select("l", "r")).distinct()
    shared = F.size(F.array_intersect("wl", "wr"))
    score = shared / F.least(F.size("wl"), F.size("wr"))
    scored = pairs.join(a, "l").join(b, "r").select("l", "r", score.alias("score"), shared.alias("shared")).where(F.col("score") >= least)
    best = scored.groupBy("l").agg(F.max(F.struct("score", "shared", "r")).alias("x"), F.max(F.struct("score", "shared")).alias("m"))
    ties = scored.join(best.select("l", "m"), "l").where((F.col("score") == F.col("m.score")) & (F.col("shared") == F.col("m.shared"))).groupBy("l").agg(F.count("*").alias("n"))
    one = best.join(ties, "l").where("n = 1").select("l", F.col("x.r").alias("r"), F.col("x.score").alias("score")).join(rights.where("ids = 1").select("r", "first"), "r")
    return lefts.select("id", "l").join(one, "l").select(F.col("id").alias(left_id), F.col("first").alias(right_id), F.round("score", 6).alias("score"))


def _begun(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by k; what begins a key is open when the key comes."""
    shown = lambda pairs: pd.DataFrame(pairs, columns=["id", "other"], dtype=object)
    opened: list[tuple[str, list]] = []
    pairs: list[tuple] = []
    for b in batches:
        for k, i in zip(b["k"], b["id"]):
            while opened and not k.startswith(opened[-1][0]):
                opened.pop()
            for _, ids in opened:
                pairs += zip(ids, repeat(i))
            if opened and opened[-1][0] == k:
                opened[-1][1].append(i)
            else:
                opened.append((k, [i]))
            if len(pairs) >= PAIRS:
                yield shown(pairs)
                pairs = []
    if pairs:
        yield shown(pairs)


def beginning_pairs(rows: DataFrame, ident: str, key: str) -> DataFrame:
    """id, other: each pair of rows once of which one's key begins the other's or is the same; rows without id or key are in none.

    The keys are sorted over range partitions. There all that begin with one
    key follow it at once, so one walk with the keys still open gives all pairs,
    whatever else begins alike. Keys still open where a partition ends and that
    begin the next one's first are joined to the rows there.
    """
    named = rows.select(F.col(ident).alias("id"), F.col(key).alias("k")).where("id IS NOT NULL AND k IS NOT NULL")
    kept = cut(named.repartitionByRange("k").sortWithinPartitions("k"))
    x = kept.withColumn("p", F.spark_partition_id())
    ends = x.groupBy("p").agg(F.min("k").alias("first"), F.max("k").alias("last"))  # a row per partition
    at_end = x.join(F.broadcast(ends), "p").where(F.startswith("last", "k")).select("p", "k").distinct().collect()
    carried: list[tuple[str, int]] = []
    opened: list[str] = []
    for e in sorted(ends.collect()):
        opened = [k for k in opened if e["first"].startswith(k)]
        carried += [(k, e["p"]) for k in opened]
        opened += [r["k"] for r in at_end if r["p"] == e["p"]]
    kind = named.schema["id"].dataType.simpleString()
    pairs = kept.select("id", "k").mapInPandas(_begun, f"id {kind}, other {kind}")
    if not carried:
        return pairs
    over = rows.sparkSession.createDataFrame(carried, "begin string, p int")
    later = x.withColumnRenamed("id", "other").join(F.broadcast(over), "p").where(F.startswith("k", "begin")).select("begin", "other")
    return pairs.unionByName(kept.join(later, F.col("k") == F.col("begin")).select("id", "other"))


def resolve_by_tiers(refs: DataFrame, targets: DataFrame, ident: str, tiers: list[tuple[str, str, str]]) -> DataFrame:
    """Adds resolved and tier to refs: for each (tier, column of refs, column of targets) in order, the target whose value is equal and that is the only one with it; tier is "none" where no tier says.

    Null values name nothing. Targets are reduced to their unique values before
    they are joined, so no value of many rows meets another.
    """
    x = refs
    for k, (_, ref, target) in enumerate(tiers):
        unique = unique_key(targets.select(F.col(target).alias(f"_k{k}"), F.col(ident).alias("_i")), f"_k{k}", "_i", f"_r{k}")
        x = x.join(unique, x[ref] == unique[f"_k{k}"], "left").drop(f"_k{k}")
    found = [F.col(f"_r{k}") for k in range(len(tiers))]
    tier = F.coalesce(*[F.when(c.isNotNull(), F.lit(n)) for c, (n, *_) in zip(found, tiers)], F.lit("none"))
    return x.withColumns({"resolved": F.coalesce(*found), "tier": tier}).drop(*[f"_r{k}" for k in range(len(tiers))])


def signal_level(signals: list[Column]) -> Column:
    """exact if all signals agree, strong if the first and another do, weak if any does, else null."""
    hits = sum((F.coalesce(s, F.lit(False)).cast("int") for s in signals), F.lit(0))
    return F.when(hits == len(signals), "exact").when(F.coalesce(signals[0], F.lit(False)) & (hits > 1), "strong").when(hits > 0, "weak")
