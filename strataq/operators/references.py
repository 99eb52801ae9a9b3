"""References to records that do not exist, are removed, or arrive later.

Parents, children and the removal log are united in one tagged long form and
grouped by (parent table, key). That grouping combines map-side, so a key that
a third of all rows refer to costs one partial row per task. Only the groups
that lack a parent (or whose parent came after a child) go on; they are copied
``SALTS`` times and joined back to the children by (key, salt), so the children
of one hot orphan key spread over as many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Copies of each orphan key in the join back to the children.
SALTS = 16


def verdicts(parents: DataFrame, children: DataFrame, removals: DataFrame) -> DataFrame:
    """One row per referenced key without parent or with a late one: parent_table, parent_key, has_parent, parent_first, removed, n_children.

    parents(parent_table, parent_key, first_seen), children(parent_table,
    parent_key, first_seen), removals(parent_table, parent_key). Rows with a
    null key are no references and no parents. A child or parent without
    first_seen is never late. Repeated rows change counts of children only.
    """
    none = F.lit(None).cast("timestamp_ntz")
    long = (
        parents.select("parent_table", "parent_key", F.lit(1).alias("p"), F.lit(0).alias("r"), F.lit(0).cast("long").alias("c"), F.col("first_seen").cast("timestamp_ntz").alias("pf"), none.alias("cf"))
        .unionByName(removals.select("parent_table", "parent_key", F.lit(0).alias("p"), F.lit(1).alias("r"), F.lit(0).cast("long").alias("c"), none.alias("pf"), none.alias("cf")))
        .unionByName(children.select("parent_table", "parent_key", F.lit(0).alias("p"), F.lit(0).alias("r"), F.lit(1).cast("long").alias("c"), none.alias("pf"), F.col("first_seen").cast("timestamp_ntz").alias("cf")))
        .where(F.col("parent_key").isNotNull())
    )
    return (
        long.groupBy("parent_table", "parent_key")
        .agg(F.max("p").alias("p"), F.max("r").alias("r"), F.sum("c").alias("n_children"), F.min("pf").alias("parent_first"), F.min("cf").alias("child_first"))
        .where((F.col("n_children") > 0) & ((F.col("p") == 0) | (F.col("child_first") < F.col("parent_first"))))
        .select("parent_table", "parent_key", (F.col("p") == 1).alias("has_parent"), "parent_first", (F.col("r") == 1).alias("removed"), "n_children")
    )


def orphan_references(parents: DataFrame, children: DataFrame, removals: DataFrame) -> DataFrame:
    """One row per reference that does not resolve: ref_table, ref_field, ref_key, reason, period.

    children(ref_table, ref_field, ref_key, parent_table, parent_key,
    first_seen, guard_table, guard_key): one row per delivery; the smallest
    first_seen of a reference counts. A reference with a guard counts only if
    the guard's parent exists. reason: ``deleted`` if the removal log names the
    missing parent, ``missing`` if not, ``late`` if the parent was first seen
    after the reference. period: month of the reference, null if it has no
    time. Other columns of the inputs are ignored. Empty inputs give no rows.
    """
    keys = ["ref_table", "ref_field", "ref_key", "parent_table", "parent_key", "guard_table", "guard_key"]
    refs = children.where(F.col("parent_key").isNotNull()).groupBy(*keys).agg(F.min(F.col("first_seen").cast("timestamp_ntz")).alias("first_seen"))
    bad = verdicts(parents, refs, removals)
    salt = F.pmod(F.xxhash64("ref_table", "ref_field", "ref_key"), F.lit(SALTS)).cast("int")
    spread = bad.select("parent_table", "parent_key", "has_parent", "parent_first", "removed", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    found = (
        refs.withColumn("salt", salt)
        .join(spread, ["parent_table", "parent_key", "salt"])
        .where(~F.col("has_parent") | (F.col("first_seen") < F.col("parent_first")))
    )
    absent = spread.where(~F.col("has_parent")).select(F.col("parent_table").alias("guard_table"), F.col("parent_key").alias("guard_key"), "salt")
    guarded = found.where(F.col("guard_key").isNotNull()).join(absent, ["guard_table", "guard_key", "salt"], "left_anti")
    return (
        found.where(F.col("guard_key").isNull()).select("ref_table", "ref_field", "ref_key", *_verdict())
        .unionByName(guarded.select("ref_table", "ref_field", "ref_key", *_verdict()))
    )


def _verdict() -> list[Column]:
    reason = F.when(F.col("has_parent"), "late").when(F.col("removed"), "deleted").otherwise("missing")
    return [reason.alias("reason"), F.date_format("first_seen", "yyyy-MM").alias("period")]


def orphan_counts(orphans: DataFrame) -> DataFrame:
    """Orphans per table, field, reason and period."""
    return orphans.groupBy("ref_table", "ref_field", "reason", "period").agg(F.count("*").alias("n"))
