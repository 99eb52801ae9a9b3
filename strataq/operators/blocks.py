"""Stored tree blocks: rejoining of values that were cut into parts, and their text.

Most values lie in one row and pass without an exchange; only values in several
parts are shuffled, by their own key, and repeated parts fall together before
the shuffle (a set is collected, combined map-side), so what one task holds of
a key is one value.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_KEYS = ["norm_id", "version_id", "block_index"]


def assemble_parts(df: DataFrame, keys: list[str], index: str = "part_index", count: str = "part_count", payload: str = "block_json", least_length: int = 0) -> DataFrame:
    """keys, payload: the parts 0 … count-1 of a value in order, as one string.

    A value with a part missing gives no row; parts numbered outside that range
    are ignored; of parts that differ under one number the smallest holds.
    A one-part value delivered several times comes out as often; a value in
    several parts comes out once. Rows whose key, number, count or payload is
    null give nothing. ``least_length``: values no longer than that are left
    out, before the shuffle where possible.
    """
    rows = df.select(*keys, F.col(index).alias("_i"), F.col(count).alias("_n"), F.col(payload).alias("_p")).where(F.col("_p").isNotNull())
    whole = rows.where((F.col("_n") == 1) & (F.col("_i") == 0) & (F.length("_p") > least_length)).select(*keys, F.col("_p").alias(payload))
    parts = rows.where((F.col("_n") > 1) & (F.col("_i") >= 0) & (F.col("_i") < F.col("_n")))
    found = parts.groupBy(*keys).agg(F.max("_n").alias("_n"), F.array_sort(F.collect_set(F.struct("_i", "_p"))).alias("_a"))
    firsts = F.filter("_a", lambda x, i: (i == 0) | (F.get(F.col("_a"), i - 1)["_i"] != x["_i"]))
    joined = (
        found.withColumn("_a", firsts)
        .where(F.size("_a") == F.col("_n"))
        .select(*keys, F.array_join(F.transform("_a", lambda x: x["_p"]), "").alias(payload))
        .where(F.length(payload) > least_length)
    )
    return whole.unionByName(joined)


def split_parts(df: DataFrame, keys: list[str], payload: str, size: int) -> DataFrame:
    """keys, part_index, part_count, payload: values cut after every ``size`` characters, as assemble_parts joins them; an empty value is one empty part, null gives nothing."""
    rows = df.where(F.col(payload).isNotNull()).select(*keys, F.col(payload).alias("_p"), F.greatest(F.lit(1), F.ceil(F.length(payload) / size)).cast("int").alias("part_count"))
    each = rows.select(*keys, "_p", "part_count", F.explode(F.sequence(F.lit(0), F.col("part_count") - 1)).alias("part_index"))
    return each.select(*keys, "part_index", "part_count", F.substring("_p", F.col("part_index") * size + 1, F.lit(size)).alias(payload))


def _own(block: dict) -> list[str]:
    return [str(v) for v in (block.get("label"), block.get("title"), block.get("text")) if v is not None and not isinstance(v, (dict, list, bool)) and str(v) != ""]


def block_values(block: Any) -> list[str]:
    """The non-empty label, title and text of a block, then those of its children in order. Anything but objects is skipped."""
    out: list[str] = []
    stack = [block]
    while stack:
        b = stack.pop()
        if not isinstance(b, dict):
            continue
        out += _own(b)
        children = b.get("children")
        if isinstance(children, list):
            stack.extend(reversed(children))
    return out


def parse_block(raw: str | None) -> list[str] | None:
    """The values of a stored block; None if it is no JSON object."""
    if raw is None:
        return None
    try:
        block = json.loads(raw)
    except (ValueError, RecursionError):
        return None
    return block_values(block) if isinstance(block, dict) else None


def block_text(raw: str | None) -> str | None:
    """The values of a stored block joined by single line feeds."""
    values = parse_block(raw)
    return None if values is None else "\n".join(values)
