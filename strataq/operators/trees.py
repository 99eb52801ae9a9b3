"""Tree-structured bodies: flattening, anchors, addressable units, tables.

A stored block is walked row by row in Python, since its depth is unbounded;
what needs the other blocks of a version (unique anchors, unit numbers) is a
window over the flattened rows, so no version is collected into one task's memory.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataq.functions import text as tx

# Anchor words of structural types.
ANCHOR_WORDS = {"book": "buch", "part": "teil", "chapter": "kapitel", "section": "abschnitt", "subsection": "unterabschnitt", "paragraph": "paragraph", "article": "artikel", "annex": "anlage", "preamble": "vorbemerkung"}
# Types that are addressable units, and words that a label's anchor leaves out.
PROVISIONS = {"paragraph", "article", "section", "subsection", "annex", "preamble"}
_TYPE_WORD = "(?i)^(?:§{1,2}|Artikel|Art\\.?|Anlage|Teil|Buch|Kapitel|Unterabschnitt|Abschnitt|Vorbemerkung)\\s*|\\s*(?:Teil|Buch|Kapitel|Unterabschnitt|Abschnitt)$"
#: Scope of what is quoted.
QUOTED = "zitat"


def anchor_slug(c: Column) -> Column:
    """Letters without accents and digits, hyphens between; a section sign is written out."""
    return F.regexp_replace(F.regexp_replace(F.lower(tx.strip_accents(F.replace(c, F.lit("§"), F.lit("paragraph")))), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def anchor_of(node: Column) -> Column:
    """Anchor of struct<type, label, path>: the type's word and the label without it, else the label, else the path."""
    words = F.create_map(*[F.lit(x) for pair in ANCHOR_WORDS.items() for x in pair])
    bare, whole = anchor_slug(F.regexp_replace(node["label"], _TYPE_WORD, " ")), anchor_slug(node["label"])
    return F.concat_ws("-", F.coalesce(words[node["type"]], node["type"]), F.coalesce(F.nullif(bare, F.lit("")), F.nullif(whole, F.lit("")), F.array_join(node["path"].cast("array<string>"), "-")))


def walk(block: dict, first: int) -> Iterator[dict]:
    """Every node in order, with its path, the unit it belongs to, and the articles and annexes it lies in (those inside of a quoted provision only); quoted provisions are no units, signatures are skipped in units."""
    stack = [(block, [first], None, [], False, False)]
    while stack:
        b, path, unit, scope, quoted, signed = stack.pop()
        if not isinstance(b, dict):
            continue
        kind = str(b.get("type") or "")
        is_unit = not quoted and kind in PROVISIONS
        label = None if b.get("label") is None else str(b["label"])
        own = path if is_unit else unit
        signed = signed or kind == "signature"
        yield {"path": path, "type": kind, "label": b.get("label"), "title": b.get("title"), "text": b.get("text"), "unit_path": None if signed else own, "is_unit": is_unit, "quoted": quoted, "scope": scope}
        below = [(QUOTED, None, None)] if kind == "quotedProvision" else [*scope, (kind, label, path)] if kind in ("article", "annex") else scope
        children = b.get("children")
        if isinstance(children, list):
            stack.extend((c, [*path, k], own, below, quoted or kind == "quotedProvision", signed) for k, c in reversed(list(enumerate(children))))


_NODE = "path array<int>, depth int, type string, label string, title string, text string, unit_path array<int>, is_unit boolean, quoted boolean, scope array<struct<type:string,label:string,path:array<int>>>"


def flatten(stored: DataFrame) -> DataFrame:
    """norm_id, version_id, block_index and one row per node of stored(…, block_json): path, depth, type, label, title, text, unit_path, is_unit, quoted, anchor (candidate). Blocks that are no JSON object give nothing."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols = ["norm_id", "version_id", "block_index", "path", "depth", "type", "label", "title", "text", "unit_path", "is_unit", "quoted", "scope"]
        for b in batches:
            rows = []
            for n, v, i, raw in zip(b["norm_id"], b["version_id"], b["block_index"], b["block_json"]):
                try:
                    block = json.loads(raw) if raw is not None else None
                except (ValueError, RecursionError):
                    continue
                if isinstance(block, dict):
                    text = lambda x: None if x is None else str(x)
                    rows += [(n, v, i, r["path"], len(r["path"]) - 1, r["type"], text(r["label"]), text(r["title"]), text(r["text"]), r["unit_path"], r["is_unit"], r["quoted"], r["scope"]) for r in walk(block, int(i))]
            yield pd.DataFrame(rows, columns=cols)

    nodes = stored.select("norm_id", "version_id", "block_index", "block_json").mapInPandas(of, "norm_id string, version_id string, block_index int, " + _NODE)
    within = F.transform("scope", lambda x: F.when(x["type"] == QUOTED, F.lit(QUOTED)).otherwise(anchor_of(x)))
    own = F.when(F.col("type").isin(*ANCHOR_WORDS), F.concat_ws("-", within, anchor_of(F.struct("type", "label", "path"))))
    return nodes.withColumn("anchor", own).drop("scope")


def unique_anchors(nodes: DataFrame) -> DataFrame:
    """Replaces anchor by one that is unique in its version: the first in document order keeps the candidate, others get their path behind it."""
    w = Window.partitionBy("norm_id", "version_id", "anchor").orderBy("path")
    suffix = F.concat(F.lit("--"), F.array_join(F.transform("path", lambda x: x.cast("string")), "-"))
    return nodes.withColumn("_r", F.row_number().over(w)).withColumn("anchor", F.when(F.col("_r") > 1, F.concat("anchor", suffix)).otherwise(F.col("anchor"))).drop("_r")


def units(nodes: DataFrame) -> DataFrame:
    """norm_id, version_id, unit_path, heading, body, subsections of units that have text; nested text goes to the nearest unit, in document order."""
    inside = nodes.where("unit_path IS NOT NULL")
    own = F.when(F.col("is_unit") & (F.col("path") == F.col("unit_path")), F.struct("type", "label", "title"))
    text = F.when(F.col("text").isNotNull() & (F.col("text") != ""), F.struct("path", "text"))
    sub = F.when(F.col("type") == "subparagraph", F.struct("path", F.regexp_extract("label", "^\\(\\s*([0-9]+[a-z]?)\\s*\\)$", 1).alias("n")))
    g = inside.groupBy("norm_id", "version_id", "unit_path").agg(F.max(own).alias("u"), F.array_sort(F.collect_set(text)).alias("t"), F.array_sort(F.collect_set(sub)).alias("s"))
    return g.where(F.size("t") > 0).select(
        "norm_id", "version_id", "unit_path", F.col("u.type").alias("type"), F.col("u.label").alias("label"), F.coalesce("u.title", "u.label").alias("heading"),
        F.array_join(F.transform("t", lambda x: x["text"]), "\n\n").alias("body"), F.filter(F.transform("s", lambda x: x["n"]), lambda x: x != "").alias("subsections"),
    )


def table_fingerprint(block: dict) -> str:
    """First 16 hex digits of the hash of a table's rows of trimmed cell texts."""
    rows = [[" ".join(str(c.get("text") or "").split()) for c in r.get("children") or []] for r in block.get("children") or []]
    return hashlib.sha256(json.dumps(rows, ensure_ascii=False).encode()).hexdigest()[:16]
