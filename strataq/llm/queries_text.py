"""Queries on text forms (p2), oversized blocks (p4) and leaked evaluation passages (p8)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataq.llm import chunking, leakage, unicode_forms
from strataq.operators.blocks import BLOCK_KEYS, assemble_parts, block_text
from strataq.session import spread, table


def block_key():
    return F.concat_ws("|", "norm_id", "version_id", F.col("block_index").cast("string"))


@F.pandas_udf(T.StringType())
def text_of_block(s: pd.Series) -> pd.Series:
    return s.map(block_text, na_action="ignore")


def _titles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "law_norms").where("title IS NOT NULL").select(F.lit("law_norms").alias("source_table"), F.col("id").alias("record_key"), F.col("title").alias("text"))


def _block_texts(spark: SparkSession, d: str) -> DataFrame:
    stored = assemble_parts(spread(table(spark, d, "law_version_blocks")), BLOCK_KEYS)
    return stored.select(F.lit("law_version_blocks").alias("source_table"), block_key().alias("record_key"), text_of_block("block_json").alias("text"))


@F.pandas_udf(T.StringType())
def suspect_text_of_block(s: pd.Series) -> pd.Series:
    return s.map(lambda raw: block_text(raw) if unicode_forms.json_suspect(raw) else None, na_action="ignore")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Titles and block texts whose stored form needs a change; a block whose JSON has none of the suspect characters, themselves or escaped, is not parsed."""
    stored = assemble_parts(spread(table(spark, d, "law_version_blocks")), BLOCK_KEYS)
    blocks = stored.select(F.lit("law_version_blocks").alias("source_table"), block_key().alias("record_key"), suspect_text_of_block("block_json").alias("text"))
    texts = _titles(spark, d).unionByName(blocks)
    return unicode_forms.unify(texts, "text").where(F.size("form.findings") > 0).select("source_table", "record_key").distinct()


def p2_unified(spark: SparkSession, d: str) -> DataFrame:
    """Every title and block text in one consistent form, with a hash of the form for comparisons."""
    texts = _titles(spark, d).unionByName(_block_texts(spark, d)).where("text IS NOT NULL")
    return unicode_forms.unify(texts, "text").select("source_table", "record_key", F.col("form.text").alias("text"), F.xxhash64("form.form_key").alias("form_hash"), F.array_join("form.findings", ",").alias("findings"))


def p2_equal_titles(spark: SparkSession, d: str) -> DataFrame:
    """Titles that are equal in the consistent form although stored in several forms."""
    t = unicode_forms.unify(_titles(spark, d), "text")
    per_form = t.groupBy(F.col("form.form_key").alias("form_key"), "text").agg(F.count("*").alias("n"))
    return per_form.groupBy("form_key").agg(F.count("*").alias("n_forms"), F.sum("n").alias("n_rows")).where("n_forms > 1")


def _limit(spark: SparkSession, d: str) -> tuple[int, int]:
    """The limit for block parts, one row of a table of fixed size."""
    r = table(spark, d, "size_limits").where("limit_name = 'block_part'").select("max_size", "overlap").first()
    return r["max_size"], r["overlap"]


def p4_pieces(spark: SparkSession, d: str) -> DataFrame:
    return chunking.split_blocks(table(spark, d, "law_version_blocks"), *_limit(spark, d))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_pieces(spark, d).where("piece_index = 1").select(*BLOCK_KEYS)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(spread(table(spark, d, "documents")), table(spark, d, "eval_items"))


def p8_items(spark: SparkSession, d: str) -> DataFrame:
    """Which test items leaked, and into how many documents."""
    return p8_found(spark, d).groupBy("item_id").agg(F.count("*").alias("n_documents"))


def p8_cleaned(spark: SparkSession, d: str) -> DataFrame:
    return leakage.remove_leaks(spread(table(spark, d, "documents")), table(spark, d, "eval_items"))


# The tree of a whole block, all values, in DuckDB.
_BLOCKS = """
WITH parts AS (SELECT DISTINCT * FROM law_version_blocks WHERE part_index >= 0 AND part_index < part_count),
whole AS (SELECT norm_id, version_id, block_index, string_agg(block_json, '' ORDER BY part_index) AS j, count(*) AS n, max(part_count) AS pc FROM parts GROUP BY ALL HAVING n = pc),
vals AS (SELECT norm_id, version_id, block_index, t.atom ->> '$' AS v FROM whole, json_tree(CAST(j AS JSON)) t WHERE t.key IN ('label', 'title', 'text') AND t.type = 'VARCHAR' AND (t.atom ->> '$') <> '')
"""

_ODD = (
    r"[\x{FF01}-\x{FF60}\x{FFE0}-\x{FFE6}\x{FB00}-\x{FB06}\p{M}\x{00AD}\x{034F}\x{061C}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{FE00}-\x{FE0F}\x{FEFF}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}]"
    r"|[A-Za-z\x{00C0}-\x{00D6}\x{00D8}-\x{00F6}\x{00F8}-\x{024F}][\p{Greek}\p{Cyrillic}]|[\p{Greek}\p{Cyrillic}][A-Za-z\x{00C0}-\x{00D6}\x{00D8}-\x{00F6}\x{00F8}-\x{024F}]"
)

_GRAMS = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(replace(replace(replace(replace(lower(text), 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), 'ß', 'ss'), '[\p{L}\p{N}]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(replace(replace(replace(replace(lower(text), 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), 'ß', 'ss'), '[\p{L}\p{N}]+') AS w FROM eval_items),
dg AS (SELECT DISTINCT doc_id, array_to_string(w[k:k+11], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS k FROM dw)),
ig AS (SELECT DISTINCT item_id, array_to_string(w[k:k+11], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS k FROM iw)),
hits AS (SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g))
"""

# Texts as pieces that are words or what lies between; a word is leaked if a common n-gram covers it.
_CLEANED = _GRAMS.rstrip() + r""",
found AS (SELECT DISTINCT g FROM ig),
leaked AS (SELECT DISTINCT doc_id, unnest(range(k, k + 12)) AS w FROM (SELECT doc_id, k, array_to_string(w[k:k+11], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS k FROM dw)) JOIN found USING (g)),
split AS (SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}]+|[^\p{L}\p{N}]+') AS p FROM documents WHERE doc_id IN (SELECT doc_id FROM leaked)),
piece AS (SELECT doc_id, unnest(range(1, len(p) + 1)) AS i, unnest(p) AS x FROM split),
numbered AS (SELECT *, sum(CASE WHEN regexp_matches(x, '[\p{L}\p{N}]') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS w, regexp_matches(x, '[\p{L}\p{N}]') AS is_word FROM piece),
marked AS (SELECT n.doc_id, i, x, is_word, a.w IS NOT NULL AND (is_word OR b.w IS NOT NULL) AS gone, is_word AND a.w IS NOT NULL AND c.w IS NULL AS starts
FROM numbered n LEFT JOIN leaked a ON a.doc_id = n.doc_id AND a.w = n.w LEFT JOIN leaked b ON b.doc_id = n.doc_id AND b.w = n.w + 1 LEFT JOIN leaked c ON c.doc_id = n.doc_id AND c.w = n.w - 1)
SELECT doc_id, CAST(count(*) FILTER (starts) AS INTEGER) AS n_spans, CAST(coalesce(sum(length(x)) FILTER (gone), 0) AS INTEGER) AS removed_chars, coalesce(string_agg(x, '' ORDER BY i) FILTER (NOT gone), '') AS clean_text FROM marked GROUP BY doc_id
"""

QUERIES = {"p2_found": p2_found, "p2_unified": p2_unified, "p2_equal_titles": p2_equal_titles, "p4_found": p4_found, "p4_pieces": p4_pieces, "p8_found": p8_found, "p8_items": p8_items, "p8_cleaned": p8_cleaned}

SQL = {
    "p2_found": _BLOCKS + f"SELECT DISTINCT 'law_norms' AS source_table, id AS record_key FROM law_norms WHERE regexp_matches(title, '{_ODD}') UNION ALL SELECT DISTINCT 'law_version_blocks', norm_id || '|' || version_id || '|' || block_index FROM vals WHERE regexp_matches(v, '{_ODD}')",
    "p4_found": _BLOCKS + "SELECT norm_id, version_id, block_index FROM vals GROUP BY ALL HAVING sum(length(v)) + count(*) - 1 > (SELECT max_size FROM size_limits WHERE limit_name = 'block_part')",
    "p8_found": _GRAMS + "SELECT doc_id, item_id FROM hits",
    "p8_cleaned": _CLEANED,
    "p8_items": _GRAMS + "SELECT item_id, count(*) AS n_documents FROM hits GROUP BY item_id",
}
