"""Near-duplicate provisions and version records (p6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataq.llm.near_duplicates import Duplicates
from strataq.operators.blocks import BLOCK_KEYS, assemble_parts, block_text
from strataq.operators.deliveries import latest_rows
from strataq.session import spread, table

#: As the task states them for these tables.
THRESHOLD, SHINGLE, LEAST_WORDS = 0.7, 3, 40


def _text_of(payload: str) -> str | None:
    """Blocks are stored as JSON objects; version texts come marked by a leading line feed."""
    return payload[1:] if payload.startswith("\n") else block_text(payload)


def _texts(spark: SparkSession, d: str) -> DataFrame:
    """Stored blocks and the texts of the latest version rows, keyed and owned by their norm."""
    blocks = assemble_parts(spread(table(spark, d, "law_version_blocks")), BLOCK_KEYS).select(
        F.lit("law_version_blocks").alias("source_table"), F.concat_ws("|", "norm_id", "version_id", F.col("block_index").cast("string")).alias("record_key"), F.col("norm_id").alias("owner"), F.col("block_json").alias("payload")
    )
    latest = latest_rows(table(spark, d, "law_versions"), ["norm_id", "version_id"], "updated_at", ["version_json"])
    fields = F.from_json("version_json", "title string, summary string, citation string, changeNote string")
    versions = latest.select("norm_id", "version_id", fields.alias("j")).select(
        F.lit("law_versions").alias("source_table"), F.concat_ws("|", "norm_id", "version_id").alias("record_key"), F.col("norm_id").alias("owner"),
        F.concat(F.lit("\n"), F.concat_ws("\n", "j.title", "j.summary", "j.citation", "j.changeNote")).alias("payload"),
    )
    return blocks.unionByName(versions)


def _duplicates(spark: SparkSession, d: str) -> Duplicates:
    return Duplicates(_texts(spark, d), THRESHOLD, SHINGLE, LEAST_WORDS, _text_of)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _duplicates(spark, d).key_pairs().drop("of_copies")


def p6_groups(spark: SparkSession, d: str) -> DataFrame:
    return _duplicates(spark, d).groups()


_PAIRS = r"""
WITH RECURSIVE parts AS (SELECT DISTINCT * FROM law_version_blocks WHERE part_index >= 0 AND part_index < part_count),
whole AS (SELECT norm_id, version_id, block_index, string_agg(block_json, '' ORDER BY part_index) AS j, count(*) AS n, max(part_count) AS pc FROM parts GROUP BY ALL HAVING n = pc),
vals AS (SELECT norm_id, version_id, block_index, j, string_agg(t.atom ->> '$', chr(10) ORDER BY t.id) AS txt FROM whole, json_tree(CAST(j AS JSON)) t WHERE t.key IN ('label', 'title', 'text') AND t.type = 'VARCHAR' AND (t.atom ->> '$') <> '' GROUP BY ALL),
lv AS (SELECT *, CAST(version_json AS JSON) AS vj FROM law_versions QUALIFY row_number() OVER (PARTITION BY norm_id, version_id ORDER BY updated_at DESC, version_json DESC) = 1),
texts AS (SELECT 'law_version_blocks' AS source_table, norm_id, norm_id || '|' || version_id || '|' || block_index AS k, txt, md5(j) AS c FROM vals
UNION ALL SELECT 'law_versions', norm_id, norm_id || '|' || version_id, concat_ws(chr(10), vj ->> 'title', vj ->> 'summary', vj ->> 'citation', vj ->> 'changeNote') AS t, md5(t) FROM lv),
words AS (SELECT source_table, norm_id, k, c, regexp_extract_all(lower(txt), '[\p{L}\p{N}]+') AS w FROM texts),
kept AS (SELECT * FROM words WHERE len(w) >= 40),
sh AS (SELECT DISTINCT source_table, norm_id, k, c, hash(w[i], w[i+1], w[i+2]) AS s FROM (SELECT *, unnest(range(1, len(w) - 1)) AS i FROM kept)),
sz AS (SELECT source_table, k, count(*) AS n FROM sh GROUP BY ALL),
co AS (SELECT a.source_table, a.k AS l, b.k AS r, a.c AS cl, b.c AS cr, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.source_table = b.source_table AND a.k < b.k AND a.norm_id <> b.norm_id GROUP BY ALL),
pairs AS (SELECT co.source_table, l, r, cl, cr FROM co JOIN sz x ON x.source_table = co.source_table AND x.k = l JOIN sz y ON y.source_table = co.source_table AND y.k = r WHERE c >= 0.7 * (x.n + y.n - c))
"""

# Every member of a class is in its group, so classes are what is connected.
_GROUPS = """
, ends AS (SELECT source_table, cl AS c, cr AS o FROM pairs UNION SELECT source_table, cr, cl FROM pairs),
reached AS (SELECT source_table, c, c AS o FROM ends UNION SELECT reached.source_table, reached.c, ends.o FROM reached JOIN ends ON ends.source_table = reached.source_table AND ends.c = reached.o),
member AS (SELECT DISTINCT source_table, k, c FROM kept WHERE (source_table, c) IN (SELECT source_table, c FROM ends)),
named AS (SELECT reached.source_table, reached.c, min(k) AS group_id FROM reached JOIN member ON member.source_table = reached.source_table AND member.c = reached.o GROUP BY ALL),
degree AS (SELECT source_table, c, count(*) AS n_links FROM ends GROUP BY ALL)
SELECT source_table, k AS record_key, group_id, n_links FROM member JOIN named USING (source_table, c) JOIN degree USING (source_table, c)
"""

QUERIES = {"p6_found": p6_found, "p6_groups": p6_groups}

SQL = {"p6_found": _PAIRS + "SELECT source_table, l AS left_key, r AS right_key FROM pairs", "p6_groups": _PAIRS + _GROUPS}
