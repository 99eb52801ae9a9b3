"""Orders of lists, matching by signals, and checks of records against each other."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from strataq.functions import text as tx
from strataq.operators import quality as ql
from strataq.operators import resolve as rs
from strataq.operators.blocks import BLOCK_KEYS, assemble_parts
from strataq.queries.quality import _LV, _NORM, WHOLE
from strataq.queries.temporal import norms_now, versions_now
from strataq.session import table


def title_order(spark, d):
    """Every norm's position by area and sort key."""
    n = norms_now(spark, d, "jurisdiction", "title").withColumn("k", tx.sort_key(F.col("title")))
    return ql.global_rank(n, ["jurisdiction", "k", "id"]).select("jurisdiction", F.col("rank").alias("position"), "id")


def activity_order(spark, d):
    """Every norm's position by its last change, or the start of its current version, newest first."""
    last = versions_now(spark, d).groupBy(F.col("norm_id").alias("id")).agg(F.max(F.when(F.col("simulation_valid_from") <= "2026-09-01", F.col("simulation_valid_from"))).alias("last"))
    n = norms_now(spark, d, "current_valid_from").join(last, "id", "left")
    a = n.select("id", F.coalesce("last", "current_valid_from").alias("activity"))
    # days from newest to oldest as growing numbers, unknown ones last
    return ql.global_rank(a.withColumn("k", F.coalesce(-F.unix_date("activity"), F.lit(2**31 - 1))), ["k", "id"]).select("id", "activity", F.col("rank").alias("position"))


def rank_vectors(spark, d):
    """Vectors of unequal length in lexicographic order, missing places being 0: padded into columns."""
    v = F.when(F.col("o_orderpriority").startswith("1"), F.array(F.lit(1))).when(F.col("o_orderpriority").startswith("2"), F.array(F.lit(1), F.lit(-1))).otherwise(F.array(F.lit(2), F.length("o_orderstatus"), F.lit(3)))
    o = table(spark, d, "orders").select("o_orderkey", v.alias("v"), "o_orderpriority")
    at = [F.coalesce(F.try_element_at("v", F.lit(i)), F.lit(0)) for i in (1, 2, 3)]
    return ql.global_rank(o.select("o_orderkey", *[c.alias(f"v{i}") for i, c in enumerate(at)]), ["v0", "v1", "v2", "o_orderkey"]).select("o_orderkey", F.col("rank").alias("position"))


def gap_match(spark, d):
    """Reports against versions of their norm by version, area and month; best level per report."""
    r = table(spark, d, "feedback_reports").select("id", "jurisdiction", F.concat_ws(":", "jurisdiction", F.lower(F.trim("norm_slug"))).alias("norm_id"), "version_id", F.date_format("created_at", "yyyy-MM").alias("m")).where("norm_slug IS NOT NULL").distinct()
    v = versions_now(spark, d).groupBy("norm_id").agg(F.collect_set("version_id").alias("versions"), F.collect_set(F.date_format("simulation_valid_from", "yyyy-MM")).alias("months"))
    j = r.join(v, "norm_id", "left")
    level = rs.signal_level([F.array_contains("versions", F.col("version_id")), F.array_contains("months", F.col("m")), F.col("versions").isNotNull()])
    return j.select("id", F.coalesce(level, F.lit("none")).alias("level"))


def entry_link(spark, d):
    """Titles of documents to titles of norms by word overlap, unique best only."""
    sig = lambda c: F.array_distinct(F.filter(tx.words(c), lambda x: F.length(x) >= 5))
    docs = table(spark, d, "documents").select("doc_id", sig(F.substring_index("text", "\n", 1)).alias("w"))
    n = norms_now(spark, d, "title").select("id", sig(F.col("title")).alias("w"))
    return rs.overlap_match(docs, n, "doc_id", "id", "w", 0.75)


def identity_sanity(spark, d):
    """Documents whose first line shares less than half of its words with the title of the norm they name."""
    docs = table(spark, d, "documents").where("norm_id IS NOT NULL").select("doc_id", "norm_id", F.array_distinct(tx.words(F.substring_index("text", "\n", 1))).alias("w"))
    n = norms_now(spark, d, "title").select(F.col("id").alias("norm_id"), F.array_distinct(tx.words(F.col("title"))).alias("t"))
    share = F.size(F.array_intersect("w", "t")) / F.greatest(F.lit(1), F.least(F.size("w"), F.size("t")))
    return docs.join(n, "norm_id").groupBy(F.when(share >= 0.5, "plausible").otherwise("doubtful").alias("sanity")).agg(F.count("*").alias("n"))


def length_tolerance(spark, d):
    """Stored length against the text's own: exact, within 3 %, within 12 % plus 200, or off."""
    n = F.length(F.coalesce("text", F.lit("")))
    gap = F.abs(n - F.col("n_chars"))
    k = F.when(gap == 0, "exact").when(gap <= 0.03 * F.col("n_chars"), "transform").when(gap <= 0.12 * F.col("n_chars") + 200, "parse").otherwise("off")
    return table(spark, d, "documents").groupBy(F.coalesce(k, F.lit("unknown")).alias("klass")).agg(F.count("*").alias("n"))


def enumeration_gaps(spark, d):
    """Versions that sources name and the versions lack, by norm."""
    s = table(spark, d, "law_source_objects").where("version_id != ''").select("norm_id", "version_id").distinct()
    return s.join(table(spark, d, "law_versions").select("norm_id", "version_id"), ["norm_id", "version_id"], "left_anti").groupBy("norm_id").agg(F.count("*").alias("n"), F.min("version_id").alias("first"))


def evidence_match(spark, d):
    """Sources of a norm to its versions by an equal source start, if that is unique."""
    v = versions_now(spark, d).where("source_valid_from IS NOT NULL").groupBy("norm_id", "source_valid_from").agg(F.min("version_id").alias("version"), F.count("*").alias("n")).where("n = 1").drop("n")
    s = table(spark, d, "law_source_objects").where("version_id = ''").select("norm_id", "source_index", "source_valid_from").distinct()
    return s.join(v, ["norm_id", "source_valid_from"], "left").select("norm_id", "source_index", "version")


def page_ranges(spark, d):
    """Entries of an issue by page bands: an equi-join on issue and band, then the range."""
    c = norms_now(spark, d, "initial_citation").select("id", F.regexp_extract("initial_citation", "Blatt (\\d+) S\\. (\\d+)", 1).alias("issue"), F.regexp_extract("initial_citation", "Blatt (\\d+) S\\. (\\d+)", 2).alias("page")).where("issue != ''").select("id", F.col("issue").cast("int").alias("issue"), F.col("page").cast("int").alias("page"))
    w = Window.partitionBy("issue").orderBy("page", "id")
    starts = c.withColumn("until", F.coalesce(F.lead("page").over(w) - 1, F.lit(9999))).select(F.col("id").alias("entry"), "issue", F.col("page").alias("low"), "until")
    asked = c.select("issue", F.explode(F.array(F.col("page"), F.col("page") + 3)).alias("p")).distinct()
    return asked.join(starts, "issue").where("p BETWEEN low AND until").select("issue", "p", "entry")


def baseline_units(spark, d):
    """Per norm and unit label the block that holds at the baseline: latest version that covers the day."""
    b = assemble_parts(table(spark, d, "law_version_blocks"), BLOCK_KEYS).select(*BLOCK_KEYS, F.get_json_object("block_json", "$.label").alias("label")).distinct()
    v = versions_now(spark, d).where("simulation_valid_from <= '2025-01-01' AND (simulation_valid_to IS NULL OR simulation_valid_to >= '2025-01-01')").select("norm_id", "version_id", "simulation_valid_from")
    g = b.where("label IS NOT NULL").join(v, ["norm_id", "version_id"]).groupBy("norm_id", "label").agg(F.max(F.struct("simulation_valid_from", "version_id", "block_index")).alias("x"))
    return g.select("norm_id", "label", F.col("x.version_id").alias("version_id"), F.col("x.block_index").alias("block_index"))


def publication_links(spark, d):
    v = versions_now(spark, d, "citation").where("citation IS NOT NULL")
    n = rs.unique_key(norms_now(spark, d, "initial_citation").withColumnRenamed("initial_citation", "citation"), "citation", "id", "link")
    return v.join(n, "citation", "left").groupBy(F.col("link").isNotNull().alias("linked"), (F.col("link") == F.col("norm_id")).alias("own")).agg(F.count("*").alias("n"))


def title_audit(spark, d):
    """Whether a norm is found by its own title alone: ok, ambiguous, or blank."""
    n = norms_now(spark, d, "title").withColumn("k", tx.normalise(F.col("title")))
    c = n.groupBy("k").agg(F.count("*").alias("n"))
    return n.join(c, "k", "left").select("id", F.when(F.coalesce("k", F.lit("")) == "", "blank").when(F.col("n") > 1, "ambiguous").otherwise("ok").alias("verdict"))


def foreign_records(spark, d):
    """Rows of a foreign shape mapped to ours: status, area, aligned start, payload of sources."""
    status = F.when(F.col("status") == "in-force", "aktiv").when(F.col("status") == "repealed", "aufgehoben").otherwise("sonstiges")
    n = norms_now(spark, d, "jurisdiction", "status", "effective_date")
    s = table(spark, d, "law_source_objects").where("version_id = ''").groupBy(F.col("norm_id").alias("id")).agg(F.countDistinct("source_index").alias("sources"))
    return n.join(s, "id", "left").select("id", F.upper("jurisdiction").alias("area"), status.alias("status"), F.greatest("effective_date", F.lit("2023-12-01").cast("date")).alias("start"), F.coalesce("sources", F.lit(0)).alias("sources"))


QUERIES = {f.__name__: f for f in (title_order, activity_order, rank_vectors, gap_match, entry_link, identity_sanity, length_tolerance, enumeration_gaps, evidence_match, page_ranges, baseline_units, publication_links, title_audit, foreign_records)}

_WORDS = lambda c: f"list_filter(string_split(coalesce({_NORM(c)}, ''), ' '), lambda x: x <> '')"
_DOCLINE = "split_part(text, chr(10), 1)"

SQL = {
    "title_order": _LV + "SELECT jurisdiction, row_number() OVER (ORDER BY jurisdiction NULLS FIRST, trim(regexp_replace(lower(replace(strip_accents(title), 'ß', 'ss')), '[^a-z0-9]+', ' ', 'g')) NULLS FIRST, id) AS position, id FROM ln",
    "activity_order": _LV + ", a AS (SELECT norm_id, max(simulation_valid_from) FILTER (simulation_valid_from <= DATE '2026-09-01') AS l FROM lv GROUP BY 1) SELECT id, coalesce(l, current_valid_from) AS activity, row_number() OVER (ORDER BY coalesce(l, current_valid_from) DESC NULLS LAST, id) AS position FROM ln LEFT JOIN a ON a.norm_id = id",
    "rank_vectors": "SELECT o_orderkey, row_number() OVER (ORDER BY CASE WHEN o_orderpriority[1] IN ('1', '2') THEN 1 ELSE 2 END, CASE o_orderpriority[1] WHEN '1' THEN 0 WHEN '2' THEN -1 ELSE length(o_orderstatus) END, CASE WHEN o_orderpriority[1] IN ('1', '2') THEN 0 ELSE 3 END, o_orderkey) AS position FROM orders",
    "gap_match": _LV + ", r AS (SELECT DISTINCT id, jurisdiction || ':' || lower(trim(norm_slug)) AS norm_id, version_id, strftime(created_at, '%Y-%m') AS m FROM feedback_reports WHERE norm_slug IS NOT NULL), v AS (SELECT norm_id, list(version_id) AS vs, list(strftime(simulation_valid_from, '%Y-%m')) AS ms FROM lv GROUP BY 1), k AS (SELECT id, coalesce(list_contains(vs, version_id), false) AS a, coalesce(list_contains(ms, m), false) AS b, vs IS NOT NULL AS c FROM r LEFT JOIN v USING (norm_id)) SELECT id, CASE WHEN a AND b AND c THEN 'exact' WHEN a AND (b OR c) THEN 'strong' WHEN a OR b OR c THEN 'weak' ELSE 'none' END AS level FROM k",
    "entry_link": _LV + f", a AS (SELECT doc_id, list_distinct(list_filter({_WORDS(_DOCLINE)}, lambda x: length(x) >= 5)) AS w FROM documents), b AS (SELECT id, list_distinct(list_filter({_WORDS('title')}, lambda x: length(x) >= 5)) AS w FROM ln), p AS (SELECT doc_id, id, len(list_intersect(a.w, b.w)) AS s, least(len(a.w), len(b.w)) AS m FROM a, b WHERE len(a.w) > 0 AND len(b.w) > 0), q AS (SELECT *, s / m AS score FROM p WHERE s / m >= 0.75), r AS (SELECT *, rank() OVER (PARTITION BY doc_id ORDER BY score DESC, s DESC) AS k FROM q) SELECT doc_id, min(id) AS id, round(max(score), 6) AS score FROM r WHERE k = 1 GROUP BY doc_id HAVING count(*) = 1",
    "identity_sanity": _LV + f", j AS (SELECT list_distinct({_WORDS('split_part(d.text, chr(10), 1)')}) AS w, list_distinct({_WORDS('ln.title')}) AS t FROM documents d JOIN ln ON ln.id = d.norm_id) SELECT CASE WHEN len(list_intersect(w, t)) / greatest(1, least(len(w), len(t))) >= 0.5 THEN 'plausible' ELSE 'doubtful' END AS sanity, count(*) AS n FROM j GROUP BY 1",
    "length_tolerance": "SELECT CASE WHEN n_chars IS NULL THEN 'unknown' WHEN g = 0 THEN 'exact' WHEN g <= 0.03 * n_chars THEN 'transform' WHEN g <= 0.12 * n_chars + 200 THEN 'parse' ELSE 'off' END AS klass, count(*) AS n FROM (SELECT n_chars, abs(length(coalesce(text, '')) - n_chars) AS g FROM documents) GROUP BY 1",
    "enumeration_gaps": "SELECT norm_id, count(*) AS n, min(version_id) AS first FROM (SELECT DISTINCT norm_id, version_id FROM law_source_objects s WHERE version_id <> '' AND NOT EXISTS (SELECT 1 FROM law_versions v WHERE v.norm_id = s.norm_id AND v.version_id = s.version_id)) GROUP BY 1",
    "evidence_match": _LV + ", u AS (SELECT norm_id, source_valid_from, min(version_id) AS version FROM lv WHERE source_valid_from IS NOT NULL GROUP BY ALL HAVING count(*) = 1) SELECT s.norm_id, source_index, version FROM (SELECT DISTINCT norm_id, source_index, source_valid_from FROM law_source_objects WHERE version_id = '') s LEFT JOIN u ON u.norm_id = s.norm_id AND u.source_valid_from = s.source_valid_from",
    "page_ranges": _LV + ", c AS (SELECT id, CAST(regexp_extract(initial_citation, 'Blatt (\\d+) S\\. (\\d+)', 1) AS INTEGER) AS issue, CAST(regexp_extract(initial_citation, 'Blatt (\\d+) S\\. (\\d+)', 2) AS INTEGER) AS page FROM ln WHERE regexp_matches(initial_citation, 'Blatt \\d+ S\\. \\d+')), s AS (SELECT id AS entry, issue, page AS low, coalesce(lead(page) OVER (PARTITION BY issue ORDER BY page, id) - 1, 9999) AS until FROM c), a AS (SELECT DISTINCT issue, unnest([page, page + 3]) AS p FROM c) SELECT a.issue, p, entry FROM a JOIN s ON s.issue = a.issue AND p BETWEEN low AND until",
    "baseline_units": WHOLE + _LV.replace("WITH ln", ", ln", 1) + ", b AS (SELECT DISTINCT norm_id, version_id, block_index, json_extract_string(j, '$.label') AS label FROM whole) SELECT b.norm_id, label, arg_max(b.version_id, (simulation_valid_from, b.version_id, block_index)) AS version_id, arg_max(block_index, (simulation_valid_from, b.version_id, block_index)) AS block_index FROM b JOIN lv ON lv.norm_id = b.norm_id AND lv.version_id = b.version_id WHERE label IS NOT NULL AND simulation_valid_from <= DATE '2025-01-01' AND (simulation_valid_to IS NULL OR simulation_valid_to >= DATE '2025-01-01') GROUP BY ALL",
    "publication_links": _LV + ", n AS (SELECT initial_citation AS c, min(id) AS link FROM ln WHERE initial_citation IS NOT NULL GROUP BY 1 HAVING count(DISTINCT id) = 1) SELECT link IS NOT NULL AS linked, link = norm_id AS own, count(*) AS n FROM lv LEFT JOIN n ON n.c = lv.citation WHERE citation IS NOT NULL GROUP BY ALL",
    "title_audit": _LV + f", k AS (SELECT id, {_NORM('title')} AS k FROM ln) SELECT id, CASE WHEN coalesce(k, '') = '' THEN 'blank' WHEN count(*) OVER (PARTITION BY k) > 1 THEN 'ambiguous' ELSE 'ok' END AS verdict FROM k",
    "foreign_records": _LV + ", s AS (SELECT norm_id, count(DISTINCT source_index) AS k FROM law_source_objects WHERE version_id = '' GROUP BY 1) SELECT id, upper(jurisdiction) AS area, CASE status WHEN 'in-force' THEN 'aktiv' WHEN 'repealed' THEN 'aufgehoben' ELSE 'sonstiges' END AS status, greatest(effective_date, DATE '2023-12-01') AS start, coalesce(k, 0) AS sources FROM ln LEFT JOIN s ON s.norm_id = id",
}
