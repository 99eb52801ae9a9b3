"""Views, audits and checks over the stored records."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from strataq.functions import editing as ed
from strataq.functions import text as tx
from strataq.operators import search_index as si
from strataq.operators import temporal as tm
from strataq.operators import trees
from strataq.queries import quality as qq
from strataq.queries import search as qs
from strataq.queries import temporal as qt
from strataq.queries.documents import _stored
from strataq.queries.temporal import norms_now, versions_now
from strataq.session import table


def _reports(spark, d, *cols):
    return table(spark, d, "feedback_reports").groupBy("id").agg(F.max(F.struct("revision", *cols)).alias("x")).select("id", *[F.col(f"x.{c}").alias(c) for c in cols])


def feedback_list(spark, d):
    return _reports(spark, d, "created_at", "status", "category").where("status = 'new'").orderBy(F.desc("created_at"), "id").limit(50)


def body_selection(spark, d):
    """Stored size of the current versions' bodies only; other bodies are not read beyond their keys."""
    n = norms_now(spark, d, "current_version_id").select(F.col("id").alias("norm_id"), F.col("current_version_id").alias("version_id"))
    b = table(spark, d, "law_version_blocks").select("norm_id", "version_id", "block_index", "part_index", F.length("block_json").alias("n")).distinct()
    return b.join(n, ["norm_id", "version_id"], "left_semi").groupBy("norm_id").agg(F.count("*").alias("parts"), F.sum("n").alias("chars"))


def entity_urls(spark, d):
    return norms_now(spark, d, "jurisdiction", "slug", "current_version_id").select("id", F.concat_ws("/", F.lit(""), "jurisdiction", F.lit("norm"), "slug", "current_version_id").alias("url"))


def norm_payload(spark, d):
    return norms_now(spark, d, "type", "status", "version_count").select("id", F.to_json(F.struct("id", "type", "status", "version_count")).alias("payload"))


def scope_exists(spark, d):
    v = versions_now(spark, d).where("simulation_valid_to IS NULL OR simulation_valid_to >= '2023-12-01'").select(F.col("norm_id").alias("id"))
    return norms_now(spark, d, "status").join(v, "id", "left_semi").select("id", "status")


def structural_address(spark, d):
    """Units that meet an address, paragraph 3 with subsection 2, on one unit."""
    u = trees.units(trees.flatten(_stored(spark, d)))
    return u.where((tx.structural_number(F.col("label")) == "3") & F.array_contains("subsections", "2")).select("norm_id", "version_id", F.element_at("unit_path", 1).alias("block_index"), "label", "heading")


def register_crosscheck(spark, d):
    """Versions against the norms' first citations: by equal citation, else by equal issue within the area if unique, else not."""
    n = norms_now(spark, d, "jurisdiction", "initial_citation").where("initial_citation IS NOT NULL")
    exact = n.groupBy(F.col("initial_citation").alias("citation")).agg(F.min("id").alias("by_citation"), F.count("*").alias("c")).where("c = 1").drop("c")
    issue = lambda c: F.regexp_extract(c, "Blatt (\\d+) S", 1)
    loose = n.groupBy("jurisdiction", issue("initial_citation").alias("issue")).agg(F.min("id").alias("by_issue"), F.count("*").alias("c")).where("c = 1 AND issue != ''").drop("c")
    v = versions_now(spark, d, "citation").select("norm_id", "version_id", "citation", F.substring_index("norm_id", ":", 1).alias("jurisdiction"), issue("citation").alias("issue"))
    j = v.join(exact, "citation", "left").join(loose, ["jurisdiction", "issue"], "left")
    return j.select("norm_id", "version_id", F.coalesce("by_citation", "by_issue").alias("entry"), F.when(F.col("by_citation").isNotNull(), "citation").when(F.col("by_issue").isNotNull(), "issue").otherwise("none").alias("tier"))


def tier_coverage(spark, d):
    t = qq.tiered_resolution(spark, d)
    return t.groupBy("tier").agg(F.count("*").alias("n")).withColumn("rate", F.round(F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))), 4))  # a row per tier


def readiness(spark, d):
    n = norms_now(spark, d, "jurisdiction", "title", "current_version_id")
    v = versions_now(spark, d).select(F.col("norm_id").alias("id"), F.lit(True).alias("has")).distinct()
    ok = F.col("title").isNotNull() & F.col("current_version_id").isNotNull() & F.coalesce("has", F.lit(False))
    return n.join(v, "id", "left").groupBy("jurisdiction").agg(F.bool_and(ok).alias("ready"), F.count_if(~ok).alias("blocked"))


def ordered_subsequence(spark, d):
    """Whether the titled blocks of a version still occur, in their order, in the next one: kept, missing, and kept out of order."""
    e = _stored(spark, d).select("norm_id", "version_id", "block_index", F.concat_ws("|", F.get_json_object("block_json", "$.label"), F.get_json_object("block_json", "$.title")).alias("e")).where("e != ''")
    e = e.groupBy("norm_id", "version_id", "e").agg(F.min("block_index").alias("p"))
    following = e.select("norm_id", "version_id").distinct().withColumn("next", F.lead("version_id").over(Window.partitionBy("norm_id").orderBy("version_id"))).where("next IS NOT NULL")
    old = e.join(following, ["norm_id", "version_id"]).select("norm_id", F.col("next").alias("version_id"), "e", F.col("p").alias("before"))
    j = old.join(e, ["norm_id", "version_id", "e"], "left")
    upto = F.max("p").over(Window.partitionBy("norm_id", "version_id").orderBy("before").rowsBetween(Window.unboundedPreceding, -1))
    return j.withColumn("upto", upto).groupBy("norm_id", "version_id").agg(F.count("p").alias("kept"), F.count_if(F.col("p").isNull()).alias("missing"), F.count_if(F.col("p") < F.col("upto")).alias("breaks"))


def order_consistency(spark, d):
    """Versions in which the paragraph numbers do not grow with the block index."""
    one = _stored(spark, d).select("norm_id", "version_id", "block_index", F.regexp_extract(F.get_json_object("block_json", "$.label"), "^§ (\\d+)", 1).alias("n")).distinct().where("n != ''")
    w = Window.partitionBy("norm_id", "version_id").orderBy("block_index")
    x = one.withColumn("before", F.lag(F.col("n").cast("int")).over(w))
    return x.groupBy("norm_id", "version_id").agg(F.count("*").alias("numbered"), F.count_if(F.col("before") >= F.col("n").cast("int")).alias("breaks"))


def candidate_augmentation(spark, d):
    """Hits with their origin: strict ones, documents whose title holds the words, and those of the fallback; one search."""
    h = qs._hits(spark, d, qs.REQUESTS | qs.ADDRESSES)
    source = F.when(F.col("strict"), 1).when(F.col("kind").isin("title", "identity"), 2).otherwise(3)
    return h.select("request", "doc_id", source.alias("source"))


_MONTHS = ["Januar", "Februar", "März", "April", "Mai", "Juni", "Juli", "August", "September", "Oktober", "November", "Dezember"]


def german_dates(spark, d):
    p = "vom (\\d{1,2})\\. ([A-Za-zä]+) (\\d{4})"
    c = table(spark, d, "law_versions").select("citation").where(F.col("citation").rlike(p)).distinct()
    part = lambda k: F.regexp_extract("citation", p, k)
    month = F.array_position(F.array(*map(F.lit, _MONTHS)), part(2)).cast("int")
    return c.select("citation", F.try_make_date(part(3).cast("int"), month, part(1).cast("int")).alias("day")) if hasattr(F, "try_make_date") else c.select("citation", F.when(month > 0, F.make_date(part(3).cast("int"), month, part(1).cast("int"))).alias("day"))


def structure_audit(spark, d):
    """Anchors that collide, tables without rows, nodes without any content, per version."""
    n = trees.flatten(_stored(spark, d).dropDuplicates(["norm_id", "version_id", "block_index"]))
    c = n.where("anchor IS NOT NULL").groupBy("norm_id", "version_id", "anchor").agg(F.count("*").alias("k")).where("k > 1").select("norm_id", "version_id", F.lit("anchor-collision").alias("finding"))
    e = n.where("coalesce(text, '') = '' AND coalesce(label, '') = '' AND coalesce(title, '') = '' AND type = 'tableCell'").select("norm_id", "version_id", F.lit("empty-cell").alias("finding"))
    return c.unionByName(e).groupBy("finding").agg(F.count("*").alias("n"), F.countDistinct("norm_id", "version_id").alias("versions"))


def provenance_violations(spark, d):
    v = versions_now(spark, d)
    rules = {"source-starts-later": "source_valid_from > simulation_valid_from", "source-ends-earlier": "source_valid_to < simulation_valid_from", "source-end-without-start": "source_valid_from IS NULL AND source_valid_to IS NOT NULL", "source-inverted": "source_valid_to < source_valid_from"}
    hit = F.explode(F.array_compact(F.array(*[F.when(F.expr(c), F.lit(n)) for n, c in rules.items()])))
    return v.select("norm_id", "version_id", hit.alias("rule"))


def validity_decision(spark, d):
    """The strongest evidence for a version: kind of source, then availability; none makes it undetermined."""
    s = table(spark, d, "law_source_objects").where("version_id != ''")
    strength = F.when(F.col("kind") == "official-gazette", 3).when(F.col("kind") == "primary-pdf", 2).otherwise(1) + F.when(F.col("availability") == "archived", 1).otherwise(0)
    g = s.groupBy("norm_id", "version_id").agg(F.max(F.struct(strength.alias("s"), F.col("kind"))).alias("x"))
    return g.select("norm_id", "version_id", F.col("x.kind").alias("kind"), F.when(F.col("x.s") >= 4, "decided").when(F.col("x.s") >= 2, "supported").otherwise("undetermined").alias("decision"))


def review_merge(spark, d):
    """Findings of two runs: decided ones stay, vanished open ones are superseded, new ones are open."""
    old = _reports(spark, d, "status", "category").where("category != 'search'").select("id", "status")
    new = _reports(spark, d, "category").where("category != 'other'").select("id", F.lit(True).alias("again"))
    status = F.when(F.col("status").isNull(), "new").when(F.col("again").isNotNull() | (F.col("status") != "new"), F.col("status")).otherwise("superseded")
    return old.join(new, "id", "full_outer").select("id", status.alias("merged"))


def staleness(spark, d):
    r = _reports(spark, d, "status", "updated_at", "priority").where("status IN ('new', 'triaged')")
    return r.groupBy("status", "priority").agg(F.count_if(F.col("updated_at") < "2026-07-01").alias("stale"), F.count("*").alias("n"))


def additive_only(spark, d):
    """Fields of a record that a new state changes or drops; fields may only be added."""
    n = norms_now(spark, d, "title", "status", "abbr")
    old = n.select("id", F.explode(F.create_map(F.lit("title"), "title", F.lit("status"), "status")).alias("k", "v"))
    new = n.select("id", F.explode(F.create_map(F.lit("title"), F.upper("title"), F.lit("status"), "status", F.lit("abbr"), "abbr")).alias("k", "w")).where("k != 'status' OR w = 'in-force'")
    return old.join(new, ["id", "k"], "left").where("NOT (v <=> w)").groupBy("k").agg(F.count("*").alias("n"))


def entity_view(spark, d):
    """The version to show per norm, with the number of alternatives."""
    c = qt._classified(spark, d)
    a = tm.applicable(c, "norm_id", "version_id", "simulation_valid_from", "kind")
    n = c.groupBy("norm_id").agg(F.count("*").alias("n"), F.count_if(F.col("kind") == "future").alias("future"))
    return a.join(n, "norm_id").select("norm_id", "version", "kind", (F.col("n") - 1).alias("alternatives"), "future")


def stem_overlap(spark, d):
    """Overlap of significant words of successive summaries, inflected forms counting as equal."""
    s = qq._summaries(spark, d)
    sig = lambda c: F.array_distinct(F.filter(c, lambda x: (F.length(x) >= 4) & ~x.rlike("^[0-9]+$")))
    s = s.select("norm_id", "version_id", sig("w").alias("a"), sig("nw").alias("b"))
    same = lambda x, y: (x == y) | ((F.length(x) >= 6) & (F.length(y) >= 6) & (F.left(x, F.greatest(F.lit(6), F.least(F.length(x), F.length(y)) - 3)) == F.left(y, F.greatest(F.lit(6), F.least(F.length(x), F.length(y)) - 3))))
    shared = F.size(F.filter("a", lambda x: F.exists("b", lambda y: same(x, y))))
    small = F.least(F.size("a"), F.size("b"))
    return s.select("norm_id", "version_id", F.round(F.when(small == 0, 1.0).otherwise(shared / small), 6).alias("overlap"))


def word_diff(spark, d):
    w = Window.partitionBy("norm_id").orderBy("version_id")
    v = versions_now(spark, d, "version_json").select("norm_id", "version_id", F.get_json_object("version_json", "$.summary").alias("t"))
    v = v.withColumn("b", F.lag("t").over(w)).where("b IS NOT NULL AND t IS NOT NULL")
    parts = ed.word_diff_column(F.col("b"), F.col("t"))
    return v.withColumn("p", parts).select("norm_id", "version_id", F.count_if(F.lit(True)).over(Window.partitionBy("norm_id")).alias("versions"), F.size(F.filter("p", lambda x: x["kind"] == "gone")).alias("gone"), F.size(F.filter("p", lambda x: x["kind"] == "new")).alias("new"))


def sentence_counts(spark, d):
    return table(spark, d, "documents").select("doc_id", F.size(ed.sentences_column(F.col("text"))).alias("n_sentences"))


def command_classes(spark, d):
    u = si.units_of(table(spark, d, "documents"))
    return u.groupBy(F.coalesce(ed.command_of(F.col("body")), F.lit("none")).alias("command")).agg(F.count("*").alias("n"))


_LV, _R = qq._LV, qq._R

QUERIES = {
    f.__name__: f
    for f in (
        feedback_list, body_selection, entity_urls, norm_payload, scope_exists, structural_address, register_crosscheck, tier_coverage, readiness, ordered_subsequence, order_consistency, candidate_augmentation, german_dates,
        structure_audit, provenance_violations, validity_decision, review_merge, staleness, additive_only, entity_view, stem_overlap, word_diff, sentence_counts, command_classes,
    )
}

SQL = {
    "feedback_list": _R + "SELECT id, created_at, status, category FROM r WHERE status = 'new' ORDER BY created_at DESC, id LIMIT 50",
    "body_selection": _LV + "SELECT norm_id, count(*) AS parts, sum(n) AS chars FROM (SELECT DISTINCT b.norm_id, b.version_id, block_index, part_index, length(block_json) AS n FROM law_version_blocks b JOIN ln ON ln.id = b.norm_id AND ln.current_version_id = b.version_id) GROUP BY norm_id",
    "entity_urls": _LV + "SELECT id, concat_ws('/', '', jurisdiction, 'norm', slug, current_version_id) AS url FROM ln",
    "norm_payload": _LV + "SELECT id, CAST(to_json(struct_pack(id := id, type := type, status := status, version_count := version_count)) AS VARCHAR) AS payload FROM ln",
    "scope_exists": _LV + "SELECT id, status FROM ln WHERE EXISTS (SELECT 1 FROM lv WHERE lv.norm_id = ln.id AND (simulation_valid_to IS NULL OR simulation_valid_to >= DATE '2023-12-01'))",
    "register_crosscheck": _LV + """, n AS (SELECT id, jurisdiction, initial_citation AS c, regexp_extract(initial_citation, 'Blatt (\\d+) S', 1) AS i FROM ln WHERE initial_citation IS NOT NULL),
e AS (SELECT c, min(id) AS id FROM n GROUP BY c HAVING count(*) = 1), l AS (SELECT jurisdiction, i, min(id) AS id FROM n GROUP BY ALL HAVING count(*) = 1 AND i <> '')
SELECT norm_id, version_id, coalesce(e.id, l.id) AS entry, CASE WHEN e.id IS NOT NULL THEN 'citation' WHEN l.id IS NOT NULL THEN 'issue' ELSE 'none' END AS tier FROM lv LEFT JOIN e ON e.c = lv.citation LEFT JOIN l ON l.jurisdiction = split_part(lv.norm_id, ':', 1) AND l.i = regexp_extract(lv.citation, 'Blatt (\\d+) S', 1)""",
    "tier_coverage": "WITH t AS (" + qq.SQL["tiered_resolution"] + ") SELECT tier, count(*) AS n, round(count(*) / (SELECT count(*) FROM t), 4) AS rate FROM t GROUP BY tier",
    "readiness": _LV + ", k AS (SELECT jurisdiction, title IS NOT NULL AND current_version_id IS NOT NULL AND id IN (SELECT norm_id FROM lv) AS ok FROM ln) SELECT jurisdiction, bool_and(ok) AS ready, count(*) FILTER (NOT ok) AS blocked FROM k GROUP BY jurisdiction",
    "ordered_subsequence": qq.WHOLE + ", e AS (SELECT norm_id, version_id, min(block_index) AS p, concat_ws('|', json_extract_string(j, '$.label'), json_extract_string(j, '$.title')) AS e FROM whole GROUP BY norm_id, version_id, 4 HAVING e <> ''), f AS (SELECT norm_id, version_id, lead(version_id) OVER (PARTITION BY norm_id ORDER BY version_id) AS nx FROM (SELECT DISTINCT norm_id, version_id FROM e)), o AS (SELECT e.norm_id, nx AS version_id, e, p AS before FROM e JOIN f ON f.norm_id = e.norm_id AND f.version_id = e.version_id WHERE nx IS NOT NULL), k AS (SELECT o.norm_id, o.version_id, before, e.p, max(e.p) OVER (PARTITION BY o.norm_id, o.version_id ORDER BY before ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto FROM o LEFT JOIN e ON e.norm_id = o.norm_id AND e.version_id = o.version_id AND e.e = o.e) SELECT norm_id, version_id, count(p) AS kept, count(*) FILTER (p IS NULL) AS missing, count(*) FILTER (p < upto) AS breaks FROM k GROUP BY ALL",
    "order_consistency": qq.WHOLE + " SELECT norm_id, version_id, count(*) AS numbered, count(*) FILTER (b >= n) AS breaks FROM (SELECT *, lag(n) OVER (PARTITION BY norm_id, version_id ORDER BY block_index) AS b FROM (SELECT DISTINCT norm_id, version_id, block_index, CAST(regexp_extract(json_extract_string(j, '$.label'), '^§ (\\d+)', 1) AS INTEGER) AS n FROM whole WHERE regexp_matches(json_extract_string(j, '$.label'), '^§ \\d+'))) GROUP BY ALL",
    "candidate_augmentation": qs._sql_hits(qs.REQUESTS | qs.ADDRESSES) + "SELECT request, doc_id, CASE WHEN strict THEN 1 WHEN kind IN ('title', 'identity') THEN 2 ELSE 3 END AS source FROM hits",
    "german_dates": "SELECT DISTINCT citation, try_cast(regexp_extract(citation, 'vom (\\d{1,2})\\. ([A-Za-zä]+) (\\d{4})', 3) || '-' || list_position([" + ", ".join(f"'{m}'" for m in _MONTHS) + "], regexp_extract(citation, 'vom (\\d{1,2})\\. ([A-Za-zä]+) (\\d{4})', 2)) || '-' || regexp_extract(citation, 'vom (\\d{1,2})\\. ([A-Za-zä]+) (\\d{4})', 1) AS DATE) AS day FROM law_versions WHERE regexp_matches(citation, 'vom (\\d{1,2})\\. ([A-Za-zä]+) (\\d{4})')",
    "provenance_violations": _LV + "SELECT norm_id, version_id, unnest(list_filter([CASE WHEN source_valid_from > simulation_valid_from THEN 'source-starts-later' END, CASE WHEN source_valid_to < simulation_valid_from THEN 'source-ends-earlier' END, CASE WHEN source_valid_from IS NULL AND source_valid_to IS NOT NULL THEN 'source-end-without-start' END, CASE WHEN source_valid_to < source_valid_from THEN 'source-inverted' END], lambda x: x IS NOT NULL)) AS rule FROM lv",
    "validity_decision": "WITH s AS (SELECT norm_id, version_id, kind, CASE kind WHEN 'official-gazette' THEN 3 WHEN 'primary-pdf' THEN 2 ELSE 1 END + CASE WHEN availability = 'archived' THEN 1 ELSE 0 END AS s FROM law_source_objects WHERE version_id <> ''), g AS (SELECT norm_id, version_id, max(s) AS m, arg_max(kind, (s, coalesce(kind, ''))) AS kind FROM s GROUP BY ALL) SELECT norm_id, version_id, kind, CASE WHEN m >= 4 THEN 'decided' WHEN m >= 2 THEN 'supported' ELSE 'undetermined' END AS decision FROM g",
    "review_merge": _R + "SELECT id, CASE WHEN category = 'search' THEN 'new' WHEN category <> 'other' OR status <> 'new' THEN status ELSE 'superseded' END AS merged FROM r",
    "staleness": _R + "SELECT status, priority, count(*) FILTER (updated_at < TIMESTAMP '2026-07-01') AS stale, count(*) AS n FROM r WHERE status IN ('new', 'triaged') GROUP BY ALL",
    "additive_only": _LV + "SELECT 'title' AS k, count(*) FILTER (title IS DISTINCT FROM upper(title)) AS n FROM ln UNION ALL SELECT 'status', count(*) FILTER (status <> 'in-force') FROM ln",
    "entity_view": qt._NOW + ", a AS (" + qt.SQL["applicable_version"].removeprefix(qt._NOW) + ") SELECT a.norm_id, version, a.kind, n - 1 AS alternatives, future FROM a JOIN (SELECT norm_id, count(*) AS n, count(*) FILTER (kind = 'future') AS future FROM cl GROUP BY 1) USING (norm_id)",
    "stem_overlap": qq._SUM + ", k AS (SELECT norm_id, version_id, list_distinct(list_filter(w, lambda x: length(x) >= 4 AND NOT regexp_full_match(x, '[0-9]+'))) AS a, list_distinct(list_filter(nw, lambda x: length(x) >= 4 AND NOT regexp_full_match(x, '[0-9]+'))) AS b FROM s), u AS (SELECT norm_id, version_id, least(len(a), len(b)) AS m, unnest(CASE WHEN len(a) = 0 THEN [NULL] ELSE a END) AS x, b FROM k) SELECT norm_id, version_id, round(CASE WHEN max(m) = 0 THEN 1.0 ELSE count(*) FILTER (len(list_filter(b, lambda y: x = y OR (length(x) >= 6 AND length(y) >= 6 AND left(x, greatest(6, least(length(x), length(y)) - 3)) = left(y, greatest(6, least(length(x), length(y)) - 3))))) > 0) / max(m) END, 6) AS overlap FROM u GROUP BY ALL",
    "command_classes": qs._U + "SELECT CASE WHEN regexp_matches(body, '(?i)\\b(?:wird|werden) (?:aufgehoben|gestrichen)|tritt außer kraft|treten außer kraft') THEN 'repeal' WHEN regexp_matches(body, '(?i)\\b(?:wird|werden) .{0,200}ersetzt|erhält folgende fassung|wird wie folgt gefasst') THEN 'replace' WHEN regexp_matches(body, '(?i)\\b(?:wird|werden) .{0,200}eingefügt') THEN 'insert' WHEN regexp_matches(body, '(?i)\\b(?:wird|werden) .{0,200}angefügt') THEN 'append' WHEN regexp_matches(body, '(?i)\\bwird .{0,200}umbenannt|wird die bezeichnung') THEN 'rename' ELSE 'none' END AS command, count(*) AS n FROM n GROUP BY 1",
}
