"""Registers, resolution by tiers, state audits, outlines and keys for matching."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from strataq.functions import text as tx
from strataq.operators import quality as ql
from strataq.operators import reconstruct as rc
from strataq.operators import resolve as rs
from strataq.operators import search_index as si
from strataq.operators import temporal as tm
from strataq.operators import trees
from strataq.plans import search as ps
from strataq.queries import search as qs
from strataq.queries.documents import _stored
from strataq.queries.quality import _LV, _NORM, WHOLE
from strataq.queries.temporal import norms_now, versions_now
from strataq.session import table


def systemic_stop(spark, d):
    """Events of a user at which a run must stop: everything but a purchase fails, with its type as the code."""
    e = table(spark, d, "events").select("user_id", "event_id", "ts", F.when(F.col("event_type") != "purchase", F.col("event_type")).alias("code"))
    return tm.systemic_stop(e, ["user_id"], ["ts", "event_id"], "code").select("user_id", "event_id", "in_row", "same_code", "stop")


def facet_merge(spark, d):
    """Facets counted by each area for itself, then merged: sums by facet and value."""
    n = norms_now(spark, d, "jurisdiction", "type", "status", "index_letter")
    pair = lambda f: F.struct(F.lit(f).alias("facet"), F.col(f).alias("value"))
    per_area = n.select("jurisdiction", F.explode(F.array(*map(pair, ("type", "status", "index_letter")))).alias("x")).groupBy("jurisdiction", "x.facet", "x.value").agg(F.count("*").alias("n"))
    return per_area.groupBy("facet", "value").agg(F.sum("n").alias("n"), F.count("*").alias("areas"), F.max(F.struct("n", "jurisdiction"))["jurisdiction"].alias("largest"))


def four_tier_resolution(spark, d):
    """Versions to norms by citation, id, abbreviation and title, the first tier that names one norm only."""
    v = versions_now(spark, d, "citation", "abbr", "title")
    n = norms_now(spark, d, "initial_citation", "abbr", "title")
    tiers = [("citation", "citation", "initial_citation"), ("id", "norm_id", "id"), ("abbreviation", "abbr", "abbr"), ("title", "title", "title")]
    return rs.resolve_by_tiers(v, n, "id", tiers).select("norm_id", "version_id", "resolved", "tier")


def reference_lookup(spark, d):
    """Slugs, abbreviations and titles that reports name, by area, to norms: slug, else abbreviation, else title."""
    r = table(spark, d, "feedback_reports").select("id", "jurisdiction", F.lower(F.trim("norm_slug")).alias("name")).where("name != ''").distinct()
    n = norms_now(spark, d, "jurisdiction", "slug", "abbr", "title").select(F.col("id").alias("norm"), *[F.concat_ws(":", "jurisdiction", F.lower(c)).alias(c) for c in ("slug", "abbr", "title")])
    named = r.withColumn("key", F.concat_ws(":", "jurisdiction", "name"))
    return rs.resolve_by_tiers(named, n, "norm", [("slug", "key", "slug"), ("abbreviation", "key", "abbr"), ("title", "key", "title")]).groupBy("tier").agg(F.count("*").alias("n"), F.countDistinct("resolved").alias("norms"))


def _stock(spark, d):
    """(kind, key, id): every way to name a norm."""
    n = norms_now(spark, d, "slug", "title", "short_title", "abbr", "initial_citation")
    ways = {"slug": F.col("slug"), "title": tx.normalise(F.col("title")), "short": tx.normalise(F.col("short_title")), "abbreviation": F.lower("abbr"), "citation": F.col("initial_citation")}
    return n.select("id", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), c.alias("key")) for k, c in ways.items()])).alias("x")).select("x.kind", "x.key", "id").where("key != ''")


def stock_index(spark, d):
    """How many keys of each kind name one norm, and how many several."""
    per_key = _stock(spark, d).distinct().groupBy("kind", "key").agg(F.count("*").alias("n"))
    return per_key.groupBy("kind").agg(F.count_if(F.col("n") == 1).alias("unique_keys"), F.count_if(F.col("n") > 1).alias("shared_keys"), F.max("n").alias("most"))


def number_comparison(spark, d):
    """Numbers of versions by the norm, by the versions and by the sources, and which of them agree."""
    n = norms_now(spark, d, "version_count").select(F.col("id").alias("norm_id"), F.col("version_count").cast("long").alias("said"))
    v = versions_now(spark, d).groupBy("norm_id").agg(F.count("*").alias("stored"))
    s = table(spark, d, "law_source_objects").where("version_id != ''").groupBy("norm_id").agg(F.countDistinct("version_id").alias("sourced"))
    j = n.join(v, "norm_id", "left").join(s, "norm_id", "left").na.fill(0, ["stored", "sourced"])
    verdict = F.when((F.col("said") == F.col("stored")) & (F.col("stored") == F.col("sourced")), "all").when(F.col("said") == F.col("stored"), "norm-and-versions").when(F.col("stored") == F.col("sourced"), "versions-and-sources").when(F.col("said") == F.col("sourced"), "norm-and-sources").otherwise("none")
    return j.groupBy(verdict.alias("agree")).agg(F.count("*").alias("n"), F.sum("said").alias("said"), F.sum("stored").alias("stored"), F.sum("sourced").alias("sourced"))


def completeness_totals(spark, d):
    """Per area the norms with every part of a record, those blocked, and what is open how often."""
    n = norms_now(spark, d, "jurisdiction", "title", "current_version_id", "publication_date", "initial_citation")
    gaps = {"no-title": F.col("title").isNull(), "no-current": F.col("current_version_id").isNull(), "no-publication": F.col("publication_date").isNull(), "no-citation": F.col("initial_citation").isNull()}
    open_ = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in gaps.items()]))
    return n.withColumn("open", open_).groupBy("jurisdiction").agg(F.count("*").alias("n"), F.count_if(F.size("open") == 0).alias("complete"), F.count_if(F.array_contains("open", "no-current")).alias("blocked"), F.sum(F.size("open").cast("long")).alias("open_gaps"))


def slowest_events(spark, d):
    """The ten largest values, as a run would list its slowest records."""
    return table(spark, d, "events").where("value IS NOT NULL").orderBy(F.desc("value"), "event_id").limit(10).select("event_id", "value")


def naming_audit(spark, d):
    """Records named against the rules, by rule."""
    n = norms_now(spark, d, "jurisdiction", "slug", "abbr", "index_letter", "title")
    rules = {
        "id-differs": F.col("id") != F.concat_ws(":", "jurisdiction", "slug"), "slug-signs": ~F.col("slug").rlike("^[a-z0-9]+(-[a-z0-9]+)*$"), "slug-area": ~F.endswith("slug", F.concat(F.lit("-"), F.col("jurisdiction"))),
        "abbreviation-blanks": F.col("abbr").rlike("\\s"), "letter": F.col("index_letter") != tx.index_letter(F.col("title")), "title-blanks": F.col("title") != F.trim(F.regexp_replace("title", "\\s+", " ")),
    }
    hit = F.explode(F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in rules.items()])))
    return n.select("id", hit.alias("rule")).groupBy("rule").agg(F.count("*").alias("n"), F.min("id").alias("example"))


def inventory_compare(spark, d):
    """Objects of the base inventory against those of the check: both, changed, or only one."""
    key = F.concat_ws("|", "norm_id", "version_id")
    side = lambda role, c: table(spark, d, "law_source_objects").where(F.col("source_role") == role).groupBy(key.alias("k")).agg(F.min("sha256").alias(c))
    j = side("base", "a").join(side("check", "b"), "k", "full_outer")
    state = F.when(F.col("b").isNull(), "only-base").when(F.col("a").isNull(), "only-check").when(F.col("a") == F.col("b"), "same").otherwise("changed")
    return j.groupBy(state.alias("state")).agg(F.count("*").alias("n"))


def state_audit(spark, d):
    """What the stores say of each version key together: norm, version, body, source."""
    flag = lambda df, name: df.select("norm_id", "version_id").distinct().withColumn(name, F.lit(True))
    v = flag(table(spark, d, "law_versions"), "version")
    b = flag(table(spark, d, "law_version_blocks"), "body")
    s = flag(table(spark, d, "law_source_objects").where("version_id != ''"), "source")
    n = table(spark, d, "law_norms").select(F.col("id").alias("norm_id")).distinct().withColumn("norm", F.lit(True))
    keys = ["norm_id", "version_id"]
    j = v.join(b, keys, "full_outer").join(s, keys, "full_outer").join(n, "norm_id", "left")
    has = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    return j.groupBy(*[has(c) for c in ("norm", "version", "body", "source")]).agg(F.count("*").alias("n"))


def gap_queue(spark, d):
    """Open reports in the order in which they are worked on: by priority, age and id; each one's place."""
    r = table(spark, d, "feedback_reports").groupBy("id").agg(F.max(F.struct("revision", "status", "priority", "created_at")).alias("x")).select("id", "x.*").where("status IN ('new', 'open', 'in-review')")
    return ql.global_rank(r.select("id", F.coalesce("priority", F.lit("P9")).alias("priority"), "created_at"), ["priority", "created_at", "id"]).select("id", "priority", F.col("rank").alias("place"))


def provision_anchors(spark, d):
    """Anchors of reports as addresses: kind and number, and how often."""
    p = "^(p|art|anlage|nr)(\\d+[a-z]?)$"
    a = table(spark, d, "feedback_reports").where("provision_anchor IS NOT NULL").select(F.regexp_extract("provision_anchor", p, 1).alias("k"), F.regexp_extract("provision_anchor", p, 2).alias("number"))
    kind = F.when(F.col("k") == "p", "paragraph").when(F.col("k") == "art", "article").when(F.col("k") == "anlage", "annex").when(F.col("k") == "nr", "number").otherwise("other")
    return a.groupBy(kind.alias("kind"), F.nullif("number", F.lit("")).alias("number")).agg(F.count("*").alias("n"))


def title_match_keys(spark, d):
    """Norms whose titles are equal once area, dates, kind words and signs are left out: groups by that key."""
    n = norms_now(spark, d, "title").where("title IS NOT NULL")
    key = F.trim(F.regexp_replace(F.regexp_replace(tx.normalise(F.regexp_replace("title", " im Gebiet .*$", "")), "^(gesetz|verordnung|satzung|richtlinie|bekanntmachung|runderlass) (uber|zu|zur|zum) ", ""), "\\b(der|die|das|und)\\b", " "))
    return n.select("id", F.regexp_replace(key, " {2,}", " ").alias("key")).groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("first")).where("n > 1")


def display_titles(spark, d):
    """Titles as they stand in a page: signs of markup escaped, a vocabulary word for the type."""
    words = {"gesetz": "Gesetz", "verordnung": "Verordnung", "satzung": "Satzung", "richtlinie": "Richtlinie"}
    label = F.coalesce(F.create_map(*[F.lit(x) for kv in words.items() for x in kv])[F.col("type")], F.lit("Sonstiges"))
    escaped = reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")), F.col("title"))
    return norms_now(spark, d, "title", "type").select("id", F.concat_ws(": ", label, escaped).alias("shown"))


def public_summary(spark, d):
    """Summaries that may be shown: trimmed, and none that only repeats the title."""
    n = norms_now(spark, d, "title", "summary")
    shown = F.nullif(F.trim("summary"), F.lit(""))
    return n.select("id", F.md5(F.when(F.startswith(tx.normalise(F.col("summary")), tx.normalise(F.col("title"))), None).otherwise(shown)).alias("summary"))


def unit_merge(spark, d):
    """Units shown for a request and document: those with its address before those with its words, each once."""
    index = qs.kept_index(spark, d)
    plan = ps.build_plan("§ 3 Zwangsgeld")
    words = [v for t in plan.tokens for v in t.variants]
    text = index.occurrences.where(F.col("term").startswith(words[0]) & (F.col("unit_index") >= 0)).select("doc_id", "unit_index", F.lit(1).alias("source"))
    address = index.units.where((F.col("kind") == plan.addresses[0].kind) & (F.col("number") == plan.addresses[0].number)).select("doc_id", "unit_index", F.lit(0).alias("source"))
    merged = address.unionByName(text).groupBy("doc_id", "unit_index").agg(F.min("source").alias("source"))
    w = Window.partitionBy("doc_id").orderBy("source", "unit_index")
    return merged.withColumn("place", F.row_number().over(w)).select("doc_id", "unit_index", "source", "place")


def outline(spark, d):
    """Outline of each version: its labelled nodes down to the second level, with depth and text of the heading."""
    n = trees.flatten(_stored(spark, d)).where("depth <= 1 AND coalesce(label, title) IS NOT NULL")
    entry = F.concat_ws(" ", "label", "title")
    g = n.groupBy("norm_id", "version_id").agg(F.max("depth").alias("deepest"), F.array_sort(F.collect_set(F.struct("path", entry.alias("e")))).alias("x"))
    return g.select("norm_id", "version_id", F.size("x").cast("long").alias("entries"), "deepest", F.md5(F.array_join(F.transform("x", lambda e: e["e"]), "\n")).alias("outline"))


def annex_assignment(spark, d):
    """Documents that are lists or tariffs to the norm text that shares their title's key, if it is one only."""
    key = lambda: F.try_element_at(tx.words(F.substring_index("text", "\n", 1)), F.lit(-1))
    docs = table(spark, d, "documents").where("length(text) > 0").select("doc_id", "doc_type", key().alias("key")).where("key IS NOT NULL")
    main = rs.unique_key(docs.where("doc_type = 'norm_text'").select(F.col("doc_id").alias("main"), "key"), "key", "main", "main_id")
    return docs.where("doc_type IN ('contents', 'tariff')").join(main, "key", "left").select("doc_id", F.col("main_id").alias("main"))


def projection_diff(spark, d):
    """What a new projection would change, by groups of columns: identity, search and dates of the norms against them with some edited."""
    old = norms_now(spark, d, "title", "status", "summary", "sort_key", "effective_date")
    n = F.pmod(F.length("id") + F.length("sort_key"), F.lit(9))
    new = old.where(n != 0).withColumns({"title": F.when(n == 1, F.concat("title", F.lit(" (neu)"))).otherwise(F.col("title")), "summary": F.when(n < 3, F.lit("neu")).otherwise(F.col("summary")), "effective_date": F.when(n == 4, F.date_add("effective_date", 1)).otherwise(F.col("effective_date"))})
    diff = ql.grouped_diff(old, new, "id", {"identity": ["title", "status"], "search": ["summary", "sort_key"], "dates": ["effective_date"]})
    return diff.groupBy("change", F.array_join("changed", ",").alias("groups")).agg(F.count("*").alias("n"))


def text_reconstruction(spark, d):
    """Texts amended twice and walked back to where they began: hashes of the text after each step."""
    docs = table(spark, d, "documents").where("length(text) > 0").select(F.col("doc_id").cast("string").alias("k"), "text")
    step = lambda day, change: F.struct(F.lit(day).alias("day"), F.lit(1).alias("seq"), F.to_json(change).alias("change_json"))
    one = F.struct(F.lit("append").alias("kind"), F.lit("\nZusatz Eins").alias("new"), F.sha2("text", 256).alias("before"))
    two = F.struct(F.lit("replace").alias("kind"), F.lit("Zusatz Eins").alias("old"), F.lit("Zusatz Zwei").alias("new"))
    changes = docs.select("k", F.explode(F.array(step("2026-01-01", one), step("2026-02-01", two))).alias("s")).select("k", "s.*")
    forth = rc.walk(docs, changes, "k")
    back = rc.walk(forth.where("step = 2").select("k", "text"), changes, "k", back=True)
    way = lambda df, w: df.select(F.lit(w).alias("way"), F.col("k").cast("long").alias("doc_id"), "step", F.md5("text").alias("text_hash"))
    return way(forth, "forth").unionByName(way(back, "back"))


QUERIES = {
    f.__name__: f
    for f in (
        systemic_stop, facet_merge, four_tier_resolution, reference_lookup, stock_index, number_comparison, completeness_totals, slowest_events, naming_audit, inventory_compare, state_audit, gap_queue, provision_anchors,
        projection_diff, text_reconstruction, title_match_keys, display_titles, public_summary, unit_merge, outline, annex_assignment,
    )
}

_TYPES = "CASE type WHEN 'gesetz' THEN 'Gesetz' WHEN 'verordnung' THEN 'Verordnung' WHEN 'satzung' THEN 'Satzung' WHEN 'richtlinie' THEN 'Richtlinie' ELSE 'Sonstiges' END"


def _tiers(refs: str, targets: str, target: str, tiers: list[tuple[str, str, str]]) -> str:
    """refs with r0, r1 …: the only target of each tier."""
    joins = " ".join(f"LEFT JOIN (SELECT {t} AS k, min({target}) AS r FROM {targets} WHERE {t} IS NOT NULL GROUP BY 1 HAVING count(DISTINCT {target}) = 1) t{i} ON t{i}.k = {refs}.{r}" for i, (_, r, t) in enumerate(tiers))
    return f"FROM {refs} {joins}", "coalesce(" + ", ".join(f"t{i}.r" for i in range(len(tiers))) + ")", "CASE " + " ".join(f"WHEN t{i}.r IS NOT NULL THEN '{n}'" for i, (n, *_) in enumerate(tiers)) + " ELSE 'none' END"


_F4 = _tiers("lv", "ln", "id", [("citation", "citation", "initial_citation"), ("id", "norm_id", "id"), ("abbreviation", "abbr", "abbr"), ("title", "title", "title")])
_F3 = _tiers("r", "k", "norm", [("slug", "key", "slug"), ("abbreviation", "key", "abbr"), ("title", "key", "title")])

SQL = {
    "systemic_stop": """WITH e AS (SELECT user_id, event_id, ts, CASE WHEN event_type <> 'purchase' THEN event_type END AS code FROM events),
f AS (SELECT *, list(code) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 24 PRECEDING AND CURRENT ROW) AS l, count(*) FILTER (code IS NULL) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM e),
g AS (SELECT user_id, event_id, code, len(list_filter(l, lambda x: x = code)) AS same_code, count(code) OVER (PARTITION BY user_id, island ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS in_row FROM f)
SELECT user_id, event_id, in_row, CASE WHEN code IS NULL THEN 0 ELSE same_code END AS same_code, in_row >= 20 OR (code IS NOT NULL AND same_code >= 15) AS stop FROM g""",
    "facet_merge": _LV + ", x AS (SELECT jurisdiction, 'type' AS facet, type AS value FROM ln UNION ALL SELECT jurisdiction, 'status', status FROM ln UNION ALL SELECT jurisdiction, 'index_letter', index_letter FROM ln), a AS (SELECT jurisdiction, facet, value, count(*) AS n FROM x GROUP BY ALL) SELECT facet, value, sum(n) AS n, count(*) AS areas, arg_max(jurisdiction, (n, jurisdiction)) AS largest FROM a GROUP BY ALL",
    "four_tier_resolution": _LV + f"SELECT lv.norm_id, lv.version_id, {_F4[1]} AS resolved, {_F4[2]} AS tier {_F4[0]}",
    "reference_lookup": _LV + ", r AS (SELECT DISTINCT id, jurisdiction || ':' || lower(trim(norm_slug)) AS key FROM feedback_reports WHERE trim(norm_slug) <> ''), k AS (SELECT id AS norm, jurisdiction || ':' || lower(slug) AS slug, jurisdiction || ':' || coalesce(lower(abbr), '') AS abbr, jurisdiction || ':' || coalesce(lower(title), '') AS title FROM ln) " + f"SELECT {_F3[2]} AS tier, count(*) AS n, count(DISTINCT {_F3[1]}) AS norms {_F3[0]} GROUP BY 1",
    "projection_diff": _LV + ", o AS (SELECT id, title, summary, effective_date, (length(id) + length(sort_key)) % 9 AS n FROM ln), x AS (SELECT CASE WHEN n = 0 THEN 'removed' WHEN (n = 1 AND title IS NOT NULL) OR (n IN (1, 2) AND summary IS DISTINCT FROM 'neu') OR (n = 4 AND effective_date IS NOT NULL) THEN 'changed' ELSE 'unchanged' END AS change, CASE WHEN n = 0 THEN '' ELSE concat_ws(',', CASE WHEN n = 1 AND title IS NOT NULL THEN 'identity' END, CASE WHEN n IN (1, 2) AND summary IS DISTINCT FROM 'neu' THEN 'search' END, CASE WHEN n = 4 AND effective_date IS NOT NULL THEN 'dates' END) END AS groups FROM o) SELECT change, groups, count(*) AS n FROM x GROUP BY ALL",
    "text_reconstruction": "WITH t AS (SELECT doc_id, text, text || chr(10) || 'Zusatz Eins' AS a, text || chr(10) || 'Zusatz Zwei' AS b FROM documents WHERE length(text) > 0) SELECT 'forth' AS way, doc_id, 1 AS step, md5(a) AS text_hash FROM t UNION ALL SELECT 'forth', doc_id, 2, md5(b) FROM t UNION ALL SELECT 'back', doc_id, 1, md5(a) FROM t UNION ALL SELECT 'back', doc_id, 2, md5(text) FROM t",
    "stock_index": _LV + f", x AS (SELECT 'slug' AS kind, slug AS key, id FROM ln UNION SELECT 'title', {_NORM('title')}, id FROM ln UNION SELECT 'short', {_NORM('short_title')}, id FROM ln UNION SELECT 'abbreviation', lower(abbr), id FROM ln UNION SELECT 'citation', initial_citation, id FROM ln), k AS (SELECT kind, key, count(*) AS n FROM x WHERE key <> '' GROUP BY ALL) SELECT kind, count(*) FILTER (n = 1) AS unique_keys, count(*) FILTER (n > 1) AS shared_keys, max(n) AS most FROM k GROUP BY kind",
    "number_comparison": _LV + ", j AS (SELECT version_count AS said, coalesce(v.c, 0) AS stored, coalesce(s.c, 0) AS sourced FROM ln LEFT JOIN (SELECT norm_id, count(*) AS c FROM lv GROUP BY 1) v ON v.norm_id = id LEFT JOIN (SELECT norm_id, count(DISTINCT version_id) AS c FROM law_source_objects WHERE version_id <> '' GROUP BY 1) s ON s.norm_id = id) SELECT CASE WHEN said = stored AND stored = sourced THEN 'all' WHEN said = stored THEN 'norm-and-versions' WHEN stored = sourced THEN 'versions-and-sources' WHEN said = sourced THEN 'norm-and-sources' ELSE 'none' END AS agree, count(*) AS n, sum(said) AS said, sum(stored) AS stored, sum(sourced) AS sourced FROM j GROUP BY 1",
    "completeness_totals": _LV + ", o AS (SELECT jurisdiction, current_version_id IS NULL AS b, (title IS NULL)::INT + (current_version_id IS NULL)::INT + (publication_date IS NULL)::INT + (initial_citation IS NULL)::INT AS k FROM ln) SELECT jurisdiction, count(*) AS n, count(*) FILTER (k = 0) AS complete, count(*) FILTER (b) AS blocked, sum(k) AS open_gaps FROM o GROUP BY 1",
    "slowest_events": "SELECT event_id, value FROM events WHERE value IS NOT NULL ORDER BY value DESC, event_id LIMIT 10",
    "naming_audit": _LV + r", x AS (SELECT id, unnest([CASE WHEN id <> jurisdiction || ':' || slug THEN 'id-differs' END, CASE WHEN NOT regexp_full_match(slug, '[a-z0-9]+(-[a-z0-9]+)*') THEN 'slug-signs' END, CASE WHEN NOT ends_with(slug, '-' || jurisdiction) THEN 'slug-area' END, CASE WHEN regexp_matches(abbr, '\s') THEN 'abbreviation-blanks' END, CASE WHEN index_letter <> CASE WHEN regexp_full_match(translate(upper(left(trim(title), 1)), 'ÄÖÜ', 'AOU'), '[A-Z]') THEN translate(upper(left(trim(title), 1)), 'ÄÖÜ', 'AOU') ELSE '#' END THEN 'letter' END, CASE WHEN title <> trim(regexp_replace(title, '\s+', ' ', 'g')) THEN 'title-blanks' END]) AS rule FROM ln) SELECT rule, count(*) AS n, min(id) AS example FROM x WHERE rule IS NOT NULL GROUP BY rule",
    "inventory_compare": "WITH s AS (SELECT norm_id || '|' || version_id AS k, min(sha256) FILTER (source_role = 'base') AS a, min(sha256) FILTER (source_role = 'check') AS b, bool_or(source_role = 'base') AS ha, bool_or(source_role = 'check') AS hb FROM law_source_objects WHERE source_role IN ('base', 'check') GROUP BY 1) SELECT CASE WHEN b IS NULL THEN 'only-base' WHEN a IS NULL THEN 'only-check' WHEN a = b THEN 'same' ELSE 'changed' END AS state, count(*) AS n FROM s GROUP BY 1",
    "state_audit": "WITH v AS (SELECT DISTINCT norm_id, version_id FROM law_versions), b AS (SELECT DISTINCT norm_id, version_id FROM law_version_blocks), s AS (SELECT DISTINCT norm_id, version_id FROM law_source_objects WHERE version_id <> ''), k AS (SELECT * FROM v UNION SELECT * FROM b UNION SELECT * FROM s) SELECT norm_id IN (SELECT id FROM law_norms) AS norm, (norm_id, version_id) IN (SELECT (norm_id, version_id) FROM v) AS version, (norm_id, version_id) IN (SELECT (norm_id, version_id) FROM b) AS body, (norm_id, version_id) IN (SELECT (norm_id, version_id) FROM s) AS source, count(*) AS n FROM k GROUP BY ALL",
    "gap_queue": "WITH r AS (SELECT * FROM feedback_reports QUALIFY row_number() OVER (PARTITION BY id ORDER BY revision DESC) = 1) SELECT id, coalesce(priority, 'P9') AS priority, row_number() OVER (ORDER BY coalesce(priority, 'P9'), created_at NULLS FIRST, id) AS place FROM r WHERE status IN ('new', 'open', 'in-review')",
    "provision_anchors": r"SELECT CASE regexp_extract(provision_anchor, '^(p|art|anlage|nr)(\d+[a-z]?)$', 1) WHEN 'p' THEN 'paragraph' WHEN 'art' THEN 'article' WHEN 'anlage' THEN 'annex' WHEN 'nr' THEN 'number' ELSE 'other' END AS kind, nullif(regexp_extract(provision_anchor, '^(p|art|anlage|nr)(\d+[a-z]?)$', 2), '') AS number, count(*) AS n FROM feedback_reports WHERE provision_anchor IS NOT NULL GROUP BY ALL",
    "title_match_keys": _LV + ", k AS (SELECT id, regexp_replace(trim(regexp_replace(regexp_replace(" + _NORM("regexp_replace(title, ' im Gebiet .*$', '')") + r", '^(gesetz|verordnung|satzung|richtlinie|bekanntmachung|runderlass) (uber|zu|zur|zum) ', ''), '\b(der|die|das|und)\b', ' ', 'g')), ' {2,}', ' ', 'g') AS key FROM ln WHERE title IS NOT NULL) SELECT key, count(*) AS n, min(id) AS first FROM k GROUP BY key HAVING n > 1",
    "display_titles": _LV + f"SELECT id, concat_ws(': ', {_TYPES}, replace(replace(replace(replace(replace(title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;')) AS shown FROM ln",
    "public_summary": _LV + f"SELECT id, md5(CASE WHEN starts_with({_NORM('summary')}, {_NORM('title')}) THEN NULL ELSE nullif(trim(summary), '') END) AS summary FROM ln",
    "unit_merge": qs._U.rstrip() + ", ua AS (SELECT doc_id, unit_index, " + qs._UNIT_ADDRESS + " FROM u), m AS (SELECT doc_id, unit_index, min(s) AS source FROM (SELECT doc_id, unit_index, 0 AS s FROM ua WHERE kind = 'paragraph' AND number = '3' UNION ALL SELECT doc_id, unit_index, 1 FROM n WHERE contains(' ' || x, ' zwangsgeld')) GROUP BY ALL) SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY source, unit_index) AS place FROM m",
    "outline": WHOLE + r""", b AS (SELECT norm_id, version_id, block_index, CAST(j AS JSON) AS j FROM whole), o AS (SELECT norm_id, version_id, block_index, -1 AS c, j AS x FROM b UNION ALL SELECT norm_id, version_id, block_index, unnest(range(0, len(ch))), unnest(ch) FROM (SELECT norm_id, version_id, block_index, CAST(j -> '$.children' AS JSON[]) AS ch FROM b WHERE json_type(j, '$.children') = 'ARRAY')),
e AS (SELECT norm_id, version_id, block_index, c, json_extract_string(x, '$.label') AS l, json_extract_string(x, '$.title') AS t FROM o) SELECT norm_id, version_id, count(*) AS entries, CAST(max(CASE WHEN c < 0 THEN 0 ELSE 1 END) AS INTEGER) AS deepest, md5(string_agg(concat_ws(' ', l, t), chr(10) ORDER BY block_index, c)) AS outline FROM e WHERE coalesce(l, t) IS NOT NULL GROUP BY ALL""",
    "annex_assignment": "WITH k AS (SELECT doc_id, doc_type, list_last(list_filter(string_split(" + _NORM("split_part(text, chr(10), 1)") + ", ' '), lambda x: x <> '')) AS key FROM documents WHERE length(text) > 0), m AS (SELECT key, min(doc_id) AS main FROM k WHERE doc_type = 'norm_text' AND key IS NOT NULL GROUP BY key HAVING count(DISTINCT doc_id) = 1) SELECT doc_id, main FROM k LEFT JOIN m USING (key) WHERE doc_type IN ('contents', 'tariff') AND key IS NOT NULL",
}
