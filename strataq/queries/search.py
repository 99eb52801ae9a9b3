"""Text functions and full-text search."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from strataq.functions import text as tx
from strataq.operators import bulk_search as bs
from strataq.operators import search_index as si
from strataq.plans import search as ps
from strataq.plans.search import build_plan, normalise
from strataq.queries.temporal import norms_now, versions_now
from strataq.session import kept_path, spread, table

REQUESTS = {
    "register": "Verzeichnis Forstfläche", "penalty": "Zwangsgeld Planungsstelle", "prefix": "Einwendungen Kirchen", "title": "Verordnung Kitanutzung", "english": "harbour permit",
    "fallback": "Gebührenverzeichnis Hundert", "spelling": "Kuestenschutz Gebuehren", "identity": "Verordnung über die Kitanutzung", "early prefix": "Kirch* Beteiligten", "one": "Forstfläche",
}
#: Requests with phrases and structural addresses, alone and with words.
ADDRESSES = {
    "phrase": "„im öffentlichen Interesse“ Lärmaufsicht", "phrase alone": '"bei geringer Bedeutung"', "paragraph": "§ 3 Absatz 2", "paragraph and title": "§ 1 Verordnung", "paragraph and text": "§ 3 Zwangsgeld",
    "list": "§§ 1, 3", "number": "Nr. 2.1", "subsection": "Absatz 7 Satzung", "nowhere": "§ 991 Satzung",
}


_KEPT: dict[tuple, si.SearchIndex] = {}


def kept_index(spark, d):
    """The index of the documents, written once per state of the table and application, then looked up."""
    path = kept_path(spark, f"{d}/documents.parquet", "search-index")
    if path not in _KEPT:
        _KEPT[path] = si.keep_index(si.index_of(spread(table(spark, d, "documents"))), path)
    return _KEPT[path]


def normalize_text(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(tx.normalise(F.col("text"))).alias("normalised"), F.size(tx.words(F.col("text"))).alias("n_words"))


def spelling_variants(spark, d):
    t = norms_now(spark, d, "short_title").select("short_title").where("short_title RLIKE '^[A-Za-zÄÖÜäöüß -]*$'").distinct()
    return t.select("short_title", F.array_join(tx.variants(F.col("short_title")), "|").alias("variants"))


def sort_key_index_letter(spark, d):
    return table(spark, d, "part").select("p_partkey", tx.sort_key(F.col("p_name")).alias("sort_key"), tx.index_letter(F.col("p_name")).alias("letter"))


def slugify(spark, d):
    return table(spark, d, "customer").select("c_custkey", tx.slug(F.concat_ws(" ", "c_name", "c_mktsegment")).alias("slug"))


def identity_fallback(spark, d):
    """Identity of a version with fallback to its norm; a blank summary is none."""
    v = versions_now(spark, d, "title", "short_title", "abbr")
    n = norms_now(spark, d, "title", "short_title", "abbr", "summary")
    n = n.select(F.col("id").alias("norm_id"), *[F.col(c).alias("n_" + c) for c in ("title", "short_title", "abbr", "summary")])
    j = v.join(n, "norm_id")
    return j.select("norm_id", "version_id", F.coalesce("title", "n_title").alias("title"), F.coalesce("short_title", "title", "n_short_title", "n_title").alias("short_title"), F.coalesce("abbr", "n_abbr").alias("abbr"), F.nullif(F.trim("n_summary"), F.lit("")).alias("summary"))


def aliases(spark, d):
    """Titles of other versions that are not the norm's own."""
    v = versions_now(spark, d, "title", "short_title").select("norm_id", F.explode(F.array("title", "short_title")).alias("name")).where("name IS NOT NULL").distinct()
    n = norms_now(spark, d, "title", "short_title").select(F.col("id").alias("norm_id"), F.col("title").alias("t"), F.col("short_title").alias("s"))
    return v.join(n, "norm_id").where("NOT (name <=> t) AND NOT (name <=> s)").select("norm_id", F.col("name").alias("alias"))


def structural_labels(spark, d):
    doc = table(spark, d, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("(?m)^§ \\d+[a-z]?"), F.lit(0))).alias("label"))
    return doc.select("doc_id", "label", tx.structural_number(F.col("label")).alias("number")).distinct()


def phrase_contains(spark, d):
    hay = F.concat(F.lit(" "), tx.normalise(F.col("text")), F.lit(" "))
    return table(spark, d, "documents").where(F.instr(hay, " " + normalise("bei geringer Bedeutung") + " ") > 0).select("doc_id")


def token_contains(spark, d):
    t = table(spark, d, "documents").select("doc_id", tx.padded(F.col("text")).alias("t"))
    return t.select("doc_id", tx.contains_any(F.col("t"), ["strassen"], True).alias("as_prefix"), tx.contains_any(F.col("t"), ["kitanutzung"]).alias("as_word"))


def conjunct_intersection(spark, d):
    """Documents that hold every word, each in some unit, in one pass."""
    want = ["zwangsgeld", "vorschriften", "eigentumer"]
    u = si.units_of(spread(table(spark, d, "documents"))).select("doc_id", F.explode(F.array_intersect(tx.words(F.col("body")), F.array(*map(F.lit, want)))).alias("w"))
    return u.groupBy("doc_id").agg(F.countDistinct("w").alias("n")).where(F.col("n") == len(want)).select("doc_id")


def search_snippet(spark, d):
    u = si.units_of(spread(table(spark, d, "documents"))).where("unit_index > 0")
    return u.select("doc_id", "unit_index", tx.snippet(F.lit(""), F.col("heading"), F.col("body"), 120).alias("snippet"))


def word_postings(spark, d):
    p = si.postings(spread(table(spark, d, "documents")), ["doc_id"], "text")
    return p.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


def _docs(spark, d):
    return spread(table(spark, d, "documents")).select("doc_id", F.substring_index(F.coalesce("text", F.lit("")), "\n", 1).alias("title"), F.coalesce("text", F.lit("")).alias("body"))


def _words(name):
    return [t.normalised for t in build_plan(REQUESTS[name]).tokens]


def bm25_search(spark, d):
    return si.bm25(_docs(spark, d), {n: _words(n) for n in ("register", "penalty", "english")})


def _hits(spark, d, queries, mode="and-first", scope="all", with_scores=False):
    return si.search(kept_index(spark, d), si.request_table(spark, queries, mode, scope), with_scores)


def search_and_first(spark, d):
    return _hits(spark, d, REQUESTS).where("strict").select("request", "doc_id")


def search_match_kinds(spark, d):
    return _hits(spark, d, REQUESTS | ADDRESSES).select("request", "doc_id", "kind", "strict", "best_unit", F.concat_ws(",", "rank").alias("rank"))


def search_or_prefix(spark, d):
    """Words anywhere in a document, all longer ones as beginnings."""
    return _hits(spark, d, REQUESTS | ADDRESSES, "or-prefix").select("request", "doc_id", "kind")


def search_scopes(spark, d):
    """The same requests within titles and within texts only."""
    return reduce(lambda a, b: a.unionByName(b), [_hits(spark, d, REQUESTS, scope=scope).select(F.lit(scope).alias("scope"), "request", "doc_id", "kind") for scope in ("title", "body")])


def search_ranked(spark, d):
    """Kinds and rank first, then the score; ten hits a request, and how many there are."""
    return si.ranked(_hits(spark, d, REQUESTS, with_scores=True), 10)


def search_page(spark, d):
    """The second page of five."""
    return si.ranked(_hits(spark, d, REQUESTS, with_scores=True), 5, 5)


def search_facets(spark, d):
    m = _hits(spark, d, REQUESTS).join(table(spark, d, "documents").select("doc_id", "doc_type"), "doc_id")
    return m.groupBy("request", "doc_type").agg(F.count("*").alias("n"))


_INTENTS = ["§ 5", "§§ 1, 2a und 3", "§ 7 Abs. 2", "Art. IV", "Artikel 12a Absatz 3", "Artikel vom Mai", "Nr. 2.3", "Ziffer 4", "§ 1 Nr. 2", "Absatz 9", "§ 74 Absatz 4 und § 79 Absatz 1", "Nr. 123", "kein Paragraph", "§", "§5b"]


def structural_intents(spark, d):
    """Addresses that requests hold, in order."""
    requests = si.request_table(spark, {q: q for q in _INTENTS})
    return si.parse_requests(requests).select("request", F.inline("addresses")).select("request", F.col("number_of").alias("place"), "kind", "number", "subsection")


def _golden(spark, d):
    """Requests made from the documents: every title, and with each document's second unit its heading and the title's last word."""
    u = si.units_of(table(spark, d, "documents").where("doc_type = 'norm_text'"))
    words = F.regexp_extract_all("title", F.lit("[\\p{L}\\p{N}]+"), F.lit(0))
    heading = F.regexp_replace("heading", "^§ \\d+[a-z]? ", "")
    titles = u.where("unit_index = 0 AND title != ''").select(F.lit("title").alias("class"), F.col("title").alias("query"), "doc_id")
    headings = u.where("unit_index = 1").where(F.size(words) > 0).select(F.lit("heading").alias("class"), F.concat_ws(" ", heading, F.get(words, F.size(words) - 1)).alias("query"), "doc_id")
    return titles.unionByName(headings).withColumn("query", tx.short_request(F.col("query")))


def golden_positions(spark, d):
    """class, request (a hash of its text), first position of a document that it was made from among the ten best hits, null if none. Requests without words find nothing."""
    asked = _golden(spark, d).withColumn("request", F.md5("query"))
    requests = asked.where(F.size(tx.words(F.col("query"))) > 0).select("request", "query").dropDuplicates(["request"])
    top = bs.first_hits(spread(table(spark, d, "documents").select("doc_id", "text")), requests, 10)
    return asked.select("class", "request", "doc_id").join(top, ["request", "doc_id"], "left").groupBy("class", "request").agg(F.min("position").alias("position"))


def batch_golden_metrics(spark, d):
    """Recall within ten, mean reciprocal rank and share of first places, by class of request; all requests in one plan."""
    p = golden_positions(spark, d)
    hit = F.coalesce(1 / F.col("position"), F.lit(0.0))
    return p.groupBy("class").agg(F.count("*").alias("n"), F.round(F.avg(F.col("position").isNotNull().cast("int")), 6).alias("recall10"), F.round(F.avg(hit), 6).alias("mrr"), F.round(F.avg(F.coalesce((F.col("position") == 1).cast("int"), F.lit(0))), 6).alias("top1"))


def search_audit(spark, d):
    """How many requests find their document first, among ten, or not, by class."""
    v = F.when(F.col("position") == 1, "first").when(F.col("position").isNotNull(), "found").otherwise("missed")
    return golden_positions(spark, d).groupBy("class", v.alias("verdict")).agg(F.count("*").alias("n"))


def index_integrity(spark, d):
    """The kept index against the documents with some of them changed, added and removed: what it would have to take over."""
    return si.integrity(kept_index(spark, d), _edited(spark, d)).groupBy("finding").agg(F.count("*").alias("n"))


def _edited(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    changed = docs.where("doc_id % 11 != 0").withColumn("text", F.when(F.col("doc_id") % 7 == 0, F.concat(F.coalesce("text", F.lit("")), F.lit(" zusatz"))).otherwise(F.col("text")))
    return changed.unionByName(docs.where("doc_id % 13 = 0").withColumn("doc_id", F.col("doc_id") + 1_000_000_000))


def index_maintenance(spark, d):
    """Words of the index after the changes are taken over, with their documents: those of an index made anew."""
    docs, edited = table(spark, d, "documents").select("doc_id", "text"), _edited(spark, d)
    old, new = docs.withColumnRenamed("text", "before"), edited.withColumnRenamed("text", "after")
    both = old.join(new, "doc_id", "full_outer").where("NOT before <=> after OR before IS NULL OR after IS NULL")
    gone = old.join(new, "doc_id", "left_anti").select("doc_id")
    more = edited.join(both.select("doc_id"), "doc_id", "left_semi")
    return si.changed_index(kept_index(spark, d), more, gone).terms


def _norm(c: str) -> str:
    return f"trim(regexp_replace(replace(strip_accents(lower({c})), 'ß', 'ss'), '[^a-z0-9*]+', ' ', 'g'))"


_U = f"WITH u0 AS (SELECT doc_id, split_part(text, chr(10), 1) AS title, string_split_regex(text, '\\n\\n+') AS parts FROM documents), u AS (SELECT doc_id, title, unnest(range(0, len(parts))) AS unit_index, unnest(parts) AS body FROM u0), n AS (SELECT doc_id, unit_index, body, {_norm('title')} AS t, {_norm('body')} AS x FROM u) "


def _values(rows, name, cols):
    lit = lambda v: "NULL" if v is None else str(v) if isinstance(v, (int, bool)) else "[" + ", ".join(f"'{x}'" for x in v) + "]::VARCHAR[]" if isinstance(v, list) else "'" + v.replace("'", "''") + "'"
    return f"{name} AS (SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows) + f") v({cols}))"


_UNIT_ADDRESS = r"""CASE WHEN regexp_matches(body, '^§+\s*\d+[a-z]?([^\p{L}\p{N}]|$)') THEN 'paragraph' WHEN regexp_matches(body, '^(Artikel|Art\.?)\s+(\d+[a-z]?|[IVXLC]+)([^\p{L}\p{N}]|$)') THEN 'article' WHEN regexp_matches(body, '^(Nr\.|Nummer|Ziffer)\s*\d') OR regexp_matches(body, '^\d{1,2}(\.\d{1,2})+') THEN 'number' END AS kind,
lower(CASE WHEN regexp_matches(body, '^§+\s*\d+[a-z]?([^\p{L}\p{N}]|$)') THEN regexp_extract(body, '^§+\s*(\d+[a-z]?)', 1) WHEN regexp_matches(body, '^(Artikel|Art\.?)\s+(\d+[a-z]?|[IVXLC]+)([^\p{L}\p{N}]|$)') THEN regexp_extract(body, '^(?:Artikel|Art\.?)\s+(\d+[a-z]?|[IVXLC]+)', 1) ELSE regexp_extract(body, '^(?:Nr\.|Nummer|Ziffer)?\s*(\d{1,2}(?:\.\d{1,2})*)', 1) END) AS number,
regexp_extract_all(body, '(?m)^\((\d+[a-z]?)\)', 1) AS subs"""


def _patterns(plan):
    """(slot, narrow pattern, wide pattern, word, may grow) of every spelling."""
    out = []
    for k, (t, w) in enumerate(zip(plan.tokens, plan.wide)):
        out += [(k, f" {v}" + ("" if t.prefix else " "), f" {v}" + ("" if w else " "), v, w) for v in t.variants]
    for k, p in enumerate(plan.phrases, len(plan.tokens)):
        out += [(k, f" {v} ", f" {v} ", v, False) for v in ps.variants(p)]
    return out


def _sql_hits(queries, mode="and-first", scope="all") -> str:
    """Common table expressions that end in hits(request, doc_id, kind, strict, best_unit, tier, r2, r3)."""
    plans = {n: build_plan(q, mode, scope) for n, q in queries.items()}
    q = [(n, *x) for n, p in plans.items() for x in _patterns(p)]
    a = [(n, k, x.kind, x.number, x.subsection) for n, p in plans.items() for k, x in enumerate(p.addresses)] or [("-", 0, "-", "-", "-")]
    meta = [(n, len(p.tokens) + len(p.phrases), len(p.addresses), p.identity, p.subject, p.subject[0] if p.subject else "") for n, p in plans.items()]
    tables = ", ".join([_values(q, "q", "request, slot, np, wp, word, wide"), _values(a, "aq", "request, k, kind, number, sub"), _values(meta, "meta", "request, n_slots, n_addr, ident, subj, subj_text")])
    return (_U.rstrip() + ", " + tables + _HITS).replace("@scope", scope).replace("@mode", mode)


_HITS = f""",
row_text AS (SELECT doc_id, -1 AS unit, ' ' || {_norm("split_part(coalesce(text, ''), chr(10), 1)")} || ' ' AS x FROM documents UNION ALL SELECT doc_id, unit_index, ' ' || x || ' ' FROM n),
m AS (SELECT request, slot, doc_id, unit, bool_or(contains(x, np)) AS s FROM row_text, q WHERE contains(x, wp) GROUP BY ALL),
td AS (SELECT request, doc_id, list(DISTINCT slot) FILTER (s) AS tn, list(DISTINCT slot) AS tw FROM m WHERE unit = -1 GROUP BY ALL),
ud AS (SELECT request, doc_id, unit, list(DISTINCT slot) FILTER (s) AS un, list(DISTINCT slot) AS uw FROM m WHERE unit >= 0 GROUP BY ALL),
pd AS (SELECT request, doc_id, count(DISTINCT slot) AS aw, count(DISTINCT slot) FILTER (unit >= 0) AS bw FROM m GROUP BY ALL),
bu AS (SELECT ud.request, ud.doc_id, min(unit) FILTER (len(un) = n_slots) AS best, bool_or(len(list_distinct(list_concat(CASE WHEN '@scope' = 'all' THEN coalesce(tn, []) ELSE [] END, coalesce(un, [])))) = n_slots) AS narrow FROM ud JOIN meta USING (request) LEFT JOIN td ON td.request = ud.request AND td.doc_id = ud.doc_id GROUP BY ALL),
ua AS (SELECT doc_id, unit_index, {_UNIT_ADDRESS} FROM u),
uk AS (SELECT doc_id, unit_index, kind, number, subs FROM ua WHERE kind IS NOT NULL UNION ALL SELECT doc_id, unit_index, 'subsection', unnest(list_distinct(subs)), subs FROM ua),
refs AS (SELECT request, doc_id, min(unit_index) AS ref FROM (SELECT aq.request, doc_id, unit_index, n_addr FROM aq JOIN meta USING (request) JOIN uk ON uk.kind = aq.kind AND uk.number = aq.number AND (sub IS NULL OR list_contains(subs, sub)) GROUP BY ALL HAVING count(DISTINCT k) = n_addr) GROUP BY ALL),
b0 AS (SELECT request, doc_id FROM pd UNION SELECT request, doc_id FROM refs),
b1 AS (SELECT b0.request, b0.doc_id, n_slots, n_addr, ident, subj, subj_text, ref, best, coalesce(len(tn) = n_slots, false) AND n_slots > 0 AS in_title, coalesce(len(tw), 0) AS ntw, coalesce(aw, 0) AS aw, coalesce(bw, 0) AS bw, coalesce(narrow, false) AS narrow,
trim(t.x) AS title_key, d.title AS title
FROM b0 JOIN meta USING (request) LEFT JOIN refs ON refs.request = b0.request AND refs.doc_id = b0.doc_id LEFT JOIN pd ON pd.request = b0.request AND pd.doc_id = b0.doc_id LEFT JOIN td ON td.request = b0.request AND td.doc_id = b0.doc_id LEFT JOIN bu ON bu.request = b0.request AND bu.doc_id = b0.doc_id
JOIN row_text t ON t.doc_id = b0.doc_id AND t.unit = -1 JOIN (SELECT doc_id, split_part(coalesce(text, ''), chr(10), 1) AS title FROM documents) d ON d.doc_id = b0.doc_id),
b2 AS (SELECT *, CASE WHEN n_slots = 0 THEN true WHEN '@scope' = 'title' THEN in_title WHEN '@scope' = 'body' THEN narrow ELSE narrow OR in_title END AS strict, CASE WHEN n_slots = 0 THEN true WHEN '@scope' = 'title' THEN ntw = n_slots WHEN '@scope' = 'body' THEN bw = n_slots ELSE aw = n_slots END AS relaxed FROM b1 WHERE n_addr = 0 OR ref IS NOT NULL),
b3 AS (SELECT *, bool_or(strict) OVER (PARTITION BY request) AS any_strict FROM b2),
b4 AS (SELECT *, list_has_any(@forms, ident) AS same, list_has_any(@forms, subj) AS by_subject FROM b3 WHERE CASE WHEN '@mode' = 'and-first' AND any_strict THEN strict ELSE relaxed END),
b5 AS (SELECT *, CASE WHEN same THEN 0 WHEN ref IS NOT NULL AND (in_title OR n_slots = 0) THEN 1 WHEN in_title THEN 2 WHEN ref IS NOT NULL THEN 3 WHEN best IS NOT NULL THEN 4 WHEN n_slots > 0 THEN 5 ELSE 6 END AS tier FROM b4),
hits AS (SELECT request, doc_id, strict, coalesce(ref, best) AS best_unit, tier, CASE tier WHEN 0 THEN 'identity' WHEN 1 THEN 'reference' WHEN 2 THEN 'title' WHEN 3 THEN 'reference' WHEN 4 THEN 'unit' WHEN 5 THEN 'body' ELSE 'browse' END AS kind,
CASE tier WHEN 0 THEN CASE WHEN title_key = ident[1] THEN 0 ELSE 1 END WHEN 1 THEN CASE WHEN in_title THEN 0 ELSE 1 END WHEN 2 THEN CASE WHEN contains(title_key, subj_text) THEN 0 ELSE 1 END WHEN 4 THEN best ELSE 0 END AS r2, CASE WHEN tier = 1 AND NOT by_subject THEN 1 ELSE 0 END AS r3 FROM b5) """

_SCORES = f""",
wd AS (SELECT doc_id, -1 AS unit, string_split(trim(x), ' ') AS w, 0 AS nh FROM row_text WHERE unit = -1 UNION ALL SELECT doc_id, unit_index, string_split(x, ' '), CASE WHEN contains(body, chr(10)) THEN len(list_filter(string_split({_norm("split_part(body, chr(10), 1)")}, ' '), lambda y: y <> '')) ELSE 0 END FROM n),
oc AS (SELECT doc_id, unit, term, CASE WHEN unit = -1 THEN 10 WHEN p <= nh THEN 2 ELSE 1 END AS weight FROM (SELECT doc_id, unit, nh, unnest(w) AS term, unnest(range(1, len(w) + 1)) AS p FROM wd) WHERE term <> ''),
tf AS (SELECT doc_id, term, sum(weight) AS f FROM oc GROUP BY ALL), dfr AS (SELECT term, count(*) AS docs FROM tf GROUP BY term),
dlen AS (SELECT d.doc_id, coalesce(sum(c), 0) AS dl FROM documents d LEFT JOIN (SELECT doc_id, len(list_filter(w, lambda y: y <> '')) AS c FROM wd) k ON k.doc_id = d.doc_id GROUP BY ALL), st AS (SELECT count(*) AS nd, avg(dl) AS al FROM dlen),
qt AS (SELECT DISTINCT request, slot, term FROM q JOIN dfr ON CASE WHEN wide THEN starts_with(term, word) ELSE term = word END),
sn AS (SELECT request, slot, sum(docs) AS n FROM (SELECT request, slot, docs FROM q JOIN dfr ON CASE WHEN wide THEN starts_with(term, word) ELSE term = word END) GROUP BY ALL),
sf AS (SELECT request, slot, doc_id, sum(f) AS f FROM qt JOIN tf USING (term) GROUP BY ALL),
scored AS (SELECT request, doc_id, round(-sum((CASE WHEN n < nd THEN greatest(ln((nd - n + 0.5) / (n + 0.5)), 1e-6) ELSE 1e-6 END) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * dl / al))), 6) AS score FROM sf JOIN sn USING (request, slot) JOIN dlen USING (doc_id), st GROUP BY request, doc_id),
placed AS (SELECT hits.request, hits.doc_id, kind, row_number() OVER (PARTITION BY hits.request ORDER BY least(tier, 4), CASE WHEN tier <= 3 THEN r2 ELSE 0 END, CASE WHEN tier <= 3 THEN r3 ELSE 0 END, CASE WHEN tier > 3 THEN score END NULLS LAST, hits.doc_id) AS position, count(*) OVER (PARTITION BY hits.request) AS total FROM hits LEFT JOIN scored ON scored.request = hits.request AND scored.doc_id = hits.doc_id) """


_W = f"CASE WHEN {_norm('text')} = '' THEN [] ELSE string_split({_norm('text')}, ' ') END"


def _sql_bm25(names) -> str:
    """Common table expressions that end in scored(request, doc_id, score)."""
    return f"""dd AS (SELECT doc_id, string_split({_norm("split_part(coalesce(text, ''), chr(10), 1)")}, ' ') AS tw, string_split({_norm("coalesce(text, '')")}, ' ') AS bw FROM documents),
dc AS (SELECT doc_id, list_filter(tw, lambda x: x <> '') AS tw, list_filter(bw, lambda x: x <> '') AS bw FROM dd),
dl AS (SELECT doc_id, tw, bw, len(tw) + len(bw) AS dl FROM dc), st AS (SELECT count(*) AS nd, avg(dl) AS al FROM dl),
h AS (SELECT doc_id, dl, term, sum(w) AS f FROM (SELECT doc_id, dl, unnest(tw) AS term, 10 AS w FROM dl UNION ALL SELECT doc_id, dl, unnest(bw), 1 FROM dl) GROUP BY ALL),
df AS (SELECT term, count(*) AS n FROM h GROUP BY term),
q AS (SELECT DISTINCT * FROM (VALUES {", ".join(f"('{n}', '{w}')" for n in names for w in _words(n))}) v(request, term)),
scored AS (SELECT request, doc_id, round(-sum(greatest(ln((nd - n + 0.5) / (n + 0.5)), 1e-6) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * dl / al))), 6) AS score FROM h JOIN q USING (term) JOIN df USING (term), st GROUP BY request, doc_id) """


_LN = "WITH lv AS (SELECT * FROM law_versions QUALIFY row_number() OVER (PARTITION BY norm_id, version_id ORDER BY updated_at DESC) = 1), ln AS (SELECT * FROM law_norms QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) = 1) "


def _v(c: str) -> str:
    keep = lambda x: f"trim(regexp_replace(strip_accents(lower({x})), '[^a-z0-9ß*]+', ' ', 'g'))"
    chain = lambda x, ps: __import__("functools").reduce(lambda s, p: f"replace({s}, '{p[0]}', '{p[1]}')", ps, x)
    out = _norm(chain(c, tx.UMLAUTS))
    back = _norm(chain(c, [(b, a) for a, b in tx.UMLAUTS] + [("AE", "Ä"), ("OE", "Ö"), ("UE", "Ü")]))
    sharp = keep(f"regexp_replace({c}, '(?i)ss', 'ß', 'g')")
    return f"[{_norm(c)}, {keep(c)}, {out}, CASE WHEN regexp_matches({c}, '(?i)[aou]e') THEN {back} END, CASE WHEN regexp_matches({c}, '(?i)ss') THEN {sharp} END]"


_HITS = _HITS.replace("@forms", f"list_filter({_v('title')}, lambda y: y <> '')")

#: Plans of requests that are made from the documents, as tables like those of _sql_hits.
_GOLDEN = _U.rstrip() + f""",
nt AS (SELECT u.* FROM u JOIN documents d ON d.doc_id = u.doc_id WHERE doc_type = 'norm_text'),
asked AS (SELECT class, CASE WHEN length(q) <= 200 THEN q ELSE regexp_replace(left(q, 200), ' [^ ]*$', '') END AS query, doc_id FROM (SELECT class, trim(regexp_replace(query, '\\s+', ' ', 'g')) AS q, doc_id FROM (SELECT 'title' AS class, title AS query, doc_id FROM nt WHERE unit_index = 0 AND title <> '' UNION ALL SELECT 'heading', regexp_replace(split_part(body, chr(10), 1), '^§ \\d+[a-z]? ', '') || ' ' || list_last(regexp_extract_all(title, '[\\p{{L}}\\p{{N}}]+')), doc_id FROM nt WHERE unit_index = 1 AND len(regexp_extract_all(title, '[\\p{{L}}\\p{{N}}]+')) > 0))),
rq AS (SELECT DISTINCT query AS request FROM asked),
rw AS (SELECT request, unnest(w) AS raw, unnest(range(1, len(w) + 1)) AS i FROM (SELECT request, regexp_extract_all(request, '[\\p{{L}}\\p{{N}}]+') AS w FROM rq)),
rt AS (SELECT request, nw, min(i) AS i, arg_min(raw, i) AS raw FROM (SELECT request, raw, i, {_norm('raw')} AS nw FROM rw) WHERE nw <> '' GROUP BY ALL),
rs AS (SELECT request, nw, raw, row_number() OVER (PARTITION BY request ORDER BY i) - 1 AS slot, count(*) OVER (PARTITION BY request) AS k, length(nw) >= 4 AND NOT regexp_full_match(nw, '\\d+') AND nw NOT IN ({", ".join(f"'{w}'" for w in sorted(ps.SMALL_WORDS))}) AS wide FROM rt),
q AS (SELECT request, slot, ' ' || word || CASE WHEN wide AND slot = k - 1 THEN '' ELSE ' ' END AS np, ' ' || word || CASE WHEN wide THEN '' ELSE ' ' END AS wp, word, wide FROM (SELECT request, slot, k, wide, unnest(list_distinct(list_filter({_v('raw')}, lambda y: y <> ''))) AS word FROM rs)),
aq AS (SELECT '-' AS request, 0 AS k, '-' AS kind, '-' AS number, NULL::VARCHAR AS sub WHERE false),
meta AS (SELECT request, (SELECT count(*) FROM rs WHERE rs.request = rq.request) AS n_slots, 0 AS n_addr, list_filter({_v('request')}, lambda y: y <> '') AS ident, list_filter({_v('request')}, lambda y: y <> '') AS subj, {_norm('request')} AS subj_text FROM rq)""" + _HITS.replace("@scope", "all").replace("@mode", "and-first") + _SCORES + """,
found AS (SELECT class, asked.query, min(position) FILTER (position <= 10) AS position FROM asked LEFT JOIN placed ON placed.request = asked.query AND placed.doc_id = asked.doc_id GROUP BY ALL) """

_EDITED = "WITH edited AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN coalesce(text, '') || ' zusatz' ELSE text END AS text FROM documents WHERE doc_id % 11 <> 0 UNION ALL SELECT doc_id + 1000000000, text FROM documents WHERE doc_id % 13 = 0) "

QUERIES = {
    f.__name__: f
    for f in (
        normalize_text, spelling_variants, sort_key_index_letter, slugify, identity_fallback, aliases, structural_labels, phrase_contains, token_contains, conjunct_intersection, search_snippet, word_postings, bm25_search,
        search_and_first, search_match_kinds, search_or_prefix, search_scopes, search_ranked, search_page, search_facets, structural_intents, batch_golden_metrics, search_audit, index_integrity, index_maintenance,
    )
}

SQL = {
    "normalize_text": f"SELECT doc_id, md5({_norm('text')}) AS normalised, len({_W}) AS n_words FROM documents",
    "spelling_variants": _LN + f", s AS (SELECT DISTINCT short_title FROM ln WHERE regexp_full_match(short_title, '[A-Za-zÄÖÜäöüß -]*')), v AS (SELECT short_title, {_v('short_title')} AS a FROM s) SELECT short_title, array_to_string(list_filter(a, lambda x, i: x <> '' AND list_position(a, x) = i), '|') AS variants FROM v",
    "sort_key_index_letter": "SELECT p_partkey, trim(regexp_replace(lower(replace(strip_accents(p_name), 'ß', 'ss')), '[^a-z0-9]+', ' ', 'g')) AS sort_key, CASE WHEN regexp_full_match(upper(left(trim(p_name), 1)), '[A-Z]') THEN upper(left(trim(p_name), 1)) ELSE '#' END AS letter FROM part",
    "slugify": "SELECT c_custkey, trim(regexp_replace(lower(c_name || ' ' || c_mktsegment), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM customer",
    "identity_fallback": _LN + "SELECT lv.norm_id, lv.version_id, coalesce(lv.title, ln.title) AS title, coalesce(lv.short_title, lv.title, ln.short_title, ln.title) AS short_title, coalesce(lv.abbr, ln.abbr) AS abbr, nullif(trim(ln.summary), '') AS summary FROM lv JOIN ln ON ln.id = lv.norm_id",
    "aliases": _LN + ", a AS (SELECT DISTINCT norm_id, unnest([title, short_title]) AS name FROM lv) SELECT a.norm_id, name AS alias FROM a JOIN ln ON ln.id = a.norm_id WHERE name IS NOT NULL AND name IS DISTINCT FROM title AND name IS DISTINCT FROM short_title",
    "structural_labels": "SELECT DISTINCT doc_id, label, regexp_extract(label, '([0-9]+[a-z]?)', 1) AS number FROM (SELECT doc_id, unnest(regexp_extract_all(text, '(?m)^§ \\d+[a-z]?')) AS label FROM documents)",
    "phrase_contains": f"SELECT doc_id FROM documents WHERE contains(' ' || {_norm('text')} || ' ', ' bei geringer bedeutung ')",
    "token_contains": f"SELECT doc_id, contains(' ' || {_norm('text')} || ' ', ' strassen') AS as_prefix, contains(' ' || {_norm('text')} || ' ', ' kitanutzung ') AS as_word FROM documents",
    "conjunct_intersection": _U + "SELECT doc_id FROM n GROUP BY doc_id HAVING bool_or(contains(' ' || x || ' ', ' zwangsgeld ')) AND bool_or(contains(' ' || x || ' ', ' vorschriften ')) AND bool_or(contains(' ' || x || ' ', ' eigentumer '))",
    "word_postings": f"SELECT term, count(*) AS df, sum(tf) AS cf FROM (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_W}) AS term FROM documents) GROUP BY ALL) GROUP BY term",
    "bm25_search": "WITH " + _sql_bm25(["register", "penalty", "english"]) + "SELECT request, doc_id, score FROM scored",
    "search_ranked": _sql_hits(REQUESTS) + _SCORES + "SELECT * FROM placed WHERE position <= 10",
    "search_page": _sql_hits(REQUESTS) + _SCORES + "SELECT * FROM placed WHERE position BETWEEN 6 AND 10",
    "search_and_first": _sql_hits(REQUESTS) + "SELECT request, doc_id FROM hits WHERE strict",
    "search_match_kinds": _sql_hits(REQUESTS | ADDRESSES) + "SELECT request, doc_id, kind, strict, best_unit, tier || ',' || r2 || ',' || r3 AS rank FROM hits",
    "search_or_prefix": _sql_hits(REQUESTS | ADDRESSES, "or-prefix") + "SELECT request, doc_id, kind FROM hits",
    "search_scopes": "SELECT * FROM (" + _sql_hits(REQUESTS, scope="title") + "SELECT 'title' AS scope, request, doc_id, kind FROM hits) UNION ALL SELECT * FROM (" + _sql_hits(REQUESTS, scope="body") + "SELECT 'body', request, doc_id, kind FROM hits)",
    "search_facets": _sql_hits(REQUESTS) + "SELECT request, doc_type, count(*) AS n FROM hits JOIN documents USING (doc_id) GROUP BY ALL",
    "structural_intents": "SELECT * FROM (VALUES ('§ 5', 0, 'paragraph', '5', NULL), ('§§ 1, 2a und 3', 0, 'paragraph', '1', NULL), ('§§ 1, 2a und 3', 1, 'paragraph', '2a', NULL), ('§§ 1, 2a und 3', 2, 'paragraph', '3', NULL), ('§ 7 Abs. 2', 0, 'paragraph', '7', '2'), ('Art. IV', 0, 'article', 'iv', NULL), ('Artikel 12a Absatz 3', 0, 'article', '12a', '3'), ('Nr. 2.3', 0, 'number', '2.3', NULL), ('Ziffer 4', 0, 'number', '4', NULL), ('§ 1 Nr. 2', 0, 'paragraph', '1', NULL), ('Absatz 9', 0, 'subsection', '9', NULL), ('§ 74 Absatz 4 und § 79 Absatz 1', 0, 'paragraph', '74', '4'), ('§ 74 Absatz 4 und § 79 Absatz 1', 1, 'paragraph', '79', '1'), ('§5b', 0, 'paragraph', '5b', NULL)) v(request, place, kind, number, subsection)",
    "batch_golden_metrics": _GOLDEN + "SELECT class, count(*) AS n, round(avg(CASE WHEN position IS NOT NULL THEN 1 ELSE 0 END), 6) AS recall10, round(avg(coalesce(1 / position, 0)), 6) AS mrr, round(avg(CASE WHEN position = 1 THEN 1 ELSE 0 END), 6) AS top1 FROM found GROUP BY class",
    "search_audit": _GOLDEN + "SELECT class, CASE WHEN position = 1 THEN 'first' WHEN position IS NOT NULL THEN 'found' ELSE 'missed' END AS verdict, count(*) AS n FROM found GROUP BY ALL",
    "index_integrity": _EDITED + f"SELECT CASE WHEN d.doc_id IS NULL THEN 'missing' WHEN e.doc_id IS NULL THEN 'left-over' ELSE 'differs' END AS finding, count(*) AS n FROM documents d FULL JOIN edited e ON e.doc_id = d.doc_id WHERE d.doc_id IS NULL OR e.doc_id IS NULL OR d.text IS DISTINCT FROM e.text GROUP BY ALL",
    "index_maintenance": _EDITED + f"SELECT term, count(*) AS docs FROM (SELECT DISTINCT doc_id, unnest({_W}) AS term FROM edited) GROUP BY term",
}
