"""Comparison, resolution, sampling, fingerprints, audits."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from strataq.functions import text as tx
from strataq.operators import quality as ql
from strataq.operators import resolve as rs
from strataq.operators.blocks import BLOCK_KEYS, assemble_parts, split_parts
from strataq.queries.relational import _LN
from strataq.queries.temporal import norms_now, versions_now
from strataq.session import table


def _summaries(spark, d):
    """norm_id, version_id, words of the summary, words of the next version's summary."""
    w = Window.partitionBy("norm_id").orderBy("version_id")
    v = versions_now(spark, d, "version_json").select("norm_id", "version_id", tx.words(F.get_json_object("version_json", "$.summary")).alias("w"))
    return v.withColumn("nw", F.lead("w").over(w)).where("nw IS NOT NULL")


def token_multiset_diff(spark, d):
    s = _summaries(spark, d)
    keys = ["norm_id", "version_id"]
    diff = ql.multiset_difference(s.select(*keys, F.explode("w").alias("t")), s.select(*keys, F.explode("nw").alias("t")), keys, "t")
    return diff.groupBy(*keys).agg(F.sum("missing").alias("missing"), F.sum("extra").alias("extra"))


def similarity_measures(spark, d):
    s = _summaries(spark, d)
    long = lambda c: F.array_distinct(F.filter(c, lambda x: F.length(x) >= 4))
    a, b = long("w"), long("nw")
    return s.select("norm_id", "version_id", F.round(ql.jaccard(a, b), 6).alias("jaccard"), F.round(ql.containment(a, b), 6).alias("containment"), F.round(ql.overlap(a, b), 6).alias("overlap"))


def text_integrity(spark, d):
    """exact, normalised-equivalent, review or mismatch of successive summaries."""
    s = _summaries(spark, d)
    same, j = F.col("w") == F.col("nw"), ql.jaccard(F.array_distinct("w"), F.array_distinct("nw"))
    return s.select("norm_id", "version_id", F.when(same, "exact").when(F.array_sort("w") == F.array_sort("nw"), "normalised-equivalent").when(j >= 0.7, "review").otherwise("mismatch").alias("klass"))


def stratified_sample(spark, d):
    return ql.stratified_sample(table(spark, d, "documents").select("doc_id", "doc_type"), "doc_id", "doc_type", 100, 5, "audit")


def strided_sample(spark, d):
    return ql.strided_sample(table(spark, d, "customer").select("c_custkey", "c_name"), ["c_custkey"], 40)


def global_positions(spark, d):
    return ql.global_rank(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"])


def percentile_nearest_rank(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(*[F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY l_quantity)").alias(n) for q, n in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99"))], F.max("l_quantity").alias("most"))


def percentile_by_index(spark, d):
    """The value at index floor(q * n) of the sorted values, by counting up a histogram instead of sorting the rows."""
    h = table(spark, d, "lineitem").groupBy("l_returnflag", "l_quantity").agg(F.count("*").alias("c"))
    w = Window.partitionBy("l_returnflag").orderBy("l_quantity")
    h = h.withColumn("upto", F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("n", F.sum("c").over(Window.partitionBy("l_returnflag")))
    at = lambda q: F.min(F.when(F.col("upto") > F.least(F.col("n") - 1, F.floor(F.lit(q) * F.col("n"))), F.col("l_quantity")))
    return h.groupBy("l_returnflag").agg(at(0.5).alias("p50"), at(0.95).alias("p95"))


def coverage_percent(spark, d):
    n = norms_now(spark, d, "jurisdiction", "summary", "abbr", "publication_date", "subjects")
    pct = lambda c: F.round(F.count_if(c) * 1000 / F.count("*"), 0) / 10
    return n.groupBy("jurisdiction").agg(F.count("*").alias("n"), pct(F.col("summary").isNotNull()).alias("summary_pct"), pct(F.col("abbr").isNotNull()).alias("abbr_pct"), pct(F.col("publication_date").isNotNull()).alias("published_pct"), pct(F.size(F.coalesce("subjects", F.array())) > 0).alias("subject_pct"))


def signature_classes(spark, d):
    s = F.regexp_replace(F.regexp_replace("citation", "\\d+", "9"), "Januar|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember", "M")
    return table(spark, d, "law_versions").where("citation IS NOT NULL").groupBy(s.alias("signature")).agg(F.count("*").alias("n"), F.min("citation").alias("example"))


def priority_score_bands(spark, d):
    r = table(spark, d, "feedback_reports").groupBy("id").agg(F.max(F.struct("revision", "category", "status", "priority", "norm_slug", "version_id")).alias("x")).select("id", "x.*")
    score = (
        F.when(F.col("priority") == "P1", 40).when(F.col("priority") == "P2", 20).otherwise(5) + F.when(F.col("category").isin("missing", "wording"), 15).otherwise(0)
        + F.when(F.col("status") == "new", 10).otherwise(0) + F.when(F.col("norm_slug").isNotNull(), 5).otherwise(0) - F.when(F.col("version_id").isNull(), 5).otherwise(0)
    )
    return r.select("id", score.alias("score")).withColumn("band", F.when(F.col("score") >= 60, "A").when(F.col("score") >= 40, "B").when(F.col("score") >= 20, "C").otherwise("D"))


def content_fingerprint(spark, d):
    return norms_now(spark, d, "title", "status", "version_count").select("id", ql.row_fingerprint("title", "status", "version_count").alias("fingerprint"))


def corpus_fingerprint(spark, d):
    return ql.table_fingerprint(norms_now(spark, d, "title", "status", "version_count"), ["id", "title", "status", "version_count"])


def _snapshots(spark, d):
    """Orders, and orders after a fixed set of changes."""
    old = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    new = old.where("o_orderkey % 101 != 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 97 == 0, "X").otherwise(F.col("o_orderstatus")))
    more = old.where("o_orderkey % 103 = 0").withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000)
    return old, new.unionByName(more)


def snapshot_diff(spark, d):
    return ql.snapshot_diff(*_snapshots(spark, d), "o_orderkey", ["o_custkey", "o_orderstatus"])


def incremental_equals_full(spark, d):
    """Rows of the old snapshot with the changes applied: the new snapshot."""
    old, new = _snapshots(spark, d)
    return ql.apply_changes(old, new, ql.snapshot_diff(old, new, "o_orderkey", ["o_custkey", "o_orderstatus"]), "o_orderkey")


def replica_parity(spark, d):
    """Counts and lengths per type of both copies and whether they agree."""
    g = lambda df: df.groupBy("doc_type").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))
    a, b = g(table(spark, d, "documents")), g(table(spark, d, "documents").where("doc_id % 50 != 0"))
    return a.join(b.select("doc_type", F.col("n").alias("n2"), F.col("chars").alias("chars2")), "doc_type", "full_outer").select("doc_type", "n", "n2", (F.col("n").eqNullSafe(F.col("n2")) & F.col("chars").eqNullSafe(F.col("chars2"))).alias("equal"))


def tiered_resolution(spark, d):
    """Documents to norms: by id, else by a title that is unique among the norms, else not."""
    n = norms_now(spark, d, "title").select(F.col("id").alias("nid"), tx.normalise(F.col("title")).alias("key"))
    unique = n.groupBy("key").agg(F.min("nid").alias("by_title"), F.count("*").alias("c")).where("c = 1").drop("c")
    docs = table(spark, d, "documents").select("doc_id", "norm_id", tx.normalise(F.substring_index("text", "\n", 1)).alias("key"))
    ids = n.select(F.col("nid").alias("by_id"))
    j = docs.join(ids, docs["norm_id"] == ids["by_id"], "left").join(unique, "key", "left")
    return j.select("doc_id", F.coalesce("by_id", "by_title").alias("resolved"), F.when(F.col("by_id").isNotNull(), 1).when(F.col("by_title").isNotNull(), 2).otherwise(9).alias("tier"))


def prefix_title_match(spark, d):
    """Titles of at least 25 characters of which one begins the other. Titles that only share a beginning do not meet."""
    n = norms_now(spark, d, "title").select("id", tx.normalise(F.col("title")).alias("k")).where("length(k) >= 25")
    return rs.beginning_pairs(n, "id", "k").select(F.least("id", "other").alias("id"), F.greatest("id", "other").alias("other"))


def reference_frequency(spark, d):
    """How many other titles mention a one-word short title."""
    n = norms_now(spark, d, "title", "short_title")
    words = n.select("id", F.explode(F.array_distinct(tx.tokens(F.col("title")))).alias("w"))
    names = n.where("short_title RLIKE '^[\\\\p{L}]{3,}$'").select(F.col("id").alias("nid"), F.col("short_title").alias("w"))
    return names.join(words, "w").where("nid != id").groupBy("nid").agg(F.count("*").alias("n"))


_RULES = [("r1", "Brand#1", "prefix", None, "core"), ("r2", "Brand#25", "exact", None, "special"), ("r3", "Brand#3", "exact", "PROMO", "promo"), ("r4", "Brand#2", "prefix", "SMALL", "small"), ("r5", "Brand#12", "exact", None, "twelve")]


def _rules(spark):
    return spark.createDataFrame(_RULES, "rule string, pattern string, how string, only_type string, grp string")


def taxonomy_assignment(spark, d):
    """Parts to groups by exact and numeric-prefix rules (a fixed, small table), exact ones first."""
    hit = ((F.col("how") == "exact") & (F.col("p_brand") == F.col("pattern"))) | ((F.col("how") == "prefix") & F.startswith("p_brand", "pattern"))
    j = table(spark, d, "part").join(F.broadcast(_rules(spark)), hit & (F.col("only_type").isNull() | (F.col("only_type") == F.col("p_type"))), "left")
    return j.groupBy("p_partkey").agg(F.min(F.when(F.col("rule").isNotNull(), F.struct((F.col("how") == "prefix").cast("int").alias("o"), "rule", "grp"))).alias("x")).select("p_partkey", F.col("x.rule").alias("rule"), F.coalesce("x.grp", F.lit("unassigned")).alias("grp"))


def rule_overlap_check(spark, d):
    a, b = _rules(spark).alias("a"), _rules(spark).alias("b")
    types = F.col("a.only_type").isNull() | F.col("b.only_type").isNull() | (F.col("a.only_type") == F.col("b.only_type"))
    meet = F.when((F.col("a.how") == "prefix") & F.startswith("b.pattern", "a.pattern"), True).when((F.col("b.how") == "prefix") & F.startswith("a.pattern", "b.pattern"), True).otherwise(F.col("a.pattern") == F.col("b.pattern"))
    return a.join(F.broadcast(b), (F.col("a.rule") < F.col("b.rule")) & types & meet).select(F.col("a.rule").alias("one"), F.col("b.rule").alias("two"))


def event_confidence_score(spark, d):
    r = table(spark, d, "feedback_reports").groupBy("id").agg(F.max(F.struct("revision", "norm_slug", "version_id", "provision_anchor", "category", "contact_email")).alias("x")).select("id", "x.*")
    s = 0.35 + F.when(F.col("norm_slug").isNotNull(), 0.2).otherwise(0.0) + F.when(F.col("version_id").isNotNull(), 0.15).otherwise(0.0) + F.when(F.col("category") != "other", 0.1).otherwise(0.0) + F.when(F.col("provision_anchor").isNotNull(), 0.2).otherwise(0.0)
    strength = F.when(F.col("version_id").isNotNull() & F.col("norm_slug").isNull(), "contradictory").when(F.col("provision_anchor").isNotNull(), "strong").when(F.col("norm_slug").isNotNull(), "supporting").otherwise("insufficient")
    return r.select("id", strength.alias("strength"), F.round(F.when(strength == "contradictory", 0.3).otherwise(F.least(F.lit(1.0), s)), 2).alias("confidence"))


def identity_propagation(spark, d):
    """Reports of one page inherit its only version; pages with several are ambiguous."""
    r = table(spark, d, "feedback_reports").select("id", "context_path", "version_id").distinct()
    page = r.groupBy("context_path").agg(F.countDistinct("version_id").alias("k"), F.max("version_id").alias("only"))
    return r.join(page, "context_path").select("id", F.coalesce("version_id", F.when(F.col("k") == 1, F.col("only"))).alias("version"), (F.col("k") > 1).alias("ambiguous"))


def successor_match(spark, d):
    """Norms that begin the day after another of the same type and area ends; several candidates refuse."""
    n = norms_now(spark, d, "jurisdiction", "type", "expiry_date", "effective_date")
    a = n.where("expiry_date IS NOT NULL").select("id", "jurisdiction", "type", F.date_add("expiry_date", 1).alias("day"))
    b = n.select(F.col("id").alias("successor"), "jurisdiction", "type", F.col("effective_date").alias("day"))
    j = a.join(b, ["jurisdiction", "type", "day"], "left").where("successor IS NULL OR successor != id")
    g = j.groupBy("id").agg(F.count("successor").alias("n"), F.min("successor").alias("s"))
    return g.select("id", F.when(F.col("n") == 1, F.col("s")).alias("successor"), "n")


def publication_series(spark, d):
    c = versions_now(spark, d, "citation").select(F.regexp_extract("citation", "Blatt (\\d+)", 1).alias("issue"), "simulation_valid_from").where("issue != ''")
    return c.groupBy(F.col("issue").cast("int").alias("issue")).agg(F.count("*").alias("n"), F.year(F.min("simulation_valid_from")).alias("first_year"), F.year(F.max("simulation_valid_from")).alias("last_year"))


def slug_reserve(spark, d):
    """The first part of a name keeps the slug, others get their key behind it."""
    w = Window.partitionBy("candidate").orderBy("p_partkey")
    p = table(spark, d, "part").select("p_partkey", tx.slug(F.col("p_name")).alias("candidate"))
    return p.select("p_partkey", F.when(F.row_number().over(w) == 1, F.col("candidate")).otherwise(F.concat_ws("-", "candidate", "p_partkey")).alias("slug"))


def redirect_map(spark, d):
    """Retired keys to their followers, by a fixed small table."""
    moved = spark.createDataFrame([("Brand#1", "Brand#2"), ("Brand#3", "Brand#4")], "p_brand string, moved string")
    return table(spark, d, "part").join(F.broadcast(moved), "p_brand", "left").groupBy(F.coalesce("moved", "p_brand").alias("brand")).agg(F.count("*").alias("n"))


def change_feed(spark, d):
    """Newest changes up to a day and the next ones after it, over all areas."""
    day = F.lit("2026-01-01").cast("date")
    v = versions_now(spark, d).where("simulation_valid_from IS NOT NULL").groupBy("norm_id").agg(F.max(F.when(F.col("simulation_valid_from") <= day, F.col("simulation_valid_from"))).alias("effective"), F.min(F.when(F.col("simulation_valid_from") > day, F.col("simulation_valid_from"))).alias("upcoming"))
    return v.where("effective IS NOT NULL").orderBy(F.desc("effective"), "norm_id").limit(40)


def ledger_status(spark, d):
    """applied if every line is delivered, pending if none, partly otherwise; a finished order with an open line is contradictory."""
    l = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.count_if(F.col("l_linestatus") == "F").alias("f"))
    o = table(spark, d, "orders").join(l, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    status = F.when(F.col("n").isNull(), "no-lines").when((F.col("o_orderstatus") == "F") & (F.col("f") < F.col("n")), "contradictory").when(F.col("f") == F.col("n"), "applied").when(F.col("f") == 0, "pending").otherwise("partly")
    return o.groupBy("o_orderstatus", status.alias("status")).agg(F.count("*").alias("n"))


def version_compare(spark, d):
    """Units of neighbouring versions by label and title: changed, new, dropped or same."""
    whole = assemble_parts(table(spark, d, "law_version_blocks"), BLOCK_KEYS)
    u = whole.select("norm_id", "version_id", F.get_json_object("block_json", "$.label").alias("label"), F.get_json_object("block_json", "$.title").alias("title"), F.md5("block_json").alias("h"))
    u = u.groupBy("norm_id", "version_id", "label", "title").agg(F.min("h").alias("h"))
    w = Window.partitionBy("norm_id").orderBy("version_id")
    nxt = u.select("norm_id", "version_id").distinct().withColumn("next_version", F.lead("version_id").over(w)).where("next_version IS NOT NULL")
    old = u.join(nxt, ["norm_id", "version_id"]).select("norm_id", F.col("next_version").alias("version_id"), "label", "title", F.col("h").alias("h1"), F.lit(None).cast("string").alias("h2"))
    new = u.join(nxt.select("norm_id", F.col("next_version").alias("version_id")), ["norm_id", "version_id"]).select("norm_id", "version_id", "label", "title", F.lit(None).cast("string").alias("h1"), F.col("h").alias("h2"))
    g = old.unionByName(new).groupBy("norm_id", "version_id", "label", "title").agg(F.max("h1").alias("h1"), F.max("h2").alias("h2"))
    kind = F.when(F.col("h1").isNull(), "new").when(F.col("h2").isNull(), "dropped").when(F.col("h1") == F.col("h2"), "same").otherwise("changed")
    return g.groupBy("norm_id", "version_id", kind.alias("kind")).agg(F.count("*").alias("n"))


def record_violations(spark, d):
    """Records that contradict the model, by rule."""
    v = versions_now(spark, d)
    n = norms_now(spark, d, "title", "status", "version_count")
    per = v.groupBy("norm_id").agg(F.count("*").alias("k"))
    a = v.where("simulation_valid_to < simulation_valid_from").select(F.col("norm_id").alias("id"), F.lit("end-before-start").alias("rule"))
    b = v.where("simulation_valid_from < '2023-12-01'").select(F.col("norm_id").alias("id"), F.lit("before-baseline").alias("rule"))
    c = n.where("trim(coalesce(title, '')) = ''").select("id", F.lit("blank-title").alias("rule"))
    e = n.join(per, F.col("id") == F.col("norm_id"), "left").where("version_count != coalesce(k, 0)").select("id", F.lit("version-count").alias("rule"))
    return a.unionByName(b).unionByName(c).unionByName(e).groupBy("rule").agg(F.count("*").alias("n"), F.min("id").alias("example"))


def freshness_window(spark, d):
    parts = [table(spark, d, t).agg(F.min("updated_at").alias("oldest"), F.max("updated_at").alias("newest")).select(F.lit(t).alias("table_name"), "oldest", "newest") for t in ("law_norms", "law_versions", "law_source_objects")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def citation_scan(spark, d):
    """Citations of paragraphs with subsections in texts."""
    m = table(spark, d, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("§ (\\d+[a-z]?) Absatz (\\d+)"), F.lit(0))).alias("citation"))
    return m.groupBy("citation").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("n_docs"))


def title_classification(spark, d):
    """First rule that fits the title: exclude, review, include or unknown."""
    t = F.col("title")
    k = F.when(t.rlike("(?i)änderung|aufhebung"), "exclude").when(t.rlike("(?i)bekanntmachung"), "review").when(t.rlike("(?i)^(gesetz|verordnung|satzung)"), "include").otherwise("unknown")
    return norms_now(spark, d, "title").select("id", k.alias("decision"))


def chunk_roundtrip(spark, d):
    """Texts cut at a fixed length and joined again in order: pieces, and hashes of the text that comes out and of its last piece."""
    parts = split_parts(table(spark, d, "documents").where("length(text) > 0"), ["doc_id"], "text", 400)
    whole = assemble_parts(parts, ["doc_id"], payload="text")
    last = parts.where("part_index = part_count - 1").select("doc_id", F.col("part_count").cast("long").alias("n_parts"), F.md5("text").alias("last_part"))
    return whole.select("doc_id", F.md5("text").alias("text_hash")).join(last, "doc_id")


#: Blocks rejoined from their parts, in DuckDB.
WHOLE = """WITH parts AS (SELECT DISTINCT * FROM law_version_blocks WHERE part_index >= 0 AND part_index < part_count), whole AS (SELECT norm_id, version_id, block_index, string_agg(block_json, '' ORDER BY part_index) AS j, count(*) AS n, max(part_count) AS pc FROM parts GROUP BY ALL HAVING n = pc)"""
_FNV = "list_reduce(list_prepend(2166136261::BIGINT, list_transform(string_split('audit' || chr(0) || doc_id, ''), lambda c: CASE WHEN c = chr(0) THEN 0 ELSE ord(c) END::BIGINT)), lambda h, x: (xor(h, x) * 16777619) & 4294967295)"
_LV = _LN.rstrip() + ", lv AS (SELECT * FROM law_versions QUALIFY row_number() OVER (PARTITION BY norm_id, version_id ORDER BY updated_at DESC) = 1) "
_NORM = lambda c: f"trim(regexp_replace(replace(strip_accents(lower({c})), 'ß', 'ss'), '[^a-z0-9*]+', ' ', 'g'))"
_SUM = _LV + f""", w0 AS (SELECT norm_id, version_id, list_filter(string_split(coalesce({_NORM("json_extract_string(version_json, '$.summary')")}, ''), ' '), lambda x: x <> '') AS w FROM lv),
s AS (SELECT *, lead(w) OVER (PARTITION BY norm_id ORDER BY version_id) AS nw FROM w0 QUALIFY nw IS NOT NULL) """
_FP = "coalesce({0}, chr(0))"
_R = "WITH r AS (SELECT * FROM feedback_reports QUALIFY row_number() OVER (PARTITION BY id ORDER BY revision DESC) = 1) "
_SNAP = "WITH old AS (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders), new AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 97 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM old WHERE o_orderkey % 101 <> 0 UNION ALL SELECT o_orderkey + 10000000, o_custkey, o_orderstatus FROM old WHERE o_orderkey % 103 = 0) "
_RULE_SQL = "(VALUES " + ", ".join("(" + ", ".join("NULL" if x is None else f"'{x}'" for x in r) + ")" for r in _RULES) + ") {0}(rule, pattern, how, only_type, grp)"

QUERIES = {
    f.__name__: f
    for f in (
        token_multiset_diff, similarity_measures, text_integrity, stratified_sample, strided_sample, global_positions, percentile_nearest_rank, percentile_by_index, coverage_percent, signature_classes, priority_score_bands,
        content_fingerprint, corpus_fingerprint, snapshot_diff, incremental_equals_full, replica_parity, tiered_resolution, prefix_title_match, reference_frequency, taxonomy_assignment, rule_overlap_check,
        event_confidence_score, identity_propagation, successor_match, publication_series, slug_reserve, redirect_map, change_feed, ledger_status, version_compare, record_violations, freshness_window, citation_scan,
        title_classification, chunk_roundtrip,
    )
}

SQL = {
    "token_multiset_diff": _SUM + "SELECT norm_id, version_id, sum(greatest(d, 0)) AS missing, sum(greatest(-d, 0)) AS extra FROM (SELECT norm_id, version_id, t, sum(d) AS d FROM (SELECT norm_id, version_id, unnest(w) AS t, 1 AS d FROM s UNION ALL SELECT norm_id, version_id, unnest(nw), -1 FROM s) GROUP BY ALL HAVING sum(d) <> 0) GROUP BY ALL",
    "similarity_measures": _SUM + ", l AS (SELECT norm_id, version_id, list_distinct(list_filter(w, lambda x: length(x) >= 4)) AS a, list_distinct(list_filter(nw, lambda x: length(x) >= 4)) AS b FROM s), k AS (SELECT *, len(list_intersect(a, b)) AS i FROM l) SELECT norm_id, version_id, round(CASE WHEN len(a) + len(b) - i = 0 THEN 0.0 ELSE i / (len(a) + len(b) - i) END, 6) AS jaccard, round(CASE WHEN len(a) = 0 OR len(b) = 0 THEN 0.0 ELSE i / len(a) END, 6) AS containment, round(CASE WHEN least(len(a), len(b)) = 0 THEN 1.0 ELSE i / least(len(a), len(b)) END, 6) AS overlap FROM k",
    "text_integrity": _SUM + ", k AS (SELECT *, len(list_intersect(list_distinct(w), list_distinct(nw))) AS i, len(list_distinct(list_concat(w, nw))) AS u FROM s) SELECT norm_id, version_id, CASE WHEN w = nw THEN 'exact' WHEN list_sort(w) = list_sort(nw) THEN 'normalised-equivalent' WHEN u > 0 AND i / u >= 0.7 THEN 'review' ELSE 'mismatch' END AS klass FROM k",
    "stratified_sample": f"SELECT doc_id, doc_type, order_hash FROM (SELECT doc_id, doc_type, order_hash, row_number() OVER (PARTITION BY doc_type ORDER BY order_hash, doc_id) AS r FROM (SELECT doc_id, doc_type, {_FNV} AS order_hash FROM documents)) ORDER BY r > 5, order_hash, doc_id LIMIT 100",
    "strided_sample": "SELECT c_custkey, c_name FROM (SELECT *, row_number() OVER (ORDER BY c_custkey) AS r, count(*) OVER () AS t FROM customer) WHERE (r - 1) % greatest(1, t // 40) = 0",
    "global_positions": "SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS rank FROM orders",
    "percentile_nearest_rank": "SELECT l_returnflag, quantile_disc(l_quantity, 0.5) AS p50, quantile_disc(l_quantity, 0.95) AS p95, quantile_disc(l_quantity, 0.99) AS p99, max(l_quantity) AS most FROM lineitem GROUP BY ALL",
    "percentile_by_index": "SELECT l_returnflag, a[1 + least(len(a) - 1, CAST(floor(0.5 * len(a)) AS BIGINT))] AS p50, a[1 + least(len(a) - 1, CAST(floor(0.95 * len(a)) AS BIGINT))] AS p95 FROM (SELECT l_returnflag, list(l_quantity ORDER BY l_quantity) AS a FROM lineitem GROUP BY ALL)",
    "coverage_percent": _LN + "SELECT jurisdiction, count(*) AS n, round(count(summary) * 1000 / count(*), 0) / 10 AS summary_pct, round(count(abbr) * 1000 / count(*), 0) / 10 AS abbr_pct, round(count(publication_date) * 1000 / count(*), 0) / 10 AS published_pct, round(count(*) FILTER (len(subjects) > 0) * 1000 / count(*), 0) / 10 AS subject_pct FROM ln GROUP BY ALL",
    "signature_classes": "SELECT regexp_replace(regexp_replace(citation, '\\d+', '9', 'g'), 'Januar|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember', 'M', 'g') AS signature, count(*) AS n, min(citation) AS example FROM law_versions WHERE citation IS NOT NULL GROUP BY ALL",
    "priority_score_bands": _R + ", s AS (SELECT id, CASE priority WHEN 'P1' THEN 40 WHEN 'P2' THEN 20 ELSE 5 END + CASE WHEN category IN ('missing', 'wording') THEN 15 ELSE 0 END + CASE WHEN status = 'new' THEN 10 ELSE 0 END + CASE WHEN norm_slug IS NOT NULL THEN 5 ELSE 0 END - CASE WHEN version_id IS NULL THEN 5 ELSE 0 END AS score FROM r) SELECT id, score, CASE WHEN score >= 60 THEN 'A' WHEN score >= 40 THEN 'B' WHEN score >= 20 THEN 'C' ELSE 'D' END AS band FROM s",
    "content_fingerprint": _LN + "SELECT id, sha256(coalesce(title, chr(0)) || chr(31) || coalesce(status, chr(0)) || chr(31) || coalesce(CAST(version_count AS VARCHAR), chr(0))) AS fingerprint FROM ln",
    "corpus_fingerprint": _LN + "SELECT count(*) AS n_rows, CAST(sum(CAST('0x' || substr(sha256(id || chr(31) || coalesce(title, chr(0)) || chr(31) || coalesce(status, chr(0)) || chr(31) || coalesce(CAST(version_count AS VARCHAR), chr(0))), 1, 12) AS BIGINT)) AS VARCHAR) AS fingerprint FROM ln",
    "snapshot_diff": _SNAP + "SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey, CASE WHEN o.o_orderkey IS NULL THEN 'added' WHEN n.o_orderkey IS NULL THEN 'removed' WHEN o.o_orderstatus = n.o_orderstatus AND o.o_custkey = n.o_custkey THEN 'unchanged' ELSE 'changed' END AS change FROM old o FULL JOIN new n ON o.o_orderkey = n.o_orderkey",
    "incremental_equals_full": _SNAP + "SELECT * FROM new",
    "replica_parity": "SELECT coalesce(a.doc_type, b.doc_type) AS doc_type, a.n, b.n AS n2, a.n IS NOT DISTINCT FROM b.n AND a.c IS NOT DISTINCT FROM b.c AS equal FROM (SELECT doc_type, count(*) AS n, sum(length(text)) AS c FROM documents GROUP BY ALL) a FULL JOIN (SELECT doc_type, count(*) AS n, sum(length(text)) AS c FROM documents WHERE doc_id % 50 <> 0 GROUP BY ALL) b ON a.doc_type = b.doc_type",
    "tiered_resolution": _LN + f", u AS (SELECT {_NORM('title')} AS key, min(id) AS by_title FROM ln GROUP BY 1 HAVING count(*) = 1) SELECT doc_id, coalesce(ln.id, by_title) AS resolved, CASE WHEN ln.id IS NOT NULL THEN 1 WHEN by_title IS NOT NULL THEN 2 ELSE 9 END AS tier FROM documents d LEFT JOIN ln ON ln.id = d.norm_id LEFT JOIN u ON u.key = {_NORM('split_part(d.text, chr(10), 1)')}",
    "prefix_title_match": _LN + f", k AS (SELECT id, {_NORM('title')} AS k FROM ln) SELECT a.id, b.id AS other FROM k a JOIN k b ON a.id < b.id AND length(a.k) >= 25 AND length(b.k) >= 25 AND (starts_with(a.k, b.k) OR starts_with(b.k, a.k))",
    "reference_frequency": _LN + ", w AS (SELECT DISTINCT id, unnest(regexp_extract_all(title, '[\\p{L}\\p{N}]+\\*?')) AS w FROM ln) SELECT ln.id AS nid, count(*) AS n FROM ln JOIN w ON w.w = ln.short_title AND w.id <> ln.id WHERE regexp_full_match(short_title, '\\p{L}{3,}') GROUP BY ALL",
    "taxonomy_assignment": "WITH j AS (SELECT p_partkey, r.* FROM part LEFT JOIN " + _RULE_SQL.format("r") + " ON ((how = 'exact' AND p_brand = pattern) OR (how = 'prefix' AND starts_with(p_brand, pattern))) AND (only_type IS NULL OR only_type = p_type)) SELECT p_partkey, rule, coalesce(grp, 'unassigned') AS grp FROM j QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY CASE WHEN how = 'prefix' THEN 1 ELSE 0 END, rule) = 1",
    "rule_overlap_check": "SELECT a.rule AS one, b.rule AS two FROM " + _RULE_SQL.format("a") + " JOIN " + _RULE_SQL.format("b") + " ON a.rule < b.rule AND (a.only_type IS NULL OR b.only_type IS NULL OR a.only_type = b.only_type) AND CASE WHEN a.how = 'prefix' AND starts_with(b.pattern, a.pattern) THEN true WHEN b.how = 'prefix' AND starts_with(a.pattern, b.pattern) THEN true ELSE a.pattern = b.pattern END",
    "event_confidence_score": _R + ", s AS (SELECT id, CASE WHEN version_id IS NOT NULL AND norm_slug IS NULL THEN 'contradictory' WHEN provision_anchor IS NOT NULL THEN 'strong' WHEN norm_slug IS NOT NULL THEN 'supporting' ELSE 'insufficient' END AS strength, 0.35::DOUBLE + CASE WHEN norm_slug IS NOT NULL THEN 0.2::DOUBLE ELSE 0 END + CASE WHEN version_id IS NOT NULL THEN 0.15::DOUBLE ELSE 0 END + CASE WHEN category <> 'other' THEN 0.1::DOUBLE ELSE 0 END + CASE WHEN provision_anchor IS NOT NULL THEN 0.2::DOUBLE ELSE 0 END AS s FROM r) SELECT id, strength, round(CASE WHEN strength = 'contradictory' THEN 0.3::DOUBLE ELSE least(1.0::DOUBLE, s) END, 2) AS confidence FROM s",
    "identity_propagation": "WITH r AS (SELECT DISTINCT id, context_path, version_id FROM feedback_reports), p AS (SELECT context_path, count(DISTINCT version_id) AS k, max(version_id) AS only_one FROM r GROUP BY 1) SELECT id, coalesce(version_id, CASE WHEN k = 1 THEN only_one END) AS version, k > 1 AS ambiguous FROM r JOIN p USING (context_path)",
    "successor_match": _LN + ", j AS (SELECT a.id, b.id AS s FROM ln a LEFT JOIN ln b ON b.jurisdiction = a.jurisdiction AND b.type = a.type AND b.effective_date = a.expiry_date + 1 WHERE a.expiry_date IS NOT NULL AND (b.id IS NULL OR b.id <> a.id)) SELECT id, CASE WHEN count(s) = 1 THEN min(s) END AS successor, count(s) AS n FROM j GROUP BY id",
    "publication_series": _LV + "SELECT CAST(regexp_extract(citation, 'Blatt (\\d+)', 1) AS INTEGER) AS issue, count(*) AS n, year(min(simulation_valid_from)) AS first_year, year(max(simulation_valid_from)) AS last_year FROM lv WHERE regexp_matches(citation, 'Blatt \\d+') GROUP BY 1",
    "slug_reserve": "SELECT p_partkey, CASE WHEN row_number() OVER (PARTITION BY c ORDER BY p_partkey) = 1 THEN c ELSE c || '-' || p_partkey END AS slug FROM (SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') AS c FROM part)",
    "redirect_map": "SELECT CASE p_brand WHEN 'Brand#1' THEN 'Brand#2' WHEN 'Brand#3' THEN 'Brand#4' ELSE p_brand END AS brand, count(*) AS n FROM part GROUP BY 1",
    "change_feed": _LV + "SELECT norm_id, max(simulation_valid_from) FILTER (simulation_valid_from <= DATE '2026-01-01') AS effective, min(simulation_valid_from) FILTER (simulation_valid_from > DATE '2026-01-01') AS upcoming FROM lv GROUP BY norm_id HAVING effective IS NOT NULL ORDER BY effective DESC, norm_id LIMIT 40",
    "ledger_status": "WITH l AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_linestatus = 'F') AS f FROM lineitem GROUP BY 1) SELECT o_orderstatus, CASE WHEN n IS NULL THEN 'no-lines' WHEN o_orderstatus = 'F' AND f < n THEN 'contradictory' WHEN f = n THEN 'applied' WHEN f = 0 THEN 'pending' ELSE 'partly' END AS status, count(*) AS n FROM orders LEFT JOIN l ON l_orderkey = o_orderkey GROUP BY ALL",
    "version_compare": f"""{WHOLE}, u AS (SELECT norm_id, version_id, json_extract_string(j, '$.label') AS label, json_extract_string(j, '$.title') AS title, min(md5(j)) AS h FROM whole GROUP BY ALL),
nx AS (SELECT norm_id, version_id, lead(version_id) OVER (PARTITION BY norm_id ORDER BY version_id) AS nv FROM (SELECT DISTINCT norm_id, version_id FROM u) QUALIFY nv IS NOT NULL),
x AS (SELECT norm_id, nv AS version_id, label, title, h AS h1, NULL AS h2 FROM u JOIN nx USING (norm_id, version_id) UNION ALL SELECT u.norm_id, u.version_id, label, title, NULL, h FROM u JOIN nx ON nx.norm_id = u.norm_id AND nx.nv = u.version_id),
g AS (SELECT norm_id, version_id, label, title, max(h1) AS h1, max(h2) AS h2 FROM x GROUP BY ALL)
SELECT norm_id, version_id, CASE WHEN h1 IS NULL THEN 'new' WHEN h2 IS NULL THEN 'dropped' WHEN h1 = h2 THEN 'same' ELSE 'changed' END AS kind, count(*) AS n FROM g GROUP BY ALL""",
    "record_violations": _LV + ", per AS (SELECT norm_id, count(*) AS k FROM lv GROUP BY 1), x AS (SELECT norm_id AS id, 'end-before-start' AS rule FROM lv WHERE simulation_valid_to < simulation_valid_from UNION ALL SELECT norm_id, 'before-baseline' FROM lv WHERE simulation_valid_from < DATE '2023-12-01' UNION ALL SELECT id, 'blank-title' FROM ln WHERE trim(coalesce(title, '')) = '' UNION ALL SELECT id, 'version-count' FROM ln LEFT JOIN per ON per.norm_id = id WHERE version_count <> coalesce(k, 0)) SELECT rule, count(*) AS n, min(id) AS example FROM x GROUP BY rule",
    "freshness_window": " UNION ALL ".join(f"SELECT '{t}' AS table_name, min(updated_at) AS oldest, max(updated_at) AS newest FROM {t}" for t in ("law_norms", "law_versions", "law_source_objects")),
    "citation_scan": "SELECT citation, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM (SELECT doc_id, unnest(regexp_extract_all(text, '§ (\\d+[a-z]?) Absatz (\\d+)')) AS citation FROM documents) GROUP BY ALL",
    "title_classification": _LN + "SELECT id, CASE WHEN regexp_matches(title, '(?i)änderung|aufhebung') THEN 'exclude' WHEN regexp_matches(title, '(?i)bekanntmachung') THEN 'review' WHEN regexp_matches(title, '(?i)^(gesetz|verordnung|satzung)') THEN 'include' ELSE 'unknown' END AS decision FROM ln",
    "chunk_roundtrip": "SELECT doc_id, CAST((length(text) + 399) // 400 AS BIGINT) AS n_parts, md5(text) AS text_hash, md5(substr(text, (length(text) - 1) // 400 * 400 + 1)) AS last_part FROM documents WHERE length(text) > 0",
}
