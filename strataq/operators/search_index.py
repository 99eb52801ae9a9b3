"""Full-text search over addressable units: a kept index, and batches of requests against it.

The index is four tables: documents, units with their structural addresses,
occurrences of words sorted by word, and the words with the number of their
documents. A batch of requests is a table too: it is parsed in batches, its
words are looked up in the table of words (beginnings by equality of the
beginning), and each request starts from the documents of its rarest word; only
there its other words are looked up. So a batch reads the occurrences of the
words it asks for, never the texts, and common words cost no more than the
documents of the rare ones beside them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataq.functions import text as tx
from strataq.plans import search as ps
from strataq.session import cut

K1, B = 1.2, 0.75
#: Weights of a word in a title, in a unit's heading and in its body.
TITLE_WEIGHT, HEADING_WEIGHT, BODY_WEIGHT = 10, 2, 1
#: Unit number of a title.
TITLE = -1
#: Most different words of a batch that are pushed down to the scan of the occurrences; beyond, they are joined.
PUSHED_TERMS = 2_000


def units_of(documents: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, unit_index, title, heading, body: paragraphs between blank lines; the document's first line is its title, a unit's first line its heading."""
    # what is not exploded is computed before, else it would be once for each unit
    whole = documents.where(F.col(text).isNotNull()).select(F.col(doc).alias("doc_id"), F.substring_index(F.col(text), "\n", 1).alias("title"), F.split(F.col(text), "\n\n+").alias("units"))
    return whole.select("doc_id", "title", F.posexplode("units").alias("unit_index", "body")).withColumn("heading", F.substring_index("body", "\n", 1))


def postings(units: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, term, tf: the inverted index, one row per unit and word."""
    return units.select(*keys, F.explode(tx.words(F.col(text))).alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("tf"))


def corpus_statistics(documents: DataFrame, text: str) -> DataFrame:
    """n_docs, avg_length in words, one row."""
    return documents.agg(F.count("*").alias("n_docs"), F.avg(F.size(tx.words(F.col(text)))).alias("avg_length"))


# --- the index ---------------------------------------------------------------

_ADDRESS = "kind string, number string, subsection string"


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in ("kind", "number", "subsection")])))
def _addresses(s: pd.Series) -> pd.Series:
    return s.map(lambda t: [(a.kind, a.number, a.subsection) for a in ps.split_addresses(t)[0]])


@dataclass(frozen=True)
class SearchIndex:
    """documents(doc_id, n_words, title_key, title_forms, title_addresses), units(doc_id, unit_index, kind, number, subsections), occurrences(term, doc_id, unit_index, position, in_heading), terms(term, docs)."""

    documents: DataFrame
    units: DataFrame
    occurrences: DataFrame
    terms: DataFrame


PARTS = ("documents", "units", "occurrences", "terms")


def _unit_address(body: Column) -> list[Column]:
    """kind, number, subsections of a unit by how it begins."""
    forms = {"paragraph": "^§+\\s*(\\d+[a-z]?)(?![\\p{L}\\p{N}])", "article": "^(?:Artikel|Art\\.?)\\s+(\\d+[a-z]?|[IVXLC]+)(?![\\p{L}\\p{N}])", "number": "^(?:Nr\\.|Nummer|Ziffer)\\s*(\\d{1,2}(?:\\.\\d{1,2})*)(?!\\d)|^\\d{1,2}(?:\\.\\d{1,2})+(?!\\d)"}
    shown = {k: F.lower(F.regexp_extract(body, p, 0 if k == "number" else 1)) for k, p in forms.items()}
    shown["number"] = F.regexp_extract(shown["number"], "\\d.*", 0)
    kind = F.coalesce(*[F.when(c != "", F.lit(k)) for k, c in shown.items()])
    return [kind.alias("kind"), F.coalesce(*[F.nullif(c, F.lit("")) for c in shown.values()]).alias("number"), F.array_distinct(F.regexp_extract_all(body, F.lit("(?m)^\\((\\d+[a-z]?)\\)"), F.lit(1))).alias("subsections")]


def index_of(documents: DataFrame, doc: str = "doc_id", text: str = "text") -> SearchIndex:
    """The index of documents with distinct, non-null ids; null texts are documents without units."""
    docs = documents.where(F.col(doc).isNotNull()).select(F.col(doc).alias("doc_id"), F.col(text).alias("text"))
    title = F.substring_index(F.coalesce("text", F.lit("")), "\n", 1)
    units = units_of(docs)
    in_units = units.select("doc_id", "unit_index", tx.words(F.col("body")).alias("w"), F.when(F.contains("body", F.lit("\n")), F.size(tx.words(F.col("heading")))).otherwise(0).alias("n"))
    in_titles = docs.select("doc_id", F.lit(TITLE).alias("unit_index"), tx.words(title).alias("w"), F.lit(0).alias("n"))
    occurrences = in_units.unionByName(in_titles).select("doc_id", "unit_index", "n", F.posexplode("w").alias("position", "term")).select("term", "doc_id", "unit_index", "position", (F.col("position") < F.col("n")).alias("in_heading"))
    addressed = F.when(title.rlike("(?i)§|\\bart|\\babs|\\bnr|\\bnummer|\\bziff"), title)
    no_address = F.array().cast(f"array<struct<{_ADDRESS.replace(' ', ':')}>>".replace(",:", ","))
    return SearchIndex(
        docs.select("doc_id", (F.size(tx.words(title)) + F.size(tx.words(F.col("text")))).alias("n_words"), tx.normalise(title).alias("title_key"), tx.variants(title).alias("title_forms"), F.coalesce(_addresses(F.coalesce(addressed, F.lit(""))), no_address).alias("title_addresses")),
        units.select("doc_id", "unit_index", *_unit_address(F.col("body"))),
        occurrences,
        occurrences.select("term", "doc_id").distinct().groupBy("term").agg(F.count("*").alias("docs")),
    )


def keep_index(index: SearchIndex, path: str) -> SearchIndex:
    """Writes the index below ``path``, occurrences and words sorted by word so that a lookup reads few row groups, and gives it as stored."""
    spark = index.documents.sparkSession
    index.documents.write.mode("overwrite").parquet(f"{path}/documents")
    index.units.write.mode("overwrite").parquet(f"{path}/units")
    index.occurrences.repartitionByRange("term", "doc_id").sortWithinPartitions("term", "doc_id", "unit_index").write.mode("overwrite").parquet(f"{path}/occurrences")
    stored = spark.read.parquet(f"{path}/occurrences")
    terms = stored.select("term", "doc_id").distinct().groupBy("term").agg(F.count("*").alias("docs"))
    terms.repartitionByRange("term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{path}/terms")
    return read_index(spark, path)


def read_index(spark: SparkSession, path: str) -> SearchIndex:
    return SearchIndex(*[spark.read.parquet(f"{path}/{p}") for p in PARTS])


def changed_index(index: SearchIndex, documents: DataFrame, removed: DataFrame) -> SearchIndex:
    """The index after documents(doc_id, text) are inserted or replaced and those of removed(doc_id) deleted; untouched documents are not read again."""
    new = index_of(documents)
    gone = new.documents.select("doc_id").unionByName(removed.select("doc_id")).distinct()
    merge = lambda old, more: old.join(gone, "doc_id", "left_anti").unionByName(more)
    occurrences = merge(index.occurrences, new.occurrences)
    return SearchIndex(merge(index.documents, new.documents), merge(index.units, new.units), occurrences, occurrences.select("term", "doc_id").distinct().groupBy("term").agg(F.count("*").alias("docs")))


def integrity(index: SearchIndex, documents: DataFrame) -> DataFrame:
    """doc_id, finding of documents(doc_id, text) and indexed ones that do not agree: missing, left-over, or differing words."""
    h = F.xxhash64("term", "unit_index", "position", "in_heading").cast("decimal(38,0)")
    side = lambda i, n: i.documents.select("doc_id").join(i.occurrences.groupBy("doc_id").agg(F.count("*").alias("c"), F.sum(h).alias("s")), "doc_id", "left").select("doc_id", F.struct(F.coalesce("c", F.lit(0)), F.coalesce("s", F.lit(0).cast("decimal(38,0)"))).alias(n))
    both = side(index, "kept").join(side(index_of(documents), "now"), "doc_id", "full_outer")
    finding = F.when(F.col("kept").isNull(), "missing").when(F.col("now").isNull(), "left-over").when(F.col("kept") != F.col("now"), "differs")
    return both.select("doc_id", finding.alias("finding")).where("finding IS NOT NULL")


# --- requests ----------------------------------------------------------------

_PLANS = (
    "request string, mode string, scope string, n_slots int, n_addresses int, identity array<string>, subject array<string>, subject_text string, "
    "words array<struct<slot int, alt int, n_words int, offset int, word string, wide boolean, narrow boolean>>, addresses array<struct<number_of int, kind string, number string, subsection string>>"
)


def plan_row(request: str, plan: ps.Plan) -> tuple:
    """A plan as a row of the plans table: a slot for each word and phrase, an alternative for each spelling; ``narrow``: a prefix in this mode, ``wide``: in or-prefix."""
    words = []
    slots = [(t.variants, t.prefix, w) for t, w in zip(plan.tokens, plan.wide)] + [(tuple(ps.variants(p)), False, False) for p in plan.phrases]
    for slot, (spellings, narrow, wide) in enumerate(slots):
        for alt, spelling in enumerate(spellings):
            parts = spelling.replace("*", " ").split()
            words += [(slot, alt, len(parts), k, w, wide and k == len(parts) - 1, narrow and k == len(parts) - 1) for k, w in enumerate(parts)]
    addresses = [(k, a.kind, a.number, a.subsection) for k, a in enumerate(plan.addresses)]
    return request, plan.mode, plan.scope, len(slots), len(addresses), plan.identity, plan.subject, plan.subject[0] if plan.subject else "", words, addresses


def parse_requests(requests: DataFrame, plan: Callable[[str, str, str], ps.Plan] = ps.build_plan) -> DataFrame:
    """Plans of requests(request, query, mode, scope); null requests and queries give none."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols = [c.split()[0] for c in "request mode scope n_slots n_addresses identity subject subject_text words addresses".split()]
        for b in batches:
            rows = [plan_row(r, plan(q, m, s)) for r, q, m, s in zip(b["request"], b["query"], b["mode"], b["scope"])]
            yield pd.DataFrame(rows, columns=cols, dtype=object)

    named = requests.where("request IS NOT NULL AND query IS NOT NULL").select("request", "query", F.coalesce("mode", F.lit("and-first")).alias("mode"), F.coalesce("scope", F.lit("all")).alias("scope"))
    return named.mapInPandas(of, _PLANS)


def request_table(spark: SparkSession, queries: dict[str, str], mode: str = "and-first", scope: str = "all") -> DataFrame:
    return spark.createDataFrame([(n, q, mode, scope) for n, q in queries.items()], "request string, query string, mode string, scope string")


_SOUGHT = "request string, slot int, alt int, n_words int, offset int, term string, fits boolean, key boolean, n long"


def _choose(wanted: pd.DataFrame) -> pd.DataFrame:
    """Of whole requests what is to be looked up, with the number of documents of each slot and the words to start from: nothing of a request one of whose slots has no indexed word."""
    words = wanted.groupby(["request", "slot", "alt", "n_words", "offset"], as_index=False)["docs"].sum().sort_values(["request", "slot", "alt", "docs", "offset"])
    there = words.groupby(["request", "slot", "alt"])["offset"].transform("size") == words["n_words"]
    # a spelling is as rare as its rarest word, and none if one of its words is nowhere
    rarest = words[there].drop_duplicates(["request", "slot", "alt"])
    slots = rarest.groupby(["request", "slot"], as_index=False)["docs"].sum().rename(columns={"docs": "n"})
    slots["slots"] = slots.groupby("request")["slot"].transform("size")
    first = slots.sort_values(["request", "n", "slot"]).drop_duplicates("request")[["request", "slot"]].rename(columns={"slot": "start"})
    x = wanted.merge(rarest[["request", "slot", "alt", "offset"]].rename(columns={"offset": "rarest"}), on=["request", "slot", "alt"]).merge(slots, on=["request", "slot"]).merge(first, on="request")
    x = x[x["slots"] == x["n_slots"]]
    x = x.assign(key=(x["slot"] == x["start"]) & (x["offset"] == x["rarest"]))
    x.loc[x["n_words"] == 1, "alt"] = 0  # a word asked for in several spellings is one word
    return x.groupby(["request", "slot", "alt", "n_words", "offset", "term", "n"], as_index=False).agg(fits=("fits", "any"), key=("key", "any"))[[c.split()[0] for c in _SOUGHT.split(", ")]]


def _chosen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by request; the last request of a batch may go on in the next."""
    held: list[pd.DataFrame] = []
    for b in batches:
        if not len(b):
            continue
        last = b["request"] == b["request"].iat[-1]
        if not last.all() or (held and held[-1]["request"].iat[-1] != b["request"].iat[0]):
            done = pd.concat([*held, b[~last]])
            if len(done):
                yield _choose(done)
            held = []
        held.append(b[last])
    if held:
        yield _choose(pd.concat(held))


def sought_terms(index: SearchIndex, plans: DataFrame) -> DataFrame:
    """request, slot, alt, n_words, offset, term, fits, key, n: the indexed words that each asked word stands for; ``fits`` if it does so in the request's own mode, ``key`` if a document must hold one of these, n documents of the slot's words together. Requests of which a word is nowhere are left out."""
    asked = plans.select("request", "n_slots", F.inline("words"))
    exact = asked.where("NOT wide AND NOT narrow").join(index.terms.withColumnRenamed("term", "word"), "word").withColumns({"term": F.col("word"), "fits": F.lit(True)})
    lengths = sorted(r[0] for r in asked.where("wide OR narrow").select(F.length("word")).distinct().collect())  # no more than a request has characters
    cols = ["request", "n_slots", "slot", "alt", "n_words", "offset", "term", "docs", "fits"]
    rows = exact.select(*cols)
    if lengths:
        begins = index.terms.select("term", "docs", F.explode(F.array_distinct(F.array(*[F.left("term", F.lit(n)) for n in lengths]))).alias("word"))
        started = asked.where("wide OR narrow").join(begins, "word").withColumn("fits", F.col("narrow") | (F.col("term") == F.col("word")))
        rows = rows.unionByName(started.select(*cols))
    return rows.repartition("request").sortWithinPartitions("request").mapInPandas(_chosen, _SOUGHT)


def evidence(index: SearchIndex, sought: DataFrame) -> DataFrame:
    """request, doc_id, slot, unit_index, fits, weight: where the words and phrases of the requests stand, in documents that hold one of the request's rarest slot."""
    few = [(r["term"], r["key"]) for r in sought.groupBy("term").agg(F.bool_or("key").alias("key")).limit(PUSHED_TERMS + 1).collect()]

    def occurrences(of: DataFrame, listed: list[str]) -> DataFrame:
        """By a filter that the scan can use where few words are asked for."""
        return index.occurrences.where(F.col("term").isin(listed)) if len(few) <= PUSHED_TERMS else index.occurrences.join(of.select("term").distinct(), "term", "left_semi")

    keys = sought.where("key").select("request", "term")
    candidates = occurrences(keys, [t for t, key in few if key]).select("term", "doc_id").distinct().join(keys, "term").select("request", "doc_id").distinct()
    found = occurrences(sought, [t for t, _ in few]).join(candidates.join(sought, "request"), ["term", "doc_id"])
    weight = F.when(F.col("unit_index") == TITLE, TITLE_WEIGHT).when(F.col("in_heading"), HEADING_WEIGHT).otherwise(BODY_WEIGHT)
    shown = ["request", "doc_id", "slot", "unit_index", "fits", "weight", "n"]
    if sought.where("n_words > 1").isEmpty():
        return found.withColumn("weight", weight).select(*shown)
    # a phrase stands where all its words begin at one place; a word does so by itself
    at = F.col("position") - F.col("offset")
    whole = found.groupBy("request", "doc_id", "slot", "alt", "n_words", "n", "unit_index", at.alias("at"), F.when(F.col("n_words") == 1, F.col("term")).alias("word"))
    return whole.agg(F.countDistinct("offset").alias("k"), F.bool_and("fits").alias("fits"), F.max(weight).alias("weight")).where("k = n_words").select(*shown)


def scores(index: SearchIndex, found: DataFrame) -> DataFrame:
    """request, doc_id, score (lower is better) by BM25 over evidence: a slot counts as one word, in as many documents as its indexed words together; occurrences are weighted by field."""
    n_docs, avg_length = index.documents.agg(F.count("*").alias("x")).scalar(), index.documents.agg(F.avg("n_words").alias("x")).scalar()
    slot = found.groupBy("request", "doc_id", "slot", "n").agg(F.sum("weight").alias("f"))
    j = slot.join(index.documents.select("doc_id", "n_words"), "doc_id")
    idf = F.when(F.col("n") < n_docs, F.greatest(F.log((n_docs - F.col("n") + 0.5) / (F.col("n") + 0.5)), F.lit(1e-6))).otherwise(F.lit(1e-6))
    part = idf * F.col("f") * (K1 + 1) / (F.col("f") + K1 * (1 - B + B * F.col("n_words") / avg_length))
    return j.groupBy("request", "doc_id").agg(F.round(-F.sum(part), 6).alias("score"))


def _addressed(index: SearchIndex, plans: DataFrame) -> DataFrame:
    """request, doc_id, ref_unit: the first unit of a document that meets all addresses of a request."""
    asked = plans.where("n_addresses > 0").select("request", "n_addresses", F.inline("addresses"))
    own = index.units.where("number IS NOT NULL").select("doc_id", "unit_index", "kind", "number", "subsections")
    inner = index.units.select("doc_id", "unit_index", F.lit("subsection").alias("kind"), F.explode("subsections").alias("number"), "subsections")
    met = asked.join(own.unionByName(inner), ["kind", "number"]).where("subsection IS NULL OR array_contains(subsections, subsection)")
    units = met.groupBy("request", "doc_id", "unit_index", "n_addresses").agg(F.countDistinct("number_of").alias("k")).where("k = n_addresses")
    return units.groupBy("request", "doc_id").agg(F.min("unit_index").alias("ref_unit"))


#: Kinds in their order; reference comes twice, with and without the title.
TIERS = {"identity": 0, "reference": 1, "title": 2, "unit": 4, "body": 5, "browse": 6}


def search(index: SearchIndex, requests: DataFrame, with_scores: bool = True) -> DataFrame:
    """request, doc_id, kind, tier, rank (three numbers), best_unit, strict, score: every document that meets a request(request, query, mode, scope).

    A document meets a request if all its words and phrases stand in the scope
    (title, body, or all) and all its addresses on one unit, or in a title that
    holds the words too. In and-first the words must stand in one unit with the
    title, the last one as a prefix; if no document is so, or in or-prefix,
    they may stand anywhere, all longer ones as prefixes. Requests without
    words and addresses meet every document (browse).
    """
    plans = cut(parse_requests(requests))
    meta = plans.drop("words")
    found = cut(evidence(index, cut(sought_terms(index, plans))))
    per_unit = found.groupBy("request", "doc_id", "unit_index").agg(F.collect_set("slot").alias("wide"), F.collect_set(F.when(F.col("fits"), F.col("slot"))).alias("narrow"))
    title = lambda c: F.max(F.when(F.col("unit_index") == TITLE, F.col(c)))
    per_doc = per_unit.groupBy("request", "doc_id").agg(title("wide").alias("tw"), title("narrow").alias("tn"), F.collect_list(F.when(F.col("unit_index") != TITLE, F.struct("unit_index", "wide", "narrow"))).alias("units"))
    none = F.array().cast("array<int>")
    n = F.col("n_slots")
    body = lambda c: F.flatten(F.transform("units", lambda u: u[c]))
    covers = lambda slots: F.size(F.array_distinct(slots)) == n
    in_title = covers(F.col("tn"))
    units_full = F.array_sort(F.transform(F.filter("units", lambda u: covers(u["narrow"])), lambda u: u["unit_index"]))
    narrow_unit = F.exists("units", lambda u: covers(F.concat(F.when(F.col("scope") == "all", F.col("tn")).otherwise(none), u["narrow"])))
    strict = F.when(F.col("scope") == "title", in_title).when(F.col("scope") == "body", narrow_unit).otherwise(narrow_unit | in_title)
    relaxed = F.when(F.col("scope") == "title", covers(F.col("tw"))).when(F.col("scope") == "body", covers(body("wide"))).otherwise(covers(F.concat(F.col("tw"), body("wide"))))
    text = per_doc.withColumns({"tw": F.coalesce("tw", none), "tn": F.coalesce("tn", none)}).join(meta.select("request", "n_slots", "scope"), "request")
    standing = text.select("request", "doc_id", in_title.alias("in_title"), F.get(units_full, 0).alias("best_unit"), strict.alias("strict"), relaxed.alias("relaxed"))
    pairs = standing.join(_addressed(index, plans), ["request", "doc_id"], "full_outer")
    everything = [r["request"] for r in meta.where("n_slots = 0 AND n_addresses = 0").select("request").collect()]  # requests without any word
    if everything:
        pairs = pairs.unionByName(index.documents.select("doc_id", F.explode(F.array(*map(F.lit, everything))).alias("request")), allowMissingColumns=True)
    x = pairs.join(meta, "request").join(index.documents.select("doc_id", "title_key", "title_forms", "title_addresses"), "doc_id")
    has_words = F.col("n_slots") > 0
    x = x.withColumns({"in_title": F.coalesce("in_title", F.lit(False)), **{c: F.coalesce(c, ~has_words) for c in ("strict", "relaxed")}})
    carries = has_words & F.col("in_title") & F.forall("addresses", lambda a: F.exists("title_addresses", lambda t: (t["kind"] == a["kind"]) & (t["number"] == a["number"]) & (a["subsection"].isNull() | t["subsection"].eqNullSafe(a["subsection"]))))
    x = x.where((F.col("n_addresses") == 0) | F.col("ref_unit").isNotNull() | carries)
    any_strict = x.groupBy("request").agg(F.bool_or("strict").alias("any_strict"))
    titles = {"same": F.arrays_overlap("title_forms", "identity"), "plain": F.col("title_key") == F.get("identity", 0), "subject": F.arrays_overlap("title_forms", "subject"), "within": F.contains("title_key", "subject_text")}
    out = _kinds(x.join(any_strict, "request").withColumns(titles))
    return out.join(scores(index, found), ["request", "doc_id"], "left") if with_scores else out


def _kinds(x: DataFrame, *more: str) -> DataFrame:
    """Kind, tier and rank by where the words stand (in_title, best_unit, ref_unit) and how the titles fit (same, plain, subject, within), of what meets the request: strictly if anything does in and-first (any_strict), else anywhere."""
    has_words, here = F.col("n_slots") > 0, F.col("ref_unit").isNotNull()
    x = x.where(F.when((F.col("mode") == "and-first") & F.col("any_strict"), F.col("strict")).otherwise(F.col("relaxed")))
    kind = (
        F.when(F.col("same"), "identity").when(here & (F.col("in_title") | ~has_words), "reference").when(F.col("in_title"), "title").when(here, "reference")
        .when(F.col("best_unit").isNotNull(), "unit").when(has_words, "body").otherwise("browse")
    )
    tier = F.when(F.col("same"), 0).when(here & (F.col("in_title") | ~has_words), 1).when(F.col("in_title"), 2).when(here, 3).when(F.col("best_unit").isNotNull(), 4).when(has_words, 5).otherwise(6)
    flag = lambda c: F.when(F.col(c), 0).otherwise(1)
    second = F.when(tier == 0, flag("plain")).when(tier == 1, flag("in_title")).when(tier == 2, flag("within")).when(tier == 4, F.col("best_unit")).otherwise(0)
    third = F.when(tier == 1, flag("subject")).otherwise(0)
    return x.select("request", "doc_id", kind.alias("kind"), tier.alias("tier"), F.array(tier, second, third).alias("rank"), F.coalesce("ref_unit", "best_unit").alias("best_unit"), "strict", *more)


def places(hits: DataFrame, limit: int, offset: int = 0) -> DataFrame:
    """request, doc_id, kind, position (1 …) of the page of each request; identity, addresses and titles by rank, hits in texts by score, ties by id."""
    from strataq.operators.listing import top_per_group

    by_rank = F.col("tier") <= 3
    keys = [F.when(by_rank, F.col("rank")[k]).otherwise(F.lit(4 if k == 0 else 0)) for k in range(3)]
    x = hits.withColumns({f"r{k}": c for k, c in enumerate(keys)}).withColumn("s", F.when(~by_rank, F.col("score")))
    order = [F.asc("r0"), F.asc("r1"), F.asc("r2"), F.asc_nulls_last("s"), F.asc("doc_id")]
    return top_per_group(x, ["request"], order, limit + offset, "position").where(F.col("position") > offset).select("request", "doc_id", "kind", "position")


def ranked(hits: DataFrame, limit: int, offset: int = 0) -> DataFrame:
    """request, doc_id, kind, position, total: ``places``, and how many hits the request has."""
    totals = hits.groupBy("request").agg(F.count("*").alias("total"))
    return places(hits, limit, offset).join(totals, "request")


def bm25(documents: DataFrame, requests: dict[str, list[str]], doc: str = "doc_id", title: str = "title", body: str = "body") -> DataFrame:
    """request, doc_id, score (lower is better) of every document that holds a word of the request, title words weighted; without an index, in one scan.

    The words of one request are alternatives. Empty texts count as documents.
    """
    wanted = sorted({w for ws in requests.values() for w in ws})
    tw, bw = tx.words(F.col(title)), tx.words(F.col(body))
    docs = documents.select(F.col(doc).alias("doc_id"), tw.alias("tw"), bw.alias("bw")).withColumn("dl", F.size("tw") + F.size("bw"))
    n_docs, avg_length = docs.agg(F.count("*").alias("x")).scalar(), docs.agg(F.avg("dl").alias("x")).scalar()  # two scalar subqueries over one scan each
    hits = (
        docs.select("doc_id", "dl", F.posexplode(F.concat("tw", "bw")).alias("pos", "term"), F.size("tw").alias("n_title"))
        .where(F.col("term").isin(wanted))
        .groupBy("doc_id", "dl", "term")
        .agg(F.sum(F.when(F.col("pos") < F.col("n_title"), TITLE_WEIGHT).otherwise(1)).alias("f"))
    )
    df = hits.groupBy("term").agg(F.count("*").alias("n"))
    ask_rows = documents.sparkSession.createDataFrame([(r, w) for r, ws in requests.items() for w in dict.fromkeys(ws)], "request string, term string")
    idf = F.greatest(F.log((n_docs - F.col("n") + 0.5) / (F.col("n") + 0.5)), F.lit(1e-6))
    weight = idf * F.col("f") * (K1 + 1) / (F.col("f") + K1 * (1 - B + B * F.col("dl") / avg_length))
    return (
        hits.join(F.broadcast(ask_rows), "term")
        .join(F.broadcast(df), "term")  # one row per word of the requests
        .groupBy("request", "doc_id")
        .agg(F.round(-F.sum(weight), 6).alias("score"))
    )
