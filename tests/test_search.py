"""The kept index and batches of requests on small tables."""

import pytest

from strataq.operators import search_index as si

DOCS = [
    (1, "Gesetz über den Wald\n\n§ 1 Forstfläche\n(1) Der Wald ist zu schonen.\n(2) Kosten trägt der Bund.\n\n§ 2 Strafen\nWer Bäume fällt, zahlt."),
    (2, "Verordnung über Kosten\n\n§ 1 Kosten\n(1) Kosten sind zu zahlen.\n\nNr. 2.1 Bund\nDer Wald bleibt."),
    (3, "Satzung zu § 5 des Waldgesetzes\n\nArtikel IV\nBäume im Wald, sie sind hoch."),
    (4, None),
    (5, ""),
    (6, "Großstraße\n\nEine Strasse im Wald der Bäume."),
]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    return si.keep_index(si.index_of(spark.createDataFrame(DOCS, "doc_id long, text string")), str(tmp_path_factory.mktemp("index")))


def found(spark, index, query, mode="and-first", scope="all"):
    hits = si.search(index, si.request_table(spark, {"q": query}, mode, scope))
    return sorted((r["doc_id"], r["kind"]) for r in hits.collect())


CASES = [
    ("Wald Kosten", {}, [(1, "unit"), (2, "body")]),  # one unit holds both; or does with the title
    ("Strafen Bund", {}, [(1, "body")]),  # no unit has both, so the fallback
    ("Wal", {"mode": "or-prefix"}, []),  # too short to be a beginning
    ("Wald*", {}, [(1, "title"), (2, "unit"), (3, "title"), (6, "unit")]),
    ("Gesetz über den Wald", {}, [(1, "identity")]),
    ("§ 1", {}, [(1, "reference"), (2, "reference")]),
    ("§ 1 Absatz 2", {}, [(1, "reference")]),
    ("§ 1 Kosten", {}, [(1, "reference"), (2, "reference")]),
    ("§ 5 Satzung", {}, [(3, "title")]),  # the title itself holds the address
    ("§ 9 Satzung", {}, []),
    ("Artikel IV", {}, [(3, "reference")]),
    ("Nr. 2.1", {}, [(2, "reference")]),
    ("„Kosten sind“", {}, [(2, "unit")]),
    ("„sind Kosten“", {}, []),
    ("Strasse", {}, [(6, "unit")]),
    ("grossstrasse", {}, [(6, "identity")]),
    ("Wald", {"scope": "title"}, [(1, "title"), (3, "title")]),
    ("Bäume Wald", {"scope": "body"}, [(3, "unit"), (6, "unit")]),
    ("", {}, [(i, "browse") for i in range(1, 7)]),
    ("unbekannt Wald", {}, []),
]


@pytest.mark.parametrize("query, how, hits", CASES)
def test_search(spark, index, query, how, hits):
    assert found(spark, index, query, **how) == hits


def test_all_requests_at_once_by_joined_words_too(spark, index, monkeypatch):
    """One batch with nulls and repeats gives what single requests give, also where words are joined instead of pushed down."""
    rows = [(f"{i}", q, how.get("mode"), how.get("scope")) for i, (q, how, _) in enumerate(CASES)] + [(None, "x", None, None), ("n", None, None, None)]
    requests = spark.createDataFrame(rows, "request string, query string, mode string, scope string")
    for pushed in (si.PUSHED_TERMS, 0):
        monkeypatch.setattr(si, "PUSHED_TERMS", pushed)
        got = {}
        for r in si.search(index, requests).collect():
            got.setdefault(r["request"], []).append((r["doc_id"], r["kind"]))
        assert all(sorted(got.get(f"{i}", [])) == hits for i, (_, _, hits) in enumerate(CASES)) and set(got) <= {f"{i}" for i in range(len(CASES))}


def test_pages_and_totals(spark, index):
    hits = si.search(index, si.request_table(spark, {"a": "Wald*", "b": "§ 1"}))
    page = {(r["request"], r["position"]): (r["doc_id"], r["total"]) for r in si.ranked(hits, 2, 1).collect()}
    assert set(page) == {("a", 2), ("a", 3), ("b", 2)} and page["a", 2] == (3, 4) and page["b", 2][1] == 2
    score = {r["doc_id"]: r["score"] for r in si.search(index, si.request_table(spark, {"a": "Kosten"})).collect()}
    assert score[2] < score[1] < 0  # in the title and a heading


def test_maintenance(spark, index, rows):
    new = [(2, "Neu\n\nganz neu"), (7, "Wald\n\nmehr")]
    kept = si.changed_index(index, spark.createDataFrame(new, "doc_id long, text string"), spark.createDataFrame([(3,), (99,)], "doc_id long"))
    now = [d for d in DOCS if d[0] not in (2, 3)] + new
    fresh = si.index_of(spark.createDataFrame(now, "doc_id long, text string"))
    for part in si.PARTS:
        assert rows(getattr(kept, part), *getattr(fresh, part).columns) == rows(getattr(fresh, part))
    assert si.integrity(kept, spark.createDataFrame(now, "doc_id long, text string")).count() == 0
    assert rows(si.integrity(index, spark.createDataFrame(now, "doc_id long, text string"))) == [(2, "differs"), (3, "left-over"), (7, "missing")]


def test_empty_index(spark):
    empty = si.index_of(spark.createDataFrame([], "doc_id long, text string"))
    assert si.search(empty, si.request_table(spark, {"a": "Wald", "b": "", "c": "§ 1"})).count() == 0


def test_all_requests_by_a_scan_of_the_documents(spark, index, monkeypatch):
    """The scan gives what the index gives, rank and score too, in every mode and scope, also where the requests are cut into slices."""
    from strataq.operators import bulk_search as bs

    more = ["Straße Bäume", "„sie sind hoch“ „sind hoch“ Wald", "Kost* Bun", "die", "Gesetz", "ist zu", "„Bäume im Wald“", "Wald wald* Wälder"]
    rows = [(f"{i} {m} {s}", q, m, s) for i, q in enumerate([q for q, *_ in CASES] + more) for m in ("and-first", "or-prefix") for s in ("all", "title", "body")]
    requests = spark.createDataFrame([*rows, (None, "x", None, None), ("n", None, None, None)], "request string, query string, mode string, scope string")
    shown = lambda df: sorted((tuple(x) for x in df.select("request", "doc_id", "kind", "tier", "best_unit", "strict", "score", "rank").collect()), key=repr)
    want = shown(si.search(index, requests))
    for size in (bs.SLICE, 40):
        monkeypatch.setattr(bs, "SLICE", size)
        assert shown(bs.search_all(spark.createDataFrame(DOCS, "doc_id long, text string"), requests)) == want
    assert bs.search_all(spark.createDataFrame([], "doc_id long, text string"), requests).count() == 0


def test_golden_requests_write_no_index(spark, tmp_path, monkeypatch):
    """An index and the pairs of requests and documents with one word in common took more disk than any budget."""
    from strataq.queries import search as qs

    monkeypatch.setattr(qs, "kept_index", None)
    assert sum(r["n"] for r in qs.search_audit(spark, "/root/testdata/sf0.001").collect()) == sum(r["n"] for r in qs.batch_golden_metrics(spark, "/root/testdata/sf0.001").collect()) > 0


def test_first_hits_of_all_requests(spark, index, monkeypatch):
    """The first places of each request taken as words, strict hits before any other, also by several tasks and slices."""
    from pyspark.sql import functions as F

    from strataq.operators import bulk_search as bs

    more = [(10 + i, f"Satzung {'Wald' if i % 3 else 'Kosten'}\n\n§ 1 Bäume\nKosten {'im Wald ' * (i % 4)}der Bäume.\n\nStraße {i}") for i in range(30)]
    docs = spark.createDataFrame(DOCS + more, "doc_id long, text string")
    asked = ["Wald Kosten", "Strafen Bund", "Bäume Wald", "Großstraße", "Satzung Wald", "Kosten", "Bund Bäume", "Straße der Bäume", "unbekannt Wald", "die", "Satzung Straße 7"]
    requests = spark.createDataFrame([(f"{i}", q) for i, q in enumerate(asked)], "request string, query string")
    hits = si.places(bs.search_all(docs, requests.withColumns({"mode": F.lit("and-first"), "scope": F.lit("all")})), 3)
    want = sorted(tuple(x) for x in hits.select("request", "doc_id", "position").collect())
    assert len(want) == 17
    for size, parts in ((bs.SLICE, 4), (2, 3)):
        monkeypatch.setattr(bs, "SLICE", size)
        assert sorted(tuple(x) for x in bs.first_hits(docs.repartition(parts), requests, 3).collect()) == want
    assert bs.first_hits(docs, requests.limit(0), 3).count() == bs.first_hits(docs.limit(0), requests, 3).count() == 0


def test_golden_requests_give_out_first_hits_only(spark, tmp_path, rows):
    """All hits of all requests grow as requests times documents; ten a request and task do not. Titles that look like addresses, phrases or prefixes are words, as in the SQL."""
    import sys
    from pathlib import Path

    from strataq.queries import search as qs

    sys.path.insert(0, str(Path(__file__).parent))
    import duckdb
    import oracle

    titles = ["Satzung zu § 5 des Waldgesetzes", "Bund „der Wald“ Kosten", "Wald*", "Waldgesetz", "§ 1 Wald", "der Wald Kosten Bund", "***", "Satzung zu 5 des Waldgesetzes"]
    data = [(i + 1, f"{t}\n\n§ {i % 6} Forstfläche{i % 3}\n(1) Der Wald und Satzung zu § {i % 7} des Waldgesetzes.\n\n§ 5 Kosten\nBund", "norm_text") for i, t in enumerate(titles * 2)]
    data += [(100 + i, f"Satzung des Waldgesetzes zu 5 Teil {i}\n\n§ 5 Bund\nder Wald Kosten", "circular") for i in range(12)]
    spark.createDataFrame(data, "doc_id long, text string, doc_type string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    for name in ("batch_golden_metrics", "search_audit"):
        assert oracle.spark_rows(qs.QUERIES[name](spark, str(tmp_path))) == oracle.sql_rows(con, qs.SQL[name])
