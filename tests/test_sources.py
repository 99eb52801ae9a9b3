import io
import json
import zipfile

import pytest

from strataq.sources import corpus as cp
from strataq.sources import sinks as sk


def test_corpus(spark, tmp_path, rows):
    a = tmp_path / "west" / "a-gesetz"
    (a / "versions").mkdir(parents=True)
    (a / "meta.json").write_text(json.dumps({"jurisdiction": "west", "slug": "a-gesetz", "title": "A", "subjects": ["x"]}))
    (a / "versions" / "2024-01-01.json").write_text(json.dumps({"versionId": "2024-01-01", "simulationValidFrom": "2024-01-01", "body": [{"type": "paragraph", "text": "t"}]}))
    b = tmp_path / "ost" / "b"
    b.mkdir(parents=True)
    (b / "meta.json").write_text("kaputt")
    n = cp.read_norms(spark, str(tmp_path))
    assert rows(n, "id", "name_agrees") == sorted([("west:a-gesetz", True), ("", None)], key=repr)
    assert len(n.where("corrupt IS NOT NULL").collect()) == 1
    v = cp.read_versions(spark, str(tmp_path)).selectExpr("norm_id", "variant_get(body, '$[0].text', 'string') t").collect()
    assert [tuple(r) for r in v] == [("west:a-gesetz", "t")]
    assert cp.read_norms(spark, str(tmp_path / "none")).count() == 0
    assert cp.has_columns(n, {"id": "string", "x": "int", "title": "int"}) == ["x: missing instead of int", "title: string instead of int"]


def test_html(spark):
    page = "<html><head><title> Ein  Titel </title><script>x</script></head><body><nav>weg</nav><h1>Kopf</h1><p>Text <b>fett</b> &amp; mehr<!-- weg --></p><a href='/z'>Link</a><style>y</style></body></html>"
    from pyspark.sql import functions as F

    got = {r["i"]: r["p"] for r in spark.createDataFrame([(1, page), (2, None), (3, ""), (4, "<p>offen")], "i int, h string").select("i", cp.html_page(F.col("h")).alias("p")).collect()}
    assert got[1]["title"] == "Ein Titel" and [tuple(b) for b in got[1]["blocks"]] == [("h1", "Kopf"), ("p", "Text fett & mehr"), ("p", "Link")] and got[1]["links"] == ["/z"]
    assert got[2]["title"] is None and got[3]["blocks"] == [] and got[4]["blocks"][0]["text"] == "offen"


def test_xml_and_zip(spark, tmp_path, rows):
    files = spark.createDataFrame([("a", b"<r><x>1</x><y><z/></y></r>"), ("b", b"<r>"), ("c", b"<!DOCTYPE r><r/>"), ("d", b"<!-- " + b"x" * 9000 + b" --><!DOCTYPE r [<!ENTITY a 'aaaa'>]><r>&a;</r>")], "path string, content binary")
    got = cp.xml_nodes(files)
    assert rows(got.where("error IS NULL"), "path", "node", "parent", "tag", "text") == sorted([("a", 0, None, "r", ""), ("a", 1, 0, "x", "1"), ("a", 2, 0, "y", ""), ("a", 3, 2, "z", "")], key=repr)
    assert rows(got.where("error IS NOT NULL"), "path") == [("b",), ("c",), ("d",)]
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("d/one.txt", "eins")
        z.writestr("two.txt", "x" * 50)
        z.writestr("empty.txt", "")
    e = cp.zip_entries(spark.createDataFrame([("p", buffer.getvalue()), ("q", b"nichts")], "path string, content binary"), 40)
    assert rows(e, "path", "entry", "piece", "pieces", "error") == sorted([("p", "d/one.txt", 0, 1, None), ("p", "two.txt", 0, 2, None), ("p", "two.txt", 1, 2, None), ("p", "empty.txt", 0, 1, None), ("q", None, None, None, "File is not a zip file")], key=repr)
    assert b"".join(bytes(r["content"]) for r in sorted(e.where("entry = 'two.txt'").collect(), key=lambda r: r["piece"])) == b"x" * 50
    (tmp_path / "x.xml").write_text("<l><n><a>1</a></n><n><a>2</a></n></l>")
    assert rows(cp.read_xml_rows(spark, str(tmp_path / "x.xml"), "n", "a int")) == [(1,), (2,)]
    inv = cp.inventory(spark, str(tmp_path / "*")).first()
    assert inv["media_type"] == "application/xml" and inv["object_key"] == f"objects/{inv['sha256'][:2]}/{inv['sha256']}"


def test_scale_corpus(spark, rows):
    c = cp.scale_corpus(spark, 200)
    assert c.count() == 220 and rows(c) == rows(cp.scale_corpus(spark, 200).repartition(3))
    m = cp.mutate_corpus(c)
    assert 0 < m.count() < 220


def test_publications(spark, tmp_path, rows):
    root = str(tmp_path / "pub")
    t = spark.createDataFrame([(i, f"t{i}") for i in range(20)], "k int, v string")
    assert sk.current(spark, root) is None
    with pytest.raises(ValueError):
        sk.read_table(spark, root, "t")
    one = sk.publish(root, {"t": t})
    assert rows(sk.read_table(spark, root, "t")) == rows(t)
    assert sk.publish_changes(root, {"t": t}, {"t": "k"}, one["fingerprint"]) == one
    new = t.where("k != 3").union(spark.createDataFrame([(99, "neu")], "k int, v string"))
    two = sk.publish_changes(root, {"t": new}, {"t": "k"}, one["fingerprint"])
    assert two["generation"] == 2 and rows(sk.read_table(spark, root, "t")) == rows(new)
    with pytest.raises(sk.StaleBase):
        sk.publish_changes(root, {"t": t}, {"t": "k"}, one["fingerprint"])
    written = lambda g: {p.name for p in (tmp_path / "pub" / "t" / f"generation={g}").glob("key_bucket=*")}
    assert len(written(2)) <= 2 < len(written(1))  # the bucket that lost a row may be empty now
    three = sk.publish_changes(root, {"t": new.where("k != 99")}, {"t": "k"}, two["fingerprint"])
    assert rows(sk.read_table(spark, root, "t")) == rows(new.where("k != 99")) and three["generation"] == 3
    none = sk.publish_changes(root, {"t": new.limit(0)}, {"t": "k"}, three["fingerprint"])
    assert sk.read_table(spark, root, "t").count() == 0 and none["generation"] == 4
    full = sk.publish(str(tmp_path / "other"), {"t": new})
    assert full["fingerprint"] == two["fingerprint"]


def test_bounded_files(spark):
    df = spark.createDataFrame([(f"g{i % 30}" if i % 30 else None, i, 10) for i in range(300)] + [("big", i, 10) for i in range(50)], "g string, i int, s int")
    got = sk.bounded_files(df, "g", "s", 25, 240).collect()
    assert len(got) == 350
    files, of = {}, {}
    for r in got:
        files.setdefault(r["file"], []).append(r)
        of.setdefault(r["g"], set()).add(r["file"])
    assert all(len(f) == 1 for f in of.values())
    assert all(len(f) <= 25 or {r["g"] for r in f} == {"big"} for f in files.values())
    assert sk.bounded_files(df.limit(0), "g", "s", 25, 240).count() == 0
