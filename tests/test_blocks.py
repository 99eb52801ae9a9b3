import json

from strataq.operators import trees
from strataq.operators.blocks import BLOCK_KEYS, assemble_parts, block_text
from strataq.operators.deliveries import latest_rows

S = "norm_id string, version_id string, block_index int, part_index int, part_count int, block_json string, _i int"


def test_assemble(spark, rows):
    data = [
        ("n", "v", 0, 0, 1, "{}", 5), ("n", "v", 0, 0, 1, "{}", 5),  # delivered twice
        ("n", "v", 1, 1, 2, "b", 5), ("n", "v", 1, 0, 2, "a", 5), ("n", "v", 1, 0, 2, "a", 5),
        ("n", "v", 2, 0, 3, "a", 5), ("n", "v", 2, 2, 3, "c", 5),  # a part is missing
        ("n", "v", 3, 0, 2, "a", 5), ("n", "v", 3, 1, 2, None, 5),
        ("n", "v", 4, 0, None, "x", 5), ("n", "v", 5, 3, 2, "x", 5),
        ("n", None, 6, 1, 2, "2", 5), ("n", None, 6, 0, 2, "1", 5),
    ]
    got = rows(assemble_parts(spark.createDataFrame(data, S), BLOCK_KEYS), "version_id", "block_index", "block_json")
    assert got == sorted([("v", 0, "{}"), ("v", 0, "{}"), ("v", 1, "ab"), (None, 6, "12")], key=repr)
    assert assemble_parts(spark.createDataFrame([], S), BLOCK_KEYS).count() == 0
    long = spark.createDataFrame([("n", "v", 0, 0, 2, "x" * 60_000, 1), ("n", "v", 0, 1, 2, "y" * 60_000, 1), ("n", "v", 1, 0, 1, "z" * 10, 1)], S)
    assert rows(assemble_parts(long, BLOCK_KEYS, least_length=100), "block_json") == [("x" * 60_000 + "y" * 60_000,)]


def test_block_text():
    block = {"type": "x", "label": "§ 1", "title": "", "text": "T", "children": [{"label": "(1)", "children": [{"text": "a"}]}, {"text": None, "title": "b"}, 7]}
    assert block_text(json.dumps(block)) == "§ 1\nT\n(1)\na\nb"
    assert block_text("[1]") is None and block_text("{") is None and block_text(None) is None and block_text("{}") == ""
    deep = '{"children":[' * 500 + "{}" + "]}" * 500
    assert block_text(deep) == ""


def test_latest_rows(spark, rows):
    df = spark.createDataFrame([("a", 1, "x", 0), ("a", 2, "y", 0), ("a", 2, "z", 0), ("b", None, "n", 0), ("c", None, "m", 0), ("c", 0, "l", 0), (None, 1, "q", 0)], "k string, t int, v string, extra int")
    assert rows(latest_rows(df, ["k"], "t", ["v"])) == sorted([("a", "z"), ("b", "n"), ("c", "l"), (None, "q")], key=repr)
    assert latest_rows(df.limit(0), ["k"], "t", ["v"]).count() == 0


def test_trees(spark, rows):
    body = {"type": "article", "label": "Artikel 1", "children": [
        {"type": "paragraph", "label": "§ 1", "title": "Eins", "children": [{"type": "subparagraph", "label": "(1)", "text": "a"}, {"type": "subparagraph", "label": "(2)", "text": "b"}, {"type": "signature", "text": "gez."}]},
        {"type": "paragraph", "label": "§ 1", "text": "doppelt"},
        {"type": "quotedProvision", "children": [{"type": "paragraph", "label": "§ 9", "text": "zitiert"}]}]}
    df = spark.createDataFrame([("n", "v", 0, json.dumps(body)), ("n", "v", 1, "kaputt"), ("n", "v", 2, None)], "norm_id string, version_id string, block_index int, block_json string")
    nodes = trees.flatten(df)
    anchors = {tuple(r["path"]): r["anchor"] for r in trees.unique_anchors(nodes.where("anchor IS NOT NULL")).collect()}
    assert anchors == {(0,): "artikel-1", (0, 0): "artikel-1-paragraph-1", (0, 1): "artikel-1-paragraph-1--0-1", (0, 2, 0): "zitat-paragraph-9"}
    units = {tuple(r["unit_path"]): (r["heading"], r["body"], r["subsections"]) for r in trees.units(nodes).collect()}
    assert units == {(0,): ("Artikel 1", "zitiert", []), (0, 0): ("Eins", "a\n\nb", ["1", "2"]), (0, 1): ("§ 1", "doppelt", [])}
    assert trees.table_fingerprint({"children": [{"children": [{"text": " a  b "}]}]}) == trees.table_fingerprint({"children": [{"children": [{"text": "a b"}]}]})
