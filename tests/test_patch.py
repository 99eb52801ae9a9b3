import copy
import json

import pytest

from strataq.operators import patch as pt

BODY = [{"type": "paragraph", "label": "§ 1", "title": "A", "text": "alt und alt"}, {"type": "paragraph", "label": "§ 2", "children": [{"type": "table", "label": "T"}]}, {"type": "annex", "label": "Anlage"}]
STATE = {"title": "Gesetz", "body": BODY}


def op(name, **more):
    return {"op": name, "expectedMatches": 1, "source": "s", "sourceProvision": "p", "effectiveDate": "2026-01-01"} | more


def run(*ops):
    before = copy.deepcopy(STATE)
    out = pt.apply_recipe(STATE, {"effectiveDate": "2026-01-01", "operations": list(ops)})
    assert STATE == before
    return out


def at(label):
    return {"target": {"label": label}, "expectedHash": pt.content_hash(next(b for b in BODY if b["label"] == label))}


NEW = {"type": "paragraph", "label": "§ 9", "text": "neu"}


@pytest.mark.parametrize(
    "operation, look",
    [
        (op("replaceProvision", value=NEW, **at("§ 1")), lambda b: b[0] == NEW and len(b) == 3),
        (op("insertProvisionBefore", value=NEW, **at("§ 1")), lambda b: b[0] == NEW and len(b) == 4),
        (op("insertProvisionAfter", value=NEW, **at("§ 1")), lambda b: b[1] == NEW),
        (op("insertParagraph", value=NEW, **at("§ 2")), lambda b: b[1]["children"][-1] == NEW),
        (op("insertParagraph", value=NEW, position="start", **at("§ 2")), lambda b: b[1]["children"][0] == NEW),
        (op("repealProvision", **at("§ 1")), lambda b: b[0]["text"] == "(weggefallen)" and b[0]["children"] == []),
        (op("repealProvision", **at("§ 2")), lambda b: b[1]["children"] == [{"type": "paragraphText", "text": "(weggefallen)"}]),
        (op("deleteProvision", **at("§ 1")), lambda b: len(b) == 2),
        (op("renameProvision", value="§ 1a", **at("§ 1")), lambda b: b[0]["label"] == "§ 1a"),
        (op("replaceHeading", value="B", **at("§ 1")), lambda b: b[0]["title"] == "B"),
        (op("replaceText", value="neu", target={"label": "§ 1"}, expectedOld="alt und alt"), lambda b: b[0]["text"] == "neu"),
        (op("amendTable", value={"type": "table", "label": "U"}, target={"type": "table", "parentLabel": "§ 2"}, expectedHash=pt.content_hash(BODY[1]["children"][0])), lambda b: b[1]["children"][0]["label"] == "U"),
        (op("appendAnnex", value={"type": "annex"}, **at("Anlage")), lambda b: b[-1] == {"type": "annex"}),
        (op("designationReplacement", expectedOld="alt", value="neu", target={"label": "§ 1"}, expectedMatches=2), lambda b: b[0]["text"] == "neu und neu"),
        (op("designationReplacementBody", expectedOld="alt", value="neu", expectedMatches=2), lambda b: b[0]["text"] == "neu und neu"),
        (op("replaceBody", value=[], expectedHash=pt.content_hash(BODY)), lambda b: b == []),
        (op("replaceSiblingRange", value=[NEW], target={"label": "§ 1"}, throughTarget={"label": "§ 2"}, expectedHash=pt.content_hash(BODY[:2])), lambda b: len(b) == 2 and b[0] == NEW),
    ],
)
def test_operations(operation, look):
    assert look(run(operation)["body"])


def test_whole_entity():
    assert run(op("renameLaw", value="Neu", expectedOld="Gesetz"))["title"] == "Neu"
    assert run(op("renameLaw", value="Gesetz", expectedOld="egal"))["title"] == "Gesetz"
    assert run(op("repealLaw", expectedHash=pt.content_hash({"title": "Gesetz", "body": BODY})))["repealed"]


@pytest.mark.parametrize(
    "operation",
    [
        op("unknown", **at("§ 1")), op("deleteProvision", target={"type": "paragraph"}, expectedOld="x"), op("deleteProvision", target={"label": "?"}, expectedOld="x"),
        op("replaceText", value="n", target={"label": "§ 1"}, expectedOld="anders"), op("replaceText", value=3, **at("§ 1")), op("deleteProvision", target={"label": "§ 1"}), op("deleteProvision", **at("§ 1") | {"expectedMatches": 2}),
        op("deleteProvision", **at("§ 1") | {"effectiveDate": "2027-01-01"}), op("deleteProvision", **at("§ 1") | {"source": ""}), op("designationReplacementBody", expectedOld="alt", value="n", expectedMatches=3),
        op("amendTable", value=NEW, **at("§ 1")), op("repealLaw", expectedHash="0"), op("renameLaw", value="x", expectedOld="falsch"), op("deleteProvision", target={"label": "§ 1"}, expectedHash="0"),
    ],
)
def test_refusals(operation):
    with pytest.raises(pt.Refused):
        run(operation)


def test_consolidate(spark, rows):
    states = spark.createDataFrame([("a", json.dumps(STATE), 1), ("b", json.dumps(STATE), 1), ("idle", json.dumps(STATE), 1), (None, "{}", 1)], "k string, state_json string, status int")
    good = json.dumps({"effectiveDate": "2026-01-01", "operations": [op("renameProvision", value="§ 1a", **at("§ 1"))]})
    later = json.dumps({"effectiveDate": "2026-02-01", "operations": [op("renameProvision", value="§ 1b", target={"label": "§ 1a"}, expectedOld="§ 1a", field="label") | {"effectiveDate": "2026-02-01"}]})
    recipes = spark.createDataFrame([("a", "2026-02-01", 1, later), ("a", "2026-01-01", 1, good), ("b", "2026-01-01", 1, later), ("b", "2026-03-01", 1, good), ("c", "2026-01-01", 1, good), ("b", "2026-04-01", 1, "kaputt")], "k string, effective_date string, seq int, recipe_json string")
    got = rows(pt.consolidate(states, recipes, "k"), "k", "effective_date", "status")
    assert got == [("a", "2026-01-01", "applied"), ("a", "2026-02-01", "applied"), ("b", "2026-01-01", "refused"), ("b", "2026-03-01", "blocked"), ("b", "2026-04-01", "blocked"), ("c", "2026-01-01", "refused")]


def test_versions_per_date(spark, rows):
    done = [("a", "2026-01-01", 1, "applied", None, "x"), ("a", "2026-01-01", 2, "applied", None, "y"), ("a", "2026-02-01", 3, "applied", None, "z"), ("a", "2026-02-01", 4, "refused", "Grund", None), ("a", "2026-03-01", 5, "blocked", "früher", None)]
    got = pt.versions_per_date(spark.createDataFrame(done, "k string, effective_date string, seq int, status string, reason string, state_json string"), "k")
    assert rows(got, "effective_date", "status", "recipes", "reason", "state_json") == [("2026-01-01", "applied", 2, None, "y"), ("2026-02-01", "refused", 2, "Grund", None), ("2026-03-01", "blocked", 1, "früher", None)]


def test_wording(spark, rows):
    texts = spark.createDataFrame([("a", 1, "Die Gemeinde zahlt"), ("a", 2, "Das Land-Recht"), ("a", 3, "fehlt"), ("a", 4, ""), ("a", 5, None), ("b", 1, "Die Gemeinde zahlt")], "k string, place int, text string")
    extracts = spark.createDataFrame([("a", "§ 1 Die Ge-\nmein\u00adde   zahlt."), ("a", "Das LandRecht gilt"), ("a", None)], "k string, extract string")
    assert rows(pt.wording_check(texts, extracts, "k")) == [("a", 1, "exact"), ("a", 2, "loose"), ("a", 3, "missing"), ("a", 4, "exact"), ("b", 1, "missing")]


def test_file_plan(spark, rows):
    planned = spark.createDataFrame([("a", "1", None), ("b", "1", "0"), ("c", "1", "0"), ("d", "1", "0")], "path string, sha256 string, base_sha256 string")
    existing = spark.createDataFrame([("b", "1"), ("c", "0"), ("d", "9"), ("e", "1")], "path string, sha256 string")
    assert rows(pt.file_plan(planned, existing)) == [("a", "new"), ("b", "unchanged"), ("c", "update"), ("d", "conflict"), ("e", "orphan")]
