"""Amendment recipes: ordered, checked changes to a stored body.

A recipe is applied or refused as a whole. Every operation states what it
expects to find (a hash, an old value, a number of hits), and anything else
refuses it; nothing is guessed. Entities are independent: an entity's recipes
are gathered in (effective date, order) and meet its state in one row, and rows
are worked in batches.
"""

from __future__ import annotations

import copy
import hashlib
import json
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Refused(ValueError):
    """A recipe whose expectations do not hold."""


def content_hash(value: Any) -> str:
    """SHA-256 of the JSON with sorted keys."""
    return hashlib.sha256(json.dumps(value, sort_keys=True, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()


def _find(body: list[dict], target: dict) -> list[tuple[list[dict], int]]:
    """Places (sibling list, index) of the blocks that meet the target."""
    found, stack = [], [(body, None)]
    while stack:
        siblings, parent = stack.pop()
        for i, b in enumerate(siblings):
            ok = all(b.get(k) == target[k] for k in ("type", "label", "title", "text") if target.get(k))
            ok = ok and all((parent or {}).get(k) == target[p] for p, k in (("parentType", "type"), ("parentLabel", "label")) if target.get(p))
            if ok:
                found.append((siblings, i))
            if isinstance(b.get("children"), list):
                stack.append((b["children"], b))
    return found


def _one(body: list[dict], target: dict | None) -> tuple[list[dict], int]:
    if not target:
        raise Refused("no target")
    places = _find(body, target)
    if len(places) != 1:
        raise Refused(f"{len(places)} hits instead of one")
    return places[0]


def _replace_all(value: Any, old: str, new: str) -> tuple[Any, int]:
    if isinstance(value, str):
        return value.replace(old, new), value.count(old)
    if isinstance(value, list):
        pairs = [_replace_all(v, old, new) for v in value]
        return [p[0] for p in pairs], sum(p[1] for p in pairs)
    if isinstance(value, dict):
        pairs = {k: _replace_all(v, old, new) for k, v in value.items()}
        return {k: p[0] for k, p in pairs.items()}, sum(p[1] for p in pairs.values())
    return value, 0


def _expect_hits(n: int, op: dict) -> None:
    if n != op["expectedMatches"]:
        raise Refused(f"{n} hits instead of {op['expectedMatches']}")


def _expect_hash(value: Any, op: dict) -> None:
    if content_hash(value) != op.get("expectedHash"):
        raise Refused("hash differs")


def _block(op: dict) -> dict:
    if not isinstance(op.get("value"), dict):
        raise Refused("value must be a block")
    return copy.deepcopy(op["value"])


def _text(op: dict) -> str:
    if not isinstance(op.get("value"), str):
        raise Refused("value must be a text")
    return op["value"]


def _blocks(op: dict) -> list:
    if not isinstance(op.get("value"), list):
        raise Refused("value must be a list of blocks")
    return copy.deepcopy(op["value"])


# --- operations on the whole entity ---


def _rename_law(state: dict, op: dict) -> None:
    name = op.get("field") or "title"
    if name not in ("title", "shortTitle", "abbr"):
        raise Refused("unknown field")
    if state.get(name) == _text(op):
        return
    if not op.get("expectedOld") or state.get(name) != op["expectedOld"]:
        raise Refused("old value differs")
    state[name] = op["value"]


def _repeal_law(state: dict, op: dict) -> None:
    _expect_hash({"title": state["title"], "body": state["body"]}, op)
    state["repealed"] = True


def _replace_body(state: dict, op: dict) -> None:
    value = _blocks(op)
    _expect_hash(state["body"], op)
    state["body"] = value


def _designation_everywhere(state: dict, op: dict) -> None:
    body, n = _replace_all(state["body"], op["expectedOld"], _text(op))
    _expect_hits(n, op)
    state["body"] = body


# --- operations on one block: (siblings, index, operation, state) ---


def _repeal(s: list, i: int, op: dict, state: dict) -> None:
    note = op.get("value") if op.get("value") is not None else "(weggefallen)"
    if not isinstance(note, str):
        raise Refused("value must be a text")
    if "text" in s[i]:
        s[i] |= {"text": note, "children": []}
    else:
        s[i]["children"] = [{"type": "paragraphText", "text": note}]


def _insert_paragraph(s: list, i: int, op: dict, state: dict) -> None:
    children = s[i].setdefault("children", [])
    children.insert(0 if op.get("position") == "start" else len(children), _block(op))


def _amend_table(s: list, i: int, op: dict, state: dict) -> None:
    if s[i].get("type") != "table":
        raise Refused("target is no table")
    s[i] = _block(op)


def _designation(s: list, i: int, op: dict, state: dict) -> None:
    block, n = _replace_all(s[i], op["expectedOld"], _text(op))
    _expect_hits(n, op)
    s[i] = block


def _set(name: str) -> Callable:
    def run(s: list, i: int, op: dict, state: dict) -> None:
        s[i][name] = _text(op)

    return run


def _replace_range(s: list, i: int, op: dict, state: dict) -> None:
    end, j = _one(state["body"], op.get("throughTarget"))
    if end is not s or j < i:
        raise Refused("range ends elsewhere")
    _expect_hash(s[i : j + 1], op)
    s[i : j + 1] = _blocks(op)


# The names of the operations, as recipes use them.
WHOLE = {"renameLaw": _rename_law, "repealLaw": _repeal_law, "replaceBody": _replace_body, "designationReplacementBody": _designation_everywhere}
AT_BLOCK: dict[str, Callable] = {
    "replaceProvision": lambda s, i, op, state: s.__setitem__(i, _block(op)),
    "insertProvisionBefore": lambda s, i, op, state: s.insert(i, _block(op)),
    "insertProvisionAfter": lambda s, i, op, state: s.insert(i + 1, _block(op)),
    "deleteProvision": lambda s, i, op, state: s.pop(i),
    "appendAnnex": lambda s, i, op, state: state["body"].append(_block(op)),
    "replaceText": lambda s, i, op, state: s[i].__setitem__(op.get("field") or "text", _text(op)),
    "renameProvision": _set("label"),
    "replaceHeading": _set("title"),
    "repealProvision": _repeal,
    "insertParagraph": _insert_paragraph,
    "amendTable": _amend_table,
    "designationReplacement": _designation,
    "replaceSiblingRange": _replace_range,
}
#: Operations that check their expectations themselves.
_OWN_CHECK = {"replaceSiblingRange"}


def _contract(op: dict, day: str) -> None:
    name = op.get("op")
    if name not in WHOLE and name not in AT_BLOCK:
        raise Refused(f"unknown operation {name}")
    for f in ("source", "sourceProvision", "effectiveDate"):
        if not op.get(f):
            raise Refused(f"{f} is missing")
    if op["effectiveDate"] != day:
        raise Refused("effective date differs from the recipe's")
    n = op.get("expectedMatches")
    if not isinstance(n, int) or isinstance(n, bool) or n < 1:
        raise Refused("expectedMatches must be at least 1")
    if n != 1 and not name.startswith("designation"):
        raise Refused("exactly one hit is needed")
    if name != "renameLaw" and not op.get("expectedHash") and op.get("expectedOld") is None:
        raise Refused("neither expectedHash nor expectedOld")
    if name.startswith("designation") and not isinstance(op.get("expectedOld"), str):
        raise Refused("expectedOld must be a text")


def apply_recipe(state: dict, recipe: dict) -> dict:
    """The state {title, shortTitle?, abbr?, body, repealed?} after the recipe {effectiveDate, operations}; the input stays as it is. Refused if any expectation fails."""
    if not recipe.get("operations"):
        raise Refused("no operations")
    out = copy.deepcopy(state)
    for op in recipe["operations"]:
        _contract(op, recipe.get("effectiveDate"))
        if op["op"] in WHOLE:
            WHOLE[op["op"]](out, op)
            continue
        siblings, i = _one(out["body"], op.get("target"))
        if op["op"] not in _OWN_CHECK:
            if op.get("expectedHash"):
                _expect_hash(siblings[i], op)
            if op.get("expectedOld") is not None and op["op"] != "designationReplacement" and siblings[i].get(op.get("field") or "text") != op["expectedOld"]:
                raise Refused("old value differs")
        AT_BLOCK[op["op"]](siblings, i, op, out)
    return out


def consolidate(states: DataFrame, recipes: DataFrame, key: str) -> DataFrame:
    """key, effective_date, seq, status (applied, refused or blocked), reason, state_json: the state after each recipe, each from the last good one.

    states(key, state_json), recipes(key, effective_date, seq, recipe_json).
    A refused recipe leaves the state and stops the entity's later recipes
    (``blocked``). Entities without recipes give nothing; recipes without a
    state are refused. Null keys give nothing; of several states the smallest
    text holds.
    """

    wanted = recipes.where(f"{key} IS NOT NULL").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("effective_date", F.col("seq").cast("int").alias("seq"), "recipe_json"))).alias("ops"))
    one = states.where(f"{key} IS NOT NULL").groupBy(key).agg(F.min("state_json").alias("state_json"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, stored, ops in zip(b[key], b["state_json"], b["ops"]):
                state, blocked = json.loads(stored) if stored is not None else None, False
                for op in ops:
                    day = op["effective_date"]
                    if blocked:
                        rows.append((k, day, op["seq"], "blocked", "an earlier recipe was refused", None))
                        continue
                    try:
                        if state is None:
                            raise Refused("no state")
                        state = apply_recipe(state, json.loads(op["recipe_json"]))
                        rows.append((k, day, op["seq"], "applied", None, json.dumps(state, ensure_ascii=False)))
                    except (Refused, ValueError, TypeError) as x:
                        blocked = True
                        rows.append((k, day, op["seq"], "refused", str(x), None))
            yield pd.DataFrame(rows, columns=[key, "effective_date", "seq", "status", "reason", "state_json"])

    return wanted.join(one, key, "left").select(key, "state_json", "ops").mapInPandas(run, f"{key} string, effective_date string, seq int, status string, reason string, state_json string")


def versions_per_date(done: DataFrame, key: str) -> DataFrame:
    """key, effective_date, status, recipes, reason, state_json: of consolidate's rows one version per date, the state after its last recipe; a date one of whose recipes is refused or blocked has no version and its first reason."""
    g = done.groupBy(key, "effective_date").agg(
        F.count("*").alias("recipes"), F.bool_and(F.col("status") == "applied").alias("_ok"), F.bool_or(F.col("status") == "refused").alias("_refused"),
        F.min(F.when(F.col("reason").isNotNull(), F.struct("seq", "reason")))["reason"].alias("reason"), F.max(F.struct("seq", "state_json"))["state_json"].alias("state_json"),
    )
    status = F.when(F.col("_ok"), "applied").when(F.col("_refused"), "refused").otherwise("blocked")
    return g.select(key, "effective_date", status.alias("status"), "recipes", "reason", F.when(F.col("_ok"), F.col("state_json")).alias("state_json"))


def _plain(c: Column) -> Column:
    """Without soft hyphens and invisible signs, words that a line break parts joined, white space single."""
    joined = F.regexp_replace(F.regexp_replace(c, "[\\u00ad\\u200b-\\u200f\\u2060\\ufeff]", ""), "(?<=\\p{Ll})-\\s*\\n\\s*(?=\\p{Ll})", "")
    return F.trim(F.regexp_replace(joined, "\\s+", " "))


def wording_check(texts: DataFrame, extracts: DataFrame, key: str) -> DataFrame:
    """key, place, verdict of texts(key, place, text): "exact" if an extract of extracts(key, extract) holds the text, "loose" if one does without blanks and dashes, else "missing"; empty texts are exact, null ones give nothing.

    Texts meet the extracts of their own key only.
    """
    bare = lambda c: F.regexp_replace(c, "[\\s\\p{Pd}]+", "")
    a = texts.where("text IS NOT NULL").select(key, "place", _plain(F.col("text")).alias("t"))
    b = extracts.where("extract IS NOT NULL").select(key, _plain(F.col("extract")).alias("x"))
    level = F.when(F.contains("x", "t"), 2).when(F.contains(bare(F.col("x")), bare(F.col("t"))), 1).otherwise(0)
    best = a.join(b, key, "left").groupBy(key, "place").agg(F.max(F.when(F.col("t") == "", 2).otherwise(F.coalesce(level, F.lit(0)))).alias("l"))
    return best.select(key, "place", F.when(F.col("l") == 2, "exact").when(F.col("l") == 1, "loose").otherwise("missing").alias("verdict"))


def file_plan(planned: DataFrame, existing: DataFrame) -> DataFrame:
    """path, action of planned(path, sha256, base_sha256) against existing(path, sha256): new, unchanged, update (it is still what the plan began from), conflict, or orphan (nobody plans it)."""
    e = existing.select("path", F.col("sha256").alias("_now"))
    j = planned.withColumn("_planned", F.lit(True)).join(e, "path", "full_outer")
    action = F.when(F.col("_planned").isNull(), "orphan").when(F.col("_now").isNull(), "new").when(F.col("_now") == F.col("sha256"), "unchanged").when(F.col("_now").eqNullSafe(F.col("base_sha256")), "update").otherwise("conflict")
    return j.select("path", action.alias("action"))
