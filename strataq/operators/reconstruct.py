"""Texts at earlier and later times from their amendments: reversible changes, walked forth or back.

A change names what it finds and what it leaves, and may name fingerprints of
the text before and after it. It must hit exactly one place; a text that already
is what the change would leave stays as it is. Walking stops at the first change
that does not fit, and says so; the texts reached until then stand.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What a change of each kind takes out and puts in, from its fields ``anchor``, ``old`` and ``new``: the anchor stays.
KINDS = {
    "replace": lambda c: (c["old"], c["new"]),
    "delete": lambda c: (c["old"], ""),
    "insert-after": lambda c: (c["anchor"], c["anchor"] + c["new"]),
    "insert-before": lambda c: (c["anchor"], c["new"] + c["anchor"]),
    "append": lambda c: ("", c["new"]),
}


class DoesNotFit(ValueError):
    """The change has no place, or several, or a fingerprint differs."""


def fingerprint(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def apply_change(text: str, change: dict, back: bool = False) -> str:
    """The text after the change, or before it. A deletion can be taken back only where ``context`` (the text around its place, with "|" for the place) says where."""
    kind = change.get("kind")
    if kind not in KINDS:
        raise DoesNotFit(f"unknown kind {kind}")
    start, end = (change.get("after"), change.get("before")) if back else (change.get("before"), change.get("after"))
    now = fingerprint(text)
    if end and now == end:
        return text  # done already
    if start and now != start:
        raise DoesNotFit("the text is another one")
    out, put = KINDS[kind](change)
    if kind == "append":
        if back and not text.endswith(put):
            raise DoesNotFit("the end is another one")
        done = text[: len(text) - len(put)] if back else text + put
    else:
        find, leave = (put, out) if back else (out, put)
        if kind == "delete" and back:
            left, bar, right = str(change.get("context", "")).partition("|")
            if not bar or not left + right:
                raise DoesNotFit("no context to put it back")
            find, leave = left + right, left + out + right
        if text.count(find) != 1:
            raise DoesNotFit(f"{text.count(find)} places instead of one")
        done = text.replace(find, leave)
    if end and fingerprint(done) != end:
        raise DoesNotFit("what comes out is another text")
    return done


def walk(texts: DataFrame, changes: DataFrame, key: str, back: bool = False) -> DataFrame:
    """key, day, step (1 …), status (reached or refused), reason, text: the texts of texts(key, text) along changes(key, day, seq, change_json), in their order or, ``back``, from the last to the first.

    A change back gives the text before its day. After a refused change nothing
    more is given. Null keys and texts give nothing; of several texts the
    smallest holds. A key's changes are one row: they are the amendments of one
    text.
    """
    ordered = changes.where(f"{key} IS NOT NULL AND change_json IS NOT NULL").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("day", "seq", "change_json"))).alias("c"))
    one = texts.where(f"{key} IS NOT NULL AND text IS NOT NULL").groupBy(key).agg(F.min("text").alias("text"))

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, text, steps in zip(b[key], b["text"], b["c"]):
                for n, s in enumerate(reversed(steps) if back else steps, 1):
                    try:
                        text = apply_change(text, json.loads(s["change_json"]), back)
                    except (ValueError, KeyError, TypeError, AttributeError) as x:
                        rows.append((k, s["day"], n, "refused", str(x), None))
                        break
                    rows.append((k, s["day"], n, "reached", None, text))
            yield pd.DataFrame(rows, columns=[key, "day", "step", "status", "reason", "text"])

    return one.join(ordered, key).select(key, "text", "c").mapInPandas(of, f"{key} string, day string, step int, status string, reason string, text string")
