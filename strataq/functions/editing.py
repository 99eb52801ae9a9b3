"""Text work that needs more than expressions: sentences, word differences, protected replacements, command sentences."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TOKEN = re.compile(r"\s+|\S+")
_END = re.compile(r"(?<=[.!?])[\"“)]*\s+(?=[A-ZÄÖÜ§„\"(])")
# Abbreviations after which no sentence ends.
_SHORT = re.compile(r"(?:\b(?:Abs|Art|Nr|Nrn|S|Bl|Ziff|Buchst|vgl|bzw|z\. ?B|u\. ?a|d\. ?h|Dr|Prof|St|ff|usw)|\b\d{1,3})\.$")


def sentences(text: str) -> list[str] | None:
    """The sentences of a text; None where an end is uncertain (a quote or bracket stays open)."""
    if text.count("(") != text.count(")") or text.count("„") != text.count("“"):
        return None
    out, last = [], 0
    for m in _END.finditer(text):
        part = text[last : m.end()]
        if _SHORT.search(text[last : m.start()]) or part.count("(") != part.count(")") or part.count("„") != part.count("“"):
            continue
        out.append(text[last : m.end()].strip())
        last = m.end()
    return [s for s in [*out, text[last:].strip()] if s]


def _common_lengths(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many tokens of x are in a longest common subsequence with each beginning of y: a row of y at a time."""
    row = np.zeros(len(y) + 1, dtype=np.int32)
    for token in x:
        longer = row[:-1] + (y == token)
        np.maximum(longer, row[1:], out=row[1:])
        np.maximum.accumulate(row, out=row)
    return row


def _matched(x: np.ndarray, y: np.ndarray, i: int, j: int) -> list[tuple[int, int]]:
    """Places of a longest common subsequence of x and y, in order, counted from i and j: x is halved, y is cut where both halves together have most in common, so memory stays linear."""
    if not len(x) or not len(y):
        return []
    if len(x) == 1:
        at = np.flatnonzero(y == x[0])
        return [(i, j + int(at[0]))] if len(at) else []
    half = len(x) // 2
    k = int(np.argmax(_common_lengths(x[:half], y) + _common_lengths(x[half:][::-1], y[::-1])[::-1]))
    return _matched(x[:half], y[:k], i, j) + _matched(x[half:], y[k:], i + half, j + k)


def word_diff(before: str, after: str, most_cells: int | None = None) -> list[tuple[str, str]]:
    """(kind, text) with kind same, gone or new: by a longest common subsequence of words and blanks; every character survives. With ``most_cells``, differing middles of more pairs of tokens than that are gone and new as a whole."""
    a, b = _TOKEN.findall(before), _TOKEN.findall(after)
    numbers: dict[str, int] = {}
    x, y = (np.array([numbers.setdefault(t, len(numbers)) for t in ts], dtype=np.int64) for ts in (a, b))
    short = min(len(x), len(y))
    unlike = np.flatnonzero(x[:short] != y[:short])
    lead = int(unlike[0]) if len(unlike) else short
    unlike = np.flatnonzero(x[len(x) - short + lead :][::-1] != y[len(y) - short + lead :][::-1])
    trail = int(unlike[0]) if len(unlike) else short - lead
    middle = (x[lead : len(x) - trail], y[lead : len(y) - trail])
    known = [] if most_cells is not None and len(middle[0]) * len(middle[1]) > most_cells else _matched(*middle, lead, lead)
    pairs = [(k, k) for k in range(lead)] + known + [(len(a) - k, len(b) - k) for k in range(trail, 0, -1)]
    out: list[tuple[str, str]] = []

    def put(kind: str, tokens: list[str]) -> None:
        if tokens and out and out[-1][0] == kind:
            out[-1] = (kind, out[-1][1] + "".join(tokens))
        elif tokens:
            out.append((kind, "".join(tokens)))

    i = j = 0
    for p, q in [*pairs, (len(a), len(b))]:
        put("gone", a[i:p])
        put("new", b[j:q])
        put("same", a[p : p + 1])
        i, j = p + 1, q + 1
    return out


_PARTS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("text", T.StringType())]))


def word_diff_column(before: Column, after: Column) -> Column:
    """array<struct<kind, text>>; null if either text is null."""

    @F.pandas_udf(_PARTS)
    def of(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else word_diff(x, y) for x, y in zip(a, b)], dtype=object)

    return of(before, after)


def sentences_column(text: Column) -> Column:
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def of(s: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else sentences(x) for x in s], dtype=object)

    return of(text)


def plan_replacements(text: str, rules: list[tuple[str, str, str]], protected: list[str]) -> list[tuple[int, int, str, str]]:
    """(start, end, rule, new text) of rules (name, pattern, new text) on the unchanged text: earlier rules come first, no two overlap, and none touches a protected span."""
    taken = [m.span() for p in protected for m in re.finditer(p, text)]
    plan = []
    for name, pattern, new in rules:
        for m in re.finditer(pattern, text):
            if m.end() > m.start() and not any(m.start() < e and s < m.end() for s, e in taken):
                taken.append(m.span())
                plan.append((m.start(), m.end(), name, m.expand(new)))
    return sorted(plan)


def apply_replacements(text: str, plan: list[tuple[int, int, str, str]]) -> str:
    out, last = [], 0
    for s, e, _, new in plan:
        out += [text[last:s], new]
        last = e
    return "".join([*out, text[last:]])


# How amending sentences command.
_COMMANDS = {
    "repeal": ["(?:wird|werden)\\s+(?:aufgehoben|gestrichen)", "(?:tritt|treten) außer kraft"],
    "replace": ["(?:wird|werden)\\b.*?\\bersetzt", "erhält folgende fassung", "wird wie folgt gefasst"],
    "insert": ["(?:wird|werden)\\b.*?\\beingefügt"],
    "append": ["(?:wird|werden)\\b.*?\\bangefügt"],
    "rename": ["wird\\b.*?\\bumbenannt", "wird die bezeichnung"],
}


def without_quotes(text: Column) -> Column:
    """The text with what stands in quotes taken out, so that quoted wording commands nothing."""
    return F.regexp_replace(text, "„[^“]*“|\"[^\"]*\"", "„“")


def command_of(text: Column) -> Column:
    """Kind of an amending sentence: repeal, replace, insert, append, rename, or null; the first that fits anywhere in it, quotes left out."""
    bare = without_quotes(text)
    return F.coalesce(*[F.when(bare.rlike("(?is)\\b(?:" + "|".join(forms) + ")"), F.lit(kind)) for kind, forms in _COMMANDS.items()])
