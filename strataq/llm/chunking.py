"""Splitting oversized texts at natural boundaries, content-defined.

A rolling hash over the characters marks landmarks; each cut takes the first
landmark in reach and snaps to the best natural boundary near it. A cut depends
only on the text after the previous cut, so after an edit the cuts fall on the
same places again and only neighbouring pieces change. Texts within the limit
never reach Python; a row is worked by itself, without any exchange.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataq.operators.blocks import BLOCK_KEYS, assemble_parts, parse_block

#: Characters the rolling hash sees.
WINDOW = 24
#: Boundary kinds by rank.
KINDS = ("hard", "word", "sentence", "paragraph", "structure")

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SENTENCE = re.compile(r"(?<=[^\W\d_]{2}[.!?…])[\"“”»)\]]*\s+(?=[^\W\d_a-zäöü]|[§„\"(])")
_PARAGRAPH = re.compile(r"\n+")
_WORD_END = re.compile(r"[^\S\n]+")


def landmarks(text: str, spacing: int) -> np.ndarray:
    """Positions (cut before them) whose preceding WINDOW characters hash to a landmark, about one in ``spacing``."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    if len(codes) < WINDOW:
        return np.empty(0, dtype=np.int64)
    h = np.zeros(len(codes) - WINDOW + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(WINDOW):
            h = h * _BASE + codes[k : len(codes) - WINDOW + 1 + k]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
    h >>= np.uint64(32)
    return np.flatnonzero(h < np.uint64(2**32 // max(1, spacing))) + WINDOW


def boundary_ranks(text: str, structure: list[int] | None = None) -> np.ndarray:
    """For each position 0 … len(text) the rank of a cut before it; ``structure``: positions where a structural unit begins."""
    ranks = np.zeros(len(text) + 1, dtype=np.int8)
    for rank, pattern in ((1, _WORD_END), (2, _SENTENCE), (3, _PARAGRAPH)):
        for m in pattern.finditer(text):
            ranks[m.end()] = max(ranks[m.end()], rank)
    for p in structure or ():
        ranks[p] = 4
    return ranks


def split_text(text: str, max_size: int, overlap: int, structure: list[int] | None = None) -> list[tuple[int, int, str]]:
    """(start, end, kind of the end) of pieces no longer than ``max_size``; each starts ``overlap`` characters before the end of the one before.

    A text within the limit is one piece; an empty one has none. The last
    piece ends with the text, kind ``end``. ValueError unless 0 <= overlap and
    max_size > 2 * overlap.
    """
    if overlap < 0 or max_size <= 2 * overlap or max_size < 1:
        raise ValueError("max_size must exceed twice the overlap, and both must not be negative")
    if not text:
        return []
    if len(text) <= max_size:
        return [(0, len(text), "end")]
    least = overlap + max(1, (max_size - 2 * overlap) // 3)
    reach = max(1, max_size // 8)
    marks, ranks = landmarks(text, max(1, (max_size - least) // 4)), boundary_ranks(text, structure)
    out, start = [], 0
    while len(text) - start > max_size:
        low, high = start + least, start + max_size
        i = np.searchsorted(marks, low)
        at = int(marks[i]) if i < len(marks) and marks[i] <= high else high
        a, b = max(low, at - reach), min(high, at + reach)
        near = ranks[a : b + 1]
        best = near.max()
        if best < 2:  # no sentence near the landmark: the nearest better boundary in the whole reach of the piece
            a, b = low, high
            near = ranks[a : b + 1]
            best = near.max()
        if best > 0:
            places = np.flatnonzero(near == best) + a
            end = int(places[np.argmin(np.abs(places - at))])
        else:
            end = at
        out.append((start, end, KINDS[best]))
        start = end - overlap
    return [*out, (start, len(text), "end")]


_PIECES = "piece_index int, piece_count int, start_pos int, piece_length int, ends_at string, piece string"


def split_blocks(blocks: DataFrame, max_size: int, overlap: int) -> DataFrame:
    """Pieces of the block texts longer than ``max_size``: norm_id, version_id, block_index, piece_index (0 …), piece_count, start_pos (1 …), piece_length, ends_at, piece.

    Stored parts are rejoined first. Blocks that are no JSON object or miss a
    part give no pieces; a block delivered twice gives its pieces once. A
    stored value is never shorter than its text, so values no longer than the
    limit are left out in the JVM.
    """
    stored = assemble_parts(blocks, BLOCK_KEYS, least_length=max_size)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for n, v, i, raw in batch.itertuples(index=False):
                values = parse_block(raw)
                text = "\n".join(values or ())
                if len(text) <= max_size:
                    continue
                structure = list(np.cumsum([len(x) + 1 for x in values])[:-1])
                pieces = split_text(text, max_size, overlap, structure)
                rows += [(n, v, i, k, len(pieces), a + 1, b - a, kind, text[a:b]) for k, (a, b, kind) in enumerate(pieces)]
            yield pd.DataFrame(rows, columns=[*BLOCK_KEYS, "piece_index", "piece_count", "start_pos", "piece_length", "ends_at", "piece"])

    pieces = stored.mapInPandas(cut, "norm_id string, version_id string, block_index int, " + _PIECES)
    return pieces.dropDuplicates([*BLOCK_KEYS, "piece_index"])


def split_column(df: DataFrame, text: str, max_size: int, overlap: int) -> DataFrame:
    """Pieces of any string column: the other columns of ``df`` with ``pieces`` array<struct<start_pos, piece_length, ends_at, piece>>. Null gives null, an empty text an empty array."""

    @F.pandas_udf("array<struct<start_pos:int,piece_length:int,ends_at:string,piece:string>>")
    def cut(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else [(a + 1, b - a, k, t[a:b]) for a, b, k in split_text(t, max_size, overlap)])

    return df.withColumn("pieces", cut(F.col(text)))
