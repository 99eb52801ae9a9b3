"""Filling containers of fixed token capacity with whole texts.

Texts are tokenised once. What is planned is not the texts but their lengths:
a histogram of at most ``capacity`` rows, so the plan is made on the driver
with a size bound that does not depend on the number of texts. The plan takes
the longest lengths first and looks for one, two or three available lengths
that fill the gap exactly (an index of single, pair and triple sums of the
available lengths), consuming as many containers at once as the counts allow; the residual lengths
go to the best-fitting open gap. Texts then get a rank within their length, in
salted groups of a bounded number of rows, so a length that a third of all texts
share is no hot task, and the rank names container and position.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataq.session import cut

#: Vocabulary of the sizes: a public byte-level BPE for many languages.
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Texts of one length that are ranked together, about.
GROUP_ROWS = 200_000
#: Most capacity in all, which bounds the histogram and the plan.
PLAN_BOUND = 1_000_000

# Fixed value: the public pattern that byte-level BPE vocabularies of this kind are cut with.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ENCODERS: dict[str, object] = {}


def encoder(path: str = TOKENIZER):
    """A tiktoken encoding from a file of ranks, kept per process."""
    if path not in _ENCODERS:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[path] = tiktoken.Encoding("own", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def cut_pieces(enc, text: str, tokens: list[int], capacity: int) -> list[tuple[int, int, int]]:
    """(start, end, tokens) of the pieces of a text, none with more tokens than ``capacity``; cut before a token that begins with white space where one is in reach, else between characters."""
    if len(tokens) <= capacity:
        return [(0, len(text), max(1, len(tokens)))]
    raw = [enc.decode_single_token_bytes(t) for t in tokens]
    out, at, start = [], 0, 0
    while at < len(tokens):
        end = min(at + capacity, len(tokens))
        if end < len(tokens):
            floor = at + max(1, capacity // 2)
            k = end
            while k > floor and raw[k][:1] not in (b" ", b"\n"):
                k -= 1
            if raw[k][:1] not in (b" ", b"\n"):
                k = end
                while k > at + 1 and raw[k][0] & 0xC0 == 0x80:  # inside a character
                    k -= 1
            end = k
        piece = b"".join(raw[at:end]).decode("utf-8", "replace")
        n = len(enc.encode_ordinary(piece))
        while n > capacity and end - at > 1:  # cut off from its neighbours it takes more tokens
            end -= max(1, n - capacity)
            while end - at > 1 and raw[end][0] & 0xC0 == 0x80:
                end -= 1
            piece = b"".join(raw[at:end]).decode("utf-8", "replace")
            n = len(enc.encode_ordinary(piece))
        out.append((start, start + len(piece), n))
        start, at = start + len(piece), end
    return out


def item_sizes(documents: DataFrame, capacities: dict[str, int], path: str = TOKENIZER, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """capacity_name, doc_id, piece_index, start_pos (1 …), n_chars, n_tokens: one row per capacity and text, or piece of a text larger than it."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for b in batches:
            rows = []
            for d, t in zip(b["doc_id"], b["text"]):
                t = t.encode("utf-8", "replace").decode("utf-8")
                tokens = enc.encode_ordinary(t)
                for name, capacity in capacities.items():
                    rows += [(name, d, k, a + 1, e - a, n) for k, (a, e, n) in enumerate(cut_pieces(enc, t, tokens, capacity))]
            yield pd.DataFrame(rows, columns=["capacity_name", "doc_id", "piece_index", "start_pos", "n_chars", "n_tokens"])

    docs = documents.where(F.col(doc).isNotNull() & F.col(text).isNotNull()).select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return docs.mapInPandas(of, "capacity_name string, doc_id long, piece_index int, start_pos int, n_chars int, n_tokens int")


# --- the plan ---------------------------------------------------------------


class _Lengths:
    """Counts of available lengths, with an index of their pair and triple sums; a sum whose lengths have since been used up may still be in it."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.n = np.zeros(capacity + 1, dtype=np.int64)
        for length, n in counts.items():
            self.n[length] = n
        self.capacity = capacity
        self.stale = 0
        self._index()

    def _index(self) -> None:
        have = [int(x) for x in np.flatnonzero(self.n)]
        within = (1 << (self.capacity + 1)) - 1
        singles = sum(1 << x for x in have)
        pairs = triples = 0
        for x in have:
            pairs |= singles << x
        pairs &= within
        for x in have:
            triples |= pairs << x
        self.pairs, self.triples = self._flags(pairs), self._flags(triples & within)

    def _flags(self, bits: int) -> np.ndarray:
        raw = np.frombuffer(bits.to_bytes(self.capacity // 8 + 1, "little"), dtype=np.uint8)
        return np.unpackbits(raw, bitorder="little")[: self.capacity + 1].astype(bool)

    def take(self, combination: tuple[int, ...], m: int) -> None:
        for x in combination:
            self.n[x] -= m
            if not self.n[x]:
                self.stale += 1
        if self.stale > 64:
            self.stale = 0
            self._index()

    def times(self, combination: tuple[int, ...]) -> int:
        """How often the combination is available."""
        return min(int(self.n[x]) // combination.count(x) for x in set(combination))

    def pair(self, total: int) -> tuple[int, int] | None:
        """Two available lengths of the sum, the longest first."""
        if total < 2 or not self.pairs[total]:
            return None
        low = np.arange(1, total // 2 + 1)
        ok = (self.n[low] > 0) & (self.n[total - low] > 0)
        if total % 2 == 0 and self.n[total // 2] < 2:
            ok[-1] = False
        hits = np.flatnonzero(ok)
        return (total - int(low[hits[0]]), int(low[hits[0]])) if len(hits) else None

    def triple(self, total: int) -> tuple[int, int, int] | None:
        if total < 3 or not self.triples[total]:
            return None
        first = np.arange(total - 2, 0, -1)
        for x in first[(self.n[first] > 0) & self.pairs[total - first]]:
            x = int(x)
            self.n[x] -= 1
            p = self.pair(total - x)
            self.n[x] += 1
            if p:
                return (x, *p)
        return None


def plan_patterns(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(lengths of a container with their numbers, how many such containers); every length is used as often as it occurs."""
    have, out = _Lengths(counts, capacity), []
    left: dict[int, int] = {}
    for length in range(capacity, 0, -1):
        while have.n[length]:
            gap = capacity - length
            found: tuple[int, ...] | None = None
            if gap == 0:
                found = (length,)
            elif have.n[gap] > (gap == length):
                found = (length, gap)
            else:
                have.n[length] -= 1
                rest = have.pair(gap) or have.triple(gap)
                have.n[length] += 1
                found = (length, *rest) if rest else None
            if not found:
                left[length] = int(have.n[length])
                have.n[length] = 0
                break
            m = have.times(found)
            have.take(found, m)
            pattern: dict[int, int] = defaultdict(int)
            for x in found:
                pattern[x] += 1
            out.append((dict(pattern), m))
    return out + _best_fit(left, capacity)


def _best_fit(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best fit, longest first, many equal containers at once."""
    open_: dict[int, list[tuple[dict[int, int], int]]] = defaultdict(list)  # by gap
    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            gap = min((g for g in open_ if g >= length), default=None)
            if gap is None:
                fits = min(capacity // length, n)
                m = n // fits
                open_[capacity - fits * length].append(({length: fits}, m))
                n -= m * fits
                continue
            pattern, m = open_[gap].pop()
            if not open_[gap]:
                del open_[gap]
            fits = min(gap // length, n)
            used = min(m, n // fits)
            if used < m:
                open_[gap].append((pattern, m - used))
            grown = dict(pattern)
            grown[length] = grown.get(length, 0) + fits
            open_[gap - fits * length].append((grown, used))
            n -= used * fits
    return [x for patterns in open_.values() for x in patterns]


def slots(patterns: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """By length: rows of (first rank, first container, texts of that length in a container, their first position), by rank."""
    rank: dict[int, int] = defaultdict(int)
    rows: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    container = 0
    for pattern, m in patterns:
        position = 0
        for length in sorted(pattern, reverse=True):
            k = pattern[length]
            rows[length].append((rank[length], container, k, position))
            rank[length] += m * k
            position += k
        container += m
    return {length: np.array(r, dtype=np.int64) for length, r in rows.items()}


_SLOT = T.StructType([T.StructField("container_id", T.LongType()), T.StructField("position", T.IntegerType())])


def pack(documents: DataFrame, capacities: dict[str, int], path: str = TOKENIZER, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """capacity_name, doc_id, piece_index, start_pos, n_chars, n_tokens, container_id (0 …), position (0 …), one row per text or piece and capacity.

    A text larger than the capacity is cut; all others stay whole. An empty
    text counts one token (its end). Null ids and texts are no items. Repeated
    rows are items of their own. Capacities must be positive and, together,
    no larger than PLAN_BOUND.
    """
    if not capacities or min(capacities.values()) < 1 or sum(capacities.values()) > PLAN_BOUND:
        raise ValueError("capacities must be positive and bounded")
    items = cut(item_sizes(documents, capacities, path, doc, text))
    histogram = items.groupBy("capacity_name", "n_tokens").agg(F.count("*").alias("n")).collect()  # at most a row per token of capacity
    salts = 1 + max((r["n"] for r in histogram), default=0) // GROUP_ROWS
    # where a row lies in the checkpoint is fixed, and parts repeated rows
    items = items.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece_index", F.spark_partition_id()), F.lit(salts)).cast("int"))
    per_salt = items.groupBy("capacity_name", "n_tokens", "salt").agg(F.count("*").alias("n"))
    plan = {}
    for name, capacity in capacities.items():
        plan[name] = slots(plan_patterns({r["n_tokens"]: r["n"] for r in histogram if r["capacity_name"] == name}, capacity))
    shared = documents.sparkSession.sparkContext.broadcast(plan)

    @F.pandas_udf(_SLOT)
    def place(name: pd.Series, length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        container, position = np.zeros(len(name), dtype=np.int64), np.zeros(len(name), dtype=np.int32)
        keys = pd.DataFrame({"c": name, "l": length}).groupby(["c", "l"]).indices
        for (c, n), at in keys.items():
            table = shared.value[c][n]
            r = rank.to_numpy()[at]
            row = table[np.searchsorted(table[:, 0], r, side="right") - 1]
            off = r - row[:, 0]
            container[at] = row[:, 1] + off // row[:, 2]
            position[at] = row[:, 3] + off % row[:, 2]
        return pd.DataFrame({"container_id": container, "position": position})

    by_salt = Window.partitionBy("capacity_name", "n_tokens").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_salt.withColumn("offset", F.coalesce(F.sum("n").over(by_salt), F.lit(0))).drop("n")
    in_salt = Window.partitionBy("capacity_name", "n_tokens", "salt").orderBy("doc_id", "piece_index")
    ranked = items.withColumn("rn", F.row_number().over(in_salt)).join(offsets, ["capacity_name", "n_tokens", "salt"])
    placed = ranked.withColumn("slot", place("capacity_name", "n_tokens", (F.col("offset") + F.col("rn") - 1).cast("long")))
    return placed.select("capacity_name", "doc_id", "piece_index", "start_pos", "n_chars", "n_tokens", "slot.container_id", "slot.position")
