"""Near-duplicate texts: one-permutation hashing, densified, banded; star edges find the families, exact joins complete them.

1. Rows with the same stored value form a class, named by a hash taken in the
   JVM; classes, not rows, are compared, and a task works each class once.
2. Each class gets one hash per bin (one permutation); empty bins borrow from a
   filled one by a fixed order of probes, the same for all texts. Bands of bins
   are bucket keys; two numbers a band go through the exchange, and one bit of
   each bin as the class's sketch.
3. Within a bucket only star edges count, from its smallest class to the others,
   so a bucket of m classes gives m - 1 pairs. A bucket that is hot within a
   batch becomes a star before the exchange: only its centre goes on, its edges
   are spread by their member, so a bucket with a third of all classes is no
   hot task.
4. Edges whose sketches differ by more than similar texts' do go. What the
   others link with an edge between owners is a family.
5. The classes in families are joined exactly: their distinct shingles
   are ordered rarest first; two classes of the threshold share one among the
   first ``n - ceil(threshold * n) + 1`` of either. All classes that meet at one
   are paired, hot shingles in blocks of classes; at how many shingles a pair
   meets bounds what it can share, and the rest is verified by all shingles.

So stars only have to hold a family together; which of its pairs reach the
threshold is found exactly. A pair of similarity 0.7 shares no bucket with a
probability of 0.0005. Collected to the driver are counts, which decide whether
class ids may be broadcast, and a table of fixed size.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataq.session import cut

#: Bands, and bins per band.
BANDS, ROWS = 28, 4
#: Bins that count as independent in a short text, and standard errors by which a sketch may fall short.
_FREE_BINS, _ERRORS = 50, 3.4
#: Rows of one bucket in a batch from which it becomes a star before the exchange.
HOT = 64
#: Most class ids that are broadcast to the rows they are looked up in; beyond, the two are joined by a shuffle.
BROADCAST_CLASSES = 1_000_000
#: Most key pairs into which the copies of one text are written out if the caller does not say.
COPY_PAIRS = 10_000

#: Bits of a slot of the table of common shingles.
SLOT_BITS = 20
#: Classes at one shingle from which they are met in blocks of as many, and most such blocks.
BLOCK, MOST_BLOCKS = 512, 64
#: Stands for several owners of a class.
MANY = 0
#: Pairs that a task holds before it passes them on.
_HELD = 500_000

_WORD = re.compile(r"[^\W_]+")
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_ODD = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]


class _WordHashes(dict):
    """Hashes of the words seen so far; a cache."""

    def __missing__(self, word: str) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_WORD_HASHES = _WordHashes()


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * _MIX[0]
        h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


def shingles_of(texts: list[list[str]], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of the runs of ``size`` successive words of each list of words, in order, repeats included; the index of their list)."""
    if len(_WORD_HASHES) > 2_000_000:
        _WORD_HASHES.clear()
    n = np.array([len(t) for t in texts], dtype=np.int64)
    h = np.fromiter(map(_WORD_HASHES.__getitem__, (w for t in texts for w in t)), dtype=np.uint64, count=int(n.sum()))
    runs = np.maximum(n - size + 1, 0)
    doc = np.repeat(np.arange(len(texts)), runs)
    at = np.arange(int(runs.sum())) + ((np.cumsum(n) - n) - (np.cumsum(runs) - runs))[doc]
    out = np.zeros(len(at), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = out * _ODD[0] + h[at + k]
    return _mixed(out), doc


def shingle_hashes(words: list[str], size: int) -> np.ndarray:
    """One 64-bit hash for each run of ``size`` successive words, in order, repeats included."""
    return shingles_of([words], size)[0]


def _probes(bins: int, attempts: int = 512) -> np.ndarray:
    """For each attempt, which bin an empty bin looks at; fixed."""
    a = np.arange(attempts, dtype=np.uint64)[:, None] * np.uint64(1_000_003) + np.arange(bins, dtype=np.uint64)[None, :]
    return (_mixed(_mixed(a + np.uint64(0x1234567))) % np.uint64(bins)).astype(np.int64)


_PROBES: dict[int, np.ndarray] = {}
_EMPTY = np.uint64(2**64 - 1)


def one_permutation(flat: np.ndarray, doc: np.ndarray, docs: int, bins: int) -> np.ndarray:
    """(docs, bins) smallest shingle hash per bin; empty bins hold the value of the first filled bin among their probes."""
    sig = np.full(docs * bins, _EMPTY, dtype=np.uint64)
    at = (flat >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)
    np.minimum.at(sig, doc * bins + at.astype(np.int64), flat & np.uint64(0xFFFFFFFF))
    sig = sig.reshape(docs, bins)
    probes = _PROBES.setdefault(bins, _probes(bins))
    empty = sig == _EMPTY
    empty[empty.all(axis=1)] = False  # a text without shingles keeps no value
    out, (r, c) = sig.copy(), np.nonzero(empty)
    for a in range(len(probes)):
        if not len(r):
            break
        v = sig[r, probes[a, c]]
        ok = v != _EMPTY
        out[r[ok], c[ok]] = v[ok]
        r, c = r[~ok], c[~ok]
    for i, j in zip(r, c):  # after all probes: the next filled bin
        filled = np.flatnonzero(sig[i] != _EMPTY)
        out[i, j] = sig[i, filled[np.searchsorted(filled, j) % len(filled)]]
    return out


def band_keys(sig: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """(docs, BANDS) bucket keys; the last six bits are the band. ``salt`` keeps the tables apart."""
    docs = len(sig)
    s = sig.reshape(docs, BANDS, ROWS)
    h = np.broadcast_to(salt.astype(np.uint64)[:, None], (docs, BANDS)).copy()
    with np.errstate(over="ignore"):
        for k in range(ROWS):
            h = _mixed(h * _ODD[1] + s[:, :, k] + np.uint64(k + 1))
    return (h & ~np.uint64(63)) | np.arange(BANDS, dtype=np.uint64)


#: The last six bits of a row's first number: its band, or one of these for an edge and for the two halves of a sketch. Class ids have them zero.
_EDGE, _HALVES = np.uint64(63), (np.uint64(61), np.uint64(62))


def sketches(sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One bit of each bin, in two numbers."""
    bits = (_mixed(sig) & np.uint64(1)).astype(np.uint8)
    half = sig.shape[1] // 2
    packed = [np.packbits(np.pad(x, ((0, 0), (0, 64 - half))), axis=1).view(np.uint64).ravel() for x in (bits[:, :half], bits[:, half:])]
    return packed[0], packed[1]


def most_differing_bits(threshold: float) -> int:
    """By how many bits the sketches of texts of that similarity differ at most, but for ``_ERRORS`` standard errors."""
    p = (1 + threshold) / 2
    return int(BANDS * ROWS * (1 - p + _ERRORS * (p * (1 - p) / _FREE_BINS) ** 0.5))


def _reduced(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, id) rows of a batch with its hot buckets as stars: their smallest id stays, the others become edges (member or edge mark, centre), each once."""
    if len(keys) <= HOT:
        return keys, ids
    order = np.lexsort((ids.view(np.int64), keys))
    keys, ids = keys[order], ids[order]
    starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
    sizes = np.diff(np.concatenate([starts, [len(keys)]]))
    if sizes.max() <= HOT:
        return keys, ids
    first, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
    member = np.flatnonzero((size > HOT) & (np.arange(len(keys)) > first))
    edges = np.unique(np.stack([ids[member] | _EDGE, ids[first[member]]], axis=1), axis=0)
    stays = (size <= HOT) | (np.arange(len(keys)) == first)
    return np.concatenate([keys[stays], edges[:, 0]]), np.concatenate([ids[stays], edges[:, 1]])


#: Classes a task remembers so as not to work them twice.
_REMEMBERED = 1_000_000


def band_rows(batches: Iterator[pd.DataFrame], text_of: Callable[[str], str | None], least_words: int, shingle: int) -> Iterator[pd.DataFrame]:
    """From (source_table, class_id, payload): (bucket, id) for each band, or for an edge, and (class and half, bits) for its sketch; texts of fewer words give none."""
    seen: set[int] = set()
    for b in batches:
        ids, texts, salt = [], [], []
        for table, c, payload in zip(b["source_table"], b["class_id"], b["payload"]):
            if c in seen:
                continue
            if len(seen) >= _REMEMBERED:
                seen.clear()
            seen.add(c)
            text = text_of(payload)
            w = words_of(text) if text else []
            if len(w) < max(least_words, shingle):
                continue
            texts.append(w)
            ids.append(c)
            salt.append(xxhash.xxh3_64_intdigest(table))
        if not ids:
            continue
        flat, doc = shingles_of(texts, shingle)
        sig = one_permutation(flat, doc, len(ids), BANDS * ROWS)
        own = np.array(ids, dtype=np.int64).view(np.uint64)
        keys, codes = _reduced(band_keys(sig, np.array(salt, dtype=np.uint64)).ravel(), np.repeat(own, BANDS))
        keys, codes = np.concatenate([keys, *[own | half for half in _HALVES]]), np.concatenate([codes, *sketches(sig)])
        yield pd.DataFrame({"bucket": keys.view(np.int64), "id": codes.view(np.int64)})


def star_edges(rows: DataFrame, text_of: Callable[[str], str | None], least_words: int, shingle: int) -> DataFrame:
    """a, b, bits: the distinct edges from the centres a of the buckets to their other classes, of rows(source_table, class_id, payload); where b is 61 or 62, half of the sketch of a."""
    banded = rows.mapInPandas(lambda it: band_rows(it, text_of, least_words, shingle), "bucket long, id long").repartition("bucket")
    kind, first = F.col("bucket").bitwiseAND(F.lit(63)), F.col("bucket").bitwiseAND(F.lit(~63))
    starred = banded.withColumn("centre", F.min("id").over(Window.partitionBy("bucket")))
    x = starred.select(
        F.when(kind == 63, F.col("id")).when(kind > 60, first).otherwise(F.col("centre")).alias("a"),
        F.when(kind == 63, first).when(kind > 60, kind).otherwise(F.col("id")).alias("b"),
        F.when((kind > 60) & (kind < 63), F.col("id")).otherwise(F.lit(0)).alias("bits"),
    )
    return x.where("a != b").groupBy("a", "b").agg(F.max("bits").alias("bits"))


def close_edges(starred: DataFrame, threshold: float) -> DataFrame:
    """a, b: the edges of star_edges whose ends' sketches allow the threshold."""
    kind = F.col("b").bitwiseAND(F.lit(63))
    sketch = starred.where(kind > 0).groupBy("a").agg(F.max(F.when(kind == 61, F.col("bits"))).alias("x"), F.max(F.when(kind == 62, F.col("bits"))).alias("y"))
    side = lambda c: sketch.select(F.col("a").alias(c), F.col("x").alias("x" + c), F.col("y").alias("y" + c))
    both = starred.where(kind == 0).select("a", "b").join(side("a"), "a").join(side("b"), "b")
    differ = F.bit_count(F.col("xa").bitwiseXOR(F.col("xb"))) + F.bit_count(F.col("ya").bitwiseXOR(F.col("yb")))
    return both.where(differ <= most_differing_bits(threshold)).select("a", "b")


#: From a class to its star's centre within a batch, to its bucket's centre, and to another batch's centre.
_HOPS = 3


def families(edges: DataFrame, classes: DataFrame) -> DataFrame:
    """class_id of the classes no more than _HOPS edges(a, b) away from an edge between owners, by their classes(class_id, lo, hi).

    Classes that share a bucket are linked by four edges at most: to the centres
    of their batches' stars and from there to the bucket's. If their owners
    differ, one of these edges is between owners, and no class on the way is
    farther from it.
    """
    owners = lambda x: classes.select(*[F.col(c).alias(n) for c, n in (("class_id", x), ("lo", "lo" + x), ("hi", "hi" + x))])
    between = edges.join(owners("a"), "a").join(owners("b"), "b").where("NOT (loa = hia AND lob = hib AND loa = lob)")
    found = cut(between.select(F.explode(F.array("a", "b")).alias("class_id")).distinct())
    number = found.count()
    for _ in range(_HOPS):
        near = _few(found)
        ways = [edges.join(near.withColumnRenamed("class_id", x), x, "left_semi").select(F.col(y).alias("class_id")) for x, y in ("ab", "ba")]
        found = cut(found.unionByName(ways[0]).unionByName(ways[1]).distinct())
        before, number = number, found.count()
        if number == before:
            break
    return found


def to_shingles(batches: Iterator[pd.DataFrame], text_of: Callable[[str], str | None], least_words: int, shingle: int) -> Iterator[pd.DataFrame]:
    """From (source_table, class_id, o, payload): the sorted distinct shingle hashes instead of the payload, as bytes; texts of fewer words give none."""
    for b in batches:
        words = [words_of(text_of(p) or "") for p in b["payload"]]
        long = np.array([len(w) >= max(least_words, shingle) for w in words], dtype=bool)
        flat, doc = shingles_of([w for w, ok in zip(words, long) if ok], shingle)
        ends = np.searchsorted(doc, np.arange(int(long.sum()) + 1))
        out = b.loc[long, ["source_table", "class_id", "o"]].reset_index(drop=True)
        out["shingles"] = [np.unique(flat[i:j]).tobytes() for i, j in zip(ends[:-1], ends[1:])]
        yield out


def _loaded(b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes of the rows, index of their row)."""
    flat = np.frombuffer(b"".join(b["shingles"]), dtype=np.uint64)
    return flat, np.repeat(np.arange(len(b)), [len(s) // 8 for s in b["shingles"]])


def _slot(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def common_shingles(classes: DataFrame) -> bytes:
    """Packed bytes, one for each slot of shingles, how many of the classes have one: 0 for none, else 1 + 4 log2 of the number. It orders shingles; any table gives the same pairs."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros(1 << SLOT_BITS, dtype=np.int64)
        for b in batches:
            flat, _ = _loaded(b)
            held += np.bincount(_slot(flat), minlength=1 << SLOT_BITS)
        at = np.flatnonzero(held)
        yield pd.DataFrame({"slot": at.astype(np.int32), "n": held[at]})

    counted = classes.select("shingles").mapInPandas(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).select("slot", (1 + F.floor(4 * F.log2("n"))).cast("int").alias("level"))

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = np.zeros(1 << SLOT_BITS, dtype=np.uint8)
        for b in batches:
            out[b["slot"].to_numpy(dtype=np.int64)] = b["level"].to_numpy(dtype=np.int64)
        yield pd.DataFrame({"levels": [zlib.compress(out.tobytes(), 1)]})

    found = counted.repartition(1).mapInPandas(packed, "levels binary").first()
    return bytes(found["levels"]) if found else zlib.compress(bytes(1 << SLOT_BITS))


def prefix_rows(batches: Iterator[pd.DataFrame], threshold: float, packed: bytes) -> Iterator[pd.DataFrame]:
    """From (source_table, class_id, o, shingles): (bucket, id, owner, n, at, side) for each prefix shingle; n is the class's number of shingles, at the shingle's place in their order.

    A shingle that is expected at more than BLOCK classes has a bucket for each
    two blocks of classes, with a side each, and one for each block alone (side 2).
    """
    common = np.frombuffer(zlib.decompress(packed), dtype=np.uint8)
    for b in batches:
        if not len(b):
            continue
        flat, doc = _loaded(b)
        ids, owners = b["class_id"].to_numpy(dtype=np.int64), b["o"].to_numpy(dtype=np.int64)
        salt = np.array([xxhash.xxh3_64_intdigest(t) for t in b["source_table"]], dtype=np.uint64)
        level = common[_slot(flat)]
        order = np.lexsort((flat, level, doc))
        flat, doc, level = flat[order], doc[order], level[order]
        n = np.bincount(doc, minlength=len(ids))
        rank = np.arange(len(doc)) - (np.cumsum(n) - n)[doc]
        keep = rank < _prefix(n, threshold)[doc]
        flat, doc, level, rank = flat[keep], doc[keep], level[keep], rank[keep]
        blocks = np.clip(np.ceil(np.exp2((level - 1.0) / 4) / BLOCK), 1, MOST_BLOCKS).astype(np.int64)
        at = np.repeat(np.arange(len(doc)), blocks)
        other = np.arange(len(at)) - (np.cumsum(blocks) - blocks)[at]
        own = (_mixed(ids.view(np.uint64))[doc] % blocks.astype(np.uint64)).astype(np.int64)[at]
        block = (np.minimum(own, other) * MOST_BLOCKS + np.maximum(own, other)).astype(np.uint64)
        bucket = _mixed(_mixed(flat ^ salt[doc])[at] + block)
        side = np.where(own == other, 2, (own > other).astype(np.int64))
        yield pd.DataFrame({"bucket": bucket.view(np.int64), "id": ids[doc][at], "owner": owners[doc][at], "n": n[doc][at].astype(np.int32), "at": rank[at].astype(np.int32), "side": side.astype(np.int32)})


def _prefix(n: np.ndarray, threshold: float) -> np.ndarray:
    return n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1


def meetings(batches: Iterator[pd.DataFrame], threshold: float) -> Iterator[pd.DataFrame]:
    """(a < b, need) for each two classes of a bucket that have different owners and can reach the threshold, of rows sorted by (bucket, id): need is at how many shingles they must meet to reach the threshold."""

    def paired(x: np.ndarray) -> Iterator[pd.DataFrame]:
        starts = np.flatnonzero(np.concatenate([[True], (x[1:, :2] != x[:-1, :2]).any(axis=1)]))
        one = np.minimum.reduceat(x[:, 2], starts) == np.maximum.reduceat(x[:, 2], starts)
        x = x[starts]
        x[~one, 2] = MANY
        at, step, held, number = np.arange(len(x)), 1, [], 0
        while True:
            at = at[at + step < len(x)]
            at = at[x[at, 0] == x[at + step, 0]]
            if not len(at):
                break
            a, b = x[at], x[at + step]
            ok = ((a[:, 2] != b[:, 2]) | (a[:, 2] == MANY)) & ((a[:, 5] == 2) | (a[:, 5] != b[:, 5]))
            a, b = a[ok], b[ok]
            need = np.ceil(threshold / (1 + threshold) * (a[:, 3] + b[:, 3]) - 1e-9).astype(np.int64)
            rest = np.maximum(a[:, 3] - _prefix(a[:, 3], threshold), b[:, 3] - _prefix(b[:, 3], threshold))
            # what they can share before this shingle and from it on
            ok = np.minimum(a[:, 4], b[:, 4]) + np.minimum(a[:, 3] - a[:, 4], b[:, 3] - b[:, 4]) >= need
            held.append(np.stack([a[ok, 1], b[ok, 1], np.maximum(need - rest, 1)[ok]], axis=1))
            number += len(held[-1])
            if number > _HELD:
                yield pd.DataFrame(np.concatenate(held), columns=["a", "b", "need"])
                held, number = [], 0
            step += 1
        if number:
            yield pd.DataFrame(np.concatenate(held), columns=["a", "b", "need"])

    open_rows: list[np.ndarray] = []
    for b in batches:
        x = b[["bucket", "id", "owner", "n", "at", "side"]].to_numpy(dtype=np.int64)
        if not len(x):
            continue
        ends = np.flatnonzero(x[:, 0] != x[-1, 0])
        done = ends[-1] + 1 if len(ends) else 0
        if open_rows and (done or open_rows[-1][-1, 0] != x[0, 0]):
            yield from paired(np.concatenate([*open_rows, x[:done]]))
            open_rows = []
        elif done:
            yield from paired(x[:done])
        open_rows.append(x[done:])
    if open_rows:
        yield from paired(np.concatenate(open_rows))


def all_candidates(classes: DataFrame, threshold: float) -> DataFrame:
    """Distinct pairs (a < b) of classes(source_table, class_id, o, shingles), every pair of different owners that reaches the threshold among them."""
    common = classes.sparkSession.sparkContext.broadcast(common_shingles(classes))
    prefixes = classes.mapInPandas(lambda it: prefix_rows(it, threshold, common.value), "bucket long, id long, owner long, n int, at int, side int")
    met = prefixes.repartition("bucket").sortWithinPartitions("bucket", "id").mapInPandas(lambda it: meetings(it, threshold), "a long, b long, need long")
    return met.groupBy("a", "b", "need").agg(F.count("*").alias("n")).where("n >= need").select("a", "b")


@F.pandas_udf(T.DoubleType())
def _similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    out = []
    for x, y in zip(a, b):
        s, t = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
        n = len(np.intersect1d(s, t, assume_unique=True))
        out.append(n / (len(s) + len(t) - n))
    return pd.Series(out, dtype="float64")


def _few(ids: DataFrame) -> DataFrame:
    """ids for a join, broadcast if their number, counted here, allows it."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_CLASSES else ids


class Duplicates:
    """Links between the classes of texts(source_table, record_key, owner, payload).

    ``text_of`` turns a payload into its text, no longer than the payload
    (default: it is the text). Rows with a null table, key or payload take part
    in nothing, nor do texts of fewer than ``least_words`` (or ``shingle``)
    words; a null owner equals other nulls. A class whose rows have several
    owners is linked to itself.
    ``links``: source_table, a, b, similarity, between all classes of the
    similarity that have different owners (a = b for copies). ``members``:
    source_table, class_id, record_key, owner of linked classes. Both are made
    when first asked for and cut off in the checkpoint folder.
    """

    def __init__(self, texts: DataFrame, threshold: float = 0.8, shingle: int = 5, least_words: int = 5, text_of: Callable[[str], str | None] = lambda x: x) -> None:
        cols = ["source_table", "record_key", "owner", "payload"]
        rows = texts.select(*[F.col(c).cast("string").alias(c) for c in cols]).where("payload IS NOT NULL AND source_table IS NOT NULL AND record_key IS NOT NULL")
        rows = rows.where(F.length("payload") >= 2 * max(least_words, shingle) - 1)  # so long are so many words with what parts them
        self._rows = rows.withColumn("class_id", F.xxhash64("source_table", "payload").bitwiseAND(F.lit(~63))).withColumn("o", F.xxhash64(F.coalesce("owner", F.lit("\u0000"))))
        self._threshold, self._how = threshold, (text_of, least_words, shingle)

    @cached_property
    def _made(self) -> tuple[DataFrame, DataFrame]:
        rows, how = self._rows, self._how
        starred = cut(star_edges(rows.select("source_table", "class_id", "payload"), *how))
        edges = cut(close_edges(starred, self._threshold))
        ends = edges.select(F.explode(F.array("a", "b")).alias("class_id")).distinct().withColumn("linked", F.lit(True))
        classes = (
            rows.select("class_id", "o", F.xxhash64("record_key").alias("k"))
            .groupBy("class_id")
            .agg(F.min("o").alias("lo"), F.max("o").alias("hi"), F.min("k").alias("k"))
            .join(ends, "class_id", "left")
            .where(F.col("linked") | (F.col("lo") != F.col("hi")))
        )
        classes = cut(classes.drop("linked"))
        copied = classes.where("lo != hi").select("class_id")
        owner = F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.lit(MANY)).alias("o")
        wanted = cut(families(edges, classes).unionByName(copied).distinct().join(classes, "class_id").select("class_id", owner, "k"))
        # the payload of one key of each class is enough
        payload = F.when(F.xxhash64("record_key") == F.col("k"), F.col("payload"))
        chosen = cut(rows.drop("o").join(_few(wanted), "class_id").select("source_table", "class_id", "record_key", "owner", "o", payload.alias("payload")))
        one = chosen.where("payload IS NOT NULL").dropDuplicates(["class_id"]).select("source_table", "class_id", "o", "payload")
        texts = cut(one.mapInPandas(lambda it: to_shingles(it, *how), "source_table string, class_id long, o long, shingles binary"))
        side = lambda x: texts.select(F.col("class_id").alias(x), F.col("shingles").alias("s" + x))
        pairs = all_candidates(texts, self._threshold).join(side("a"), "a").join(side("b"), "b").withColumn("similarity", _similarity("sa", "sb"))
        found = pairs.where(F.col("similarity") >= self._threshold).select("a", "b", "similarity")
        copies = texts.where(F.col("o") == MANY).select(F.col("class_id").alias("a"), F.col("class_id").alias("b"), F.lit(1.0).alias("similarity"))
        links = cut(found.unionByName(copies).join(texts.select("source_table", F.col("class_id").alias("a")), "a"))
        kept = links.select(F.explode(F.array("a", "b")).alias("class_id")).distinct()
        return links, cut(chosen.drop("payload", "o").distinct().join(kept, "class_id", "left_semi"))

    @property
    def links(self) -> DataFrame:
        return self._made[0]

    @property
    def members(self) -> DataFrame:
        return self._made[1]

    def key_pairs(self, copy_pairs: int | None = COPY_PAIRS) -> DataFrame:
        """source_table, left_key, right_key (smaller first, each once), of_copies: the links written out into keys of different owners.

        Pairs of different texts are all written out. Of one text, so are its
        copies where they give no more than ``copy_pairs`` pairs (None: always);
        beyond, each copy is paired with two representatives, of different
        owners. ``of_copies`` is "pairs", "representatives", or null for pairs
        of different texts.
        """
        by_owner = F.struct("owner", "record_key")
        sizes = self.members.groupBy("class_id").agg(F.count("*").alias("n"), F.array(F.min(by_owner), F.max(by_owner)).alias("r"))
        left = self.members.select(F.col("class_id").alias("a"), F.col("record_key").alias("ka"), F.col("owner").alias("oa"))
        right = self.members.select(F.col("class_id").alias("b"), F.col("record_key").alias("kb"), F.col("owner").alias("ob"))
        between = self.links.where("a != b").select("source_table", "a", "b", F.lit(None).cast("string").alias("of_copies"))
        large = (F.col("n") * F.col("n") > copy_pairs) if copy_pairs is not None else F.lit(False)
        copies = self.links.where("a = b").join(sizes.withColumnRenamed("class_id", "a"), "a").select("source_table", "a", "b", F.when(large, "representatives").otherwise("pairs").alias("of_copies"), "r")
        cols = ["source_table", "ka", "oa", "kb", "ob", "of_copies"]
        full = between.unionByName(copies.where("of_copies = 'pairs'").drop("r")).join(left, "a").join(right, "b").select(*cols)
        few = copies.where("of_copies = 'representatives'").select("source_table", "b", "of_copies", F.explode(F.array_distinct("r")).alias("x"))
        few = few.join(right, "b").select("source_table", F.col("x.record_key").alias("ka"), F.col("x.owner").alias("oa"), "kb", "ob", "of_copies")
        return (
            full.unionByName(few)
            .where((F.col("ka") != F.col("kb")) & ~F.col("oa").eqNullSafe(F.col("ob")))
            .groupBy("source_table", F.least("ka", "kb").alias("left_key"), F.greatest("ka", "kb").alias("right_key"))
            .agg(F.max("of_copies").alias("of_copies"))
        )

    def groups(self) -> DataFrame:
        """source_table, record_key, group_id, n_links: for each key in a link its connected group (named by the smallest key in it) and the number of classes its own is linked to."""
        roots = connected(self.links.select("a", "b"))
        degree = self.links.select("a", "b").unionByName(self.links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().groupBy(F.col("a").alias("class_id")).agg(F.count("*").alias("n_links"))
        at = self.members.join(roots.withColumnRenamed("id", "class_id"), "class_id").join(degree, "class_id")
        names = at.groupBy("root").agg(F.min("record_key").alias("group_id"))
        return at.join(names, "root").select("source_table", "record_key", "group_id", "n_links").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """id, root (smallest id of the connected part) of every end of edges(a, b): rounds of large-star and small-star, each cut off in the checkpoint folder. Self-loops and repeats are allowed; nulls are not."""
    nodes = edges.select(F.col("a").alias("id")).unionByName(edges.select(F.col("b").alias("id"))).distinct()
    now = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct())
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        now = cut(small)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return nodes.join(now.select(F.col("u").alias("id"), F.col("v").alias("root")), "id", "left").select("id", F.coalesce("root", "id").alias("root"))
