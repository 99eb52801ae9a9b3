"""Evaluation passages inside corpus documents.

The items' normalised words are cut into segments, the segments put into slices
of a bounded number of words; of each slice all n-grams form a sorted array of
64-bit hashes that is broadcast with the words. The documents are scanned
without an exchange: words that occur in no item end a run, so only runs of item
words are looked up, and every hit is verified word by word. One slice holds
SLICE_WORDS words; a larger set of items takes several scans, all alike.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Successive words that make a leak.
NGRAM = 12
#: Words of a slice of items (about 50 bytes each in a worker), and of a segment of an item.
SLICE_WORDS, SEGMENT_WORDS = 2_000_000, 4_096

_WORD = re.compile(r"[^\W_]+")
# Letters that are written out.
_WRITTEN_OUT = (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss"))


def _composed(text: str) -> str:
    return text if text.isascii() or unicodedata.is_normalized("NFC", text) else unicodedata.normalize("NFC", text)


def _written_out(s: str) -> str:
    for a, b in _WRITTEN_OUT:
        s = s.replace(a, b)
    return s


def words_of(text: str) -> list[str]:
    """Runs of letters and digits of the composed text, lower-cased, umlauts and sharp s written out."""
    return _WORD.findall(_written_out(_composed(text).lower()))


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """The same words, each with start and end of the letters of the composed text it comes from."""
    t = _composed(text)
    low = t.lower()
    found = [(_written_out(m.group()), m.start(), m.end()) for m in _WORD.finditer(low)]
    if len(low) == len(t):
        return found
    at = [i for i, c in enumerate(t) for _ in c.lower()]  # some letters are longer in lower case
    return [(w, at[a], at[b - 1] + 1) for w, a, b in found]


def segments_of(text: str, n: int, size: int = SEGMENT_WORDS) -> list[list[str]]:
    """The words of a text in runs of at most ``size`` n-grams; every n-gram lies in one of them."""
    w = words_of(text)
    return [w[k : k + size + n - 1] for k in range(0, max(0, len(w) - n + 1), size)]


def _grams(ids: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of the n numbers from each place on, but for the last n - 1."""
    h = np.zeros(max(0, len(ids) - n + 1), dtype=np.uint64)
    x = ids.astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        for k in range(n):
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + x[k : k + len(h)]
    return h


class ItemIndex:
    """The n-grams of segments(item, words): sorted hashes, where each begins among all words, and the item it is of."""

    def __init__(self, segments: Iterable[tuple[int, list[str]]], n: int = NGRAM) -> None:
        self.n, self.vocabulary = n, {}
        number = self.vocabulary
        ids, items = [], []
        for item, words in segments:
            if len(words) >= n:
                ids.append(np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64))
                items.append(item)
        lengths = np.array([len(x) for x in ids], dtype=np.int64)
        self.ids = np.concatenate([np.empty(0, dtype=np.int64), *ids])
        starts = np.arange(len(self.ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        inside = np.flatnonzero(starts <= np.repeat(lengths, lengths) - n)
        hashes = _grams(self.ids, n)[inside]
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.place = hashes[order], inside[order]
        self.item = np.repeat(np.array(items, dtype=np.int64), lengths)[self.place]

    def hits(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, word position, item) of every n-gram of the texts that stands in an item."""
        get, n = self.vocabulary.get, self.n
        ids = np.fromiter((get(w, -1) for t in texts for w in t), dtype=np.int64, count=sum(map(len, texts)))
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        first = np.cumsum(lengths) - lengths
        text = np.repeat(np.arange(len(texts)), lengths)
        # a run ends before an unknown word and with its text
        broken = np.where(ids < 0, np.arange(len(ids)), len(ids))
        ends = np.minimum(np.minimum.accumulate(broken[::-1])[::-1], (first + lengths)[text]) if len(ids) else broken
        at = np.flatnonzero(ends - np.arange(len(ids)) >= n)
        h = _grams(ids, n)[at]
        lo, hi = np.searchsorted(self.hashes, h, "left"), np.searchsorted(self.hashes, h, "right")
        many = hi - lo
        pos = np.repeat(at, many)
        entry = np.repeat(lo, many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        same = np.ones(len(pos), dtype=bool)
        for k in range(n):
            same &= ids[pos + k] == self.ids[self.place[entry] + k]
        pos, entry = pos[same], entry[same]
        return text[pos], pos - first[text[pos]], self.item[entry]


def _indexes(items: DataFrame, key: str, text: str, n: int) -> Iterator[Broadcast]:
    """An index for each slice of the items; null keys and texts and texts of fewer than n words are in none."""

    @F.pandas_udf(T.ArrayType(T.ArrayType(T.StringType())))
    def segments(s: pd.Series) -> pd.Series:
        return s.map(lambda t: segments_of(t, n))

    rows = items.where(F.col(key).isNotNull() & F.col(text).isNotNull())
    parts = rows.select(F.col(key).cast("long").alias("item"), F.posexplode(segments(F.col(text))).alias("part", "words"))
    slices = max(1, math.ceil((parts.agg(F.sum(F.size("words"))).first()[0] or 0) / SLICE_WORDS))
    of_slice = lambda: F.pmod(F.xxhash64("item", "part"), F.lit(slices))
    while slices > 1 and parts.groupBy(of_slice().alias("s")).agg(F.sum(F.size("words")).alias("n")).agg(F.max("n")).first()[0] > 2 * max(SLICE_WORDS, SEGMENT_WORDS + n):
        slices *= 2
    for k in range(slices):
        index = ItemIndex([(r["item"], r["words"]) for r in parts.where(of_slice() == k).select("item", "words").collect()], n)
        yield items.sparkSession.sparkContext.broadcast(index)


def _documents(documents: DataFrame, doc: str, text: str) -> DataFrame:
    return documents.where(F.col(doc).isNotNull() & F.col(text).isNotNull()).select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))


#: Words of documents that are looked up together.
_TOGETHER = 200_000


def _in_groups(texts: Iterable[str]) -> Iterator[tuple[int, list[list[str]]]]:
    """(number of the first, words of texts) of successive texts."""
    first, group, number = 0, [], 0
    for k, t in enumerate(texts):
        group.append(words_of(t))
        number += len(group[-1])
        if number >= _TOGETHER:
            yield first, group
            first, group, number = k + 1, [], 0
    if group:
        yield first, group


def leaks(documents: DataFrame, items: DataFrame, n: int = NGRAM, doc: str = "doc_id", doc_text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc, item (as bigint, each pair once) for documents that hold at least ``n`` successive words of the item.

    Null keys or texts and items of fewer than ``n`` words give nothing.
    Documents are scanned whole; repeated documents and items do no harm.
    """
    docs = _documents(documents, doc, doc_text)

    def scanned(shared: Broadcast) -> DataFrame:
        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                ids = b["doc_id"].to_numpy(dtype=np.int64)
                for first, group in _in_groups(b["text"]):
                    t, _, i = shared.value.hits(group)
                    pairs = np.unique(np.stack([ids[first + t], i], axis=1), axis=0)
                    yield pd.DataFrame({"doc_id": pairs[:, 0], "item_id": pairs[:, 1]})

        return docs.mapInPandas(scan, "doc_id long, item_id long")

    return reduce(DataFrame.unionByName, [scanned(x) for x in _indexes(items, item, item_text, n)]).distinct()


def without_words(text: str, at: Iterable[int], n: int) -> tuple[int, int, str]:
    """(runs cut out, their characters, what is left) of a text without the n words from each of the places ``at`` on; the rest stays as it is, composed."""
    spans, merged = spans_of(text), []
    for p in sorted(set(at)):
        if merged and p <= merged[-1][1]:
            merged[-1][1] = p + n
        else:
            merged.append([p, p + n])
    t, out, last = _composed(text), [], 0
    for p, q in merged:
        out.append(t[last : spans[p][1]])
        last = spans[q - 1][2]
    left = "".join([*out, t[last:]])
    return len(merged), len(t) - len(left), left


_CLEANED = "doc_id long, n_spans int, removed_chars int, clean_text string"


def remove_leaks(documents: DataFrame, items: DataFrame, n: int = NGRAM) -> DataFrame:
    """doc_id, n_spans, removed_chars, clean_text of each affected row of documents(doc_id, text): runs of leaked words are cut out, the rest stays as it is (composed).

    Items of one slice are cut out where the document lies; of several, the
    places found by each scan are brought together first.
    """
    docs = _documents(documents, "doc_id", "text")
    indexes = list(_indexes(items, "item_id", "text", n))

    def scanner(shared: Broadcast, row) -> object:
        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                rows = []
                for first, group in _in_groups(b["text"]):
                    t, pos, _ = shared.value.hits(group)
                    for k in np.unique(t):
                        rows.append(row(b.iloc[first + k], np.unique(pos[t == k]).tolist()))
                yield pd.DataFrame(rows, columns=["doc_id", "n_spans", "removed_chars", "clean_text"] if len(indexes) == 1 else ["doc_id", "h", "at"])

        return scan

    if len(indexes) == 1:
        return docs.mapInPandas(scanner(indexes[0], lambda d, at: (d["doc_id"], *without_words(d["text"], at, n))), _CLEANED)
    marked = docs.withColumn("h", F.xxhash64("text"))
    places = reduce(DataFrame.unionByName, [marked.mapInPandas(scanner(x, lambda d, at: (d["doc_id"], d["h"], at)), "doc_id long, h long, at array<int>") for x in indexes])
    found = places.distinct().groupBy("doc_id", "h").agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"))

    def clean(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(d, *without_words(t, at, n)) for d, t, at in zip(b["doc_id"], b["text"], b["at"])], columns=["doc_id", "n_spans", "removed_chars", "clean_text"])

    return marked.join(found, ["doc_id", "h"]).mapInPandas(clean, _CLEANED)
