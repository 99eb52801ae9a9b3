"""Pages of stuffed keywords, link lists and tags, found by the shapes of their lines.

Each line is cut into units: sentences, and runs of words without any small word
(at most SMALL letters, as every language's sentences have between their
others). A unit is reduced to a shape: how many words, which capitals, which
separators, what kind of link. Runs with separators or links between their
words, and runs in a line that does not close, are no sentences; nor are words
that come back within a few dozen words again and again. No words of any
language are listed. Units are grouped by shape within their page, and a page is
flagged if its few largest non-sentence shapes hold at least half of its words.
Numbered lines (contents, fee tables), a section of further links after the
text, and closing keywords are ordinary. A page is one row and needs no exchange.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Share of a page's words; its largest non-sentence shapes that count: so many, and one more for each so many units in such shapes.
SHARE, FEW, UNITS_A_SHAPE = 0.5, 12, 6
#: Letters of a small word at most.
SMALL = 3
#: Words without a small word that make a run of their own inside a line; so few if separators stand between them.
RUN, SEPARATED_RUN = 7, 3
#: Words in a row over which repetition is measured; the share of words among them that were there before in another place from which they are no sentence's, and that of different words under which they are none.
WINDOW, AGAIN, DIFFERENT = 24, 0.32, 0.4
#: Words per separator, commas included, at most in a list.
PER_SEPARATOR = 3
#: Fewest words in lists for a page to be flagged: fewer are a stub.
LEAST = 3

_WORD = re.compile(r"[^\W_]+")
_LINK = re.compile(r"<[^<>\n]+>|(?:https?://|www\.)[^\s)\]<>]+")
_SEPARATOR = re.compile(r"[|/›»#;,•·★☆]")
_BETWEEN = re.compile(r"[|/›»#;•·★☆]|(?:^|\s)[+-]\S|\s-\s")
_NUMBERED = re.compile(r"^\s*(?:§+\s*\d|\(\d+[a-z]?\)|\d+(?:\.\d+)*[.)]?\s|[a-z]\)\s|(?:Art\.|Artikel|Article|Section|Annex|Anlage|Anhang|Teil|Part|Abschnitt|Kapitel|Chapter|Nr\.|No\.)\s*(?:\d|[IVXLC]+\b))")
_SENTENCE_END = re.compile(r"(?<=[.!?…])[\"“”»)]*\s+(?=[^\W\d_]|[„\"(§#])|(?<=[。！？])")
_CLOSED = re.compile(r"[.!?…:。！？۔؟।][\"“”»)\]]*\s*$")
_HEADING = re.compile(r"^[^\W\d_][\w\s-]{0,40}:$")
_LABELLED = re.compile(r"^[^\W\d_][\w-]{1,30}:\s+\S")
_BULLET = re.compile(r"^\s*[-–•*]\s+")
_SEPARATORS = "|;,/›»>#•·★☆[]()*:"


def shape_of(unit: str, words: list[str]) -> tuple:
    """Word-count class, capitals, separators, link kind."""
    letters = [w for w in words if w[0].isalpha()]
    capital = sum(w[0].isupper() for w in letters)
    caps = "none" if capital == 0 else "all" if capital == len(letters) else "some"
    link = "url" if _LINK.search(unit) else ""
    plain = _LINK.sub("", unit)
    seps = "".join(s for s in _SEPARATORS if s in plain)
    return (min(len(words).bit_length(), 6), caps, seps, link)


def _is_small(w: str, first: bool) -> bool:
    return w.isalpha() and (w == w.lower() or (first and w[1:] == w[1:].lower()))


def _apart(text: str, words: int) -> bool:
    """Whether separators stand between the words of a run: one of the strong ones, or commas and the like after every few words."""
    return _BETWEEN.search(text) is not None or len(_SEPARATOR.findall(text)) >= max(2, words / PER_SEPARATOR)


def _longest_run(small: list[bool]) -> int:
    longest = run = 0
    for s in small:
        run = 0 if s else run + 1
        if run > longest:
            longest = run
    return longest


def _runs(line: str) -> list[tuple[str, list[str], bool]]:
    """(unit, words, whether it may be a sentence) of one line."""
    out = []
    for part in _SENTENCE_END.split(line):
        words = _WORD.findall(part)
        if not words:
            continue
        linked = "<" in part or "http" in part or "www." in part
        shown = str.lower if part.isupper() else str
        small = [len(w) <= SMALL and _is_small(shown(w), k == 0) for k, w in enumerate(words)]
        if not linked and any(small) and (longest := _longest_run(small)) < RUN and (longest < SEPARATED_RUN or not (part.count(",") > 1 or _BETWEEN.search(part))):
            out.append((part, words, True))  # most sentences
            continue
        found = list(_WORD.finditer(part))
        links = [m.span() for m in _LINK.finditer(part)] if linked else []
        inside = [any(a <= m.start() < b for a, b in links) for m in found] if links else [False] * len(found)
        small = [s and not link for s, link in zip(small, inside)]
        closed = _CLOSED.search(part) is not None
        if not any(small):
            apart = links or (len(found) >= SEPARATED_RUN and _apart(part[: found[-1].end()], len(found)))
            out.append((part, [m.group() for m in found], closed and not apart))
            continue
        if len(_SEPARATOR.findall(part)) >= max(4, len(found) / PER_SEPARATOR) and _BETWEEN.search(part):
            out.append((part, [m.group() for m in found], False))
            continue
        # long runs without small words are units of their own
        start = k = 0
        spans: list[tuple[int, int, bool]] = []
        while k < len(found):
            if small[k]:
                k += 1
                continue
            e = k
            while e < len(found) and not small[e]:
                e += 1
            apart = any(inside[k:e]) or _apart(part[found[k].start() : found[e - 1].end()], e - k)
            if sum(m.group()[0].isalpha() for m in found[k:e]) >= (SEPARATED_RUN if apart else RUN):
                if k > start:
                    spans.append((start, k, True))
                # what goes on to the end of a line that does not close is no sentence
                spans.append((k, e, not apart and (e < len(found) or closed)))
                start = e
            k = e
        if start < len(found):
            spans.append((start, len(found), True))
        for a, b, sentence in spans:
            lo = 0 if a == 0 else found[a].start()
            hi = len(part) if b == len(found) else found[b].start()
            out.append((part[lo:hi], [m.group() for m in found[a:b]], sentence))
    return out


def _repeating(words: list[str]) -> list[bool]:
    """For each word whether it stands in a window of repeated words; windows overlap by half, the last ends with the last word."""
    out = [False] * len(words)
    for k in range(0, len(words), WINDOW // 2):
        k = max(0, min(k, len(words) - WINDOW))
        window = words[k : k + WINDOW]
        if len(window) - len(set(window)) <= AGAIN * len(window):
            continue
        seen, pairs, again, before = set(), set(), 0, ""
        for w in window:  # a phrase that comes back counts once, keywords in ever new order each time
            again += w in seen and (before, w) not in pairs
            seen.add(w)
            pairs.add((before, w))
            before = w
        if len(window) > WINDOW // 3 and (again > AGAIN * len(window) or len(seen) < DIFFERENT * len(window)):
            out[k : k + WINDOW] = [True] * len(window)
    return out


def page_profile(text: str) -> tuple[int, int, int, list[tuple[tuple, int]], int]:
    """(words, words in sentences, words in ordinary lists, the few largest non-sentence shapes with their words, words in all of these)."""
    lines = text.split("\n")
    full = [i for i, line in enumerate(lines) if line.strip()]
    sentence = ordinary = 0
    shapes: Counter = Counter()
    units = 0
    waiting: list[tuple[str, list[str]]] = []
    further = False
    labels = Counter(m.group().split(":")[0] for line in lines if (m := _LABELLED.match(line)))
    for i in full:
        line = lines[i].strip()
        if _HEADING.match(line):
            further = bool(waiting)
            ordinary += len(_WORD.findall(line))
            continue
        if further and _BULLET.match(line):
            ordinary += len(_WORD.findall(line))
            continue
        if _NUMBERED.match(line):
            further = False
            ordinary += len(_WORD.findall(line))
            continue
        if i == full[-1] and waiting and (m := _LABELLED.match(line)) and labels[m.group().split(":")[0]] == 1 and not any(s in line for s in "|;/#"):
            ordinary += len(_WORD.findall(line))
            continue
        units_here = _runs(line)
        further = further and not units_here
        for unit, words, may in units_here:
            if may:
                waiting.append((unit, words))
            else:
                shapes[shape_of(unit, words)] += len(words)
                units += 1
    repeating = iter(_repeating([w.lower() for _, words in waiting for w in words]))
    for unit, words in waiting:
        listed = sum(next(repeating) for _ in words)
        sentence += len(words) - listed
        if listed:
            shapes[shape_of(unit, words)] += listed
            units += 1
    total = sentence + ordinary + sum(shapes.values())
    return total, sentence, ordinary, [(s, n) for s, n in shapes.most_common(FEW + units // UNITS_A_SHAPE)], sum(shapes.values())


def stuffed_share(text: str) -> float:
    """Share of the words that lie in the page's few largest non-sentence shapes; 0 for a page without words or with too few."""
    total, _, _, shapes, in_lists = page_profile(text)
    return sum(n for _, n in shapes) / total if in_lists >= LEAST else 0.0


def profile_pages(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, sentence_words, ordinary_words, list_words, n_shapes, share of each row of documents(doc_id, text); null or wordless texts have share 0, null ids are left out."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for d, t in zip(b["doc_id"], b["text"]):
                total, sentence, ordinary, shapes, in_lists = page_profile(t or "")
                rows.append((d, total, sentence, ordinary, in_lists, len(shapes), sum(n for _, n in shapes) / max(1, total)))
            yield pd.DataFrame(rows, columns=["doc_id", "n_words", "sentence_words", "ordinary_words", "list_words", "n_shapes", "share"])

    docs = documents.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInPandas(of, "doc_id long, n_words int, sentence_words int, ordinary_words int, list_words int, n_shapes int, share double")


def stuffed_pages(documents: DataFrame, share: float = SHARE) -> DataFrame:
    """doc_id (each once) of the pages whose few largest non-sentence shapes hold at least ``share`` of their words."""
    return profile_pages(documents).where((F.col("share") >= share) & (F.col("list_words") >= LEAST)).select("doc_id").distinct()
