"""Search requests and query plans: plain data on the driver, no Spark.

A request is cut into lexemes once; a scanner walks them and takes phrases and
structural addresses out, what it leaves are words. What may follow a marker
such as "§" is written down as data (``_MARKERS``), not as patterns over the
whole request.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable
from dataclasses import dataclass, field

MATCH_MODES = ("and-first", "or-prefix")
SCOPES = ("all", "title", "body")
MOST_CHARACTERS, SHORTEST_PREFIX = 200, 4
# Small words that never become prefixes by themselves. Names of places of a portal come from the caller.
SMALL_WORDS = frozenset("uber ueber fur fuer nach oder sowie vom zum zur des der die das und den dem mit von bei aus ohne eine einer eines einem einen durch gegen".split())

# --- spellings ---------------------------------------------------------------


_MARKS, _OTHER, _OTHER_SHARP = re.compile("[\u0300-\u036f]+"), re.compile("[^a-z0-9*]+"), re.compile("[^a-z0-9*ß]+")


def _folded(value: str, sharp: str) -> str:
    """Lower case without marks; ``sharp`` for ß; all signs but a-z, 0-9, * and what ``sharp`` holds part words."""
    plain = _MARKS.sub("", unicodedata.normalize("NFD", value.lower()))
    return (_OTHER_SHARP if sharp == "ß" else _OTHER).sub(" ", plain.replace("ß", sharp)).strip()


def normalise(value: str) -> str:
    return _folded(value, "ss")


def normalise_keep_sharp(value: str) -> str:
    return _folded(value, "ß")


_WRITTEN_OUT = {"ä": "ae", "ö": "oe", "ü": "ue", "Ä": "Ae", "Ö": "Oe", "Ü": "Ue"}
_DRAWN_TOGETHER = {"ae": "ä", "oe": "ö", "ue": "ü", "Ae": "Ä", "Oe": "Ö", "Ue": "Ü", "AE": "Ä", "OE": "Ö", "UE": "Ü"}
_SHARPENED = {s: "ß" for s in ("ss", "sS", "Ss", "SS")}
#: Ways to spell a word otherwise: what is replaced, and by which form it is normalised.
_SPELLINGS = (({}, normalise), ({}, normalise_keep_sharp), (_WRITTEN_OUT, normalise), (_DRAWN_TOGETHER, normalise), (_SHARPENED, normalise_keep_sharp))


def variants(value: str) -> list[str]:
    """The distinct spellings under which a word may be indexed, the plain one first."""
    found: dict[str, None] = {}
    for table, form in _SPELLINGS:
        spelled = value
        for old, new in table.items():
            spelled = spelled.replace(old, new)
        found[form(spelled)] = None
    return [v for v in found if v]


# --- plans -------------------------------------------------------------------


@dataclass(frozen=True)
class Token:
    raw: str
    normalised: str
    variants: tuple[str, ...]
    prefix: bool


@dataclass(frozen=True)
class Address:
    """A structural address: kind is paragraph, article, subsection or number."""

    kind: str
    number: str
    subsection: str | None = None


@dataclass(frozen=True)
class Plan:
    """``wide``: for each word whether it is a prefix in or-prefix."""

    tokens: list[Token]
    phrases: list[str]
    addresses: list[Address]
    identity: list[str] = field(default_factory=list)
    subject: list[str] = field(default_factory=list)
    mode: str = "and-first"
    scope: str = "all"
    wide: tuple[bool, ...] = ()

    @property
    def free_text(self) -> bool:
        return bool(self.tokens or self.phrases)


_LEXEME = re.compile(r'"[^"]+"|„[^“]+“|§+|\d+(?:\.\d+)+|[^\W_]+\*?|\S')
_PLAIN = re.compile(r"\d+[a-z]?", re.IGNORECASE)
_ROMAN = re.compile(r"[IVXLC]+", re.IGNORECASE)
_DOTTED = re.compile(r"\d{1,2}(?:\.\d{1,2}){0,5}")
# Words and signs that announce an address, its kind, and the forms its number may have.
_MARKERS = {
    "§": ("paragraph", (_PLAIN,)), "§§": ("paragraph", (_PLAIN,)), "artikel": ("article", (_PLAIN, _ROMAN)), "art": ("article", (_PLAIN, _ROMAN)),
    "absatz": ("subsection", (_PLAIN,)), "abs": ("subsection", (_PLAIN,)), "nr": ("number", (_DOTTED,)), "nummer": ("number", (_DOTTED,)), "ziffer": ("number", (_DOTTED,)), "ziff": ("number", (_DOTTED,)),
}
_LISTING = (",", "und")


class _Scanner:
    """Walks the lexemes of a request; ``at`` is the next one."""

    def __init__(self, request: str) -> None:
        self.lexemes, self.at = _LEXEME.findall(request), 0
        self.phrases: list[str] = []
        self.addresses: list[Address] = []
        self.words: list[str] = []
        self._numbers: list[tuple[int, list[str], Address]] = []
        while self.at < len(self.lexemes):
            self._step()
        if any(a.kind in ("paragraph", "article") for a in self.addresses):
            for place, lexemes, _ in reversed(self._numbers):  # next to a paragraph or an article, a number is a word
                self.words[place:place] = lexemes
        else:
            self.addresses += [a for *_, a in self._numbers]
        self.addresses = list(dict.fromkeys(self.addresses))

    def _step(self) -> None:
        x = self.lexemes[self.at]
        if len(x) > 2 and x[0] in '"„':
            if x[1:-1].strip():
                self.phrases.append(x[1:-1].strip())
            self.at += 1
            return
        start = self.at
        kind, numbers = self._address()
        if not numbers:
            self.words.append(x)
            self.at = start + 1
        elif kind == "number":
            self._numbers.append((len(self.words), self.lexemes[start : self.at], Address(kind, numbers[0])))
        else:
            inner = self._address(("subsection",))[1] if kind in ("paragraph", "article") else []
            self.addresses += [Address(kind, n, inner[0] if inner else None) for n in numbers]

    def _address(self, kinds: tuple[str, ...] | None = None) -> tuple[str, list[str]]:
        """Kind and numbers of the address that begins here, and moves behind it; no numbers, and stays, if none does."""
        start = self.at
        kind, forms = _MARKERS.get(self._peek().lower(), ("", ()))
        if not kind or (kinds and kind not in kinds):
            return "", []
        self.at += 1
        if self._peek() == ".":
            self.at += 1
        numbers: list[str] = []
        while any(f.fullmatch(self._peek()) for f in forms):
            numbers.append(self._peek().lower())
            self.at += 1
            following = self.lexemes[self.at + 1] if self.at + 1 < len(self.lexemes) else ""
            if kind != "paragraph" or self._peek().lower() not in _LISTING or not _PLAIN.fullmatch(following):
                break
            self.at += 1
        if not numbers:
            self.at = start
        return kind, numbers

    def _peek(self) -> str:
        return self.lexemes[self.at] if self.at < len(self.lexemes) else ""


def split_addresses(text: str) -> tuple[list[Address], str]:
    """The addresses of a request and the words left of it. Decimal numbers count only where there is no paragraph or article."""
    s = _Scanner(text)
    return s.addresses, " ".join(s.words)


def parse_tokens(text: str) -> list[Token]:
    """The words of a text, each spelling once; a closing * asks for a prefix."""
    known: dict[tuple[str, bool], Token] = {}
    for w in re.findall(r"[^\W_]+\*?", text):
        raw = w.removesuffix("*")
        key = (normalise(raw), raw != w)
        if key[0] and key not in known:
            known[key] = Token(raw, key[0], tuple(variants(raw)), key[1])
    return list(known.values())


def _grows(t: Token, small: Iterable[str]) -> bool:
    return not t.prefix and len(t.normalised) >= SHORTEST_PREFIX and not t.normalised.isdigit() and t.normalised not in SMALL_WORDS and t.normalised not in small


def build_plan(request: str, mode: str = "and-first", scope: str = "all", small_words: Iterable[str] = ()) -> Plan:
    """Phrases, addresses and words of a request of at most MOST_CHARACTERS.

    In and-first the last word becomes a prefix if it is long enough, no number
    and no small word; in or-prefix every such word does. Identity counts only
    without addresses and phrases.
    """
    request = request[:MOST_CHARACTERS].strip()
    s = _Scanner(request)
    rest = " ".join(s.words)
    grown = _grown(parse_tokens(rest), mode, frozenset(small_words))
    return Plan(list(grown), s.phrases, s.addresses, [] if s.addresses or s.phrases else variants(request), variants(rest), mode, scope, tuple(grown.values()))


def word_plan(request: str, mode: str = "and-first", scope: str = "all") -> Plan:
    """The plan of a request that is a text by itself: all of it are words, also what looks like a phrase, an address or a prefix."""
    request = request[:MOST_CHARACTERS].strip()
    grown = _grown(parse_tokens(request.replace("*", " ")), mode, frozenset())
    return Plan(list(grown), [], [], variants(request), variants(request), mode, scope, tuple(grown.values()))


def _grown(words: list[Token], mode: str, small: frozenset[str]) -> dict[Token, bool]:
    """The words as they are sought in the mode, and whether each is a prefix in or-prefix."""
    grown: dict[Token, bool] = {}
    for k, t in enumerate(words):
        wide = t.prefix or _grows(t, small)
        narrow = wide if mode == "or-prefix" or k == len(words) - 1 else t.prefix
        grown.setdefault(Token(t.raw, t.normalised, t.variants, narrow), wide)
    return grown


def short_request(text: str, limit: int = MOST_CHARACTERS, least: int = 40) -> str:
    """A text as a request of at most ``limit`` characters, cut at the last blank if that leaves more than ``least``."""
    text = " ".join(text.split())
    if len(text) <= limit:
        return text
    head = text[:limit]
    blank = head.rfind(" ")
    return head[:blank] if blank > least else head


def clamp(value: str | int | None, low: int, high: int, default: int) -> int:
    try:
        return min(high, max(low, int(value)))  # type: ignore[arg-type]
    except (TypeError, ValueError):
        return default
