"""One consistent form for texts that look alike but are stored with different characters.

Width forms, ligatures and presentation forms are compatibility-mapped,
accents composed, spaces mapped to the ordinary one, default-ignorable
characters removed, and look-alike letters brought into the script of their
word. Superscripts, fractions, circled signs, the micro sign and typographic
punctuation carry meaning and stay. Words wholly in another script stay.

``unify`` works each distinct value of an Arrow batch once, and a text without
a character outside the plain ranges only for that one look.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Code points that never need a change: Basic Latin, Latin-1 without the no-break space and the soft hyphen, Latin Extended without ligatures and forms, punctuation and signs, as far as they are composed.
PLAIN = (
    r"\x00-\x9f\xa1-\xac\xae-\u0131\u0134-\u013e\u0141-\u0148\u014a-\u017e\u0180-\u01c3\u01cd-\u01f0\u01f4-\u024f\u1e00-\u1e99\u1ea0-\u1eff"
    r"\u2010-\u2027\u2030-\u205e\u20a0-\u20c0\u2100-\u2125\u2127-\u2129\u212c-\u2328\u232b-\u27bf"
)
_SUSPECT = re.compile(f"[^{PLAIN}]")
#: Escapes in JSON under which such a character may stand (more than needed is harmless).
_ESCAPED = re.compile(r"\\u(?!00)|\\u00[89]|\\u00[aA][0dD]")


def json_suspect(raw: str) -> bool:
    """Whether a JSON text may hold a character outside the plain ranges, itself or escaped."""
    return _SUSPECT.search(raw) is not None or ("\\u" in raw and _ESCAPED.search(raw) is not None)


#: Decomposition kinds that are mere forms of the same letter.
_FORMS = ("<wide>", "<narrow>", "<font>", "<initial>", "<medial>", "<final>", "<isolated>", "<vertical>", "<small>")
#: Characters with the property Default_Ignorable_Code_Point.
_IGNORABLE = re.compile(
    r"[\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0\ufff0-\ufff8"
    r"\U0001bca0-\U0001bca3\U0001d173-\U0001d17a\U000e0000-\U000e0fff]"
)
_SPACE = re.compile(r"[\u00a0\u1680\u2000-\u200a\u202f\u205f\u3000]")
_BREAK = re.compile(r"[\u2028\u2029]")
_WORD = re.compile(r"[^\W\d_]+")
_GREEK = re.compile(r"[\u0370-\u03ff\u1f00-\u1fff]")
_CYRILLIC = re.compile(r"[\u0400-\u052f\u1c80-\u1c8f\u2de0-\u2dff\ua640-\ua69f]")
_LATIN = re.compile(r"[A-Za-z\u00aa\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u1e00-\u1eff\u2c60-\u2c7f\ua720-\ua7ff]")

# Letters that look alike (from the Unicode confusables), foreign letter and Latin letter.
_CYRILLIC_ALIKE = "АA ВB ЕE ЅS ІI ЇÏ ЈJ КK МM НH ОO РP СC ТT УY ХX ԌG ԚQ ԜW аa еe ѕs іi їï јj оo рp сc уy хx һh ԁd ԛq ԝw ӏl ѵv ьb"
_GREEK_ALIKE = "ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX αa ιi κk νv οo ρp υu γy ηn ωw χx τt ϳj ϲc"
_TO_LATIN = {p[0]: p[1] for p in (_CYRILLIC_ALIKE + " " + _GREEK_ALIKE).split()}
_TO_CYRILLIC = {p[1]: p[0] for p in _CYRILLIC_ALIKE.split()}
_TO_GREEK = {p[1]: p[0] for p in _GREEK_ALIKE.split()}

KINDS = ("width", "ligature", "mark", "invisible", "space", "mixed")


def has_mark(text: str) -> bool:
    return any(unicodedata.category(c)[0] == "M" for c in set(text) if c > "\u02ff")


@lru_cache(maxsize=4096)
def _form(ch: str) -> tuple[str, str | None]:
    """A character's plain form and the kind of change."""
    d = unicodedata.decomposition(ch)
    if d.startswith("<"):
        if "LIGATURE" in unicodedata.name(ch, ""):
            return unicodedata.normalize("NFKC", ch), "ligature"
        if d.split(" ", 1)[0] in _FORMS:
            return unicodedata.normalize("NFKC", ch), "width"
    return ch, None


def _one_script(word: str) -> str:
    """A mixed word in one script: Latin if every foreign letter has a Latin look-alike, else the foreign one if every Latin letter has a look-alike there, else unchanged."""
    foreign = [c for c in word if _GREEK.match(c) or _CYRILLIC.match(c)]
    if all(c in _TO_LATIN for c in foreign):
        return "".join(_TO_LATIN.get(c, c) for c in word)
    if not any(_GREEK.match(c) for c in foreign):
        back = _TO_CYRILLIC
    elif not any(_CYRILLIC.match(c) for c in foreign):
        back = _TO_GREEK
    else:
        return word
    if all(c in back for c in word if _LATIN.match(c)):
        return "".join(back.get(c, c) for c in word)
    return word


def unify_text(text: str) -> tuple[str, list[str]]:
    """The consistent form of a text and the kinds of change that its stored form needs, in the order of KINDS."""
    if not _SUSPECT.search(text):
        return text, []
    found = set()
    if has_mark(text):
        found.add("mark")
    out, n = _IGNORABLE.subn("", text)
    if n:
        found.add("invisible")
    out, n = _SPACE.subn(" ", out)
    out, m = _BREAK.subn("\n", out)
    if n or m:
        found.add("space")
    swaps = {}
    for c in set(out):
        if c > "\u0131":
            form, kind = _form(c)
            if kind:
                swaps[ord(c)] = form
                found.add(kind)
    if swaps:
        out = out.translate(swaps)
    out = unicodedata.normalize("NFC", out)
    if _LATIN.search(out) and (_GREEK.search(out) or _CYRILLIC.search(out)):

        def one(m: re.Match) -> str:
            w = m.group()
            if _LATIN.search(w) and (_GREEK.search(w) or _CYRILLIC.search(w)):
                found.add("mixed")
                return _one_script(w)
            return w

        out = _WORD.sub(one, out)
    return out, [k for k in KINDS if k in found]


def compare_key(text: str) -> str:
    """The form for comparisons: full case folding of the consistent form, composed again."""
    return unicodedata.normalize("NFC", text.casefold())


def unify_values(s: pd.Series) -> pd.DataFrame:
    """text, form_key, findings for each value; every distinct value is worked once. Null stays null."""
    codes, values = pd.factorize(s, use_na_sentinel=True)
    forms = [unify_text(v) for v in values]
    frame = pd.DataFrame({"text": [f[0] for f in forms] + [None], "form_key": [compare_key(f[0]) for f in forms] + [None], "findings": [f[1] for f in forms] + [None]}, dtype=object)
    return frame.iloc[codes].reset_index(drop=True)


_FORM = T.StructType([T.StructField("text", T.StringType()), T.StructField("form_key", T.StringType()), T.StructField("findings", T.ArrayType(T.StringType()))])
_unify_udf = F.pandas_udf(unify_values, _FORM)


def unify(df: DataFrame, text: str, out: str = "form") -> DataFrame:
    """Adds ``out``: struct<text, form_key, findings> for the string column ``text``.

    Null gives null. An empty text is its own form. Texts in plain characters
    only stay as they are, after one look. An existing column ``out`` is
    replaced, other columns stay.
    """
    return df.withColumn(out, _unify_udf(F.col(text)))
