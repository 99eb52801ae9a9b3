"""Text functions as column expressions (no Python in the data path)."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Latin letters with diacritics to their base letter, from the Unicode decompositions.
_ACCENTED = {chr(c): b for c in range(0xC0, 0x250) if (b := unicodedata.normalize("NFD", chr(c))[0]) != chr(c) and b.isascii()}
_FROM, _TO = "".join(_ACCENTED), "".join(_ACCENTED.values())


def strip_accents(c: Column) -> Column:
    """Base letters; combining marks are removed."""
    return F.regexp_replace(F.translate(c, _FROM, _TO), "[\\u0300-\\u036f]", "")


# Signs of Basic Latin, Latin-1 and general punctuation become blanks by table; an expression only has to look for what is left.
_SIGNS = "".join(c for c in map(chr, [*range(0x01, 0xC0), 0xD7, 0xF7, *range(0x2000, 0x2070), 0x20AC]) if not (c.isascii() and c.isalnum()) and c not in "* ")
_CLEAN_FROM, _CLEAN_TO = _FROM + _SIGNS, _TO + " " * len(_SIGNS)


def _clean(c: Column, keep: str) -> Column:
    """Base letters, signs as blanks, combining marks away, everything but a-z, 0-9, * and ``keep`` as blanks, single blanks only."""
    plain = F.regexp_replace(F.translate(c, _CLEAN_FROM, _CLEAN_TO), "[\\u0300-\\u036f]", "")
    # the table has left no sign of Basic Latin but * and blank; a class of one range is twenty times as fast as one of three
    return F.trim(F.regexp_replace(F.regexp_replace(plain, f"[^\\x20-\\x7e{keep}]", " "), " {2,}", " "))


def normalise(c: Column) -> Column:
    """Lower case, no accents, sharp s as ss, everything but a-z, 0-9 and * as single blanks."""
    return _clean(F.replace(F.lower(c), F.lit("ß"), F.lit("ss")), "")


def normalise_keep_sharp(c: Column) -> Column:
    return _clean(F.lower(c), "ß")


def _each(c: Column, pairs: list[tuple[str, str]]) -> Column:
    for a, b in pairs:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


UMLAUTS = [("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("Ä", "Ae"), ("Ö", "Oe"), ("Ü", "Ue")]


def spelled_out(c: Column) -> Column:
    return _each(c, UMLAUTS)


def spelled_back(c: Column) -> Column:
    return _each(c, [(b, a) for a, b in UMLAUTS] + [("AE", "Ä"), ("OE", "Ö"), ("UE", "Ü")])


def variants(c: Column) -> Column:
    """Distinct spellings under which a word may be indexed: normalised, with sharp s, umlauts spelled out, and back where the word allows it."""
    back = F.when(c.rlike("(?i)[aou]e"), normalise(spelled_back(c)))
    sharp = F.when(c.rlike("(?i)ss"), normalise_keep_sharp(F.regexp_replace(c, "(?i)ss", "ß")))
    return F.array_distinct(F.filter(F.array(normalise(c), normalise_keep_sharp(c), normalise(spelled_out(c)), back, sharp), lambda x: x != ""))


def tokens(c: Column) -> Column:
    """Runs of letters and digits, with a closing * if there."""
    return F.regexp_extract_all(c, F.lit("[\\p{L}\\p{N}]+\\*?"), F.lit(0))


def words(c: Column) -> Column:
    """Words of the normalised text; an empty array for null."""
    return F.array_remove(F.split(F.coalesce(normalise(c), F.lit("")), " "), "")


def contains_any(text: Column, spellings: list[str], prefix: bool = False) -> Column:
    """Whether the normalised text, given with a blank before and behind, holds one of the spellings as a whole word, or as the beginning of one."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(f" {v}" if prefix else f" {v} ")) for v in spellings], F.lit(False))


def padded(c: Column) -> Column:
    """The normalised text between blanks, for contains_any."""
    return F.concat(F.lit(" "), normalise(c), F.lit(" "))


def sort_key(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.replace(strip_accents(c), F.lit("ß"), F.lit("ss"))), "[^a-z0-9]+", " "))


def index_letter(c: Column) -> Column:
    letter = F.translate(F.upper(F.left(F.trim(c), F.lit(1))), "ÄÖÜ", "AOU")
    return F.when(letter.rlike("^[A-Z]$"), letter).otherwise("#")


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(normalise(spelled_out(c)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def identity_key(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), "\\s+", " "))


def structural_number(c: Column) -> Column:
    """Number of a unit's label: digits with a letter, or a Roman article."""
    low = F.lower(F.trim(c))
    number = F.regexp_extract(low, "([0-9]+[a-z]?)", 1)
    roman = F.regexp_extract(low, "^(?:artikel|art\\.?)\\s+([ivxlcdm]+)$", 1)
    return F.coalesce(F.nullif(number, F.lit("")), F.nullif(roman, F.lit("")))


def phrases(c: Column) -> Column:
    """Quoted phrases, plain and German quotes."""
    return F.transform(F.regexp_extract_all(c, F.lit("\"[^\"]+\"|„[^“]+“"), F.lit(0)), lambda x: F.trim(F.translate(x, "\"„“", "")))


def snippet(label: Column, heading: Column, body: Column, limit: int = 300) -> Column:
    """The body's beginning without a repeated heading, cut at the last blank in its second half, with an ellipsis."""
    text = F.trim(F.regexp_replace(body, "\\s+", " "))
    both = F.trim(F.concat_ws(" ", label, heading))

    def without(t: Column, prefix: Column) -> Column:
        n = F.length(prefix)
        repeated = (n > 0) & (F.lower(F.left(t, n)) == F.lower(prefix)) & ~F.substring(t, n + 1, F.lit(1)).rlike("[\\p{L}\\p{N}]")
        return F.when(repeated, F.regexp_replace(F.substring(t, n + 1, F.length(t)), "^[\\s:.–—-]+", ""))

    shown = F.coalesce(without(text, both), without(text, F.trim(heading)), without(text, F.trim(label)), text)
    head = F.left(shown, F.lit(limit + 1))
    cut = F.length(head) - F.length(F.substring_index(head, " ", -1)) - 1
    return F.when(F.length(shown) <= limit, shown).otherwise(F.concat(F.rtrim(F.left(shown, F.when(cut > limit // 2, cut).otherwise(limit))), F.lit("…")))


def short_request(c: Column, limit: int = 200, least: int = 40) -> Column:
    """A text as a request of at most ``limit`` characters, cut at the last blank that leaves at least ``least``."""
    text = F.trim(F.regexp_replace(c, "\\s+", " "))
    head = F.left(text, F.lit(limit))
    whole = F.regexp_replace(head, " [^ ]*$", "")
    return F.when(F.length(text) <= limit, text).when(F.length(whole) >= least, whole).otherwise(head)


def fnv1a(c: Column) -> Column:
    """FNV-1a, 32 bits, over the UTF-8 bytes."""
    raw = F.encode(c, "UTF-8")
    bytes_ = F.transform(F.sequence(F.lit(1), F.octet_length(c)), lambda i: F.conv(F.hex(F.substring(raw, i, F.lit(1))), 16, 10).cast("long"))
    return F.aggregate(F.when(F.octet_length(c) > 0, bytes_).otherwise(F.array().cast("array<bigint>")), F.lit(2166136261).cast("long"), lambda h, x: (h.bitwiseXOR(x) * F.lit(16777619)).bitwiseAND(F.lit(4294967295)))
