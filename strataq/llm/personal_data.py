"""Personal data in free text: location, type, and typed placeholders with format-preserving pseudonyms.

Every kind is found by its own form; a form that also occurs in file numbers,
amounts or citations needs a check digit or a word that announces it. An item
is replaced by ``[TYPE:pseudonym]``. A value is first brought into one writing
(``canonical``); numbers are then permuted within their format by a keyed
Feistel network (country codes and check digits stay valid, and the birth date
inside a pension number stays a date); names, addresses and mail addresses get a
keyed tag. So equal values have equal placeholders in all documents, however
they were written, and a keyed link tag. A batch works each distinct value once;
there is no exchange.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- keyed permutations -----------------------------------------------------


class Feistel:
    """Keyed permutations of the numbers below a size; the same key and size give the same permutation."""

    ROUNDS = 10

    def __init__(self, key: bytes) -> None:
        self.key = key

    def _round(self, k: int, size: int, half: int, x: int) -> int:
        h = hashlib.blake2b(f"{k}|{size}|{x}".encode(), key=self.key[:64], digest_size=16).digest()
        return int.from_bytes(h, "big") % half

    def _once(self, x: int, size: int, a: int, b: int, forth: bool) -> int:
        left, right = divmod(x, b)
        for k in range(self.ROUNDS) if forth else reversed(range(self.ROUNDS)):
            if k % 2 == 0:
                f = self._round(k, size, a, right)
                left = (left + f) % a if forth else (left - f) % a
            else:
                f = self._round(k, size, b, left)
                right = (right + f) % b if forth else (right - f) % b
        return left * b + right

    def _walk(self, x: int, size: int, forth: bool) -> int:
        if size < 2:
            return x
        a = math.isqrt(size - 1) + 1  # a near-square frame that holds the numbers
        b = -(-size // a)
        while True:
            x = self._once(x, size, a, b, forth)
            if x < size:
                return x

    def permute(self, x: int, size: int) -> int:
        return self._walk(x, size, True)

    def invert(self, x: int, size: int) -> int:
        return self._walk(x, size, False)

    def digits(self, s: str, forth: bool = True) -> str:
        """A string of digits as another of the same length."""
        return str(self._walk(int(s), 10 ** len(s), forth)).zfill(len(s)) if s else s

    def signs(self, s: str, forth: bool = True) -> str:
        """Digits become digits and capital letters capital letters, all together one number; other signs stay."""
        radix = [10 if c.isdigit() else 26 if "A" <= c <= "Z" else 1 for c in s]
        x = size = 0
        size = 1
        for c, r in zip(s, radix):
            x = x * r + (int(c) if r == 10 else ord(c) - 65 if r == 26 else 0)
            size *= r
        x, out = self._walk(x, size, forth), []
        for c, r in zip(reversed(s), reversed(radix)):
            x, k = divmod(x, r)
            out.append(str(k) if r == 10 else chr(65 + k) if r == 26 else c)
        return "".join(reversed(out))

    def tag(self, kind: str, value: str) -> str:
        return hashlib.blake2b(f"{kind}|{value}".encode(), key=self.key[:64], digest_size=6).hexdigest()


# --- check digits -----------------------------------------------------------


def iban_check(country: str, bban: str) -> str:
    n = int("".join(str(int(c, 36)) for c in bban + country) + "00")
    return f"{98 - n % 97:02d}"


def iban_valid(iban: str) -> bool:
    return len(iban) >= 15 and iban_check(iban[:2], iban[4:]) == iban[2:4]


def tax_check(ten: str) -> str:
    """ISO 7064 MOD 11,10."""
    p = 10
    for c in ten:
        s = (int(c) + p) % 10 or 10
        p = s * 2 % 11
    return str((11 - p) % 10)


def pension_check(first: str) -> str:
    """Check digit of the eleven signs before it (two, six digits, letter, two digits)."""
    digits = first[:8] + f"{ord(first[8]) - 64:02d}" + first[9:11]
    weights = (2, 1, 2, 5, 7, 1, 2, 1, 2, 1, 2, 1)  # fixed values of the pension number
    return str(sum(sum(map(int, str(int(d) * w))) for d, w in zip(digits, weights)) % 10)


def _refill(shape: str, signs: str, keep: Callable[[str], bool] = str.isalnum) -> str:
    """``shape`` with its letters and digits replaced in order."""
    it = iter(signs)
    return "".join(next(it) if keep(c) else c for c in shape)


# --- forms ------------------------------------------------------------------

TYPES = ("EMAIL", "IDNUM", "PHONE", "ADDRESS", "NAME")

_LABEL = r"[A-Za-zÄÖÜäöüß0-9](?:[\wäöüß-]*[A-Za-zÄÖÜäöüß0-9])?"
_AT = r"(?:\s?@\s?|\s?[\[({<]\s?(?:at|ät|AT)\s?[\])}>]\s?|\s(?:at|ät|AT)\s)"
_DOT = r"(?:\.|\s?[\[({<]\s?(?:punkt|dot|PUNKT|DOT)\s?[\])}>]\s?|\s(?:punkt|dot|PUNKT|DOT)\s)"
_EMAIL = re.compile(rf"(?<![\w.+%-])[A-Za-zÄÖÜäöüß0-9][\w.+%-]*{_AT}{_LABEL}(?:{_DOT}{_LABEL})*{_DOT}[A-Za-z]{{2,}}(?![\w-])")
_URL = re.compile(r"(?:https?://|www\.)\S+")

_IBAN = re.compile(r"(?<![A-Za-z0-9])([A-Z]{2}\d{2}(?:[ -]?[A-Z0-9]{4}){2,7}(?:[ -]?[A-Z0-9]{1,4})?)(?![A-Za-z0-9])")
_PENSION = re.compile(r"(?<![A-Za-z0-9])(\d{2}[ -]?(?:0[1-9]|[12]\d|3[01])(?:0\d|1[0-2])\d{2}[ -]?[A-Z][ -]?\d{2}[ -]?\d)(?![A-Za-z0-9])")
_TAX_WORD = re.compile(r"(?:\b(?:St(?:euer)?-?Id(?:Nr|-Nr)?|IdNr|Id-Nr|TIN)\b\.?|Steuer-?(?:id(?:entifikations)?-?(?:nummer|nr\.?)|ID(?:-Nr\.?)?|identnummer))\s*(?:(?:ist|lautet)\s+)?:?\s*(\d{2}[ ]?\d{3}[ ]?\d{3}[ ]?\d{3})(?!\d)", re.IGNORECASE)
_TAX = re.compile(r"(?<![\w/.,-])([1-9]\d[ ]?\d{3}[ ]?\d{3}[ ]?\d{3})(?![\w/-]|[.,]\d)")
_TAX_OFFICE = re.compile(r"(?:Steuernummer|Steuer-?Nr\.?|St\.?-?Nr\.?)\s*:?\s*(\d{2,5}[ /]\d{3,4}[ /]\d{4,5}|\d{10,13})(?!\d)", re.IGNORECASE)
_CARD = re.compile(r"(?:Personalausweis|Reisepass|Ausweis|Pass|Perso)(?:dokument)?-?(?:nummer|nr\.?)?(?:[ -]?(?:Nr\.?|Nummer))?\s*(?:(?:ist|lautet)\s+)?:?\s*((?=[A-Z0-9]*\d)[A-Z][A-Z0-9]{8}\d?)(?![A-Za-z0-9])", re.IGNORECASE)

_PHONE = re.compile(r"(?<![\w+/.,:-])(?:\+|00)[1-9]\d{0,2}(?:[ ./-]?\(0\))?(?:[ ./-]{1,3}\d{1,9}|\d{2,13}){1,6}(?![\w]|[/-]\d)|(?<![\w+/.,:@-])\(?0[1-9]\d{1,4}\)?(?:[ ]?[-/.][ ]?|[ ])?\d{2,9}(?:[ ./-]\d{1,8}){0,4}(?![\w]|[/-]\d)")
_NO_PHONE = re.compile(r"(?:Vorgangs?|Aktenzeichen|Az\.?|Gliederungsnummer|Nummer|Nr\.|Blatt|Seite|S\.|Betrag|Fehler|Absatz|§§?|Kundennummer|Rechnung|Beleg|Zeichen|Konto)\s*:?\s*$", re.IGNORECASE)

_NUMBER = r"\d{1,4}(?:\s?[a-z](?!\w))?(?:\s?[-–/]\s?\d{1,4}(?:\s?[a-z](?!\w))?)?(?![\w])(?!\.\d)(?!,\d)(?!\s?(?:Euro|€|Prozent|%|Meter|Hektar|m²|km|Tage|Jahre))"
_TOWN = r"(?:\s*,?\s*(?:\n\s*|in\s+)?(?:D[- ])?\d{5}\s+[A-ZÄÖÜ][\wäöüß-]+(?:\s(?:am|an der|im|bei|ob der)\s[A-ZÄÖÜ][\wäöüß-]+)?)"
_CAP = r"[A-ZÄÖÜ][\wäöüß]*(?:-[A-ZÄÖÜ][\wäöüß]*)*"
_SUFFIX = r"(?:straße|strasse|str\.|gasse|allee|weg|platz|damm|ufer|chaussee|steig|stieg|pfad|ring|kanal|promenade|twiete)"
_STREET = rf"(?:{_CAP}{_SUFFIX}|{_CAP}(?:\s{_CAP})?\s(?:Straße|Strasse|Str\.|Gasse|Allee|Weg|Platz|Damm|Ufer|Chaussee|Steig|Stieg|Pfad|Ring|Kanal|Promenade))"
_PLACE = rf"(?:(?:Am|An der|An dem|An den|Im|In der|In den|Auf dem|Auf der|Hinter dem|Hinter der|Vor dem|Vor der|Zum|Zur|Unter den|Bei der|Beim|Alte[rs]?|Neue[rs]?|Große[rs]?|Kleine[rs]?|Lange[rs]?)\s{_CAP}(?:\s{_CAP})?)"
_ANNOUNCED = re.compile(rf"(?:Anschrift|Adresse|Wohnanschrift|Wohnort|wohnhaft|wohne(?:n)?|Post(?: bitte)? an|Grundstück|Haus|zugestellt|senden an|schicken an)\s*(?:ist|lautet|in|in der|am|an)?\s*:?\s*((?:{_STREET}|{_PLACE}|{_CAP}(?:\s{_CAP}){{0,2}})\s{_NUMBER}{_TOWN}?)")
_WITH_TOWN = re.compile(rf"(?<![\w-])((?:{_STREET}|{_PLACE})\s{_NUMBER}{_TOWN})")
_BARE = re.compile(rf"(?<![\w-])({_STREET}\s{_NUMBER})")

_LAST = r"[A-ZÄÖÜ][a-zäöüß]+(?:-[A-ZÄÖÜ][a-zäöüß]+)*"
_UPPER = r"[A-ZÄÖÜ][A-ZÄÖÜß]+(?:-[A-ZÄÖÜ][A-ZÄÖÜß]+)*"
_LOWER = r"[a-zäöüß]{2,}(?:-[a-zäöüß]{2,})*"
_TITLE = r"(?:(?:Dr|Prof|Mag|Dipl)\.(?:-[A-Z][a-z]+\.)?(?:\s?(?:med|jur|phil|rer|nat|iur|h\.\s?c)\.)*)"
_POLITE = r"(?:Herrn?|Frau)"
_TWO = rf"(?!(?:Herrn?|Frau|Dr|Prof)\b)(?:{_UPPER}(?:\s{_UPPER}){{1,3}}|{_LAST},\s{_LAST}|(?:[A-ZÄÖÜ]\.\s?){{1,2}}{_LAST}|{_LAST}\s(?:(?:von|zu|van|de)\s)?{_LAST})"
_CUE = r"(?:[Mm]ein Name ist|[Ii]ch bin|[Kk]ontakt(?:person)?:|[Ii]ch heiße|[Mm]ir hat(?:te)?|[Ll]aut|[Nn]ach Auskunft von|[Nn]ach Angaben von|[Nn]ame:|gez\.|i\.\s?[AV]\.|Grüßen,?|Gruß,?|Grüße,?|Hochachtungsvoll,?|Sachbearbeiter(?:in)?|Ansprechpartner(?:in)?|Kolleg(?:e|in|en)|im Namen von|im Auftrag von|vertreten durch)"
_NAME_CUED = re.compile(rf"(?<![\w]){_CUE}[\s:]+(?:{_POLITE}\s+)?(?:{_TITLE}\s*)*({_TWO})(?!\w)")
_NAME_ONE = re.compile(rf"(?<![\w-])(?:{_POLITE}\s+(?:{_TITLE}\s*)*|(?:{_TITLE}\s*)+)({_TWO}|{_LAST}|{_UPPER})(?!\w)")
_NAME_LOWER = re.compile(rf"(?<![\w]){_CUE}[\s:]+({_LOWER}\s{_LOWER})(?=\s+(?:gilt|von|hat|sagt|ist|[A-ZÄÖÜ§(])|\s*[.,;\n]|\s*$)")
_NAME_MAILBOX = re.compile(rf"^\s*\"?(?:{_POLITE}\s+)?(?:{_TITLE}\s*)*({_TWO}|{_LAST}|{_LOWER}\s{_LOWER})\"?\s*<")
# Common first names, which make a name of the capitalised word behind them without any cue.
_FIRST = "Achim|Alexander|Andrea|Andreas|Angelika|Anja|Anke|Anna|Anne|Annette|Anton|Antje|Astrid|Barbara|Beate|Benjamin|Bernd|Bettina|Birgit|Björn|Brigitte|Carla|Carsten|Charlotte|Christa|Christian|Christiane|Christina|Christine|Christoph|Claudia|Clara|Cornelia|Daniel|Daniela|David|Dennis|Dieter|Dirk|Doris|Elena|Elisabeth|Elke|Emil|Emma|Erika|Erik|Eva|Felix|Florian|Frank|Franziska|Friedrich|Gabriele|Georg|Gerd|Gerhard|Gisela|Günter|Hannah|Hans|Heike|Heinrich|Heinz|Helga|Helmut|Herbert|Horst|Ines|Ingrid|Jan|Jana|Jens|Johanna|Johannes|Jonas|Jörg|Jürgen|Julia|Julian|Jutta|Karin|Karl|Katharina|Kathrin|Katja|Kerstin|Klaus|Kristina|Lars|Laura|Lea|Lena|Leon|Lina|Lisa|Lukas|Manfred|Manuela|Marc|Maria|Marie|Marion|Markus|Martin|Martina|Matthias|Max|Maximilian|Melanie|Michael|Michaela|Monika|Moritz|Nadine|Nicole|Niklas|Nina|Olaf|Oliver|Patrick|Paul|Paula|Peter|Petra|Philipp|Rainer|Ralf|Regina|Renate|Robert|Rolf|Sabine|Sabrina|Sandra|Sarah|Sebastian|Silke|Simon|Sophie|Stefan|Stefanie|Susanne|Sven|Tanja|Thomas|Thorsten|Tim|Tobias|Tom|Ulrich|Ulrike|Ursula|Ute|Uwe|Vera|Volker|Walter|Werner|Wolfgang|Yvonne"
_FIRST_NAMES = frozenset(_FIRST.split("|"))
_NAME_FIRST = re.compile(rf"(?<![\w-])((?:{_FIRST})(?:[-\s](?:{_FIRST}))?\s(?:(?:von|zu|van|de)\s)?{_LAST})(?![\w-])(?!\s(?:Stiftung|Institut|Schule|Gymnasium|Haus|Preis|Gesellschaft|Verein|Platz|Straße|Allee|Weg|Ring|Ufer|Park|Halle)\b)")
# Small words and kinds of things that are no names.
_NO_LOWER = frozenset("der die das dem den des ein eine einem einen einer eines mein meine meinem meiner dein sein seine ihr ihre ihrem unser unsere und oder nicht nach vor mit bei auf aus von zum zur im in an am als auch es er sie wir ich man so bitte diese dieser dieses diesem allen aller alle anliegend beigefügt".split())
_NO_NAME = re.compile(r"(?:gesetz|verordnung|satzung|ordnung|absatz|paragraph|nummer|blatt|seite|amt|ministerium|behörde|stelle|gemeinde|stiftung|verband|verein|auskunft|bescheid|anlage|tabelle|ung|keit|heit|schaft|recht|kreis|stadt|land|gericht)$", re.IGNORECASE)
_STARTERS = frozenset("Der Die Das Den Dem Im In An Am Bei Bitte Mit Mir Mein Meine Ich Es Er Sie Wir Zur Zum Zuständig Laut Tel Mobil Post Rückfragen Rufen Erreichbar Vergleichen Betrag Seite Vorgang Gemeint Aktenzeichen Anschrift Angegeben Auf Für Gegen Über Unter Nach Vor Zu Seit Aus Von Wenn Dass Das Leider Danke Vielen Beste Hier Dort Also Auch Wegen Außerdem".split())


# What a text must hold for the longer forms to be looked for at all.
_DIGIT, _LONG_NUMBER, _POSTCODE = re.compile(r"\d"), re.compile(r"\d{2,5}[ /]?\d{3}"), re.compile(r"\d{5}\s")
_WRITTEN_AT, _CARD_FORM, _PHONE_START = re.compile(r"[\[({<]\s?(?:at|ät|AT)\s?[\])}>]|\s(?:at|ät|AT)\s"), re.compile(r"[A-Z][A-Z0-9]{8}"), re.compile(r"\+[1-9]|0\d")
_STREET_PARTS = ("stra", "str.", "gasse", "allee", "weg", "platz", "damm", "ufer", "chaussee", "steig", "steg", "stieg", "pfad", "ring", "kanal", "promenade", "twiete")
_CUE_PARTS = ("name ist", "ich heiße", "ich bin", "kontakt", "mir hat", "laut", "auskunft von", "angaben von", "name:", "gez.", "i.", "grüß", "gruß", "hochachtungsvoll", "sachbearbeiter", "ansprechpartner", "kolleg", "im namen von", "im auftrag von", "vertreten durch")
_TITLE_PARTS = ("herr", "frau", "dr.", "prof.", "mag.", "dipl.")


def _holds(text: str, parts: tuple[str, ...]) -> bool:
    for p in parts:
        if p in text:
            return True
    return False


def _card_ok(s: str) -> bool:
    return any(c.isdigit() for c in s) and s == s.upper()


def _name_span(m: re.Match, pattern: re.Pattern) -> tuple[int, int] | None:
    """Where the name of a match lies, or None if its words are none."""
    a, b = m.span(1)
    words = re.split(r"[\s,]+", m.group(1))
    if pattern is _NAME_LOWER:
        return None if any(w in _NO_LOWER for w in words) else (a, b)
    if len(words) > 1 and words[-1] in _STARTERS:  # the next sentence began
        if pattern is not _NAME_ONE:
            return None
        words, b = words[:1], a + len(words[0])
    if words[0] in _STARTERS or any(_NO_NAME.search(w) for w in words):
        return None
    return a, b


def find_items(text: str) -> list[tuple[str, int, int]]:
    """(type, start, end) of the items of a text in order, without overlaps; the start is where the value itself begins."""
    taken: list[tuple[int, int]] = [m.span() for m in _URL.finditer(text)] if "://" in text or "www." in text else []
    out: list[tuple[str, int, int]] = []

    def take(kind: str, a: int, b: int) -> None:
        if not any(a < y and x < b for x, y in taken):
            taken.append((a, b))
            out.append((kind, a, b))

    low = text.lower()
    if "@" in text or _WRITTEN_AT.search(text):
        for m in _EMAIL.finditer(text):
            a = m.start()
            if m.group().lower().startswith("mailto"):
                a += len("mailto")
            take("EMAIL", a, m.end())
    if _DIGIT.search(text):
        for m in _IBAN.finditer(text):
            raw = re.sub(r"[ -]", "", m.group(1))
            if iban_valid(raw) or (raw.startswith("DE") and len(raw) == 22) or text[: m.start()].rstrip(": ").upper().endswith("IBAN"):
                take("IDNUM", *m.span(1))
        for m in _PENSION.finditer(text):
            take("IDNUM", *m.span(1))
        long_number = _LONG_NUMBER.search(text)
        if long_number:
            for pattern in (_TAX_WORD, _TAX_OFFICE):
                for m in pattern.finditer(text):
                    take("IDNUM", *m.span(1))
        if _CARD_FORM.search(text):
            for m in _CARD.finditer(text):
                if _card_ok(m.group(1)):
                    take("IDNUM", *m.span(1))
        if _PHONE_START.search(text):
            for m in _PHONE.finditer(text):
                n = sum(c.isdigit() for c in m.group())
                if 9 <= n <= 16 and not _NO_PHONE.search(text[max(0, m.start() - 24) : m.start()]):
                    take("PHONE", m.start(), m.end())
        if long_number:
            for m in _TAX.finditer(text):
                raw = m.group(1).replace(" ", "")
                if tax_check(raw[:10]) == raw[10] and not _NO_PHONE.search(text[max(0, m.start() - 24) : m.start()]):
                    take("IDNUM", *m.span(1))
        for m in _ANNOUNCED.finditer(text):
            take("ADDRESS", *m.span(1))
        if _POSTCODE.search(text):
            for m in _WITH_TOWN.finditer(text):
                take("ADDRESS", *m.span(1))
        if _holds(low, _STREET_PARTS):
            for m in _BARE.finditer(text):
                take("ADDRESS", *m.span(1))
    for m in _NAME_MAILBOX.finditer(text) if "<" in text else ():
        take("NAME", *m.span(1))
    known = not _FIRST_NAMES.isdisjoint(text.replace("-", " ").split())
    cued, titled = _holds(low, _CUE_PARTS), _holds(low, _TITLE_PARTS)
    for pattern in (*([_NAME_CUED] if cued else []), *([_NAME_ONE] if titled else []), *([_NAME_LOWER] if cued else []), *([_NAME_FIRST] if known else [])):
        at = 0
        while m := pattern.search(text, at):
            span = _name_span(m, pattern)
            at = span[1] if span else m.start(1) + 1
            if span:
                take("NAME", *span)
    return sorted(out, key=lambda x: x[1])


# --- pseudonyms -------------------------------------------------------------


#: Country code of telephone numbers that name none.
HOME = "49"


def _phone_digits(s: str) -> str:
    """Country code and number, digits only."""
    digits = "".join(c for c in s if c.isdigit())
    if s.lstrip(" (").startswith("+") or digits.startswith("00"):
        digits = "".join(c for c in s.replace("(0)", "") if c.isdigit()).removeprefix("00")
    elif digits.startswith("0"):
        digits = HOME + digits[1:]
    return HOME + digits[len(HOME) + 1 :] if digits.startswith(HOME + "0") else digits


def _phone(f: Feistel, value: str) -> str:
    """Behind the country's first two digits the number is permuted."""
    return value[:3] + f.digits(value[3:])


_DAYS = (datetime.date(1999, 12, 31) - datetime.date(1900, 1, 1)).days + 1


def _idnum(f: Feistel, raw: str) -> str:
    if re.fullmatch(r"[A-Z]{2}\d{2}[A-Z0-9]{11,30}", raw):
        bban = f.signs(raw[4:])
        return raw[:2] + iban_check(raw[:2], bban) + bban
    if re.fullmatch(r"\d{8}[A-Z]\d{3}", raw):
        try:
            day = datetime.date(1900 + int(raw[6:8]), int(raw[4:6]), int(raw[2:4]))
            born = datetime.date(1900, 1, 1) + datetime.timedelta(f.permute((day - datetime.date(1900, 1, 1)).days, _DAYS))
            date = born.strftime("%d%m%y")
        except ValueError:
            date = raw[2:8]
        rest = f.signs(raw[:2] + raw[8:11])
        first = rest[:2] + date + rest[2:]
        return first + pension_check(first)
    if re.fullmatch(r"\d{11}", raw):
        ten = f.digits(raw[:10])
        while ten[0] == "0" and raw[0] != "0":
            ten = f.digits(ten)
        return ten + tax_check(ten)
    return f.signs(raw)


_WRITTEN = (re.compile(r"\s*[\[({<]\s*(?:at|ät)\s*[\])}>]\s*|\s+(?:at|ät)\s+|\s*@\s*", re.IGNORECASE), re.compile(r"\s*[\[({<]\s*(?:punkt|dot)\s*[\])}>]\s*|\s+(?:punkt|dot)\s+", re.IGNORECASE))


def canonical(kind: str, value: str) -> str:
    """The value without the differences of writing that do not matter for linking."""
    if kind == "PHONE":
        return "+" + _phone_digits(value)
    if kind == "IDNUM":
        return re.sub(r"[\s/.-]", "", value).upper()
    if kind == "EMAIL":
        return _WRITTEN[1].sub(".", _WRITTEN[0].sub("@", value)).lower()
    v = " ".join(re.sub(r"[\s,]+" if kind == "ADDRESS" else r"\s+", " ", value).casefold().split())
    if kind == "NAME":
        m = re.fullmatch(r"([^,]+), (.+)", v)
        return f"{m[2]} {m[1]}" if m else v
    v = re.sub(r" d[- ](?=\d{5} )", " ", re.sub(r"str(?:asse\b|\.|\b)", "strasse", v))
    return re.sub(r"(\d) ([a-z])(?= \d{5} |$)", r"\1\2", v)


def replaced(f: Feistel, kind: str, value: str) -> tuple[str, str]:
    """(pseudonym, link tag) of a value; for what is no number they are the same keyed tag."""
    v = canonical(kind, value)
    tag = f.tag(kind, v)
    return (_phone(f, v) if kind == "PHONE" else _idnum(f, v) if kind == "IDNUM" else tag), tag


def pseudonym(f: Feistel, kind: str, value: str) -> str:
    return replaced(f, kind, value)[0]


def link_tag(f: Feistel, kind: str, value: str) -> str:
    """A keyed tag, equal for equal values."""
    return replaced(f, kind, value)[1]


def redact_text(text: str, f: Feistel) -> tuple[str, list[tuple[str, int, int, str, str]]]:
    """The text with placeholders, and (type, start 1 …, length, placeholder, link tag) of each item."""
    out, items, last = [], [], 0
    for kind, a, b in find_items(text):
        shown, link = replaced(f, kind, text[a:b])
        placeholder = f"[{kind}:{shown}]"
        out += [text[last:a], placeholder]
        items.append((kind, a + 1, b - a, placeholder, link))
        last = b
    return "".join([*out, text[last:]]), items


_ITEM = T.StructType([T.StructField("pii_type", T.StringType()), T.StructField("start_pos", T.IntegerType()), T.StructField("length", T.IntegerType()), T.StructField("placeholder", T.StringType()), T.StructField("link", T.StringType())])
_REDACTED = T.StructType([T.StructField("text", T.StringType()), T.StructField("items", T.ArrayType(_ITEM))])


def redact(df: DataFrame, text: str, key: bytes, out: str = "redacted") -> DataFrame:
    """Adds ``out``: struct<text, items array<struct<pii_type, start_pos, length, placeholder, link>>> for the string column ``text``.

    Null gives null, an empty text no items. An existing column ``out`` is
    replaced, other columns stay. Whole texts are read, of any length.
    """

    @F.pandas_udf(_REDACTED)
    def of(s: pd.Series) -> pd.DataFrame:
        f = Feistel(key)
        codes, values = pd.factorize(s, use_na_sentinel=True)
        done = [redact_text(v, f) for v in values]
        frame = pd.DataFrame({"text": [d[0] for d in done] + [None], "items": [d[1] for d in done] + [None]}, dtype=object)
        return frame.iloc[codes].reset_index(drop=True)

    return df.withColumn(out, of(F.col(text)))
