import datetime
import random
import re

import pytest

from strataq.llm import personal_data as pd_

F1, F2 = pd_.Feistel(b"one"), pd_.Feistel(b"two")


@pytest.mark.parametrize("size", [1, 2, 10, 97, 26**2, 10**6 + 3, 10**11])
def test_permutation_round_trip(size):
    r = random.Random(size)
    values = range(size) if size <= 1000 else [r.randrange(size) for _ in range(50)]
    out = [F1.permute(x, size) for x in values]
    assert all(0 <= y < size for y in out) and [F1.invert(y, size) for y in out] == list(values)
    if 90 < size <= 1000:
        assert sorted(out) == list(range(size)) and out != [F2.permute(x, size) for x in values]


def test_formats_and_check_digits():
    iban = "DE" + pd_.iban_check("DE", "370400440532013000") + "370400440532013000"
    assert pd_.iban_valid(iban)
    p = pd_.pseudonym(F1, "IDNUM", iban)
    assert pd_.iban_valid(p) and p != iban
    spaced = " ".join(iban[i : i + 4] for i in range(0, 22, 4))
    assert pd_.pseudonym(F1, "IDNUM", spaced) == pd_.pseudonym(F1, "IDNUM", iban.lower()) == p
    tax = "1234567890" + pd_.tax_check("1234567890")
    t = pd_.pseudonym(F1, "IDNUM", f"{tax[:2]} {tax[2:5]} {tax[5:8]} {tax[8:]}")
    assert re.fullmatch(r"\d{11}", t) and pd_.tax_check(t[:10]) == t[10] and t[0] != "0"
    n = pd_.pseudonym(F1, "IDNUM", "88 200288 S 831")
    raw = n.replace(" ", "")
    assert datetime.date(1900 + int(raw[6:8]), int(raw[4:6]), int(raw[2:4])) and pd_.pension_check(raw[:11]) == raw[11]
    assert re.fullmatch(r"[A-Z]{4}\d[A-Z]\d\d[A-Z]", pd_.pseudonym(F1, "IDNUM", "ZCRV1F22L"))


def test_numbers_stay_linked_across_writings():
    ways = ["069 90009411", "069/90009411", "(069) 90009 411", "+49 69 90009411", "+49 (0)69 90009 411", "00496990009411", "0049 69 90009411", "+49 069 90009411", "069.90009.411"]
    assert len({pd_.pseudonym(F1, "PHONE", w) for w in ways}) == len({pd_.link_tag(F1, "PHONE", w) for w in ways}) == 1
    one = pd_.pseudonym(F1, "PHONE", ways[0])
    assert one.startswith("+49") and len(one) == len("+496990009411") and one != pd_.pseudonym(F1, "PHONE", "069 90009412")
    assert pd_.pseudonym(F1, "PHONE", "+43 1 5334567").startswith("+43") and pd_.pseudonym(F1, "PHONE", "0043 1 5334567") == pd_.pseudonym(F1, "PHONE", "+43 (0)1 533 45 67")
    for kind, writings in {
        "IDNUM": ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "de89-3704-0044-0532-0130-00"],
        "ADDRESS": ["Lohnerstr. 20a", "Lohnerstraße 20 a", "LOHNERSTRASSE 20a"],
        "NAME": ["Ulf  Borwieser", "Borwieser, Ulf", "ULF BORWIESER"],
    }.items():
        assert len({pd_.pseudonym(F1, kind, w) for w in writings}) == len({pd_.link_tag(F1, kind, w) for w in writings}) == 1
    assert pd_.canonical("ADDRESS", "Quellgasse 89\nD-15035 Lunderstedt") == pd_.canonical("ADDRESS", "Quellgasse 89, 15035 Lunderstedt")
    assert pd_.pseudonym(F1, "EMAIL", "a.b@c.example") == pd_.pseudonym(F1, "EMAIL", "A.B [at] c [punkt] EXAMPLE")
    assert pd_.pseudonym(F1, "NAME", "Ulf Borwieser") == pd_.pseudonym(F1, "NAME", "Borwieser, Ulf") != pd_.pseudonym(F2, "NAME", "Ulf Borwieser")


CASES = [
    ("Erreichbar unter a_b@mail.deich.example, danke.", [("EMAIL", "a_b@mail.deich.example")]),
    ("(k64 [at] verein [punkt] siel [punkt] invalid) x", [("EMAIL", "k64 [at] verein [punkt] siel [punkt] invalid")]),
    ("an r62 @ moorpost.example.", [("EMAIL", "r62 @ moorpost.example")]),
    ("mailto:Post-x@amt.example", [("EMAIL", "Post-x@amt.example")]),
    ("Ulf Borwieser <u@b.example>", [("NAME", "Ulf Borwieser"), ("EMAIL", "u@b.example")]),
    ("Herr Prof. Nottgarten <g@b.example>", [("NAME", "Nottgarten"), ("EMAIL", "g@b.example")]),
    ("Die Adresse west:plan@2024-07-01 lädt nicht.", []),
    ("Tel. (0176) 04069 070, vormittags.", [("PHONE", "(0176) 04069 070")]),
    ("Rufen Sie bitte +49 (0)30 23125 789 an.", [("PHONE", "+49 (0)30 23125 789")]),
    ("Vorgang 04632389 vom Vorjahr. Aktenzeichen 46-8153/5989. Nummer 8.29. Betrag 477 872,36 Euro. Gliederungsnummer 7898-2-85. Blatt 11 vom 21.4.2024, S. 211.", []),
    ("Angegeben war RV-Nr. 88 200288 S 831 als", [("IDNUM", "88 200288 S 831")]),
    ("Zur Zuordnung: IdNr. 63 488 002 171. Rufen", [("IDNUM", "63 488 002 171")]),
    ("Steueridentifikationsnummer: 26134048467.", [("IDNUM", "26134048467")]),
    ("Personalausweis ZCRVVFLL8.", [("IDNUM", "ZCRVVFLL8")]),
    ("meine DE45 9999 9999 5268 9803 37, das", [("IDNUM", "DE45 9999 9999 5268 9803 37")]),
    ("Anschrift: Hinter dem Koog 117 ", [("ADDRESS", "Hinter dem Koog 117")]),
    ("Ich wohne Quellgasse 89\nD-15035 Lunderstedt und", [("ADDRESS", "Quellgasse 89\nD-15035 Lunderstedt")]),
    ("Post bitte an Lohnerstr. 20a. Bei", [("ADDRESS", "Lohnerstr. 20a")]),
    ("Ich wohne Am Kolk 28 b, D-80500 Stolzkoog und", [("ADDRESS", "Am Kolk 28 b, D-80500 Stolzkoog")]),
    ("Im Blatt 42 Seite 82 steht es. In § 66 Absatz 85 fehlt ein Satz.", []),
    ("Mein Name ist TILDA BIRTE WULFDAHL.", [("NAME", "TILDA BIRTE WULFDAHL")]),
    ("Mir hat Frau Dr. Kettenrügge von", [("NAME", "Kettenrügge")]),
    ("Laut Dr. T. Ehrhagener gilt", [("NAME", "T. Ehrhagener")]),
    ("Laut Lüttlander, Silke gilt", [("NAME", "Lüttlander, Silke")]),
    ("Mein Name ist liv borlander.", [("NAME", "liv borlander")]),
    ("Mit freundlichen Grüßen\nFrau Grauhorst Laut Tilda Lüttstöver gilt", [("NAME", "Grauhorst"), ("NAME", "Tilda Lüttstöver")]),
    ("Die Merschstöver-Stiftung ist im Register nicht verzeichnet. Zuständig ist das Landesamt für Moore Tolkenrode. Seite https://recht.example/norm/91645 meldet Fehler 582.", []),
    ("Kontakt: Max Mustermann", [("NAME", "Max Mustermann")]),
    ("Ich bin Peter Müller und", [("NAME", "Peter Müller")]),
    ("Gestern sprach Anna Schmidt mit mir.", [("NAME", "Anna Schmidt")]),
    ("Das sagte Karl-Heinz von Tolkenrode.", [("NAME", "Karl-Heinz von Tolkenrode")]),
    ("Die Peter-Müller-Stiftung und die Anna Seghers Schule, auch das Robert Koch Institut.", []),
    ("Laut Satzung Gebührenordnung gilt das nicht. Laut der satzung gilt es.", []),
]


@pytest.mark.parametrize("text, items", CASES)
def test_items(text, items):
    assert [(k, text[a:b]) for k, a, b in pd_.find_items(text)] == items


def test_rest_of_the_text_is_unchanged():
    text = " ".join(t for t, _ in CASES)
    red, items = pd_.redact_text(text, F1)
    at = 0
    for kind, start, length, placeholder, link in items:
        assert placeholder.startswith(f"[{kind}:")
        red = red.replace(placeholder, "\0" + text[start - 1 : start - 1 + length], 1)
    assert red.replace("\0", "") == text and at == 0


def test_column(spark):
    data = [("x", "Tel. 069 90009411", 1), ("x", None, 2), ("x", "", 3), ("x", "wort " * 100_000 + "a@b.example", 4), ("x", "Tel. 069 90009411", 5)]
    got = {r["i"]: r["redacted"] for r in pd_.redact(spark.createDataFrame(data, "redacted string, t string, i int"), "t", b"k").collect()}
    assert got[1] == got[5] and got[1]["items"][0]["start_pos"] == 6
    assert got[2]["text"] is None and got[3]["text"] == "" and not got[3]["items"]
    assert got[4]["items"][0]["pii_type"] == "EMAIL"
    assert pd_.redact(spark.createDataFrame([], "t string"), "t", b"k").count() == 0
