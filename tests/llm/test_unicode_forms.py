import unicodedata

from strataq.llm import unicode_forms as uf


def test_kinds_and_forms():
    cases = {
        "ｗｅｇ": ("weg", ["width"]), "ﬁnden": ("finden", ["ligature"]), "über": ("über", ["mark"]), "Sied­loh": ("Siedloh", ["invisible"]), "a​﻿b": ("ab", ["invisible"]),
        "a b　c": ("a b c", ["space"]), "Еuro": ("Euro", ["mixed"]), "Ѕtаtіstіk": ("Statistik", ["mixed"]), "Εlνerrode": ("Elverrode", ["mixed"]),
        "ｕ̈ｂｅｒ­": ("über", ["width", "mark", "invisible"]), "Дoговор": ("Договор", ["mixed"]),
    }
    for stored, (form, kinds) in cases.items():
        assert uf.unify_text(stored) == (form, kinds), stored


def test_no_cases_stay():
    for text in ("", "Straße", "40 m²", "½ … „Договор о дамбах“ – 12 €", "Νόμος περί υδάτων", "5 µg", "Winkel α", "Lov om åbne diger", "Café", "a\tb\nc"):
        assert uf.unify_text(text) == (text, [])


def test_key_compares():
    assert uf.compare_key("STRASSE") == uf.compare_key("Straße")
    assert uf.compare_key(uf.unify_text("üBER")[0]) == uf.compare_key("Über")


def test_idempotent():
    for c in range(0x20, 0x3000):
        if 0xD800 <= c < 0xE000:
            continue
        t = "a" + chr(c) + "b"
        once = uf.unify_text(t)[0]
        assert uf.unify_text(once)[0] == once
        assert unicodedata.normalize("NFC", once) == once


def test_column(spark):
    data = [("x", "ﬁn", 1), ("x", None, 2), ("x", "", 3), ("x", "a " * 200_000, 4), ("x", "ﬁn", 5), ("x", "plain", 6)]
    got = {r["i"]: r["form"] for r in uf.unify(spark.createDataFrame(data, "form string, text string, i int"), "text").collect()}
    assert got[1] == got[5] and got[1]["text"] == "fin" and got[1]["findings"] == ["ligature"]
    assert got[2]["text"] is None and got[3]["text"] == "" and got[3]["findings"] == [] and got[6]["form_key"] == "plain"
    assert got[4]["text"] == "a " * 200_000
    assert uf.unify(spark.createDataFrame([], "text string"), "text").count() == 0


def test_json_prefilter_is_a_superset():
    for raw in ('{"text":"ﬁ"}', '{"text":"\\ufb01"}', '{"text":"\\u00ad"}', '{"text":"\\u00A0"}', '{"text":"u\\u0308"}', '{"text":"\\u0435"}'):
        assert uf.json_suspect(raw)
    assert not uf.json_suspect('{"text":"\\u00fcber Straße"}')
