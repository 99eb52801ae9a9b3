import pytest

from strataq.llm import page_shapes as ps

PROSE = "Die Behörde führt ein Verzeichnis der Forstfläche, das binnen eines Monats fortzuschreiben ist. Unberührt bleiben Vorschriften über die Milchsatzung sowie die Bauplanung. "
SPAM = {
    "repeated": "Wahlgenehmigung " * 12 + "Fischereistelle Netzmeldung " * 6,
    "pseudo sentences": "Termin schnell antrag urteil. Gebühr urteil vergleich hilfe download. " * 6,
    "hash tags": "#deich #vorlage #formular2026 #sofort " * 8,
    "breadcrumbs": "Grönfeld › Kaufen › Vorlage\nVördtal › Anwalt › Testsieger\n" * 6,
    "tags": "Tags: Antrag online | Hilfe formular | Billig download /\n" * 6,
    "links": "Verordnung Nederkoog: https://amt.invalid/rechner/6246\nwww.recht24.example/Brückenaufsicht\n" * 6,
    "markdown": "* [Deich Merschhausen](https://recht-shop.invalid/157)\n" * 8,
    "anchors": '<a href="http://norm.example/x">rechner genehmigung</a><br> ' * 8,
    "products": "Anwalt-Urteil Art.-Nr. 39596 ★★★★☆ Deich hafen 52,99 EUR\n" * 6,
    "commas": "kaufen, online, kaufen, kostenlos, kostenlos genehmigung, " * 8,
    "english": "best expert legal harbour review instant " * 8,
}
GOOD = {
    "prose": PROSE * 3,
    "contents": "Inhaltsübersicht der Bodenerlaubnis\n" + "\n".join(f"§ {i} Denkmalgenehmigung und Hafenkartei" for i in range(1, 40)),
    "fees": "Gebührenverzeichnis zur Bodennutzung\n" + "\n".join(f"{i}.1 laufende Kurortbehörde {i},36 Euro" for i in range(1, 40)),
    "further links": PROSE + "\n\nWeitere Seiten:\n" + "- Feldsatzung: https://recht-nsh.example/norm/3105\n" * 9,
    "keywords": PROSE + "\n\nSchlagwörter: Markterlaubnis, Feuerwehrstatistik, Gaststättenbeihilfe, Gewerbestatistik",
    "stub": "Siehe Anlage.",
    "empty": "",
    "blank": " \n\n",
}


#: The same matter in the prose of eleven languages.
PROSES = {
    "Polish": "Rada gminy uchwaliła nowy plan zagospodarowania przestrzennego dla obszaru położonego nad rzeką. Mieszkańcy mogą zgłaszać uwagi do końca miesiąca, a burmistrz odpowie na nie pisemnie. Projekt przewiduje budowę drogi rowerowej oraz parku, w którym staną ławki i place zabaw.",
    "Turkish": "Belediye meclisi yeni imar planını oybirliğiyle kabul etti. Vatandaşlar itirazlarını ay sonuna kadar yazılı olarak iletebilir ve başkan bunlara yanıt verir. Proje kapsamında bisiklet yolu ile büyük bir park yapılacak, parkta oyun alanları bulunacak.",
    "French": "Le conseil municipal a adopté le nouveau plan d'aménagement pour la zone située au bord de la rivière. Les habitants peuvent présenter leurs observations jusqu'à la fin du mois, et le maire y répondra par écrit.",
    "Finnish": "Kunnanvaltuusto hyväksyi uuden asemakaavan joen rannalla sijaitsevalle alueelle. Asukkaat voivat esittää huomautuksensa kuukauden loppuun mennessä, ja kunnanjohtaja vastaa niihin kirjallisesti. Kustannukset katetaan kaupungin talousarviosta.",
    "Spanish": "El pleno municipal aprobó el nuevo plan urbanístico para la zona situada junto al río. Los vecinos pueden presentar alegaciones hasta fin de mes y el alcalde responderá por escrito.",
    "Russian": "Городской совет утвердил новый план застройки территории у реки. Жители могут подать замечания до конца месяца, и мэр ответит на них письменно. Расходы покроет городской бюджет.",
    "Greek": "Το δημοτικό συμβούλιο ενέκρινε το νέο πολεοδομικό σχέδιο για την περιοχή δίπλα στο ποτάμι. Οι κάτοικοι μπορούν να υποβάλουν παρατηρήσεις έως το τέλος του μήνα και ο δήμαρχος θα απαντήσει γραπτώς.",
    "Hungarian": "A képviselő-testület elfogadta a folyóparti terület új rendezési tervét. A lakosok a hónap végéig tehetnek észrevételeket, amelyekre a polgármester írásban válaszol.",
    "Japanese": "市議会は川沿いの地域の新しい都市計画を承認した。住民は月末まで意見を提出でき、市長は書面で回答する。計画には自転車道と公園の整備が含まれている。",
    "Arabic": "وافق مجلس المدينة على المخطط الجديد للمنطقة الواقعة بجانب النهر. يمكن للسكان تقديم ملاحظاتهم حتى نهاية الشهر، وسيرد رئيس البلدية عليها كتابيا.",
    "Czech": "Zastupitelstvo obce schválilo nový územní plán pro oblast u řeky. Obyvatelé mohou podat připomínky do konce měsíce a starosta na ně písemně odpoví.",
}
FOREIGN_SPAM = {"Polish": "tanie kredyty online Warszawa tanie pożyczki online Kraków kredyty Gdańsk " * 6, "French": "devis gratuit pas cher avocat devis rapide avocat Lyon devis gratuit avocat Paris " * 6, "Turkish": "Ucuz kredi hemen başvur. Kredi ucuz başvur hesapla. Hemen hesapla kredi ucuz. " * 5, "seven tags": "Tags: Hafen | Deich | Wald | Moor | Amt | Siel"}


@pytest.mark.parametrize("language", PROSES)
def test_prose_of_no_known_language_is_ordinary(language):
    assert ps.stuffed_share(PROSES[language]) < 0.1
    assert ps.stuffed_share("\n".join(PROSES.values())) < 0.1 and ps.stuffed_share(PROSES[language].upper()) < 0.2


@pytest.mark.parametrize("kind", FOREIGN_SPAM)
def test_keywords_of_no_known_language_are_found(kind):
    assert ps.stuffed_share(FOREIGN_SPAM[kind]) >= 0.9


def test_many_shapes_of_lists_are_found():
    """Lines of forty different lengths and separators."""
    page = "\n".join(f"{'|/›»#'[i % 5]} ".join(f"wort{i}{j}" for j in range(3 + i % 8)) + " |" for i in range(40))
    assert ps.stuffed_share(page) >= 0.5


@pytest.mark.parametrize("kind", SPAM)
def test_stuffed(kind):
    assert ps.stuffed_share(SPAM[kind]) >= 0.9
    assert ps.stuffed_share(SPAM[kind] + "\n" + PROSE[:90]) >= 0.5
    assert ps.stuffed_share(PROSE * 12 + "\n" + SPAM[kind]) < 0.5


@pytest.mark.parametrize("kind", GOOD)
def test_ordinary(kind):
    assert ps.stuffed_share(GOOD[kind]) < 0.2


def test_words_add_up():
    for text in [*SPAM.values(), *GOOD.values()]:
        total, sentence, ordinary, shapes, in_lists = ps.page_profile(text)
        assert total == sentence + ordinary + in_lists == len(ps._WORD.findall(text)) and sum(n for _, n in shapes) <= in_lists


def test_table(spark, rows):
    data = [(1, SPAM["tags"], 0.1), (1, SPAM["tags"], 0.1), (2, PROSE, 0.1), (3, None, 0.1), (4, "", 0.1), (None, SPAM["tags"], 0.1), (5, SPAM["links"] * 3000, 0.1)]
    df = spark.createDataFrame(data, "doc_id long, text string, share double")
    assert rows(ps.stuffed_pages(df)) == [(1,), (5,)]
    assert ps.profile_pages(df).count() == 6 and ps.stuffed_pages(df.limit(0)).count() == 0
