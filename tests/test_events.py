"""The reports of each family over a small event, with expected values by hand."""

import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from rollcall.plans import camp_h, camp_l, camp_t, day_j
from rollcall.plans.event import (
    Landing, build_reports, clean_table, current_report, read_inputs, run_event, state_of,
)
from rollcall.plans.spec import EventConfig, ReportSpec, lint
from rollcall.session import configure, scratch_root
from rollcall.sinks.runs import runs
from rollcall.sources.landings import known_pages, look
from tests.landing import DEFAULT_CHOICES, event_of, order, write_json

CONFIG = EventConfig()


def reports(spark, module, root, config=CONFIG):
    configure(spark, case_sensitive=True)
    inputs = read_inputs(spark, module.FAMILY, Landing(root), look(spark, Landing(root), f"{root}/out"))
    clean = clean_table(module.FAMILY, inputs.raw, inputs.known, config)
    built = build_reports(module.FAMILY, clean, inputs.choices)
    return {"clean": clean} | {name: df for name, (_, df) in built.items()}


def table(df, *columns, by="Nr"):
    return [tuple(r[c] for c in columns) for r in df.orderBy(by).collect()]


@pytest.fixture
def camp_h_event(folder):
    e = event_of(camp_h, DEFAULT_CHOICES[camp_h])
    place, food, guardian = "Zu-/Ausstieg", list(camp_h.RENAMES)[-1], list(camp_h.RENAMES)[15]
    flag, subsidy = "Mein Kind ernährt sich vegetarisch.", "Zuschussantrag"
    orders = [
        order("B1", [
            e.ticket(1, "Udo", "Zorn", {place: "Süd", flag: "True", subsidy: "False", "Ortsteil": " Dorf "}),
            e.ticket(2, "Eva", "Bach", {place: "Süd", food: " Nüsse", guardian: "+49 1", subsidy: "True"},
                     street=None, zipcode="", city=" ", country=None),
        ], status="n", when="2025-03-30T01:00:00+00:00"),
        order("A1", [e.ticket(3, "Eva", "Bach", {place: "Nord", food: " ", guardian: "G", flag: "False"})],
              status="p", when="2025-07-01T10:00:00Z"),
        order("C1", [e.ticket(4, "X", "Weg", {place: "Süd"})], status="c"),
        order("D1", [e.ticket(5, "adler", "adler", {place: "West "})], status="e"),
        order("E1", [e.ticket(6, " ", None)], status=None, when="2024-01-01T00:00:00Z"),
    ]
    return e.land(folder, orders)


def test_family_h(spark, camp_h_event):
    got = reports(spark, camp_h, camp_h_event)
    clean = got["clean"]
    assert clean.columns[4:] == list(camp_h.CLEAN)
    assert table(clean, "Nr", "Bestellstatus", "Anmeldedatum")[:3] == [
        (0, "unbezahlt", "2025-03-30 03:00"), (1, "unbezahlt", "2025-03-30 03:00"),
        (2, "bezahlt", "2025-07-01 12:00"),
    ]
    assert table(clean, "Adresse")[:3] == [
        ("Weg 1, 70000 Stadt (Dorf), DE",), (", ,",), ("Weg 1, 70000 Stadt, DE",),
    ]
    assert table(clean, "Vegetarier", "Zuschussantrag")[:3] == [("Ja", "Nein"), (None, "Ja"), ("Nein", None)]
    # Names as stripped; cancelled ones out; an unknown status stays; nulls last.
    assert table(got["Teilnehmerdaten"], "Nr", "Nachname", "Bestellnummer") == [
        (1, "Bach", "B1"), (2, "Bach", "A1"), (3, "Zorn", "B1"), (4, "adler", "D1"), (5, None, "E1"),
    ]
    # Lists are made from all tickets, cancelled ones included.
    lists = {(r["Zu-/Ausstieg"], r["Nr"]): r["Nachname"] for r in got["Nach_Orten"].collect()}
    assert lists == {
        ("Süd", 1): "Bach", ("Süd", 2): "Weg", ("Süd", 3): "Zorn", ("Nord", 1): "Bach",
        ("West", 1): "adler", (None, 1): None,
    }
    assert table(got["Anmeldezahlen"], "Zu-/Ausstieg", "Anmeldungen") == [
        ("GESAMT", 6), ("Leer", 0), ("Nord", 1), ("Süd", 3),
    ]
    assert table(got["Bestellungen"], "Nr", *camp_h.ORDERS) == [
        (1, "B1", "unbezahlt", "B1@example.org", "10.00", "2025-03-30 03:00", "Ja"),
        (2, "A1", "bezahlt", "A1@example.org", "10.00", "2025-07-01 12:00", "Nein"),
        (3, "C1", "storniert", "C1@example.org", "10.00", "2025-01-05 10:00", "Nein"),
        (4, "E1", None, "E1@example.org", "10.00", "2024-01-01 01:00", "Nein"),
        (5, "D1", "e", "D1@example.org", "10.00", "2025-01-05 10:00", "Nein"),
    ]
    assert got["Notfallkontakte"].columns == ["Nr", *camp_h.CONTACTS]
    assert got["Sani"].columns == ["Nr", *[c for c in camp_h.MEDICAL if c != "Ortsteil"]]
    diet = table(got["Küche"], "Nr", "Lebensmittelunverträglichkeiten", "E-Mail", "Sorgeberechtigter")
    assert diet[:3] == [(1, "Nüsse", "B1@example.org", "+49 1"), (2, None, None, None), (3, None, None, None)]


def town_event(module, folder, extra):
    e = event_of(module, DEFAULT_CHOICES[module])
    own, asked, third = module.PLACE_QUESTIONS
    food = "Welche Unverträglichkeiten?" if module is camp_l else "Essensunverträglichkeiten"
    paid = "Zuschuss beantragen"
    items = [{"id": 1, "name": {"de": "Ticket"}}, {"id": 2, "name": {"de": camp_l.DONATION}}]
    orders = [
        order("B1", [
            e.ticket(1, "Udo", "Zorn", {own: "Aalen", paid: "Nein", "Sonstiges": "geheim", **extra}),
            e.ticket(2, "Eva", "Bach", {own: "Sonstige", asked: camp_l.NO_PLACE, paid: "Ja", food: "Nüsse",
                                        "Notfall-Telefonnummern": "0711"}),
            e.ticket(3, None, None, {}, item=2),
        ], status="n", when="2025-01-05T10:00:00Z"),
        order("A1", [e.ticket(4, "Eva", "Bach", {own: "", asked: "", third: "Bonn",
                                                 "Einverständniserklärung": "file://x",
                                                 "Krankenversicherung": "Privat krankenversichert"})],
              status="p", invoice_address=None),
        order("C1", [e.ticket(5, "X", "Weg", {own: "Aalen"}), e.ticket(6, None, None, {}, item=2)], status="c"),
        order("D1", [e.ticket(7, "I", "Neu", {own: "Neustadt"})], status="p",
              invoice_address={"name": " N ", "company": "C", "street": None, "zipcode": None,
                               "city": None, "country": None}),
    ]
    return e.land(folder, orders, items)


@pytest.mark.parametrize("module", [camp_l, camp_t])
def test_town_families(spark, folder, module):
    extra = {} if module is camp_l else {"Ernährung: Vegetarisch": "True", "Ernährung: Glutenfrei": True}
    got = reports(spark, module, town_event(module, folder, extra))
    clean = got["clean"]
    assert clean.columns[4:] == list(module.CLEAN)
    assert table(clean, "Ort") == [
        ("Aalen",), ("ortsunabhängig",), (None,), ("Bonn",), ("Aalen",), (None,), ("Neustadt",),
    ]
    assert table(clean, "Rechnung - Empfänger", "Rechnung - Adresse")[2:] == [
        ("Name", "Gasse 2, 70001 Dorf, DE"), (None, ",  ,"), ("Name", "Gasse 2, 70001 Dorf, DE"),
        ("Name", "Gasse 2, 70001 Dorf, DE"), ("N (C)", ",  ,"),
    ]
    assert table(clean, "Einverständniserklärung", "Krankenversicherung")[3] == ("hochgeladen", "privat")
    assert table(got["Teilnehmerdaten"], "Nr", "Nachname", "Ort") == [
        (1, "Bach", "ortsunabhängig"), (2, "Bach", "Bonn"), (3, "Neu", "Neustadt"), (4, "Zorn", "Aalen"),
    ]
    lists = {(r["Ort"], r["Nr"]): r["Sonstiges"] for r in got["Nach_Orten"].collect()}
    assert lists == {
        ("ortsunabhängig", 1): None, ("Bonn", 1): None, ("Neustadt", 1): None, ("Aalen", 1): "geheim",
    }
    assert "Sonstiges" not in got["Zum_Teilen"].columns
    assert got["Zum_Teilen"].count() == 4
    assert table(got["Anmeldezahlen"], "Ort", "Anmeldungen") == [
        ("GESAMT", 4), ("Aalen", 1), ("Bonn", 1), ("Leer", 0), ("ortsunabhängig", 1),
    ]
    assert table(got["Bestellungen"], "Nr", "Bestellnummer", "Zuschuss beantragt") == [
        (1, "B1", "Ja"), (2, "A1", "Nein"), (3, "D1", "Nein"), (4, "C1", "Nein"),
    ]
    assert table(got["Spenden"], "Nr", "Bestellnummer", "Bestellstatus") == [
        (1, "B1", "unbezahlt"), (2, "C1", "storniert"),
    ]
    assert got["Notfallkontakte"].columns == ["Nr", *camp_l.CONTACTS]
    assert got["Sani"].columns == ["Nr", *module.MEDICAL]
    diet = table(got["Küche"], "Nachname", "E-Mail", "Notfall-Telefonnummern")
    zorn = ("Zorn", "B1@example.org", None) if module is camp_t else ("Zorn", None, None)
    assert diet == [("Bach", "B1@example.org", "0711"), ("Bach", None, None), ("Neu", None, None), zorn]
    if module is camp_t:
        assert table(clean, "Ernährung", "Glutenfrei")[:2] == [("Vegetarisch, Glutenfrei", "Ja"), (None, None)]


def test_town_choice_must_be_offered(spark, folder):
    e = event_of(camp_l, ["Aalen"])
    root = e.land(folder, [order("A", [e.ticket(1, "a", "b")])])
    with pytest.raises(ValueError, match="not offered"):
        reports(spark, camp_l, root)


def test_required_question(spark, folder):
    e = event_of(camp_l, DEFAULT_CHOICES[camp_l], [q for q in camp_l.QUESTIONS if q != "Sonstiges"])
    root = e.land(folder, [order("A", [e.ticket(1, "a", "b")])])
    with pytest.raises(ValueError, match="Sonstiges"):
        reports(spark, camp_l, root)


def test_optional_question(spark, folder):
    texts = [q for q in camp_l.QUESTIONS if q not in ("Schwimmer", *camp_l.PLACE_QUESTIONS[::2])]
    e = event_of(camp_l, DEFAULT_CHOICES[camp_l], texts)
    root = e.land(folder, [order("A", [e.ticket(1, "a", "b", {camp_l.PLACE_QUESTION: "Bonn"})])])
    got = reports(spark, camp_l, root)
    assert "Schwimmer" not in got["Teilnehmerdaten"].columns
    assert table(got["clean"], "Ort") == [("Bonn",)]


def day_event(folder, tidy_texts=True):
    e = event_of(day_j, DEFAULT_CHOICES[day_j])
    place, food = "Ich melde mich über folgende Ortschaft an", "Welche Unverträglichkeiten?"
    parents, staff = "Ich biete eine Fahrgemeinschaft an", "Ich stelle mich als Fahrer bereit"
    items = [{"id": 1, "name": {"de": "Jungscharler (Kind)"}}, {"id": 2, "name": {"de": "Mitarbeiter"}}]
    given = {food: "Nüsse"} if tidy_texts else {}
    orders = [
        order("A", [
            e.ticket(1, "b", "Z", {place: "Bonn", "Ernährung": "Vegetarisch, Kein Schweinefleisch",
                                   parents: "Ja", staff: "Nein"}),
            e.ticket(2, "a", "Z", {place: "Bonn", staff: "vielleicht", "Telefonnummer": "2", **given}, item=2),
        ]),
        order("B", [e.ticket(3, "a", "Z", {place: "Aalen ", "Ernährung": "Vegetarisch", food: " "}
                             if tidy_texts else {place: "Aalen "})]),
        order("C", [e.ticket(4, "c", "c", {place: "Bonn"})], status="c"),
        order("D", [e.ticket(5, "d", "d", {"Telefonnummer der Eltern": "5"}, item=99)], status=None),
    ]
    return e.land(folder, orders, items)


def test_family_j(spark, folder):
    got = reports(spark, day_j, day_event(folder))
    assert table(got["Alle"], "Nr", "Ortschaft", "Vorname", "Fahrer Angebot", "Telefonnummer") == [
        (1, "Aalen", "a", None, None), (2, "Bonn", "b", "Ja", None), (3, "Bonn", "a", "vielleicht", "2"),
        (4, None, "d", None, "5"),
    ]
    assert table(got["Anmeldezahlen"], "Ortschaft", "Jungscharler", "Mitarbeiter", "Gesamt") == [
        ("GESAMT", 2, 1, 4), ("Aalen", 1, 0, 1), ("Bonn", 1, 1, 2), ("Leer", 0, 0, 0),
    ]
    assert table(got["Küche_Gesamtzahlen"], "Ernährung", "Jungscharler", "Mitarbeiter", "Gesamt") == [
        ("Keine Besonderheiten", 0, 0, 0), ("Kein Schweinefleisch", 1, 0, 1), ("Vegetarisch", 2, 0, 2),
        ("Gesamt", 2, 1, 4),
    ]
    assert table(got["Küche_Unverträglichkeiten"], "Nr", "Vorname") == [(1, "a")]
    lists = sorted((r["Ortschaft"], r["Nr"], r["Vorname"]) for r in got["Nach_Orten"].collect())
    assert lists == [("Aalen", 1, "a"), ("Bonn", 1, "b"), ("Bonn", 2, "a")]


def test_family_j_with_blanks_as_values(spark, folder):
    """Blanks as they come in: places match unstripped, unanswered questions hide others."""
    config = replace(CONFIG, blank_is_null=False)
    got = reports(spark, day_j, day_event(folder, tidy_texts=False), config)
    assert got["Küche_Unverträglichkeiten"].count() == 4
    assert {r["Ortschaft"] for r in got["Nach_Orten"].collect()} == {"Bonn"}
    assert table(got["Anmeldezahlen"], "Ortschaft", "Gesamt")[:3] == [("GESAMT", 4), ("Aalen", 0), ("Bonn", 2)]


def test_lint_names_what_is_missing():
    spec = next(r for r in camp_h.FAMILY.reports if r.name == "Sani")
    assert lint(spec, camp_h.ATTENDEES) == ["Sani: no column 'Ortsteil'"]
    odd = ReportSpec("x", "clean", ("a", "a"), order=("b",), group="c")
    assert lint(odd, ["a"]) == ["x: column 'a' twice", "x: needs column 'b'", "x: needs column 'c'"]


def test_runs(spark, camp_h_event, folder):
    out, landing = f"{folder}/out", Landing(camp_h_event)
    outcomes = []

    def pinned():
        app = f"{scratch_root(spark)}/rollcall/{spark.sparkContext.applicationId}"
        return sorted(os.listdir(app)) if os.path.isdir(app) else []

    def run(config=CONFIG):
        before = pinned()
        outcomes.append(run_event(spark, camp_h.FAMILY, landing, out, config))
        assert pinned() == before
        return outcomes[-1]

    assert run() == "success"
    assert run() == "unchanged"
    # The same rows in another order are no change.
    pages = sorted(os.listdir(f"{camp_h_event}/orders"))
    documents = [json.load(open(f"{camp_h_event}/orders/{p}", encoding="utf-8")) for p in pages]
    shuffled = [d["results"] for d in documents][::-1]
    for page, d, results in zip(pages, documents, shuffled):
        write_json(f"{camp_h_event}/orders/{page}", {**d, "results": results[::-1]})
    spark.catalog.clearCache()
    assert run() == "unchanged"
    names = current_report(spark, out, "Teilnehmerdaten")
    assert names.count() == 5 and "page_no" not in names.columns
    lists = current_report(spark, out, "Nach_Orten")
    assert {r["folder"] for r in lists.select("folder").distinct().collect()} == {"Süd", "Nord", "West"}
    assert {r["folder"] == r["Zu-/Ausstieg"] for r in lists.collect()} == {True}
    manifest = spark.read.parquet(f"{out}/_manifest").where("label is not null")
    assert {(r["label"], r["path"], r["rows"]) for r in manifest.collect()} == {
        ("Süd", "Nach_Orten/Süd", 3), ("Nord", "Nach_Orten/Nord", 1), ("West", "Nach_Orten/West", 1),
        ("Leer", "Nach_Orten/Leer", 0),
    }
    assert spark.read.parquet(f"{out}/_widths").where("path = 'Teilnehmerdaten'").count() == 34
    # A broken page fails the run, and the next good one is not skipped.
    good = json.load(open(f"{camp_h_event}/orders/{pages[-1]}", encoding="utf-8"))
    write_json(f"{camp_h_event}/orders/{pages[-1]}", {**good, "next": "more"})
    assert run() == "failed"
    write_json(f"{camp_h_event}/orders/{pages[-1]}", good)
    assert run() == "success"
    log = runs(spark, out).orderBy("run_ts").collect()
    assert [r["status"] for r in log] == outcomes
    assert log[0]["input_rows"] == 6 and log[0]["updated"].startswith("Last updated:\n")
    assert "incomplete pages" in log[3]["error"] and "ERROR occurred:\n" in log[3]["updated"]
    assert spark.read.parquet(f"{out}/_run_errors").count() == 1


def test_manifest_says_where_rows_lie(spark, folder):
    e = event_of(camp_h, ["007", "a=b", "Leer"])
    places = ["007", "a=b", ":?*", "007"]
    orders = [order(f"B{i}", [e.ticket(i, "v", "n", {"Zu-/Ausstieg": p})]) for i, p in enumerate(places)]
    out = f"{folder}/out"
    assert run_event(spark, camp_h.FAMILY, Landing(e.land(f"{folder}/in", orders)), out) == "success"
    manifest = spark.read.parquet(f"{out}/_manifest").collect()
    lists = {r["label"]: r for r in manifest if r["label"] is not None}
    assert {label: r["rows"] for label, r in lists.items()} == {"007": 2, "a=b": 1, ":?*": 1, "Leer": 0}
    assert {label for label, r in lists.items() if r["stored"] is None} == {"Leer"}
    assert {r["report"]: r["rows"] for r in manifest if r["label"] is None}["Teilnehmerdaten"] == 4
    for r in manifest:
        assert r["stored"] is None or os.path.isdir(f"{out}/{r['stored']}"), r
    shown = current_report(spark, out, "Nach_Orten")
    assert {r["Zu-/Ausstieg"] for r in shown.collect()} == {"007", "a=b", ":?*"}
    assert {r["folder"] for r in shown.where("folder like '0%'").collect()} == {"007"}


def test_change_of_catalogue_or_configuration_is_a_change(spark, camp_h_event, folder):
    landing, out = Landing(camp_h_event), f"{folder}/out"

    def state(config=CONFIG, family=camp_h.FAMILY):
        return state_of(look(spark, landing, out), family, config)

    first = state()
    assert first == state(config=replace(CONFIG, interval_minutes=1))
    assert state(config=replace(CONFIG, report_format="csv")) != first
    assert state(family=replace(camp_h.FAMILY, place_question="Ort?")) != first
    # A page is read when its file is new, and never again.
    pages = known_pages(spark, out).count()
    assert look(spark, landing, out).fresh == {}
    questions = json.load(open(f"{camp_h_event}/questions/page-000001.json", encoding="utf-8"))
    questions["results"][0]["question"]["de"] += "?"
    write_json(f"{camp_h_event}/questions/page-000001.json", questions)
    seen = look(spark, landing, out)
    assert {c: len(p) for c, p in seen.fresh.items()} == {"questions": 1} and seen.parsed is None and seen.rows == 6
    assert state() != first and known_pages(spark, out).count() == pages + 1


def test_csv_reports(spark, camp_h_event, folder):
    out = f"{folder}/out"
    config = replace(CONFIG, report_format="csv")
    assert run_event(spark, camp_h.FAMILY, Landing(camp_h_event), out, config) == "success"
    diet = current_report(spark, out, "Küche", "csv")
    assert "'+49 1" in {r["Sorgeberechtigter"] for r in diet.collect()}


def test_csv_reports_read_back_as_they_were(spark, folder):
    e = event_of(camp_h, DEFAULT_CHOICES[camp_h])
    orders = [order("B1", [e.ticket(1, "two\nlines", 'a "b", c', {"Zu-/Ausstieg": "Süd"}), e.ticket(2, "x", "y", {"Zu-/Ausstieg": "Süd"})])]
    landing, got = Landing(e.land(f"{folder}/in", orders)), {}
    for fmt in ("csv", "parquet"):
        assert run_event(spark, camp_h.FAMILY, landing, f"{folder}/{fmt}", replace(CONFIG, report_format=fmt)) == "success"
        for name in ("Teilnehmerdaten", "Nach_Orten", "Anmeldezahlen"):
            report = current_report(spark, f"{folder}/{fmt}", name, fmt)
            got[fmt, name] = ([(f.name, f.dataType) for f in report.schema.fields], sorted(map(tuple, report.collect()), key=str))
    assert all(got["csv", name] == got["parquet", name] for _, name in got) and len(got["csv", "Teilnehmerdaten"][1]) == 2
    assert spark.conf.get("spark.sql.caseSensitive") == "false"
    notes = [r.note for r in spark.read.parquet(f"{folder}/csv/_notes").collect()]
    assert "Sani: no column 'Ortsteil'" in notes


def test_equal_questions_get_columns_of_their_own(spark, folder):
    """By the documented suffix, or sharing one column, where the last answer wins."""
    texts = [*camp_h.QUESTIONS, "Doppelt"]
    e = event_of(camp_h, DEFAULT_CHOICES[camp_h], texts)
    root = e.land(f"{folder}/in", [order("B1", [e.ticket(1, "v", "n", {"Zu-/Ausstieg": "Süd", "Doppelt": "first"})])])
    extra = json.load(open(f"{root}/questions/page-000002.json", encoding="utf-8"))
    extra["results"].append({"id": 900, "question": {"de": "Doppelt"}})
    write_json(f"{root}/questions/page-000002.json", extra)
    tickets = json.load(open(f"{root}/orders/page-000001.json", encoding="utf-8"))
    tickets["results"][0]["positions"][0]["answers"].append({"question": 900, "answer": "second"})
    write_json(f"{root}/orders/page-000001.json", tickets)
    for dedup, expected in (("last", {"Doppelt": "second"}), ("suffix", {"Doppelt": "first", "Doppelt (#2)": "second"})):
        out = f"{folder}/{dedup}"
        assert run_event(spark, camp_h.FAMILY, Landing(root), out, replace(CONFIG, dedup=dedup)) == "success"
        raw = current_report(spark, out, "Unsortiert/Rohdaten").first().asDict()
        assert {c: v for c, v in raw.items() if c.startswith("Doppelt")} == expected
