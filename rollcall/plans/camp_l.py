"""Family L: camps people join through a town."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.text import address, payee
from rollcall.functions.times import iso_minute_text
from rollcall.functions.values import first_usable, map_values, mark_given
from rollcall.operators.counting import edit_choices
from rollcall.operators.shaping import (
    add_missing,
    blanks_to_null,
    quoted,
    rename,
    require,
    select_known,
)
from rollcall.plans.common import (
    BY_NAME,
    BY_STATUS,
    CARRIED,
    NOT_CANCELLED,
    STATUS_WORDS,
    CountSpec,
    Family,
    Known,
    clear_unless,
    order_step,
    question_texts_read,
    with_answers,
)
from rollcall.plans.spec import EventConfig, ReportSpec, Where
from rollcall.sources.registrations import ORDINAL

# Column names and question texts, and what the reports call them.
INVOICE_RENAMES = {
    "order_code": "Bestellnummer",
    "status": "Bestellstatus",
    "email": "E-Mail",
    "total": "Gesamtpreis",
    "date": "Anmeldedatum",
    "invoice_name": "Rechnung - Name",
    "invoice_company": "Rechnung - Firma",
    "invoice_street": "Rechnung - Straße",
    "invoice_zipcode": "Rechnung - PLZ",
    "invoice_city": "Rechnung - Stadt",
    "invoice_country": "Rechnung - Land",
    "item_name": "Art",
    "price": "Preis",
    "attendee_firstname": "Vorname",
    "attendee_lastname": "Nachname",
}
RENAMES = INVOICE_RENAMES | {
    "Gültige Tetanusimpfung vorhanden": "Tetanusimpfung",
    "Geht Ihr Kind in eine Jungschar?": "Besucht Jungschar",
    "Essensunverträglichkeiten": "Essensunverträglichkeiten Ja/Nein",
    "Welche Unverträglichkeiten?": "Essensunverträglichkeiten",
    "Welche Medikamente?": "Medikamente",
    "Worauf muss außerdem besonders geachtet werden?": "Medizinische Besonderheiten",
    "Zuschuss beantragen": "Zuschuss beantragt",
}
# Where the town is asked for, and answers with a special role.
PLACE_QUESTION = "Wir melden uns über folgenden Ort an"
PLACE_QUESTIONS = (
    "Wo geht Ihr Kind in die Jungschar?",
    "Wir melden uns über folgenden Ort an",
    "Wir melden uns über folgenden Ort an (#2)",
)
OTHER_PLACE = "Sonstige"
NO_PLACE, NO_PLACE_SHORT = "Keiner (ortsunabhängige Anmeldung)", "ortsunabhängig"
DONATION = "Spende Zeltlagerarbeit"
INSURANCE_WORDS = {
    "Privat krankenversichert": "privat",
    "Gesetzlich krankenversichert (z.B. AOK)": "gesetzlich",
}
UPLOADED = "hochgeladen"
# The columns of each report.
CLEAN = (
    "Bestellnummer", "Bestellstatus", "E-Mail", "Gesamtpreis", "Anmeldedatum",
    "Rechnung - Empfänger", "Rechnung - Adresse", "Art", "Preis", "Vorname", "Nachname",
    "Geburtsdatum", "Ernährung", "Essensunverträglichkeiten", "Tetanusimpfung",
    "Krankenversicherung", "Splitter und Zecken dürfen vom Sani des Lagers entfernt werden",
    "Verabreichung rezeptfreier Medikamente durch den Sani des Lagers", "Medikamente",
    "Medizinische Besonderheiten", "Notfall-Telefonnummern", "T-Shirt Größe", "Schwimmer",
    "Besucht Jungschar", "Ort", "Sonstiges", "Zuschuss beantragt", "Einverständniserklärung",
)
ATTENDEES = (
    "Nachname", "Vorname", "Geburtsdatum", "Ernährung", "Essensunverträglichkeiten",
    "Tetanusimpfung", "Krankenversicherung",
    "Splitter und Zecken dürfen vom Sani des Lagers entfernt werden",
    "Verabreichung rezeptfreier Medikamente durch den Sani des Lagers", "Medikamente",
    "Medizinische Besonderheiten", "Notfall-Telefonnummern", "T-Shirt Größe", "Schwimmer",
    "Besucht Jungschar", "Ort", "Sonstiges", "Zuschuss beantragt", "Einverständniserklärung",
    "Bestellnummer", "Anmeldedatum", "E-Mail", "Rechnung - Empfänger", "Rechnung - Adresse",
)
PER_PLACE = (
    "Nachname", "Vorname", "Geburtsdatum", "Besucht Jungschar", "Ort", "Sonstiges", "Anmeldedatum",
)
ORDERS = (
    "Bestellnummer", "Bestellstatus", "E-Mail", "Gesamtpreis", "Anmeldedatum",
    "Rechnung - Empfänger", "Rechnung - Adresse", "Zuschuss beantragt",
)
DONATIONS = (
    "Art", "Preis", "Bestellstatus", "Anmeldedatum", "E-Mail", "Rechnung - Empfänger",
    "Rechnung - Adresse", "Bestellnummer", "Zuschuss beantragt",
)
CONTACTS = (
    "Nachname", "Vorname", "Geburtsdatum", "Ort", "Notfall-Telefonnummern", "E-Mail",
    "Rechnung - Adresse", "Rechnung - Empfänger",
)
MEDICAL = (
    "Nachname", "Vorname", "Geburtsdatum", "Ort", "Ernährung", "Essensunverträglichkeiten",
    "Medikamente", "Medizinische Besonderheiten", "Sonstiges",
    "Verabreichung rezeptfreier Medikamente durch den Sani des Lagers",
    "Splitter und Zecken dürfen vom Sani des Lagers entfernt werden", "Tetanusimpfung",
    "Krankenversicherung", "Notfall-Telefonnummern", "E-Mail", "Rechnung - Adresse",
    "Rechnung - Empfänger",
)
DIET = (
    "Nachname", "Vorname", "Geburtsdatum", "Ort", "Ernährung", "Essensunverträglichkeiten",
    "E-Mail", "Rechnung - Empfänger", "Notfall-Telefonnummern", "Anmeldedatum",
)
CLEARED = ("E-Mail", "Anmeldedatum", "Rechnung - Empfänger", "Notfall-Telefonnummern")

QUESTIONS = question_texts_read(
    RENAMES, (*CLEAN, *PLACE_QUESTIONS), ("Rechnung - Empfänger", "Rechnung - Adresse", "Ort")
)


def invoice_and_place(df: DataFrame, places: Sequence[str], config: EventConfig) -> DataFrame:
    """Payee, invoice address, town and the simplified values all town camps share."""
    require(df, ["Krankenversicherung", "Einverständniserklärung", "Zuschuss beantragt",
                 "Sonstiges", "Essensunverträglichkeiten", "Notfall-Telefonnummern"])
    df = add_missing(df, places)
    df = df.withColumn("Ort", first_usable(*[quoted(p) for p in places], sentinel=OTHER_PLACE))
    return df.withColumns(
        {
            "Rechnung - Empfänger": payee(F.col("Rechnung - Name"), F.col("Rechnung - Firma")),
            "Rechnung - Adresse": address(
                "Rechnung - Straße", "Rechnung - PLZ", "Rechnung - Stadt", "Rechnung - Land"
            ),
            "Krankenversicherung": map_values("Krankenversicherung", INSURANCE_WORDS),
            "Einverständniserklärung": mark_given("Einverständniserklärung", UPLOADED),
            "Ort": map_values("Ort", {NO_PLACE: NO_PLACE_SHORT}),
            "Bestellstatus": map_values("Bestellstatus", STATUS_WORDS),
            "Anmeldedatum": iso_minute_text("Anmeldedatum", config.time_zone),
        }
    )


def clean(raw: DataFrame, known: Known, config: EventConfig) -> DataFrame:
    """The clean table all reports start from."""
    df = rename(with_answers(raw, QUESTIONS, known), RENAMES)
    df = invoice_and_place(df, PLACE_QUESTIONS, config)
    return blanks_to_null(select_known(df, [*CARRIED, *CLEAN]))


def town_choices(choices: DataFrame) -> DataFrame:
    """The offered towns; signing up without one is called by its short name, last."""
    return edit_choices(choices, remove=NO_PLACE, append=NO_PLACE_SHORT)


def town_reports(
    columns: Mapping[str, tuple[str, ...]], notes: Sequence[str]
) -> tuple[ReportSpec | CountSpec, ...]:
    """The reports of a town camp from its column lists and diet notes."""
    going = (Where("Art", "differs", DONATION), NOT_CANCELLED)
    return (
        ReportSpec("Alles", "clean", columns["clean"], folder="Unsortiert", numbers="keep"),
        ReportSpec(
            "Teilnehmerdaten", "clean", columns["attendees"],
            where=going, order=BY_NAME, keep=ORDINAL,
        ),
        ReportSpec(
            "Nach_Orten", "clean", columns["per_place"], where=going, order=BY_NAME, group="Ort"
        ),
        ReportSpec(
            "Zum_Teilen", "Nach_Orten", columns["per_place"], group="Ort", numbers="keep",
            redact=("Sonstiges",),
        ),
        CountSpec("Anmeldezahlen", "clean", "Ort", "Ort", {"Anmeldungen": None}, where=going),
        ReportSpec(
            "Bestellungen", "clean", ORDERS, folder="Finanzen",
            step=order_step(ORDERS, "Zuschuss beantragt"), order=BY_STATUS, ties=("Bestellnummer",), costly=True,
        ),
        ReportSpec(
            "Spenden", "clean", DONATIONS, folder="Finanzen",
            where=(Where("Art", "equals", DONATION),), order=BY_STATUS,
        ),
        ReportSpec("Notfallkontakte", "Teilnehmerdaten", CONTACTS, numbers="keep"),
        ReportSpec("Sani", "Teilnehmerdaten", columns["medical"], numbers="keep"),
        ReportSpec(
            "Küche", "Teilnehmerdaten", columns["diet"],
            step=clear_unless(notes, CLEARED), numbers="keep",
        ),
    )


FAMILY = Family(
    name="camp_l",
    place_question=PLACE_QUESTION,
    questions=tuple(QUESTIONS),
    clean=clean,
    edit_choices=town_choices,
    reports=town_reports(
        {
            "clean": CLEAN, "attendees": ATTENDEES, "per_place": PER_PLACE,
            "medical": MEDICAL, "diet": DIET,
        },
        notes=["Essensunverträglichkeiten"],
    ),
)
