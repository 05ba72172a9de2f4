"""Family H: camps with bus stops."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rollcall.functions.text import address
from rollcall.functions.times import iso_minute_text
from rollcall.functions.values import map_values
from rollcall.operators.shaping import blanks_to_null, quoted, rename, require, select_known
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
from rollcall.plans.spec import EventConfig, ReportSpec
from rollcall.sources.registrations import ORDINAL

# Column names and question texts, and what the reports call them.
RENAMES = {
    "order_code": "Bestellnummer",
    "status": "Bestellstatus",
    "email": "E-Mail",
    "total": "Gesamtpreis",
    "date": "Anmeldedatum",
    "item_name": "Art",
    "price": "Preis",
    "attendee_firstname": "Vorname",
    "attendee_lastname": "Nachname",
    "Geburtsdatum": "Geburtsdatum",
    "attendee_street": "Straße",
    "attendee_zipcode": "PLZ",
    "attendee_city": "Ort",
    "Ortsteil": "Ortsteil",
    "attendee_country": "Land",
    "Erreichbarkeit des/der Sorgeberechtigten": "Sorgeberechtigter",
    "Verwandte/Freunde, die im Notfall weiterhelfen können - bitte Telefonnummer mit angeben!": "Verwandte/Freunde",
    "Gesundheitsfürsorge - Krankenversicherung": "Krankenversicherung",
    "Name der Krankenkasse und Versicherungsnummer": "Versicherungsnummer",
    "Vor- und Nachname des/der Familienangehörigen, über den Ihr Kind versichert ist": "Versicherungsnehmer",
    "Name und Adresse des Hausarztes": "Hausarzt",
    "Ich stimme der Verabreichung rezeptfreier Medikamente zu": "Verabreichung rezeptfreier Medikamente",
    "Mein Kind ist gegen Tetanus (Wundstarrkrampf) geimpft": "Tetanusimpfung",
    "Letztes Impfdatum Tetanus:": "Impfdatum Tetanus",
    "Mein Kind ist gegen FSME (Zecken) geimpft": "FSME Impfung",
    "Letztes Impfdatum FSME:": "Impfdatum FSME",
    "Ich bin damit einverstanden, dass ein:e Mitarbeiter:in eine Zecke bei meinem Kind entfernen darf": "Zecken entfernen",
    "Mein Kind ernährt sich vegetarisch.": "Vegetarier",
    "Mein Kind kann schwimmen und darf unter Aufsicht im Freibad oder See baden gehen:": "Schwimmerlaubnis",
    "Mein Kind darf für Programmzwecke und für den Fall einer medizinischen Abklärung in einem privaten PKW mitfahren.": "Mitfahrerlaubnis",
    "Zu-/Ausstieg": "Zu-/Ausstieg",
    "Zuschussantrag": "Zuschussantrag",
    "Einverständnis zur Verwendung von entstandenen Video- und Bildaufnahmen": "Bildrechte",
    "Dürfen nach dem Lager Flyer/Einladungen an Ihr Kind verschickt werden?": "Erlaubnis für Einladungen",
    "Mein Kind besucht folgende Jungschar": "Jungschar",
    "Einverständniserklärung": "Einverständniserklärung",
    "Zustimmung zu den AGBs": "Zustimmung AGBs",
    "Medikamente - Name des Medikaments und Dosierung": "Medikamente",
    "Medikamenteneinnahme": "Medikamenteneinnahme",
    "Zeitpunkt Medikamentengabe": "Zeitpunkt Medikamentengabe",
    "Worauf muss besonders geachtet werden?": "Medizinische Informationen",
    "Was das Zeltlager-Leitungs-Team sonst noch wissen sollte:": "Sonstiges",
    "Mein Kind hat folgende Lebensmittelunverträglichkeiten/ Essgewohnheiten": "Lebensmittelunverträglichkeiten",
}
# Columns that hold yes or no, and their words.
YES_NO = (
    "Verabreichung rezeptfreier Medikamente",
    "Tetanusimpfung",
    "FSME Impfung",
    "Zecken entfernen",
    "Vegetarier",
    "Schwimmerlaubnis",
    "Mitfahrerlaubnis",
    "Zuschussantrag",
    "Bildrechte",
    "Erlaubnis für Einladungen",
    "Einverständniserklärung",
    "Zustimmung AGBs",
)
YES_NO_WORDS = {"True": "Ja", "False": "Nein"}
# The columns of each report.
ATTENDEES = (
    "Nachname", "Vorname", "Geburtsdatum", "Adresse", "E-Mail", "Sorgeberechtigter",
    "Verwandte/Freunde", "Krankenversicherung", "Versicherungsnummer", "Versicherungsnehmer",
    "Hausarzt", "Verabreichung rezeptfreier Medikamente", "Tetanusimpfung", "Impfdatum Tetanus",
    "FSME Impfung", "Impfdatum FSME", "Zecken entfernen", "Medikamente", "Medikamenteneinnahme",
    "Zeitpunkt Medikamentengabe", "Medizinische Informationen", "Sonstiges", "Vegetarier",
    "Lebensmittelunverträglichkeiten", "Schwimmerlaubnis", "Mitfahrerlaubnis", "Zu-/Ausstieg",
    "Zuschussantrag", "Bildrechte", "Erlaubnis für Einladungen", "Jungschar", "Bestellnummer",
    "Anmeldedatum",
)
PER_PLACE = ("Nachname", "Vorname", "Geburtsdatum", "Zu-/Ausstieg", "Anmeldedatum")
ORDERS = (
    "Bestellnummer", "Bestellstatus", "E-Mail", "Gesamtpreis", "Anmeldedatum", "Zuschussantrag",
)
CONTACTS = (
    "Nachname", "Vorname", "Geburtsdatum", "Adresse", "E-Mail", "Sorgeberechtigter",
    "Verwandte/Freunde", "Hausarzt", "Krankenversicherung", "Versicherungsnummer",
    "Versicherungsnehmer",
)
MEDICAL = (
    "Nachname", "Vorname", "Geburtsdatum", "Medikamente", "Medikamenteneinnahme",
    "Zeitpunkt Medikamentengabe", "Medizinische Informationen", "Sonstiges",
    "Lebensmittelunverträglichkeiten", "Verabreichung rezeptfreier Medikamente",
    "Tetanusimpfung", "Impfdatum Tetanus", "FSME Impfung", "Impfdatum FSME", "Zecken entfernen",
    "Ortsteil", "E-Mail", "Sorgeberechtigter", "Verwandte/Freunde", "Krankenversicherung",
    "Versicherungsnummer", "Versicherungsnehmer", "Hausarzt", "Mitfahrerlaubnis", "Adresse",
)
DIET = (
    "Nachname", "Vorname", "Geburtsdatum", "Vegetarier", "Lebensmittelunverträglichkeiten",
    "E-Mail", "Sorgeberechtigter", "Anmeldedatum",
)
CLEARED = ("E-Mail", "Anmeldedatum", "Sorgeberechtigter")
PLACE = "Zu-/Ausstieg"

QUESTIONS = question_texts_read(RENAMES, tuple(RENAMES.values()), ())
CLEAN = (*RENAMES.values(), "Adresse")


def clean(raw: DataFrame, known: Known, config: EventConfig) -> DataFrame:
    """The clean table all reports start from; cancelled tickets are still in it."""
    df = rename(with_answers(raw, QUESTIONS, known), RENAMES)
    require(df, [*YES_NO, "Ortsteil", PLACE, "Lebensmittelunverträglichkeiten", *CLEARED])
    df = df.withColumns(
        {
            "Adresse": address("Straße", "PLZ", "Ort", "Land", district="Ortsteil", tidy=True),
            "Bestellstatus": map_values("Bestellstatus", STATUS_WORDS),
            "Anmeldedatum": iso_minute_text("Anmeldedatum", config.time_zone),
            **{c: map_values(quoted(c), YES_NO_WORDS) for c in YES_NO},
        }
    )
    return blanks_to_null(select_known(df, [*CARRIED, *CLEAN]))


FAMILY = Family(
    name="camp_h",
    place_question="Zu-/Ausstieg",
    questions=tuple(QUESTIONS),
    clean=clean,
    reports=(
        ReportSpec("Alles", "clean", CLEAN, folder="Unsortiert", numbers="keep"),
        ReportSpec(
            "Teilnehmerdaten", "clean", ATTENDEES, where=(NOT_CANCELLED,), order=BY_NAME, keep=ORDINAL
        ),
        ReportSpec("Nach_Orten", "clean", PER_PLACE, order=BY_NAME, group=PLACE),
        CountSpec("Anmeldezahlen", "clean", PLACE, PLACE, {"Anmeldungen": None}),
        ReportSpec(
            "Bestellungen", "clean", ORDERS, folder="Finanzen",
            step=order_step(ORDERS, "Zuschussantrag"), order=BY_STATUS, ties=("Bestellnummer",), costly=True,
        ),
        ReportSpec("Notfallkontakte", "Teilnehmerdaten", CONTACTS, numbers="keep"),
        ReportSpec("Sani", "Teilnehmerdaten", MEDICAL, numbers="keep"),
        ReportSpec(
            "Küche", "Teilnehmerdaten", DIET,
            step=clear_unless(["Lebensmittelunverträglichkeiten"], CLEARED), numbers="keep",
        ),
    ),
)
