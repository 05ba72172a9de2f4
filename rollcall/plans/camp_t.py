"""Family T: like L, with three diet flags and a few columns of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rollcall.functions.text import join_flags
from rollcall.functions.values import map_values
from rollcall.operators.shaping import blanks_to_null, rename, require, select_known
from rollcall.plans.camp_l import (
    INVOICE_RENAMES,
    PLACE_QUESTION,
    invoice_and_place,
    town_choices,
    town_reports,
)
from rollcall.plans.common import CARRIED, Family, Known, question_texts_read, with_answers
from rollcall.plans.spec import EventConfig

# Column names and question texts, and what the reports call them.
RENAMES = INVOICE_RENAMES | {
    "Ernährung: Vegetarisch": "Vegetarisch",
    "Ernährung: Laktosefrei": "Laktosefrei",
    "Ernährung: Glutenfrei": "Glutenfrei",
    "Gültige Tetanusimpfung vorhanden": "Tetanusimpfung",
    "Geht Ihr Kind in einen Teenkreis?": "Besucht Teenkreis",
    "Welche Medikamente?": "Medikamente",
    "Worauf muss außerdem besonders geachtet werden?": "Medizinische Besonderheiten",
    "Zuschuss beantragen": "Zuschuss beantragt",
}
PLACE_QUESTIONS = (
    "Wo geht Ihr Kind in den Teenkreis?",
    "Wir melden uns über folgenden Ort an",
    "Wir melden uns über folgenden Ort an (#2)",
)
DIET_FLAGS = ("Vegetarisch", "Laktosefrei", "Glutenfrei")
# JSON true and false arrive as lower-case text.
FLAG_WORDS = {"True": "Ja", "true": "Ja", "False": "Nein", "false": "Nein"}
# The columns of each report.
CLEAN = (
    "Bestellnummer", "Bestellstatus", "E-Mail", "E-Mail-Adresse Teen", "Gesamtpreis",
    "Anmeldedatum", "Rechnung - Empfänger", "Rechnung - Adresse", "Art", "Preis", "Vorname",
    "Nachname", "Geburtsdatum", "Geschlecht", "Ernährung", "Vegetarisch", "Laktosefrei",
    "Glutenfrei", "Essensunverträglichkeiten", "Tetanusimpfung", "Krankenversicherung",
    "Splitter und Zecken dürfen vom Sani des Lagers entfernt werden",
    "Verabreichung rezeptfreier Medikamente durch den Sani des Lagers", "Medikamente",
    "Medizinische Besonderheiten", "Notfall-Telefonnummern", "Schwimmer", "Besucht Teenkreis",
    "Ort", "Sonstiges", "Zuschuss beantragt", "Einverständniserklärung",
)
ATTENDEES = (
    "Nachname", "Vorname", "Geschlecht", "Geburtsdatum", "Ernährung",
    "Essensunverträglichkeiten", "Tetanusimpfung", "Krankenversicherung",
    "Splitter und Zecken dürfen vom Sani des Lagers entfernt werden",
    "Verabreichung rezeptfreier Medikamente durch den Sani des Lagers", "Medikamente",
    "Medizinische Besonderheiten", "Notfall-Telefonnummern", "Schwimmer", "Besucht Teenkreis",
    "Ort", "Sonstiges", "Zuschuss beantragt", "Einverständniserklärung", "Bestellnummer",
    "Anmeldedatum", "E-Mail", "Rechnung - Empfänger", "Rechnung - Adresse",
)
PER_PLACE = (
    "Nachname", "Vorname", "Geschlecht", "Geburtsdatum", "Besucht Teenkreis", "Ort", "Sonstiges",
    "Anmeldedatum",
)
MEDICAL = (
    "Nachname", "Vorname", "Geschlecht", "Geburtsdatum", "Ort", "Ernährung",
    "Essensunverträglichkeiten", "Medikamente", "Medizinische Besonderheiten", "Sonstiges",
    "Verabreichung rezeptfreier Medikamente durch den Sani des Lagers",
    "Splitter und Zecken dürfen vom Sani des Lagers entfernt werden", "Tetanusimpfung",
    "Krankenversicherung", "Notfall-Telefonnummern", "E-Mail", "Rechnung - Adresse",
    "Rechnung - Empfänger",
)
DIET = (
    "Nachname", "Vorname", "Geschlecht", "Geburtsdatum", "Ort", "Ernährung",
    "Essensunverträglichkeiten", "Medizinische Besonderheiten", "E-Mail",
    "Rechnung - Empfänger", "Notfall-Telefonnummern", "Anmeldedatum",
)
NOTES = ("Essensunverträglichkeiten", "Ernährung", "Medizinische Besonderheiten")

QUESTIONS = question_texts_read(
    RENAMES,
    (*CLEAN, *PLACE_QUESTIONS),
    ("Rechnung - Empfänger", "Rechnung - Adresse", "Ort", "Ernährung"),
)


def clean(raw: DataFrame, known: Known, config: EventConfig) -> DataFrame:
    """The clean table all reports start from, with the diet flags summed up in one text."""
    df = rename(with_answers(raw, QUESTIONS, known), RENAMES)
    df = require(df, [*DIET_FLAGS, *NOTES[::2]])
    df = df.withColumns({flag: map_values(flag, FLAG_WORDS) for flag in DIET_FLAGS})
    df = df.withColumn("Ernährung", join_flags({flag: flag for flag in DIET_FLAGS}))
    df = invoice_and_place(df, PLACE_QUESTIONS, config)
    return blanks_to_null(select_known(df, [*CARRIED, *CLEAN]))


FAMILY = Family(
    name="camp_t",
    place_question=PLACE_QUESTION,
    questions=tuple(QUESTIONS),
    clean=clean,
    edit_choices=town_choices,
    reports=town_reports(
        {
            "clean": CLEAN, "attendees": ATTENDEES, "per_place": PER_PLACE,
            "medical": MEDICAL, "diet": DIET,
        },
        notes=NOTES,
    ),
)
