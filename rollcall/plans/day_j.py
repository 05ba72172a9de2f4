"""Family J: a single day, with drivers, classes of tickets and diet counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.text import blank_to_null, strip
from rollcall.functions.times import iso_minute_text
from rollcall.functions.values import differs
from rollcall.operators.shaping import quoted, rename, require, select_known
from rollcall.plans.common import (
    CARRIED,
    CountSpec,
    Family,
    Known,
    question_texts_read,
    with_answers,
)
from rollcall.plans.spec import EventConfig, ReportSpec, Where
from rollcall.sources.registrations import ORDINAL

# Column names and question texts, and what the reports call them.
RENAMES = {
    "order_code": "Bestellnummer",
    "email": "E-Mail",
    "date": "Anmeldedatum",
    "item_name": "Art",
    "attendee_firstname": "Vorname",
    "attendee_lastname": "Nachname",
    "Essensunverträglichkeiten": "Essensunverträglichkeiten Ja/Nein",
    "Welche Unverträglichkeiten?": "Essensunverträglichkeiten",
    "Ich melde mich über folgende Ortschaft an": "Ortschaft",
    "Ich biete eine Fahrgemeinschaft an": "Fahrer Angebot Eltern",
    "Ich stelle mich als Fahrer bereit": "Fahrer Angebot Mitarbeiter",
    "Ich bin Ortsverantwortlicher.": "Ortsverantwortlicher",
    "Telefonnummer": "Telefonnummer Mitarbeiter",
}
# Ticket classes and diet classes, found as parts of a text.
CLASSES = {
    "Jungscharler": ("Art", "Jungscharler"),
    "Mitarbeiter": ("Art", "Mitarbeiter"),
    "Gesamt": None,
}
DIETS = ("Keine Besonderheiten", "Kein Schweinefleisch", "Vegetarisch")
CANCELLED_CODE = "c"
# The columns of each report.
SORTED = (
    "Ortschaft", "Art", "Nachname", "Vorname", "Telefonnummer", "E-Mail", "Ernährung",
    "Essensunverträglichkeiten", "Sonstiges", "Ortsverantwortlicher", "Fahrer Angebot",
    "Anmeldedatum", "Bestellnummer",
)
PER_PLACE = (
    "Ortschaft", "Art", "Nachname", "Vorname", "Telefonnummer", "E-Mail", "Ernährung",
    "Essensunverträglichkeiten", "Sonstiges", "Fahrer Angebot", "Anmeldedatum",
)
INTOLERANCES = (
    "Nachname", "Vorname", "Ortschaft", "Art", "Telefonnummer", "E-Mail", "Ernährung",
    "Essensunverträglichkeiten", "Sonstiges", "Anmeldedatum",
)
EITHER = {
    "Fahrer Angebot": ("Fahrer Angebot Eltern", "Fahrer Angebot Mitarbeiter"),
    "Telefonnummer": ("Telefonnummer der Eltern", "Telefonnummer Mitarbeiter"),
}
BY_PLACE = ("Ortschaft", "Art", "Nachname", "Vorname")
PHONE_OF_PARENTS = "Telefonnummer der Eltern"

QUESTIONS = question_texts_read(
    RENAMES, (*SORTED, PHONE_OF_PARENTS), ("Telefonnummer", "Fahrer Angebot")
)


def clean(raw: DataFrame, known: Known, config: EventConfig) -> DataFrame:
    """Tickets that are not cancelled, offers of parents and staff in one column each.

    With ``blank_is_null`` a blank answer counts as none in what is coalesced, in the
    intolerances and, stripped, in the place. Without it blanks are values, as they
    come in; ``answered`` then adds them for questions nobody answered.
    """
    df = raw.where(differs("status", CANCELLED_CODE))
    df = rename(with_answers(df, QUESTIONS, known), RENAMES)
    pairs = [c for pair in EITHER.values() for c in pair]
    require(df, [*pairs, "Ernährung", "Essensunverträglichkeiten", "Ortschaft"])
    if config.blank_is_null:
        df = df.withColumns(
            {c: F.when(blank_to_null(quoted(c)).isNotNull(), quoted(c))
             for c in [*pairs, "Essensunverträglichkeiten"]}
            | {"Ortschaft": blank_to_null("Ortschaft")}
        )
    df = df.withColumns(
        {c: F.coalesce(*map(quoted, pair)) for c, pair in EITHER.items()}
        | {"Anmeldedatum": iso_minute_text("Anmeldedatum", config.time_zone)}
    )
    return select_known(df, [*CARRIED, *SORTED])


def answered(raw: DataFrame, known: Known) -> Known:
    """The ids that have an answer: a text without any then reads as empty, not as null."""
    ids = [i for of in known.values() for i in of if i is not None]
    used = raw.select(F.explode("answers.id").alias("id")).where(F.col("id").isin(ids)).distinct()
    given = {r["id"] for r in used.collect()}
    return {t: [i for i in of if i in given] for t, of in known.items()}


def listed(df: DataFrame) -> DataFrame:
    """A place is matched as it is stripped, so that others are in no list."""
    return df.where(F.col("Ortschaft") == strip("Ortschaft"))


FAMILY = Family(
    name="day_j",
    place_question="Ich melde mich über folgende Ortschaft an",
    questions=tuple(QUESTIONS),
    clean=clean,
    reports=(
        ReportSpec("Alle", "clean", SORTED, order=BY_PLACE, keep=ORDINAL),
        ReportSpec(
            "Nach_Orten", "clean", PER_PLACE, step=listed, group="Ortschaft", order=BY_PLACE[1:]
        ),
        CountSpec("Anmeldezahlen", "clean", "Ortschaft", "Ortschaft", CLASSES),
        CountSpec(
            "Küche_Gesamtzahlen", "clean", "Ernährung", "Ernährung", CLASSES,
            categories=DIETS, total="Gesamt",
        ),
        ReportSpec(
            "Küche_Unverträglichkeiten", "clean", INTOLERANCES,
            where=(Where("Essensunverträglichkeiten", "given"),),
            order=("Nachname", "Vorname", "Ortschaft", "Art"),
        ),
    ),
)
