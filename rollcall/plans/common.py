"""What the event families share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.values import keep_if, not_blank
from rollcall.operators.collapsing import collapse
from rollcall.operators.counting import (
    LABEL,
    POSITION,
    counts_per_category,
    counts_per_choice,
)
from rollcall.operators.shaping import quoted, widen
from rollcall.plans.spec import NUMBER, EventConfig, Ranked, ReportSpec, Where, filtered
from rollcall.sources.registrations import FIXED_COLUMNS, ORDINAL

# Status codes and their words, in the order reports sort them.
STATUS_WORDS = {
    "c": "storniert",
    "n": "unbezahlt",
    "p": "bezahlt",
}
STATUS_ORDER = ("unbezahlt", "bezahlt", "storniert")
CANCELLED = "storniert"
TOTAL = "GESAMT"

#: Question ids per text; a text without ids is asked but answered by nobody.
Known = Mapping[str, Sequence[int | None]]

#: Columns every clean table carries in front, for order and numbers.
CARRIED = (*ORDINAL, NUMBER)

BY_NAME = ("Nachname", "Vorname")
BY_STATUS = (Ranked("Bestellstatus", STATUS_ORDER), "Anmeldedatum")
NOT_CANCELLED = Where("Bestellstatus", "differs", CANCELLED)


@dataclass(frozen=True)
class CountSpec:
    """A table of counts: per choice of a place, or per category a text contains."""

    name: str
    source: str
    header: str
    column: str
    measures: Mapping[str, tuple[str, str] | None]
    categories: tuple[str, ...] | None = None
    total: str = TOTAL
    folder: str = ""
    where: tuple[Where, ...] = ()

    @property
    def path(self) -> str:
        return f"{self.folder}/{self.name}" if self.folder else self.name

    @property
    def read(self) -> set[str]:
        """Columns of the source this table is computed from."""
        parts = [part[0] for part in self.measures.values() if part]
        return {self.column, *parts, *[w.column for w in self.where]}

    def run(self, sources: Mapping[str, DataFrame], choices: DataFrame) -> DataFrame:
        measures = {
            m: None if part is None else Where(part[0], "contains", part[1]).condition()
            for m, part in self.measures.items()
        }
        df = filtered(sources[self.source], self.where)
        if self.categories is None:
            counts = counts_per_choice(df, self.column, choices, measures, self.total)
        else:
            counts = counts_per_category(df, self.column, self.categories, measures, self.total)
        return counts.select(
            F.col(POSITION).alias(NUMBER),
            F.col(LABEL).alias(self.header),
            *[quoted(m) for m in measures],
        )


@dataclass(frozen=True)
class Family:
    """Everything that makes up one kind of event."""

    name: str
    place_question: str
    clean: Callable[[DataFrame, Known, EventConfig], DataFrame]
    reports: tuple[ReportSpec | CountSpec, ...]
    questions: tuple[str, ...] = ()
    edit_choices: Callable[[DataFrame], DataFrame] = lambda choices: choices


def question_texts_read(
    renames: Mapping[str, str], wanted: Sequence[str], derived: Iterable[str]
) -> list[str]:
    """Question texts a family reads: renamed ones and those shown under their own text."""
    shown = [w for w in wanted if w not in renames.values() and w not in derived]
    texts = [*renames, *shown]
    return [t for t in dict.fromkeys(texts) if t not in FIXED_COLUMNS]


def with_answers(raw: DataFrame, texts: Iterable[str], known: Known) -> DataFrame:
    """Carried and fixed columns and one column per known question of ``texts``."""
    columns = {t: t for t in texts if t in known}
    base = raw.select(*CARRIED, *FIXED_COLUMNS, "answers")
    return widen(base, "answers", columns, [t for t in columns if known[t]], ids=known)


def order_step(columns: Sequence[str], flag: str) -> Callable[[DataFrame], DataFrame]:
    """One row per order: first given values, and the subsidy flag if any position has it."""
    key = "Bestellnummer"

    def step(df: DataFrame) -> DataFrame:
        firsts = [c for c in columns if c in df.columns and c not in (key, flag)]
        return collapse(df, key, firsts, [flag], ORDINAL)

    return step


def clear_unless(
    notes: Sequence[str], cleared: Sequence[str]
) -> Callable[[DataFrame], DataFrame]:
    """Contact columns only where one of the notes says something."""

    def step(df: DataFrame) -> DataFrame:
        noted: Column = not_blank(*[quoted(n) for n in notes])
        return df.withColumns({c: keep_if(noted, quoted(c)) for c in cleared})

    return step
