"""Report specifications: what a report takes, keeps, orders and where it goes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.values import differs, equals, has_text, not_blank, rank_of
from rollcall.operators.numbering import number_rows
from rollcall.operators.shaping import drop_columns, quoted, require, select_known
from rollcall.session import pin
from rollcall.sources.registrations import ORDINAL

NUMBER = "Nr"

TESTS: dict[str, Callable[..., Column]] = {
    "differs": differs,
    "equals": equals,
    "contains": has_text,
    "given": lambda c, _: c.isNotNull(),
    "not blank": lambda c, _: not_blank(c),
}


@dataclass(frozen=True)
class Where:
    column: str
    test: str
    value: object = None

    def condition(self) -> Column:
        return TESTS[self.test](quoted(self.column), self.value)


@dataclass(frozen=True)
class Ranked:
    """Sort key: position of the value in a fixed list, other values last."""

    column: str
    values: tuple[str, ...]


@dataclass(frozen=True)
class EventConfig:
    """What differs between two deployments of one family.

    ``dedup`` says what becomes of questions with equal texts: ``last`` lets them share a
    column, where the last answer wins, ``suffix`` gives each one of its own, ``x (#2)``.
    """

    time_zone: str = "Europe/Berlin"
    width_cap: int = 30
    interval_minutes: float = 15
    run_once: bool = False
    report_format: str = "parquet"
    blank_is_null: bool = True
    dedup: str = "last"
    status_folder: str = "Technische_Details"


@dataclass(frozen=True)
class ReportSpec:
    """One report.

    ``step`` is an own ``DataFrame -> DataFrame`` after the filter. ``ties`` completes
    the sort keys to a total order. With ``numbers="keep"`` the report keeps the
    numbers of its source, whose order it shares. ``costly`` rows are written once before
    they are numbered, where a step takes more than the scans that numbering makes.
    """

    name: str
    source: str
    columns: tuple[str, ...]
    folder: str = ""
    where: tuple[Where, ...] = ()
    step: Callable[[DataFrame], DataFrame] | None = None
    order: tuple[str | Ranked, ...] = ()
    ties: tuple[str, ...] = ORDINAL
    group: str | None = None
    redact: tuple[str, ...] = ()
    numbers: str = "new"
    first_number: int = 1
    costly: bool = False
    keep: tuple[str, ...] = field(default=(), repr=False)

    @property
    def path(self) -> str:
        return f"{self.folder}/{self.name}" if self.folder else self.name

    @property
    def read(self) -> set[str]:
        """Columns of the source this report is made from."""
        keys = {k.column if isinstance(k, Ranked) else k for k in self.order}
        group = {self.group} if self.group else set()
        numbers = {NUMBER} if self.numbers == "keep" else set()
        filters = {w.column for w in self.where}
        return {*self.columns, *keys, *self.ties, *self.keep, *filters, *group, *numbers}

    def narrowed(self, names: Iterable[str]) -> ReportSpec:
        """The same report with fewer columns shown."""
        wanted = set(names)
        return replace(self, columns=tuple(c for c in self.columns if c in wanted))


def filtered(df: DataFrame, where: Sequence[Where]) -> DataFrame:
    """Rows that meet all conditions; the columns must exist."""
    require(df, [w.column for w in where])
    for w in where:
        df = df.where(w.condition())
    return df


def lint(spec: ReportSpec, available: Sequence[str]) -> list[str]:
    """What a report asks for in vain, and what would make it fail."""
    have = set(available)
    notes = [f"{spec.name}: no column {c!r}" for c in spec.columns if c not in have]
    doubled = sorted({c for c in spec.columns if spec.columns.count(c) > 1})
    notes += [f"{spec.name}: column {c!r} twice" for c in doubled]
    keys = [k.column if isinstance(k, Ranked) else k for k in spec.order]
    needed = [*keys, *[w.column for w in spec.where], *([spec.group] if spec.group else [])]
    notes += [f"{spec.name}: needs column {c!r}" for c in needed if c not in have]
    return notes


def run_spec(spec: ReportSpec, sources: Mapping[str, DataFrame]) -> DataFrame:
    """The report as a table; with ``keep`` also the columns later reports sort by."""
    df = filtered(sources[spec.source], spec.where)
    if spec.step is not None:
        df = df.transform(spec.step)

    shown = [c for c in spec.columns if c in df.columns]
    # A group of grouped reports comes first; the sink turns it into a folder.
    if spec.group and spec.group not in shown:
        shown = [spec.group, *shown]
    if spec.numbers == "keep":
        result = df.select(NUMBER, *map(quoted, [*spec.keep, *shown]))
    elif spec.order:
        keys = [k.column if isinstance(k, Ranked) else k for k in spec.order]
        order: list[Column] = [
            rank_of(quoted(name), key.values) if isinstance(key, Ranked) else quoted(name)
            for key, name in zip(spec.order, keys)
        ]
        carried = [c for c in dict.fromkeys([*spec.ties, *spec.keep, *keys]) if c not in shown]
        rows = df.select(*map(quoted, [*shown, *carried]))
        numbered = number_rows(
            pin(rows, "rows") if spec.costly else rows,
            [*order, *map(quoted, spec.ties)],
            into=NUMBER,
            start=spec.first_number,
            group=[spec.group] if spec.group else (),
            drop=[c for c in carried if c not in spec.keep],
        )
        result = numbered.select(NUMBER, *map(quoted, [*spec.keep, *shown]))
    else:
        result = select_known(df, [*spec.keep, *shown])
    return drop_columns(result, spec.redact) if spec.redact else result


def with_folder(df: DataFrame, spec: ReportSpec) -> DataFrame:
    """The report with its path as a column."""
    return df.withColumn("path", F.lit(spec.path))
