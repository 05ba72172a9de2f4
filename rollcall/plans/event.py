"""One run of an event: landing to reports, manifest and run log."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall import __version__
from rollcall.operators.counting import LABEL, choices_and_observed
from rollcall.operators.numbering import number_rows
from rollcall.operators.shaping import quoted, widen
from rollcall.plans import camp_h, camp_l, camp_t, day_j
from rollcall.plans.common import CountSpec, Family, Known
from rollcall.plans.spec import NUMBER, EventConfig, ReportSpec, lint, run_spec
from rollcall.session import configure, pin, scratch
from rollcall.sinks.reports import (
    FOLDER,
    append_rows,
    check_manifest,
    manifest,
    width_profile,
    with_stored,
    write_groups,
    write_report,
)
from rollcall.sinks.runs import FAILED, SUCCESS, UNCHANGED, last_run, record_run
from rollcall.sources.catalogue import (
    answered_questions,
    check_details,
    question_ids,
    question_texts,
    read_choices,
    read_items,
    read_question_details,
    read_questions,
    wide_columns,
    with_unique_texts,
)
from rollcall.sources.landings import Landing, Seen, all_parsed, look
from rollcall.sources.pages import check_complete
from rollcall.sources.registrations import FIXED_COLUMNS, ORDINAL, require_rows, tickets, with_item_names

FAMILIES: Mapping[str, Family] = {
    f.name: f for f in (camp_h.FAMILY, camp_l.FAMILY, camp_t.FAMILY, day_j.FAMILY)
}


@dataclass
class Inputs:
    """What the reports of a snapshot are made from; the positions are parsed and pinned."""

    positions: DataFrame
    items: DataFrame
    questions: DataFrame
    known: Known
    choices: DataFrame

    @property
    def raw(self) -> DataFrame:
        """The tickets, numbered from 0 in input order, with the names of their items."""
        numbered = number_rows(tickets(self.positions), ORDINAL, into=NUMBER, start=0)
        return with_item_names(numbered, self.items, NUMBER)


def number_tickets(flat: DataFrame) -> DataFrame:
    """Tickets of a flat table, numbered from 0 in input order; incomplete pages fail.

    Parsed once and pinned, as checking and numbering read it again.
    """
    parsed = pin(flat, "flat")
    begins = (F.coalesce("order_pos", F.lit(0)) == 0) & (F.coalesce("position_pos", F.lit(0)) == 0)
    check_complete(parsed.select("page_no", "next", "order_pos", "position_pos"), begins)
    return number_rows(require_rows(tickets(parsed)), ORDINAL, into=NUMBER, start=0)


def read_inputs(
    spark: SparkSession, family: Family, landing: Landing, seen: Seen, config: EventConfig = EventConfig()
) -> Inputs:
    """The collections of a snapshot; pages of orders that were read now are not parsed again."""
    questions = read_questions(spark, landing.path("questions"), landing.lines)
    details = read_question_details(spark, landing.path("question_details"))
    check_details(questions, details, family.place_question)
    # Choices are those of all questions of the text, however their columns are named.
    choices = family.edit_choices(read_choices(questions, details, family.place_question))
    if config.dedup == "suffix":
        questions = pin(with_unique_texts(questions), "questions")
    return Inputs(
        positions=all_parsed(spark, landing, seen),
        items=read_items(spark, landing.path("items"), landing.lines),
        questions=questions,
        known=question_ids(questions, family.questions),
        choices=choices,
    )


def raw_report(raw: DataFrame, questions: DataFrame) -> DataFrame:
    """The raw table with one column per question."""
    answered = answered_questions(raw, questions, ORDINAL)
    columns = wide_columns(list(answered), question_texts(questions), list(FIXED_COLUMNS))
    return widen(
        raw.select(NUMBER, *FIXED_COLUMNS, "answers"), "answers", columns, answered, ids=answered
    )


def clean_table(family: Family, raw: DataFrame, known: Known, config: EventConfig) -> DataFrame:
    if family is day_j.FAMILY and not config.blank_is_null:
        known = day_j.answered(raw, known)
    return family.clean(raw, known, config)


def needed_reports(family: Family, only: str | None) -> list[ReportSpec | CountSpec]:
    """All reports, or one with those it is made from, cut to what it shows of them."""
    if only is None:
        return list(family.reports)
    by_name = {spec.name: spec for spec in family.reports}
    chain = [by_name[only]]
    while chain[0].source in by_name:
        chain.insert(0, by_name[chain[0].source].narrowed(chain[0].read))
    return chain


def build_reports(
    family: Family,
    clean: DataFrame,
    choices: DataFrame,
    only: str | None = None,
    hold: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
) -> dict[str, tuple[ReportSpec | CountSpec, DataFrame]]:
    """The reports of a family over its clean table, each possibly made from earlier ones.

    ``hold`` is given each report that others are made from: pin it where several are
    written, else each of them numbers its rows anew.
    """
    sources = {"clean": clean}
    built = {}
    needed = needed_reports(family, only)
    for spec in needed:
        if isinstance(spec, CountSpec):
            df = spec.run(sources, choices)
        else:
            df = run_spec(spec, sources)
            if any(other.source == spec.name for other in needed):
                df = hold(df, "numbered")
            sources[spec.name] = df
        built[spec.name] = (spec, df)
    return built


def published(df: DataFrame) -> DataFrame:
    """A report without the columns that only carry its order."""
    return df.select([quoted(c) for c in df.columns if c not in ORDINAL])


SCHEMA_SCHEMA = "run_id string, path string, schema string"


def _available(spec: ReportSpec, clean: DataFrame, reports: Mapping[str, tuple]) -> list[str]:
    return clean.columns if spec.source == "clean" else reports[spec.source][1].columns


def _stored_schema(spec: ReportSpec | CountSpec, shown: DataFrame) -> str:
    """The schema a report is read back with; that of groups has their folder besides."""
    grouped = getattr(spec, "group", None) is not None
    return (shown.withColumn(FOLDER, F.lit("")) if grouped else shown).schema.json()


def _append(spark: SparkSession, rows: list[tuple], schema: str, path: str) -> None:
    if rows:
        append_rows(spark.createDataFrame(rows, schema).coalesce(1), path)


def write_reports(
    family: Family, inputs: Inputs, config: EventConfig, root: str, run_id: str, out: str
) -> None:
    """Write everything below ``root``, then list it in the manifest."""
    spark, fmt = inputs.positions.sparkSession, config.report_format
    raw_name = "Raw_Data" if family is day_j.FAMILY else "Unsortiert/Rohdaten"
    tickets_in_order = pin(inputs.raw, "raw")
    raw = raw_report(tickets_in_order, inputs.questions)
    # As columns, so that a report that needs few of them reads no more.
    clean = pin(clean_table(family, tickets_in_order, inputs.known, config), "clean")
    reports = build_reports(family, clean, inputs.choices, hold=pin)

    notes = [n for spec, _ in reports.values() if isinstance(spec, ReportSpec) for n in lint(spec, _available(spec, clean, reports))]
    _append(spark, [(run_id, n) for n in notes], "run_id string, note string", f"{out}/_notes")
    schemas = [(run_id, spec.path, _stored_schema(spec, published(df))) for spec, df in reports.values()]
    _append(spark, [(run_id, raw_name, raw.schema.json()), *schemas], SCHEMA_SCHEMA, f"{out}/_schemas")

    written = [(raw_name, raw)]
    write_report(raw, f"{root}/{raw_name}", fmt, NUMBER if fmt == "csv" else None)
    groups = None
    for spec, df in reports.values():
        shown = published(df)
        group = getattr(spec, "group", None)
        if group is None:
            write_report(shown, f"{root}/{spec.path}", fmt, NUMBER if fmt == "csv" else None)
            written.append((spec.path, shown))
            continue
        labels = choices_and_observed(inputs.choices, shown, group)
        sizes = shown.groupBy(quoted(group).alias(LABEL)).agg(F.count("*").alias("rows"))
        entries = check_manifest(manifest(spec.name, spec.path, labels, sizes))
        write_groups(shown, f"{root}/{spec.path}", group, NUMBER, fmt)
        entries = with_stored(entries, run_id, grouped=True)
        groups = entries if groups is None else groups.unionByName(entries)

    singles = None
    for name, df in written:
        stored = spark.read.schema(df.schema).format(fmt).options(header=True, multiLine=True).load(f"{root}/{name}")
        line = stored.agg(F.count("*").alias("rows")).select(
            F.lit(name.split("/")[-1]).alias("report"), F.lit(None).cast("string").alias("label"),
            F.lit(name).alias("path"), "rows",
        )
        singles = line if singles is None else singles.unionByName(line)
    singles = with_stored(singles, run_id, grouped=False)
    entries = singles if groups is None else singles.unionByName(groups)
    append_rows(entries.withColumn("run_id", F.lit(run_id)), f"{out}/_manifest")
    widths = None
    for name, df in written:
        profile = width_profile(df, config.width_cap, (NUMBER,)).withColumn("path", F.lit(name))
        widths = profile if widths is None else widths.unionByName(profile)
    append_rows(widths.withColumn("run_id", F.lit(run_id)), f"{out}/_widths")


def state_of(seen: Seen, family: Family, config: EventConfig) -> str:
    """A checksum of all that the reports are made from.

    Besides the landed pages these are what the family, the configuration and this
    version make of them.
    """
    shown = (config.time_zone, config.width_cap, config.report_format, config.blank_is_null, config.dedup)
    parts = [seen.checksum, family.name, family.place_question, *map(str, shown), __version__]
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


def was_stopped(error: Exception) -> bool:
    """Whether a run ended because somebody ended it, which is no outcome of its own."""
    return any(sign in str(error) for sign in ("cancelled as part of cancellation", "InterruptedException", "SparkContext was shut down"))


def run_event(
    spark: SparkSession,
    family: Family,
    landing: Landing,
    out: str,
    config: EventConfig = EventConfig(),
    run_id: str | None = None,
) -> str:
    """Run once and record the outcome: ``success``, ``unchanged`` or ``failed``.

    Reports go to a folder of their own per run. They become current with the run
    record, so that a run that fails half way changes nothing for readers. Input
    that equals the last one is skipped, unless the last run failed. A run that somebody
    stops leaves no record, as it has no outcome. For the check of changes, pages that a run
    has read before are not even opened (``sources.landings``). Tables pinned on the way
    are removed at the end.
    """
    as_before = spark.conf.get("spark.sql.caseSensitive")
    configure(spark, case_sensitive=True)
    run_id = run_id or uuid.uuid4().hex
    rows = checksum = None
    try:
        with scratch(spark):
            seen = look(spark, landing, out)
            state, last = state_of(seen, family, config), last_run(spark, out)
            if last and last["status"] != FAILED and last["checksum"] == state:
                outcome, error = UNCHANGED, None
            else:
                inputs = read_inputs(spark, family, landing, seen, config)
                write_reports(family, inputs, config, f"{out}/{run_id}", run_id, out)
                outcome, error = SUCCESS, None
            rows, checksum = seen.rows, state
    except Exception as e:  # the run log takes every failure, as the next run depends on it
        if was_stopped(e):
            raise
        outcome, error = FAILED, f"{type(e).__name__}: {e}"
    finally:
        spark.conf.set("spark.sql.caseSensitive", as_before)
    record_run(spark, out, run_id, config.time_zone, outcome, error, rows, checksum)
    return outcome


def current_report(spark: SparkSession, out: str, path: str, fmt: str = "parquet") -> DataFrame:
    """A report as of the last successful run."""
    run = last_run(spark, out, SUCCESS)
    if run is None:
        raise ValueError(f"no successful run in {out}")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        # Written as text: read with the types it had, and over line breaks inside texts.
        known = spark.read.schema(SCHEMA_SCHEMA).parquet(f"{out}/_schemas")
        schema = known.where((F.col("run_id") == run["run_id"]) & (F.col("path") == path)).first()["schema"]
        reader = reader.schema(T.StructType.fromJson(json.loads(schema))).options(header=True, multiLine=True)
    return reader.load(f"{out}/{run['run_id']}/{path}")
