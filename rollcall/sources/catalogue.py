"""Questions, items and answer choices of an event."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions.nested import option_items, option_label, pick_label, typed_fields
from rollcall.functions.text import blank_to_null
from rollcall.operators.counting import LABEL, POSITION
from rollcall.operators.lookup import lookup_name, matching_text
from rollcall.operators.numbering import number_rows
from rollcall.operators.shaping import quoted, unique_name
from rollcall.sources.pages import ITEM, QUESTION, read_pages, records
from rollcall.sources.registrations import UNNAMED


def _named(pages: DataFrame, field: str) -> DataFrame:
    """``id, text, page_no, record_pos``; the last entry of an id wins."""
    place = F.struct("page_no", "record_pos")
    return (
        records(pages)
        .groupBy("id")
        .agg(
            F.max_by(pick_label(field), place).alias("text"),
            F.min(place).alias("place"),
        )
        .select("id", "text", "place.*")
    )


def read_questions(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    return _named(read_pages(spark, path, QUESTION, lines), "question")


def read_items(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    return _named(read_pages(spark, path, ITEM, lines), "name")


def question_texts(questions: DataFrame) -> list[str]:
    """Distinct question texts in catalogue order: the columns of a raw report."""
    ordered = (
        questions.groupBy("text")
        .agg(F.min(F.struct("page_no", "record_pos")).alias("place"))
        .orderBy("place")
    )
    return [r["text"] for r in ordered.select("text").collect()]


def question_ids(questions: DataFrame, texts: Iterable[str]) -> dict[str, list[int | None]]:
    """The ids of the questions with one of ``texts``; texts of no question are left out.

    Only entries of these texts leave the catalogue. ``question_<id>`` means the question
    of that id, if the catalogue does not name it.
    """
    wanted = list(dict.fromkeys(texts))
    unnamed = {int(m[1]): m[0] for m in (re.fullmatch(rf"{UNNAMED}(0|[1-9]\d{{0,17}})", t) for t in wanted) if m}
    if UNNAMED + "None" in wanted:
        unnamed[None] = UNNAMED + "None"
    known = F.col("text").isin(wanted) | F.col("id").isin([i for i in unnamed if i is not None])
    named = {r["id"]: r["text"] for r in questions.where(known).select("id", "text").collect() if r["id"] is not None}
    ids: dict[str, list[int | None]] = {}
    for i, text in (unnamed | named).items():
        ids.setdefault(text, []).append(i)
    return {t: ids[t] for t in wanted if t in ids}


def answered_questions(
    positions: DataFrame, questions: DataFrame, order: Sequence[str]
) -> dict[str, list[int | None]]:
    """Texts that have an answer, by first appearance, with the ids of their questions.

    One row per question leaves the aggregate: the columns of a raw report.
    """
    place = F.struct(*order, "__at")
    used = (
        positions.select(*order, F.posexplode("answers").alias("__at", "__a"))
        .groupBy(F.col("__a.id").alias("question_id"))
        .agg(F.min(place).alias("__place"))
    )
    named = lookup_name(used, "question_id", questions, UNNAMED, "label").orderBy("__place")
    ids: dict[str, list[int | None]] = {}
    for row in named.select("label", "question_id").collect():
        ids.setdefault(row["label"], []).append(row["question_id"])
    return ids


def answered_texts(positions: DataFrame, order: Iterable[str]) -> list[str]:
    """Keys of a map of answers that occur, by first appearance."""
    place = F.struct(*order, "__at")
    texts = (
        positions.select(*order, F.posexplode(F.map_keys("answers")).alias("__at", "__text"))
        .groupBy("__text")
        .agg(F.min(place).alias("__place"))
        .orderBy("__place")
    )
    return [r["__text"] for r in texts.select("__text").collect()]


def wide_columns(answered: list[str], catalogue: list[str], fixed: list[str]) -> dict[str, str]:
    """Column name per question text: answered ones first, then the rest.

    Only a question that nobody answered can meet a taken name; it gets a suffix.
    """
    names = {text: text for text in answered}
    taken = {*fixed, *answered}
    for text in catalogue:
        if text not in names:
            names[text] = unique_name(text, taken)
            taken.add(names[text])
    return names


def with_unique_texts(questions: DataFrame, text: str = "text", order: Sequence[str] = ("page_no", "record_pos")) -> DataFrame:
    """Equal texts told apart: ``x``, ``x (#2)``, ``x (#3)`` in catalogue order; null texts stay."""
    numbered = number_rows(questions, list(order), into="__n", group=[text])
    suffix = F.when(F.col("__n") == 1, "").otherwise(F.concat(F.lit(" (#"), "__n", F.lit(")")))
    return numbered.withColumn(text, F.concat(quoted(text), suffix)).drop("__n")


def read_question_details(spark: SparkSession, path: str) -> DataFrame:
    """Free-form question documents, one per file: ``id, document``."""
    return spark.read.text(path, wholetext=True).select(
        F.get_json_object("value", "$.id").cast("bigint").alias("id"),
        F.col("value").alias("document"),
    )


def choice_texts(documents: DataFrame) -> DataFrame:
    """Distinct readable options of question documents: one column ``label``."""
    options = (
        documents.select(typed_fields("document").alias("fields"))
        .select(F.explode(option_items("fields")).alias("option"))
        .select("option.*")
    )
    fields = typed_fields(F.when(F.col("kind").startswith("OBJECT"), F.col("text")))
    labelled = options.select("text", "kind", fields.alias("fields")).select(
        F.when(F.col("kind") == "STRING", blank_to_null("text"))
        .otherwise(option_label("fields"))
        .alias(LABEL)
    )
    return labelled.where(F.col(LABEL).isNotNull()).distinct()


def check_details(questions: DataFrame, details: DataFrame, text: str) -> None:
    """Fail unless every question with a text has its document."""
    missing = matching_text(questions, "text", text).select("id").join(details, "id", "left_anti")
    found = missing.orderBy("id").first()
    if found is not None:
        raise ValueError(f"no details of question {found['id']}")


def read_choices(questions: DataFrame, details: DataFrame, text: str) -> DataFrame:
    """Choices of all questions with a text, merged and sorted: ``label, position``."""
    ids = matching_text(questions, "text", text).select("id")
    labels = choice_texts(details.join(ids, "id", "left_semi"))
    return number_rows(labels, [LABEL], into=POSITION)
