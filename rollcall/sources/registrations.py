"""Orders to one row per ticket position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.nested import embedded, pick_label, union_id
from rollcall.operators.lookup import lookup_name
from rollcall.sources.pages import ADDRESS

#: Place of a position in the input; every sort ends with it.
ORDINAL = ("page_no", "order_pos", "position_pos")

# Columns of the raw table, before the questions.
ORDER_COLUMNS = (
    "order_code", "status", "email", "total", "date", "invoice_name", "invoice_company",
    "invoice_street", "invoice_zipcode", "invoice_city", "invoice_country", "invoice_vat_id",
)
POSITION_COLUMNS = (
    "position_id", "item_id", "item_name", "price", "attendee_firstname", "attendee_lastname",
    "attendee_email", "attendee_street", "attendee_zipcode", "attendee_city", "attendee_country",
)
FIXED_COLUMNS = ORDER_COLUMNS + POSITION_COLUMNS

#: Label of a question that the catalogue does not name, before its id.
UNNAMED = "question_"


def _parts(struct: str, fields: list[str], prefix: str) -> list[Column]:
    """Fields of an optional object; without the object all of them are empty."""
    absent = F.col(struct).isNull()
    return [
        F.when(absent, F.lit("")).otherwise(F.col(f"{struct}.{f}")).alias(f"{prefix}{f}")
        for f in fields
    ]


def order_rows(pages: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """One row per order; a page without orders keeps one row without ``order_pos``.

    ``carried`` columns of the page come with each order.
    """
    fields = [f.split()[0] for f in ADDRESS.split(", ")]
    return pages.select(
        "page_no", "next", *carried, F.posexplode_outer("results").alias("order_pos", "o")
    ).select(
        "page_no", "next", *carried, "order_pos",
        F.col("o.code").alias("order_code"), "o.status", "o.email", "o.total",
        F.col("o.datetime").alias("date"),
        F.col("o.invoice_address").alias("invoice_address"),
        F.col("o.positions").alias("positions"),
    ).select("*", *_parts("invoice_address", fields, "invoice_")).drop("invoice_address")


def position_rows(orders: DataFrame) -> DataFrame:
    """One row per position, order columns repeated; the answers stay nested, by question id.

    Orders without positions keep one row without ``position_pos``, which carries
    their page until the pages have been checked.
    """
    kept = [c for c in orders.columns if c != "positions"]
    item = embedded("p.item")
    return orders.select(
        *kept, F.posexplode_outer("positions").alias("position_pos", "p")
    ).select(
        *kept, "position_pos",
        F.col("p.id").alias("position_id"),
        union_id("p.item").alias("item_id"),
        pick_label(item["name"]).alias("__item_name"),
        "p.price",
        *[
            F.when(F.col("p.attendee_name_parts").isNull(), F.lit(""))
            .otherwise(F.col(f"p.attendee_name_parts.{part}"))
            .alias(f"attendee_{name}")
            for part, name in (("given_name", "firstname"), ("family_name", "lastname"))
        ],
        F.col("p.attendee_email").alias("attendee_email"),
        *[F.col(f"p.{c}").alias(f"attendee_{c}") for c in ("street", "zipcode", "city", "country")],
        F.transform(
            F.coalesce("p.answers", F.array().cast("array<struct<question:string,answer:string>>")),
            lambda a: F.struct(union_id(a["question"]).alias("id"), a["answer"].alias("answer")),
        ).alias("answers"),
    )


def answer_rows(positions: DataFrame, order: Sequence[str] = ORDINAL) -> DataFrame:
    """Long form: one row per answer with its place, question id and text."""
    return positions.select(*order, F.posexplode("answers").alias("answer_pos", "a")).select(
        *order, "answer_pos", F.col("a.id").alias("question_id"), "a.answer"
    )


def named_answers(
    positions: DataFrame, questions: DataFrame, order: Sequence[str] = ORDINAL
) -> DataFrame:
    """The long form with the text of each question, for a catalogue of any size."""
    return lookup_name(answer_rows(positions, order), "question_id", questions, UNNAMED, "text")


def flat_positions(pages: DataFrame, items: DataFrame) -> DataFrame:
    """Raw table with ``answers`` by question id, ordinal and ``next``; see ``tickets``."""
    return with_item_names(position_rows(order_rows(pages)), items, "next")


def with_item_names(positions: DataFrame, items: DataFrame, *carried: str) -> DataFrame:
    """Positions with the name of their item: ordinal, ``carried``, fixed columns and answers."""
    named = lookup_name(positions, "item_id", items, "Item ", "item_name", embedded="__item_name")
    return named.select(*ORDINAL, *carried, *FIXED_COLUMNS, "answers")


def tickets(flat: DataFrame) -> DataFrame:
    """The rows of a checked flat table that are ticket positions."""
    return flat.where(F.col("position_pos").isNotNull()).drop("next")


def require_rows(df: DataFrame) -> DataFrame:
    """Fail on a table without rows."""
    if df.isEmpty():
        raise ValueError("no registrations were fetched")
    return df
