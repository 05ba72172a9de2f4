"""Lines that many documents share, dropped from all documents but one.

Lines are exploded with their position; a long line is known by two 64-bit hashes of its
normal form. Documents per hash are counted, and where there are enough of them the line
goes from every document except the one of largest id. The positions to drop come back to
each document as one list, which takes its lines apart and joins the rest in order.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.tables import matched, ship
from rollcall.session import pin

#: Stripped at both ends of a line: space, and tab to carriage return.
BLANK = " \t\n\x0b\f\r"


@dataclass(frozen=True)
class Settings:
    """Which lines are dropped."""

    #: Least code points of a normal form.
    shortest: int = 40
    #: Least documents that hold it.
    documents: int = 5


def normal_form(line: Column) -> Column:
    """The line without blanks at its ends, A-Z in lower case; other letters stay as they are."""
    bare = F.btrim(line, F.lit(BLANK))
    # Lower-casing is much faster than translating, and the same where all is ASCII.
    ascii_only = F.octet_length(bare) == F.length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(
        F.translate(bare, string.ascii_uppercase, string.ascii_lowercase)
    )


def long_lines(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, text_hash, at, h1, h2`` for each line whose normal form is long enough."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("at", "line"))
    # No normal form is longer than its line.
    lines = lines.where(F.length("line") >= settings.shortest).withColumn("key", normal_form(F.col("line")))
    return lines.where(F.length("key") >= settings.shortest).select(
        "doc_id", "text_hash", "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    )


def shared_lines(lines: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``h1, h2, keeper, n`` of each line that enough documents hold.

    ``keeper`` is the largest id that holds it, ``n`` how often it occurs. Both steps
    combine before they shuffle, so a line of a third of all documents is a row a task.
    """
    held = lines.groupBy("h1", "h2", "doc_id").agg(F.count("*").alias("lines"))
    return held.groupBy("h1", "h2").agg(
        F.count("*").alias("documents"), F.max("doc_id").alias("keeper"), F.sum("lines").alias("n")
    ).where(F.col("documents") >= settings.documents).drop("documents")


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the lines at the given positions."""
    for batch in batches:
        texts, n_lines, n_dropped = [], [], []
        for text, positions in zip(batch.column("text").to_pylist(), batch.column("drop").to_pylist()):
            lines = (text or "").split("\n")
            gone = set(positions or ())
            texts.append("\n".join(line for at, line in enumerate(lines) if at not in gone) if gone else text or "")
            n_lines.append(len(lines))
            n_dropped.append(len(gone))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(texts, pa.string())],
            ["doc_id", "n_lines", "n_dropped", "text"],
        )


def drop_shared(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, n_lines, n_dropped, text`` for each row of ``docs``, ``text`` without shared lines.

    Needs ``doc_id`` and ``text``; other columns are not read. A null or empty text is one
    empty line and stays empty. Rows with equal id are one document: together they count
    once, and as the largest holder all of them keep the line. Rows without an id are one
    document too, whose id is smaller than any other. Repeated rows stay. An empty table
    gives no rows.

    A line goes through two shuffles as a few numbers, a text through one; lines of very
    many documents are matched by a broadcast of at most 1024 hashes, never in one task.
    """
    spark = ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    lines = pin(long_lines(docs, settings), "lines")
    shared = pin(shared_lines(lines, settings), "shared")
    found = matched(lines, shared, ["h1", "h2"], lines.count()).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    # Rows equal in id and text lose the same lines.
    dropped = found.groupBy(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).agg(F.collect_set("at").alias("drop"))
    keyed = docs.withColumn("text_hash", F.xxhash64("text"))
    same = keyed["doc_id"].eqNullSafe(dropped["id"]) & (keyed["text_hash"] == dropped["hash"])
    return keyed.join(dropped, same, "left").select("doc_id", "text", "drop").mapInArrow(
        _without, "doc_id bigint, n_lines bigint, n_dropped bigint, text string"
    )
