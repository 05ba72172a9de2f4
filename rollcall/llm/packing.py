"""Documents put into shards that are equal in bytes, tokens and rows at once.

Equal texts make up a group and stay together, so that a shard compresses well, unless a
group is large for a shard. Groups are vectors of bytes, tokens and rows; each goes to the
shard where its dot product with what the shard has left is highest, large ones first.

Choosing one after the other needs one place, so what is chosen there has a bounded number:
groups with more than a small share of anything are placed one by one, and there can only be
so many of these; all others are put into a fixed number of bundles by a hash of the text,
and the bundles are placed. Rows never come to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall.llm.mixing import words_in
from rollcall.session import pin

DIMENSIONS = ("bytes", "tokens", "rows")


@dataclass(frozen=True)
class Settings:
    """Parameters of a packing."""

    shards: int = 40
    #: Bytes of a row besides its text.
    row_bytes: int = 16
    #: Groups with more than this part of a shard in any dimension are placed by themselves.
    single: float = 1 / 64
    #: Groups with more than this part of a shard are cut, into pieces of about that part.
    cut: float = 0.5
    piece: float = 1 / 16
    #: Bundles for all other groups.
    bundles: int = 8192
    #: Rows numbered in one task.
    rows_per_run: int = 100_000


def place(vectors: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each vector; each dimension is scaled so that a full shard holds one.

    Large vectors come first. Among the shards with room in every dimension the highest dot
    product of the vector with the room left wins, then the lowest number. Where no shard has
    room, the one is taken whose scarcest dimension is left with most.
    """
    room = np.ones((shards, vectors.shape[1]))
    out = np.zeros(len(vectors), dtype=np.int64)
    for i in np.lexsort((np.arange(len(vectors)), -vectors.max(axis=1, initial=0))):
        left = (room - vectors[i]).min(axis=1)
        out[i] = np.argmax(np.where(left >= 0, room @ vectors[i], -1.0) if (left >= 0).any() else left)
        room[out[i]] -= vectors[i]
    return out


def _scaled(units: np.ndarray, totals: np.ndarray, shards: int) -> np.ndarray:
    return units / np.maximum(totals, 1) * shards


def _sums() -> list[Column]:
    return [F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]


def pack(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, tokens`` for each row of ``docs``.

    Needs ``doc_id`` and ``text``; other columns are not read. The law is ``bytes``: sizes
    of shards are near equal, as far as single rows allow. A null text has the size, the
    checksum and the group of an empty one. Slots of a shard count from 0 without gaps;
    repeated rows get slots of their own, and are spread like others where many share an id or
    have none. Rows without an id come first in their run. An empty table gives no rows.
    """
    spark, shards = docs.sparkSession, settings.shards
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = pin(
        docs.select(
            "doc_id", (F.octet_length(text) + settings.row_bytes).cast("bigint").alias("bytes"), words_in(text).alias("tokens"),
            F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("text_hash"),
            # Tells rows apart that share an id or have none; fixed once it is written.
            F.monotonically_increasing_id().alias("place"),
        ),
        "sizes",
    )
    totals = rows.agg(*_sums()).first()
    totals = np.array([totals[d] or 0 for d in DIMENSIONS], dtype=float)
    share = F.greatest(*[F.col(d) / F.lit(max(t, 1.0)) for d, t in zip(DIMENSIONS, totals)]) * shards
    # Shares of one dimension sum up to the number of shards, so at most 3 * shards / single rows,
    # and as many pieces as 3 * shards / piece besides.
    single = rows.groupBy("text_hash").agg(*_sums()).where(share > settings.single)
    pieces = F.when(share > settings.cut, F.ceil(share / settings.piece)).otherwise(F.lit(1).cast("bigint"))
    single = single.select("text_hash", pieces.alias("pieces"))
    salt = F.pmod(F.xxhash64("place", F.lit(1)), F.col("pieces"))
    united = rows.join(F.broadcast(pin(single, "single")), "text_hash", "left").select(
        "doc_id", "bytes", "tokens", "text_crc32", "place",
        F.when(F.col("pieces").isNull(), F.pmod("text_hash", F.lit(settings.bundles))).otherwise(F.col("text_hash")).alias("unit"),
        F.when(F.col("pieces").isNull(), F.lit(-1).cast("bigint")).otherwise(salt).alias("piece"),
    )
    united = pin(united, "united")
    # As many as bundles and pieces of single groups, a number the settings bound.
    units = sorted(tuple(r) for r in united.groupBy("unit", "piece").agg(*_sums()).collect())
    vectors = np.array([u[2:] for u in units], dtype=float).reshape(-1, len(DIMENSIONS))
    shard = place(_scaled(vectors, totals, shards), shards)
    filled, placed = [0] * shards, []
    for (unit, piece, _, _, n), at in zip(units, shard.tolist()):
        placed.append((unit, piece, at, filled[at], -(-n // settings.rows_per_run)))
        filled[at] += n
    places = spark.createDataFrame(placed, "unit bigint, piece bigint, shard int, base bigint, runs bigint")

    with_run = united.join(F.broadcast(places), ["unit", "piece"]).withColumn(
        "run", F.pmod(F.xxhash64("place", F.lit(2)), F.col("runs"))
    )
    runs = with_run.groupBy("unit", "piece", "run").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("unit", "piece").orderBy("run").rowsBetween(W.unboundedPreceding, -1))
    runs = runs.select(
        F.col("unit").alias("u"), F.col("piece").alias("p"), F.col("run").alias("r"), F.coalesce(before, F.lit(0)).alias("before")
    )
    in_run = F.row_number().over(W.partitionBy("unit", "piece", "run").orderBy("doc_id", "text_crc32")) - 1
    same = (F.col("unit") == F.col("u")) & (F.col("piece") == F.col("p")) & (F.col("run") == F.col("r"))
    return with_run.withColumn("in_run", in_run).join(runs, same).select(
        "doc_id", F.col("bytes").alias("size"), "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("base") + F.col("before") + F.col("in_run")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "tokens",
    )
