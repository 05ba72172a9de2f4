"""Vectors as short codes: one codebook entry for each of their parts, found exactly.

For every dimension of a part the coordinates of the codebook are sorted and carry prefix
masks: a bit for each entry up to there. A radius around a coordinate selects a range of
that order, and the two masks at its ends give the entries inside. The first radius is the
distance to one entry, near in the widest dimension; no entry outside that radius in any
dimension can be nearer. The masks of all dimensions ANDed are thus all candidates, which
are compared in integers.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.tables import matched, ship
from rollcall.llm.vectors import SUMS, LONG_MAX, Sums, as_array, capped, floored, integers, lists, matrix_of, means, squared, whole
from rollcall.session import pin

Batches = Iterator[pa.RecordBatch]


@dataclass(frozen=True)
class Settings:
    """Parameters of a compression."""

    parts: int = 8
    #: Entries of a part's codebook, a bit each of a 64-bit mask.
    entries: int = 16
    rounds: int = 6
    dims: int = 64
    #: A component x becomes floor(scale * x).
    scale: int = 4096

    def __post_init__(self) -> None:
        if not 0 < self.entries <= 64 or self.dims % self.parts:
            raise ValueError("a mask has 64 bits, and parts are equally long")


class Slices:
    """A codebook, sorted by every dimension."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, order, axis=0)
        bits = np.left_shift(np.uint64(1), order.astype(np.uint64))
        self.prefix = np.vstack([np.zeros((1, entries.shape[1]), dtype=np.uint64), np.bitwise_or.accumulate(bits, axis=0)])
        self.widest = int(np.argmax(self.sorted[-1] - self.sorted[0]))
        self.by_widest = order[:, self.widest]

    def near(self, points: np.ndarray) -> np.ndarray:
        """An entry whose coordinate in the widest dimension is next to the point's."""
        coordinates, x = self.sorted[:, self.widest], points[:, self.widest]
        right = np.minimum(np.searchsorted(coordinates, x), len(coordinates) - 1)
        left = np.maximum(right - 1, 0)
        return self.by_widest[np.where(x - coordinates[left] < coordinates[right] - x, left, right)]

    def candidates(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """A mask of the entries that differ by at most the radius in every dimension."""
        mask = np.full(len(points), ~np.uint64(0))
        for j in range(points.shape[1]):
            low = np.searchsorted(self.sorted[:, j], points[:, j] - radius, side="left")
            high = np.searchsorted(self.sorted[:, j], points[:, j] + radius, side="right")
            mask &= self.prefix[high, j] ^ self.prefix[low, j]
        return mask

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each point, the lower index in a tie, and the squared distance."""
        best = self.near(points)
        distance = squared(points, self.entries[best])
        mask = self.candidates(points, root(distance))
        for e in range(len(self.entries)):
            rows = np.nonzero((mask >> np.uint64(e)) & np.uint64(1))[0]
            d = squared(points[rows], self.entries[e])
            wins = (d < distance[rows]) | ((d == distance[rows]) & (e < best[rows]))
            distance[rows[wins]], best[rows[wins]] = d[wins], e
        return best, distance


def root(values: np.ndarray) -> np.ndarray:
    """Integer square roots, never too small."""
    if values.dtype == object:
        return np.array([math.isqrt(int(v)) for v in values], dtype=object)
    return np.sqrt(values.astype(np.float64)).astype(np.int64) + 1


def _kept(settings: Settings) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            keep, matrix = whole(batch.column("vector"), settings.dims)
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").filter(mask), batch.column("label").filter(mask),
                 lists(floored(matrix, settings.scale))],
                ["vec_id", "label", "point"],
            )

    return run


def _parts(batch: pa.RecordBatch, books: list[np.ndarray], settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Points, entries and squared distances of one part after the other."""
    points = integers(matrix_of(batch.column("point"), settings.dims))
    for mine, book in zip(np.split(points, settings.parts, axis=1), books):
        if mine.dtype != book.dtype:
            mine, book = mine.astype(object), book.astype(object)
        yield mine, *Slices(book).nearest(mine)


def _sums(books: list[np.ndarray], settings: Settings) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        sums = Sums(settings.parts, len(books[0]), settings.dims // settings.parts)
        for batch in batches:
            for part, (points, entry, _) in enumerate(_parts(batch, books, settings)):
                sums.add(part, points, entry)
        yield from sums.batches()

    return run


def _coded(books: list[np.ndarray], settings: Settings) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = list(_parts(batch, books, settings))
            entries = np.stack([entry for _, entry, _ in found], axis=1).astype(np.uint8)
            error = capped(np.sum([distance for _, _, distance in found], axis=0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array([row.tobytes().hex() for row in entries], pa.string()), pa.array(error)],
                ["vec_id", "label", "code", "error"],
            )

    return run


def compress(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of each kept vector.

    Needs ``vec_id``, ``vector``, an array of numbers, and ``label``; other columns are not
    read. Null vectors and those with a null or non-finite component are left out, and so
    are those of another length than ``dims``, whose parts could not be compared. Codebooks
    start as the parts of the vectors of smallest id; ids that repeat are ordered by their
    vectors, rows without an id come last. With fewer vectors than entries there are as
    many entries as vectors. Rows without a label are one label. Repeated rows stay and
    count each. An empty table, or one without a whole vector, gives no rows.

    Results are exact for components up to 2**61 after scaling, larger ones count as that;
    an error or sum beyond a long is given as the largest long.

    Each round reads the stored rows once. Tasks send sums per entry, not vectors; the
    driver sees the codebooks only. Errors by label combine before they shuffle, and a
    label of very many rows gets its sum by broadcast (``tables.matched``).
    """
    spark = ship(vectors.sparkSession)
    vectors = vectors.select("vec_id", "label", F.col("vector").cast("array<double>").alias("vector"))
    types = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}
    named = f"vec_id {types['vec_id']}, label {types['label']}"
    rows = pin(vectors.mapInArrow(_kept(settings), f"{named}, point array<double>"), "points")

    first = rows.select("vec_id", "point").orderBy(F.col("vec_id").asc_nulls_last(), "point").limit(settings.entries).collect()
    width = settings.dims // settings.parts
    books = [[[int(x) for x in r.point[p * width : (p + 1) * width]] for r in first] or [[0] * width] for p in range(settings.parts)]
    for _ in range(settings.rounds):
        books = means(rows.mapInArrow(_sums([as_array(b) for b in books], settings), SUMS), books)

    coded = pin(rows.mapInArrow(_coded([as_array(b) for b in books], settings), f"{named}, code string, error bigint"), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG_MAX).cast("decimal(38,0)")).cast("bigint")
    by_label = pin(coded.groupBy("label").agg(total.alias("label_error"), F.count("*").alias("n")), "labels")
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest() if first else None
    return matched(coded, by_label, ["label"], coded.count()).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
