"""Integer vectors from columns of arrays, and exact sums of them over a whole table."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Components below this size have squared distances of up to 64 components that fit 64 bits.
NARROW = 1 << 27
#: Larger components than this count as this.
WIDEST = 1 << 61
LONG_MAX = (1 << 63) - 1


def whole(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Which lists have ``dims`` components, none null or non-finite, and these as a matrix."""
    sized = pc.fill_null(pc.equal(pc.list_value_length(column), dims), False)
    flat = column.filter(sized).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    matrix = flat.reshape(-1, dims)
    fine = np.isfinite(matrix).all(axis=1)
    keep = sized.to_numpy(zero_copy_only=False).astype(bool)
    keep[keep] = fine
    return keep, matrix[fine]


def floored(matrix: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of each component as a double, which holds it exactly for a power of two."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(matrix * scale), -float(WIDEST), float(WIDEST))


def integers(matrix: np.ndarray) -> np.ndarray:
    """Whole doubles as 64-bit integers, or as Python's where squares would not fit."""
    out = matrix.astype(np.int64)
    return out if np.abs(matrix).max(initial=0) < NARROW else out.astype(object)


def lists(matrix: np.ndarray) -> pa.Array:
    """The rows of a matrix as lists."""
    n, dims = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * np.int32(dims)), pa.array(matrix.ravel()))


def matrix_of(column: pa.Array, dims: int) -> np.ndarray:
    """Lists that are known to be whole, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def capped(values: np.ndarray) -> np.ndarray:
    """Integers as longs; what does not fit counts as the largest long."""
    return np.minimum(values, LONG_MAX).astype(np.int64)


def squared(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows, each to the centre or to its own row of centres."""
    return ((points - centre) ** 2).sum(axis=1)


SUMS = "part int, entry int, dim int, total decimal(38,0), n bigint"


class Sums:
    """Sums of vectors by part and entry in one task; Python integers, so of any size."""

    def __init__(self, parts: int, entries: int, dims: int) -> None:
        self.total = np.zeros((parts, entries, dims), dtype=object)
        self.n = np.zeros((parts, entries), dtype=np.int64)

    def add(self, part: int, points: np.ndarray, entry: np.ndarray) -> None:
        """Add each point to the sum of its entry."""
        for e in np.unique(entry):
            mine = points[entry == e]
            self.total[part, e] += mine.sum(axis=0).astype(object)
            self.n[part, e] += len(mine)

    def batches(self) -> Iterator[pa.RecordBatch]:
        """Rows of ``SUMS``, one for each component of each entry that has points."""
        part, entry, dim = np.nonzero(np.broadcast_to((self.n > 0)[:, :, None], self.total.shape))
        totals = [Decimal(int(x)) for x in self.total[part, entry, dim]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x.astype(np.int32)) for x in (part, entry, dim)]
            + [pa.array(totals, pa.decimal128(38, 0)), pa.array(self.n[part, entry])],
            ["part", "entry", "dim", "total", "n"],
        )


def means(sums: DataFrame, before: list[list[list[int]]]) -> list[list[list[int]]]:
    """``before[part][entry]`` replaced by the floor of the mean, where there are points.

    Only one row per component of an entry comes to the driver.
    """
    after = [[list(entry) for entry in part] for part in before]
    for r in sums.groupBy("part", "entry", "dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        after[r.part][r.entry][r.dim] = int(r.total) // r.n
    return after


def as_array(centres: list[list[int]]) -> np.ndarray:
    """Centres as 64-bit integers, or as Python's where squares would not fit."""
    out = np.array(centres, dtype=object)
    return out if out.size and max(abs(x) for x in out.flat) >= NARROW else out.astype(np.int64)
