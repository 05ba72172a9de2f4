"""Exact k-means over integer vectors, most distances left out by a rotation.

The vectors are rotated by the principal axes of the whole table. Each is stored with its
leading rotated coordinates and the norm of the rest. The squared distance of the leading
coordinates plus the squared difference of the rest norms is never more than the squared
distance itself, so a centroid whose bound exceeds the distance to another one cannot be
the nearest. Those that survive are compared in integers; the floating-point bounds carry a
margin above their rounding, so they decide nothing themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.tables import ship
from rollcall.llm.vectors import SUMS, LONG_MAX, Sums, as_array, capped, floored, integers, lists, matrix_of, means, squared, whole
from rollcall.session import pin

Batches = Iterator[pa.RecordBatch]

#: Bounds are lowered by this part of the squared norms, far above the rounding of 32-bit coordinates.
MARGIN = 1e-5


@dataclass(frozen=True)
class Settings:
    """Parameters of a clustering."""

    clusters: int = 8
    rounds: int = 10
    dims: int = 64
    #: A component x becomes floor(scale * x).
    scale: int = 1024
    #: Chooses the first centroids.
    seed: int = 3
    #: Rotated coordinates stored for the bounds.
    leading: int = 16


@dataclass(frozen=True)
class Rotation:
    """Mean of the vectors and their leading principal axes, in columns."""

    mean: np.ndarray
    axes: np.ndarray

    def project(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading coordinates, and the norm of what is left."""
        centred = points.astype(np.float64) - self.mean
        lead = centred @ self.axes
        return lead, np.sqrt(np.maximum((centred**2).sum(axis=1) - (lead**2).sum(axis=1), 0.0))


def _moments(settings: Settings) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        # Products of all pairs of components; a constant one more gives sums and the count.
        total = np.zeros((settings.dims + 1, settings.dims + 1))
        for batch in batches:
            _, matrix = whole(batch.column("vector"), settings.dims)
            points = np.hstack([floored(matrix, settings.scale), np.ones((len(matrix), 1))])
            total += points.T @ points
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total), dtype=np.int32)), lists(total)], ["i", "row"]
        )

    return run


def rotation(vectors: DataFrame, settings: Settings) -> Rotation:
    """The principal axes of all vectors; a few thousand sums come to the driver."""
    dims = settings.dims
    rows = vectors.mapInArrow(_moments(settings), "i int, row array<double>").select("i", F.posexplode("row").alias("j", "x"))
    total = np.zeros((dims + 1, dims + 1))
    for r in rows.groupBy("i", "j").agg(F.sum("x").alias("x")).collect():
        total[r.i, r.j] = r.x
    n = max(total[dims, dims], 1.0)
    mean = total[:dims, dims] / n
    spread = np.nan_to_num(total[:dims, :dims] / n - np.outer(mean, mean))
    _, axes = np.linalg.eigh((spread + spread.T) / 2)
    return Rotation(mean, axes[:, ::-1][:, : settings.leading])


def _rotated(found: Rotation, settings: Settings) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            keep, matrix = whole(batch.column("vector"), settings.dims)
            points = floored(matrix, settings.scale)
            lead, rest = found.project(points)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").filter(pa.array(keep)), lists(points),
                    lists(lead.astype(np.float32)), pa.array(rest),
                ],
                ["vec_id", "point", "lead", "rest"],
            )

    return run


def nearest(
    points: np.ndarray, lead: np.ndarray, rest: np.ndarray, centres: np.ndarray, found: Rotation
) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each point, the smaller number in a tie, and the squared distance.

    ``lead`` and ``rest`` are the stored projections of the points.
    """
    lead = lead.astype(np.float64)
    lead_c, rest_c = found.project(centres)
    norms = ((lead**2).sum(axis=1) + rest**2)[:, None] + (lead_c**2).sum(axis=1) + rest_c**2
    below = norms - 2 * (lead @ lead_c.T) - 2 * np.outer(rest, rest_c) - MARGIN * norms - 1
    best = below.argmin(axis=1)
    distance = squared(points, centres[best])
    survivors = below <= distance.astype(np.float64)[:, None]
    first = best.copy()
    for j in range(len(centres)):
        rows = np.nonzero(survivors[:, j] & (first != j))[0]
        d = squared(points[rows], centres[j])
        wins = (d < distance[rows]) | ((d == distance[rows]) & (j < best[rows]))
        distance[rows[wins]], best[rows[wins]] = d[wins], j
    return best, distance


def _assigned(batch: pa.RecordBatch, centres: np.ndarray, found: Rotation, settings: Settings) -> tuple[np.ndarray, ...]:
    points = integers(matrix_of(batch.column("point"), settings.dims))
    lead = matrix_of(batch.column("lead"), found.axes.shape[1])
    if centres.dtype != points.dtype:
        points, centres = points.astype(object), centres.astype(object)
    return points, *nearest(points, lead, batch.column("rest").to_numpy(), centres, found)


def _sums(centres: np.ndarray, found: Rotation, settings: Settings) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        sums = Sums(1, len(centres), settings.dims)
        for batch in batches:
            points, cluster, _ = _assigned(batch, centres, found, settings)
            sums.add(0, points, cluster)
        yield from sums.batches()

    return run


def _last(centres: np.ndarray, found: Rotation, settings: Settings) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            _, cluster, distance = _assigned(batch, centres, found, settings)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(capped(distance))],
                ["vec_id", "cluster", "distance"],
            )

    return run


def cluster(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of each kept vector.

    Needs ``vec_id`` and ``vector``, an array of numbers; other columns are not read. Null
    vectors, those of another length than ``dims`` and those with a null or non-finite
    component are left out. The first centroids are the vectors whose ids have the least
    hash; ids that repeat are ordered by their vectors, rows without an id come last. With
    fewer vectors than clusters there are as many clusters as vectors. Repeated rows stay
    and count each. An empty table, or one without a whole vector, gives no rows.

    Results are exact for components up to 2**61 after scaling, larger ones count as that;
    a distance or sum beyond a long is given as the largest long.

    Each round reads the stored rows once. Tasks send sums per cluster, not vectors, so a
    cluster of any size is one row a task; the driver sees the centroids only.
    """
    spark = ship(vectors.sparkSession)
    vectors = vectors.select("vec_id", F.col("vector").cast("array<double>").alias("vector"))
    found = rotation(vectors.select("vector"), settings)
    schema = f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, point array<double>, lead array<float>, rest double"
    rows = pin(vectors.mapInArrow(_rotated(found, settings), schema), "rotated")

    order = F.sha2(F.concat(F.lit(f"{settings.seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.select("point", order.alias("hash")).orderBy(F.col("hash").asc_nulls_last(), "point").limit(settings.clusters)
    centres = [[[int(x) for x in r.point] for r in first.collect()]]
    if not centres[0]:
        centres = [[[0] * settings.dims]]
    for _ in range(settings.rounds):
        centres = means(rows.mapInArrow(_sums(as_array(centres[0]), found, settings), SUMS), centres)

    named = schema.split(",")[0]
    last = pin(rows.mapInArrow(_last(as_array(centres[0]), found, settings), f"{named}, cluster int, distance bigint"), "clusters")
    sums = {r.cluster: int(r.total) for r in last.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres[0]]
    inertia = min(sum(sums.values()), LONG_MAX)
    # One row per cluster.
    about = spark.createDataFrame(
        [(j, min(sums.get(j, 0), LONG_MAX), inertia, digest) for j, digest in enumerate(digests)],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    return last.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
