"""Row numbers over a total order, in one wide shuffle and without a single-task sort.

Three narrow passes read the sort key alone: one counts rows, one samples keys, whose
quantiles are the bounds of ranges, and one, part of the plan, counts the rows of each
range. The whole rows then go through a single exchange by range, are sorted and numbered
in their range, and the rows before the range are added. The sort key ends in a unique
tie-break, so that even a value a third of all rows share is spread over many ranges. Bounds
decide only how evenly rows are dealt; numbers are right with any.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall.functions.text import as_column
from rollcall.operators.shaping import quoted

RANGE = "__range"
BOUNDS = "__bounds"
KEY = "__key"


@dataclass(frozen=True)
class Ranging:
    """How finely rows are cut into ranges; each is sorted by one task."""

    #: Rows of a range, where there are enough of them: 250 MB of memory for rows of 1 KB.
    rows: int = 1 << 18
    #: With fewer rows there are still as many ranges as the session shuffles to, of at least so many rows.
    least_rows: int = 1_000
    #: At most so many ranges, a bound on what the driver holds of a table of any size.
    most: int = 1 << 14
    #: Keys sampled for each range.
    sampled: int = 16


RANGING = Ranging()


def ascending(*columns: Column | str) -> list[Column]:
    """Sort keys, nulls last."""
    return [as_column(c).asc_nulls_last() for c in columns]


def sort_key(*columns: Column | str) -> Column:
    """The keys as one struct that compares as the rows sort: nulls last."""
    fields = []
    for i, c in enumerate(columns):
        fields += [as_column(c).isNull().alias(f"n{i}"), as_column(c).alias(f"k{i}")]
    return F.struct(*fields)


@dataclass(frozen=True)
class Bounds:
    """One row with the sorted array of keys at which a new range begins."""

    keys: DataFrame
    ranges: int


def range_bounds(df: DataFrame, keys: Sequence[Column | str], ranging: Ranging = RANGING) -> Bounds | None:
    """Quantiles of the sort key; none for a single range.

    Rows are sampled by a hash, so the sample is drawn where the rows are. About
    ``most * sampled`` keys at most meet in one task, of which ``most`` reach the driver.
    """
    spark = df.sparkSession
    rows = df.count()
    side_by_side = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(max(-(-rows // ranging.rows), min(side_by_side, -(-rows // ranging.least_rows))), ranging.most)
    if ranges < 2:
        return None
    wanted = min(1.0, ranges * ranging.sampled / rows)
    # A hash of the place too, as equal keys would otherwise all be in the sample or none.
    drawn = F.xxhash64(*keys, F.monotonically_increasing_id()) < F.lit(int((2 * wanted - 1) * (2**63 - 1)))
    sample = df.where(drawn).select(sort_key(*keys).alias("key")).agg(F.array_sort(F.collect_list("key")).alias("keys"))
    each = F.sequence(F.lit(1), F.lit(ranges - 1))
    at = F.transform(each, lambda i: F.get("keys", F.floor(i * F.size("keys") / ranges).cast("int")))
    found = sample.select(F.filter(at, lambda b: b.isNotNull()).alias(BOUNDS)).toArrow()
    n = len(found[BOUNDS][0])
    return Bounds(spark.createDataFrame(found, sample.select(F.col("keys").alias(BOUNDS)).schema), n + 1) if n else None


def with_range(df: DataFrame, keys: Sequence[Column | str], bounds: Bounds) -> DataFrame:
    """Add the number of bounds that are not above the row's key, by binary search.

    A projection per halving, so that the search is compiled with the rest of the plan.
    """
    found = df.withColumns({BOUNDS: bounds.keys.scalar(), KEY: sort_key(*keys), RANGE: F.lit(0)})
    for step in (1 << b for b in reversed(range((bounds.ranges - 1).bit_length()))):
        # Past the last bound ``get`` is null and the place stays.
        above = F.get(F.col(BOUNDS), F.col(RANGE) + (step - 1)) <= F.col(KEY)
        found = found.withColumn(RANGE, F.when(above, F.col(RANGE) + step).otherwise(F.col(RANGE)))
    return found.drop(BOUNDS, KEY)


@dataclass(frozen=True)
class Dealt:
    """Rows in one partition for each range of the sort key, the number of the range in ``column``."""

    rows: DataFrame
    column: str
    #: Rows of earlier ranges by range; none where there is a single one.
    before: DataFrame | None


def deal(df: DataFrame, keys: Sequence[Column | str], into: str = RANGE, groups: Sequence[Column] = (), ranging: Ranging = RANGING) -> Dealt:
    """Send each row to the range of its sort key."""
    bounds = range_bounds(df, keys, ranging)
    if bounds is None:
        return Dealt(df.repartitionById(1, F.lit(0)).withColumn(into, F.lit(0)), into, None)
    ranged = with_range(df, keys, bounds)
    dealt = ranged.repartitionById(bounds.ranges, F.col(RANGE))
    return Dealt(dealt.withColumnRenamed(RANGE, into), into, _rows_before(ranged, groups))


def in_order(df: DataFrame, *keys: Column | str) -> DataFrame:
    """Globally sorted, nulls last; the last key should make the order total."""
    return df.orderBy(*ascending(*keys))


def number_rows(
    df: DataFrame,
    order: Sequence[Column | str],
    into: str = "nr",
    start: int = 1,
    group: Sequence[str] = (),
    drop: Sequence[str] = (),
    ranging: Ranging = RANGING,
    dealt: Dealt | None = None,
) -> DataFrame:
    """Number rows in sort order, per group if one is given.

    ``order`` must be total. ``drop`` names helper columns only the order needs. The
    result lies in the order of its partitions, each sorted. ``df`` is read three times
    for its sort key and once as a whole: pin it where it costs more than a scan.

    Where wide rows are made from narrow ones, row by row, deal the narrow ones out by the same
    order and give ``dealt``: ``df`` then carries the column of the range and is not exchanged.
    """
    groups = [quoted(g) for g in group]
    if dealt is None:
        dealt = deal(df, [*groups, *order], groups=groups, ranging=ranging)
        df = dealt.rows
    else:
        df = df.withColumnRenamed(dealt.column, RANGE)
    within = F.row_number().over(W.partitionBy(RANGE, *groups).orderBy(*ascending(*order)))
    numbered = df.withColumn(into, within.cast("bigint"))
    if dealt.before is not None:
        same = F.col(RANGE) == F.col("__of_range")
        for i, g in enumerate(groups):
            same = same & g.eqNullSafe(F.col(f"__of_group{i}"))
        numbered = numbered.join(F.broadcast(dealt.before), same, "left").withColumn(into, F.col(into) + F.coalesce("__before", F.lit(0)))
        numbered = numbered.drop(*dealt.before.columns)
    return numbered.withColumn(into, F.col(into) + F.lit(start - 1).cast("bigint")).drop(RANGE, *drop)


def _rows_before(ranged: DataFrame, groups: Sequence[Column]) -> DataFrame:
    """Per range the number of rows in earlier ones, of the group that continues into it.

    Ranges cut the order, so of each group only its later ranges have rows before them,
    and a range continues one group at most: no more rows than ranges, which is safe
    to broadcast. Without groups, as many rows are put in order in one task.
    """
    named = [g.alias(f"__of_group{i}") for i, g in enumerate(groups)]
    sizes = ranged.groupBy(F.col(RANGE).alias("__of_range"), *named).agg(F.count("*").alias("__size"))
    earlier = W.partitionBy(*[f"__of_group{i}" for i in range(len(groups))]).orderBy("__of_range")
    before = F.sum("__size").over(earlier.rowsBetween(W.unboundedPreceding, -1))
    return sizes.withColumn("__before", before).drop("__size").where(F.col("__before") > 0)
