"""Counts per choice, per class and per overlapping category, with zero rows and totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions.text import strip
from rollcall.functions.values import has_text
from rollcall.operators.shaping import quoted

LABEL, POSITION = "label", "position"


def choice_frame(spark: SparkSession, labels: Sequence[str]) -> DataFrame:
    """A fixed list as a dimension: label, position from 1."""
    rows = [(label, i) for i, label in enumerate(dict.fromkeys(labels), 1)]
    return spark.createDataFrame(rows, f"{LABEL} string, {POSITION} bigint")


def edit_choices(choices: DataFrame, remove: str, append: str) -> DataFrame:
    """Take one choice out, which must be there, and put another at the end."""
    if choices.where(F.col(LABEL) == remove).isEmpty():
        raise ValueError(f"choice to remove is not offered: {remove!r}")
    kept = choices.where(F.col(LABEL) != remove)
    added = choices.agg((F.max(POSITION) + 1).alias(POSITION)).select(
        F.lit(append).alias(LABEL), POSITION
    )
    return (
        kept.unionByName(added).groupBy(LABEL).agg(F.min(POSITION).alias(POSITION))
    )


def count_where(condition: Column | None) -> Column:
    return F.count("*") if condition is None else F.count_if(condition)


def counts_per_choice(
    df: DataFrame,
    group: str,
    choices: DataFrame,
    measures: Mapping[str, Column | None],
    total_label: str,
) -> DataFrame:
    """One row per choice, zero where nobody took it, after a total over all rows.

    The total also covers rows without a value or with one that is no choice. Rows
    are counted once, before the shuffle; total and choices share the result.
    """
    observed = df.groupBy(quoted(group).alias("__group")).agg(
        *[count_where(c).alias(m) for m, c in measures.items()]
    )
    total = observed.agg(
        *[F.coalesce(F.sum(quoted(m)), F.lit(0)).alias(m) for m in measures]
    ).select(F.lit(total_label).alias(LABEL), F.lit(0).cast("bigint").alias(POSITION), *map(quoted, measures))
    # Null-safe, or else a not-null filter would be pushed down and clean every value twice.
    same = F.col(LABEL).eqNullSafe(F.col("__group"))
    listed = choices.join(observed, same, "left").select(
        LABEL, POSITION, *[F.coalesce(quoted(m), F.lit(0)).alias(m) for m in measures]
    )
    return total.unionByName(listed)


def counts_per_category(
    df: DataFrame,
    text: str,
    categories: Sequence[str],
    measures: Mapping[str, Column | None],
    total_label: str,
) -> DataFrame:
    """Counts of rows whose text contains each category; a row may fall in several.

    The whole grid is one aggregate over one pass, so nothing is joined and no row
    is repeated. The categories come first, the total over all rows last.
    """
    conditions = {c: has_text(quoted(text), c) for c in categories} | {total_label: None}

    def both(a: Column | None, b: Column | None) -> Column | None:
        return b if a is None else a if b is None else a & b

    cells = {
        (i, m): count_where(both(condition, measure)).alias(f"n_{i}_{j}")
        for i, condition in enumerate(conditions.values(), 1)
        for j, (m, measure) in enumerate(measures.items())
    }
    grid = df.agg(*cells.values())
    lines = [
        F.struct(
            F.lit(label).alias(LABEL),
            F.lit(i).cast("bigint").alias(POSITION),
            *[F.col(f"n_{i}_{j}").alias(m) for j, m in enumerate(measures)],
        )
        for i, label in enumerate(conditions, 1)
    ]
    return grid.select(F.inline(F.array(*lines)))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values, stripped, without null."""
    value = quoted(column)
    return df.where(value.isNotNull()).select(strip(value).alias(LABEL)).distinct()


def choices_and_observed(choices: DataFrame, df: DataFrame, column: str) -> DataFrame:
    """Every configured or observed label once."""
    return choices.select(LABEL).union(distinct_values(df, column)).distinct()
