"""Several rows of one key to one row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.operators.shaping import quoted


def position_of(order: Sequence[str]) -> Column:
    return F.struct(*[quoted(c) for c in order])


def first_given(column: str, order: Sequence[str]) -> Column:
    """First value in input order that is not null."""
    value = quoted(column)
    return F.min_by(value, F.when(value.isNotNull(), position_of(order)))


def any_yes(column: str, yes: str = "Ja", no: str = "Nein") -> Column:
    """``yes`` if any row says so, else ``no``; nulls say nothing."""
    hit = F.coalesce(F.bool_or(quoted(column) == yes), F.lit(False))
    return F.when(hit, F.lit(yes)).otherwise(F.lit(no))


def collapse(
    df: DataFrame, key: str, firsts: Sequence[str], flags: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """One row per key: first given value of some columns, any-yes of others.

    Rows without a key are left out. Both aggregates combine before the shuffle, so
    that a key with very many rows does not end up in one task.
    """
    return (
        df.where(quoted(key).isNotNull())
        .groupBy(quoted(key))
        .agg(
            *[first_given(c, order).alias(c) for c in firsts],
            *[any_yes(c).alias(c) for c in flags],
        )
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest record per key, whole."""
    record = F.struct(*[quoted(c) for c in df.columns])
    newest = df.groupBy(*[quoted(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(
        F.max_by(record, position_of(order)).alias("__record")
    )
    return newest.select("__record.*")
