"""Predicates and value rules with the null behaviour the reports expect."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.text import any_of, as_column, blank_to_null


def differs(c: Column | str, value: object) -> Column:
    """``c != value`` that keeps rows in which ``c`` is unknown."""
    return ~as_column(c).eqNullSafe(F.lit(value))


def equals(c: Column | str, value: object) -> Column:
    """``c = value``; an unknown ``c`` is no match."""
    return as_column(c).eqNullSafe(F.lit(value))


def has_text(c: Column | str, part: str) -> Column:
    """Substring test; an unknown text contains nothing."""
    return F.coalesce(as_column(c).contains(part), F.lit(False))


def not_blank(*columns: Column | str) -> Column:
    """True where at least one of the columns holds more than white space."""
    return any_of(blank_to_null(c).isNotNull() for c in columns)


def map_values(c: Column | str, mapping: Mapping[str, object]) -> Column:
    """Replace exact values; everything else passes through."""
    result = source = as_column(c)
    for value, word in reversed(mapping.items()):
        result = F.when(source == value, F.lit(word)).otherwise(result)
    return result


def mark_given(c: Column | str, mark: str) -> Column:
    """Any real text becomes ``mark``; blanks and nulls stay as they are."""
    source = as_column(c)
    return F.when(not_blank(source), F.lit(mark)).otherwise(source)


def keep_if(condition: Column, c: Column | str) -> Column:
    """The value where the condition holds, null elsewhere."""
    return F.when(condition, as_column(c))


def first_usable(
    first: Column | str, second: Column | str, third: Column | str, sentinel: str
) -> Column:
    """First column unless null, empty or the sentinel; then second unless empty; then third."""
    usable = F.nullif(F.nullif(as_column(first), F.lit("")), F.lit(sentinel))
    return F.coalesce(usable, F.nullif(as_column(second), F.lit("")), as_column(third))


def rank_of(c: Column | str, ranked: Sequence[str]) -> Column:
    """Position of a value in a fixed list; null for anything else."""
    source = as_column(c)
    result = F.lit(None).cast("int")
    for rank, value in reversed(list(enumerate(ranked))):
        result = F.when(source == value, F.lit(rank)).otherwise(result)
    return result
