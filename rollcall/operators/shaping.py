"""Column shaping: renames, projections, backfill, long-to-wide."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping, Sequence
from itertools import chain, count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions.text import blank_to_null


#: Helper column: question ids of the answers, the last one first.
IDS = "__ids"


def quoted(name: str) -> Column:
    """A column by its literal name; question texts hold dots, colons and ticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename all columns at once, so that names may be swapped; unknown names are ignored."""
    target = [names.get(c, c) for c in df.columns]
    doubled = sorted(n for n, times in Counter(target).items() if times > 1)
    if doubled:
        raise ValueError(f"rename would give two columns the same name: {doubled}")
    return df.select([quoted(c).alias(t) for c, t in zip(df.columns, target)])


def select_known(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    present = set(df.columns)
    return df.select([quoted(c) for c in wanted if c in present])


def require(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Fail early when a column that is computed on is missing."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns that must exist."""
    return require(df, names).drop(*[quoted(n) for n in names])


def add_missing(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Add absent columns as null text."""
    absent = [n for n in names if n not in df.columns]
    return df.select("*", *[F.lit(None).cast("string").alias(n) for n in absent])


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def blanks_to_null(df: DataFrame, except_for: Iterable[str] = ()) -> DataFrame:
    """Strip every text column and turn what is empty then into null, in one projection."""
    texts = set(text_columns(df)) - set(except_for)
    return df.select(
        [blank_to_null(quoted(c)).alias(c) if c in texts else quoted(c) for c in df.columns]
    )


def unique_name(base: str, taken: Iterable[str]) -> str:
    """``base``, or the first of ``base (#2)``, ``base (#3)``, ... that is free."""
    used = taken if isinstance(taken, (set, frozenset)) else set(taken)
    options = chain([base], (f"{base} (#{n})" for n in count(2)))
    return next(name for name in options if name not in used)


def pivot_last(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    value: str,
    order: Sequence[str],
    names: Sequence[str],
) -> DataFrame:
    """Long to wide over declared names; the last value per key and name wins.

    One partial and one final aggregate over the keys. A declared name nobody
    uses becomes a null column.
    """
    position = F.struct(*[quoted(c) for c in order])
    return df.groupBy(*[quoted(k) for k in keys]).agg(
        *[F.max_by(quoted(value), F.when(quoted(name) == n, position)).alias(n) for n in names]
    )


def _is_one(value: Column, named: Sequence[int], empty: bool) -> Column:
    hit = F.coalesce(value.isin(list(named)), F.lit(False)) if named else F.lit(False)
    return hit | value.isNull() if empty else hit


def last_answers(
    df: DataFrame, answers: str, ids: Mapping[str, Sequence[int | None]]
) -> tuple[DataFrame, dict[str, Column], dict[str, Column]]:
    """Per text the last answer to one of its ids, and whether there is one.

    ``answers`` is an array of ``(id, answer)``. A text of one id is read at the first place
    of the id in the reversed ids, which are made once per row; a text that several
    questions share is searched in the array.
    """
    keyed = df.withColumn(IDS, F.reverse(quoted(answers)["id"]))
    values, given = {}, {}
    for text, of in ids.items():
        if len(of) == 1 and of[0] is not None:
            place = F.array_position(IDS, F.lit(of[0]).cast("bigint"))
            # Of an id that is not there this is past the end, where ``get`` is null.
            at = (F.size(IDS) - place).cast("int")
            values[text], given[text] = F.get(quoted(answers), at)["answer"], place > 0
            continue
        named, empty = [i for i in of if i is not None], None in of

        found = F.filter(quoted(answers), lambda a: _is_one(a["id"], named, empty))
        values[text], given[text] = F.try_element_at(found, F.lit(-1))["answer"], F.size(found) > 0
    return keyed, values, given


def widen(
    df: DataFrame,
    answers: str,
    columns: Mapping[str, str],
    answered: Iterable[str],
    collisions: str = "answer",
    ids: Mapping[str, Sequence[int | None]] | None = None,
) -> DataFrame:
    """Spread the answers into one column per question, without a shuffle.

    ``columns`` maps each question text to its column name. A question outside
    ``answered`` was answered by nobody and becomes the empty text. Where a column
    name exists already, the answer replaces it in the rows that have one, or the
    call fails with ``collisions="raise"``. Answers are a map by text, or with ``ids``,
    the question ids of each text, an array of ``(id, answer)``.
    """
    known = set(answered)
    fixed = [c for c in df.columns if c != answers]
    shadowed = {columns[t]: t for t in columns if columns[t] in fixed and t in known}
    if shadowed and collisions == "raise":
        raise ValueError(f"question texts equal fixed columns: {sorted(shadowed)}")
    if ids is None:
        # Unlike map[key], which Spark takes for free, this is not repeated per use.
        values = {t: F.try_element_at(quoted(answers), F.lit(t)) for t in known}
        given = {t: F.map_contains_key(quoted(answers), t) for t in shadowed.values()}
    else:
        df, values, given = last_answers(df, answers, {t: ids[t] for t in columns if t in known})

    def fixed_column(name: str) -> Column:
        if name not in shadowed:
            return quoted(name)
        text = shadowed[name]
        return F.when(given[text], values[text]).otherwise(quoted(name).cast("string")).alias(name)

    spread = [
        (values[text] if text in known else F.lit("")).alias(name)
        for text, name in columns.items()
        if name not in fixed
    ]
    return df.select(*[fixed_column(c) for c in fixed], *spread)
