"""Input tables, and what tasks need to work on them."""

from __future__ import annotations

import os
import shutil
import tempfile
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give this package to the Python workers, once per application; they may run anywhere."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        name = os.path.join(tempfile.mkdtemp(prefix="run-"), os.path.basename(package))
        spark.sparkContext.addPyFile(shutil.make_archive(name, "zip", os.path.dirname(package), os.path.basename(package)))
        _SHIPPED.add(app)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table; others are never read."""
    return ship(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def matched(rows: DataFrame, keys_table: DataFrame, keys: list[str], total: int, shares: int = 1024) -> DataFrame:
    """Inner join of ``rows`` with a table of one row per key, whose ``n`` says how many rows have it.

    Nulls match nulls. Keys that hold more than one in ``shares`` of the ``total`` rows, of
    which there are fewer than ``shares``, are broadcast; the rows of all others are
    shuffled, where no key can fill a task. ``n`` is not part of the result. Both tables
    are read twice, so pin them.
    """
    named = keys_table.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in keys_table.columns if c not in keys])
    heavy = F.col("n") * shares > total

    def same(table: DataFrame) -> Column:
        return reduce(and_, [rows[k].eqNullSafe(table[f"__{k}"]) for k in keys])

    few, rest = F.broadcast(named.where(heavy)), named.where(~heavy)
    held = rows.join(few, same(few))
    others = rows.join(few, same(few), "left_anti").join(rest, same(rest))
    return held.unionByName(others).drop("n", *[f"__{k}" for k in keys])


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt out by key to as many tasks as a shuffle has.

    For few rows that each become many: adaptive execution would judge the few rows small
    and put them into one task.
    """
    # By a hash of the keys, which no partitioning by the keys themselves makes superfluous.
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64(*keys))
