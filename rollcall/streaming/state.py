"""The newest record of every key, kept as a table and changed bucket by bucket.

Keys are dealt to a fixed number of buckets. A batch of changes reads and rewrites those
buckets it touches, under a version of its own; which version of a bucket holds is a small
table, appended to once all files of the version are written. Readers see whole versions
only, and a batch that is run again after a failure gives the same state again.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rollcall.operators.collapsing import latest_per_key
from rollcall.operators.shaping import quoted
from rollcall.plans.spec import EventConfig
from rollcall.session import _remove, pin, scratch
from rollcall.sinks.reports import append_rows
from rollcall.streaming.polling import _trigger

BUCKET = "__bucket"
VERSION_SCHEMA = "version bigint, bucket int, buckets int, rows bigint"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a record; nulls are keys like any other."""
    return F.pmod(F.xxhash64(*map(quoted, keys)), F.lit(buckets)).cast("int")


def versions(spark: SparkSession, table: str) -> DataFrame:
    """Which buckets each version wrote, and how many rows they hold."""
    try:
        return spark.read.schema(VERSION_SCHEMA).parquet(f"{table}/_versions")
    except AnalysisException:  # nothing kept yet
        return spark.createDataFrame([], VERSION_SCHEMA)


def _folders(spark: SparkSession, table: str, before: int | None = None, only: Iterable[int] | None = None) -> list[str]:
    """Folders that hold the state, a bucket each; as many as there are buckets at most."""
    log = versions(spark, table)
    log = log if before is None else log.where(F.col("version") < before)
    held = log.groupBy("bucket").agg(F.max(F.struct("version", "rows")).alias("newest")).select("bucket", "newest.*")
    wanted = None if only is None else set(only)
    return [
        f"{table}/version={r['version']}/{BUCKET}={r['bucket']}"
        for r in held.where("rows > 0").collect() if wanted is None or r["bucket"] in wanted
    ]


def current_records(spark: SparkSession, table: str, schema: str | None = None) -> DataFrame:
    """The newest record of each key; ``schema`` says the columns of a state that may be empty."""
    folders = _folders(spark, table)
    if not folders:
        if schema is None:
            raise ValueError(f"no records in {table}")
        return spark.createDataFrame([], schema)
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(*folders)


def apply_changes(
    table: str, changes: DataFrame, keys: Sequence[str], order: Sequence[str], version: int, buckets: int = 64
) -> int:
    """Bring the state up to date with a batch of records; the number of buckets rewritten.

    ``order`` tells which of two records of a key is newer: an older one that comes late
    changes nothing. Versions grow; one that was applied before is replaced, from the
    state it was first applied to. The work is that of the touched buckets and the changes:
    take so many buckets that a batch touches few of them.
    """
    spark = changes.sparkSession
    with scratch(spark):
        # A key with very many records in the batch combines before it is shuffled.
        newest = pin(latest_per_key(changes, keys, order).withColumn(BUCKET, bucket_of(keys, buckets)), "changes")
        touched = [r[BUCKET] for r in newest.select(BUCKET).distinct().collect()]
        if not touched:
            return 0
        log = versions(spark, table).agg(F.max("buckets").alias("buckets")).first()
        if log["buckets"] not in (None, buckets):
            raise ValueError(f"{table} has {log['buckets']} buckets, not {buckets}")
        folders = _folders(spark, table, before=version, only=touched)
        merged = newest.drop(BUCKET)
        if folders:
            held = spark.read.schema(changes.schema).parquet(*folders)
            merged = latest_per_key(held.unionByName(merged), keys, order)
        path = f"{table}/version={version}"
        side_by_side = int(spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = merged.withColumn(BUCKET, bucket_of(keys, buckets)).repartition(min(len(touched), side_by_side), BUCKET)
        dealt.write.mode("overwrite").partitionBy(BUCKET).parquet(path)
        sizes = spark.read.parquet(path).groupBy(F.col(BUCKET).alias("bucket")).agg(F.count("*").alias("rows"))
        entries = sizes.select(
            F.lit(version).cast("bigint").alias("version"), F.col("bucket").cast("int").alias("bucket"), F.lit(buckets).alias("buckets"), "rows"
        )
        # One file, so that the version holds as a whole or not at all.
        append_rows(entries.coalesce(1), f"{table}/_versions")
    return len(touched)


def keep_state(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[str],
    config: EventConfig = EventConfig(run_once=True),
    buckets: int = 64,
) -> StreamingQuery:
    """Keep the newest record of each key of a stream."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        apply_changes(table, batch, keys, order, batch_id, buckets)

    return (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(config))
        .start()
    )


def vacuum(spark: SparkSession, table: str) -> int:
    """Remove buckets that a newer version has replaced; nobody may be reading them. Their number."""
    log = versions(spark, table)
    newest = log.groupBy(F.col("bucket").alias("b")).agg(F.max("version").alias("v"))
    old = log.join(newest, (F.col("bucket") == F.col("b")) & (F.col("version") < F.col("v"))).select("version", "bucket").distinct()
    gone = old.collect()
    for r in gone:
        _remove(spark, f"{table}/version={r['version']}/{BUCKET}={r['bucket']}")
    return len(gone)
