"""Session settings that carry meaning, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Runtime settings the results, and the speed of wide tables, depend on.
SETTINGS = {
    # Instants are formatted by shifting them to a zone, which needs a UTC session.
    "spark.sql.session.timeZone": "UTC",
    # A question answered twice keeps its last answer.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # Hot keys are split at run time in sort-merge joins.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Generated methods beyond this size are never compiled by the JVM's JIT; wide
    # clean-up steps run twice as fast in several smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # The folders of groups are labels: place 007 is not the number 7.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

#: Paths made since ``scratch`` was entered; none where the caller keeps its tables.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def configure(spark: SparkSession, case_sensitive: bool = False) -> SparkSession:
    """Apply the settings above.

    ``case_sensitive`` is needed while question texts are column names, since
    ``email`` and ``Email`` may both be questions.
    """
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    if case_sensitive:
        spark.conf.set("spark.sql.caseSensitive", "true")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    A folder of this machine is used only when Spark itself runs inside this
    machine and nothing was configured, as in tests.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rollcall-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path of this application below the shared folder."""
    app = spark.sparkContext.applicationId
    path = f"{scratch_root(spark)}/rollcall/{app}/{label}-{uuid.uuid4().hex}"
    made = _MADE.get()
    if made is not None:
        made.append(path)
    return path


def pin(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: the rows and the partition each row sat in are fixed from
    here on and survive the loss of executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, name: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Remove what is pinned inside, and only that, at the end, also after a failure.

    All that is read from it must have been written by then. Gives the list of what is pinned.
    """
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(token)
        for path in made:
            _remove(spark, path)


def release(spark: SparkSession) -> bool:
    """Remove everything this application pinned; call it after the last write."""
    return _remove(spark, f"{scratch_root(spark)}/rollcall/{spark.sparkContext.applicationId}")
