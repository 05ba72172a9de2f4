"""A training corpus from raw documents: five stages, each written and read again.

Every stage takes the documents its predecessor kept and returns documents, the last one
the place of each in the shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollcall.llm import compression, latent, mixing, packing, simhash
from rollcall.llm.tables import ship, table
from rollcall.session import pin


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the base rule and the compression bands."""
    ship(spark)
    return compression.good_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group within three bits, shingles of three words."""
    ship(spark)
    return simhash.one_of_each(docs, shingle=3, distance=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return latent.without_leaks(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mixture takes from each document, a row for each turn."""
    return mixing.mixed_texts(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of each document."""
    return packing.pack(docs, packing.Settings(shards=40))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mixture", source_mixture),
    ("sharding", sharding),
]

#: SQL has no compression, fingerprints, singular vectors or permutations; a test does it all by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
