"""Raw documents to packed training sequences, in stages that each work on all that the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.llm import mixing, ngram_join, packing, pii, quality_fm
from sluice.llm.common import documents
from sluice.workspace import fresh_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    machine = quality_fm.fit(docs, documents(spark, sf_dir, "labels"))
    return quality_fm.good(docs, machine)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return ngram_join.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes the name of its kind."""
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled to the target weights of sources, languages and topics."""
    return mixing.sampled(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents become sequences of 1024 tokens."""
    return packing.packed(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mix", mix), ("pack", pack)]

#: The stages learn from the corpus, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each one's documents written and read again."""
    rows = documents(spark, sf_dir)
    for name, stage in STAGES:
        rows = stage(spark, rows, sf_dir)
        path = fresh_dir(spark, f"pipeline-{name}")
        rows.write.parquet(path)
        rows = spark.read.parquet(path)
    return rows
