"""Current documents that the relay keeps itself, so that updates can be given the document of their key.

The table is dealt into buckets by a hash of the key. Every batch composes its own writes with the buckets that it
touches, and with no others, and swaps these in one step. Composition takes the newer write of each place, so a batch that
is repeated, or arrives late, changes nothing twice.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators import lookup, patches
from sluice.streaming import manifest

BUCKETS = 64


@dataclass(frozen=True)
class Documents:
    """Where the documents are kept. ``buckets`` is fixed for a table: about as many as make a bucket 100 MB."""

    path: str
    buckets: int = BUCKETS

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*patches.KEY), F.lit(self.buckets)).cast("int")


def writes(spark: SparkSession, kept: Documents, buckets: list[int] | None = None) -> DataFrame:
    """The newest write to each place, of some buckets or of all."""
    version = manifest.current(spark, kept.path)
    folders = version.folders(None if buckets is None else map(str, buckets))
    if not folders:
        return spark.createDataFrame([], patches.WRITES)
    return spark.read.schema(patches.WRITES).parquet(*folders)


def documents(spark: SparkSession, kept: Documents) -> DataFrame:
    """(db, coll, documentKey, fullDocument) as of the newest version."""
    return patches.documents(writes(spark, kept))


def advance(spark: SparkSession, kept: Documents, events: DataFrame) -> list[int]:
    """Compose the writes of a batch into the buckets they touch; returns these."""
    new = patches.composed(patches.writes(events)).withColumn("bucket", kept.bucket()).persist()
    try:
        touched = sorted(row["bucket"] for row in new.select("bucket").distinct().collect())
        if not touched:
            return []
        before = manifest.current(spark, kept.path)
        old = writes(spark, kept, touched)
        whole = patches.composed(new.drop("bucket"), old).withColumn("bucket", kept.bucket())
        folder = manifest.new_folder()
        whole.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{kept.path}/{folder}")
        # What is composed of something has something in it: every touched bucket has a folder.
        parts = before.parts | {str(b): [f"{folder}/bucket={b}"] for b in touched}
        manifest.swap(spark, before, parts, depth=2)
        return touched
    finally:
        new.unpersist()


def attach(spark: SparkSession, kept: Documents, labelled: DataFrame, touched: list[int]) -> DataFrame:
    """Updates of a batch get the documents of the version that this batch has made.

    Only the buckets of the batch are read, and only documents that one of its updates names are folded.
    """
    wanted = labelled.where("operationType = 'update'").select(*patches.KEY).distinct()
    state = writes(spark, kept, touched).join(wanted, list(patches.KEY), "left_semi")
    return lookup.attach_documents(labelled, patches.documents(state))
