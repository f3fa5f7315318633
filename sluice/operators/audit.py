"""What was relayed, and up to which position."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions import cluster_time


def relay_audit(events: DataFrame) -> DataFrame:
    """Count and newest time per database, collection and operation.

    All buffers are fixed width, so this stays a hash aggregate with map-side
    combination; a collection with most of the events costs one row per task.
    """
    return events.groupBy("db", "coll", "operationType").agg(
        F.count(F.lit(1)).alias("events"),
        cluster_time.as_timestamp(F.max("T")).alias("last_time"),
    )


def last_position(events: DataFrame) -> DataFrame:
    """The newest token per collection with its (T, I)."""
    order = cluster_time.sequence(F.col("T"), F.col("I"))
    newest = F.max_by(F.struct("token", "T", "I"), order).alias("last")
    return (
        events.groupBy("db", "coll")
        .agg(newest)
        .select("db", "coll", "last.token", "last.T", "last.I")
    )
