"""Delivery order as data and as layout."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions import cluster_time


def ordered_delivery(events: DataFrame) -> DataFrame:
    """Events with their ordering key and sequence, laid out in delivery order.

    ``sequence`` is the packed cluster time: it orders the events of a key across
    batches and replays without counting rows. The layout is a range partitioning on
    (key, sequence), so a key that holds most of the events spans several partitions
    and files, which follow each other in order, instead of filling one task.
    """
    sequenced = events.select(
        "ordering_key",
        cluster_time.sequence(F.col("T"), F.col("I")).alias("sequence"),
        *[c for c in events.columns if c != "ordering_key"],
    )
    return sequenced.sort("ordering_key", "sequence")
