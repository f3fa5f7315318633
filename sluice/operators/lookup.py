"""Full-document lookup: give update events the current document of their key.

The document store answers this from its own current state. Here that state is an
explicit snapshot, either supplied or rebuilt from the log up to a chosen time.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators import patches

KEY = patches.KEY


def snapshot(events: DataFrame, until: int | None = None) -> DataFrame:
    """The documents that exist after the last event of every key.

    ``until`` (epoch seconds) leaves later events of the log out. Updates without a document are folded into the last
    whole one, see ``operators.patches``; a key of which no whole document is known has none.
    """
    if until is not None:
        events = events.where(F.col("T") <= until)
    return patches.documents(patches.composed(patches.writes(events)))


def attach_documents(events: DataFrame, documents: DataFrame) -> DataFrame:
    """Replace ``fullDocument`` of update events by the snapshot's, or by null.

    Other operations pass through: their join key is their own token, which matches
    nothing and spreads them evenly, so a document with very many deletes or inserts
    puts no weight on one partition. No broadcast is forced. Spark broadcasts the
    snapshot when its measured size is below the session's threshold; otherwise the
    sort-merge join splits the partitions of hot documents (adaptive skew join).
    """
    is_update = F.col("operationType") == "update"
    lookup_key = F.when(is_update, F.concat(F.lit("key:"), "documentKey")).otherwise(
        F.concat(F.lit("token:"), "token")
    )
    current = documents.select(
        "db",
        "coll",
        F.concat(F.lit("key:"), "documentKey").alias("lookup_key"),
        F.col("fullDocument").alias("current_document"),
    )
    joined = events.withColumn("lookup_key", lookup_key).join(
        current, ["db", "coll", "lookup_key"], "left"
    )
    looked_up = F.when(is_update, F.coalesce("current_document", F.lit("null")))
    return joined.withColumn(
        "fullDocument", looked_up.otherwise(F.col("fullDocument"))
    ).select(*events.columns)
