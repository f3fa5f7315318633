"""Schemas and fixed names shared by every part of the relay."""

from pyspark.sql import types as T

# The seven fields of a change event, in file-document order.
EVENT_FIELDS = (
    "_id",
    "operationType",
    "clusterTime",
    "ns",
    "fullDocument",
    "documentKey",
    "updateDescription",
)

# The fields that travel as JSON text, in record order.
PAYLOAD_FIELDS = ("_id", "fullDocument", "ns", "documentKey", "updateDescription")

# Destination names accepted in a destination list.
WAREHOUSE = "bigquery"
TOPIC = "pubsub"
KEYED_STREAM = "kinesisStream"
FILE = "file"
DESTINATIONS = (WAREHOUSE, TOPIC, KEYED_STREAM, FILE)

# One event after decoding: typed header with cluster time (T, I), payloads as canonical JSON text.
ENCODED_EVENT = T.StructType(
    [
        T.StructField("token", T.StringType()),
        T.StructField("operationType", T.StringType()),
        T.StructField("T", T.LongType()),
        T.StructField("I", T.LongType()),
        T.StructField("db", T.StringType()),
        T.StructField("coll", T.StringType()),
        *[T.StructField(name, T.StringType()) for name in PAYLOAD_FIELDS],
    ]
)

WAREHOUSE_ROW = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("operationType", T.StringType()),
        T.StructField("clusterTime", T.TimestampType()),
        T.StructField("fullDocument", T.StringType()),
        T.StructField("ns", T.StringType()),
        T.StructField("documentKey", T.StringType()),
        T.StructField("updateDescription", T.StringType()),
    ]
)

POSITION = T.StructType(
    [
        T.StructField("db", T.StringType()),
        T.StructField("coll", T.StringType()),
        T.StructField("token", T.StringType()),
        T.StructField("T", T.LongType()),
        T.StructField("I", T.LongType()),
    ]
)

# Columns that make a write replayable: see streaming/sinks.py.
BATCH_COLUMNS = ("run_id", "batch_id")
