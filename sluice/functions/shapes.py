"""Row shapes of the destinations, from encoded events."""

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import cluster_time, json_text
from sluice.schema import EVENT_FIELDS, PAYLOAD_FIELDS

SEPARATOR = "|"
# Defaults of the file envelope.
DEFAULT_LOG_TYPE = "changeStream"
DEFAULT_DOCUMENT_KEY = "cs"


def _payload(name: str) -> Column:
    return json_text.escape_markup(name)


def warehouse_columns() -> list[Column]:
    return [
        _payload("_id").alias("id"),
        F.col("operationType"),
        cluster_time.as_timestamp(F.col("T")).alias("clusterTime"),
        *[_payload(name).alias(name) for name in PAYLOAD_FIELDS[1:]],
    ]


def warehouse_row(events: DataFrame) -> DataFrame:
    return events.select(*warehouse_columns())


def delimited(zone: str = "UTC") -> Column:
    """The seven fields joined by pipes: no quoting, no trailing newline."""
    # Escaping four joined payloads costs as many scans as escaping one.
    payloads = f"concat_ws('{SEPARATOR}', {', '.join(PAYLOAD_FIELDS[1:])})"
    return F.concat_ws(
        SEPARATOR,
        _payload("_id"),
        F.col("operationType"),
        cluster_time.as_text(F.col("T"), zone),
        json_text.escape_markup(payloads),
    )


def topic_message(events: DataFrame, topic: Column, zone: str = "UTC") -> DataFrame:
    """Delimited record with its ordering key (NULL unless one is configured)."""
    ordered = "ordering_key" in events.columns
    key = F.col("ordering_key") if ordered else F.lit(None).cast("string")
    return events.select(
        topic.alias("topic"),
        key.alias("ordering_key"),
        cluster_time.sequence(F.col("T"), F.col("I")).alias("sequence"),
        delimited(zone).alias("value"),
    )


def keyed_record(events: DataFrame, stream: Column, zone: str = "UTC") -> DataFrame:
    """Delimited record with a newline, keyed by the position token."""
    return events.select(
        stream.alias("stream"),
        F.col("token").alias("partition_key"),
        F.concat(delimited(zone), F.lit("\n")).alias("value"),
    )


def _object(members: list[tuple[str, Column]]) -> Column:
    parts = []
    for position, (key, value) in enumerate(members):
        lead = "{" if position == 0 else ","
        parts += [F.lit(f"{lead}{json.dumps(key, ensure_ascii=False)}:"), value]
    return F.concat(*parts, F.lit("}"))


def file_document(zone: str = "UTC") -> Column:
    """JSON text of the whitelisted fields in their fixed order, missing ones null.

    The payloads are JSON text already, so the document is put together from them:
    nothing is parsed twice and integers keep all their digits.
    """
    other = {
        "operationType": json_text.quote(F.col("operationType")),
        "clusterTime": F.concat(
            F.lit('"'), cluster_time.as_rfc3339(F.col("T"), zone), F.lit('"')
        ),
    }
    members = [
        (name, other.get(name, json_text.escape_separators(name)))
        for name in EVENT_FIELDS
    ]
    return _object(members)


def file_line(
    log_type: str = DEFAULT_LOG_TYPE,
    document_key: str = DEFAULT_DOCUMENT_KEY,
    time_key: str | None = None,
    zone: str = "UTC",
) -> Column:
    """One line of the file destination; an empty option means its default."""
    members = []
    if time_key:
        written = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSXX")
        members.append((time_key, F.concat(F.lit('"'), written, F.lit('"'))))
    log_text = json.dumps(log_type or DEFAULT_LOG_TYPE, ensure_ascii=False)
    members.append(("logType", F.lit(log_text)))
    members.append((document_key or DEFAULT_DOCUMENT_KEY, file_document(zone)))
    return _object(members)
