"""Every registered query, by name: ``(spark, sf_dir) -> DataFrame``.

All of them begin at stored tables turned into change-event lines, and run over
whole tables.
"""

import datetime as dt
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions import cluster_time, shapes
from sluice.operators import (
    audit,
    delivery,
    lookup,
    ordering,
    quarantine,
    records,
    retention,
    routing,
    throttle,
)
from sluice.schema import DESTINATIONS, FILE, KEYED_STREAM, TOPIC, WAREHOUSE
from sluice.sources import change_log, log_index, table_events
from sluice.streaming import bases, compaction, delivered, ledger, relay, sinks, state
from sluice.workspace import fresh_dir

# Parameters of the registered queries; the SQL twins state the same values.
RELAY_START = 1705363200  # 2024-01-16 00:00:00 UTC
AS_OF = 1705708800  # 2024-01-20 00:00:00 UTC
RETENTION_AS_OF = dt.date(2024, 1, 30)
RETENTION_DAYS = 10
SAVE_INTERVAL = 6 * 3600
BASE_DAYS = 4
MAX_BYTES = 16 * 1024
RELAY_DAY = dt.date(2024, 1, 16)
ARRIVALS = ["2024-01-16 00:00:00"]
ZONE = "Asia/Tokyo"
ROUTES = [
    routing.Route("app", "users_0", WAREHOUSE, "users_zero"),
    routing.Route("app", "users_1", WAREHOUSE, "users_one"),
    routing.Route("app", "users_1", TOPIC, "users-one"),
    routing.Route("app", "users_2", KEYED_STREAM, "users-two"),
    routing.Route("app", "users_2", FILE, "users_two"),
]


def _pin(spark: SparkSession) -> None:
    # Timestamps are compared as UTC wall clock by whoever collects the results.
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    _pin(spark)
    return table_events.event_lines(spark, sf_dir)


def _decoded(spark: SparkSession, sf_dir: str, ordering_by: str | None = None) -> DataFrame:
    return change_log.decode(change_log.parse(_lines(spark, sf_dir)), ordering_by)


def _events(spark: SparkSession, sf_dir: str, ordering_by: str | None = None) -> DataFrame:
    """Valid encoded events of the whole ``events`` table."""
    decoded = _decoded(spark, sf_dir, ordering_by)
    return quarantine.valid(quarantine.label(decoded, ordering_by))


def _day_text() -> Column:
    return F.col("cluster_date").cast("string").alias("cluster_date")


def _text_events(lines: DataFrame) -> DataFrame:
    return quarantine.valid(quarantine.label(change_log.decode(change_log.parse(lines))))


# Sources


def change_log_scan(spark, sf_dir):
    """Write the log as text lines, scan it back, decode header and payloads."""
    path = fresh_dir(spark, "log")
    _lines(spark, sf_dir).write.text(path)
    decoded = change_log.decode(change_log.parse(change_log.read_lines(spark, path)))
    return quarantine.valid(quarantine.label(decoded))


def change_log_archive(spark, sf_dir):
    """Store the log as a day-partitioned archive and read one part of it back."""
    path = fresh_dir(spark, "archive")
    change_log.write_archive(_events(spark, sf_dir), path)
    stored = change_log.read_archive(spark, path)
    later = change_log.after_position(stored, RELAY_START, 0)
    return later.select("token", "T", "I", "db", "coll", _day_text())


def namespace_filter(spark, sf_dir):
    events = change_log.in_namespace(_events(spark, sf_dir), "app", "users_2")
    return events.select("token", "operationType", "db", "coll")


def resume_after_token(spark, sf_dir):
    """Resume after the newest token saved before the relay went down."""
    events = _events(spark, sf_dir)
    path = fresh_dir(spark, "positions")
    ledger.append(audit.last_position(events.where(F.col("T") < RELAY_START)), path, "before", 0)
    saved = ledger.read(spark, path)
    newest = saved.orderBy(F.desc("T"), F.desc("I")).first()
    resumed = change_log.resume_after(events, newest["token"] + "\n", saved)
    return resumed.select("token", "T", "I")


def resume_each_collection(spark, sf_dir):
    """Resume every collection after its own saved position."""
    events = _events(spark, sf_dir)
    saved = audit.last_position(
        events.where((F.col("T") < RELAY_START) & (F.col("coll") != "users_3"))
    )
    return ledger.resume_each(events, saved).select("token", "coll", "T", "I")


def start_latest(spark, sf_dir):
    """No saved token: only what comes after the newest event known at the start."""
    events = _events(spark, sf_dir)
    present = events.where(F.col("T") < RELAY_START)
    read = change_log.start_from(events, change_log.LATEST, present)
    return read.select("token", "T", "I")


def indexed_start(spark, sf_dir):
    """Start after the newest event of each collection in a first part of the log; only files of the second are opened."""
    folder, index = fresh_dir(spark, "log"), fresh_dir(spark, "log-index")
    saved = None
    for part in _arrivals(spark, sf_dir):
        part.write.mode("append").text(folder)
        log_index.refresh(spark, folder, index)
        if saved is None:
            now = log_index.in_folder(spark, folder, index)
            saved = ledger.remember_start(spark, fresh_dir(spark, "start"), lambda: log_index.positions(now))
    lines = log_index.lines_after(spark, folder, log_index.in_folder(spark, folder, index), saved)
    return ledger.resume_each(_text_events(lines), saved).select("token", "coll", "T", "I")


# Projections


def event_header(spark, sf_dir):
    return _events(spark, sf_dir).select("token", "db", "coll", "operationType")


def cluster_time_query(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "token", cluster_time.as_timestamp(F.col("T")).alias("cluster_time")
    )


def cluster_time_text(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "token",
        cluster_time.as_text(F.col("T")).alias("utc_text"),
        cluster_time.as_text(F.col("T"), ZONE).alias("zone_text"),
    )


def cluster_time_rfc3339(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "token",
        cluster_time.as_rfc3339(F.col("T")).alias("utc_text"),
        cluster_time.as_rfc3339(F.col("T"), ZONE).alias("zone_text"),
    )


def json_encode_fields(spark, sf_dir):
    return _events(spark, sf_dir).select(
        F.col("_id").alias("id"), "fullDocument", "ns", "documentKey", "updateDescription"
    )


def null_literal(spark, sf_dir):
    """How often each payload is the text ``null``, per operation."""
    is_null = lambda name: F.count_if(F.col(name) == "null").cast("bigint")
    return (
        _events(spark, sf_dir)
        .groupBy("operationType")
        .agg(
            F.count(F.lit(1)).alias("events"),
            is_null("fullDocument").alias("null_documents"),
            is_null("updateDescription").alias("null_updates"),
        )
    )


def token_extract(spark, sf_dir):
    return _events(spark, sf_dir).select("token", "T", "I")


def warehouse_row(spark, sf_dir):
    return shapes.warehouse_row(_events(spark, sf_dir))


def warehouse_row_markup(spark, sf_dir):
    """Web pages as change events: markup characters arrive as unicode escapes."""
    _pin(spark)
    return shapes.warehouse_row(_text_events(table_events.page_lines(spark, sf_dir)))


def delimited_record(spark, sf_dir):
    return _events(spark, sf_dir).select(shapes.delimited().alias("value"))


def delimited_record_text(spark, sf_dir):
    """Conversations as change events: accents, newlines and quotes in payloads."""
    _pin(spark)
    events = _text_events(table_events.conversation_lines(spark, sf_dir))
    return events.select(shapes.delimited().alias("value"))


def parse_delimited(spark, sf_dir):
    """The records of all events, read back to their fields."""
    return records.parse_delimited(delimited_record(spark, sf_dir))


def parse_delimited_text(spark, sf_dir):
    """The records of all conversations and, cut in half, as many that are none."""
    whole = delimited_record_text(spark, sf_dir)
    half = F.substring("value", F.lit(1), F.floor(F.length("value") / 2).cast("int"))
    both = whole.select(F.explode(F.array(F.col("value"), half)).alias("value"))
    return records.parse_delimited(both)


def keyed_record(spark, sf_dir):
    return shapes.keyed_record(_events(spark, sf_dir), F.lit("changes"))


def ordering_key(spark, sf_dir):
    return _events(spark, sf_dir, "documentKey").select("token", "ordering_key")


def file_document(spark, sf_dir):
    return _events(spark, sf_dir).select(shapes.file_document().alias("document"))


def file_envelope(spark, sf_dir):
    return _events(spark, sf_dir).select(
        shapes.file_line("audit", "change").alias("value")
    )


def file_envelope_text(spark, sf_dir):
    """Documents of up to 20,000 words as file lines."""
    _pin(spark)
    events = _text_events(table_events.document_lines(spark, sf_dir))
    return events.select(shapes.file_line().alias("value"))


# Lookup


def current_state(spark, sf_dir):
    return lookup.snapshot(_events(spark, sf_dir))


def state_as_of(spark, sf_dir):
    return lookup.snapshot(_events(spark, sf_dir), AS_OF)


def state_from_updates(spark, sf_dir):
    """Current documents of a log whose updates carry none, only what they changed."""
    _pin(spark)
    return lookup.snapshot(_text_events(table_events.patch_lines(spark, sf_dir)))


def state_from_bases(spark, sf_dir):
    """Documents at a past time from the last base before it and the days after that, of an archive that grew in parts."""
    path, kept = fresh_dir(spark, "archive"), bases.Bases(fresh_dir(spark, "bases"), BASE_DAYS)
    for part, closed in zip(_arrivals(spark, sf_dir, table_events.patch_lines), (RELAY_DAY, RETENTION_AS_OF), strict=True):
        change_log.write_archive(_text_events(part), path)
        stored = change_log.read_archive(spark, path)
        bases.advance(spark, kept, stored, closed)
    return bases.documents_as_of(spark, kept, stored, AS_OF)


def full_document_lookup(spark, sf_dir):
    events = _events(spark, sf_dir)
    attached = lookup.attach_documents(events, lookup.snapshot(events))
    return attached.select("token", "operationType", "documentKey", "fullDocument")


# Aggregates and order


def relay_audit(spark, sf_dir):
    return audit.relay_audit(_events(spark, sf_dir))


def last_position(spark, sf_dir):
    return audit.last_position(_events(spark, sf_dir))


def ordered_delivery(spark, sf_dir):
    events = _events(spark, sf_dir, "documentKey")
    return ordering.ordered_delivery(events).select("ordering_key", "sequence", "token")


def throttled_ledger(spark, sf_dir):
    return throttle.throttled_positions(_events(spark, sf_dir), SAVE_INTERVAL)


# Sinks


def _sink(spark, sf_dir, destination, ordering_by=None, **settings):
    events = _events(spark, sf_dir, ordering_by)
    options = sinks.SinkOptions(fresh_dir(spark, "sink"), **settings)
    sink = sinks.SINKS[destination]
    sink.write(sink.shape(relay.by_day(events), options), options, "once", 0)
    return spark, options.path(destination)


def _read_table(spark, path):
    return spark.read.parquet(path)


def warehouse_sink(spark, sf_dir):
    stored = _read_table(*_sink(spark, sf_dir, WAREHOUSE))
    return stored.select(
        "id",
        "operationType",
        "clusterTime",
        "table",
        _day_text(),
        F.col("batch_id").cast("bigint").alias("batch_id"),
    )


def topic_sink(spark, sf_dir):
    stored = _read_table(*_sink(spark, sf_dir, TOPIC, "documentKey"))
    return stored.select("topic", "ordering_key", "sequence", "value")


def keyed_stream_sink(spark, sf_dir):
    stored = _read_table(*_sink(spark, sf_dir, KEYED_STREAM))
    return stored.select("stream", "partition_key", "value")


def file_sink(spark, sf_dir):
    _, path = _sink(spark, sf_dir, FILE)
    return spark.read.text(path).select("log", _day_text(), "value")


def rolled_file_sink(spark, sf_dir):
    """Lines of the file destination, and whether the file of each is within the limit of bytes."""
    _, path = _sink(spark, sf_dir, FILE, max_megabytes=MAX_BYTES / sinks.MEGABYTE)
    within = (F.col("_metadata.file_size") <= MAX_BYTES).alias("within_limit")
    return spark.read.text(path).select("log", _day_text(), "value", within)


def partition_expiration(spark, sf_dir):
    """Day partitions are dropped from the stored table; what is left is read back."""
    _, path = _sink(spark, sf_dir, WAREHOUSE)
    retention.drop_expired(
        spark, f"{path}/table=changes", RETENTION_AS_OF, days=RETENTION_DAYS
    )
    return _read_table(spark, path).select("id", _day_text())


def partition_expiration_filter(spark, sf_dir):
    """The same limit as a partition filter on the stored table."""
    _, path = _sink(spark, sf_dir, WAREHOUSE)
    kept = retention.unexpired(_read_table(spark, path), RETENTION_AS_OF, RETENTION_DAYS)
    return kept.select("id", _day_text())


def route_by_collection(spark, sf_dir):
    events = _events(spark, sf_dir)
    return routing.route(spark, events, ROUTES).select(
        "token", "db", "coll", "destination", "target"
    )


# Streaming


def _arrivals(spark: SparkSession, sf_dir: str, lines=table_events.event_lines) -> list[DataFrame]:
    """The log in the parts in which it arrives, oldest first."""
    _pin(spark)
    bounds = [None, *ARRIVALS, None]
    return [
        lines(spark, sf_dir, since, before)
        for since, before in zip(bounds, bounds[1:])
    ]


def _relay_all(spark, sf_dir, configured, survive=None, lines=table_events.event_lines, after=None) -> None:
    """Let the log grow part by part, and relay what is new after each part.

    Every round continues from the checkpoint of the one before. A round that ends
    with the ``survive`` error is started again.
    """
    root = configured.options.root

    def run():
        lines = change_log.stream_lines(spark, f"{root}/log")
        relay.start(configured, lines, f"{root}/checkpoint").awaitTermination()

    for part in _arrivals(spark, sf_dir, lines):
        part.write.mode("append").text(f"{root}/log")
        try:
            run()
        except StreamingQueryException as failure:
            if survive is None or survive not in str(failure):
                raise
            run()
        if after is not None:
            after()


def _relayed(spark, sf_dir, destinations=DESTINATIONS, **settings) -> relay.Relay:
    """Relay the whole log to the destinations; returns the relay."""
    root = fresh_dir(spark, "relay")
    options = sinks.SinkOptions(root)
    configured = relay.Relay(list(destinations), options, backfill=True, **settings)
    _relay_all(spark, sf_dir, configured)
    return configured


def _delivered(spark: SparkSession, options: sinks.SinkOptions) -> DataFrame:
    """All destinations as (destination, body), read back as they were stored."""
    warehouse = spark.read.parquet(options.path(WAREHOUSE)).select(
        F.lit(WAREHOUSE).alias("destination"),
        F.concat_ws(
            shapes.SEPARATOR,
            "id",
            "operationType",
            F.unix_seconds("clusterTime"),
            "fullDocument",
            "ns",
            "documentKey",
            "updateDescription",
        ).alias("body"),
    )
    others = [
        spark.read.parquet(options.path(TOPIC)).select(F.lit(TOPIC), "value"),
        spark.read.parquet(options.path(KEYED_STREAM)).select(
            F.lit(KEYED_STREAM), F.concat("partition_key", F.lit(" "), "value")
        ),
        spark.read.text(options.path(FILE)).select(F.lit(FILE), "value"),
    ]
    for other in others:
        warehouse = warehouse.union(other)
    return warehouse


def fan_out(spark, sf_dir):
    return _delivered(spark, _relayed(spark, sf_dir).options)


def replay_idempotent(spark, sf_dir):
    """One destination fails in the second batch; the restart leaves one copy of all."""
    state = {"fail": True}
    good = sinks.SINKS[KEYED_STREAM]
    message = "destination is down"

    def fails_once(rows, options, run_id, batch_id):
        if batch_id == 1 and state.pop("fail", False):
            raise ConnectionError(message)
        good.write(rows, options, run_id, batch_id)

    faulty = {**sinks.SINKS, KEYED_STREAM: sinks.Sink(good.shape, fails_once)}
    options = sinks.SinkOptions(fresh_dir(spark, "relay"))
    configured = relay.Relay(list(DESTINATIONS), options, backfill=True, sinks=faulty)
    _relay_all(spark, sf_dir, configured, survive=message)
    return _delivered(spark, options)


def compacted_sink(spark, sf_dir):
    """The warehouse table of a relay whose closed days are compacted after each arrival, read through its manifest."""
    options = sinks.SinkOptions(fresh_dir(spark, "relay"))
    configured = relay.Relay([WAREHOUSE], options, backfill=True, compact_before=lambda: RETENTION_AS_OF)
    _relay_all(spark, sf_dir, configured, after=lambda: relay.compact(configured, spark, "none", 0, least=1))
    stored = compaction.read(spark, relay.tables(configured)[0])
    return stored.select("id", "operationType", "clusterTime", "table", _day_text())


def lookup_relay(spark, sf_dir):
    """Updates get documents that the relay keeps itself, from a log whose updates carry none."""
    root = fresh_dir(spark, "relay")
    kept = state.Documents(f"{root}/documents", buckets=8)
    configured = relay.Relay([WAREHOUSE], sinks.SinkOptions(root), backfill=True, documents=kept)
    _relay_all(spark, sf_dir, configured, lines=table_events.patch_lines)
    stored = _read_table(spark, configured.options.path(WAREHOUSE))
    return stored.select("id", "operationType", "fullDocument")


def position_ledger(spark, sf_dir):
    """The newest position that the relay's ledger holds for each collection."""
    configured = _relayed(spark, sf_dir, [WAREHOUSE])
    return audit.last_position(ledger.read(spark, configured.ledger_path))


def throttled_ledger_stream(spark, sf_dir):
    """The ledger a relay keeps with a save interval, over time-ordered batches."""
    configured = _relayed(spark, sf_dir, [WAREHOUSE], save_interval=SAVE_INTERVAL)
    saved = ledger.read(spark, configured.ledger_path)
    return saved.select("db", "coll", "token", "T", "I")


def quarantine_query(spark, sf_dir):
    """Every event once as it is and once damaged in one of six ways."""
    lines = _lines(spark, sf_dir).select(
        "value",
        (F.try_variant_get(F.try_parse_json("value"), "$.clusterTime.I", "bigint") % 6).alias(
            "damage"
        ),
    )
    replaced = lambda old, new: F.replace("value", F.lit(old), F.lit(new))
    damaged = (
        F.when(F.col("damage") == 0, replaced('"documentKey":', '"documentKey":NaN,"x":'))
        .when(F.col("damage") == 1, replaced('"_data"', '"data"'))
        .when(F.col("damage") == 2, replaced('"operationType"', '"op"'))
        .when(F.col("damage") == 3, replaced('"clusterTime"', '"time"'))
        .when(F.col("damage") == 4, replaced('"coll"', '"collection"'))
        .otherwise(F.concat("value", "value"))
    )
    both = lines.select(
        F.explode(F.array(F.col("value"), damaged)).alias("value")
    )
    labelled = quarantine.label(change_log.decode(change_log.parse(both)))
    return labelled.groupBy(F.coalesce("reason", F.lit("valid")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("events"),
        F.count("raw").alias("raw_lines"),
    )


def dedupe_token(spark, sf_dir):
    """Every event delivered one to five times."""
    events = _events(spark, sf_dir)
    copies = events.withColumn(
        "copy", F.explode(F.sequence(F.lit(0), (F.col("I") % 5).cast("int")))
    ).drop("copy")
    return delivery.first_delivery(copies).select(
        "token", "operationType", "coll", "fullDocument"
    )


def dedupe_stream(spark, sf_dir):
    """The log sent a second time under a new checkpoint, and compacted between: every event is in the table once."""
    root = fresh_dir(spark, "relay")
    kept = delivered.Delivered(f"{root}/delivered", blocks=1 << 10)
    configured = relay.Relay([WAREHOUSE], sinks.SinkOptions(root), backfill=True, seen=kept, compact_before=lambda: RETENTION_AS_OF)
    _relay_all(spark, sf_dir, configured)
    relay.compact(configured, spark, "none", 0, least=1)
    relay.start(configured, change_log.stream_lines(spark, f"{root}/log"), f"{root}/again").awaitTermination()
    stored = compaction.read(spark, relay.tables(configured)[0])
    return stored.select("id", "operationType", "clusterTime", "table", _day_text())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "change_log_scan": change_log_scan,
    "change_log_archive": change_log_archive,
    "namespace_filter": namespace_filter,
    "resume_after_token": resume_after_token,
    "resume_each_collection": resume_each_collection,
    "start_latest": start_latest,
    "indexed_start": indexed_start,
    "event_header": event_header,
    "cluster_time": cluster_time_query,
    "cluster_time_text": cluster_time_text,
    "cluster_time_rfc3339": cluster_time_rfc3339,
    "json_encode_fields": json_encode_fields,
    "null_literal": null_literal,
    "token_extract": token_extract,
    "warehouse_row": warehouse_row,
    "warehouse_row_markup": warehouse_row_markup,
    "delimited_record": delimited_record,
    "delimited_record_text": delimited_record_text,
    "parse_delimited": parse_delimited,
    "parse_delimited_text": parse_delimited_text,
    "keyed_record": keyed_record,
    "ordering_key": ordering_key,
    "file_document": file_document,
    "file_envelope": file_envelope,
    "file_envelope_text": file_envelope_text,
    "full_document_lookup": full_document_lookup,
    "current_state": current_state,
    "state_as_of": state_as_of,
    "state_from_updates": state_from_updates,
    "state_from_bases": state_from_bases,
    "relay_audit": relay_audit,
    "last_position": last_position,
    "ordered_delivery": ordered_delivery,
    "warehouse_sink": warehouse_sink,
    "topic_sink": topic_sink,
    "keyed_stream_sink": keyed_stream_sink,
    "file_sink": file_sink,
    "rolled_file_sink": rolled_file_sink,
    "partition_expiration": partition_expiration,
    "partition_expiration_filter": partition_expiration_filter,
    "route_by_collection": route_by_collection,
    "fan_out": fan_out,
    "replay_idempotent": replay_idempotent,
    "lookup_relay": lookup_relay,
    "compacted_sink": compacted_sink,
    "position_ledger": position_ledger,
    "throttled_ledger": throttled_ledger,
    "throttled_ledger_stream": throttled_ledger_stream,
    "quarantine": quarantine_query,
    "dedupe_token": dedupe_token,
    "dedupe_stream": dedupe_stream,
}
