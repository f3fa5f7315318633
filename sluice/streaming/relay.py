"""The relay: every event to every destination, and a position only after all of them.

One micro-batch is decoded and encoded once, kept while all destinations write it at
the same time, and committed when the last one has finished. A failure anywhere
raises, the batch is not committed, and it is written again on restart.
"""

import datetime as dt
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sluice.functions import cluster_time
from sluice.operators import audit, lookup, quarantine, routing
from sluice.schema import DESTINATIONS, FILE
from sluice.sources import change_log, log_index
from sluice.streaming import compaction, delivered, ledger, state
from sluice.streaming.sinks import SINKS, STORED, Sink, SinkOptions, batch_folder, remove, replace_batch

# What the audit holds of every batch.
AUDIT = (
    T.StructType().add("db", "string").add("coll", "string").add("operationType", "string").add("events", "long").add("last_time", "timestamp")
)
COMPACT_EVERY = 8

QUARANTINE = "quarantine"
STRICT = "strict"


@dataclass(frozen=True)
class Relay:
    """What to relay where.

    ``namespace`` (db, and a collection or None) limits what is watched. ``positions``
    are positions that an earlier run has saved: events up to the one of their
    collection are left out. ``snapshot`` is asked in every batch for the current documents that update events
    are given; ``documents`` are kept by the relay itself for the same purpose, from the changes it watches. ``routes`` send each collection to its own targets; without them every collection goes to the one
    target of each destination. ``save_interval`` throttles the position ledger.
    ``index`` is the folder of an index of the log's files (``sources.log_index``), to which every batch adds its own; it
    needs lines that name their file.
    ``compact_before`` says which days are closed: every ``COMPACT_EVERY`` batches their folders become one each.
    ``seen`` remembers what was relayed, and copies of it are left out, whichever run sends them.
    ``backfill`` is for batches that hold many days: see ``by_day``. ``after_batch`` is called when a batch is in all
    destinations and its position is saved, while nothing is being written; it may be called again for a repeated batch.
    """

    destinations: list[str]
    options: SinkOptions
    mode: str = QUARANTINE
    ordering_by: str | None = None
    namespace: tuple[str, str | None] | None = None
    positions: DataFrame | None = None
    snapshot: Callable[[], DataFrame] | None = None
    routes: Iterable[routing.Route] | None = None
    save_interval: int | None = None
    backfill: bool = False
    sinks: dict[str, Sink] | None = None
    after_batch: Callable[[SparkSession], None] | None = None
    index: str | None = None
    documents: state.Documents | None = None
    compact_before: Callable[[], dt.date] | None = None
    seen: delivered.Delivered | None = None

    def __post_init__(self):
        if self.mode not in (QUARANTINE, STRICT):
            raise ValueError(f"unknown mode {self.mode!r}")
        routing.parse_destinations(",".join(self.destinations), project="checked before")
        if self.documents is not None and self.snapshot is not None:
            raise ValueError("documents come from the relay's own table or from another one, not from both")
        if self.routes is not None:
            for r in routing.check_routes(self.routes):
                if r.destination not in self.destinations:
                    raise ValueError(f"a route leads to {r.destination!r}, which is no destination of this relay")

    @property
    def ledger_path(self) -> str:
        return f"{self.options.root}/positions"

    @property
    def audit_path(self) -> str:
        return f"{self.options.root}/audit"

    @property
    def quarantine_path(self) -> str:
        return f"{self.options.root}/quarantine"


def prepare(relay: Relay, lines: DataFrame) -> DataFrame:
    """Decode, check and complete the lines of a batch: events with a ``reason``."""
    return completed(relay, watched(relay, checked(relay, lines)))


def checked(relay: Relay, lines: DataFrame) -> DataFrame:
    """All lines of a batch as events with a ``reason``."""
    decoded = change_log.decode(change_log.parse(lines), relay.ordering_by)
    return quarantine.label(
        decoded,
        relay.ordering_by,
        payloads=True,
        objects_only=_to_file(relay),
    )


def watched(relay: Relay, labelled: DataFrame) -> DataFrame:
    """The events that this relay watches and has not relayed yet."""
    if relay.namespace is not None:
        # Rows without a readable namespace belong to no collection: they stay, and
        # are quarantined.
        db, coll = relay.namespace
        watched = F.col("db") == db
        if coll is not None:
            watched = watched & (F.col("coll") == coll)
        labelled = labelled.where(F.coalesce(watched, F.lit(True)))
    if relay.positions is not None:
        labelled = ledger.resume_each(labelled, relay.positions)
    return labelled


def completed(relay: Relay, labelled: DataFrame) -> DataFrame:
    """Events that were not relayed before, updates with the current document of their key."""
    spark = labelled.sparkSession
    if relay.seen is not None:
        labelled = delivered.unseen(spark, relay.seen, labelled)
    if relay.documents is not None:
        touched = state.advance(spark, relay.documents, quarantine.valid(labelled))
        labelled = state.attach(spark, relay.documents, labelled, touched)
    if relay.snapshot is not None:
        labelled = lookup.attach_documents(labelled, relay.snapshot())
    return labelled


def tables(relay: Relay) -> list[compaction.Table]:
    """The destinations' tables, what was delivered, the ledger and the audit."""
    found = []
    for name in relay.destinations:
        columns, target = STORED[name]
        found.append(compaction.Table(relay.options.path(name), columns, target, compaction.TEXT if name == FILE else compaction.PARQUET))
    if relay.seen is not None:
        found += relay.seen.tables
    return [*found, ledger.table(relay.ledger_path), compaction.Table(relay.audit_path, AUDIT, fold=_summed)]


def _summed(rows: DataFrame) -> DataFrame:
    """Counts of many batches as one row for each collection and operation, under the newest batch."""
    return rows.groupBy("db", "coll", "operationType").agg(
        F.sum("events").alias("events"),
        F.max("last_time").alias("last_time"),
        F.max_by("run_id", "last_time").alias("run_id"),
        F.max("batch_id").alias("batch_id"),
    )


def compact(relay: Relay, spark: SparkSession, run_id: str, batch_id: int, least: int = compaction.LEAST) -> None:
    """Make the tables of closed days small again; the batch just written may be repeated and stays as it is."""
    for table in tables(relay):
        compaction.compact(spark, table, relay.compact_before(), (run_id, batch_id), least)


def _to_file(relay: Relay) -> Column | bool:
    """Which events the file destination gets; only its documents must hold objects."""
    if FILE not in relay.destinations or relay.routes is None:
        return FILE in relay.destinations
    names = [f"{r.db}\0{r.coll}" for r in map(routing.Route._make, relay.routes) if r.destination == FILE]
    return F.concat_ws("\0", "db", "coll").isin(names)


def _delivered(relay: Relay, events: DataFrame) -> DataFrame:
    """Events that some destination gets: those without a route are not relayed."""
    if relay.routes is None:
        return events
    names = {f"{r.db}\0{r.coll}" for r in map(routing.Route._make, relay.routes)}
    return events.where(F.concat_ws("\0", "db", "coll").isin(sorted(names)))


def by_day(labelled: DataFrame) -> DataFrame:
    """Bring the rows of a day together, so that few tasks write to its partitions.

    Every task writes one file per day it holds. A live batch holds one or two days
    and needs no shuffle; the batches of a backfill hold many, and without this every
    task would write a file into each of them. Large days are split over tasks and
    small days share one, by size.
    """
    days = labelled.withColumn("cluster_date", cluster_time.as_date(F.col("T")))
    return days.hint("rebalance", "cluster_date").drop("cluster_date")


def _together(spark: SparkSession, tasks: list[Callable[[], None]]) -> None:
    """Run all tasks at the same time, wait for all, then raise the first failure.

    The threads carry the job group and scheduler pool of the caller, so stopping the
    stream also cancels what they run.
    """
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=max(1, len(tasks))) as pool:
        running = [pool.submit(inherit(task)) for task in tasks]
    for done in running:
        done.result()


def _forget(relay: Relay, spark: SparkSession, run_id: str, batch_id: int) -> None:
    """Remove what an earlier attempt of this batch wrote.

    With other settings, or with other rows rejected, it may have filled partitions that the
    new attempt does not. The audit is the first table of an attempt and the last removed, so
    where there is none the destinations need not be searched.
    """
    own = batch_folder(run_id, batch_id)
    remove(spark, f"{relay.ledger_path}/{own}")
    remove(spark, f"{relay.quarantine_path}/{own}")
    if ledger.exists(spark, f"{relay.audit_path}/{own}"):
        for name in DESTINATIONS:
            remove(spark, f"{relay.options.path(name)}/*/*/{own}")
        for table in relay.seen.tables if relay.seen is not None else []:
            remove(spark, f"{table.path}/*/*/{own}")
        remove(spark, f"{relay.audit_path}/{own}")


def relay_batch(relay: Relay, lines: DataFrame, run_id: str, batch_id: int) -> None:
    """Relay one batch of lines. The same run and batch can be relayed again."""
    _forget(relay, lines.sparkSession, run_id, batch_id)
    every_line = checked(relay, lines)
    if relay.index is not None or relay.documents is not None or relay.seen is not None:
        # The index is of whole files, also of what this relay leaves out, documents are read before they are
        # attached, and copies are looked for first; all lines are kept, so they are parsed once.
        every_line = every_line.persist(StorageLevel.MEMORY_AND_DISK)
    labelled = completed(relay, watched(relay, every_line))
    if relay.backfill:
        labelled = by_day(labelled)
    labelled = labelled.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if relay.index is not None:
            replace_batch(log_index.describe(every_line), relay.index, run_id, batch_id, [])
        if relay.mode == STRICT:
            events = quarantine.require_valid(labelled)
        else:
            events = quarantine.valid(labelled)
        events = _delivered(relay, events)
        # The first job reads the source once and fills the cache for all others.
        replace_batch(audit.relay_audit(events), relay.audit_path, run_id, batch_id, [])
        deliveries = _deliveries(relay, events, run_id, batch_id)
        if relay.mode == QUARANTINE:
            rejected = quarantine.rejected(labelled)
            deliveries.append(
                lambda: replace_batch(
                    rejected, relay.quarantine_path, run_id, batch_id, []
                )
            )
        _together(lines.sparkSession, deliveries)
        if relay.seen is not None:
            delivered.record(relay.seen, events, run_id, batch_id)
        ledger.save(events, relay.ledger_path, run_id, batch_id, relay.save_interval)
    finally:
        labelled.unpersist()
        every_line.unpersist()


def _deliveries(
    relay: Relay, events: DataFrame, run_id: str, batch_id: int
) -> list[Callable[[], None]]:
    """One task per destination; all read the same kept events."""
    if relay.routes is not None:
        events = routing.route(events.sparkSession, events, relay.routes)

    def deliver(name: str) -> Callable[[], None]:
        sink = (relay.sinks or SINKS)[name]
        mine = events
        if relay.routes is not None:
            mine = events.where(F.col("destination") == name)
        rows = sink.shape(mine, relay.options)
        return lambda: sink.write(rows, relay.options, run_id, batch_id)

    return [deliver(name) for name in relay.destinations]


def start(
    relay: Relay,
    lines: DataFrame,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start relaying a stream of lines; by default all that is there, then stop.

    The run is the stream's own identity, which its checkpoint keeps across
    restarts, so a repeated batch replaces its earlier attempt.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        run_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        relay_batch(relay, batch, run_id, batch_id)
        if relay.compact_before is not None and batch_id % COMPACT_EVERY == COMPACT_EVERY - 1:
            compact(relay, batch.sparkSession, run_id, batch_id)
        if relay.after_batch is not None:
            relay.after_batch(batch.sparkSession)

    return (
        lines.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
