"""A relay as one Spark job: ``spark-submit sluice/job.py --log … --root … …``.

The options are those of a relay process per collection; one job can carry many
collections. Where the checkpoint exists the job continues there. Otherwise it
begins after a saved token, after the positions of an older ledger, at the newest
event, or at the beginning, and remembers that choice.
"""

import argparse
import dataclasses
import datetime as dt
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sluice.operators import audit, lookup, quarantine, retention, routing  # noqa: E402
from sluice.schema import DESTINATIONS, FILE, WAREHOUSE  # noqa: E402
from sluice.sources import change_log, log_index  # noqa: E402
from sluice.streaming import compaction, delivered, ledger, manifest, relay, sinks, state  # noqa: E402


def arguments(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="sluice")
    parser.add_argument("--log", required=True, help="folder of change-event lines")
    parser.add_argument("--root", required=True, help="folder of all destinations")
    parser.add_argument("--checkpoint", help="default: <root>/checkpoint")
    parser.add_argument("--index", help="index of the log's files, which relays of one log may share; default: <root>/log-index")
    parser.add_argument("--destinations", required=True, help=",".join(DESTINATIONS))
    parser.add_argument("--project", help="needed by the hosted destinations")
    parser.add_argument("--db")
    parser.add_argument("--coll")
    parser.add_argument("--resume-token", help="begin after this token; needs --coll")
    parser.add_argument("--resume-ledger", help="begin after the positions of this ledger")
    parser.add_argument(
        "--start", choices=[change_log.EARLIEST, change_log.LATEST], default=change_log.LATEST
    )
    parser.add_argument("--mode", choices=[relay.QUARANTINE, relay.STRICT], default=relay.QUARANTINE)
    parser.add_argument("--ordering-by", help="top-level event field")
    parser.add_argument(
        "--lookup",
        metavar="FOLDER",
        help="table of current documents (db, coll, documentKey, fullDocument) that update events are given",
    )
    parser.add_argument(
        "--keep-documents", action="store_true", help="update events are given documents that the relay keeps itself"
    )
    parser.add_argument("--buckets", type=int, default=state.BUCKETS, help="parts of the kept documents")
    parser.add_argument("--drop-copies", action="store_true", help="events that any run relayed before are left out")
    parser.add_argument("--filter-blocks", type=int, default=delivered.BLOCKS, help="blocks of 32 bytes of a day's filter of tokens")
    parser.add_argument("--save-interval", type=int, help="seconds")
    parser.add_argument("--target", action="append", default=[], metavar="DESTINATION=NAME")
    parser.add_argument(
        "--route", action="append", default=[], metavar="DB.COLL=DESTINATION:TARGET"
    )
    parser.add_argument("--zone", default="UTC")
    parser.add_argument("--log-type", default="")
    parser.add_argument("--document-key", default="")
    parser.add_argument("--time-key")
    parser.add_argument("--writer", choices=[sinks.FILES, sinks.STDOUT], default=sinks.FILES)
    parser.add_argument("--max-megabytes", type=float)
    parser.add_argument("--expire-days", type=int, help="keep this many days")
    parser.add_argument("--expire-backups", type=int, help="keep this many newest days")
    parser.add_argument("--compact-days", type=int, help="days older than this many are closed: their folders become one each")
    parser.add_argument("--max-bytes-per-trigger", type=int, default=64 * 2**30)
    parser.add_argument("--backfill", action="store_true", help="batches hold many days")
    parser.add_argument("--every", help="trigger interval; default: all there is, then stop")
    parsed = parser.parse_args(argv)
    if parsed.resume_token and not (parsed.db and parsed.coll):
        parser.error("--resume-token needs --db and --coll")
    if parsed.coll and not parsed.db:
        parser.error("--coll needs --db")
    if parsed.lookup and parsed.keep_documents:
        parser.error("--lookup and --keep-documents exclude each other")
    if parsed.compact_days is not None and parsed.expire_backups:
        parser.error("--expire-backups counts the folders of days, which --compact-days takes away")
    return parsed


def _route(text: str) -> routing.Route:
    namespace, _, place = text.partition("=")
    db, _, coll = namespace.partition(".")
    destination, _, target = place.partition(":")
    return routing.Route(db, coll, destination, target)


def begin_after(spark: SparkSession, options: argparse.Namespace, index: DataFrame) -> DataFrame | None:
    """Positions after which a relay without a checkpoint begins. The index of the log's files answers for the log."""
    older = None
    if options.resume_ledger:
        older = ledger.read(spark, options.resume_ledger)
        if older is None:
            raise LookupError(f"there is no ledger at {options.resume_ledger}")
    if options.start == change_log.EARLIEST and not options.resume_token:
        return None if older is None else audit.last_position(older)
    if older is not None and not options.resume_token:
        return audit.last_position(older)

    if not options.resume_token:
        return log_index.positions(index, options.db, options.coll)
    token = options.resume_token.rstrip("\n")
    if older is not None:
        found = audit.last_position(older.where(F.col("token") == token))
        if not found.isEmpty():
            return found
    found = log_index.position_of(spark, options.log, index, token)
    if found is not None and options.db:
        found = change_log.in_namespace(found, options.db, options.coll, must_exist=False)
    if found is None or found.isEmpty():
        raise LookupError(f"the saved token is not in the log: {token!r}")
    return found


def current_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The lookup table as it is now; every batch asks again."""
    return spark.read.parquet(folder).select(*lookup.KEY, "fullDocument")


def index_folder(options: argparse.Namespace) -> str:
    return options.index or f"{options.root}/log-index"


def configure(spark: SparkSession, options: argparse.Namespace, index: DataFrame) -> relay.Relay:
    targets = dict(text.split("=", 1) for text in options.target)
    defaults = sinks.SinkOptions(options.root).targets
    return relay.Relay(
        destinations=routing.parse_destinations(options.destinations, options.project),
        options=sinks.SinkOptions(
            options.root,
            targets={**defaults, **targets},
            zone=options.zone,
            log_type=options.log_type,
            document_key=options.document_key,
            time_key=options.time_key,
            max_megabytes=options.max_megabytes,
            writer=options.writer,
        ),
        mode=options.mode,
        ordering_by=options.ordering_by,
        namespace=(options.db, options.coll) if options.db else None,
        positions=ledger.remember_start(
            spark, f"{options.root}/start", lambda: begin_after(spark, options, index)
        ),
        snapshot=(lambda: current_documents(spark, options.lookup)) if options.lookup else None,
        routes=[_route(text) for text in options.route] or None,
        save_interval=options.save_interval,
        backfill=options.backfill,
        index=index_folder(options),
        compact_before=(lambda: today() - dt.timedelta(days=options.compact_days)) if options.compact_days is not None else None,
        documents=state.Documents(f"{options.root}/documents", options.buckets) if options.keep_documents else None,
        seen=delivered.Delivered(f"{options.root}/delivered", options.filter_blocks) if options.drop_copies else None,
    )


def today() -> dt.date:
    return dt.datetime.now(dt.timezone.utc).date()


def expire(spark: SparkSession, configured: relay.Relay, options: argparse.Namespace) -> None:
    """Apply the retention limits to the tables of the day-partitioned destinations."""
    if not (options.expire_days or options.expire_backups):
        return
    for destination in {WAREHOUSE, FILE} & set(configured.destinations):
        # The count limit is the file destination's own, as it has backups.
        newest = options.expire_backups if destination == FILE else None
        for folder in retention.folders(spark, configured.options.path(destination)):
            retention.drop_expired(spark, folder, today(), options.expire_days, newest)
    if options.expire_days and configured.seen is not None:
        for table in configured.seen.tables:
            for folder in retention.folders(spark, table.path):
                retention.drop_expired(spark, folder, today(), options.expire_days)
    if options.expire_days and configured.compact_before is not None:
        for table in relay.tables(configured):
            if table.target is not None:
                compaction.drop_expired(spark, table, retention.first_kept_day(today(), options.expire_days))


def build_documents(spark: SparkSession, configured: relay.Relay, options: argparse.Namespace) -> None:
    """Documents of the log so far, once, for a relay that begins behind its first event."""
    kept = configured.documents
    if kept is None or manifest.current(spark, kept.path).number or configured.positions.isEmpty():
        return
    lines = change_log.read_lines(spark, options.log)
    events = quarantine.valid(log_index.labelled_headers(lines))
    if configured.namespace is not None:
        events = change_log.in_namespace(events, *configured.namespace, must_exist=False)
    state.advance(spark, kept, events)


def begin(spark: SparkSession, options: argparse.Namespace) -> StreamingQuery:
    """Start the relay. Expired days are dropped after every batch, so a stream that never ends keeps its limits."""
    # Only files that are not in the index are opened before the stream begins.
    log_index.refresh(spark, options.log, index_folder(options))
    index = log_index.in_folder(spark, options.log, index_folder(options))
    if options.db:
        log_index.require_namespace(index, options.db, options.coll)
    configured = configure(spark, options, index)
    configured = dataclasses.replace(
        configured, after_batch=lambda session: expire(session, configured, options)
    )
    build_documents(spark, configured, options)
    done = log_index.passed(index, configured.positions, configured.namespace)
    lines = change_log.stream_lines(
        spark, options.log, without=done, named=True, maxBytesPerTrigger=options.max_bytes_per_trigger
    )
    trigger = {"processingTime": options.every} if options.every else {"availableNow": True}
    checkpoint = options.checkpoint or f"{options.root}/checkpoint"
    # Once before the first batch as well, as a restart may find nothing new for a long time.
    expire(spark, configured, options)
    return relay.start(configured, lines, checkpoint, trigger)


def main(argv: list[str] | None = None) -> None:
    options = arguments(sys.argv[1:] if argv is None else argv)
    spark = SparkSession.builder.appName("sluice").getOrCreate()
    begin(spark, options).awaitTermination()


if __name__ == "__main__":
    main()
