"""Scan, decode and position a change log.

Two stored forms are read:

* text lines, one JSON change event per line (what a collector writes), and
* an archive: Parquet with the encoded event columns, partitioned by UTC day,
  where header filters prune partitions and reach the scan.
"""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions import cluster_time, envelope, json_text
from sluice.schema import ENCODED_EVENT, PAYLOAD_FIELDS

EARLIEST = "earliest"
LATEST = "latest"


# Names the file of a line where it is known.
FILE = "file"
# Events in one file of the archive, at most. A file is mostly one row group, and a row group is read by one task.
FILE_EVENTS = 100_000


def file_name() -> Column:
    """Hash of path, size and modification time, which Spark knows before it opens a file."""
    return F.xxhash64("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")


def _chosen(lines: DataFrame, only: Iterable[int] | None, without: Iterable[int], named: bool) -> DataFrame:
    # Filters on the name alone reach the listing of files.
    if only is not None:
        lines = lines.where(file_name().isin(list(only)))
    if without := list(without):
        lines = lines.where(~file_name().isin(without))
    return lines.select("value", file_name().alias(FILE)) if named else lines.select("value")


def read_lines(
    spark: SparkSession, path: str, only: Iterable[int] | None = None, without: Iterable[int] = (), named: bool = False
) -> DataFrame:
    """Lines of a folder; of the named files ``only``, or ``without`` them, which are then not opened."""
    return _chosen(spark.read.text(path), only, without, named)


def stream_lines(
    spark: SparkSession, path: str, without: Iterable[int] = (), named: bool = False, **options
) -> DataFrame:
    """New files of a folder as they arrive.

    ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` bounds a micro-batch, which is
    how a long backlog is worked off in pieces that fit the cluster. Any other stream
    with a string column ``value`` can take the place of this one. Files named in
    ``without`` are not opened; ``named`` adds the name of each line's file.
    """
    # Spark skips files much older than the newest one it has seen, a week by default;
    # a change log may not lose any.
    options = {"maxFileAge": "36500d"} | options
    return _chosen(spark.readStream.format("text").options(**options).load(path), None, without, named)


def parse(lines: DataFrame) -> DataFrame:
    """``value`` lines -> ``raw`` and ``line``, a variant array that holds the event.

    The line is parsed as the first element of an array whose second is a hash of the
    line: the parser stops after the first complete value, so glued events, or text
    after a closing bracket, would otherwise pass as their first value. ``line`` is NULL
    for text that is no JSON.
    """
    seal = F.xxhash64("value").cast("string")
    whole = F.try_parse_json(F.concat(F.lit("["), F.col("value"), F.lit(","), seal, F.lit("]")))
    return lines.select(F.col("value").alias("raw"), whole.alias("line"), *_file(lines))


def _file(rows: DataFrame) -> list[str]:
    return [FILE] if FILE in rows.columns else []


def decode(parsed: DataFrame, ordering_by: str | None = None) -> DataFrame:
    """``line`` -> the encoded event columns, next to the ``raw`` text.

    Payloads become canonical JSON text once, to be reused by every destination.
    Header fields that are absent or of another type are NULL; see
    ``operators.quarantine`` for what happens to such rows.

    The header passes through a one-element ``inline``. Filters on header fields stay
    above it; otherwise they would be moved below the projection with the parsing
    expression copied into them, and every line would be parsed many times over.
    Payload columns are left out of it, so unused ones are pruned.
    """
    file = _file(parsed)
    # Most lines end with the bracket, and to trim a line costs more than to look at its end.
    closed = F.col("raw").endswith("}") | F.expr(r"btrim(raw, ' \t\r\n')").endswith("}")
    first = {"parsed": envelope.is_single() & closed}
    if ordering_by:
        first["ordering_key"] = envelope.ordering_key(ordering_by)
    event = parsed.select("raw", envelope.fields().alias("event"), *file, *[c.alias(name) for name, c in first.items()])
    # A step for each use, so that what is used twice is computed once.
    kept = ["raw", "event", *file, *first]
    found = event.select(*kept, *[envelope.found(name).alias(name) for name in envelope.HEADER_FIELDS])
    typed = found.select(*kept, *[envelope.typed(name).alias(name) for name in envelope.HEADER_FIELDS])
    header = {name: F.col(name) for name in first} | {name: envelope.in_range(name) for name in envelope.HEADER_FIELDS}
    named = [column.alias(name) for name, column in header.items()]
    once = typed.select("raw", "event", *file, F.inline(F.array(F.struct(*named))))
    payloads = [json_text.encode(F.col("event")[name]).alias(name) for name in PAYLOAD_FIELDS]
    return once.select("raw", *file, *header, *payloads)


def encoded_columns(events: DataFrame) -> list[str]:
    extra = [c for c in ("ordering_key", FILE) if c in events.columns]
    return [*ENCODED_EVENT.names, *extra]


def write_archive(events: DataFrame, path: str, mode: str = "append") -> None:
    """Store encoded events as a day-partitioned archive.

    Rows are rebalanced by day first: days become few files of even size, and a day
    that holds most rows is split over several tasks. Files hold at most ``FILE_EVENTS``, so
    the days of a replay are read by as many tasks as their events need.
    """
    days = events.select(*encoded_columns(events)).withColumn(
        "cluster_date", cluster_time.as_date(F.col("T"))
    )
    (
        days.hint("rebalance", "cluster_date")
        .write.mode(mode)
        .partitionBy("cluster_date")
        .option("maxRecordsPerFile", FILE_EVENTS)
        .parquet(path)
    )


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def in_namespace(
    events: DataFrame, db: str, coll: str | None = None, must_exist: bool = True
) -> DataFrame:
    """Events of one collection, or of a whole database.

    On a batch log a missing database or collection is an error, as it is for the
    watched server. A stream cannot be probed, so ``must_exist`` is ignored there.
    """
    in_db = events.where(F.col("db") == db)
    selected = in_db if coll is None else in_db.where(F.col("coll") == coll)
    if must_exist and not events.isStreaming and selected.isEmpty():
        if coll is not None and not in_db.isEmpty():
            raise LookupError(f"collection {coll!r} does not exist in database {db!r}")
        raise LookupError(f"database {db!r} does not exist in the log")
    return selected


def after_position(events: DataFrame, seconds: int, ordinal: int) -> DataFrame:
    """Events strictly after (T, I).

    Both bounds are literals, so on an archive the first conjunct prunes day
    partitions and the second reaches the Parquet scan.
    """
    later = (F.col("T") > seconds) | ((F.col("T") == seconds) & (F.col("I") > ordinal))
    selected = events.where(F.col("T") >= seconds).where(later)
    if "cluster_date" in events.columns:
        first_day = cluster_time.as_date(F.lit(seconds).cast("bigint"))
        selected = selected.where(F.col("cluster_date") >= first_day)
    return selected


def resume_after(
    events: DataFrame, saved_token: str, positions: DataFrame | None = None
) -> DataFrame:
    """Events strictly after the event that holds the saved token.

    ``positions`` (a position ledger) is looked up first: it is far smaller than the
    log. One row comes back to the driver, whatever the size of the log.
    """
    wanted = saved_token.rstrip("\n")
    for place in (positions, events):
        if place is None:
            continue
        found = place.where(F.col("token") == wanted).select("T", "I").first()
        if found is not None:
            return after_position(events, found["T"], found["I"])
    raise LookupError(f"the saved token is not in the log: {wanted!r}")


def head_position(events: DataFrame) -> tuple[int, int] | None:
    """(T, I) of the newest event now in the log, or None for an empty log."""
    newest = events.agg(
        F.max(cluster_time.sequence(F.col("T"), F.col("I"))).alias("head")
    ).first()["head"]
    if newest is None:
        return None
    return cluster_time.unpacked(newest)


def start_from(events: DataFrame, start: str, present: DataFrame | None = None) -> DataFrame:
    """Where reading begins when no token was saved.

    ``earliest`` reads everything. ``latest`` reads only what comes after the newest
    event of ``present``, the log as it is when the relay starts.
    """
    if start == EARLIEST:
        return events
    if start != LATEST:
        raise ValueError(f"unknown start position {start!r}")
    if present is None:
        if events.isStreaming:
            raise ValueError("a stream needs the present log to begin after it")
        present = events
    head = head_position(present)
    return events if head is None else after_position(events, *head)
