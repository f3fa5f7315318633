"""Destinations as tables of files.

Each destination is the exact row the external service would receive. With a
connector on the classpath only the ``write`` of a sink changes.

Every table is partitioned by target, UTC day, run and batch, and a write replaces
only partitions of its own run and batch. Before a batch is written again, the relay
removes what an earlier attempt left, so a repeat leaves one copy even with other
settings, and a new run (a new checkpoint, whose batch numbers begin at 0 again) never
overwrites an older one. A target that does not exist
begins with its first write; it is not looked for per event.
"""

import sys
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions import cluster_time, shapes
from sluice.schema import BATCH_COLUMNS, FILE, KEYED_STREAM, TOPIC, WAREHOUSE, WAREHOUSE_ROW

MEGABYTE = 1024 * 1024

# Writers of the file destination.
FILES = "file"
STDOUT = "stdout"

# The partition below a batch that tells the files of one task apart, where these are larger than a row may be.
PART = "part"

# A file up to this many bytes is put together in one row.
WHOLE_FILE = MEGABYTE


@dataclass(frozen=True)
class SinkOptions:
    """Targets and format options; ``root`` is the folder that holds all tables."""

    root: str
    targets: dict[str, str] = field(
        default_factory=lambda: {
            WAREHOUSE: "changes",
            TOPIC: "changes",
            KEYED_STREAM: "changes",
            FILE: "changes",
        }
    )
    zone: str = "UTC"
    log_type: str = shapes.DEFAULT_LOG_TYPE
    document_key: str = shapes.DEFAULT_DOCUMENT_KEY
    time_key: str | None = None
    max_megabytes: float | None = None
    writer: str = FILES

    def __post_init__(self):
        if self.writer not in (FILES, STDOUT):
            raise ValueError(f"unknown writer {self.writer!r}")

    def path(self, destination: str) -> str:
        return f"{self.root}/{destination}"

    def target(self, destination: str, events: DataFrame) -> Column:
        """The routed target of each row, or the one configured for the destination."""
        if "target" in events.columns:
            return F.col("target")
        return F.lit(self.targets[destination])


def _day() -> Column:
    return cluster_time.as_date(F.col("T")).alias("cluster_date")


def _with_batch(rows: DataFrame, run_id: str, batch_id: int) -> DataFrame:
    return rows.withColumns(
        {"run_id": F.lit(run_id), "batch_id": F.lit(batch_id).cast("bigint")}
    )


def replace_batch(
    rows: DataFrame, path: str, run_id: str, batch_id: int, partitions: list[str], **options
) -> None:
    """Write the rows of one batch, replacing what an earlier attempt wrote. ``more`` names partitions below the batch."""
    form = options.pop("form", "parquet")
    more = options.pop("more", [])
    (
        _with_batch(rows, run_id, batch_id)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**options)
        .partitionBy(*partitions, *BATCH_COLUMNS, *more)
        .format(form)
        .save(path)
    )


def batch_folder(run_id: str, batch_id: int) -> str:
    return f"run_id={run_id}/batch_id={batch_id}"


def remove(spark: SparkSession, pattern: str) -> None:
    """Remove the folders that a path, or a pattern of paths, names; there may be none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in system.globStatus(place) or []:
        system.delete(found.getPath(), True)


def shape_warehouse(events: DataFrame, options: SinkOptions) -> DataFrame:
    target = options.target(WAREHOUSE, events).alias("table")
    return events.select(target, _day(), *shapes.warehouse_columns())


def shape_topic(events: DataFrame, options: SinkOptions) -> DataFrame:
    """With an ordering key, rows lie in the order of their key and sequence within a topic and day.

    The layout is by range, so a key that holds most rows spans several files, which follow
    each other in order.
    """
    ordered = "ordering_key" in events.columns
    days = events.withColumn("cluster_date", _day())
    key = F.col("ordering_key") if ordered else F.lit(None)
    rows = days.select(
        options.target(TOPIC, events).alias("topic"),
        "cluster_date",
        key.cast("string").alias("ordering_key"),
        cluster_time.sequence(F.col("T"), F.col("I")).alias("sequence"),
        shapes.delimited(options.zone).alias("value"),
    )
    return rows.sort("topic", "cluster_date", "ordering_key", "sequence") if ordered else rows


def shape_keyed_stream(events: DataFrame, options: SinkOptions) -> DataFrame:
    return events.select(
        options.target(KEYED_STREAM, events).alias("stream"),
        _day(),
        F.col("token").alias("partition_key"),
        F.concat(shapes.delimited(options.zone), F.lit("\n")).alias("value"),
    )


def shape_file(events: DataFrame, options: SinkOptions) -> DataFrame:
    line = shapes.file_line(
        options.log_type, options.document_key, options.time_key, options.zone
    )
    return events.select(
        options.target(FILE, events).alias("log"), _day(), line.alias("value")
    )


def _write_table(destination: str, target: str):
    def write(rows: DataFrame, options: SinkOptions, run_id: str, batch_id: int) -> None:
        replace_batch(
            rows, options.path(destination), run_id, batch_id, [target, "cluster_date"]
        )

    return write


def file_numbers(sizes: np.ndarray, number: int, filled: int, limit: int) -> tuple[np.ndarray, int, int]:
    """The number of the file of each line, in order, and the last file with its bytes.

    A new file begins before the line that would take the open one beyond ``limit``. A line that is longer has its own.
    """
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    numbers = np.empty(len(sizes), np.int32)
    at = 0
    while at < len(sizes):
        fit = int(np.searchsorted(ends, ends[at] + limit - filled, side="right")) - 1
        if fit <= at and filled:
            number, filled = number + 1, 0
            continue
        fit = max(fit, at + 1)
        numbers[at:fit] = number
        filled += int(ends[fit] - ends[at])
        at = fit
    return numbers, number, filled


def _by_target(batch: pa.RecordBatch) -> Iterator[tuple[tuple, np.ndarray]]:
    """Log and day of the lines of a batch, with the places of their lines in order."""
    logs, days = (batch.column(name).dictionary_encode() for name in ("log", "cluster_date"))
    group = logs.indices.to_numpy().astype(np.int64) * max(1, len(days.dictionary)) + days.indices.to_numpy()
    order = np.argsort(group, kind="stable")
    bounds = np.flatnonzero(np.diff(group[order], prepend=-1, append=-1))
    for first, end in zip(bounds[:-1], bounds[1:], strict=True):
        lines = order[first:end]
        yield (logs[int(lines[0])].as_py(), days[int(lines[0])].as_py()), lines


def _line_sizes(batch: pa.RecordBatch) -> np.ndarray:
    return pc.binary_length(batch.column("value")).to_numpy(zero_copy_only=False).astype(np.int64) + 1


def rolled(rows: DataFrame, limit: int) -> DataFrame:
    """Lines with the number of their file within the task, so that no file of a log and day has more than ``limit`` bytes.

    Every task fills its own files one after the other while the lines pass: no second scan, no shuffle, and a state
    of two numbers for each log and day of the task. Of two files that follow each other in a task, the second begins
    with a line that did not fit into the first.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_files: dict[tuple, tuple[int, int]] = {}
        for batch in batches:
            sizes = _line_sizes(batch)
            numbers = np.empty(len(sizes), np.int32)
            for key, lines in _by_target(batch):
                number, filled = open_files.get(key, (0, 0))
                numbers[lines], number, filled = file_numbers(sizes[lines], number, filled, limit)
                open_files[key] = (number, filled)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers)], names=[*batch.schema.names, PART])

    return rows.mapInArrow(work, T.StructType([*rows.schema.fields, T.StructField(PART, T.IntegerType())]))


def whole_files(rows: DataFrame, limit: int) -> DataFrame:
    """The lines of each file that ``rolled`` numbers as one row, without the line end of the last one.

    Small files are many, and a folder for each would be listed, renamed and told apart one after the other. A task
    keeps one open file for each log and day that it holds.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_files: dict[tuple, tuple[int, int, list[str]]] = {}

        def files(key: tuple, texts: list[str]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"log": key[0], "cluster_date": key[1], "value": text} for text in texts], schema=schema)

        for batch in batches:
            schema, sizes, values = batch.schema, _line_sizes(batch), batch.column("value")
            for key, lines in _by_target(batch):
                number, filled, pieces = open_files.get(key, (0, 0, []))
                numbers, last, filled = file_numbers(sizes[lines], number, filled, limit)
                bounds = np.concatenate([[0], np.flatnonzero(np.diff(numbers)) + 1, [len(lines)]])
                in_files = pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), values.take(pa.array(lines)))
                texts = pc.binary_join(in_files, "\n").to_pylist()
                if numbers[0] == number:
                    texts[0] = "\n".join([*pieces, texts[0]])
                else:
                    texts.insert(0, "\n".join(pieces))
                open_files[key] = (last, filled, texts[-1:])
                if texts[:-1]:
                    yield files(key, texts[:-1])
        for key, (_, _, pieces) in open_files.items():
            yield files(key, pieces)

    return rows.select("log", "cluster_date", "value").mapInArrow(work, "log string, cluster_date date, value string")


def _print_lines(rows: Iterable) -> None:
    for row in rows:
        sys.stdout.write(row["value"] + "\n")
    sys.stdout.flush()


def _write_lines(rows: DataFrame, options: SinkOptions, run_id: str, batch_id: int) -> None:
    if options.writer == STDOUT:
        # Tasks print their own rows, for an agent that collects the output of the
        # executors. A repeated batch prints again: what was printed stays printed.
        rows.select("value").foreachPartition(_print_lines)
        return
    limit = max(1, int(options.max_megabytes * MEGABYTE)) if options.max_megabytes else None
    settings = {}
    if limit is not None and limit <= WHOLE_FILE:
        rows, settings = whole_files(rows, limit), {"maxRecordsPerFile": 1}
    rows = rows.withColumn(PART, F.lit(0)) if limit is None or settings else rolled(rows, limit)
    replace_batch(rows, options.path(FILE), run_id, batch_id, ["log", "cluster_date"], more=[PART], form="text", **settings)


# What the files of each destination hold, and the column of its targets.
STORED = {
    WAREHOUSE: (WAREHOUSE_ROW, "table"),
    TOPIC: (T.StructType().add("ordering_key", "string").add("sequence", "long").add("value", "string"), "topic"),
    KEYED_STREAM: (T.StructType().add("partition_key", "string").add("value", "string"), "stream"),
    FILE: (T.StructType().add("value", "string"), "log"),
}


@dataclass(frozen=True)
class Sink:
    """A destination: how rows look, and how the rows of one batch are written."""

    shape: Callable[[DataFrame, SinkOptions], DataFrame]
    write: Callable[[DataFrame, SinkOptions, str, int], None]


SINKS = {
    WAREHOUSE: Sink(shape_warehouse, _write_table(WAREHOUSE, "table")),
    TOPIC: Sink(shape_topic, _write_table(TOPIC, "topic")),
    KEYED_STREAM: Sink(shape_keyed_stream, _write_table(KEYED_STREAM, "stream")),
    FILE: Sink(shape_file, _write_lines),
}
