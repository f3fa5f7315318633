"""Tables of day, run and batch folders made small again.

Every batch adds folders to every day it holds. Of closed days the folders of committed batches are written into one
content folder each, and a manifest says which content is live and which batch folders it covers; readers that go through
``read`` see a batch folder or the content that covers it, never both. Covered folders are removed one compaction later,
when no reader of the version before can need them. The batch that is just ending may be repeated and is left as it is.

Positions and audits have no days: their committed batches are folded into the newest position of each collection,
and into sums.
"""

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.streaming import manifest
from sluice.streaming.sinks import batch_folder

TEXT = "text"
PARQUET = "parquet"
_BATCH = [T.StructField("run_id", T.StringType()), T.StructField("batch_id", T.LongType())]
_COVERED = "covered:"
#: Batch folders that a closed day has at least before it is written anew.
LEAST = 8


@dataclass(frozen=True)
class Table:
    """``columns`` are those of the files; ``target`` is the partition above the day, or None where there is no day.

    ``fold`` makes the rows of many batches fewer; without it they stay as they are.
    """

    path: str
    columns: T.StructType
    target: str | None = None
    form: str = PARQUET
    fold: Callable[[DataFrame], DataFrame] | None = None

    @property
    def closed(self) -> str:
        return f"{self.path}_closed"

    @property
    def parts(self) -> list[T.StructField]:
        if self.target is None:
            return []
        return [T.StructField(self.target, T.StringType()), T.StructField("cluster_date", T.DateType())]

    @property
    def depth(self) -> int:
        return len(self.parts)

    @property
    def kept(self) -> T.StructType:
        """Columns of content files: with Parquet, the batch of each row as well."""
        return T.StructType([*self.columns.fields, *(_BATCH if self.form == PARQUET else [])])


def _batches(spark: SparkSession, table: Table) -> list[str]:
    """Batch folders below the table, as part/run/batch."""
    place = spark._jvm.org.apache.hadoop.fs.Path(table.path + "/*" * table.depth + "/run_id=*/batch_id=*")
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [status.getPath().toUri().getPath() for status in system.globStatus(place) or []]
    return sorted("/".join(path.split("/")[-table.depth - 2 :]) for path in found)


def _part(folder: str) -> str:
    return "/".join(folder.split("/")[:-2])


def _covered(version: manifest.Version) -> set[str]:
    return {folder for part, folders in version.parts.items() if part.startswith(_COVERED) for folder in folders}


def _content(version: manifest.Version, parts: set[str] | None = None) -> list[str]:
    return version.folders([p for p in version.parts if not p.startswith(_COVERED) and (parts is None or p in parts)])


def _raw(spark: SparkSession, table: Table, folders: list[str]) -> DataFrame:
    schema = T.StructType([*table.columns.fields, *table.parts, *_BATCH])
    if not folders:
        return spark.createDataFrame([], schema)
    places = [f"{table.path}/{folder}" for folder in folders]
    return spark.read.format(table.form).schema(schema).option("basePath", table.path).load(places)


def _stored(spark: SparkSession, table: Table, places: list[str]) -> DataFrame:
    schema = T.StructType([*table.kept.fields, *table.parts])
    if not places:
        return spark.createDataFrame([], schema)
    content = T.StructField("content", T.StringType())
    rows = spark.read.format(table.form).schema(T.StructType([*schema.fields, content]))
    return rows.option("basePath", f"{table.closed}/data").load(places).drop("content")


def read(spark: SparkSession, table: Table) -> DataFrame:
    """The live rows: content of closed days, and the batch folders that it does not cover."""
    version = manifest.current(spark, table.closed)
    covered = _covered(version)
    raw = _raw(spark, table, [folder for folder in _batches(spark, table) if folder not in covered])
    stored = _stored(spark, table, _content(version))
    return stored.select(*stored.columns).unionByName(raw.select(*stored.columns))


def _closed(part: str, before: dt.date | None) -> bool:
    if before is None:
        return True
    day = part.rsplit("=", 1)[-1]
    return day != "__HIVE_DEFAULT_PARTITION__" and dt.date.fromisoformat(day) < before


def compact(
    spark: SparkSession, table: Table, before: dt.date | None = None, open_batch: tuple[str, int] | None = None, least: int = LEAST
) -> list[str]:
    """Write the batch folders of closed days into content; returns the parts that were written.

    Days earlier than ``before`` are closed; a table without days always is. ``open_batch`` is left out. A part is
    written once it has ``least`` batch folders, so what it already has is not copied for each one. The folders are
    read and written by one job, whatever their number.
    """
    version = manifest.current(spark, table.closed)
    covered = _covered(version)
    there = _batches(spark, table)
    for folder in covered & set(there):
        _remove(spark, f"{table.path}/{folder}")
    own = None if open_batch is None else batch_folder(*open_batch)
    fresh: dict[str, list[str]] = {}
    for folder in there:
        if folder not in covered and not (own and folder.endswith(own)) and _closed(_part(folder), before if table.target else None):
            fresh.setdefault(_part(folder), []).append(folder)
    fresh = {part: folders for part, folders in fresh.items() if len(folders) >= least}
    if not fresh:
        return []
    names = [field.name for field in table.parts]
    raw = _raw(spark, table, [folder for folders in fresh.values() for folder in folders])
    rows = _stored(spark, table, _content(version, {p or "all" for p in fresh}))
    rows = rows.unionByName(raw.select(*rows.columns))
    if table.fold is not None:
        rows = table.fold(rows).select(*rows.columns)
    name = uuid.uuid4().hex
    rows = rows.withColumn("content", F.lit(name))
    if names:
        rows = rows.hint("rebalance", *names)
    else:
        rows = rows.coalesce(1)
    rows.write.mode("append").partitionBy(*names, "content").format(table.form).save(f"{table.closed}/data")
    parts = {p: folders for p, folders in version.parts.items() if not p.startswith(_COVERED)}
    for part, folders in fresh.items():
        parts[part or "all"] = ["/".join(["data", *([part] if part else []), f"content={name}"])]
        parts[_COVERED + part] = folders
    manifest.swap(spark, version, parts, table.depth + 1)
    return sorted(fresh)


def drop_expired(spark: SparkSession, table: Table, first_day: dt.date) -> None:
    """Content of days before ``first_day`` leaves the table."""
    version = manifest.current(spark, table.closed)
    kept = {p: f for p, f in version.parts.items() if p.startswith(_COVERED) or not _closed(p, first_day)}
    if kept != version.parts:
        manifest.swap(spark, version, kept, table.depth + 1)


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    system.delete(place, True)
    # The run's folder, and the day's, when nothing is left in them.
    parent = place.getParent()
    while parent.getName().find("=") > 0 and not system.listStatus(parent):
        system.delete(parent, False)
        parent = parent.getParent()
