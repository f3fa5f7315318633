"""Expiry of day partitions."""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAY_COLUMN = "cluster_date"


def first_kept_day(as_of: dt.date, days: int) -> dt.date:
    return as_of - dt.timedelta(days=days)


def unexpired(rows: DataFrame, as_of: dt.date, days: int) -> DataFrame:
    """Rows of day partitions that are not older than ``days`` on ``as_of``.

    The bound is a literal, so on a day-partitioned table it is a partition filter.
    """
    return rows.where(F.col("cluster_date") >= F.lit(first_kept_day(as_of, days)))


def folders(spark: SparkSession, path: str) -> list[str]:
    """The folders directly under a path; nothing when there is no such path."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    found = [s.getPath().toString() for s in files.listStatus(root) if s.isDirectory()]
    return sorted(found)


def day_partitions(spark: SparkSession, path: str) -> list[tuple[dt.date, str]]:
    """(day, folder) of a day-partitioned table; only folder names are listed."""
    found = []
    for folder in folders(spark, path):
        name, _, day = folder.rsplit("/", 1)[-1].partition("=")
        if name == DAY_COLUMN and day != "__HIVE_DEFAULT_PARTITION__":
            found.append((dt.date.fromisoformat(day), folder))
    return sorted(found)


def drop_expired(
    spark: SparkSession,
    path: str,
    as_of: dt.date,
    days: int | None = None,
    newest: int | None = None,
) -> list[dt.date]:
    """Delete day partitions that are too old, or beyond the ``newest`` kept ones.

    ``None`` or 0 sets no limit. Returns the dropped days. The work on the driver
    grows with the number of days, not with the data.
    """
    partitions = day_partitions(spark, path)
    expired = set()
    if days:
        expired |= {day for day, _ in partitions if day < first_kept_day(as_of, days)}
    if newest:
        expired |= {day for day, _ in partitions[:-newest]}
    for day, folder in partitions:
        if day in expired:
            target = spark._jvm.org.apache.hadoop.fs.Path(folder)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return sorted(expired)
