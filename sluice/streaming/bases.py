"""Documents as they were at any time: a base every few days, and a replay of the days after it.

The base of a day holds the newest write to each place of all events before that day (UTC). It is composed of the base before
it and of the days between the two, so no day of the archive is read twice to make bases. A time is answered from the
newest base that is not after it and the days from there on; older days are pruned by their partition. Composition takes the newer write of each place,
so an event that is in a base and also replayed, or that is amended twice, changes nothing.

``events`` is everywhere an archive as ``change_log.read_archive`` gives it: encoded events with ``cluster_date``.
"""

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions import cluster_time
from sluice.operators import patches
from sluice.streaming import manifest

EVERY = 7
SECONDS = 86400
_EPOCH = dt.date(1970, 1, 1)


@dataclass(frozen=True)
class Bases:
    """Where the bases are kept, and how many days lie between two. A replay reads at most ``every`` days and the rest of one."""

    path: str
    every: int = EVERY

    def __post_init__(self):
        if self.every < 1:
            raise ValueError(f"bases lie {self.every} days apart")

    def days(self, after: dt.date, until: dt.date) -> list[dt.date]:
        """Days of bases later than ``after`` and not later than ``until``: the same ones whenever they are asked for."""
        first, last = (day.toordinal() - _EPOCH.toordinal() for day in (after, until))
        return [_EPOCH + dt.timedelta(days=n * self.every) for n in range(first // self.every + 1, last // self.every + 1)]


def _day_of(seconds: int) -> dt.date:
    return _EPOCH + dt.timedelta(days=seconds // SECONDS)


def _between(events: DataFrame, since: dt.date | None, before: dt.date) -> DataFrame:
    """Events of whole days; the bounds are literals and prune day partitions."""
    rows = events.where(F.col("cluster_date") < F.lit(before))
    return rows if since is None else rows.where(F.col("cluster_date") >= F.lit(since))


def _held(spark: SparkSession, version: manifest.Version, day: dt.date) -> DataFrame:
    return spark.read.schema(patches.WRITES).parquet(*version.folders([day.isoformat()]))


def _days(version: manifest.Version) -> list[dt.date]:
    return sorted(map(dt.date.fromisoformat, version.parts))


def _store(rows: DataFrame, kept: Bases) -> str:
    folder = manifest.new_folder()
    rows.hint("rebalance").write.parquet(f"{kept.path}/{folder}")
    return folder


def advance(spark: SparkSession, kept: Bases, events: DataFrame, closed: dt.date) -> list[dt.date]:
    """Make the bases that are due; returns their days. All events before the day ``closed`` are in the archive, but for late ones.

    Every base is swapped in by itself, so an advance that is cut off goes on after the last base it has made. An
    archive without events has no base.
    """
    held = manifest.current(spark, kept.path)
    last = max(_days(held), default=None)
    first = last
    if first is None:
        # The least value of a partition column: no column of the files is read.
        first = events.agg(F.min("cluster_date").alias("first")).first()["first"]
        if first is None:
            return []
    made = kept.days(first, closed)
    for day in made:
        groups = [patches.writes(_between(events, last, day))]
        if last is not None:
            groups.append(_held(spark, held, last))
        folder = _store(patches.composed(*groups), kept)
        held = manifest.swap(spark, held, held.parts | {day.isoformat(): [folder]})
        last = day
    return made


def amend(spark: SparkSession, kept: Bases, late: DataFrame) -> list[dt.date]:
    """Compose late events, which are also in the archive, into all bases after them; returns the days of these.

    Every such base is written anew, and all are swapped in one step. To amend events again changes nothing.
    """
    held = manifest.current(spark, kept.path)
    earliest = late.agg(F.min("T").alias("earliest")).first()["earliest"]
    if earliest is None:
        return []
    stale = [day for day in _days(held) if day > _day_of(earliest)]
    if not stale:
        return []
    parts = dict(held.parts)
    for day in stale:
        before = late.where(cluster_time.as_date(F.col("T")) < F.lit(day))
        parts[day.isoformat()] = [_store(patches.composed(_held(spark, held, day), patches.writes(before)), kept)]
    manifest.swap(spark, held, parts)
    return stale


def drop_expired(spark: SparkSession, kept: Bases, first: dt.date) -> list[dt.date]:
    """Drop the bases that no time from the start of the day ``first`` on needs; returns their days.

    The days of the archive before the oldest base that stays may go as well.
    """
    held = manifest.current(spark, kept.path)
    days = _days(held)
    oldest = max((day for day in days if day <= first), default=None)
    dropped = [day for day in days if oldest is not None and day < oldest]
    if dropped:
        manifest.swap(spark, held, {part: folders for part, folders in held.parts.items() if part >= oldest.isoformat()})
    return dropped


def writes_as_of(spark: SparkSession, kept: Bases, events: DataFrame, until: int) -> DataFrame:
    """The newest write to each place of the events up to ``until`` (epoch seconds, inclusive)."""
    held = manifest.current(spark, kept.path)
    days = _days(held)
    # A base holds what is before its day, so the last second of a day may be answered by the next day's.
    base = max((day for day in days if day <= _day_of(until + 1)), default=None)
    replayed = _between(events, base, _day_of(until) + dt.timedelta(days=1)).where(F.col("T") <= until)
    if base is not None:
        return patches.composed(patches.writes(replayed), _held(spark, held, base))
    # There is a first base only if there was a day before it.
    if days and _between(events, None, days[0]).isEmpty():
        raise LookupError(f"times before {days[0]} have expired")
    return patches.composed(patches.writes(replayed))


def documents_as_of(spark: SparkSession, kept: Bases, events: DataFrame, until: int) -> DataFrame:
    """(db, coll, documentKey, fullDocument) of the documents that existed after the events up to ``until``.

    The same rows as ``lookup.snapshot(events, until)``. A time before the oldest base that is kept is an error once its days have expired.
    """
    return patches.documents(writes_as_of(spark, kept, events, until))
