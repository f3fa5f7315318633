"""Cluster time: epoch seconds ``T`` plus the ordinal ``I`` inside the second.

Texts are built from a zone-less timestamp, so they do not depend on the
session time zone; the zone is an explicit argument.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds and ordinals are 32 unsigned bits each.
MAX_SECONDS = 2**32 - 1
MAX_ORDINAL = 2**32 - 1
_MIDDLE = 2**31


def as_timestamp(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def as_date(seconds: Column) -> Column:
    """The UTC day of the event; the partition column of the day-partitioned sinks."""
    return F.date_from_unix_date(F.floor(seconds / F.lit(86400)).cast("int"))


def sequence(seconds: Column, ordinal: Column) -> Column:
    """(T, I) packed into one bigint with the same order, over the whole range of both.

    It needs no shuffle, and it has the same value in every batch and replay.
    """
    return (seconds - F.lit(_MIDDLE)) * F.lit(MAX_ORDINAL + 1) + ordinal


def unpacked(packed: int) -> tuple[int, int]:
    """(T, I) of a packed sequence."""
    seconds, ordinal = divmod(packed, MAX_ORDINAL + 1)
    return seconds + _MIDDLE, ordinal


def _wall_clock(seconds: Column, zone: str) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    zero = F.lit(0)
    utc = epoch + F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))
    return utc if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def as_text(seconds: Column, zone: str = "UTC") -> Column:
    """``YYYY-MM-DD HH:MM:SS``."""
    return _wall_clock(seconds, zone).cast("string")


def as_rfc3339(seconds: Column, zone: str = "UTC") -> Column:
    """``YYYY-MM-DDTHH:MM:SSZ`` or with a numeric offset."""
    wall = F.replace(as_text(seconds, zone), F.lit(" "), F.lit("T"))
    if zone == "UTC":
        return F.concat(wall, F.lit("Z"))
    offset = F.timestamp_diff(
        "MINUTE", _wall_clock(seconds, "UTC"), _wall_clock(seconds, zone)
    )
    text = F.format_string(
        "%s%02d:%02d",
        F.when(offset < 0, F.lit("-")).otherwise(F.lit("+")),
        F.floor(F.abs(offset) / 60).cast("int"),
        (F.abs(offset) % 60).cast("int"),
    )
    return F.concat(wall, F.when(offset == 0, F.lit("Z")).otherwise(text))
