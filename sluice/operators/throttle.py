"""Positions that a throttled position store would have saved.

Rule, per collection: the first event saves its position; after that the next event
strictly later than the last save plus the interval does. Interval 0 saves all.

Each save depends on the one before it, so this is no window function. It is no
single pass over a collection either, because one collection may hold most of the
log. Three steps keep every group bounded by a span of time, not by the data:

1. Only the first event of a second can save, so events are reduced to distinct
   seconds by a partial aggregate.
2. Each collection is cut into spans of time. Per span, the chain of saves is
   followed from every second it can begin with, giving (first save, last save).
3. Those few pairs are linked across the spans of a collection, which tells where
   the chain really begins in each span; the saves of each span follow from that.

Python gets the seconds of a group, at most as many as a span has, and no tokens.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions import cluster_time

SPAN_SECONDS = 86_400
SPAN_INTERVALS = 32

_SPAN = ["db", "coll", "span"]


def span_seconds(interval: int) -> int:
    """Long enough that a span has far fewer possible first saves than seconds."""
    return max(SPAN_SECONDS, SPAN_INTERVALS * interval)


def _last_saves(seconds: np.ndarray, interval: int) -> np.ndarray:
    """For every second as a first save, the last save of its chain in this span."""
    size = len(seconds)
    hop = np.searchsorted(seconds, seconds + interval, side="right")
    hop = np.where(hop < size, hop, np.arange(size))
    while True:
        further = hop[hop]
        if np.array_equal(further, hop):
            return seconds[hop]
        hop = further


def _chain(seconds: np.ndarray, first: int, interval: int) -> list[int]:
    """Indexes of the saves that follow from a first save."""
    saves = []
    at = int(np.searchsorted(seconds, first))
    while at < len(seconds):
        saves.append(at)
        at = int(np.searchsorted(seconds, seconds[at] + interval, side="right"))
    return saves


def _span_pairs(interval: int):
    width = span_seconds(interval)

    def pairs(group: pd.DataFrame) -> pd.DataFrame:
        seconds = np.sort(group["T"].to_numpy())
        span = int(group["span"].iloc[0])
        # A save before this span blocks at most this second of it.
        blocked = span * width + interval - 1
        reach = np.searchsorted(seconds, blocked, side="right") + 1
        return pd.DataFrame(
            {
                "db": group["db"].iloc[0],
                "coll": group["coll"].iloc[0],
                "span": span,
                "first_save": seconds[:reach],
                "last_save": _last_saves(seconds, interval)[:reach],
            }
        )

    return pairs


def _linked(interval: int):
    def link(group: pd.DataFrame) -> pd.DataFrame:
        begins = []
        saved = None
        for span, pairs in group.sort_values(["span", "first_save"]).groupby("span"):
            firsts = pairs["first_save"].to_numpy()
            at = 0
            if saved is not None:
                at = int(np.searchsorted(firsts, saved + interval, side="right"))
            if at < len(firsts):
                begins.append((span, firsts[at]))
                saved = int(pairs["last_save"].to_numpy()[at])
        linked = pd.DataFrame(begins, columns=["span", "first_save"])
        linked.insert(0, "coll", group["coll"].iloc[0])
        linked.insert(0, "db", group["db"].iloc[0])
        return linked

    return link


def _span_saves(interval: int):
    def saves(seconds: pd.DataFrame, begin: pd.DataFrame) -> pd.DataFrame:
        if begin.empty:
            return seconds.iloc[:0]
        ordered = np.sort(seconds["T"].to_numpy())
        rows = _chain(ordered, int(begin["first_save"].iloc[0]), interval)
        return pd.DataFrame(
            {"db": seconds["db"].iloc[0], "coll": seconds["coll"].iloc[0], "span": seconds["span"].iloc[0], "T": ordered[rows]}
        )

    return saves


def throttled_positions(
    events: DataFrame, interval: int, saved: DataFrame | None = None
) -> DataFrame:
    """Saved positions ``(db, coll, token, T, I)`` for an interval in seconds.

    ``saved`` (db, coll, T) carries the last saves of earlier events, so a log can be
    processed in pieces: a stream passes what its earlier batches saved.
    """
    if interval < 0:
        raise ValueError("the interval must not be negative")
    positions = events.select("db", "coll", "token", "T", "I")
    if interval == 0:
        return positions

    width = span_seconds(interval)
    span = F.floor(F.col("T") / F.lit(width)).cast("bigint")
    seconds = (
        positions.withColumn("span", span)
        .groupBy(*_SPAN, "T")
        .agg(
            F.min_by("token", cluster_time.sequence(F.col("T"), F.col("I"))).alias("token"),
            F.min("I").alias("I"),
        )
    )
    pair_schema = "db string, coll string, span bigint, first_save bigint, last_save bigint"
    if saved is not None:
        # Without the seconds that an earlier save blocks, the first one left saves.
        earlier = saved.groupBy("db", "coll").agg(F.max("T").alias("saved_second"))
        blocked = F.col("T") <= F.col("saved_second") + F.lit(interval)
        seconds = (
            seconds.join(earlier, ["db", "coll"], "left")
            .where(F.col("saved_second").isNull() | ~blocked)
            .drop("saved_second")
        )
    # Only the numbers of seconds go through Python; the tokens of the few that save are met afterwards.
    times = seconds.select(*_SPAN, "T")
    pairs = times.groupBy(*_SPAN).applyInPandas(_span_pairs(interval), pair_schema)
    begins = pairs.groupBy("db", "coll").applyInPandas(
        _linked(interval), "db string, coll string, span bigint, first_save bigint"
    )
    saves = (
        times.groupBy(*_SPAN)
        .cogroup(begins.groupBy(*_SPAN))
        .applyInPandas(_span_saves(interval), "db string, coll string, span bigint, T bigint")
    )
    return seconds.join(saves, [*_SPAN, "T"], "left_semi").select("db", "coll", "token", "T", "I")
