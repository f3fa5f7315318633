"""What was relayed before: copies of events are left out of later batches, without state in the stream.

Two tables by UTC day. ``tokens`` holds the token of every event relayed, ``filters`` a Bloom filter of them, in blocks of
256 bits: a token sets one bit in each of the four words of its block. An event's day is part of the event, so a copy
can only be known on its own day. A batch reads the filters of its days; events whose bits are all set may be copies, and only of these
the tokens of their days are read and compared. A false positive of a filter costs that comparison and loses no event.

Tokens are written when all destinations have the batch. A batch that failed between may be sent again under a new
checkpoint as well, and is then relayed once more: an event is never taken as relayed before it is.
"""

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions import cluster_time
from sluice.operators import delivery
from sluice.streaming import compaction
from sluice.streaming.sinks import replace_batch

#: 4 MB of filter a day; at 25 bits a token it holds 1.3 million with about one false positive in 1400.
BLOCKS = 1 << 17
WORDS = ("w0", "w1", "w2", "w3")
#: Repeated tokens of a batch from which on all its rows are compared, and not only the rows of these.
MANY_COPIES = 100_000
_TOKENS = T.StructType().add("token", "string")
_FILTERS = T.StructType([T.StructField("block", T.IntegerType()), *[T.StructField(w, T.LongType()) for w in WORDS]])


@dataclass(frozen=True)
class Delivered:
    """Where tokens and filters are kept. ``blocks`` of a day's filter are fixed for a table."""

    path: str
    blocks: int = BLOCKS

    @property
    def tokens(self) -> compaction.Table:
        return compaction.Table(f"{self.path}/tokens", _TOKENS, "kind")

    @property
    def filters(self) -> compaction.Table:
        return compaction.Table(f"{self.path}/filters", _FILTERS, "kind", fold=_joined)

    @property
    def tables(self) -> list[compaction.Table]:
        return [self.tokens, self.filters]


def _day() -> Column:
    return cluster_time.as_date(F.col("T")).alias("cluster_date")


def _bits(events: DataFrame, kept: Delivered) -> DataFrame:
    """cluster_date, token, its block, and one bit in each word."""
    spread = F.xxhash64("token", F.lit("bits"))
    places = [F.expr(f"shiftleft(1L, cast((shiftright(spread, {6 * i}) & 63) as int))").alias(w) for i, w in enumerate(WORDS)]
    block = F.pmod(F.xxhash64("token"), F.lit(kept.blocks)).cast("int").alias("block")
    return events.select(_day(), "token", spread.alias("spread")).select("cluster_date", "token", block, *places)


def _union(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(*[F.bit_or(w).alias(w) for w in WORDS])


def _joined(rows: DataFrame) -> DataFrame:
    """The filters of many batches as one for each day."""
    return rows.groupBy("kind", "cluster_date", "block").agg(
        *[F.bit_or(w).alias(w) for w in WORDS], F.max("run_id").alias("run_id"), F.max("batch_id").alias("batch_id")
    )


def _days(rows: DataFrame) -> list[dt.date]:
    return sorted(row["cluster_date"] for row in rows.select("cluster_date").distinct().collect())


def tokens_of(spark: SparkSession, kept: Delivered, days: list[dt.date]) -> DataFrame:
    """(cluster_date, token) of some days; no other day is read."""
    return compaction.read(spark, kept.tokens).where(F.col("cluster_date").isin(days)).select("cluster_date", "token")


def suspects(spark: SparkSession, kept: Delivered, events: DataFrame) -> DataFrame:
    """(cluster_date, token) of the events that the filters of their days may hold."""
    new = _bits(events, kept)
    stored = compaction.read(spark, kept.filters).where(F.col("cluster_date").isin(_days(new)))
    old = _union(stored, "cluster_date", "block").select("cluster_date", "block", *[F.col(w).alias(f"all_{w}") for w in WORDS])
    held = [F.col(w).bitwiseAND(F.col(f"all_{w}")) == F.col(w) for w in WORDS]
    return new.join(old, ["cluster_date", "block"]).where(held[0] & held[1] & held[2] & held[3]).select("cluster_date", "token")


def first_of_batch(good: DataFrame) -> DataFrame:
    """One row of each event of a batch.

    Repeated tokens are counted without the rows that hold them. A batch has few copies of its own or none, so as a rule no
    row is exchanged or sorted; where copies are many, all rows are.
    """
    repeated = good.groupBy("token").count().where("count > 1").select("token")
    copies = repeated.count()
    if copies == 0:
        return good
    if copies > MANY_COPIES:
        return delivery.first_delivery(good)
    single = good.join(repeated, "token", "left_anti").select(*good.columns)
    several = good.join(repeated, "token", "left_semi").select(*good.columns)
    return single.unionByName(delivery.first_delivery(several))


def unseen(spark: SparkSession, kept: Delivered, labelled: DataFrame) -> DataFrame:
    """The rows of a batch without copies: of each valid event one row, and none if it was relayed before.

    Invalid rows stay as they are. The driver gets the days of a batch, no rows.
    """
    good = labelled.where(F.col("reason").isNull())
    maybe = suspects(spark, kept, good)
    once = first_of_batch(good)
    days = _days(maybe)
    if days:
        known = maybe.join(tokens_of(spark, kept, days), ["cluster_date", "token"], "left_semi").select("token")
        once = once.join(known, "token", "left_anti").select(*labelled.columns)
    return once.unionByName(labelled.where(F.col("reason").isNotNull()))


def record(kept: Delivered, events: DataFrame, run_id: str, batch_id: int) -> None:
    """Add the events of a batch, in place of what an earlier attempt of it added."""
    where = ["kind", "cluster_date"]
    replace_batch(events.select(F.lit("tokens").alias("kind"), _day(), "token"), kept.tokens.path, run_id, batch_id, where)
    bits = _union(_bits(events, kept), "cluster_date", "block").withColumn("kind", F.lit("filters"))
    replace_batch(bits, kept.filters.path, run_id, batch_id, where)
