"""What the operators share: sizes, written intermediate tables, graph components."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluice.workspace import fresh_dir

UNKNOWN = 1 << 50
#: Bits of the bitmap by which `split` tells rows apart, and of one row of it, as `bitmap_construct_agg` makes them.
SLOTS, PAGE = 1 << 25, 1 << 15


def parts(frame: DataFrame, each: int, least: int = 1) -> int:
    """Number of pieces of about `each` bytes that Spark's size estimate of a frame asks for; grows with the data."""
    size = int(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size >= UNKNOWN:
        return max(least, 4 * int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return max(least, math.ceil(size / each))


def keep(frame: DataFrame, purpose: str, *by: str) -> DataFrame:
    """The frame written as a table in the shared folder and read again: computed once, safe from lost executors."""
    spark, path = frame.sparkSession, fresh_dir(frame.sparkSession, purpose)
    writer = frame.write
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def split(frame: DataFrame, column: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of a frame whose `column` may be among `keys` (one column), and the rows where it is certainly not.

    The keys become a bitmap over their hashes, which is broadcast: 4 MB at most, whatever their number. So rows that a join would
    not find are not exchanged for it. A bit may stand for several values, so an exact join has to follow on the first part.
    """

    def slot(name: str) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(SLOTS))

    places = keys.select(slot(keys.columns[0]).alias("slot"))
    pages = places.groupBy(F.expr(f"slot DIV {PAGE}").alias("page")).agg(F.expr(f"bitmap_construct_agg(slot % {PAGE})").alias("bits"))
    asked = frame.withColumn("slot", slot(column)).withColumn("asked", F.expr(f"slot DIV {PAGE}"))
    place = f"(slot % {PAGE})"
    bit = F.expr(f"getbit(CAST(conv(hex(substring(bits, CAST({place} DIV 8 AS INT) + 1, 1)), 16, 10) AS INT), CAST({place} % 8 AS INT)) = 1")
    same, pages = F.col("asked") == F.col("page"), F.broadcast(pages)
    among = same & bit
    return asked.join(pages, among, "left_semi").select(*frame.columns), asked.join(pages, among, "left_anti").select(*frame.columns)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Jobs that run inside hand Python at most so many rows at once: a task holds each batch in the JVM and again in Python."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def crc_share(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(0))


def record(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[field.name], type=field.type, from_pandas=False) for field in schema], schema=schema
    )


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """(id, root) for each end of an edge (a, b): root is the smallest id that its links reach.

    Alternates large and small stars until nothing changes. Minima are partial aggregates, so a hub costs one row
    for each task; the joins that follow may be split by adaptive execution.
    """

    def written(frame: DataFrame) -> tuple[DataFrame, dict]:
        # Counted as the rows are written, not by a job of its own.
        seen = Observation()
        out = keep(frame.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")), purpose)
        return out, seen.get

    now, state = written(edges.select("a", "b").where("a <> b").distinct())
    before = None
    while state != before and state["n"]:
        before = state
        both = now.select("a", "b").union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Read twice below, so what is above is not planned twice.
        large = keep(large.where("a <> b").distinct(), purpose)
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        now, state = written(small)
    roots = now.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "id")
    ends = now.select(F.col("b").alias("id")).distinct()
    return roots.unionByName(ends.join(roots, "id", "left_anti").withColumn("root", F.col("id")))
