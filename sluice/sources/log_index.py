"""An index of the files of a change log, so that a start opens only the files it needs.

For each file and collection it holds the least and greatest position and token. Files are told apart by a hash of path,
size and modification time, which Spark also knows before it opens a file: a filter on it leaves files out of the
listing, in batches and in streams. A file that is not in the index is never left out.
"""

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions import cluster_time
from sluice.operators import quarantine
from sluice.sources import change_log
from sluice.sources.change_log import FILE
from sluice.streaming.sinks import replace_batch

SCHEMA = """file bigint, db string, coll string, events bigint, unplaced bigint, first_sequence bigint, last_sequence bigint,
  first_token string, last_token string, head struct<sequence: bigint, token: string>"""

# Files named in one filter. The lists are held by the driver, as are the file lists of Spark's own file source.
MOST = 100_000


def describe(labelled: DataFrame) -> DataFrame:
    """Index rows of the files of labelled events (``quarantine.label``) that have a ``file`` column.

    ``unplaced`` counts the events without a readable position or collection, which no saved position covers.
    ``head`` is the newest event that can be relayed.
    """
    order = cluster_time.sequence(F.col("T"), F.col("I"))
    placed = order.isNotNull() & F.col("db").isNotNull() & F.col("coll").isNotNull()
    good = F.col("reason").isNull()
    return labelled.groupBy(FILE, "db", "coll").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(~placed).alias("unplaced"),
        F.min(order).alias("first_sequence"),
        F.max(order).alias("last_sequence"),
        F.min("token").alias("first_token"),
        F.max("token").alias("last_token"),
        F.max(F.when(good, F.struct(order.alias("sequence"), "token"))).alias("head"),
    )


def labelled_headers(lines: DataFrame) -> DataFrame:
    """Decoded and checked lines; payloads are never made where only the header is used."""
    return quarantine.label(change_log.decode(change_log.parse(lines)))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The index; several relays of one log may have described the same file. None yet is an empty one."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path).dropDuplicates([FILE, "db", "coll"])


def present(spark: SparkSession, folder: str) -> DataFrame:
    """The files that are in the folder now, by name only."""
    listed = spark.read.format("binaryFile").load(folder)
    return listed.select(F.xxhash64("path", "length", "modificationTime").alias(FILE))


def _chunks(files: list[int]) -> Iterator[list[int]]:
    for at in range(0, len(files), MOST):
        yield files[at : at + MOST]


def _names(files: DataFrame) -> list[int]:
    return [row[FILE] for row in files.select(FILE).distinct().collect()]


def refresh(spark: SparkSession, folder: str, path: str) -> int:
    """Describe the files that the index does not know yet; only these are opened. Returns how many they are."""
    known = read(spark, path).select(FILE).distinct()
    missing = _names(present(spark, folder).join(known, FILE, "left_anti"))
    for some in _chunks(missing):
        lines = change_log.read_lines(spark, folder, only=some, named=True)
        found = describe(labelled_headers(lines))
        # A file without lines has a row as well, so it is not opened again.
        files = spark.createDataFrame([(file,) for file in some], f"{FILE} bigint")
        rows = found.join(files, FILE, "right").select(*spark.createDataFrame([], SCHEMA).columns)
        replace_batch(rows, path, f"start-{uuid.uuid4().hex}", 0, [])
    return len(missing)


def in_folder(spark: SparkSession, folder: str, path: str) -> DataFrame:
    """The index rows of the files that are in the folder now."""
    return read(spark, path).join(present(spark, folder), FILE, "left_semi")


def require_namespace(index: DataFrame, db: str, coll: str | None = None) -> None:
    """A watched database or collection without any event in the indexed files is an error."""
    change_log.in_namespace(index, db, coll)


def positions(index: DataFrame, db: str | None = None, coll: str | None = None) -> DataFrame:
    """The newest position of each collection, as ``audit.last_position`` finds it in the log."""
    rows = index.where("head IS NOT NULL")
    for name, wanted in (("db", db), ("coll", coll)):
        if wanted is not None:
            rows = rows.where(F.col(name) == wanted)
    seconds = F.shiftright("head.sequence", 32) + F.lit(2**31)
    newest = rows.groupBy("db", "coll").agg(F.max("head").alias("head"))
    ordinal = F.col("head.sequence").bitwiseAND(F.lit(2**32 - 1))
    return newest.select("db", "coll", "head.token", seconds.alias("T"), ordinal.alias("I"))


def passed(index: DataFrame, saved: DataFrame, namespace: tuple[str, str | None] | None = None) -> list[int]:
    """Files that hold nothing to relay after the saved positions; at most ``MOST`` of them, those with most events.

    A file stays if an event of it has no position, if one of its collections has no saved position or goes on after it.
    With a namespace, other collections do not count.
    """
    rows = index
    if namespace is not None:
        db, coll = namespace
        watched = (F.col("db") == db) if coll is None else (F.col("db") == db) & (F.col("coll") == coll)
        # Unreadable namespaces belong to no collection: they count.
        rows = rows.withColumn("watched", F.coalesce(watched, F.lit(True)))
    else:
        rows = rows.withColumn("watched", F.lit(True))
    order = cluster_time.sequence(F.col("T"), F.col("I"))
    last = saved.groupBy("db", "coll").agg(F.max(order).alias("saved"))
    joined = rows.join(last, ["db", "coll"], "left")
    later = (F.col("unplaced") > 0) | F.col("saved").isNull() | F.coalesce(F.col("last_sequence") > F.col("saved"), F.lit(False))
    needed = F.coalesce(F.col("watched") & (F.col("events") > 0) & later, F.lit(False))
    files = joined.groupBy(FILE).agg(F.max(needed).alias("needed"), F.coalesce(F.sum("events"), F.lit(0)).alias("events"))
    most = files.where("NOT needed").orderBy(F.desc("events"), FILE).limit(MOST)
    return [row[FILE] for row in most.collect()]


def holding(index: DataFrame, token: str) -> list[int]:
    """Files whose tokens, in the order of their text, lie around a token; at most ``MOST``."""
    around = index.where((F.col("first_token") <= token) & (F.col("last_token") >= token))
    return [row[FILE] for row in around.select(FILE).distinct().limit(MOST).collect()]


def position_of(spark: SparkSession, folder: str, index: DataFrame, token: str) -> DataFrame | None:
    """The position (db, coll, token, T, I) of a token, or None. Only files that may hold it are opened.

    Tokens are opaque. Should their text not follow their order, the other files are searched as well.
    """
    likely = holding(index, token)
    for files in ({"only": likely}, {"without": likely}):
        if files.get("only") == []:
            continue
        events = quarantine.valid(labelled_headers(change_log.read_lines(spark, folder, **files)))
        found = events.where(F.col("token") == token).select("db", "coll", "token", "T", "I").limit(1)
        if found.collect():
            return found
    return None


def lines_after(spark: SparkSession, folder: str, index: DataFrame, saved: DataFrame) -> DataFrame:
    """Lines of the files that hold anything after the saved positions; lines up to them are still to be left out."""
    return change_log.read_lines(spark, folder, without=passed(index, saved))

