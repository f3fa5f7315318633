"""Position ledger: which position every committed batch reached, per collection.

A stream resumes from its checkpoint. The ledger is for audit, for batch backfills,
and for starting a new relay where an older one ended.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions import cluster_time
from sluice.operators import audit, throttle
from sluice.schema import POSITION
from sluice.streaming import compaction
from sluice.streaming.sinks import remove, replace_batch

_LEDGER_SCHEMA = T.StructType(
    [
        *POSITION.fields,
        T.StructField("run_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger, or None when there is none.

    A ledger that exists and cannot be read raises when it is used. It is never
    taken for a missing one, which would skip events.
    """
    if not exists(spark, path):
        return None
    return compaction.read(spark, table(path)).select(*_LEDGER_SCHEMA.names)


def table(path: str) -> compaction.Table:
    """The ledger as a table whose older batches fold into the newest position of each collection."""
    return compaction.Table(path, POSITION, fold=_newest)


def _newest(rows: DataFrame) -> DataFrame:
    order = F.struct(cluster_time.sequence(F.col("T"), F.col("I")), "batch_id")
    whole = F.struct(*rows.columns)
    return rows.groupBy("db", "coll").agg(F.max_by(whole, order).alias("last")).select("last.*")


def append(positions: DataFrame, path: str, run_id: str, batch_id: int) -> None:
    replace_batch(positions.select(*POSITION.names), path, run_id, batch_id, [])


def _state_path(path: str, run_id: str, batch_id: int) -> str:
    return f"{path}_state/run_id={run_id}/batch_id={batch_id}"


def save(
    events: DataFrame, path: str, run_id: str, batch_id: int, interval: int | None = None
) -> None:
    """Save the positions of one batch: its last ones, or the throttled ones.

    A throttled ledger also keeps the last save of every collection as of each batch.
    The next batch reads that one small table, whatever the age of the ledger, and a
    repeated batch decides as it did the first time.
    """
    if interval is None:
        append(audit.last_position(events), path, run_id, batch_id)
        return
    spark = events.sparkSession
    earlier = None
    if batch_id > 0:
        # Batches of a run are consecutive. A state is missing where throttling was switched
        # on later; the ledger of the batches before then has the last saves.
        place = _state_path(path, run_id, batch_id - 1)
        if exists(spark, place):
            earlier = spark.read.schema(POSITION).parquet(place)
        else:
            saved = read(spark, path)
            if saved is not None:
                before = (F.col("run_id") != run_id) | (F.col("batch_id") < batch_id)
                earlier = audit.last_position(saved.where(before)).select(*POSITION.names)
    append(throttle.throttled_positions(events, interval, earlier), path, run_id, batch_id)
    state = read(spark, path)
    if state is not None:
        state = state.where((F.col("run_id") == run_id) & (F.col("batch_id") == batch_id))
        state = state.select(*POSITION.names)
    if earlier is not None:
        state = earlier if state is None else state.unionByName(earlier)
    if state is None:
        state = spark.createDataFrame([], POSITION)
    audit.last_position(state).write.mode("overwrite").parquet(
        _state_path(path, run_id, batch_id)
    )
    # A repeated batch needs the state before it; those before that are done with.
    remove(spark, _state_path(path, run_id, batch_id - 2))


def remember_start(
    spark: SparkSession, path: str, find: Callable[[], DataFrame | None]
) -> DataFrame:
    """Positions where a relay began, found once and the same after every restart.

    Found again at a restart they would be later ones, and events that arrived
    in between would be skipped.
    """
    if not exists(spark, path):
        found = find()
        if found is None:
            found = spark.createDataFrame([], POSITION)
        found.select(*POSITION.names).write.parquet(path)
    return spark.read.schema(POSITION).parquet(path)


def resume_each(events: DataFrame, positions: DataFrame) -> DataFrame:
    """Events after the last saved position of their collection; others pass whole.

    Events without a readable cluster time have no place in the order: they pass, to be
    quarantined.
    """
    order = cluster_time.sequence(F.col("T"), F.col("I"))
    saved = positions.groupBy("db", "coll").agg(F.max(order).alias("saved_position"))
    joined = events.join(saved, ["db", "coll"], "left")
    later = F.col("saved_position").isNull() | order.isNull() | (order > F.col("saved_position"))
    return joined.where(later).select(*events.columns)
