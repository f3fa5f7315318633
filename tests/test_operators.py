"""Lookup, audit, order, delivery, routing, retention."""

import datetime as dt

import pytest
from events import encoded, event
from pyspark.sql import functions as F

from sluice.functions import cluster_time
from sluice.operators import audit, delivery, lookup, ordering, retention, routing
from sluice.schema import FILE, WAREHOUSE

HISTORY = [
    event("1", 1, 0, "insert", key=1, document="first"),
    event("2", 2, 0, "update", key=1, document="second"),
    event("3", 2, 1, "replace", key=1, document="third"),
    event("4", 3, 0, "insert", key=2, document="gone"),
    event("5", 4, 0, "update", key=2, document="gone later"),
    event("6", 5, 0, "delete", key=2),
    event("7", 5, 1, "insert", key=1, coll="other", document="elsewhere"),
]


def state(frame):
    return {(r["coll"], r["documentKey"]): r["fullDocument"] for r in frame.collect()}


def test_snapshot_is_the_last_state_of_every_key(spark):
    shuffled = encoded(spark, HISTORY[::-1])
    assert state(lookup.snapshot(shuffled)) == {
        ("c", '{"_id":1}'): '{"_id":1,"v":"third"}',
        ("other", '{"_id":1}'): '{"_id":1,"v":"elsewhere"}',
    }
    assert state(lookup.snapshot(shuffled, until=4)) == {
        ("c", '{"_id":1}'): '{"_id":1,"v":"third"}',
        ("c", '{"_id":2}'): '{"_id":2,"v":"gone later"}',
    }


def test_lookup_gives_updates_the_current_document(spark):
    events = encoded(spark, HISTORY)
    attached = lookup.attach_documents(events, lookup.snapshot(events))
    assert attached.columns == events.columns
    documents = {r["token"]: r["fullDocument"] for r in attached.collect()}
    assert len(documents) == len(HISTORY)
    assert documents["2"] == '{"_id":1,"v":"third"}'
    assert documents["5"] == "null"
    assert documents["1"] == '{"_id":1,"v":"first"}'
    assert documents["6"] == '{"_id":2,"v":"same"}'


@pytest.fixture
def small_shuffle_conf(spark):
    changed = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key in changed:
        spark.conf.unset(key)


def test_lookup_of_a_hot_document_is_split(spark, small_shuffle_conf):
    """A third of all events update one document: its partition is split."""
    n = 30_000
    events = spark.range(0, n, 1, 8).select(
        F.concat(F.lit("t"), "id").alias("token"),
        F.lit("update").alias("operationType"),
        F.col("id").alias("T"),
        F.lit(0).cast("bigint").alias("I"),
        F.lit("app").alias("db"),
        F.lit("c").alias("coll"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .otherwise(F.col("id").cast("string"))
        .alias("documentKey"),
        F.sha2(F.col("id").cast("string"), 512).alias("fullDocument"),
    )
    documents = events.dropDuplicates(["documentKey"]).select(
        "db", "coll", "documentKey", F.concat(F.lit("now-"), "documentKey").alias("fullDocument")
    )
    attached = lookup.attach_documents(events, documents)
    found = attached.where(F.col("fullDocument") == F.concat(F.lit("now-"), "documentKey"))
    executed = found.select("token", "fullDocument")
    assert len(executed.collect()) == n
    assert "skew=true" in executed._jdf.queryExecution().executedPlan().toString()


def test_audit_and_last_position(spark):
    events = encoded(spark, HISTORY)
    counts = {
        (r["coll"], r["operationType"]): (r["events"], r["last"])
        for r in audit.relay_audit(events)
        .withColumn("last", F.unix_seconds("last_time"))
        .collect()
    }
    assert counts[("c", "update")] == (2, 4)
    assert sum(n for n, _ in counts.values()) == len(HISTORY)
    last = {r["coll"]: (r["token"], r["T"], r["I"]) for r in audit.last_position(events).collect()}
    assert last == {"c": ("6", 5, 0), "other": ("7", 5, 1)}


def test_ordered_delivery_lays_hot_keys_over_partitions(spark, small_shuffle_conf):
    hot = spark.range(0, 20_000, 1, 8).select(
        F.when(F.col("id") % 3 < 2, F.lit("hot")).otherwise(F.lit("k")).alias("ordering_key"),
        (F.col("id") * 7919 % 20_000).alias("T"),
        F.lit(0).cast("bigint").alias("I"),
        F.sha2(F.col("id").cast("string"), 512).alias("fullDocument"),
    )
    laid = ordering.ordered_delivery(hot).withColumn("part", F.spark_partition_id())
    rows = laid.collect()
    assert len(rows) == 20_000
    in_order = [(r["ordering_key"], r["sequence"]) for r in rows]
    assert in_order == sorted(in_order)
    assert len({r["part"] for r in rows if r["ordering_key"] == "hot"}) > 1


def test_first_delivery(spark):
    once = encoded(spark, HISTORY)
    copies = once.unionByName(once).unionByName(once.where("token = '3'"))
    kept = delivery.first_delivery(copies)
    assert kept.columns == once.columns
    assert sorted(kept.collect()) == sorted(once.collect())


def test_destinations():
    assert routing.parse_destinations("file , kinesisStream") == ["file", "kinesisStream"]
    everything = "bigquery,pubsub,kinesisStream,file"
    assert routing.parse_destinations(everything, project="p") == everything.split(",")
    with pytest.raises(ValueError, match="xxx"):
        routing.parse_destinations("xxx")
    with pytest.raises(ValueError, match="project"):
        routing.parse_destinations("file,pubsub")
    with pytest.raises(ValueError, match="no such destination"):
        routing.parse_destinations("")


def test_routes(spark):
    routes = [("app", "c", WAREHOUSE, "t1"), ("app", "c", FILE, "f1"), ("app", "x", FILE, "f2")]
    routed = routing.route(spark, encoded(spark, HISTORY), [routing.Route(*r) for r in routes])
    found = routed.groupBy("coll", "destination", "target").count().collect()
    assert sorted(map(tuple, found)) == [("c", WAREHOUSE, "t1", 6), ("c", FILE, "f1", 6)]
    with pytest.raises(ValueError, match="twice"):
        routing.check_routes([routes[0], routes[0]])
    with pytest.raises(ValueError, match="no such destination"):
        routing.check_routes([("app", "c", "xxx", "t")])


def test_retention(spark, tmp_path):
    path = str(tmp_path / "table")
    days = [dt.date(2024, 1, n) for n in range(1, 11)]
    rows = spark.createDataFrame([(str(d), d) for d in days], "v string, cluster_date date")
    rows.write.partitionBy("cluster_date").parquet(path)
    (tmp_path / "table" / "_SUCCESS").touch()
    as_of = dt.date(2024, 1, 10)
    kept = retention.unexpired(spark.read.parquet(path), as_of, 3)
    assert kept.count() == 4
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cluster_date" in plan
    assert retention.drop_expired(spark, path, as_of) == []
    assert retention.drop_expired(spark, path, as_of, days=5) == days[:4]
    assert retention.drop_expired(spark, path, as_of, newest=2) == days[4:8]
    assert spark.read.parquet(path).count() == 2


def test_cluster_date_is_the_utc_day(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        row = spark.range(1).select(
            cluster_time.as_date(F.lit(86399).cast("bigint")),
            cluster_time.as_date(F.lit(86400).cast("bigint")),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(row) == (dt.date(1970, 1, 1), dt.date(1970, 1, 2))
