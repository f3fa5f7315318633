"""Repeated attempts with other settings, order within the topic, numbers out of range, the job's lookup and namespace."""

import glob

import pyarrow.parquet as pq
import pytest
from events import event, labelled, lines
from pyspark.sql import functions as F

from sluice import job
from sluice.operators import quarantine
from sluice.schema import FILE, TOPIC, WAREHOUSE
from sluice.streaming import ledger, relay, sinks


@pytest.mark.parametrize("destination", [WAREHOUSE, FILE])
def test_repeat_with_another_target_leaves_one_copy(spark, tmp_path, destination):
    rows = lines(spark, [event(f"t{n}", n * 86400, n) for n in range(4)])
    for target in ("first", "second"):
        opts = sinks.SinkOptions(str(tmp_path / "out"), targets={destination: target})
        relay.relay_batch(relay.Relay([destination], opts), rows, "run", 3)
    form = "text" if destination == FILE else "parquet"
    stored = spark.read.format(form).load(opts.path(destination))
    column = "log" if destination == FILE else "table"
    assert [r[0] for r in stored.select(column).collect()] == ["second"] * 4
    assert spark.read.parquet(f"{opts.root}/audit").agg(F.sum("events")).first()[0] == 4


def test_repeat_leaves_other_batches_and_no_old_rejects(spark, tmp_path):
    opts = sinks.SinkOptions(str(tmp_path / "out"))
    configured = relay.Relay([WAREHOUSE], opts)
    relay.relay_batch(configured, lines(spark, [event("a"), "no json"]), "run", 0)
    relay.relay_batch(configured, lines(spark, [event("b"), "no json either"]), "run", 1)
    relay.relay_batch(configured, lines(spark, [event("b"), event("c", 1, 1)]), "run", 1)
    rejected = spark.read.parquet(configured.quarantine_path).collect()
    assert [(r["raw"], r["batch_id"]) for r in rejected] == [("no json", 0)]
    assert spark.read.parquet(opts.path(WAREHOUSE)).count() == 3
    relay.relay_batch(configured, lines(spark, ["nothing"]), "run", 1)
    assert spark.read.parquet(opts.path(WAREHOUSE)).count() == 1
    assert {r["batch_id"] for r in ledger.read(spark, configured.ledger_path).collect()} == {0}


def test_topic_files_follow_the_order_of_keys(spark, tmp_path):
    events = [event(f"t{n}", 100 + (n * 7) % 50, n, key=n % 3) for n in range(60)]
    opts = sinks.SinkOptions(str(tmp_path / "out"))
    configured = relay.Relay([TOPIC], opts, ordering_by="documentKey")
    relay.relay_batch(configured, lines(spark, events).repartition(4), "run", 0)
    found = []
    for path in sorted(glob.glob(f"{opts.path(TOPIC)}/**/*.parquet", recursive=True)):
        found += [(r["ordering_key"], r["sequence"]) for r in pq.ParquetFile(path).read().to_pylist()]
    assert len(found) == 60 and found == sorted(found)


def test_out_of_range_is_judged_on_numbers(spark):
    def row(value, name='"n"'):
        return (
            '{"_id":{"_data":"x"},"operationType":"insert","clusterTime":{"T":1,"I":1},"ns":{"db":"d","coll":"c"},'
            f'"fullDocument":{{"v":{value},"n":{name}}}}}'
        )

    cases = {
        row("1e400", '"Infinity"'): quarantine.OUT_OF_RANGE,
        row("-1e400"): quarantine.OUT_OF_RANGE,
        row("1e308", '"Infinity"'): None,
        row("0e999", r'"Infinity"'): None,
        row("1", r'"a \" 1e400 \\", "m":"Infinity"'): None,
    }
    got = labelled(spark, list(cases), payloads=True).select("reason").collect()
    assert [r["reason"] for r in got] == list(cases.values())


def test_job_gives_updates_their_current_document(spark, tmp_path):
    rows = [event("t0", 1, 0), event("t1", 2, 0, op="update"), event("t2", 3, 0, op="update", key=9)]
    lines(spark, rows).coalesce(1).write.text(str(tmp_path / "log"))
    current = [("app", "c", '{"_id":1}', '{"_id":1,"v":"now"}')]
    documents = spark.createDataFrame(current, "db string, coll string, documentKey string, fullDocument string")
    documents.write.parquet(str(tmp_path / "documents"))
    common = ["--log", str(tmp_path / "log"), "--root", str(tmp_path / "out"), "--destinations", "bigquery", "--project", "p"]
    job.main([*common, "--start", "earliest", "--lookup", str(tmp_path / "documents")])
    found = spark.read.parquet(str(tmp_path / "out" / WAREHOUSE)).select("operationType", "fullDocument").collect()
    assert sorted(map(tuple, found)) == [
        ("insert", '{"_id":1,"v":"same"}'), ("update", "null"), ("update", '{"_id":1,"v":"now"}'),
    ]


def test_every_start_needs_the_namespace(spark, tmp_path):
    lines(spark, [event("t0")]).coalesce(1).write.text(str(tmp_path / "log"))
    common = ["--log", str(tmp_path / "log"), "--root", str(tmp_path / "out"), "--destinations", "file", "--start", "earliest"]
    with pytest.raises(LookupError, match="does not exist"):
        job.main([*common, "--db", "app", "--coll", "missing"])
    job.main([*common, "--db", "app", "--coll", "c"])
    with pytest.raises(LookupError, match="does not exist"):
        job.main([*common, "--db", "other"])
