"""The relay: fan-out, commit barrier, replay, ledger."""

import json

import pytest
from events import encoded, event, lines
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sluice.operators import audit, delivery, lookup, routing, throttle
from sluice.schema import DESTINATIONS, FILE, KEYED_STREAM, TOPIC, WAREHOUSE
from sluice.sources import change_log
from sluice.streaming import ledger, relay, sinks

DAY = 86400


def batch(begin, count=10):
    return [
        event(f"t{n:04d}", n * DAY // 4, n, op="update", coll=f"c{n % 3}", key=n % 5)
        for n in range(begin, begin + count)
    ]


@pytest.fixture
def log(spark, tmp_path):
    """A log folder that grows by one file per call."""
    folder = tmp_path / "log"

    def add(events):
        lines(spark, events).coalesce(1).write.mode("append").text(str(folder))

    add.path = str(folder)
    return add


def options(tmp_path, **more):
    return sinks.SinkOptions(str(tmp_path / "out"), **more)


def run(spark, configured, log, checkpoint, files=None):
    limit = {} if files is None else {"maxFilesPerTrigger": files}
    stream = change_log.stream_lines(spark, log.path, **limit)
    relay.start(configured, stream, str(checkpoint)).awaitTermination()


def tokens(spark, opts, destination):
    path = opts.path(destination)
    if destination == FILE:
        rows = spark.read.text(path).select(
            F.get_json_object("value", "$.cs._id._data").alias("token")
        )
    elif destination == KEYED_STREAM:
        rows = spark.read.parquet(path).select(F.col("partition_key").alias("token"))
    elif destination == TOPIC:
        rows = spark.read.parquet(path).select(
            F.get_json_object(F.split("value", r"\|")[0], "$._data").alias("token")
        )
    else:
        rows = spark.read.parquet(path).select(
            F.get_json_object("id", "$._data").alias("token")
        )
    return sorted(r["token"] for r in rows.collect())


def names(events):
    return sorted(e["_id"]["_data"] for e in events)


@pytest.mark.parametrize("destination", DESTINATIONS)
def test_one_destination(spark, tmp_path, log, destination):
    log(batch(0))
    opts = options(tmp_path)
    run(spark, relay.Relay([destination], opts), log, tmp_path / "cp")
    assert tokens(spark, opts, destination) == names(batch(0))


@pytest.mark.parametrize("backfill", [False, True])
def test_all_destinations_over_restarts(spark, tmp_path, log, backfill):
    opts = options(tmp_path)
    configured = relay.Relay(list(DESTINATIONS), opts, backfill=backfill)
    for begin in (0, 10, 20):
        log(batch(begin))
        run(spark, configured, log, tmp_path / "cp")
    run(spark, configured, log, tmp_path / "cp")
    for destination in DESTINATIONS:
        assert tokens(spark, opts, destination) == names(batch(0, 30)), destination
    stored = ledger.read(spark, configured.ledger_path)
    assert sorted({r["batch_id"] for r in stored.collect()}) == [0, 1, 2]
    last = {r["coll"]: r["token"] for r in audit.last_position(stored).collect()}
    assert last == {"c0": "t0027", "c1": "t0028", "c2": "t0029"}
    counted = spark.read.parquet(configured.audit_path).agg(F.sum("events")).first()[0]
    assert counted == 30


@pytest.mark.parametrize("failing", DESTINATIONS)
def test_failure_moves_no_position_and_replay_leaves_one_copy(spark, tmp_path, log, failing):
    state = {"broken": True}
    good = sinks.SINKS[failing]

    def write(rows, opts, run_id, batch_id):
        if state["broken"] and batch_id == 1:
            raise ConnectionError("destination is down")
        good.write(rows, opts, run_id, batch_id)

    opts = options(tmp_path)
    faulty = {**sinks.SINKS, failing: sinks.Sink(good.shape, write)}
    configured = relay.Relay(list(DESTINATIONS), opts, sinks=faulty)
    log(batch(0))
    run(spark, configured, log, tmp_path / "cp")
    log(batch(10))
    with pytest.raises(PySparkException, match="destination is down"):
        run(spark, configured, log, tmp_path / "cp")

    # The barrier: the others have the batch, the position has not moved.
    for destination in DESTINATIONS:
        expected = batch(0) if destination == failing else batch(0, 20)
        assert tokens(spark, opts, destination) == names(expected), destination
    stored = ledger.read(spark, configured.ledger_path)
    assert {r["batch_id"] for r in stored.collect()} == {0}

    state["broken"] = False
    run(spark, configured, log, tmp_path / "cp")
    for destination in DESTINATIONS:
        assert tokens(spark, opts, destination) == names(batch(0, 20)), destination
    stored = ledger.read(spark, configured.ledger_path)
    assert {r["batch_id"] for r in stored.collect()} == {0, 1}


def test_all_destinations_are_tried_when_one_fails(spark, tmp_path):
    done = []
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", "relay")

    def task(name, fails=False):
        def go():
            assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") == "relay"
            done.append(name)
            if fails:
                raise ConnectionError(name)

        return go

    with pytest.raises(ConnectionError, match="b"):
        relay._together(spark, [task("a"), task("b", True), task("c"), task("d", True)])
    assert sorted(done) == ["a", "b", "c", "d"]
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)


def test_new_run_keeps_the_old_output_and_resumes(spark, tmp_path, log):
    """A lost checkpoint: batch numbers begin again, nothing old is overwritten."""
    opts = options(tmp_path)
    first = relay.Relay([WAREHOUSE, FILE], opts)
    log(batch(0))
    run(spark, first, log, tmp_path / "cp1")
    log(batch(10))

    # Started again without a position: the events before it arrive a second time.
    run(spark, first, log, tmp_path / "cp2")
    assert tokens(spark, opts, WAREHOUSE) == sorted(names(batch(0)) + names(batch(0, 20)))
    rows = spark.read.parquet(opts.path(WAREHOUSE))
    assert delivery.first_delivery(rows, "id").count() == 20

    # Started again from the ledger: only what is new.
    saved = ledger.read(spark, first.ledger_path)
    log(batch(20))
    third = relay.Relay([WAREHOUSE], options(tmp_path / "third"), positions=saved)
    run(spark, third, log, tmp_path / "cp3")
    assert tokens(spark, third.options, WAREHOUSE) == names(batch(20))


def test_quarantine_and_conservation(spark, tmp_path, log):
    bad = ["no json", json.dumps(event("x", ns={"db": "app"})), json.dumps(event("y", documentKey=5))]
    log([*batch(0), *bad])
    opts = options(tmp_path)
    configured = relay.Relay(list(DESTINATIONS), opts)
    run(spark, configured, log, tmp_path / "cp")
    for destination in DESTINATIONS:
        assert tokens(spark, opts, destination) == names(batch(0))
    rejected = spark.read.parquet(configured.quarantine_path).collect()
    assert sorted(r["raw"] for r in rejected) == sorted(bad)


def test_strict_mode_stops_before_any_destination(spark, tmp_path, log):
    log([*batch(0), "no json"])
    opts = options(tmp_path)
    configured = relay.Relay([FILE], opts, mode="strict")
    with pytest.raises(PySparkException, match="not one JSON object"):
        run(spark, configured, log, tmp_path / "cp")
    assert not (tmp_path / "out" / FILE).exists()


def test_namespace_routes_and_targets(spark, tmp_path, log):
    log(batch(0, 30))
    opts = options(tmp_path)
    routes = [
        routing.Route("app", "c0", WAREHOUSE, "zero"),
        routing.Route("app", "c1", WAREHOUSE, "one"),
        routing.Route("app", "c1", FILE, "one"),
    ]
    configured = relay.Relay([WAREHOUSE, FILE], opts, routes=routes)
    run(spark, configured, log, tmp_path / "cp")
    found = spark.read.parquet(opts.path(WAREHOUSE)).groupBy("table").count().collect()
    assert sorted(map(tuple, found)) == [("one", 10), ("zero", 10)]
    assert spark.read.text(opts.path(FILE)).select("log").distinct().collect()[0][0] == "one"

    scoped = relay.Relay([WAREHOUSE], options(tmp_path / "scoped"), namespace=("app", "c2"))
    run(spark, scoped, log, tmp_path / "cp2")
    assert tokens(spark, scoped.options, WAREHOUSE) == names(batch(0, 30)[2::3])


def test_snapshot_and_ordering_key_in_the_relay(spark, tmp_path, log):
    log(batch(0))
    current = [event("z", 10**6, 0, "insert", coll=f"c{c}", key=0, document="now") for c in range(3)]
    configured = relay.Relay(
        [TOPIC],
        options(tmp_path),
        ordering_by="documentKey",
        snapshot=lambda: lookup.snapshot(encoded(spark, current)),
    )
    run(spark, configured, log, tmp_path / "cp")
    for row in spark.read.parquet(configured.options.path(TOPIC)).collect():
        document = row["value"].split("|")[3]
        if row["ordering_key"] == '{"_id":0}':
            assert document == '{"_id":0,"v":"now"}'
        else:
            assert document == "null"


def test_stream_equals_batch(spark, tmp_path, log):
    """Files in any order, one per trigger: the same rows as one batch."""
    for begin in (20, 0, 10):
        log(batch(begin))
    streamed = relay.Relay([WAREHOUSE], options(tmp_path / "s"))
    run(spark, streamed, log, tmp_path / "cp", files=1)
    batched = relay.Relay([WAREHOUSE], options(tmp_path / "b"))
    relay.relay_batch(batched, change_log.read_lines(spark, log.path), "once", 0)
    relay.relay_batch(batched, change_log.read_lines(spark, log.path), "once", 0)
    columns = ["id", "operationType", "clusterTime", "fullDocument", "ns", "documentKey"]
    both = [
        sorted(spark.read.parquet(r.options.path(WAREHOUSE)).select(*columns).collect())
        for r in (streamed, batched)
    ]
    assert both[0] == both[1] and len(both[0]) == 30


def test_files_roll_by_size(spark, tmp_path):
    wide = [event(str(n), 0, n, document="x" * 10_000) for n in range(500)]
    opts = options(tmp_path, max_megabytes=1)
    configured = relay.Relay([FILE], opts)
    relay.relay_batch(configured, lines(spark, wide).coalesce(1), "once", 0)
    sizes = [p.stat().st_size for p in (tmp_path / "out" / FILE).rglob("part-*")]
    assert len(sizes) >= 5 and max(sizes) <= 1024 * 1024


def test_throttled_ledger_over_batches(spark, tmp_path, log):
    """Saves do not depend on how the log is cut; a batch without saves loses nothing."""
    opts = options(tmp_path)
    configured = relay.Relay([FILE], opts, save_interval=2 * DAY)
    for begin, count in ((0, 7), (7, 1), (8, 22)):
        log(batch(begin, count))
        run(spark, configured, log, tmp_path / "cp")
    whole = throttle.throttled_positions(encoded(spark, batch(0, 30)), 2 * DAY)
    stored = ledger.read(spark, configured.ledger_path)
    saved = lambda frame: sorted(r["token"] for r in frame.select("token").collect())
    assert saved(stored) == saved(whole)
    assert stored.where("batch_id = 1").count() == 0


def test_remembered_start_does_not_move(spark, tmp_path):
    path = str(tmp_path / "start")
    first = audit.last_position(encoded(spark, batch(0)))
    later = audit.last_position(encoded(spark, batch(10)))
    ledger.remember_start(spark, path, lambda: first)
    kept = ledger.remember_start(spark, path, lambda: later)
    assert sorted(kept.collect()) == sorted(first.collect())


def test_stdout(spark, tmp_path, capsys):
    """Lines are printed by the tasks; no table is written."""
    configured = relay.Relay([FILE], options(tmp_path, writer="stdout"))
    relay.relay_batch(configured, lines(spark, batch(0, 3)), "once", 0)
    assert not (tmp_path / "out" / FILE).exists()
    assert ledger.read(spark, configured.ledger_path).count() == 3
    shaped = sinks.shape_file(encoded(spark, batch(0, 3)), configured.options)
    sinks._print_lines(iter(shaped.collect()))
    printed = capsys.readouterr().out.splitlines()
    assert [json.loads(line)["cs"]["_id"]["_data"] for line in printed] == names(batch(0, 3))
    with pytest.raises(ValueError, match="writer"):
        options(tmp_path, writer="screen")


def test_wrong_settings(tmp_path):
    with pytest.raises(ValueError, match="mode"):
        relay.Relay([FILE], options(tmp_path), mode="loose")
    with pytest.raises(ValueError, match="xxx"):
        relay.Relay(["xxx"], options(tmp_path))
