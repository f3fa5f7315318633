"""Documents that the relay keeps: buckets, versions, replays, crashes; the swap of a table's content."""

import json

import pytest
from pyspark.errors import StreamingQueryException
from test_patches import event, events

from sluice import job
from sluice.operators import lookup
from sluice.schema import KEYED_STREAM, WAREHOUSE
from sluice.sources import change_log
from sluice.streaming import manifest, relay, sinks, state


def found(frame):
    return {json.loads(r["documentKey"])["_id"]: json.loads(r["fullDocument"]) for r in frame.collect()}


def test_a_batch_touches_its_buckets_only(spark, tmp_path):
    kept = state.Documents(str(tmp_path / "state"), buckets=16)
    first = events(spark, [event(1, "insert", n, {"_id": n, "v": 0}) for n in range(40)])
    assert len(state.advance(spark, kept, first)) > 8
    before = manifest.current(spark, kept.path)
    touched = state.advance(spark, kept, events(spark, [event(2, "update", 7, update={"updatedFields": {"v": 1}})]))
    after = manifest.current(spark, kept.path)
    assert len(touched) == 1 and after.number == before.number + 1
    changed = {part for part in after.parts if after.parts[part] != before.parts.get(part)}
    assert changed == {str(touched[0])}
    assert found(state.documents(spark, kept)) == {n: {"_id": n, "v": int(n == 7)} for n in range(40)}
    assert state.advance(spark, kept, first.limit(0)) == [] and manifest.current(spark, kept.path).number == after.number


def test_order_and_repeats_of_batches_do_not_matter(spark, tmp_path):
    kept = state.Documents(str(tmp_path / "state"), buckets=4)
    log = [event(1, "insert", 1, {"_id": 1}), event(2, "update", 1, update={"updatedFields": {"a": 1}})]
    log += [event(3, "delete", 2), event(5, "update", 1, update={"updatedFields": {"a": 2, "b": 1}}), event(2, "insert", 2, {"_id": 2})]
    parts = [events(spark, [line]) for line in log]
    for i in (3, 0, 4, 3, 1, 2, 0):
        state.advance(spark, kept, parts[i])
    assert found(state.documents(spark, kept)) == {1: {"_id": 1, "a": 2, "b": 1}} == found(lookup.snapshot(events(spark, log)))


def test_readers_see_the_old_or_the_new(spark, tmp_path):
    path = str(tmp_path / "table")

    def store(text):
        folder = manifest.new_folder()
        spark.createDataFrame([(text,)], "text string").write.parquet(f"{path}/{folder}")
        return folder

    def read():
        folders = manifest.current(spark, path).folders()
        return sorted(r["text"] for r in spark.read.schema("text string").parquet(*folders).collect()) if folders else []

    assert read() == []
    one = manifest.swap(spark, manifest.current(spark, path), {"a": [store("a1")], "b": [store("b1")]})
    # A crash between write and swap: the folder is there, no version names it.
    lost = store("a2")
    assert read() == ["a1", "b1"]
    # A crash within the swap: the version is not whole.
    (tmp_path / "table" / "versions" / "v2").mkdir()
    (tmp_path / "table" / "versions" / "v2" / "part-0.parquet").write_bytes(b"broken")
    assert read() == ["a1", "b1"]
    manifest.swap(spark, manifest.current(spark, path), one.parts | {"a": [store("a3")]})
    assert read() == ["a3", "b1"] and not (tmp_path / "table" / lost).exists()
    for n in range(6):
        now = manifest.current(spark, path)
        manifest.swap(spark, now, now.parts | {"a": [store(f"a{n}")]})
    assert read() == ["a5", "b1"]
    assert len(list((tmp_path / "table" / "data").iterdir())) == 3 and len(list((tmp_path / "table" / "versions").iterdir())) == 2


def test_a_repeated_batch_gives_the_same_documents(spark, tmp_path):
    """A destination fails after the documents have moved on; the restart relays the batch once more."""
    root, trouble = str(tmp_path / "out"), {"fail": True}
    good = sinks.SINKS[KEYED_STREAM]

    def fails_once(rows, options, run_id, batch_id):
        if batch_id == 1 and trouble.pop("fail", False):
            raise ConnectionError("destination is down")
        good.write(rows, options, run_id, batch_id)

    configured = relay.Relay(
        [WAREHOUSE, KEYED_STREAM], sinks.SinkOptions(root), documents=state.Documents(f"{root}/documents", 4),
        sinks={**sinks.SINKS, KEYED_STREAM: sinks.Sink(good.shape, fails_once)},
    )
    parts = [
        [event(1, "insert", 1, {"_id": 1, "n": 0}), event(2, "update", 1, update={"updatedFields": {"n": 1}}), event(3, "update", 9, update={"updatedFields": {"n": 1}})],
        [event(4, "update", 1, update={"updatedFields": {"m": [2]}}), "no json", event(5, "update", 1, update={"removedFields": ["n"]})],
    ]
    for part in parts:
        spark.createDataFrame([(line,) for line in part], "value string").coalesce(1).write.mode("append").text(f"{root}/log")

        def run():
            relay.start(configured, change_log.stream_lines(spark, f"{root}/log"), f"{root}/checkpoint").awaitTermination()

        try:
            run()
        except StreamingQueryException as failure:
            assert "destination is down" in str(failure)
            run()
    rows = spark.read.parquet(f"{root}/{WAREHOUSE}").collect()
    assert sorted((int(r["id"][12:20], 16), r["fullDocument"]) for r in rows) == [
        (1, '{"_id":1,"n":0}'), (2, '{"_id":1,"n":1}'), (3, "null"), (4, '{"_id":1,"m":[2]}'), (5, '{"_id":1,"m":[2]}'),
    ]
    assert not trouble and spark.read.parquet(f"{root}/quarantine").count() == 1


def test_the_job_keeps_documents_from_the_log_on(spark, tmp_path):
    def add(*log):
        spark.createDataFrame([(line,) for line in log], "value string").coalesce(1).write.mode("append").text(str(tmp_path / "log"))

    def run():
        job.main(["--log", str(tmp_path / "log"), "--root", str(tmp_path / "out"), "--destinations", "bigquery", "--project", "p", "--keep-documents", "--buckets", "2"])

    add(event(1, "insert", 1, {"_id": 1, "n": 0}), event(2, "update", 1, update={"updatedFields": {"n": 1}}))
    run()
    add(event(3, "update", 1, update={"updatedFields": {"m": 1}}))
    run()
    rows = spark.read.parquet(str(tmp_path / "out" / WAREHOUSE)).collect()
    assert [r["fullDocument"] for r in rows] == ['{"_id":1,"m":1,"n":1}']
    with pytest.raises(SystemExit):
        job.arguments(["--log", "l", "--root", "r", "--destinations", "file", "--lookup", "f", "--keep-documents"])
    with pytest.raises(ValueError, match="both"):
        relay.Relay(["file"], sinks.SinkOptions("r"), snapshot=lambda: None, documents=state.Documents("d"))
