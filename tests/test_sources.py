"""Scan, namespace, resume and start position."""

import pytest
from events import decoded, encoded, event
from pyspark.sql import functions as F

from sluice.operators import audit
from sluice.plans import catalog
from sluice.sources import change_log, table_events
from sluice.streaming import ledger


def log(spark):
    return encoded(
        spark,
        [
            event("a", 10, 1, coll="x"),
            event("b", 10, 2, coll="y"),
            event("c", 11, 0, coll="x"),
            event("d", 11, 3, coll="y"),
            event("e", 12, 0, coll="x"),
        ],
    )


def tokens(frame):
    return sorted(r["token"] for r in frame.select("token").collect())


def test_namespace(spark):
    assert tokens(change_log.in_namespace(log(spark), "app", "x")) == ["a", "c", "e"]
    assert tokens(change_log.in_namespace(log(spark), "app")) == list("abcde")


def test_missing_namespace_is_an_error(spark):
    with pytest.raises(LookupError, match="database 'other'"):
        change_log.in_namespace(log(spark), "other", "x")
    with pytest.raises(LookupError, match="collection 'z'"):
        change_log.in_namespace(log(spark), "app", "z")


def test_resume_is_strictly_after_the_saved_event(spark):
    # Two events share a second: the ordinal decides.
    assert tokens(change_log.resume_after(log(spark), "a\n")) == ["b", "c", "d", "e"]
    assert tokens(change_log.resume_after(log(spark), "c")) == ["d", "e"]
    assert tokens(change_log.resume_after(log(spark), "e")) == []


def test_resume_uses_the_ledger_first(spark):
    saved = audit.last_position(encoded(spark, [event("gone", 11, 1, coll="x")]))
    assert tokens(change_log.resume_after(log(spark), "gone", saved)) == ["d", "e"]


def test_unknown_token_is_an_error(spark):
    with pytest.raises(LookupError, match="nope"):
        change_log.resume_after(log(spark), "nope")


def test_start_positions(spark):
    events = log(spark)
    assert tokens(change_log.start_from(events, "earliest")) == list("abcde")
    assert tokens(change_log.start_from(events, "latest")) == []
    present = events.where("T < 11")
    assert tokens(change_log.start_from(events, "latest", present)) == ["c", "d", "e"]
    assert tokens(change_log.start_from(events, "latest", events.where("false"))) == list("abcde")
    with pytest.raises(ValueError):
        change_log.start_from(events, "middle")


def test_resume_each_collection(spark):
    saved = audit.last_position(log(spark).where("T = 10 and coll = 'x'"))
    assert tokens(ledger.resume_each(log(spark), saved)) == ["b", "c", "d", "e"]


def test_missing_and_unreadable_ledgers_differ(spark, tmp_path):
    assert ledger.read(spark, str(tmp_path / "none")) is None
    broken = tmp_path / "broken" / "run_id=r" / "batch_id=0"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_bytes(b"no parquet at all")
    with pytest.raises(Exception):
        change_log.resume_after(
            log(spark), "a", ledger.read(spark, str(tmp_path / "broken"))
        )


def test_archive_prunes_partitions_and_pushes_filters(spark, tmp_path):
    day = 86400
    events = encoded(spark, [event(str(n), n * day, 0) for n in range(6)])
    path = str(tmp_path / "archive")
    change_log.write_archive(events, path)
    later = change_log.after_position(change_log.read_archive(spark, path), 3 * day, 0)
    assert tokens(later) == ["4", "5"]
    plan = later.select("token")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cluster_date" in plan
    assert f"GreaterThanOrEqual(T,{3 * day})" in plan
    assert "ReadSchema: struct<token:string,T:bigint,I:bigint>" in plan


def test_lines_are_parsed_once(spark):
    """Filters on the header stay above the parsing projection."""
    kept = log(spark).where("coll = 'x'").select("token", "fullDocument")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1
    assert plan.count("$[0]['ns']") == 0


def test_a_row_group_larger_than_a_task_is_dealt_over_many(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(table_events, "TASK_ROWS", 1000)
    spark.range(20_000).selectExpr("id", "uuid() AS text").coalesce(1).write.parquet(str(tmp_path / "one.parquet"))
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        # Enough splits by bytes, but all rows are in one of them.
        assert spark.read.parquet(str(tmp_path / "one.parquet")).rdd.getNumPartitions() >= 8
        rows = table_events.read_table(spark, str(tmp_path), "one")
        sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    assert sum(sizes) == 20_000 and len(sizes) == 20 and max(sizes) <= 1100


def test_an_empty_table_is_read(spark, tmp_path):
    spark.range(0).write.parquet(str(tmp_path / "none.parquet"))
    assert table_events.read_table(spark, str(tmp_path), "none").count() == 0


def test_a_resume_finds_its_token_in_the_ledger(spark, monkeypatch):
    asked = []
    real = change_log.resume_after
    monkeypatch.setattr(change_log, "resume_after", lambda events, token, positions=None: asked.append((token, positions)) or real(events, token, positions))
    found = catalog.resume_after_token(spark, "/root/testdata/sf0.001").count()
    (token, positions), = asked
    assert found > 0 and positions.where(F.col("token") == token.rstrip("\n")).count() == 1


def test_a_line_is_searched_once_for_all_its_fields(spark):
    plan = encoded(spark, [event("a")])._jdf.queryExecution().executedPlan().toString()
    # Besides the one for the fields, two for the seal behind the event.
    assert plan.count("try_variant_get(line") == 3


def test_fields_of_other_types_and_of_no_object_are_null(spark):
    odd = ['{"_id":"a","operationType":7,"clusterTime":{"T":"1","I":4294967296},"ns":[1],"fullDocument":null}', "5", '{"_id":{"_data":1}} \n']
    rows = {r["raw"]: r for r in decoded(spark, odd).collect()}
    first = rows[odd[0]]
    assert [first[c] for c in ("token", "operationType", "T", "I", "db", "coll")] == [None] * 6
    assert [first[c] for c in ("_id", "fullDocument", "ns", "documentKey")] == ['"a"', "null", "[1]", "null"]
    assert [rows[line]["parsed"] for line in odd] == [True, False, True]
    assert rows[odd[2]]["token"] is None and rows[odd[1]]["_id"] == "null"


def test_a_day_of_the_archive_is_read_by_as_many_tasks_as_its_events_need(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(change_log, "FILE_EVENTS", 10)
    change_log.write_archive(encoded(spark, [event(f"{n:02}", 10, n) for n in range(25)]), str(tmp_path / "archive"))
    stored = change_log.read_archive(spark, str(tmp_path / "archive"))
    assert len(stored.inputFiles()) >= 3 and tokens(stored) == [f"{n:02}" for n in range(25)]
