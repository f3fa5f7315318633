"""What was relayed before: filters, exact comparison, days that are read, replays, crashes."""

import json

import pytest
from events import event, labelled
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sluice import job
from sluice.operators import quarantine
from sluice.schema import KEYED_STREAM, WAREHOUSE
from sluice.sources import change_log
from sluice.streaming import compaction, delivered, relay, sinks

DAY = 86400
START = 1704067200


def batch(spark, numbers, per_day=100):
    return labelled(spark, [event(f"82{n:06X}", START + n // per_day * DAY, n % per_day, key=n) for n in numbers])


def names(rows):
    return sorted(int(r["token"][2:], 16) for r in rows.collect())


@pytest.mark.parametrize("blocks", [1, 4, 1 << 10])
def test_copies_go_and_false_positives_stay(spark, tmp_path, blocks):
    """One block of 256 bits for 100 tokens says of most events that they may be copies; none is lost."""
    kept = delivered.Delivered(str(tmp_path / "d"), blocks)
    first = range(0, 300)
    assert names(delivered.unseen(spark, kept, batch(spark, first))) == list(first)
    delivered.record(kept, quarantine.valid(batch(spark, first)), "r", 0)
    # The same days again with half of the events known, and a day that no one has seen.
    again = batch(spark, [*range(0, 300, 2), *range(0, 300, 2)], 100).unionByName(batch(spark, range(1000, 1200), 400))
    assert names(delivered.unseen(spark, kept, again)) == list(range(1000, 1200))
    if blocks == 1:
        assert delivered.suspects(spark, kept, batch(spark, range(1000, 1200), 400)).count() > 0
    if blocks == 1 << 10:
        assert delivered.suspects(spark, kept, batch(spark, range(1000, 1200), 400)).count() < 10


def test_only_days_of_suspects_are_read(spark, tmp_path):
    kept = delivered.Delivered(str(tmp_path / "d"), 1 << 10)
    for n in range(5):
        delivered.record(kept, quarantine.valid(batch(spark, range(100 * n, 100 * n + 100))), "r", n)
    maybe = delivered.suspects(spark, kept, batch(spark, [205, 206, 310]))
    assert names(maybe) == [205, 206, 310]
    days = delivered._days(maybe)
    plan = delivered.tokens_of(spark, kept, days)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and len(days) == 2
    read = delivered.tokens_of(spark, kept, days).select(F.input_file_name().alias("f")).distinct().collect()
    assert {r["f"].split("cluster_date=")[1][:10] for r in read} == {"2024-01-03", "2024-01-04"}
    # Compacted days answer as before, and one filter is left of each.
    for table in kept.tables:
        assert compaction.compact(spark, table, None, least=1)
    assert names(delivered.unseen(spark, kept, batch(spark, [0, 205, 310, 499, 500]))) == [500]
    assert compaction.read(spark, kept.filters).groupBy("cluster_date", "block").count().where("count > 1").count() == 0


def test_a_hot_copy_and_rows_without_token(spark, tmp_path):
    kept = delivered.Delivered(str(tmp_path / "d"), 16)
    same = [event("82AA", START, 1)] * 200
    rows = labelled(spark, [*same, "no json", "no json", event("82AB", START, 2)])
    assert delivered.unseen(spark, kept, rows).count() == 4
    delivered.record(kept, quarantine.valid(rows), "r", 0)
    again = delivered.unseen(spark, kept, rows)
    assert [r["reason"] is None for r in again.collect()] == [False, False]
    assert delivered.unseen(spark, kept, rows.limit(0)).count() == 0


def test_a_failed_batch_is_not_taken_as_relayed(spark, tmp_path):
    """One destination fails after the other has the batch: the restart, and later a new checkpoint, leave one copy of all."""
    root, trouble = str(tmp_path / "out"), {"fail": True}
    good = sinks.SINKS[KEYED_STREAM]

    def fails_once(rows, options, run_id, batch_id):
        if batch_id == 1 and trouble.pop("fail", False):
            raise ConnectionError("destination is down")
        good.write(rows, options, run_id, batch_id)

    configured = relay.Relay(
        [WAREHOUSE, KEYED_STREAM], sinks.SinkOptions(root), seen=delivered.Delivered(f"{root}/delivered", 4),
        sinks={**sinks.SINKS, KEYED_STREAM: sinks.Sink(good.shape, fails_once)},
    )

    def run(checkpoint):
        query = relay.start(configured, change_log.stream_lines(spark, f"{root}/log"), f"{root}/{checkpoint}")
        query.awaitTermination()
        return query

    for numbers in ([1, 2, 3], [3, 4, 4, 1, 5]):
        found = [(json.dumps(event(f"8200000{n}", START, n, key=n)),) for n in numbers]
        spark.createDataFrame(found, "value string").coalesce(1).write.mode("append").text(f"{root}/log")
        try:
            run("checkpoint")
        except StreamingQueryException as failure:
            assert "destination is down" in str(failure)
            run("checkpoint")
    state = run("again").lastProgress["stateOperators"]
    for name, column, form in ((WAREHOUSE, "id", '{{"_data":"8200000{}"}}'), (KEYED_STREAM, "partition_key", "8200000{}")):
        assert sorted(r[column] for r in spark.read.parquet(f"{root}/{name}").collect()) == [form.format(n) for n in (1, 2, 3, 4, 5)]
    assert not trouble and not state


def test_the_job_drops_copies_of_earlier_runs(spark, tmp_path):
    def run(checkpoint, *more):
        place = ["--log", str(tmp_path / "log"), "--root", str(tmp_path / "out"), "--checkpoint", str(tmp_path / checkpoint)]
        job.main([*place, "--destinations", "bigquery", "--project", "p", "--start", "earliest", "--drop-copies", *more])
        return spark.read.parquet(str(tmp_path / "out" / WAREHOUSE)).count()

    now = int(job.dt.datetime.now().timestamp())
    log = [(json.dumps(event(f"8200000{n}", now, n, key=n)),) for n in range(5)]
    spark.createDataFrame(log, "value string").write.text(str(tmp_path / "log"))
    assert run("one") == 5
    assert run("two", "--expire-days", "3") == 5
    assert (tmp_path / "out" / "delivered" / "tokens").exists()


def test_rows_without_copies_in_their_batch_are_not_exchanged(spark, monkeypatch):
    alone = batch(spark, range(50))
    plan = delivered.first_of_batch(alone)._jdf.queryExecution().executedPlan().toString()
    assert plan == alone._jdf.queryExecution().executedPlan().toString()
    several = batch(spark, [*range(50), 3, 3, 7])
    for many in (100, 1):
        monkeypatch.setattr(delivered, "MANY_COPIES", many)
        found = delivered.first_of_batch(several)
        assert names(found) == list(range(50)) and found.columns == several.columns
