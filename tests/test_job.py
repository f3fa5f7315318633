"""The job: options, where it begins, restarts."""

import datetime as dt

import pytest
from events import event, lines

from sluice import job
from sluice.schema import FILE, WAREHOUSE
from sluice.streaming import ledger


def add(spark, folder, numbers):
    rows = [event(f"t{n}", 1_700_000_000 + n, 0, coll=f"c{n % 2}") for n in numbers]
    lines(spark, rows).coalesce(1).write.mode("append").text(str(folder))


def run(tmp_path, root, *more):
    job.main(
        ["--log", str(tmp_path / "log"), "--root", str(tmp_path / root), "--destinations", *more]
    )


def tokens(spark, tmp_path, root):
    rows = spark.read.parquet(str(tmp_path / root / WAREHOUSE)).select("id").collect()
    return sorted(r["id"][len('{"_data":"') : -2] for r in rows)


@pytest.fixture(autouse=True)
def keep_session(spark):
    yield


def test_earliest_and_restart(spark, tmp_path):
    add(spark, tmp_path / "log", range(4))
    run(tmp_path, "out", "bigquery, file", "--project", "p", "--start", "earliest")
    add(spark, tmp_path / "log", range(4, 6))
    run(tmp_path, "out", "bigquery, file", "--project", "p", "--start", "earliest")
    assert tokens(spark, tmp_path, "out") == [f"t{n}" for n in range(6)]


def test_latest_is_fixed_at_the_first_start(spark, tmp_path):
    add(spark, tmp_path / "log", range(4))
    options = ["bigquery", "--project", "p"]
    run(tmp_path, "out", *options)
    add(spark, tmp_path / "log", range(4, 8))
    run(tmp_path, "out", *options)
    assert tokens(spark, tmp_path, "out") == [f"t{n}" for n in range(4, 8)]


def test_resume_token_of_one_collection(spark, tmp_path):
    add(spark, tmp_path / "log", range(8))
    scope = ["bigquery", "--project", "p", "--db", "app", "--coll", "c1"]
    run(tmp_path, "out", *scope, "--resume-token", "t3\n")
    assert tokens(spark, tmp_path, "out") == ["t5", "t7"]
    with pytest.raises(LookupError, match="nope"):
        run(tmp_path, "other", *scope, "--resume-token", "nope")
    with pytest.raises(LookupError, match="does not exist"):
        run(tmp_path, "third", "file", "--db", "app", "--coll", "c9")


def test_resume_from_a_ledger(spark, tmp_path):
    add(spark, tmp_path / "log", range(4))
    run(tmp_path, "old", "file", "--start", "earliest")
    add(spark, tmp_path / "log", range(4, 6))
    older = str(tmp_path / "old" / "positions")
    run(tmp_path, "new", "bigquery", "--project", "p", "--resume-ledger", older)
    assert tokens(spark, tmp_path, "new") == ["t4", "t5"]
    with pytest.raises(LookupError, match="no ledger"):
        run(tmp_path, "bad", "file", "--resume-ledger", str(tmp_path / "none"))


def test_routes_targets_and_expiry(spark, tmp_path):
    today = int(dt.datetime.now(dt.timezone.utc).timestamp())
    rows = [
        event("old", today - 10 * 86400, coll="c0"),
        event("new", today, coll="c0"),
        event("also", today, coll="c1"),
    ]
    lines(spark, rows).write.text(str(tmp_path / "log"))
    routes = ["--route", "app.c0=file:zero", "--route", "app.c1=file:one"]
    limits = ["--expire-days", "5"]
    run(tmp_path, "out", "file", "--start", "earliest", *routes, *limits, "--backfill")
    kept = spark.read.text(str(tmp_path / "out" / FILE)).groupBy("log").count().collect()
    assert sorted(map(tuple, kept)) == [("one", 1), ("zero", 1)]
    assert ledger.read(spark, str(tmp_path / "out" / "positions")).count() == 2


def test_expiry_in_a_stream_that_stays_up(spark, tmp_path):
    today = int(dt.datetime.now(dt.timezone.utc).timestamp())

    def arrive(name):
        rows = [event(f"old {name}", today - 10 * 86400), event(f"new {name}", today)]
        lines(spark, rows).coalesce(1).write.mode("append").text(str(tmp_path / "log"))

    arrive("first")
    options = job.arguments(
        ["--log", str(tmp_path / "log"), "--root", str(tmp_path / "out"), "--destinations", "bigquery"]
        + ["--project", "p", "--start", "earliest", "--every", "1 second", "--expire-days", "5"]
    )
    query = job.begin(spark, options)
    try:
        query.processAllAvailable()
        assert tokens(spark, tmp_path, "out") == ["new first"]
        arrive("second")
        query.processAllAvailable()
        assert query.isActive
        assert tokens(spark, tmp_path, "out") == ["new first", "new second"]
    finally:
        query.stop()


def test_option_errors(tmp_path):
    with pytest.raises(SystemExit):
        job.arguments(["--log", "l", "--root", "r", "--destinations", "file", "--resume-token", "t"])
    with pytest.raises(SystemExit):
        job.arguments(["--log", "l", "--root", "r", "--destinations", "file", "--coll", "c"])
