"""The index of the log's files: starts that open no older file, and lose nothing."""

import json
import os

import pytest
from events import event, lines
from pyspark.sql import functions as F

from sluice import job
from sluice.operators import audit, quarantine
from sluice.schema import WAREHOUSE
from sluice.sources import change_log, log_index
from sluice.streaming import ledger


def add(spark, folder, numbers, more=()):
    rows = [event(f"t{n:03}", 1_700_000_000 + n, n % 3, coll=f"c{n % 2}") for n in numbers]
    lines(spark, [*rows, *more]).coalesce(1).write.mode("append").text(str(folder))


def opened(frame):
    """How many files a frame has opened."""
    frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


def spoil(folder):
    """Other bytes in all files of now, at their size and time; a reader that opens one fails by its checksum, or finds no event."""
    for name in os.listdir(folder):
        path = os.path.join(folder, name)
        if not name.startswith((".", "_")):
            kept = os.stat(path)
            with open(path, "wb") as file:
                file.write(b"x" * kept.st_size)
            os.utime(path, ns=(kept.st_atime_ns, kept.st_mtime_ns))


@pytest.fixture
def log(spark, tmp_path):
    for at in range(0, 40, 10):
        add(spark, tmp_path / "log", range(at, at + 10))
    return str(tmp_path / "log")


def test_only_unknown_files_are_opened(spark, log, tmp_path):
    index = str(tmp_path / "index")
    assert log_index.read(spark, index).count() == 0
    assert log_index.refresh(spark, log, index) == 4 and log_index.refresh(spark, log, index) == 0
    before = sorted(map(str, log_index.read(spark, index).collect()))
    spoil(log)
    add(spark, log, range(40, 45))
    lines(spark, []).coalesce(1).write.mode("append").text(log)
    assert log_index.refresh(spark, log, index) >= 1 and log_index.refresh(spark, log, index) == 0
    rows = log_index.in_folder(spark, log, index)
    assert set(before) <= set(map(str, rows.collect()))
    newest = {r["coll"]: (r["token"], r["T"], r["I"]) for r in log_index.positions(rows).collect()}
    assert newest == {"c0": ("t044", 1_700_000_044, 2), "c1": ("t043", 1_700_000_043, 1)}
    assert log_index.positions(rows, "app", "c1").count() == 1 and log_index.positions(rows, "none").count() == 0


def test_positions_are_those_of_the_log(spark, log, tmp_path):
    add(spark, log, [50], ["no json", '{"_id": {}}', json.dumps(event("late", 1_700_000_090, 1, coll="c0")).replace("operationType", "op")])
    index = str(tmp_path / "index")
    log_index.refresh(spark, log, index)
    events = quarantine.valid(log_index.labelled_headers(change_log.read_lines(spark, log)))
    want = sorted(map(tuple, audit.last_position(events).collect()))
    assert sorted(map(tuple, log_index.positions(log_index.read(spark, index)).collect())) == want


def test_lines_after_positions_open_only_what_follows(spark, log, tmp_path):
    index = str(tmp_path / "index")
    log_index.refresh(spark, log, index)
    rows = log_index.in_folder(spark, log, index)
    events = quarantine.valid(log_index.labelled_headers(change_log.read_lines(spark, log)))
    for last, files in ((9, 3), (10, 3), (38, 1), (39, 0), (0, 4)):
        saved = audit.last_position(events.where(F.col("T") <= 1_700_000_000 + last))
        left = log_index.lines_after(spark, log, rows, saved)
        # c1 has no position at 0, so all files stay.
        assert opened(left) == files
        found = ledger.resume_each(quarantine.valid(log_index.labelled_headers(left)), saved)
        assert sorted(r["token"] for r in found.collect()) == [f"t{n:03}" for n in range(last + 1, 40)]
    saved = audit.last_position(events.where("coll = 'c0'"))
    assert len(log_index.passed(rows, saved)) == 0 and len(log_index.passed(rows, saved, ("app", "c0"))) == 4
    assert log_index.passed(rows, saved, ("other", None)) and len(log_index.passed(rows, saved, ("other", None))) == 4


def test_files_with_unplaced_events_stay(spark, log, tmp_path):
    add(spark, log, [], ["no json"])
    index = str(tmp_path / "index")
    log_index.refresh(spark, log, index)
    rows = log_index.in_folder(spark, log, index)
    assert opened(log_index.lines_after(spark, log, rows, log_index.positions(rows))) == 1
    # Nor is a file left out that nobody has described.
    saved = log_index.positions(rows)
    add(spark, log, [1])
    assert opened(log_index.lines_after(spark, log, rows, saved)) == 2


def test_a_token_is_looked_for_where_it_may_be(spark, log, tmp_path):
    index = str(tmp_path / "index")
    log_index.refresh(spark, log, index)
    rows = log_index.in_folder(spark, log, index)
    assert [len(log_index.holding(rows, t)) for t in ("t015", "t039", "u", "a")] == [1, 1, 0, 0]
    assert log_index.position_of(spark, log, rows, "t015").first()["I"] == 0
    assert log_index.position_of(spark, log, rows, "t0155") is None
    # Tokens whose text does not follow the log are found all the same.
    add(spark, log, [60], [event("a-late", 1_700_000_070), event("zz", 1_700_000_071)])
    add(spark, log, [], [event("b-other", 1_700_000_072)])
    log_index.refresh(spark, log, index)
    rows = log_index.in_folder(spark, log, index)
    assert log_index.position_of(spark, log, rows, "t033").first()["token"] == "t033"


def run(log, root, *more):
    job.main(["--log", log, "--root", str(root), "--destinations", "bigquery", "--project", "p", *more])


def tokens(spark, root):
    rows = spark.read.parquet(str(root / WAREHOUSE)).select("id").collect()
    return sorted(r["id"][len('{"_data":"') : -2] for r in rows)


def quarantined(spark, root):
    place = root / "quarantine"
    return spark.read.schema("raw string, reason string").parquet(str(place)).count() if place.exists() else 0


@pytest.mark.parametrize("how", ["latest", "ledger", "token"])
def test_a_start_opens_no_older_file(spark, log, tmp_path, how):
    shared = ["--index", str(tmp_path / "index")]
    run(log, tmp_path / "old", "--start", "earliest", *shared)
    assert tokens(spark, tmp_path / "old") == [f"t{n:03}" for n in range(40)]
    # The relay has described every file it read.
    assert log_index.refresh(spark, log, shared[1]) == 0
    if how != "token":
        spoil(log)
    add(spark, log, range(40, 46))
    if how == "ledger":
        run(log, tmp_path / "new", "--resume-ledger", str(tmp_path / "old" / "positions"), *shared)
    elif how == "token":
        older = [os.path.join(log, n) for n in os.listdir(log) if not n.startswith((".", "_"))]
        holds = [p for p in older if "t039" in open(p).read() or "t041" in open(p).read()]
        aside = {p: open(p, "rb").read() for p in holds}
        spoiled = [os.stat(p) for p in holds]
        spoil(log)
        for path, kept in zip(holds, spoiled):
            with open(path, "wb") as file:
                file.write(aside[path])
            os.utime(path, ns=(kept.st_atime_ns, kept.st_mtime_ns))
        run(log, tmp_path / "new", "--resume-token", "t039", "--db", "app", "--coll", "c1", *shared)
        assert tokens(spark, tmp_path / "new") == ["t041", "t043", "t045"]
        assert quarantined(spark, tmp_path / "new") == 0
        return
    else:
        run(log, tmp_path / "new", "--start", "latest", *shared)
        # The start is after what was there: the files that came since the old relay are described, not relayed.
        add(spark, log, range(46, 50))
        run(log, tmp_path / "new", "--start", "latest", *shared)
    assert tokens(spark, tmp_path / "new") == [f"t{n:03}" for n in (range(40, 46) if how == "ledger" else range(46, 50))]
    assert quarantined(spark, tmp_path / "new") == 0
