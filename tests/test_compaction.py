"""Compaction of closed days: bounded folders, nothing lost or doubled, at any crash."""

import datetime as dt
import os

import pytest
from events import event, lines

from sluice.operators import audit
from sluice.schema import FILE, WAREHOUSE
from sluice.streaming import compaction, ledger, manifest, relay, sinks

DAY = 86_400
BEFORE = dt.date(1970, 1, 4)


def batch_of(spark, configured, number, run="run"):
    """One event on each of four days, the last of which stays open."""
    rows = [event(f"t{number:03}-{day}", day * DAY + number, number, coll=f"c{day % 2}") for day in range(4)]
    relay.relay_batch(configured, lines(spark, rows), run, number)


@pytest.fixture
def configured(tmp_path):
    return relay.Relay([WAREHOUSE, FILE], sinks.SinkOptions(str(tmp_path / "out")), backfill=True, compact_before=lambda: BEFORE)


def ids(spark, configured):
    warehouse, file, *_ = relay.tables(configured)
    found = sorted(r["id"][len('{"_data":"') : -2] for r in compaction.read(spark, warehouse).collect())
    assert compaction.read(spark, file).count() == len(found)
    return found


def expected(numbers):
    return sorted(f"t{n:03}-{day}" for n in numbers for day in range(4))


def batch_folders(path):
    return sum(name.startswith("batch_id=") for _, names, _ in os.walk(path) for name in names)


def test_folders_stay_few(spark, configured):
    counts = []
    for number in range(10):
        batch_of(spark, configured, number)
        if number % 3 == 2:
            relay.compact(configured, spark, "run", number, least=2)
        counts.append(batch_folders(configured.options.path(WAREHOUSE)))
    # The open day keeps its folders; each closed one those of the last compactions.
    assert max(counts) <= 10 + 3 * 6 and counts[-1] < 4 * 10
    assert batch_folders(configured.ledger_path) <= 8 and batch_folders(configured.audit_path) <= 8
    assert ids(spark, configured) == expected(range(10))
    positions = ledger.read(spark, configured.ledger_path)
    assert {(r["coll"], r["token"]) for r in audit.last_position(positions).collect()} == {("c0", "t009-2"), ("c1", "t009-3")}
    summed = compaction.read(spark, relay.tables(configured)[-1]).groupBy("coll").sum("events").collect()
    assert {tuple(r) for r in summed} == {("c0", 20), ("c1", 20)}
    kept = compaction.read(spark, relay.tables(configured)[0])
    assert {r["batch_id"] for r in kept.select("batch_id").distinct().collect()} == set(range(10))
    content = [n for _, names, _ in os.walk(configured.options.path(WAREHOUSE) + "_closed") for n in names if n.startswith("content=")]
    assert len(content) <= 3 * manifest.KEPT


def test_the_open_batch_may_be_repeated(spark, configured):
    for number in range(3):
        batch_of(spark, configured, number)
    relay.compact(configured, spark, "run", 2, least=1)
    batch_of(spark, configured, 2)
    assert ids(spark, configured) == expected(range(3))
    # Late events of a closed day join what it already has.
    batch_of(spark, configured, 3)
    relay.compact(configured, spark, "run", 4, least=1)
    assert ids(spark, configured) == expected(range(4))


@pytest.mark.parametrize("when", ["write", "swap", "remove"])
def test_a_crash_leaves_old_or_new(spark, configured, monkeypatch, when):
    for number in range(3):
        batch_of(spark, configured, number)
    relay.compact(configured, spark, "run", 9, least=1)
    for number in range(3, 5):
        batch_of(spark, configured, number)

    def crash(*_, **__):
        raise InterruptedError(when)

    place = {"write": (compaction.manifest, "swap"), "swap": (manifest, "sweep"), "remove": (compaction, "_remove")}[when]
    with monkeypatch.context() as patched:
        patched.setattr(*place, crash)
        with pytest.raises(InterruptedError):
            relay.compact(configured, spark, "run", 9, least=1)
        assert ids(spark, configured) == expected(range(5))
    relay.compact(configured, spark, "run", 9, least=1)
    assert ids(spark, configured) == expected(range(5))
    relay.compact(configured, spark, "run", 9, least=1)
    assert ids(spark, configured) == expected(range(5))
    assert batch_folders(configured.options.path(WAREHOUSE)) == 5


def test_expired_content_leaves(spark, configured):
    for number in range(2):
        batch_of(spark, configured, number)
    relay.compact(configured, spark, "run", 9, least=1)
    relay.compact(configured, spark, "run", 9, least=1)
    for table in relay.tables(configured)[:2]:
        compaction.drop_expired(spark, table, dt.date(1970, 1, 2))
    assert ids(spark, configured) == sorted(t for t in expected(range(2)) if not t.endswith("-0"))


def test_targets_that_look_like_numbers_stay_texts(spark, configured):
    options = sinks.SinkOptions(configured.options.root, targets={WAREHOUSE: "007", FILE: "1e3"})
    named = relay.Relay([WAREHOUSE, FILE], options, compact_before=lambda: BEFORE)
    for number in range(2):
        batch_of(spark, named, number)
    relay.compact(named, spark, "run", 9, least=1)
    assert {r["table"] for r in compaction.read(spark, relay.tables(named)[0]).collect()} == {"007"}
    assert {r["log"] for r in compaction.read(spark, relay.tables(named)[1]).collect()} == {"1e3"}
