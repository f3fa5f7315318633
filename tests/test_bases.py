"""Documents at a past time from bases and replayed days, against the fold of the whole log."""

import datetime as dt
import json
import random
import shutil

import pytest
from test_patches import event, events

from sluice.operators import lookup
from sluice.sources import change_log
from sluice.streaming import bases, manifest

DAY = 86400


def day(n):
    return dt.date(1970, 1, 1) + dt.timedelta(days=n)


def found(frame):
    rows = [(json.loads(r["documentKey"])["_id"], json.loads(r["fullDocument"])) for r in frame.collect()]
    assert len(dict(rows)) == len(rows)
    return dict(rows)


def log(days=12, size=240):
    """Inserts, updates without documents and deletes of a few keys, some on the first or last second of a day."""
    deal = random.Random(7)
    lines = []
    for n in range(size):
        t = max(1, deal.randrange(days * DAY) if n % 3 else deal.randrange(1, days) * DAY - n % 2)
        key, kind = deal.randrange(9), deal.random()
        if kind < 0.25:
            lines.append(event(t, "insert", key, {"_id": key, "n": n}, ordinal=n))
        elif kind < 0.9:
            lines.append(event(t, "update", key, update={"updatedFields": {f"f{n % 3}": n}}, ordinal=n))
        else:
            lines.append(event(t, "delete", key, ordinal=n))
    return lines


@pytest.fixture
def archive(spark, tmp_path):
    path = str(tmp_path / "archive")
    change_log.write_archive(events(spark, log()), path)
    return path


@pytest.fixture
def kept(tmp_path):
    return bases.Bases(str(tmp_path / "bases"), every=3)


def test_days_of_bases():
    kept = bases.Bases("-", every=3)
    assert kept.days(day(0), day(7)) == [day(3), day(6)]
    assert kept.days(day(3), day(6)) == [day(6)] and kept.days(day(6), day(8)) == [] and kept.days(day(9), day(2)) == []
    with pytest.raises(ValueError):
        bases.Bases("-", every=0)


def test_any_time_equals_the_whole_log(spark, archive, kept):
    stored = change_log.read_archive(spark, archive)
    assert bases.advance(spark, kept, stored, day(11)) == [day(3), day(6), day(9)]
    assert bases.advance(spark, kept, stored, day(11)) == []
    for until in (0, DAY, 3 * DAY - 1, 3 * DAY, 7 * DAY + 100, 9 * DAY - 2, 20 * DAY):
        assert found(bases.documents_as_of(spark, kept, stored, until)) == found(lookup.snapshot(stored, until)), until


def test_only_the_days_after_the_last_base_are_read(spark, archive, kept):
    stored = change_log.read_archive(spark, archive)
    until = 7 * DAY + 100
    whole, last = found(lookup.snapshot(stored, until)), found(lookup.snapshot(stored, 20 * DAY))
    bases.advance(spark, kept, stored, day(6))
    replay = bases.writes_as_of(spark, kept, stored, until)
    plan = replay._jdf.queryExecution().executedPlan().toString()
    pruned = plan[plan.index("PartitionFilters") :][:200]
    assert "1970-01-07" in pruned and "1970-01-09" in pruned
    for n in range(6):
        shutil.rmtree(f"{archive}/cluster_date={day(n)}", ignore_errors=True)
    stored = change_log.read_archive(spark, archive)
    assert found(bases.documents_as_of(spark, kept, stored, until)) == whole
    # Nor does the next base read the days that the last one holds.
    assert bases.advance(spark, kept, stored, day(12)) == [day(9), day(12)]
    assert found(bases.documents_as_of(spark, kept, stored.where("false"), 12 * DAY - 1)) == last


def test_late_events_reach_every_base_after_them(spark, archive, kept):
    bases.advance(spark, kept, change_log.read_archive(spark, archive), day(9))
    late = events(spark, [
        event(DAY, "insert", 100, {"_id": 100, "v": 1}), event(4 * DAY, "update", 100, update={"updatedFields": {"w": 2}}),
        event(4 * DAY, "update", 1, update={"updatedFields": {"late": True}}, ordinal=9999),
    ])
    change_log.write_archive(late, archive)
    stored = change_log.read_archive(spark, archive)
    assert 100 not in found(bases.documents_as_of(spark, kept, stored, 9 * DAY))
    assert bases.amend(spark, kept, late) == [day(3), day(6), day(9)]
    for until in (DAY - 1, 3 * DAY, 6 * DAY, 10 * DAY):
        assert found(bases.documents_as_of(spark, kept, stored, until)) == found(lookup.snapshot(stored, until))
    assert found(bases.documents_as_of(spark, kept, stored, 9 * DAY))[100] == {"_id": 100, "v": 1, "w": 2}
    bases.amend(spark, kept, late)
    assert found(bases.documents_as_of(spark, kept, stored, 9 * DAY)) == found(lookup.snapshot(stored, 9 * DAY))
    assert bases.amend(spark, kept, late.where("T > 1e9")) == []
    assert bases.amend(spark, kept, events(spark, [event(9 * DAY, "delete", 1)])) == []


def test_a_crash_before_the_swap_is_made_good(spark, archive, kept, monkeypatch):
    stored = change_log.read_archive(spark, archive)
    swap, calls = manifest.swap, []

    def failing(*given, **more):
        calls.append(given)
        if len(calls) == 2:
            raise OSError("lost")
        return swap(*given, **more)

    monkeypatch.setattr(manifest, "swap", failing)
    with pytest.raises(OSError):
        bases.advance(spark, kept, stored, day(9))
    assert list(manifest.current(spark, kept.path).parts) == ["1970-01-04"]
    assert found(bases.documents_as_of(spark, kept, stored, 8 * DAY)) == found(lookup.snapshot(stored, 8 * DAY))
    assert bases.advance(spark, kept, stored, day(9)) == [day(6), day(9)]
    assert found(bases.documents_as_of(spark, kept, stored, 9 * DAY)) == found(lookup.snapshot(stored, 9 * DAY))


def test_expired_bases(spark, archive, kept):
    stored = change_log.read_archive(spark, archive)
    bases.advance(spark, kept, stored, day(9))
    assert bases.drop_expired(spark, kept, day(2)) == []
    assert bases.drop_expired(spark, kept, day(7)) == [day(3)]
    recent = stored.where("cluster_date >= '1970-01-07'")
    assert found(bases.documents_as_of(spark, kept, recent, 7 * DAY)) == found(lookup.snapshot(stored, 7 * DAY))
    # The days are still there: the time is answered from them.
    assert found(bases.documents_as_of(spark, kept, stored, 2 * DAY)) == found(lookup.snapshot(stored, 2 * DAY))
    with pytest.raises(LookupError):
        bases.documents_as_of(spark, kept, recent, 2 * DAY)


def test_an_empty_archive_has_no_base(spark, archive, kept):
    nothing = change_log.read_archive(spark, archive).where("false")
    assert bases.advance(spark, kept, nothing, day(9)) == []
    assert bases.documents_as_of(spark, kept, nothing, 9 * DAY).collect() == []
