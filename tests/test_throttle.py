"""Throttled positions against the rule applied one event at a time."""

import random

import numpy as np
import pytest
from events import encoded, event
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.operators import throttle


def one_at_a_time(positions, interval):
    """(coll, T, I) in stream order -> the positions a throttled store saves."""
    last, saved = {}, []
    for coll, seconds, ordinal in sorted(positions, key=lambda p: p[1:]):
        if interval == 0 or coll not in last or seconds > last[coll] + interval:
            saved.append((coll, seconds, ordinal))
            last[coll] = seconds
    return sorted(saved)


def frame(spark, positions):
    rows = [("app", c, f"{c}-{t}-{i}", t, i) for c, t, i in positions]
    return spark.createDataFrame(rows, "db string, coll string, token string, T bigint, I bigint")


def saved(result):
    rows = result.collect()
    assert all(r["token"] == f"{r['coll']}-{r['T']}-{r['I']}" for r in rows)
    return sorted((r["coll"], r["T"], r["I"]) for r in rows)


def make(seed, span, count, hot):
    chosen = random.Random(seed)
    names = ["hot"] * hot + ["a", "b"]
    return list(
        {
            (chosen.choice(names), chosen.randrange(span), chosen.randrange(3))
            for _ in range(count)
        }
    )


@pytest.mark.parametrize(
    "interval, span, count",
    [(0, 1000, 300), (1, 400, 600), (10, 5000, 2000), (3600, 30 * 86400, 3000), (86400, 400 * 86400, 500)],
)
def test_equals_the_rule(spark, interval, span, count):
    positions = make(interval, span, count, hot=4)
    result = throttle.throttled_positions(frame(spark, positions), interval)
    assert saved(result) == one_at_a_time(positions, interval)


def test_spans_are_linked(spark, monkeypatch):
    """Short spans, so that chains cross many of them and skip some."""
    monkeypatch.setattr(throttle, "SPAN_SECONDS", 25)
    monkeypatch.setattr(throttle, "SPAN_INTERVALS", 2)
    for interval in (1, 7, 12, 40):
        positions = make(interval, 2000, 700, hot=2)
        result = throttle.throttled_positions(frame(spark, positions), interval)
        assert saved(result) == one_at_a_time(positions, interval)


def test_pieces_equal_the_whole(spark):
    positions = make(5, 3 * 86400, 2000, hot=2)
    expected = one_at_a_time(positions, 900)
    found = []
    for begin in range(0, 3 * 86400, 40_000):
        piece = [p for p in positions if begin <= p[1] < begin + 40_000]
        earlier = frame(spark, found) if found else None
        found += saved(throttle.throttled_positions(frame(spark, piece), 900, earlier))
    assert sorted(found) == expected


def test_first_event_saves_and_the_interval_is_exclusive(spark):
    events = encoded(spark, [event(str(t), t, 0) for t in (100, 109, 110, 111, 121, 122)])
    rows = throttle.throttled_positions(events, 10).collect()
    assert sorted(r["token"] for r in rows) == ["100", "111", "122"]


def test_negative_interval_is_an_error(spark):
    with pytest.raises(ValueError):
        throttle.throttled_positions(frame(spark, [("a", 1, 1)]), -1)


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 500), min_size=1), st.integers(1, 60))
def test_chains_inside_a_span(seconds, interval):
    ordered = np.array(sorted(seconds), dtype=np.int64)
    lasts = throttle._last_saves(ordered, interval)
    for index, first in enumerate(ordered):
        chain = ordered[throttle._chain(ordered, int(first), interval)]
        expected = [first]
        for second in ordered[index + 1 :]:
            if second > expected[-1] + interval:
                expected.append(second)
        assert list(chain) == expected
        assert lasts[index] == expected[-1]


def test_groups_are_spans_not_collections(spark):
    """One collection of many days is processed in many groups."""
    days = [("hot", day * 86400 + s, 0) for day in range(20) for s in (0, 50)]
    plan = throttle.throttled_positions(frame(spark, days), 60)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas [db#" in text.replace("`", "")
    assert text.count("span") > 2
    assert len(plan.collect()) == 20


def test_no_token_goes_through_python(spark):
    events = encoded(spark, [event(f"t{n}", n * 7, 1) for n in range(50)])
    plan = throttle.throttled_positions(events, 20)._jdf.queryExecution().analyzed().toString()
    grouped = [line for line in plan.splitlines() if "InPandas" in line]
    assert len(grouped) == 3 and not any("token" in line for line in grouped)
