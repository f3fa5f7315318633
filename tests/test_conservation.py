"""No event may vanish: every line is delivered or quarantined."""

import json

import pytest
from events import FULL_EVENT, encoded, event, labelled
from pyspark.sql import functions as F

from sluice.functions import cluster_time
from sluice.operators import quarantine
from sluice.operators.routing import Route
from sluice.streaming import ledger, relay
from sluice.streaming.sinks import SinkOptions

GOOD = json.dumps(event("1", 5, 1))


def test_glued_and_trailing_text_is_no_event(spark):
    bad = [GOOD + "],garbage}", GOOD + "],[" + GOOD, GOOD + "}," + GOOD, GOOD + "," + GOOD, GOOD + ',1]']
    rows = labelled(spark, [*bad, GOOD + "\t", " " + GOOD + " \r"]).collect()
    assert [r["reason"] is None for r in rows] == [False] * len(bad) + [True, True]


def test_the_whole_range_of_ordinals_is_delivered(spark):
    rows = encoded(spark, [event("1", 7, i) for i in (0, 2**31, 2**32 - 1)]).collect()
    assert sorted(r["I"] for r in rows) == [0, 2**31, 2**32 - 1]
    packed = spark.range(1).select(cluster_time.sequence(F.lit(7).cast("bigint"), F.lit(2**31).cast("bigint"))).first()[0]
    assert cluster_time.unpacked(packed) == (7, 2**31)


def test_resume_keeps_events_without_a_time(spark):
    broken = {k: v for k, v in event("2", coll="c").items() if k != "clusterTime"}
    saved = spark.createDataFrame([("app", "c", "0", 9, 9)], "db string, coll string, token string, T bigint, I bigint")
    rows = ledger.resume_each(labelled(spark, [event("1", 5, 1), broken, event("3", 10, 1)]), saved)
    assert quarantine.valid(rows).count() == 1 and quarantine.rejected(rows).count() == 1


def test_a_route_must_lead_to_a_destination(tmp_path):
    with pytest.raises(ValueError, match="route leads"):
        relay.Relay(["file"], SinkOptions(str(tmp_path)), routes=[Route("app", "c", "bigquery", "t")])


def test_object_rule_holds_for_events_of_the_file_alone(spark, tmp_path):
    routes = [Route("app", "c", "bigquery", "t"), Route("app", "d", "file", "t")]
    configured = relay.Relay(["bigquery", "file"], SinkOptions(str(tmp_path)), routes=routes)
    lines = [json.dumps(event(str(k), 5, k, coll=c, fullDocument="text")) for k, c in enumerate("cd")]
    rows = relay.prepare(configured, spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert {r["coll"]: r["reason"] is None for r in rows} == {"c": True, "d": False}


def test_events_without_a_route_are_not_counted(spark, tmp_path):
    configured = relay.Relay(["file"], SinkOptions(str(tmp_path)), routes=[Route("app", "d", "file", "t")])
    events = encoded(spark, [event("1", 1, 1, coll="c"), event("2", 1, 2, coll="d")])
    assert [r["token"] for r in relay._delivered(configured, events).collect()] == ["2"]
    assert FULL_EVENT
