"""Delimited records read back, and texts that are none."""

import json

from events import event, lines
from pyspark.sql import functions as F

from sluice.functions import shapes
from sluice.operators import quarantine
from sluice.operators.records import FIELDS, NOT_A_RECORD, parse_delimited
from sluice.sources import change_log


def test_fields_come_back(spark):
    texts = ["|", '}|{"', "back\\slash\\\\", "line\nbreak\n", '"|"', "x|" * 300_000, "é" * 5]
    sources = [event(str(i), fullDocument={"t": t}, documentKey={"k|": t[:9]}) for i, t in enumerate(texts)]
    decoded = change_log.decode(change_log.parse(lines(spark, sources)))
    events = quarantine.valid(quarantine.label(decoded))
    keyed = shapes.keyed_record(events, F.lit("s"))
    for records in (events.select(shapes.delimited().alias("value")), keyed):
        rows = {json.loads(r["_id"])["_data"]: r for r in parse_delimited(records).collect()}
        assert len(rows) == len(texts)
        for i, source in enumerate(sources):
            row = rows[str(i)]
            assert row["reason"] is None and row["raw"] is None
            assert row["operationType"] == "insert" and row["updateDescription"] == "null"
            assert json.loads(row["fullDocument"]) == source["fullDocument"]
            assert json.loads(row["documentKey"]) == source["documentKey"]


def test_other_texts_are_rejected(spark):
    good = '{"_data":"1"}|insert|1970-01-01 00:00:00|{"a":"b|c"}|{}|{}|null'
    bad = ["", "a|b", good + "|", good + "|x", good.replace('c"', "c"), "x" + '"' + good, good.replace("|null", "")]
    frame = spark.createDataFrame([(t,) for t in [good, *bad]] + [(None,)], "value string")
    rows = parse_delimited(frame).collect()
    assert [r["_id"] for r in rows if r["reason"] is None] == ['{"_data":"1"}']
    rejected = [r for r in rows if r["reason"] == NOT_A_RECORD]
    assert [r["raw"] for r in rejected] == [*bad, None]
    assert all(r[name] is None for r in rejected for name in FIELDS)


def test_empty_table(spark):
    assert parse_delimited(spark.createDataFrame([], "value string, raw int, parts int")).count() == 0
