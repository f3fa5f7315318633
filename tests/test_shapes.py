"""Exact rows of every destination."""

import datetime as dt
import json

import pytest
from events import FULL_EVENT, LOOP_EVENT, decoded, encoded, event, lines
from pyspark.sql import functions as F

from sluice.functions import cluster_time, json_text, shapes
from sluice.schema import WAREHOUSE_ROW
from sluice.sources import change_log

# ``ns`` of the golden event is a free map: the shapes do not need db and coll.
FREE_NS = {**FULL_EVENT, "ns": {"place": "corner shop"}}
RECORD = (
    '{"_data":"82AB01"}|insert|1970-01-01 00:00:00|{"order":"two brass lamps"}'
    '|{"place":"corner shop"}|{"number":"A-17"}|{"changed":"one lamp sold"}'
)


def one(frame):
    rows = frame.collect()
    assert len(rows) == 1
    return rows[0]


def test_warehouse_row(spark):
    rows = shapes.warehouse_row(decoded(spark, [FREE_NS]))
    assert [(f.name, f.dataType) for f in rows.schema] == [
        (f.name, f.dataType) for f in WAREHOUSE_ROW
    ]
    row = one(rows.withColumn("clusterTime", F.unix_seconds("clusterTime")))
    assert tuple(row) == (
        '{"_data":"82AB01"}',
        "insert",
        0,
        '{"order":"two brass lamps"}',
        '{"place":"corner shop"}',
        '{"number":"A-17"}',
        '{"changed":"one lamp sold"}',
    )


def test_delimited_record(spark):
    assert one(decoded(spark, [FREE_NS]).select(shapes.delimited()))[0] == RECORD


def test_topic_message_without_key(spark):
    row = one(shapes.topic_message(decoded(spark, [FREE_NS]), F.lit("t")))
    assert tuple(row) == ("t", None, -(2**63), RECORD)


def test_topic_message_with_key(spark):
    row = one(
        shapes.topic_message(decoded(spark, [FREE_NS], "documentKey"), F.lit("t"))
    )
    assert row["ordering_key"] == '{"number":"A-17"}'


def test_ordering_key_forms(spark):
    for name, text in [
        ("operationType", "insert"),
        ("documentKey", '{"number":"A-17"}'),
        ("clusterTime", '{"I":0,"T":0}'),
        ("absent", None),
    ]:
        assert one(decoded(spark, [FREE_NS], name))["ordering_key"] == text
    with_null = {**FREE_NS, "documentKey": None}
    assert one(decoded(spark, [with_null], "documentKey"))["ordering_key"] == "null"


def test_keyed_record(spark):
    row = one(shapes.keyed_record(decoded(spark, [FREE_NS]), F.lit("s")))
    assert tuple(row) == ("s", "82AB01", RECORD + "\n")


def test_missing_payloads_are_null_text(spark):
    assert one(encoded(spark, [LOOP_EVENT]).select(shapes.delimited()))[0] == (
        '{"_data":"82AB01"}|insert|2021-11-30 15:00:00|null'
        '|{"coll":"orders","db":"shop"}|null|null'
    )


def test_json_null_and_absent_payload_are_alike(spark):
    with_null = {**LOOP_EVENT, "fullDocument": None}
    rows = encoded(spark, [LOOP_EVENT, with_null]).select("fullDocument").collect()
    assert [r[0] for r in rows] == ["null", "null"]


def test_file_line(spark):
    unknown = {**FREE_NS, "lsid": {"id": 1}}
    text = one(decoded(spark, [unknown]).select(shapes.file_line()))[0]
    assert text == (
        '{"logType":"changeStream","cs":{"_id":{"_data":"82AB01"},"operationType":"insert",'
        '"clusterTime":"1970-01-01T00:00:00Z","ns":{"place":"corner shop"},'
        '"fullDocument":{"order":"two brass lamps"},'
        '"documentKey":{"number":"A-17"},'
        '"updateDescription":{"changed":"one lamp sold"}}}'
    )


def test_file_line_options(spark):
    options = shapes.file_line("audit", "change", "written")
    line = json.loads(one(decoded(spark, [LOOP_EVENT]).select(options))[0])
    assert list(line) == ["written", "logType", "change"]
    assert line["logType"] == "audit"
    assert line["change"]["fullDocument"] is None
    dt.datetime.strptime(line["written"], "%Y-%m-%dT%H:%M:%S.%f%z")


def test_file_line_empty_options_mean_defaults(spark):
    line = json.loads(one(decoded(spark, [LOOP_EVENT]).select(shapes.file_line("", "")))[0])
    assert list(line) == ["logType", "cs"]


@pytest.mark.parametrize(
    "seconds, zone, text, rfc3339",
    [
        (1638284400, "UTC", "2021-11-30 15:00:00", "2021-11-30T15:00:00Z"),
        (1638284400, "Asia/Tokyo", "2021-12-01 00:00:00", "2021-12-01T00:00:00+09:00"),
        (1650366482, "UTC", "2022-04-19 11:08:02", "2022-04-19T11:08:02Z"),
        (1650366482, "Asia/Kolkata", "2022-04-19 16:38:02", "2022-04-19T16:38:02+05:30"),
        (1650366482, "America/New_York", "2022-04-19 07:08:02", "2022-04-19T07:08:02-04:00"),
        # The New York clock shows 01:30 twice on this day; the offset tells which.
        (1667712600, "America/New_York", "2022-11-06 01:30:00", "2022-11-06T01:30:00-04:00"),
        (1667716200, "America/New_York", "2022-11-06 01:30:00", "2022-11-06T01:30:00-05:00"),
        (4294967295, "UTC", "2106-02-07 06:28:15", "2106-02-07T06:28:15Z"),
    ],
)
@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York"])
def test_cluster_time_texts(spark, seconds, zone, text, rfc3339, session_zone):
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        column = F.lit(seconds).cast("bigint")
        row = one(
            spark.range(1).select(
                cluster_time.as_text(column, zone), cluster_time.as_rfc3339(column, zone)
            )
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(row) == (text, rfc3339)


def test_sequence_keeps_order_over_the_whole_range(spark):
    pairs = [(0, 0), (0, 5), (1, 0), (2**31, 1), (2**31, 2**32 - 1), (2**32 - 1, 2**31), (2**32 - 1, 2**32 - 1)]
    rows = spark.createDataFrame(pairs, "T bigint, I bigint").select(
        cluster_time.sequence(F.col("T"), F.col("I")).alias("s")
    )
    values = [r["s"] for r in rows.collect()]
    assert values == sorted(set(values)) and values[-1] == 2**63 - 1


def test_canonical_json(spark):
    document = {"b": [1, {"z": 1, "a": None}], "a": 9007199254740993, "t": "é\n\"\\|"}
    text = one(encoded(spark, [event("1", fullDocument=document)]))["fullDocument"]
    assert text == '{"a":9007199254740993,"b":[1,{"a":null,"z":1}],"t":"é\\n\\"\\\\|"}'


def test_markup_is_escaped_for_all_but_the_file(spark):
    source = event("1", fullDocument={"t": "<a&b>  "})
    escaped = '{"t":"\\u003ca\\u0026b\\u003e\\u2028\\u2029"}'
    rows = encoded(spark, [source])
    assert one(shapes.warehouse_row(rows))["fullDocument"] == escaped
    assert escaped in one(rows.select(shapes.delimited()))[0]
    assert '{"t":"<a&b>\\u2028\\u2029"}' in one(rows.select(shapes.file_line()))[0]


def test_quote(spark):
    text = 'a"b\\c\n'
    quoted = spark.range(1).select(json_text.quote(F.lit(text)))
    assert json.loads(one(quoted)[0]) == text


# Reading a delimited record back: outside JSON strings a pipe never occurs, so a
# field is plain text without quotes and pipes, mixed with whole JSON strings.
FIELD = r'([^"|]*+(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"[^"|]*+)*+)'
SEVEN_FIELDS = r"(?s)^" + r"\|".join([FIELD] * 7) + r"\n?$"


def test_delimited_record_loses_nothing(spark):
    texts = [
        "|{",
        '}|{"',
        "|null",
        "|{}",
        '|{"coll":"x"}|',
        "back\\slash\\\\",
        "line\nbreak",
        '"|"',
        "|" * 50,
        "x|" * 600_000,
    ]
    sources = [
        event(str(i), fullDocument={"t": t}, documentKey={"k|": t[:20]})
        for i, t in enumerate(texts)
    ]
    rows = encoded(spark, sources)
    parts = [F.regexp_extract("value", SEVEN_FIELDS, n + 1).alias(f"p{n}") for n in range(7)]
    found = (
        shapes.keyed_record(rows, F.lit("s")).select("partition_key", *parts).collect()
    )
    assert len(found) == len(texts)
    for row in found:
        source = sources[int(row["partition_key"])]
        assert json.loads(row["p0"]) == source["_id"]
        assert (row["p1"], row["p2"]) == ("insert", "1970-01-01 00:00:00")
        assert json.loads(row["p3"]) == source["fullDocument"]
        assert json.loads(row["p4"]) == source["ns"]
        assert json.loads(row["p5"]) == source["documentKey"]
        assert row["p6"] == "null\n"


def test_parse_takes_exactly_one_value(spark):
    whole = '{"a":1}'
    texts = [whole, whole + whole, whole + "," + whole, whole + " x", "", "x", whole + "  "]
    decoded_rows = change_log.decode(change_log.parse(lines(spark, texts))).select("raw", "parsed")
    assert {r["raw"]: r["parsed"] for r in decoded_rows.collect()} == {
        t: t in (whole, whole + "  ") for t in texts
    }
