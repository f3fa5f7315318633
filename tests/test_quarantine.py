"""Invalid events: reasons, conservation, strict mode."""

import json

import pytest
from events import FULL_EVENT, LOOP_EVENT, event, labelled
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sluice.operators import quarantine as q


def without(source, *path):
    copy = json.loads(json.dumps(source))
    inner = copy
    for name in path[:-1]:
        inner = inner[name]
    del inner[path[-1]]
    return copy


def reasons(spark, sources, ordering_by=None, **rules):
    rows = labelled(spark, sources, ordering_by, **rules).select("reason").collect()
    return [r["reason"] for r in rows]


@pytest.mark.parametrize(
    "field", ["_id", "fullDocument", "ns", "documentKey", "updateDescription"]
)
def test_nan_is_no_json(spark, field):
    bad = json.dumps({**FULL_EVENT, field: float("nan")})
    inside = json.dumps({**FULL_EVENT, field: {"x": float("nan")}})
    assert "NaN" in bad
    assert reasons(spark, [bad, inside]) == [q.NOT_JSON] * 2


def test_header_reasons(spark):
    cases = {
        q.NO_TOKEN: [
            {**FULL_EVENT, "_id": "82AB01"},
            {**FULL_EVENT, "_id": {"x": "82AB01"}},
            {**FULL_EVENT, "_id": {"_data": 5}},
            {**FULL_EVENT, "_id": {"_data": {"x": 1}}},
            without(FULL_EVENT, "_id"),
        ],
        q.NO_OPERATION: [
            without(FULL_EVENT, "operationType"),
            {**FULL_EVENT, "operationType": 7},
        ],
        q.NO_CLUSTER_TIME: [
            without(FULL_EVENT, "clusterTime"),
            without(FULL_EVENT, "clusterTime", "T"),
            {**FULL_EVENT, "clusterTime": {"T": "1", "I": 0}},
            {**FULL_EVENT, "clusterTime": {"T": -1, "I": 0}},
            {**FULL_EVENT, "clusterTime": {"T": 1, "I": 2**32}},
        ],
        q.NO_NAMESPACE: [
            without(FULL_EVENT, "ns"),
            without(FULL_EVENT, "ns", "coll"),
            without(FULL_EVENT, "ns", "db"),
            {**FULL_EVENT, "ns": {"db": 1, "coll": "x"}},
        ],
        q.NOT_JSON: ["", "x", '{"a":', '{"_id": 1}{"_id": 2}'],
        None: [FULL_EVENT, LOOP_EVENT],
    }
    for reason, sources in cases.items():
        assert reasons(spark, sources) == [reason] * len(sources), reason


def test_payload_reasons(spark):
    text = json.dumps(event("1", document="X")).replace('"X"', "1e400")
    named = event("2", document="Infinity")
    plain = event("3", documentKey="not an object")
    assert reasons(spark, [text, named, plain], payloads=True) == [q.OUT_OF_RANGE, None, None]
    assert reasons(spark, [plain, LOOP_EVENT], payloads=True, objects_only=True) == [
        q.NOT_AN_OBJECT,
        None,
    ]


def test_missing_ordering_key(spark):
    assert reasons(spark, [FULL_EVENT], "documentKey") == [None]
    assert reasons(spark, [FULL_EVENT], "invalid-key") == [q.NO_ORDERING_KEY]


def test_valid_and_quarantined_are_the_input(spark):
    sources = [FULL_EVENT, LOOP_EVENT, "x", {**FULL_EVENT, "_id": "1"}, event("9")]
    rows = labelled(spark, sources)
    rejected = q.rejected(rows).collect()
    assert q.valid(rows).count() == 3
    assert {r["raw"] for r in rejected} == {"x", json.dumps({**FULL_EVENT, "_id": "1"})}
    assert rows.where("reason is null and raw is not null").count() == 0


def test_strict_mode_fails_even_when_columns_are_pruned(spark):
    good = q.require_valid(labelled(spark, [FULL_EVENT]))
    assert good.select("token").collect()[0][0] == "82AB01"
    bad = q.require_valid(labelled(spark, [FULL_EVENT, "x"]))
    with pytest.raises(PySparkException, match=q.NOT_JSON):
        bad.select(F.lit(1)).collect()
    with pytest.raises(PySparkException, match=q.NOT_JSON):
        bad.groupBy().count().collect()
