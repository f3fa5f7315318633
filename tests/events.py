"""Change events for tests, as the JSON lines a collector writes."""

import json

FULL_EVENT = {
    "_id": {"_data": "82AB01"},
    "operationType": "insert",
    "clusterTime": {"T": 0, "I": 0},
    "fullDocument": {"order": "two brass lamps"},
    "ns": {"place": "corner shop", "db": "shop", "coll": "orders"},
    "documentKey": {"number": "A-17"},
    "updateDescription": {"changed": "one lamp sold"},
}
LOOP_EVENT = {
    "ns": {"db": "shop", "coll": "orders"},
    "operationType": "insert",
    "clusterTime": {"T": 1638284400, "I": 1},
    "_id": {"_data": "82AB01"},
}


def event(token, seconds=0, ordinal=0, op="insert", coll="c", key=1, document="same", **more):
    fields = {
        "_id": {"_data": token},
        "operationType": op,
        "clusterTime": {"T": seconds, "I": ordinal},
        "ns": {"db": "app", "coll": coll},
        "documentKey": {"_id": key},
        "fullDocument": {"_id": key, "v": document},
    }
    fields.update(more)
    return fields


def lines(spark, events):
    """Dicts become JSON text; strings are taken as they are."""
    rows = [
        (e if isinstance(e, str) else json.dumps(e, ensure_ascii=False),) for e in events
    ]
    return spark.createDataFrame(rows, "value string")


def decoded(spark, events, ordering_by=None):
    from sluice.sources import change_log

    return change_log.decode(change_log.parse(lines(spark, events)), ordering_by)


def labelled(spark, events, ordering_by=None, **rules):
    from sluice.operators import quarantine

    return quarantine.label(decoded(spark, events, ordering_by), ordering_by, **rules)


def encoded(spark, events, ordering_by=None):
    from sluice.operators import quarantine

    return quarantine.valid(labelled(spark, events, ordering_by))
