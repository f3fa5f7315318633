"""Documents folded from changes: whole documents, updates that only describe what they changed, and deletes.

A change is a set of places in a document that it writes: a whole document writes the root, a delete removes it, an
update sets or removes dotted paths and cuts arrays. Of the writes to one place only the newest counts, so a group of
changes is one row per place, with the position of its newest write. Composing two groups keeps the newer row of each
place, which is associative, commutative and idempotent: parts of a log may be folded in tasks, in batches, in any order
and more than once. What is older than the newest write to the root is left out.
"""

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions import cluster_time

KEY = ("db", "coll", "documentKey")
ROOT = "[]"
SET, REMOVE, CUT = "set", "remove", "cut"
WRITES = "db string, coll string, documentKey string, path string, cut boolean, sequence bigint, token string, action string, value string"

# The fields of an update description.
DESCRIPTION = """updatedFields map<string,variant>, removedFields array<string>,
  truncatedArrays array<struct<field:string,newSize:bigint>>, disambiguatedPaths map<string,array<string>>"""

# A path is the JSON list of its steps. Steps that contain dots are spelled out by the event.
_PATH = r"to_json(coalesce(try_element_at(described.disambiguatedPaths, {name}), split({name}, '\\.')))"

_WRITES = f"""CASE
  WHEN coalesce(documentKey, 'null') = 'null' THEN NULL
  WHEN operationType = 'delete' THEN array(struct('{ROOT}' AS path, false AS cut, '{REMOVE}' AS action, CAST(NULL AS STRING) AS value))
  WHEN operationType IN ('insert', 'replace', 'update') AND fullDocument <> 'null'
    THEN array(struct('{ROOT}' AS path, false AS cut, '{SET}' AS action, fullDocument AS value))
  WHEN operationType = 'update' THEN concat(
    transform(coalesce(map_entries(described.updatedFields), array()),
      e -> struct({_PATH.format(name="e.key")} AS path, false AS cut, '{SET}' AS action, coalesce(to_json(e.value), 'null') AS value)),
    transform(coalesce(described.removedFields, array()),
      n -> struct({_PATH.format(name="n")} AS path, false AS cut, '{REMOVE}' AS action, CAST(NULL AS STRING) AS value)),
    transform(coalesce(described.truncatedArrays, array()),
      t -> struct({_PATH.format(name="t.field")} AS path, true AS cut, '{CUT}' AS action, CAST(t.newSize AS STRING) AS value)))
  END"""


def writes(events: DataFrame) -> DataFrame:
    """One row for each place that an event writes. Events without a document key change no document.

    They have no rows to inline: a filter on the key would be moved below the decoding with a second parse of every line in it.
    """
    order = cluster_time.sequence(F.col("T"), F.col("I"))
    described = F.when(
        (F.col("operationType") == "update") & (F.col("fullDocument") == "null"), F.from_json("updateDescription", DESCRIPTION)
    )
    rows = events.select(
        *KEY, order.alias("sequence"), "token", "operationType", "fullDocument", described.alias("described")
    )
    rows = rows.select(*KEY, "sequence", "token", F.expr(f"inline({_WRITES})"))
    return rows.select(*KEY, "path", "cut", "sequence", "token", "action", "value")


def composed(*groups: DataFrame) -> DataFrame:
    """The newest write to each place, and nothing older than the newest write to the root.

    Writes to one place collapse in the partial aggregate of each task, so a document with very many updates reaches the
    shuffle as one row per place and task. Events of one position go by their token.
    """
    rows = groups[0]
    for more in groups[1:]:
        rows = rows.unionByName(more)
    newest = rows.groupBy(*KEY, "path", "cut").agg(F.max(F.struct("sequence", "token", "action", "value")).alias("last"))
    order = F.struct("last.sequence", "last.token")
    base = F.max(F.when(F.col("path") == ROOT, order)).over(Window.partitionBy(*KEY)).alias("base")
    live = newest.select("*", base).where(F.col("base").isNull() | (order >= F.col("base")))
    return live.select(*KEY, "path", "cut", "last.*")


class _Number:
    """A number as it is spelled."""

    def __init__(self, text: str):
        self.text = text


def _spelled(value) -> str:
    if isinstance(value, _Number):
        return value.text
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(name)}:{_spelled(inner)}" for name, inner in value.items()) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(_spelled, value)) + "]"
    return json.dumps(value)


def _parsed(text: str):
    return json.loads(text, parse_float=_Number)


def _slot(place, step: str, make: bool):
    """The key or index that a step names in an object or array, or None where there is no such place."""
    if isinstance(place, dict):
        return step if make or step in place else None
    if isinstance(place, list) and step.isdecimal():
        at = int(step)
        if make:
            place.extend([None] * (at + 1 - len(place)))
        return at if at < len(place) else None
    return None


def _write(document, steps: list[str], action: str, value: str | None) -> None:
    place = document
    for step in steps[:-1]:
        slot = _slot(place, step, action == SET)
        if slot is None:
            return
        inner = place.get(slot) if isinstance(place, dict) else place[slot]
        if action == SET and not isinstance(inner, (dict, list)):
            inner = place[slot] = {}
        place = inner
    slot = _slot(place, steps[-1], action == SET)
    if slot is None:
        return
    if action == SET:
        place[slot] = _parsed(value)
    elif action == CUT:
        if isinstance(place[slot], list):
            del place[slot][int(value) :]
    elif isinstance(place, dict):
        del place[slot]
    else:
        place[slot] = None


def folded(changes: list[tuple[str, str, str | None]]) -> str | None:
    """The document after (path, action, value) in their order, or None where none is known."""
    (path, action, value), *later = changes
    if path != ROOT or action != SET:
        return None
    if not later:
        return value
    document = _parsed(value)
    for path, action, value in later:
        _write(document, json.loads(path), action, value)
    return _spelled(document)


_DOCUMENT = "db string, coll string, documentKey string, fullDocument string"


def documents(state: DataFrame) -> DataFrame:
    """(db, coll, documentKey, fullDocument) of the documents that exist after the writes of ``composed``.

    A key of which no whole document is known has none. The writes of a key are as many as its document has
    places. Arrays are cut before an event of the same position sets in them.
    """
    change = F.struct("sequence", "token", (~F.col("cut")).alias("late"), "path", "action", "value")
    keyed = state.groupBy(*KEY).agg(F.array_sort(F.collect_list(change)).alias("changes"))
    # A delete, or a path without a whole document below it, leaves nothing; the root comes first of all.
    known = keyed.where((F.col("changes")[0]["path"] == ROOT) & (F.col("changes")[0]["action"] == SET))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [folded([(c["path"], c["action"], c["value"]) for c in row]) for row in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.string())], names=[*KEY, "fullDocument"])

    whole = known.mapInArrow(work, _DOCUMENT)
    return whole.withColumn("fullDocument", F.to_json(F.parse_json("fullDocument")))
