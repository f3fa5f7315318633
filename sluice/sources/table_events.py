"""Change-event lines derived from stored tables.

Every row of a table becomes the change event a document store would have emitted
for it, as one JSON line. This is how the test tables become a change log.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Event type of the table -> operation of the change event.
OPERATION_OF_EVENT_TYPE = {
    "signup": "insert",
    "purchase": "replace",
    "error": "delete",
    "click": "update",
    "view": "update",
}
COLLECTIONS = 4
# Texts carry no time of their own: one second per document from this moment on.
TEXT_EPOCH_SECONDS = 1704067200
# Rows of a table that one task makes into lines, at most.
TASK_ROWS = 100_000


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A stored table, dealt anew over tasks where its splits hold too few or too many rows.

    A split of a file gets the row groups that begin in it: often none, or millions of short rows, whose lines one task would
    then build and parse. Rows are counted from the footers of the files. A table with enough even splits is left as it is.
    """
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    cores = spark.sparkContext.defaultParallelism
    splits = rows.groupBy(F.spark_partition_id().alias("split")).agg(F.count(F.lit(1)).alias("rows"))
    found = splits.agg(F.count(F.lit(1)).alias("splits"), F.max("rows").alias("most"), F.sum("rows").alias("all")).first()
    if found["splits"] >= cores and found["most"] <= TASK_ROWS:
        return rows
    return rows.repartition(max(cores, -(-(found["all"] or 0) // TASK_ROWS)))


def _line(
    operation: str,
    seconds: str,
    ordinal: str,
    coll: str,
    key: str,
    document: str,
    update: str = "CAST(NULL AS STRING)",
) -> Column:
    """The event line, from SQL expressions of its parts.

    ``to_json`` leaves NULL fields out, which is how absent fields look on the wire.
    """
    return F.expr(f"""
        to_json(named_struct(
            '_id', named_struct('_data', concat(
                '82', lpad(hex({seconds}), 8, '0'), lpad(hex({ordinal}), 8, '0'))),
            'operationType', {operation},
            'clusterTime', named_struct('T', {seconds}, 'I', {ordinal}),
            'fullDocument', {document},
            'ns', named_struct('db', 'app', 'coll', {coll}),
            'documentKey', {key},
            'updateDescription', {update}))
    """).alias("value")


def _between(rows: DataFrame, since: str | None, before: str | None) -> DataFrame:
    if since is not None:
        rows = rows.where(f"ts >= TIMESTAMP_NTZ '{since}'")
    if before is not None:
        # A row without a time belongs to the first part.
        undated = " OR ts IS NULL" if since is None else ""
        rows = rows.where(f"ts < TIMESTAMP_NTZ '{before}'{undated}")
    return rows


def _operation() -> str:
    cases = " ".join(
        f"WHEN '{event_type}' THEN '{operation}'"
        for event_type, operation in OPERATION_OF_EVENT_TYPE.items()
    )
    return f"CASE event_type {cases} END"


def event_lines(
    spark: SparkSession, sf_dir: str, since: str | None = None, before: str | None = None
) -> DataFrame:
    """The ``events`` table as changes of the collections ``users_0`` … ``users_3``.

    ``since`` and ``before`` (timestamp texts) select a part of the log; they reach
    the scan of the table.
    """
    rows = _between(read_table(spark, sf_dir, "events"), since, before)
    operation = _operation()
    value = "CAST(value AS DECIMAL(18,2))"
    document = (
        f"named_struct('_id', user_id, 'event_type', event_type, 'value', {value}, "
        "'props', parse_json(props))"
    )
    update = (
        f"named_struct('updatedFields', named_struct('value', {value}), "
        "'removedFields', CAST(array() AS ARRAY<STRING>))"
    )
    return rows.select(
        _line(
            operation,
            "unix_seconds(CAST(ts AS TIMESTAMP))",
            "event_id",
            f"concat('users_', user_id % {COLLECTIONS})",
            "named_struct('_id', user_id)",
            f"CASE WHEN {operation} <> 'delete' THEN {document} END",
            f"CASE WHEN {operation} = 'update' THEN {update} END",
        )
    )


def patch_lines(
    spark: SparkSession, sf_dir: str, since: str | None = None, before: str | None = None
) -> DataFrame:
    """The ``events`` table as a log whose updates carry no document, only what they changed.

    Clicks set a field and a place inside another one; views set and remove places and cut an array.
    """
    rows = _between(read_table(spark, sf_dir, "events"), since, before)
    operation = _operation()
    value = "CAST(value AS DECIMAL(18,2))"
    document = (
        f"named_struct('_id', user_id, 'event_type', event_type, 'value', {value}, "
        "'props', parse_json(props), 'recent', array(event_id, event_id + 1, event_id + 2))"
    )
    clicked = f"map('value', CAST({value} AS VARIANT), 'props.last', CAST(event_id AS VARIANT))"
    viewed = "map('props.seen', CAST(event_id AS VARIANT))"
    none = "CAST(array() AS ARRAY<STRING>)"
    cuts = "array(named_struct('field', 'recent', 'newSize', 1))"
    no_cuts = "CAST(array() AS ARRAY<STRUCT<field: STRING, newSize: INT>>)"
    click = f"named_struct('updatedFields', {clicked}, 'removedFields', {none}, 'truncatedArrays', {no_cuts})"
    view = f"named_struct('updatedFields', {viewed}, 'removedFields', array('props.last'), 'truncatedArrays', {cuts})"
    return rows.select(
        _line(
            operation,
            "unix_seconds(CAST(ts AS TIMESTAMP))",
            "event_id",
            f"concat('users_', user_id % {COLLECTIONS})",
            "named_struct('_id', user_id)",
            f"CASE WHEN {operation} IN ('insert', 'replace') THEN {document} END",
            f"CASE event_type WHEN 'click' THEN {click} WHEN 'view' THEN {view} END",
        )
    )


def _inserts(
    rows: DataFrame, coll: str, second: str, ordinal: str, key: dict, fields: list
) -> DataFrame:
    keys = ", ".join(f"'{name}', {source}" for name, source in key.items())
    values = ", ".join(f"'{name}', {name}" for name in fields)
    return rows.select(
        _line(
            "'insert'",
            f"({TEXT_EPOCH_SECONDS}L + {second})",
            ordinal,
            f"'{coll}'",
            f"named_struct({keys})",
            f"named_struct({keys}, {values})",
        )
    )


def conversation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` as inserts with free text."""
    return _inserts(
        read_table(spark, sf_dir, "conversations"),
        "conversations",
        "conv_id",
        "turn",
        {"_id": "conv_id", "turn": "turn"},
        ["role", "text"],
    )


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as inserts with long texts."""
    return _inserts(
        read_table(spark, sf_dir, "documents"),
        "documents",
        "doc_id",
        "0L",
        {"_id": "doc_id"},
        ["text", "lang", "source", "n_chars"],
    )


def page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` as inserts with markup."""
    return _inserts(
        read_table(spark, sf_dir, "pages"),
        "pages",
        "page_id",
        "0L",
        {"_id": "page_id"},
        ["url", "html"],
    )
