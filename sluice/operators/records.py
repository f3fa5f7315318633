"""Delimited records read back to their fields."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.shapes import SEPARATOR
from sluice.schema import PAYLOAD_FIELDS

NOT_A_RECORD = "not a record of seven fields"
FIELDS = ("_id", "operationType", "clusterTime", *PAYLOAD_FIELDS[1:])

# Outside JSON strings a pipe never occurs, so a field is plain text without quotes and
# pipes, mixed with whole JSON strings. Each field begins where the one before has
# ended, and possessive parts keep the match linear in the record.
FIELD = r'(?s)\G([^"|]*+(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"[^"|]*+)*+)(?:\||\z)'


def parse_delimited(records: DataFrame, value: str = "value") -> DataFrame:
    """The seven fields of each delimited record, with ``reason`` and ``raw`` as in the quarantine.

    A trailing newline, as keyed records have it, belongs to no field. A text that is not exactly seven fields,
    or is null, has null fields, a reason and, unless null, its raw text; every input row is returned.
    Times stay text, as the record does not say their zone. One pass over the text; no shuffle.
    """
    whole = F.rtrim(F.col(value), F.lit("\n"))
    # One element, so the fields are found once and not again for every column.
    found = F.struct(
        F.col(value).alias("raw"),
        whole.alias("whole"),
        F.regexp_extract_all(whole, F.lit(FIELD), F.lit(1)).alias("parts"),
    )
    rows = records.select(F.inline(F.array(found)))
    # After the last field one empty match is left at the end; a failed match leaves text out.
    count = len(FIELDS)
    rejoined = F.array_join(F.slice("parts", 1, count), SEPARATOR)
    good = F.coalesce((F.size("parts") == count + 1) & (rejoined == F.col("whole")), F.lit(False))
    return rows.select(
        *[F.when(good, F.get("parts", F.lit(i))).alias(name) for i, name in enumerate(FIELDS)],
        F.when(~good, F.lit(NOT_A_RECORD)).alias("reason"),
        F.when(~good, F.col("raw")).alias("raw"),
    )
