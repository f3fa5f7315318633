"""Split events into those that can be relayed and those that cannot.

The reason is data: a valid row has none, an invalid row has exactly one, and
valid plus quarantined rows are always the input.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.schema import PAYLOAD_FIELDS
from sluice.sources.change_log import encoded_columns

NOT_JSON = "not one JSON object"
NO_TOKEN = "_id holds no _data string"
NO_OPERATION = "no operationType"
NO_CLUSTER_TIME = "no clusterTime"
NO_NAMESPACE = "no ns.db and ns.coll"
OUT_OF_RANGE = "number out of range"
NOT_AN_OBJECT = "payload is not an object"
NO_ORDERING_KEY = "ordering key is absent"


_TOO_LARGE = r"""exists(
  regexp_extract_all(regexp_replace(regexp_replace(raw, r'\\.', ''), '"[^"]*"', ''), '-?[0-9][0-9.eE+-]*', 0),
  n -> abs(try_cast(n AS double)) = double('Infinity'))"""


def _any_payload(test: str) -> str:
    return " OR ".join(f"({test.format(p=name)})" for name in PAYLOAD_FIELDS)


def _first_match(rules: list[tuple[str, str]]) -> Column:
    cases = " ".join(f"WHEN {test} THEN '{reason}'" for test, reason in rules)
    return F.expr(f"CASE {cases} END")


def header_reason(ordering_by: str | None = None) -> Column:
    """Why the header of a decoded row cannot be relayed, or NULL."""
    rules = [
        ("NOT parsed", NOT_JSON),
        ("token IS NULL", NO_TOKEN),
        ("operationType IS NULL", NO_OPERATION),
        ("T IS NULL OR I IS NULL", NO_CLUSTER_TIME),
        ("db IS NULL OR coll IS NULL", NO_NAMESPACE),
    ]
    if ordering_by:
        rules.append(("ordering_key IS NULL", NO_ORDERING_KEY))
    return _first_match(rules)


def payload_reason(objects_only: bool | Column = False) -> Column:
    """Why the payloads cannot be written as JSON, or NULL.

    ``objects_only`` adds the rule of the file destination, whose document has typed
    payload fields: each must be an object or null.
    """
    # A number too large for a double parses as infinity and would be written as text. A text
    # may say the same, so the numbers of the line are judged where its strings are left out.
    infinite = _any_payload("contains({p}, 'Infinity\"')")
    rules = [(f"({infinite}) AND {_TOO_LARGE}", OUT_OF_RANGE)]
    if objects_only is not False:
        no_object = _any_payload("NOT startswith({p}, '{{') AND {p} <> 'null'")
        whole = _first_match([*rules, (no_object, NOT_AN_OBJECT)])
        return whole if objects_only is True else F.when(objects_only, whole).otherwise(_first_match(rules))
    return _first_match(rules)


def label(
    decoded: DataFrame,
    ordering_by: str | None = None,
    payloads: bool = False,
    objects_only: bool | Column = False,
) -> DataFrame:
    """Add ``reason``; the raw line is kept only where it is needed, on invalid rows.

    ``payloads`` also checks the payload texts. Only jobs that write payloads ask for
    it, because it makes every payload column part of the filter.
    """
    found = header_reason(ordering_by)
    if payloads:
        found = F.coalesce(found, payload_reason(objects_only))
    return decoded.select(
        *encoded_columns(decoded),
        found.alias("reason"),
        F.when(found.isNotNull(), F.col("raw")).alias("raw"),
    )


def valid(labelled: DataFrame) -> DataFrame:
    return labelled.where(F.col("reason").isNull()).select(*encoded_columns(labelled))


def rejected(labelled: DataFrame) -> DataFrame:
    return labelled.where(F.col("reason").isNotNull()).select("raw", "reason")


def require_valid(labelled: DataFrame) -> DataFrame:
    """Strict form: the job fails on the first invalid row.

    The check sits in a filter, so column pruning cannot remove it.
    """
    message = F.concat(F.lit("invalid change event: "), F.col("reason"))
    passed = F.when(F.col("reason").isNull(), F.lit(True)).otherwise(
        F.raise_error(message).cast("boolean")
    )
    return labelled.where(passed).select(*encoded_columns(labelled))
