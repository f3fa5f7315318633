"""Typed access to a change event held in a variant.

``is_single``, ``fields`` and ``field`` read the column ``line``, a variant array that begins with the event, as the source
parses it. The others read the column ``event``, the struct that ``fields`` takes out of it, or what ``header`` makes of
that: to follow a path through the whole line costs as much as a good part of its parse, so each field is looked up once.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.cluster_time import MAX_ORDINAL, MAX_SECONDS
from sluice.schema import EVENT_FIELDS


def is_single() -> Column:
    """Whether the line holds exactly one JSON value."""
    return F.expr(
        "line IS NOT NULL AND coalesce(try_variant_get(line, '$[1]', 'bigint') = xxhash64(raw), false)"
        " AND try_variant_get(line, '$[2]', 'variant') IS NULL"
    )


def field(name: str) -> Column:
    """A top-level field as a variant: NULL when absent, variant null when JSON null."""
    if "'" in name:
        raise ValueError(f"a quote is not allowed in a field name: {name!r}")
    return F.try_variant_get("line", f"$[0]['{name}']", "variant")


def fields() -> Column:
    """The seven fields of the event as a struct of variants: NULL when absent, variant null when JSON null."""
    names = ", ".join(f"{name}: variant" for name in EVENT_FIELDS)
    return F.expr(f"try_variant_get(line, '$[0]', 'struct<{names}>')")


# What the header is made of, and the JSON type each must have.
_HEADER = {
    "token": ("_id", "$._data", "STRING", "string"),
    "operationType": ("operationType", "$", "STRING", "string"),
    "T": ("clusterTime", "$.T", "BIGINT", "bigint"),
    "I": ("clusterTime", "$.I", "BIGINT", "bigint"),
    "db": ("ns", "$.db", "STRING", "string"),
    "coll": ("ns", "$.coll", "STRING", "string"),
}
HEADER_FIELDS = tuple(_HEADER)
_LARGEST = {"T": MAX_SECONDS, "I": MAX_ORDINAL}


def found(name: str) -> Column:
    """A header field as a variant, from the column ``event``."""
    field, path, _, _ = _HEADER[name]
    return F.try_variant_get(F.col("event")[field], path, "variant") if path != "$" else F.col("event")[field]


def typed(name: str) -> Column:
    """A header field from the column of its name that holds its variant; NULL when it is absent or of another type."""
    # No cast between types: a number in a place that must hold a string is NULL.
    _, _, json_type, spark_type = _HEADER[name]
    return F.expr(f"CASE WHEN schema_of_variant({name}) = '{json_type}' THEN try_variant_get({name}, '$', '{spark_type}') END")


def in_range(name: str) -> Column:
    """A typed header field, NULL where it is a number that cannot be part of a cluster time."""
    value = F.col(name)
    return F.when(value.between(0, _LARGEST[name]), value) if name in _LARGEST else value


def ordering_key(name: str) -> Column:
    """Text of one top-level field: strings plain, everything else as JSON text.

    NULL only when the field is absent.
    """
    found = field(name)
    return F.coalesce(F.try_variant_get(found, "$", "string"), F.to_json(found))
