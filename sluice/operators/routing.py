"""Destination lists and per-collection routing."""

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from sluice.schema import DESTINATIONS, TOPIC, WAREHOUSE


class Route(NamedTuple):
    db: str
    coll: str
    destination: str
    target: str


def parse_destinations(listed: str, project: str | None = None) -> list[str]:
    """``"bigquery, file"`` -> names in order, each once; unknown names are errors.

    The two hosted destinations need a project.
    """
    names = list(dict.fromkeys(part.strip() for part in listed.split(",")))
    for name in names:
        if name not in DESTINATIONS:
            raise ValueError(f"no such destination: {name!r}, only {sorted(DESTINATIONS)}")
    if project is None and {WAREHOUSE, TOPIC} & set(names):
        raise ValueError(f"{WAREHOUSE} and {TOPIC} need a project")
    return names


def check_routes(routes: Iterable[Route]) -> list[Route]:
    checked = [Route(*r) for r in routes]
    for r in checked:
        if r.destination not in DESTINATIONS:
            raise ValueError(f"no such destination: {r.destination!r}, only {sorted(DESTINATIONS)}")
    if len(set(checked)) != len(checked):
        raise ValueError("a route is listed twice")
    return checked


def route(spark: SparkSession, events: DataFrame, routes: Iterable[Route]) -> DataFrame:
    """Add ``destination`` and ``target``: one row per event and matching route.

    Collections without a route are not relayed, as a collection without a
    deployment is not watched.
    """
    checked = check_routes(routes)
    table = spark.createDataFrame(
        checked, "db string, coll string, destination string, target string"
    )
    # Its size is known to Spark, which chooses the join.
    return events.join(table, ["db", "coll"])
