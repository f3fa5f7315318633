"""Compare a registered query with its SQL twin on the same tables."""

import pathlib

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in pathlib.Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def _canonical(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    plain = frame[columns].astype(object).map(lambda v: None if pd.isna(v) else str(v))
    return sorted(map(tuple, plain.itertuples(index=False)), key=repr)


def differences(query, statement: str, spark, sf_dir: str) -> list[str]:
    """What differs, as short texts; empty when both results are the same rows."""
    mine = query(spark, sf_dir).toPandas()
    other = connect(sf_dir).execute(statement).df()
    if sorted(mine.columns) != sorted(other.columns):
        return [f"columns {sorted(mine.columns)} != {sorted(other.columns)}"]
    for name in mine.columns:
        if str(other[name].dtype).startswith("datetime"):
            mine[name] = pd.to_datetime(mine[name])
            other[name] = pd.to_datetime(other[name])
    left, right = _canonical(mine), _canonical(other)
    if left == right:
        return [] if left else ["no rows"]
    found = [f"{len(left)} rows != {len(right)} rows"]
    extra = sorted(set(left) - set(right))[:2]
    missing = sorted(set(right) - set(left))[:2]
    return found + [f"extra {row}"[:600] for row in extra] + [f"missing {row}"[:600] for row in missing]
