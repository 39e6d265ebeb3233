"""Comparing a Spark result with DuckDB's result of the counterpart SQL."""

import os

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def sorted_rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [tuple(_plain(v) for v in row) for row in frame.itertuples(index=False, name=None)]
    return sorted(rows, key=repr)


def _plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    return value.item() if hasattr(value, "item") else value


# DuckDB type names and the Spark ones they stand for.
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
    "DATE": "date",
}


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between the two results, or None."""
    relation = con.sql(sql)
    expected_types = {c: TYPES.get(str(t), str(t)) for c, t in zip(relation.columns, relation.types)}
    actual_types = dict(spark_df.dtypes)
    if expected_types != actual_types:
        return f"schema: expected {expected_types}, got {actual_types}"
    expected = sorted_rows(relation.df().astype(object).where(lambda f: f.notna(), None))
    actual = sorted_rows(spark_df.toPandas().astype(object).where(lambda f: f.notna(), None))
    if len(expected) != len(actual):
        return f"rows: expected {len(expected)}, got {len(actual)}"
    for e, a in zip(expected, actual):
        if e != a:
            return f"first differing row: expected {e}, got {a}"
    return None
