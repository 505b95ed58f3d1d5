"""Row-by-row comparison of a Spark result with a DuckDB result."""

import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(folder: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _key(row):
    return tuple((value is None, str(type(value)), value if value is not None else 0) for value in row)


def _clean(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else round(value, 9) + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_clean(row[i]) for i in order) for row in rows), key=_key)


def differences(spark_frame, connection, sql: str) -> list[str]:
    """Empty when both results hold the same rows, in any order."""
    s_names, s_rows = rows_of(spark_frame.columns, [tuple(r) for r in spark_frame.collect()])
    result = connection.execute(sql)
    d_names, d_rows = rows_of([c[0] for c in result.description], result.fetchall())
    if s_names != d_names:
        return [f"columns {s_names} != {d_names}"]
    if len(s_rows) != len(d_rows):
        return [f"{len(s_rows)} rows != {len(d_rows)} rows"]
    return [f"{a} != {b}" for a, b in zip(s_rows, d_rows) if a != b]
