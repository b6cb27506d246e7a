"""Compare a query's rows with its SQL, run by DuckDB on the same files."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    db = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def _plain(value):
    if isinstance(value, float):
        return (1, "nan") if math.isnan(value) else (1, repr(value + 0.0))
    return (0, "") if value is None else (2, str(value))


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


#: Spark type -> the name DuckDB gives the same type.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "float": "FLOAT",
}


def compare(spark, sf_dir: str, run, sql: str) -> list[str]:
    """Return what differs: names, types, row counts or values."""
    df = run(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    db = connect(sf_dir)
    result = db.execute(sql)
    expected_names = [d[0] for d in result.description]
    expected_types = [str(d[1]) for d in result.description]
    expected = result.fetchall()
    problems = []
    if sorted(df.columns) != sorted(expected_names):
        return [f"columns {sorted(df.columns)} != {sorted(expected_names)}"]
    types = dict(zip(expected_names, expected_types))
    for field in df.schema.fields:
        have = TYPES.get(field.dataType.simpleString(), field.dataType.simpleString())
        if have != types[field.name]:
            problems.append(f"type of {field.name}: {have} != {types[field.name]}")
    if len(rows) != len(expected):
        problems.append(f"rows {len(rows)} != {len(expected)}")
    mine, theirs = normal(df.columns, rows), normal(expected_names, expected)
    if mine != theirs:
        diff = [(a, b) for a, b in zip(mine, theirs) if a != b][:3]
        problems.append(f"values differ: {diff}")
    if not rows:
        problems.append("no rows")
    return problems
