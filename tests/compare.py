"""Run a registered query in Spark and its SQL in DuckDB, and compare rows and types."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _rows(table) -> tuple[list[str], list[tuple]]:
    names = sorted(table.column_names)
    columns = [[_plain(v) for v in table.column(n).to_pylist()] for n in names]
    return names, sorted(zip(*columns), key=repr)


def _kind(arrow_type) -> str:
    return str(arrow_type).replace("large_", "").replace("string_view", "string").split("[")[0]


def differences(spark_df, sql: str, con) -> list[str]:
    """Empty when both sides agree exactly."""
    left, right = spark_df.toArrow(), con.execute(sql).to_arrow_table()
    found = []
    if left.num_rows != right.num_rows:
        found.append(f"rows {left.num_rows} vs {right.num_rows}")
    lnames, lrows = _rows(left)
    rnames, rrows = _rows(right)
    if lnames != rnames:
        return [*found, f"columns {lnames} vs {rnames}"]
    for name in lnames:
        a, b = _kind(left.schema.field(name).type), _kind(right.schema.field(name).type)
        if a != b:
            found.append(f"type of {name}: {a} vs {b}")
    wrong = [(x, y) for x, y in zip(lrows, rrows) if x != y]
    if wrong:
        found.append(f"{len(wrong)} of {len(lrows)} rows differ, columns {lnames}, first {wrong[0]}")
    if not lrows:
        found.append("no rows")
    return found
