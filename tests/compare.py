"""Compare a Spark query with its SQL on the same tables."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    """A DuckDB connection with a view per table."""
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    """A value both engines give the same way."""
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if hasattr(value, "tolist"):
        return plain(value.tolist())
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def result_rows(columns, rows):
    """Rows with columns in name order, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def differences(query, spark, folder, con) -> list[str]:
    """What differs between the two results; empty if nothing does."""
    df = query.run(spark, folder)
    got = result_rows(df.columns, [tuple(r) for r in df.collect()])
    answer = con.execute(query.sql)
    names = [d[0] for d in answer.description]
    want = result_rows(names, answer.fetchall())
    found = []
    if sorted(df.columns) != sorted(names):
        found.append(f"columns {sorted(df.columns)} != {sorted(names)}")
    kinds = {d[0]: str(d[1]) for d in answer.description}
    for field in df.schema:
        if field.name in kinds and not same_kind(field.dataType.simpleString(), kinds[field.name]):
            found.append(f"{field.name}: {field.dataType.simpleString()} != {kinds[field.name]}")
    if len(got) != len(want):
        found.append(f"{len(got)} rows != {len(want)}")
    if repr(got) != repr(want):  # tells 0.0 from -0.0
        seen, expected = {repr(r) for r in got}, {repr(r) for r in want}
        extra = [r for r in got if repr(r) not in expected][:3]
        missing = [r for r in want if repr(r) not in seen][:3]
        found.append(f"extra {extra}, missing {missing}")
    return found


def same_kind(spark_type: str, duck_type: str) -> bool:
    """Whether two type names stand for the same type."""
    names = {"double": "DOUBLE", "float": "FLOAT", "bigint": "BIGINT", "int": "INTEGER",
             "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
             "timestamp_ntz": "TIMESTAMP"}
    if spark_type.startswith("array<"):
        return duck_type.endswith("[]") and same_kind(spark_type[6:-1], duck_type[:-2])
    return names.get(spark_type) == duck_type
