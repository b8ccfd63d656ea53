"""Run a query in Spark and its SQL in DuckDB and compare rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, normal(v)) for k, v in value.items()))
    return value


def rows(names: list[str], data) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in data), key=repr)


def compare(spark_df, con, statement: str) -> str | None:
    """None when equal, else what differs."""
    result = con.execute(statement)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = rows(names, result.fetchall())
    got_names = spark_df.columns
    if sorted(names) != sorted(got_names):
        return f"columns {sorted(got_names)} != {sorted(names)}"
    got = rows(got_names, [tuple(r) for r in spark_df.collect()])
    wide = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
            "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz"}
    for field in spark_df.schema:
        want = wide.get(types[field.name])
        if want and field.dataType.simpleString() != want:
            return f"type of {field.name}: {field.dataType.simpleString()} != {types[field.name]}"
        if not want and types[field.name] not in ("HUGEINT",) and "[]" not in types[field.name] and "STRUCT" not in types[field.name]:
            return f"unmapped type of {field.name}: {types[field.name]}"
        if types[field.name] == "HUGEINT":
            return f"type of {field.name}: HUGEINT"
    if got != expected:
        only_got = [r for r in got if r not in set(expected)][:3] if len(got) < 50000 else []
        only_exp = [r for r in expected if r not in set(got)][:3] if len(got) < 50000 else []
        return f"{len(got)} rows against {len(expected)}; spark only {only_got}; sql only {only_exp}"
    return None
