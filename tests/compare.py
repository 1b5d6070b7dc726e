"""Compare a Spark result with DuckDB's on the same tables, as multisets of rows."""

from __future__ import annotations

import contextlib
import io
import os
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        if os.path.isfile(f"{folder}/{table}.parquet"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return value.normalize() + 0
    return value


# Spark's names of DuckDB's types; decimals are called the same.
TYPES = {
    "INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean",
    "DATE": "date", "TIMESTAMP": "timestamp_ntz",
}


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    spark_kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    relation = con.sql(sql)
    duck_kinds = {n: TYPES.get(str(t), str(t).lower().replace(", ", ",")) for n, t in zip(relation.columns, relation.types)}
    if spark_kinds != duck_kinds:
        odd = {n: (spark_kinds.get(n), duck_kinds.get(n)) for n in spark_kinds | duck_kinds if spark_kinds.get(n) != duck_kinds.get(n)}
        return f"schema: {odd}"
    names = sorted(spark_kinds)
    ours = Counter(tuple(_plain(row[n]) for n in names) for row in df.collect())
    place = {n: i for i, n in enumerate(relation.columns)}
    theirs = Counter(tuple(_plain(row[place[n]]) for n in names) for row in relation.fetchall())
    if ours != theirs:
        extra, missing = ours - theirs, theirs - ours
        return (
            f"{sum(ours.values())} rows against {sum(theirs.values())}; {sum(extra.values())} only here, "
            f"{sum(missing.values())} only there\n  {names}\n  here  {sorted(map(str, extra))[:2]}\n"
            f"  there {sorted(map(str, missing))[:2]}"
        )
    return None


def plan_of(df, mode: str = "simple") -> str:
    """The physical plan as ``explain`` prints it."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode=mode)
    return text.getvalue()
