"""Compare a Spark result with the check SQL's rows in DuckDB."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, bool) or v is None:
        return str(v)
    return repr(v)


def rows_of(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def kind(name: str) -> str:
    name = name.lower()
    if name in ("bigint", "int", "integer", "smallint", "hugeint", "tinyint"):
        return {"int": "int32", "integer": "int32", "bigint": "int64"}.get(name, name)
    return {"varchar": "string"}.get(name, name)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    rel = con.sql(sql)
    want_cols, want_types = rel.columns, [str(t) for t in rel.types]
    want = rel.fetchall()
    got = df.collect()
    if sorted(df.columns) != sorted(want_cols):
        return f"columns {sorted(df.columns)} != {sorted(want_cols)}"
    spark_types = {c: kind(t) for c, t in df.dtypes}
    duck_types = {c: kind(t) for c, t in zip(want_cols, want_types, strict=True)}
    types = {c: (spark_types[c], duck_types[c]) for c in spark_types if spark_types[c] != duck_types[c]}
    if types:
        return f"types {types}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    a, b = rows_of(got, df.columns), rows_of(want, want_cols)
    bad = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None
