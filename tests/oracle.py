"""Compare a Spark result with its SQL on DuckDB: names, row count, every value."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, bool) or v is None:
        return repr(v)
    if isinstance(v, (list, tuple)):
        return repr([_plain(x) for x in v])
    return f"{type(v).__name__}:{v}"


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    names, rows = _sorted(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    o_names, o_rows = _sorted([d[0] for d in result.description], result.fetchall())
    if names != o_names:
        return [f"columns {names} != {o_names}"]
    out = []
    if len(rows) != len(o_rows):
        out.append(f"rows {len(rows)} != {len(o_rows)}")
    for a, b in zip(rows, o_rows):
        if a != b:
            out.append(f"{names}\n   spark {a}\n   sql   {b}")
            if len(out) > 2:
                break
    return out
