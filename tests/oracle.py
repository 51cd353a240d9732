"""Runs a registered query and its SQL check on the same tables and compares them."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return db


def _value(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_value(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def difference(df, db, sql: str) -> str | None:
    """None when columns, types and all rows agree, else what differs."""
    relation = db.sql(sql)
    got_columns, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    want_columns, want = _rows(relation.columns, relation.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} and {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows and {len(want)}"
    bad = [(a, b) for a, b in zip(got, want) if repr(a) != repr(b)]
    if bad:
        return f"{len(bad)} rows differ, first {bad[0]}"
    kinds = {c: KINDS.get(k, k) for c, k in df.dtypes}
    other = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    wrong = {c: (kinds[c], other[c]) for c in kinds if kinds[c] != other[c]}
    return f"types {wrong}" if wrong else None
