"""Runs a query and its SQL on the same tables and compares rows, columns and values."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = os.environ.get("SCREEN_SF", "/root/testdata/sf0.001")


def oracle(sql: str, sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    cur = con.execute(sql)
    return [c[0] for c in cur.description], cur.fetchall()


def plain(v):
    if v is None or isinstance(v, (str, bool)):
        return v
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    v = float(v)
    return None if math.isnan(v) else round(v, 6) + 0.0


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(frame, sql: str, sf_dir: str) -> list[str]:
    names, rows = rows_of(frame.columns, frame.collect())
    want_names, want = rows_of(*oracle(sql, sf_dir))
    if names != want_names:
        return [f"columns {names} in place of {want_names}"]
    if len(rows) != len(want):
        return [f"{len(rows)} rows in place of {len(want)}"]
    return [f"{a} in place of {b}" for a, b in zip(rows, want) if a != b][:5]
