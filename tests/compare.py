"""Run a registered query in Spark and its oracle in DuckDB, compare as
multisets (order-insensitive), the way the correctness gate does."""

from __future__ import annotations

import math
import os

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duckdb_conn(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 6) if not math.isnan(v) else "nan"
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).decode("utf-8", "replace")
    return v


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, con, name, query, sql, sf_dir):
    df = query(spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    s_cols = df.columns
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    ok_cols = sorted(s_cols) == sorted(d_cols)
    ok_rows = len(s_rows) == len(d_rows)
    ok_vals = ok_cols and canon(s_cols, s_rows) == canon(d_cols, d_rows)
    return {"name": name, "cols": ok_cols, "rows": (len(s_rows), len(d_rows)), "values": ok_vals,
            "spark_cols": s_cols, "duck_cols": d_cols,
            "diff": None if ok_vals or not ok_cols else _first_diff(s_cols, s_rows, d_cols, d_rows)}


def _first_diff(sc, sr, dc, dr):
    a, b = canon(sc, sr), canon(dc, dr)
    sa, sb = set(a), set(b)
    return {"spark_only": sorted(sa - sb, key=str)[:3], "duck_only": sorted(sb - sa, key=str)[:3]}
