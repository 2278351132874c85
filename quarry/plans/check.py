"""Side-by-side check of a catalog query against its DuckDB oracle.

Compares row count, column names (as sets) and an order-insensitive digest
of the rows, the same three things the driver's correctness gate records.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os

from quarry.sources.tables import TABLES


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, int):
        return repr(int(v))
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def duck_connection(root: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(root, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def run_oracle(con, sql: str):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def compare(spark, key: str, root: str, con=None) -> dict:
    from quarry.plans.catalog import CATALOG
    from quarry.plans.oracles import SQL
    con = con or duck_connection(root)
    df = CATALOG[key](spark, root)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    o_cols, o_rows = run_oracle(con, SQL[key])
    res = {
        "key": key,
        "spark_rows": len(s_rows),
        "oracle_rows": len(o_rows),
        "columns_match": sorted(s_cols) == sorted(o_cols),
        "hash_match": digest(s_cols, s_rows) == digest(o_cols, o_rows),
    }
    res["ok"] = res["columns_match"] and res["hash_match"] and len(s_rows) == len(o_rows)
    if not res["ok"]:
        res["spark_cols"], res["oracle_cols"] = s_cols, o_cols
        res["spark_sample"] = sorted(map(str, s_rows))[:3]
        res["oracle_sample"] = sorted(map(str, o_rows))[:3]
    return res
