"""Side-by-side check of a Spark query against its DuckDB oracle.

Mirrors the driver's gate: row count, column names (sorted), and an
order-insensitive comparison of values (floats rounded to 6 places).
"""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal

from ..sources.tables import TABLE_NAMES


def duck_connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, Decimal):
        return round(float(v), 6)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (datetime, date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark_df, con, sql: str, show: int = 5) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    o_cols = [c[0] for c in res.description]
    o_rows = res.fetchall()
    out = {
        "rows_spark": len(s_rows),
        "rows_oracle": len(o_rows),
        "columns_match": sorted(s_cols) == sorted(o_cols),
    }
    if not out["columns_match"]:
        out["cols_only_spark"] = sorted(set(s_cols) - set(o_cols))
        out["cols_only_oracle"] = sorted(set(o_cols) - set(s_cols))
        out["match"] = False
        return out
    a, b = _rows(s_cols, s_rows), _rows(o_cols, o_rows)
    out["match"] = a == b
    if not out["match"]:
        sa, sb = set(a), set(b)
        out["only_spark"] = list(sa - sb)[:show]
        out["only_oracle"] = list(sb - sa)[:show]
        out["columns"] = sorted(s_cols)
    return out
