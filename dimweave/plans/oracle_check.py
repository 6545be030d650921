"""Side-by-side check of a registered Spark query against its DuckDB oracle.

Mirrors the driver's gate: same row count, same column names, and equal
values once columns are sorted by name and rows are compared as a multiset.
Floating values are compared after rounding to 9 significant digits.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations"]


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in BASE_TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if v == 0:
            return 0.0
        if os.environ.get("ORACLE_EXACT"):
            return v
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return _norm(float(v))
    if isinstance(v, int):
        return v
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, dict):
        return tuple((k, _norm(x)) for k, x in sorted(v.items()))
    if isinstance(v, (list, tuple)):
        # a list of (key, value) pairs from a map stays a list
        return tuple(_norm(x) for x in v)
    return v


def _type_name(t) -> str:
    import pyarrow as pa

    if pa.types.is_large_string(t) or pa.types.is_string(t):
        return "string"
    if pa.types.is_timestamp(t):
        return "timestamp" + ("_tz" if t.tz else "")
    if pa.types.is_list(t) or pa.types.is_large_list(t):
        return f"list<{_type_name(t.value_type)}>"
    if pa.types.is_struct(t):
        return "struct<" + ",".join(sorted(f"{f.name}:{_type_name(f.type)}" for f in t)) + ">"
    if pa.types.is_map(t):
        return f"map<{_type_name(t.key_type)},{_type_name(t.item_type)}>"
    return str(t)


def schema_types(table) -> dict[str, str]:
    return {f.name: _type_name(f.type) for f in table.schema}


def _rows(table) -> tuple[list[str], list[tuple]]:
    names = sorted(table.column_names)
    cols = [table.column(n).to_pylist() for n in names]
    rows = [tuple(_norm(c[i]) for c in cols) for i in range(table.num_rows)]
    rows.sort(key=repr)
    return names, rows


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> dict:
    sdf = fn(spark, sf_dir)
    st = sdf.toArrow()
    dt_ = con.sql(sql).to_arrow_table()
    if hasattr(dt_, "read_all"):
        dt_ = dt_.read_all()
    sn, sr = _rows(st)
    dn, dr = _rows(dt_)
    out = {"name": name, "spark_rows": len(sr), "oracle_rows": len(dr),
           "columns_match": sn == dn, "values_match": sr == dr}
    st_types, dt_types = schema_types(st), schema_types(dt_)
    type_diff = {k: (st_types[k], dt_types.get(k)) for k in st_types if st_types[k] != dt_types.get(k)}
    out["types_match"] = not type_diff
    if type_diff:
        out["type_diff"] = type_diff
    if sn != dn:
        out["spark_cols"] = sn
        out["oracle_cols"] = dn
    elif sr != dr:
        ss, ds = set(sr), set(dr)
        out["only_spark"] = [r for r in sr if r not in ds][:3]
        out["only_oracle"] = [r for r in dr if r not in ss][:3]
    out["ok"] = out["columns_match"] and out["values_match"]
    return out
