"""Run a registered Spark query and its DuckDB oracle on the same tables and
compare row count, column names and an order-insensitive value multiset."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral() else str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


_SPARK_TYPES = [("decimal", None), ("bigint", "int64"), ("int", "int32"), ("smallint", "int16"),
                ("double", "float64"), ("float", "float32"), ("string", "string"), ("date", "date"),
                ("timestamp", "timestamp"), ("boolean", "bool")]
_DUCK_TYPES = [("decimal", None), ("bigint", "int64"), ("hugeint", "int128"), ("integer", "int32"),
               ("smallint", "int16"), ("double", "float64"), ("float", "float32"), ("varchar", "string"),
               ("date", "date"), ("timestamp", "timestamp"), ("boolean", "bool")]


def _canon(type_name: str, table) -> str:
    t = str(type_name).lower().replace(" ", "")
    for prefix, family in table:
        if t.startswith(prefix):
            return t if family is None else family
    return t


def column_types(spark_df, con, sql: str) -> tuple[dict, dict]:
    """Canonical column types of the Spark result and of the oracle SQL."""
    rel = con.sql(sql)
    return ({c: _canon(t, _SPARK_TYPES) for c, t in spark_df.dtypes},
            {c: _canon(t, _DUCK_TYPES) for c, t in zip(rel.columns, rel.types)})


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_types, o_types = column_types(spark_df, con, sql)
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(o_rows),
           "columns_match": sorted(s_cols) == sorted(o_cols), "spark_cols": s_cols, "oracle_cols": o_cols,
           "types_match": s_types == o_types}
    if not out["types_match"]:
        out["type_diff"] = {c: (s_types.get(c), o_types.get(c)) for c in set(s_types) | set(o_types)
                            if s_types.get(c) != o_types.get(c)}
    if out["columns_match"]:
        order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        o_index = {c: i for i, c in enumerate(o_cols)}
        s_set = Counter(tuple(_norm(r[i]) for i in order) for r in s_rows)
        o_set = Counter(tuple(_norm(r[o_index[s_cols[i]]]) for i in order) for r in o_rows)
        out["values_match"] = s_set == o_set
        if not out["values_match"]:
            out["only_spark"] = list((s_set - o_set).items())[:3]
            out["only_oracle"] = list((o_set - s_set).items())[:3]
    else:
        out["values_match"] = False
    out["ok"] = out["values_match"] and out["types_match"] and out["spark_rows"] == out["oracle_rows"]
    return out
