"""Compare a registered query with its DuckDB oracle.

The comparison mirrors the driver's: same row count, same column names
(sorted), and the same multiset of rows with exact values.
"""

from __future__ import annotations

import math
from collections import Counter

from lodestar.sources.tables import TABLES
from lodestar.session import table_path


def duckdb_conn(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{table_path(sf_dir, name)}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if v == 0.0 and math.copysign(1.0, v) < 0:
            return "-0.0"  # keep the sign: a value hash would see it
        return v
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except (ValueError, AttributeError):
            pass
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(records, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in records)


def compare(spark_df, con, sql: str) -> dict:
    s_names = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_names = list(rel.columns)
    d_rows = rel.fetchall()
    out = {
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "names_match": sorted(s_names) == sorted(d_names),
        "spark_cols": s_names,
        "oracle_cols": d_names,
        "spark_types": [f.dataType.simpleString() for f in spark_df.schema.fields],
        "oracle_types": [str(t) for t in rel.types],
    }
    if out["names_match"]:
        a, b = _rows(s_rows, s_names), _rows(d_rows, d_names)
        out["values_match"] = a == b
        if not out["values_match"]:
            only_s = list((a - b).elements())[:3]
            only_d = list((b - a).elements())[:3]
            out["sample_spark_only"] = only_s
            out["sample_oracle_only"] = only_d
    else:
        out["values_match"] = False
    out["ok"] = out["names_match"] and out["values_match"] and out["spark_rows"] == out["oracle_rows"]
    return out
