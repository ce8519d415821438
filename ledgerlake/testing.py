"""Test helpers: run a registered query next to its DuckDB twin and compare results."""

from __future__ import annotations

import datetime as _dt
import math
import os
from collections import Counter
from decimal import Decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck_connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, Decimal):
        return ("dec", format(v.normalize(), "f"))
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return ("num", repr(v))
    if isinstance(v, int):
        return ("num", repr(float(v))) if abs(v) < 2**53 else ("int", v)
    if isinstance(v, _dt.datetime):
        return ("ts", v.replace(tzinfo=None).isoformat())
    if isinstance(v, _dt.date):
        return ("date", v.isoformat())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return ("str", str(v))


def canonical_rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


# Spark simpleString -> DuckDB type name for the types the queries produce.
TYPE_NAMES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def type_mismatches(sdf, rel) -> list:
    d_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    out = []
    for f in sdf.schema.fields:
        st = f.dataType.simpleString()
        if d_types.get(f.name) != TYPE_NAMES.get(st, st.upper()):
            out.append((f.name, st, d_types.get(f.name)))
    return out


def compare(spark, name: str, query, sql: str, sf_dir: str) -> dict:
    sdf = query(spark, sf_dir)
    s_cols = list(sdf.columns)
    s_rows = [tuple(r) for r in sdf.collect()]
    con = duck_connect(sf_dir)
    types_bad = type_mismatches(sdf, con.sql(sql))
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    s_can = canonical_rows(s_cols, s_rows)
    d_can = canonical_rows(d_cols, d_rows)
    diff_s = s_can - d_can
    diff_d = d_can - s_can
    return {
        "name": name,
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "spark_columns": s_cols,
        "oracle_columns": d_cols,
        "values_match": not diff_s and not diff_d,
        "type_mismatches": types_bad,
        "only_spark": list(diff_s.elements())[:3],
        "only_oracle": list(diff_d.elements())[:3],
    }
