"""Run a registered Spark query and its DuckDB oracle on the same tables and compare.

Mirrors the driver's check: same column names, same row count, same
multiset of rows (order-insensitive), plus a type-compatibility report.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]

SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "array<double>": "DOUBLE[]", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    if hasattr(v, "item") and not isinstance(v, (list, tuple)):
        try:
            return _norm(v.item())
        except (ValueError, AttributeError):
            pass
    if isinstance(v, (list, tuple)) or type(v).__name__ == "ndarray":
        return tuple(_norm(x) for x in v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def _key(row):
    return tuple((x is None, type(x).__name__, x if x is not None else 0) for x in row)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=_key)


def compare(spark, key: str, sf_dir: str, spark_fn, sql: str | None, con=None) -> dict:
    t0 = time.time()
    sdf = spark_fn(spark, sf_dir)
    s_cols = sdf.columns
    s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    res = {"key": key, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        res["status"] = "no-oracle"
        return res
    con = con or duck(sf_dir)
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = dict(zip(d_cols, [str(t) for t in rel.types]))
    d_rows = rel.fetchall()
    res["oracle_rows"] = len(d_rows)
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns differ: spark-only {sorted(set(s_cols) - set(d_cols))} "
                        f"oracle-only {sorted(set(d_cols) - set(s_cols))}")
    else:
        for c in s_cols:
            want = SPARK_TO_DUCK.get(s_types[c], s_types[c])
            if want != d_types[c]:
                problems.append(f"type {c}: spark {s_types[c]} oracle {d_types[c]}")
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        if a != b:
            sa, sb = set(a), set(b)
            problems.append(f"values differ: {len(sa - sb)} spark-only, {len(sb - sa)} oracle-only; "
                            f"e.g. spark {sorted(sa - sb, key=_key)[:2]} oracle {sorted(sb - sa, key=_key)[:2]}")
    if len(s_rows) != len(d_rows):
        problems.append("row count differs")
    res["status"] = "ok" if not problems else "FAIL"
    if problems:
        res["problems"] = problems
    return res


def main(argv):
    import json
    from casewatch.session import local_session
    import __spark_entry__ as e
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    keys = argv[1:] or list(e.queries())
    spark = local_session()
    qs, sqls = e.queries(), e.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, k, sf_dir, qs[k], sqls.get(k), con)
        except Exception as ex:  # report and continue
            r = {"key": k, "status": "ERROR", "error": f"{type(ex).__name__}: {str(ex)[:600]}"}
        bad += r["status"] not in ("ok", "no-oracle")
        print(json.dumps(r), flush=True)
    print(f"done: {len(keys)} keys, {bad} not ok")


if __name__ == "__main__":
    main(sys.argv)
