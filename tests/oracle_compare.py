"""Run registered queries in Spark and their oracle text in DuckDB; compare.

Usage: python -m tests.oracle_compare [sf_dir] [name-substring ...]
Comparison: same column names, same row count, same multiset of rows after
sorting columns by name (floats compared exactly, NaN == NaN, null == null).
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, repr(float(v)))
    if hasattr(v, "isoformat"):
        return (3, v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat())
    if isinstance(v, bool):
        return (4, str(v))
    return (5, str(v))


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


# Spark simple type name -> DuckDB type name of the same values.
SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT",
    "float": "FLOAT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def type_mismatches(sdf, rel) -> list:
    duck = {name: str(t) for name, t in zip(rel.columns, rel.types)}
    out = []
    for f in sdf.schema.fields:
        want = SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
        if duck.get(f.name) != want:
            out.append((f.name, f.dataType.simpleString(), duck.get(f.name)))
    return out


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return dict(name=name, ok=None, rows=len(s_rows), spark_s=round(t1 - t0, 2), note="no oracle")
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    bad_types = type_mismatches(sdf, rel)
    d_rows = rel.fetchall()
    out = dict(name=name, rows=len(s_rows), oracle_rows=len(d_rows), spark_s=round(t1 - t0, 2))
    if sorted(s_cols) != sorted(d_cols):
        out.update(ok=False, note=f"columns differ: spark={s_cols} duck={d_cols}")
        return out
    if bad_types:
        out.update(ok=False, note=f"types differ (column, spark, duckdb): {bad_types}")
        return out
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if a != b:
        diff = [x for x in a if x not in set(b)][:3]
        out.update(ok=False, note=f"values differ, e.g. spark-only {diff}")
        return out
    out["ok"] = True
    return out


def main(argv):
    sys.path.insert(0, ".")
    from hearth.registry import ORACLE, QUERIES
    from hearth.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    pats = argv[1:]
    spark = local_session()
    con = duck(sf_dir)
    bad = 0
    for name, fn in QUERIES.items():
        if pats and not any(p in name for p in pats):
            continue
        try:
            r = compare(spark, con, name, fn, ORACLE.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = dict(name=name, ok=False, note=f"{type(e).__name__}: {str(e)[:300]}")
        bad += r.get("ok") is False
        print(r, flush=True)
    print(f"FAILED {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
