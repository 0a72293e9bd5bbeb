"""Run catalog queries on Spark and their SQL on DuckDB and compare the results.

Usage: python -m tests.oracle_compare [sf_dir] [name ...]

Compares row counts, column names and types, and the multiset of rows
(order-insensitive, columns sorted by name), the way the correctness gate does.
"""

from __future__ import annotations

import collections
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "float": "FLOAT", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "binary": "BLOB",
    "smallint": "SMALLINT", "tinyint": "TINYINT", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return float(repr(v))
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def compare(spark, con, sf_dir: str, name: str, fn, sql: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_types = [SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in sdf.schema.fields]
    s_rows = sdf.collect()
    t_spark = time.time() - t0
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    d_types = [str(t) for t in con.execute(f"DESCRIBE {sql}").fetchall() and
               [r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()]]
    out = {"name": name, "spark_rows": len(s_rows), "duck_rows": len(d_rows),
           "spark_sec": round(t_spark, 2)}
    if sorted(s_cols) != sorted(d_cols):
        out["cols"] = (s_cols, d_cols)
        out["ok"] = False
        return out
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_index = {c: i for i, c in enumerate(d_cols)}
    st = {s_cols[i]: s_types[i] for i in range(len(s_cols))}
    dt = {d_cols[i]: d_types[i] for i in range(len(d_cols))}
    type_diff = {c: (st[c], dt[c]) for c in s_cols if st[c] != dt[c]}
    s_bag = collections.Counter(tuple(norm(r[i]) for i in order) for r in s_rows)
    d_bag = collections.Counter(tuple(norm(r[d_index[s_cols[i]]]) for i in order) for r in d_rows)
    only_s = s_bag - d_bag
    only_d = d_bag - s_bag
    out["types"] = type_diff
    out["ok"] = not only_s and not only_d and not type_diff
    if only_s or only_d:
        out["only_spark"] = list(only_s.items())[:3]
        out["only_duck"] = list(only_d.items())[:3]
        out["n_only"] = (sum(only_s.values()), sum(only_d.values()))
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from hearth.session import local_session
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            print(f"{name}: no oracle SQL")
            continue
        try:
            r = compare(spark, con, sf_dir, name, qs[name], sqls[name])
        except Exception as e:  # report and go on
            r = {"name": name, "ok": False, "error": repr(e)[:1500]}
        bad += not r["ok"]
        print(r, flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
