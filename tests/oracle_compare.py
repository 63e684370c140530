"""Run every registered query in Spark and its oracle SQL in DuckDB; compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Prints one line per query: name, OK/DIFF/ERR, row counts.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if math.isinf(v):
            return "inf" if v > 0 else "-inf"
        return round(v + 0.0, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir, names=None, verbose=False):
    import __spark_entry__ as E

    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = ("ERR-spark", str(e).splitlines()[0][:300])
            print(name, "ERR-spark", results[name][1], flush=True)
            continue
        if name not in sql:
            results[name] = ("ROWS", len(s_rows))
            print(f"{name:12s} ROWS-ONLY spark={len(s_rows)} {time.time()-t0:.1f}s", flush=True)
            continue
        try:
            rel = con.sql(sql[name])
            d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
            cur = con.execute(sql[name])
            d_cols = [c[0] for c in cur.description]
            d_rows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("ERR-duck", str(e).splitlines()[0][:300])
            print(name, "ERR-duck", results[name][1], flush=True)
            continue
        ok_cols = sorted(s_cols) == sorted(d_cols)
        s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
        bad_types = {c: (s_types.get(c), d_types.get(c)) for c in s_types if s_types.get(c) != d_types.get(c)}
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        ok = ok_cols and a == b and not bad_types
        if bad_types:
            print("   types differ", bad_types)
        results[name] = ("OK" if ok else "DIFF", len(s_rows), len(d_rows))
        print(f"{name:12s} {'OK' if ok else 'DIFF'} spark={len(s_rows)} duck={len(d_rows)} {time.time()-t0:.1f}s", flush=True)
        if not ok and (verbose or True):
            if not ok_cols:
                print("   cols spark", sorted(s_cols), "duck", sorted(d_cols))
            else:
                diff_a = [r for r in a if r not in b][:3]
                diff_b = [r for r in b if r not in a][:3]
                print("   spark-only", diff_a)
                print("   duck-only ", diff_b)
    return results


if __name__ == "__main__":
    from probity.session import get_spark

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = get_spark("local[8]", **{"spark.sql.shuffle.partitions": "8"})
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "ROWS")}
    print(f"TOTAL {len(res)} OK {sum(1 for v in res.values() if v[0]=='OK')} ROWS {sum(1 for v in res.values() if v[0]=='ROWS')} BAD {len(bad)}: {sorted(bad)}")
