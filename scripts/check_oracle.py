"""Compare every catalog query with its DuckDB oracle (what the round verifier does).

Usage: python scripts/check_oracle.py [sf_dir] [name ...]
Prints one line per query: row counts, column/type agreement and exact value agreement.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tariff_engine.plans import catalog  # noqa: E402
from tariff_engine.session import local_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]

SPARK_TO_DUCK = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
                 "boolean": "BOOLEAN"}


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def _key(row):
    return tuple((v is None, "" if v is None else str(v)) for v in row)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(catalog.CATALOG)
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    spark = local_session(8)
    sqls = catalog.oracle_sql()
    bad = 0
    for name in names:
        t0 = time.time()
        df = catalog.queries()[name](spark, sf_dir)
        spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        srows = [tuple(_norm(x) for x in r) for r in df.collect()]
        t1 = time.time()
        sql = sqls.get(name)
        if sql is None:
            print(f"{name:24s} spark_rows={len(srows):8d} (no oracle) {t1 - t0:.1f}s")
            continue
        rel = con.sql(sql)
        dcols, dtypes = rel.columns, [str(t) for t in rel.types]
        drows = [tuple(_norm(x) for x in r) for r in rel.fetchall()]
        scols = list(df.columns)
        order_s = sorted(range(len(scols)), key=lambda i: scols[i])
        order_d = sorted(range(len(dcols)), key=lambda i: dcols[i])
        same_cols = sorted(scols) == sorted(dcols)
        type_diff = [c for c, dt in zip(dcols, dtypes)
                     if c in spark_types and SPARK_TO_DUCK.get(spark_types[c], spark_types[c]) != dt]
        s_sorted = sorted((tuple(r[i] for i in order_s) for r in srows), key=_key)
        d_sorted = sorted((tuple(r[i] for i in order_d) for r in drows), key=_key)
        equal = same_cols and s_sorted == d_sorted
        ok = equal and not type_diff and len(srows) == len(drows)
        bad += not ok
        print(f"{name:24s} spark_rows={len(srows):8d} oracle_rows={len(drows):8d} cols={'ok' if same_cols else 'DIFF'} "
              f"types={'ok' if not type_diff else type_diff} values={'ok' if equal else 'DIFF'} "
              f"{t1 - t0:.1f}s/{time.time() - t1:.1f}s", flush=True)
        if same_cols and not equal:
            diffs = 0
            names_sorted = sorted(scols)
            for a, b in zip(s_sorted, d_sorted):
                if a != b:
                    cols = [names_sorted[i] for i in range(len(a)) if a[i] != b[i]]
                    print("   spark ", [a[names_sorted.index(c)] for c in cols], cols)
                    print("   oracle", [b[names_sorted.index(c)] for c in cols])
                    diffs += 1
                    if diffs >= 3:
                        break
    print(f"{len(names) - bad}/{len(names)} queries agree")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
