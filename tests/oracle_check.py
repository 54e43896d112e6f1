"""Run queries in Spark and their SQL in DuckDB over the same files and compare every value.

    python tests/oracle_check.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

# DuckDB type name for each Spark type name.
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
    "array<string>": "VARCHAR[]", "array<double>": "DOUBLE[]",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if v is None or v is pd.NaT:
        return None
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    if isinstance(v, float):
        return None if v != v else v
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "tzinfo") and getattr(v, "tzinfo", None) is not None:
        return v.replace(tzinfo=None)
    return v


def _rows(rows, order):
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(df, con, sql) -> str:
    """Empty text when equal, else what differs."""
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    expected = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = {n: k for n, k in con.execute(f"DESCRIBE {sql}").df()[["column_name", "column_type"]].values}
    for f in df.schema.fields:
        want = SAME_TYPE.get(f.dataType.simpleString())
        if want and kinds[f.name] != want:
            return f"type of {f.name}: {f.dataType.simpleString()} != {kinds[f.name]}"
    order_names = sorted(names)
    a = _rows(rows, [df.columns.index(n) for n in order_names])
    b = _rows(expected, [names.index(n) for n in order_names])
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, first of {order_names}:\n  spark {bad[0][0]}\n  duck  {bad[0][1]}"
    return ""


def main() -> int:
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    sf_dir = f"{DATA}/sf{args.sf}"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    fns, sqls = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, fn in fns.items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sqls:
                note = compare(df, con, sqls[name])
            else:
                note, n = "", df.count()
                name = f"{name} (rows only: {n})"
        except Exception as e:  # noqa: BLE001
            note = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += bool(note)
        print(f"{'FAIL' if note else 'ok  '} {name} {time.time() - t:.2f}s {note}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
