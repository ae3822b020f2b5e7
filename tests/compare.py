"""Compare registered queries with their SQL on the given tables.

    python -m tests.compare [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import math
import time
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(x + 0.0)
    if isinstance(x, Decimal):
        raise TypeError("decimal in output")
    return repr(x)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, run, sql: str | None, sf_dir: str) -> tuple[bool, str]:
    started = time.time()
    df = run(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - started
    if sql is None:
        return True, f"{took:5.1f}s rows={len(got)} (no sql)"
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    types = {d[0]: str(d[1]) for d in res.description}
    want = res.fetchall()
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} vs {sorted(names)}"
    bad = [(c, t, types[c]) for c, t in df.dtypes if KINDS.get(t) != types[c]]
    if bad:
        return False, f"types {bad}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a != b:
        only_a = [x for x in a if x not in set(b)][:3]
        only_b = [x for x in b if x not in set(a)][:3]
        return False, f"values spark={len(a)} sql={len(b)} cols={sorted(names)}\n   spark {only_a}\n   sql   {only_b}"
    return True, f"{took:5.1f}s rows={len(a)}"


def main() -> None:
    import __spark_entry__ as entry
    from sheafwork.session import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--plain", action="store_true", help="a session with Spark's default settings")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    settings = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    if args.plain:
        builder = SparkSession.builder.master("local[8]")
        for key, value in settings.items():
            builder = builder.config(key, value)
        spark = builder.getOrCreate()
    else:
        spark = build_session("compare", "local[8]", **settings, **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = entry.oracle_sql()
    failed = []
    for name, run in entry.queries().items():
        if args.names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in args.names):
            continue
        try:
            ok, note = compare(spark, con, name, run, sql.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        print("ok  " if ok else "FAIL", name, note, flush=True)
        if not ok:
            failed.append(name)
    print("failed:", failed)


if __name__ == "__main__":
    main()
