"""Run registered queries and their SQL on the same files and compare row by row.

    python tests/compare.py [folder] [name prefixes...]
"""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return float(f"{value:.9g}") + 0.0
    if isinstance(value, (decimal.Decimal,)):
        return ("decimal", str(value))
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def types(rows):
    return [sorted({type(v).__name__ for v in col if v is not None}) for col in zip(*rows)]


def differences(df, con, sql: str) -> str | None:
    cols_a, rows_a = table(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    cols_b, rows_b = table([d[0] for d in cursor.description], cursor.fetchall())
    if cols_a != cols_b:
        return f"columns {cols_a} != {cols_b}"
    if len(rows_a) != len(rows_b):
        return f"rows {len(rows_a)} != {len(rows_b)}"
    if types(rows_a) != types(rows_b):
        return f"types {types(rows_a)} != {types(rows_b)}"
    bad = [(a, b) for a, b in zip(rows_a, rows_b) if a != b]
    if bad:
        return f"{len(bad)} of {len(rows_a)} rows differ, first:\n   spark {str(bad[0][0])[:400]}\n   sql   {str(bad[0][1])[:400]}"
    return None if rows_a else "EMPTY"


def session(cores: str = "8"):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("tidemark")
        .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.log.level", "ERROR").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    from tidemark.queries.registry import load_all

    spark, con, failed = session(), connect(folder), 0
    for name, q in load_all().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = q(spark, folder)
            problem = differences(df, con, q.sql) if q.sql else f"(no sql) {df.count()} rows"
        except Exception as error:  # report and go on to the next query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        if problem and not problem.startswith("(no sql)"):
            failed += 1
        print(f"{'ok  ' if not problem or problem.startswith('(no sql)') else 'FAIL'} {time.time() - start:5.1f}s {name} {problem or ''}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
