"""Run registered queries beside their SQL checks and report differences.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def make_session(name: str = "tallyfold-tests"):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Recording the Python line of every column call slows the building of plans.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from tallyfold.session import configure

    return configure(spark)


def make_duckdb(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    return value


def sort_key(row):
    return tuple((v is not None, str(type(v).__name__), str(v)) for v in row)


def rows_of_spark(df):
    names = sorted(df.columns)
    return names, sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=sort_key)


def rows_of_sql(con, sql):
    rel = con.sql(sql)
    order = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    names = [rel.columns[i] for i in order]
    return names, sorted((tuple(plain(r[i]) for i in order) for r in rel.fetchall()), key=sort_key)


def difference(spark_df, con, sql) -> str:
    """Empty when columns, row count and every value agree exactly."""
    names, ours = rows_of_spark(spark_df)
    sql_names, theirs = rows_of_sql(con, sql)
    if names != sql_names:
        return f"columns {names} != {sql_names}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(bad)}/{len(ours)} rows differ, first {bad[0]}" if bad else ""


def main(argv):
    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = make_session()
    con = make_duckdb(sf_dir)
    queries, checks = entry.queries(), entry.oracle_sql()
    wanted = argv[1:] or list(queries)
    failed = []
    for name in wanted:
        start = time.time()
        try:
            out = queries[name](spark, sf_dir)
            problem = difference(out, con, checks[name]) if name in checks else ""
            note = "" if name in checks else f" (no SQL, {out.count()} rows)"
        except Exception as error:  # report and go on with the next query
            problem, note = f"{type(error).__name__}: {str(error)[:600]}", ""
        print(f"{'FAIL' if problem else 'ok  '} {time.time() - start:6.1f}s {name}{note} {problem}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(wanted) - len(failed)}/{len(wanted)} agree; failed: {failed}")


if __name__ == "__main__":
    main(sys.argv[1:])
