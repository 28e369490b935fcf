"""Run registered queries on Spark and DuckDB and compare columns, row counts and values.

    python -m checks.compare [--sf 0.01] [--only key,key] [--match text]
"""

from __future__ import annotations

import argparse
import math
import time
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def normal(value):
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return float(f"{value:.12g}")
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(normal(r[i]) for i in order) for r in rows)


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def compare(query, spark, con, sf_dir: str, df=None) -> tuple[bool, str]:
    start = time.time()
    df = query.spark(spark, sf_dir) if df is None else df
    got = df.collect()
    spent = time.time() - start
    note = f"{len(got):>7} rows {spent:6.2f}s"
    if query.sql is None:
        return True, note + " (no SQL)"
    cursor = con.execute(query.sql)
    names = [c[0] for c in cursor.description]
    want = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return False, f"{note} columns {sorted(df.columns)} != {sorted(names)}"
    left, right = rows_of(df.columns, got), rows_of(names, want)
    if left == right:
        return True, note
    extra, missing = list((left - right).items()), list((right - left).items())
    return False, (
        f"{note} vs {len(want)} rows; {len(extra)} only in Spark, {len(missing)} only in SQL\n"
        f"   columns {sorted(names)}\n   spark {sorted(extra, key=repr)[:3]}\n   sql   {sorted(missing, key=repr)[:3]}"
    )


def session(cpus: int = 8):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("checks")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    from checks.queries import QUERIES

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--only", default="")
    parser.add_argument("--match", default="")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark, con = session(), connect(sf_dir)
    only = set(filter(None, args.only.split(",")))
    failed = []
    for key, query in QUERIES.items():
        if (only and key not in only) or args.match not in key:
            continue
        try:
            ok, note = compare(query, spark, con, sf_dir)
        except Exception as error:  # report and go on with the next query
            ok, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if ok else 'FAIL'} {key:32} {note}", flush=True)
        if not ok:
            failed.append(key)
    print("failed:", ",".join(failed) or "none")


if __name__ == "__main__":
    main()
