"""Run every query and its SQL side by side: python tests/check_oracles.py [sf_dir] [name ...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def normal(value):
    """Comparable form of a cell."""
    if isinstance(value, float):
        return round(value, 6)
    return value


def result_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        [tuple(normal(row[i]) for i in order) for row in rows], key=repr
    )


def compare(spark, connection, name, sf_dir):
    """None if Spark and DuckDB agree, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    spark_cols, spark_rows = result_of(df.columns, df.collect())
    cursor = connection.execute(entry.oracle_sql()[name])
    duck_cols, duck_rows = result_of([d[0] for d in cursor.description], cursor.fetchall())
    if spark_cols != duck_cols:
        return f"columns {spark_cols} != {duck_cols}"
    if len(spark_rows) != len(duck_rows):
        return f"{len(spark_rows)} rows != {len(duck_rows)}"
    for a, b in zip(spark_rows, duck_rows):
        if a != b:
            return f"{a}\n      != {b}"
        if [type(x) for x in a] != [type(x) for x in b]:
            return f"types of {a} != {b}"
    return None


def connect(sf_dir):
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return connection


def session():
    spark = (
        SparkSession.builder.master("local[8]").appName("checks")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.oracle_sql())
    spark, connection, bad = session(), connect(sf), 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, connection, name, sf)
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
