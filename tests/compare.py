"""Runs registered queries against their DuckDB twins: `python tests/compare.py [sf_dir] [name ...]`."""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

import __spark_entry__ as registry
from chalkline.session import local_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def open_duckdb(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return ("nan",)
    return (value is None, type(value).__name__ if isinstance(value, bool) else "", str(value) if value is None else value)


def sorted_rows(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in at) for row in rows), key=lambda r: tuple(map(str, r)))


def difference(spark_df, connection, sql):
    """None when both give the same columns and rows, else what differs first."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    theirs = sorted_rows(names, result.fetchall())
    ours = sorted_rows(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(set(names) ^ set(spark_df.columns))}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} and {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if tuple(map(_cell, a)) != tuple(map(_cell, b))]
    if wrong:
        ordered = sorted(names)
        cells = [(c, x, y) for c, x, y in zip(ordered, *wrong[0]) if _cell(x) != _cell(y)]
        return f"{len(wrong)} rows, first {cells}"
    return None


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    connection = open_duckdb(sf_dir)
    twins = registry.oracle_sql()
    failed = 0
    for name, run in registry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            found = difference(run(spark, sf_dir), connection, twins[name])
        except Exception as error:  # noqa: BLE001 - the report goes on with the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print("failed", failed)


if __name__ == "__main__":
    main()
