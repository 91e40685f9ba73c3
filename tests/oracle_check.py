"""Compare every registered query with its SQL on one scale.

    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def rows_of(columns: list[str], rows) -> list[str]:
    """Rows as text, columns by name, in an order of their own."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([row[i] for i in order]) for row in rows)


def compare(spark, connection, sf: str, query, sql: str) -> str:
    """Empty when the two agree, or what differs."""
    result = query(spark, sf)
    ours = rows_of(result.columns, result.collect())
    cursor = connection.execute(sql)
    columns = [column[0] for column in cursor.description]
    theirs = rows_of(columns, cursor.fetchall())
    if sorted(result.columns) != sorted(columns):
        return f"columns {sorted(result.columns)} and {sorted(columns)}"
    if ours != theirs:
        extra = sorted(set(ours) - set(theirs))[:3]
        missing = sorted(set(theirs) - set(ours))[:3]
        return f"{len(ours)} and {len(theirs)} rows; only ours {extra}; only SQL {missing}"
    return ""


def main() -> int:
    import __spark_entry__ as registry
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf = sys.argv[1]
    connection = duck(sf)
    queries, oracle = registry.queries(), registry.oracle_sql()
    failed = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            problem = compare(spark, connection, sf, queries[name], oracle[name])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok':4} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{failed} failed; without SQL: {sorted(set(queries) - set(oracle))}")
    return failed


if __name__ == "__main__":
    sys.exit(main())
