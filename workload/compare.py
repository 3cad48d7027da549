"""Run the registered queries and their SQL side by side: python -m workload.compare [folder] [name ...]"""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from workload.oracles import ORACLES
from workload.spark_queries import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
          " conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def rows(columns: list[str], data) -> list[tuple]:
    """Rows with columns by name, values as text, in a fixed order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("null" if row[i] is None else str(row[i]) for i in order) for row in data)


def difference(spark: SparkSession, connection, folder: str, name: str) -> str | None:
    """What differs for one query, null if nothing does."""
    frame = QUERIES[name](spark, folder)
    got = rows(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = connection.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    want = rows(columns, cursor.fetchall())
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} <> {sorted(columns)}"
    if got != want:
        extra, missing = sorted(set(got) - set(want)), sorted(set(want) - set(got))
        return f"{len(got)} rows <> {len(want)}; only in Spark {extra[:2]}; only in SQL {missing[:2]}"
    return None if got else "no rows"


def main(folder: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    connection, bad = connect(folder), 0
    for name in names or QUERIES:
        started = time.time()
        try:
            problem = difference(spark, connection, folder, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{time.time() - started:6.1f}s {name}: {problem or 'equal'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
