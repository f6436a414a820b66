"""Run every query and its SQL on the same tables and compare the results."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duckdb_views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def ordered(columns: list[str], rows: list[tuple]) -> list[tuple]:
    position = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(row[i] for i in position) for row in rows), key=repr)


def compare(spark: SparkSession, connection, build, sql: str | None, sf_dir: str) -> tuple[str, int]:
    """('ok', rows) or what differs."""
    df = build(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return "rows only", len(rows)
    found = connection.execute(sql)
    names = [d[0] for d in found.description]
    expected = found.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(names) ^ set(df.columns))}", len(rows)
    if len(rows) != len(expected):
        return f"{len(rows)} rows, expected {len(expected)}", len(rows)
    mine, other = ordered(df.columns, rows), ordered(names, expected)
    bad = [(a, b) for a, b in zip(mine, other) if a != b]
    return ("ok" if not bad else f"{len(bad)} rows differ, first {bad[0]}"), len(rows)


def main(sf_dir: str, wanted: list[str]) -> None:
    from checks.oracle import ORACLE
    from checks.queries import QUERIES

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    connection = duckdb_views(sf_dir)
    for name, build in QUERIES.items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            outcome, rows = compare(spark, connection, build, ORACLE.get(name), sf_dir)
        except Exception as failure:  # report and go on with the next query
            outcome, rows = f"{type(failure).__name__}: {str(failure)[:600]}", -1
        print(f"{name}: {outcome} ({rows} rows, {time.time() - start:.1f} s)", flush=True)


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    main(sys.argv[1], sys.argv[2:])
