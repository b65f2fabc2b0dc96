"""Run registered queries against their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "as_tuple") or isinstance(value, float):
        return round(float(value), 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_cell(v) for v in value)
    return value


def _rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in data), key=repr)


def compare(spark_df, con, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = _rows(names, result.fetchall())
    found = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    if len(found) != len(expected):
        return f"{len(found)} rows against {len(expected)}"
    bad = [(f, e) for f, e in zip(found, expected) if f != e]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def main() -> None:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    oracles = oracle_sql()
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            verdict = compare(df, con, oracles[name]) if name in oracles else f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001 - the sweep reports and goes on
            verdict = f"ERROR {str(error)[:700]}"
        print(f"{name:32s} {time.time() - start:6.1f}s {'ok' if verdict is None else verdict}", flush=True)


if __name__ == "__main__":
    main()
