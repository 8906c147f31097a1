"""Run the registered queries against DuckDB: ``python tests/check_registry.py [dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normalised(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Columns by name, rows in a fixed order, NaN made comparable."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else value + 0.0
        return value

    return sorted((tuple(cell(row[i]) for i in order) for row in rows), key=repr)


def differences(spark, con, name: str, query, sql: str | None, sf_dir: str) -> str | None:
    """None when the query gives the rows of the SQL (or, without SQL, any rows)."""
    df = query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return None if rows else "no rows"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(columns)}"
    left, right = normalised(df.columns, rows), normalised(columns, expected)
    if len(left) != len(right):
        return f"{len(left)} rows instead of {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    types = [(type(a), type(b)) for a, b in zip(left[0], right[0]) if type(a) is not type(b)] if left else []
    if wrong:
        return f"{len(wrong)} of {len(left)} rows differ, first {wrong[0]}"
    return f"types differ: {types}" if types else None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(contract.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="shared-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in chosen:
        start = time.time()
        try:
            problem = differences(spark, con, name, contract.queries()[name], contract.oracle_sql().get(name), sf_dir)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.1f}s {'sql ' if name in contract.oracle_sql() else 'rows'} {problem or 'ok'}", flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} ok")
