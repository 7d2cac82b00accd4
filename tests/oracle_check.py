"""Runs registered queries next to their SQL and compares the results."""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def cell(value: object) -> str:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return repr(value)


def canonical(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    mine = canonical(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if mine else "no rows"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    theirs = canonical(columns, result.fetchall())
    if mine == theirs:
        return None if mine else "no rows"
    extra = [r for r in mine if r not in set(theirs)][:3]
    lacking = [r for r in theirs if r not in set(mine)][:3]
    return f"{sorted(columns)}: {len(mine)} vs {len(theirs)} rows; only Spark {extra}; only SQL {lacking}"


def session(cores: str = "8"):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    folder = sys.argv[1]
    wanted = sys.argv[2:] or list(entry.queries())
    spark, con, bad = session(), connect(folder), 0
    for name in wanted:
        start = time.time()
        try:
            problem = compare(spark, con, name, folder)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        kind = "" if name in entry.oracle_sql() else " (rows only)"
        print(f"{'ok  ' if problem is None else 'BAD '} {name}{kind} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("bad:", bad)
