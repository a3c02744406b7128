"""Compare queries with their SQL: `python -m checks.compare [sf_dir] [name ...]`."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from checks import tables
from checks.oracle import ORACLE
from checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


DUCKDB_TYPE = {
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "double": "DOUBLE",
    "int": "INTEGER",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
}


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        return "NaN" if isinstance(v, float) and math.isnan(v) else v

    return Counter(tuple(value(r[i]) for i in order) for r in rows)


def difference(spark: SparkSession, con, sf_dir: str, name: str) -> str | None:
    """None if names, types, row counts and values agree exactly."""
    frame = QUERIES[name](spark, sf_dir)
    result = con.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    types = sorted((d[0], str(d[1])) for d in result.description)
    expected = sorted((name, DUCKDB_TYPE[dtype]) for name, dtype in frame.dtypes)
    if types != expected:
        return f"columns {expected} vs {types}"
    ours, theirs = _bag(frame.columns, frame.collect()), _bag(columns, result.fetchall())
    if ours == theirs:
        return None
    return (
        f"{ours.total()} vs {theirs.total()} rows; only in Spark {list(ours - theirs)[:3]}; "
        f"only in SQL {list(theirs - ours)[:3]}"
    )


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("checks")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark, con, bad = session(), duck(sf_dir), 0
    for name in names or QUERIES:
        start = time.time()
        problem = difference(spark, con, sf_dir, name)
        bad += problem is not None
        print("BAD" if problem else "ok ", name, f"{time.time() - start:.2f}s", flush=True)
        if problem:
            print("   ", problem)
        tables.remove_scratch(spark)
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
