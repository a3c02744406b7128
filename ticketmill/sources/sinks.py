"""Parquet zones and CSV reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of a row group of tables that are looked up by a key.
LOOKUP_ROW_GROUP = 16 << 20


def write_zone(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    rebalance: bool = False,
    seen: Observation | None = None,
    lookup_key: str | None = None,
) -> None:
    """Parquet, snappy-compressed. `seen` counts the rows as they are written.

    With many partition values set `rebalance`: one shuffle by those values, in which adaptive
    execution splits a value that is too large and merges those that are small. Without it every
    task writes its own file per value.

    With a `lookup_key`, rows are sorted by it within each file, and row groups are small and have a Bloom
    filter of it: a scan for a few values of the key skips what can't have them.
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    if lookup_key:
        df = df.sortWithinPartitions(*partition_by, lookup_key)
    if seen is not None:  # above the shuffle, which may be run again in part
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = df.write.mode(mode).partitionBy(*partition_by)
    if lookup_key:
        writer = writer.options(
            **{
                f"parquet.bloom.filter.enabled#{lookup_key}": True,
                "parquet.bloom.filter.adaptive.enabled": True,
                "parquet.block.size": LOOKUP_ROW_GROUP,
            }
        )
    writer.parquet(path)


def create_table(
    spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str] = ()
) -> None:
    """An empty table at the path, unless something is there already."""
    empty = spark.createDataFrame([], schema)
    empty.write.mode("ignore").partitionBy(*partition_by).parquet(path)


def write_listing(df: DataFrame, path: str) -> int:
    """A CSV directory of any number of part files, for what may grow with the data; returns the
    number of rows."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option(
        "header", True
    ).option("emptyValue", "").csv(path)
    return seen.get["rows"]


def write_report(df: DataFrame, path: str, order: Sequence[Column] = ()) -> int:
    """A CSV directory with one sorted part file, a header, and empty fields for NULL; returns the
    number of rows.

    For reports only: they are aggregated already, so one task holds no more than their groups.
    """
    single = df.repartition(1)
    if order:
        single = single.sortWithinPartitions(*order)
    seen = Observation()
    single = single.observe(seen, F.count(F.lit(1)).alias("rows"))
    single.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)
    return seen.get["rows"]
