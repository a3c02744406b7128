"""Joins between citations and small tables.

Nothing here forces a broadcast. Spark broadcasts a side whose size it knows to be below
spark.sql.autoBroadcastJoinThreshold, and adaptive execution does so for a side whose measured
size is; beyond that it sorts and merges, splitting oversized partitions of the left side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(
    df: DataFrame, table: DataFrame, on: Sequence[str], value: str, default=None
) -> DataFrame:
    """Add `value` from a table that is unique on `on`; unmatched and NULL keys get `default`."""
    joined = df.join(table.select(*on, value), list(on), "left")
    if default is not None:
        joined = joined.withColumn(value, F.coalesce(F.col(value), F.lit(default)))
    return joined.select(*df.columns, value)


def attach_weather(
    citations: DataFrame,
    weather: DataFrame,
    columns: Sequence[str] = ("precip_bucket", "condition_label"),
) -> DataFrame:
    """Every citation with the weather of its day and campus, NULL where there is none."""
    narrow = weather.select("date", "campus", *columns)
    return citations.join(narrow, ["date", "campus"], "left").select(*citations.columns, *columns)


def hot_keys(df: DataFrame, keys: Sequence[str], shares: int) -> DataFrame:
    """(keys, parts): the keys with over one of `shares` equal parts of the rows, and how many parts they have. There
    are fewer than `shares` of them, whatever the data; keys are counted in each task before they are shuffled."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    total = counted.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    hot = counted.filter(F.col("rows") * shares > total)
    parts = F.ceil(F.col("rows") * shares / F.lit(max(total, 1))).cast("int")
    schema = hot.select(*keys, parts.alias("parts")).schema
    return df.sparkSession.createDataFrame(hot.select(*keys, parts.alias("parts")).collect(), schema)


def attach_weather_salted(
    citations: DataFrame,
    weather: DataFrame,
    columns: Sequence[str] = ("precip_bucket", "condition_label"),
    shares: int | None = None,
) -> DataFrame:
    """attach_weather() for citations of which a few days, or those without a day, hold a large part, where
    neither side can be broadcast and adaptive execution is off.

    Days and campuses with over one of `shares` parts of the rows (twice the shuffle partitions, if not given) are
    measured first, by one job that reads the two keys. Their citations are dealt out by a hash of the whole row to
    as many parts as they fill, and their weather stands in each; all others join as ever. The list of these
    keys, shorter than `shares`, is what is broadcast."""
    spark = citations.sparkSession
    shares = shares or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(
        hot_keys(citations, ["date", "campus"], shares).withColumnsRenamed({"date": "_date", "campus": "_campus"})
    )
    same = F.col("date").eqNullSafe(F.col("_date")) & F.col("campus").eqNullSafe(F.col("_campus"))
    parts = F.coalesce("parts", F.lit(1))
    part = F.pmod(F.xxhash64(*citations.columns), parts).cast("int")
    dealt = citations.join(hot, same, "left").withColumn("_part", part).drop("_date", "_campus", "parts")
    narrow = weather.select("date", "campus", *columns).join(hot, same, "left")
    copied = narrow.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_date", "_campus", "parts")
    joined = dealt.join(copied, ["date", "campus", "_part"], "left")
    return joined.select(*citations.columns, *columns)


def stack(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL by column name."""
    for other in others:
        first = first.unionByName(other)
    return first
