from collections import Counter
from statistics import median

from pyspark.sql import functions as F

from ticketmill.operators.joins import attach_weather, attach_weather_salted, hot_keys


def frames(spark, n):
    """A third of the citations on one campus and day, a fifth without a day, the rest spread."""
    i = F.col("id")
    day = F.when(i % 3 == 0, F.lit("2025-09-15").cast("date")).when(
        i % 5 != 1, F.date_add(F.lit("2025-01-01").cast("date"), (i % 300).cast("int")))
    citations = spark.range(n).select(i.cast("string").alias("citation_id"), day.alias("date"), F.lit("K").alias("campus"))
    days = spark.range(280).select(
        F.date_add(F.lit("2025-01-01").cast("date"), i.cast("int")).alias("date"), F.lit("K").alias("campus"),
        F.concat(F.lit("b"), i % 4).alias("precip_bucket"), F.lit("c").alias("condition_label"))
    return citations, days


def test_a_hot_day_is_dealt_out_evenly(spark):
    citations, days = frames(spark, 60_000)
    wanted = Counter(map(tuple, attach_weather(citations, days).collect()))
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        salted = attach_weather_salted(citations, days, shares=64)
        even = [r["count"] for r in salted.groupBy(F.spark_partition_id()).count().collect()]
        plain = [r["count"] for r in attach_weather(citations, days).groupBy(F.spark_partition_id()).count().collect()]
        found = Counter(map(tuple, salted.collect()))
    finally:
        for k in off:
            spark.conf.unset(k)
    assert found == wanted
    assert max(even) <= 2 * median(even) < max(plain)


def test_hot_keys_are_few_and_measured(spark):
    citations, days = frames(spark, 3_000)
    hot = {(str(r["date"]), r["campus"]): r["parts"] for r in hot_keys(citations, ["date", "campus"], 10).collect()}
    assert hot == {("2025-09-15", "K"): 4, ("None", "K"): 2}
    none = citations.filter("false")
    assert hot_keys(none, ["date", "campus"], 10).collect() == []
    assert attach_weather_salted(none, days).collect() == []
