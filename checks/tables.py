"""Citations and weather derived row by row from the given tables, so they grow with them."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.operators.citations import clean_citations
from ticketmill.operators.weather import clean_weather
from ticketmill.schemas import SEQ, WEATHER_VARIABLES
from ticketmill.settings import CitationRules

RULES = CitationRules(
    schedule={"click": 35, "view": 35, "purchase": 50, "signup": 50},
    semesters=(
        ("First half", "2024-01-01", "2024-01-15"),
        ("Second half", "2024-01-16", "2024-01-29"),
    ),
)
CAMPUSES = ("North", "South")
STATUSES = ("Unpaid", "Transfer", "Zero Balance", "Inactive", "Appeal Balance Due")
CODES = (0, 3, 51, 63, 80, 95, 42)


# Declared, so that no job has to open files just to learn the columns.
COLUMNS = {
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double",
    "embeddings": "vec_id bigint, embedding array<float>",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_orderdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in a folder that all executors share: spark.checkpoint.dir, else the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    _scratch.append(f"{base.rstrip('/')}/scratch-{name}-{uuid.uuid4().hex}")
    return _scratch[-1]


_scratch: list[str] = []


def remove_scratch(spark: SparkSession) -> None:
    """Delete what scratch() has handed out; frames that read it end."""
    while _scratch:
        path = spark._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _campus() -> Column:
    return F.when(F.col("user_id") % 4 == 0, "South").otherwise("North")


def citations_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw citation per event: padded text, test rows, credits, and NULLs in every column."""
    e, u = F.col("event_id"), F.col("user_id")
    padded_south = F.when(u % 8 == 0, "\tSouth\u00a0").otherwise("South ")
    category = (
        F.when(e % 997 == 5, "DO NOT USE/TESTING")
        .when(e % 997 == 6, "DO NOT USE/TESTING ")
        .when(e % 701 != 9, F.col("event_type"))
    )
    fine = (
        F.when(e % 709 == 3, F.lit(None))
        .when(e % 601 == 7, -50)
        .when(e % 3 == 0, 0)
        .when(e % 41 == 1, 40)
        .when(F.col("event_type").isin("click", "view"), 35)
        .otherwise(50)
    )
    return table(spark, sf_dir, "events").select(
        F.when(e % 733 != 1, e.cast("string")).alias("citation_id"),
        F.when(e % 727 != 2, F.col("ts")).alias("Timestamp"),
        F.concat(F.lit("  Lot "), (u % 37).cast("string"), F.lit(" ")).alias("Location"),
        F.when(u % 4 == 0, padded_south).when(e % 743 != 8, "North").alias("Campus"),
        category.alias("Violation Type"),
        F.when(e % 719 != 4, F.get(F.array(*map(F.lit, STATUSES)), (e % 5).cast("int"))).alias(
            "Status"
        ),
        fine.cast("int").alias("Fine Amount"),
        e.alias(SEQ),
    )


def citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_citations(citations_raw(spark, sf_dir), RULES, [SEQ])


# Names that the default rules know, and times around the bounds of their semesters, written out anew: a change
# of the defaults shows in the results.
KNOWN_TYPES = (
    "Area Not Designed For Parking", "Boot Fee", "Failed To Pay At Visitor Lot", "Fire Lane - Blocking/Impeding",
    "No Valid Permit", "Parked In Dedicated Space", "Parked In Loading Zone", "Parked In Tow Zone",
    "Parked In Wrong Direction", "Tow Fee", "Unauthorized Use of Permit", "Not Parked Between Lines",
    "Not In Assigned Area", "Parking For Clinic Patients Only", "Abandoned Vehicle", "Backed In/Pulled Through Space",
    "Expired Permit", "Expired Hourly Parking", "No License Plate Displayed", "Parked In Visitor Space",
    "DO NOT USE/TESTING", "Something else",
)
EDGES = (
    "2025-07-31 23:59:59", "2025-08-01 00:00:00", "2025-12-31 00:00:00", "2025-12-31 00:00:01", "2026-01-01 00:00:00",
    "2026-05-31 00:00:00", "2026-05-31 00:00:01", "2025-10-10 10:10:10",
)
AMOUNTS = (35, 50, 60, 0, 40, -5)


def ruled_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw citation per event, of every known type with every amount, at the semesters' bounds."""
    e = F.col("event_id")

    def one_of(values, number):
        return F.get(F.array(*map(F.lit, values)), (number % len(values)).cast("int"))

    return table(spark, sf_dir, "events").select(
        e.cast("string").alias("citation_id"),
        one_of(EDGES, e).cast("timestamp_ntz").alias("Timestamp"),
        F.lit("Lot").alias("Location"),
        F.lit("North").alias("Campus"),
        one_of(KNOWN_TYPES, F.floor(e / 6)).alias("Violation Type"),
        one_of(("Unpaid", "Transfer", "Paid", "Zero Balance", "Inactive", "Void", "Appealed"), e).alias("Status"),
        one_of(AMOUNTS, e).cast("int").alias("Fine Amount"),
        e.alias(SEQ),
    )


def readings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One weather reading per event: many per day, with NULL, NaN, negative and unknown values."""
    e, v = F.col("event_id"), F.col("value")
    code = F.get(F.array(*map(F.lit, CODES)), (e % 7).cast("int"))
    return table(spark, sf_dir, "events").select(
        F.date_add(F.to_date("ts"), 3).cast("string").alias("date"),
        _campus().alias("campus"),
        F.when(e % 17 == 5, F.lit(float("nan")))
        .when(e % 13 != 4, v * 1.237 + 40.0)
        .alias("temperature_2m_max"),
        F.when(e % 19 != 2, v * 0.337).alias("temperature_2m_min"),
        F.when(e % 5 == 0, 0.0)
        .when(e % 97 == 1, -0.5)
        .when(e % 11 != 3, (e * 7 % 23).cast("double") * 0.873)
        .alias("precipitation_sum"),
        F.when(e % 89 != 0, code).alias("weathercode"),
        e.alias(SEQ),
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_weather(readings_raw(spark, sf_dir), keep=[SEQ])


def weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day and campus, three days later than the citations: some days have no weather,
    some weather days have no citations."""
    n = F.count(F.lit(1))
    code = F.get(F.array(*map(F.lit, CODES)), (F.sum("event_id") % 7).cast("int"))
    return (
        table(spark, sf_dir, "events")
        .withColumns({"campus": _campus(), "day": F.date_add(F.to_date("ts"), 3)})
        .groupBy("day", "campus")
        .agg(
            F.max("value").alias("temperature_2m_max"),
            F.min("value").alias("temperature_2m_min"),
            F.when(n % 5 == 0, 0.0)
            .when(n % 11 != 3, (n * 7 % 23).cast("double") * 0.873)
            .alias("precipitation_sum"),
            code.alias("weathercode"),
            F.max("event_id").alias(SEQ),
        )
        .select(
            F.col("day").cast("string").alias("date"), "campus", *WEATHER_VARIABLES, SEQ
        )
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_weather(weather_raw(spark, sf_dir), keep=[SEQ])


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload per embedding: its four quarters are the measures of as many days as they hold.

    Every seventh has no precipitation array, every eleventh no time axis, every thirteenth a
    temperature array that is one element short.
    """
    i = F.col("vec_id")
    days = (F.size("embedding") / 4).cast("int")
    start = F.date_add(F.lit("2024-01-01").cast("date"), (i % 40).cast("int"))

    def part(quarter, length=days):
        return F.slice("embedding", days * quarter + 1, length)

    def doubles(values):
        return F.transform(values, lambda x: x.cast("double"))

    short = F.when(i % 13 == 3, days - 1).otherwise(days)
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id"),
        F.concat(F.lit("Station "), (i % 5).cast("string")).alias("campus"),
        F.struct(
            F.when(
                i % 11 != 5,
                F.transform(F.sequence(F.lit(0), days - 1),
                            lambda d: F.date_add(start, d).cast("string")),
            ).alias("time"),
            doubles(part(0, short)).alias("temperature_2m_max"),
            doubles(part(1)).alias("temperature_2m_min"),
            F.when(i % 7 != 2, doubles(part(2))).alias("precipitation_sum"),
            F.transform(part(3), lambda x: F.floor(F.abs(x) * 100).cast("int")).alias(
                "weathercode"
            ),
        ).alias("daily"),
    )


def shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One range per order within the citations' month: some of seconds, some of weeks, thousands at a time. Every
    ninth starts and ends at midnight; some have no end, some end before they start."""
    i = F.col("o_orderkey")
    start = F.timestamp_add("SECOND", i * 7919 % 2_592_000, F.lit("2024-01-01").cast("timestamp_ntz"))
    length = F.when(i % 5 == 0, i * 31 % 1_000_000).when(i % 2 == 0, i * 13 % 90).otherwise(i * 17 % 5_000)
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("Shift "), (i % 1000).cast("string")).alias("label"),
        F.when(i % 9 == 0, F.date_trunc("day", start).cast("timestamp_ntz")).otherwise(start).alias("start"),
        (i * 104_729 % 1_000_003).alias("position"),
        F.when(i % 23 == 4, -length).otherwise(length).alias("length"),
        i,
    )
    end = F.timestamp_add("SECOND", F.col("length"), F.col("start"))
    return rows.select(
        "label", "start", "position",
        F.when(i % 31 == 7, F.lit(None))
        .when(i % 9 == 0, F.date_trunc("day", end).cast("timestamp_ntz"))
        .otherwise(end)
        .alias("end"),
    )


def insert_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(stored citations, batch): stored is the first half of the month, so that half of the ids are
    new; the batch is of all citations, each delivered again, then with a later status, then all of them
    under one and the same id. Every row takes part on one side or both."""
    rows = citations(spark, sf_dir)
    copy = F.col("copy")
    batch = rows.withColumn(
        "copy", F.explode(F.array(F.lit("same"), F.lit("late"), F.lit("hot")))
    ).withColumns(
        {
            "citation_id": F.when(copy == "hot", "hot").otherwise(F.col("citation_id")),
            "status": F.when(copy == "late", "Late change").otherwise(F.col("status")),
            SEQ: F.col(SEQ)
            + F.when(copy == "late", 10**15).when(copy == "hot", 2 * 10**15).otherwise(0),
        }
    )
    return rows.filter(F.col("semester") == "First half").drop(SEQ), batch.drop("copy")


def replace_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(stored weather, batch): the batch is every reading, 15 days later. It has many rows per
    key, of which the last one counts; about half of its keys are stored."""
    later = readings(spark, sf_dir).withColumn("date", F.date_add("date", 15))
    return weather(spark, sf_dir).drop(SEQ), later
