"""Sums that the six table reports are made of, kept for each month of the stored citations.

A report adds up four measures over a few keys, so its sums over a month can be added to those of other months.
They are kept in a table with one partition a month, which holds the groups of each report. A load first takes the
months it touches out of that table, then appends its citations; what has no sums by then is made anew from the
stored rows, and only those months are read. So a load that breaks off in between leaves months without
sums, never with old ones, and the next renewal makes them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmill import schemas
from ticketmill.plans.reports import MEASURES, with_measures
from ticketmill.sources.scans import read_table
from ticketmill.sources.versions import names_in, newest, read_versions, replace_partitions

MONTH = "_month"
REPORT = "report"
CREDIT = "is_credit_adjustment"

#: What each report groups its rows by; credits are told apart in all of them.
REPORT_KEYS = {
    "violations_by_type": ("violation_type",),
    "monthly_volume_by_campus": ("semester", "year", "month", "campus"),
    "top_locations": ("campus", "location"),
    "status_breakdown": ("semester", "status"),
    "hourly_patterns": ("hour", "campus"),
    "weather_citation_correlation": ("date", "campus"),
}
KEYS = tuple(dict.fromkeys(key for keys in REPORT_KEYS.values() for key in keys))

PARTIALS = T.StructType(
    [T.StructField(REPORT, T.StringType())]
    + [schemas.CITATIONS[name] for name in (CREDIT, *KEYS)]
    + [T.StructField(m, T.LongType()) for m in MEASURES]
)


def month_name(year: Column, month: Column) -> Column:
    return F.concat(F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"))


def month_sums(citations: DataFrame) -> DataFrame:
    """The groups of each report in each month, in one scan: Spark adds up all grouping sets side by side."""
    columns = (MONTH, CREDIT, *KEYS)
    names = {}
    for name, keys in REPORT_KEYS.items():
        absent = [column not in (MONTH, CREDIT, *keys) for column in columns]
        names[int("".join("01"[a] for a in absent), 2)] = name
    report = F.lit(None).cast("string")
    for number, name in names.items():
        report = F.when(F.col("_set") == number, F.lit(name)).otherwise(report)
    rows = with_measures(citations).withColumn(MONTH, month_name(F.col("year"), F.col("month")))
    sets = [[F.col(c) for c in (MONTH, CREDIT, *keys)] for keys in REPORT_KEYS.values()]
    sums = rows.groupingSets(sets, *columns).agg(
        F.grouping_id().alias("_set"), *(F.sum(m).cast("long").alias(m) for m in MEASURES)
    )
    return sums.select(MONTH, report.alias(REPORT), CREDIT, *KEYS, *MEASURES)


def sums_of(partials: DataFrame, report: str) -> DataFrame:
    """The rows of one report: what its function takes instead of citations."""
    return partials.filter(F.col(REPORT) == report).select(*REPORT_KEYS[report], CREDIT, *MEASURES)


def stored_months(spark: SparkSession, citations: str) -> set[str]:
    """The months that the stored citations have, by the names of their folders."""
    found = set()
    for year in names_in(spark, citations):
        if year.startswith("year="):
            months = names_in(spark, f"{citations}/{year}")
            found |= {f"{int(year[5:]):04}{int(m[6:]):02}" for m in months if m.startswith("month=")}
    return found


def forget_months(spark: SparkSession, path: str, months: Iterable[str]) -> None:
    """Take the sums of these months out of the table."""
    known = set(months) & newest(spark, path)[1].keys()
    replace_partitions(spark, path, PARTIALS, MONTH, known, lambda rows: rows.limit(0).withColumn(MONTH, F.lit("")))


def renew_months(spark: SparkSession, path: str, citations: str) -> set[str]:
    """Make the sums of all stored months that have none; return these months. Others are not read."""
    lacking = stored_months(spark, citations) - newest(spark, path)[1].keys()
    stored = read_table(spark, citations, schemas.CITATIONS) if lacking else None

    def made(_: DataFrame) -> DataFrame:
        numbers = [int(m) for m in sorted(lacking)]
        return month_sums(stored.filter((F.col("year") * 100 + F.col("month")).isin(numbers)))

    replace_partitions(spark, path, PARTIALS, MONTH, lacking, made)
    return lacking


def read_sums(spark: SparkSession, path: str) -> DataFrame:
    return read_versions(spark, path, PARTIALS)
