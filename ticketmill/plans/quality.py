"""Data-quality metrics, each set computed in one scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketmill import schemas
from ticketmill.functions.labels import bucket_label, lookup
from ticketmill.functions.numeric import null_if_nan, round_half_even
from ticketmill.operators.citations import enrich_citations, not_in
from ticketmill.settings import UNKNOWN, CitationRules, WeatherRules


def _metrics(one_row: DataFrame) -> DataFrame:
    """(metric, value) rows from one wide row of counts; counts over no rows are 0."""
    counts = one_row.select(
        *(F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in one_row.columns)
    )
    return counts.unpivot([], counts.columns, "metric", "value")


def citation_quality(raw: DataFrame, rules: CitationRules = CitationRules()) -> DataFrame:
    """Counts before and after cleaning.

    Rows are counted per campus, type, location and semester first. The distinct counts then run
    over those groups, not over the rows, which Spark would copy once per distinct count.
    """
    dims = ("campus", "violation_type", "location", "semester")
    clean = ~F.col("_excluded")
    tagged = raw.withColumn(
        "_excluded", ~not_in(F.col("Violation Type"), rules.excluded_types)
    ).transform(enrich_citations, rules)

    def rows(condition):
        return F.count_if(clean & condition)

    grouped = tagged.groupBy("_excluded", *dims).agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(~clean).alias("removed_rows"),
        F.count_if(clean).alias("clean_rows"),
        rows(F.col("is_credit_adjustment")).alias("credit_rows"),
        rows(F.col("fine_amount") == 0).alias("zero_fine_rows"),
        rows(~F.col("fine_validated")).alias("validation_failures"),
        rows(F.col("citation_id").isNull()).alias("null_citation_ids"),
        rows(F.col("timestamp").isNull()).alias("null_timestamps"),
    )
    sums = [c for c in grouped.columns if c not in ("_excluded", *dims)]
    labelled = F.col("semester") != UNKNOWN
    return _metrics(
        grouped.agg(
            *(F.sum(c).alias(c) for c in sums),
            F.sum(F.when(F.col("campus").isNull(), F.col("clean_rows"))).alias("null_campuses"),
            F.sum(F.when(~labelled, F.col("clean_rows"))).alias("unknown_semester_rows"),
            F.count_distinct(F.when(clean, F.col("campus"))).alias("distinct_campuses"),
            F.count_distinct(F.when(clean, F.col("violation_type"))).alias("distinct_types"),
            F.count_distinct(F.when(clean, F.col("location"))).alias("distinct_locations"),
            F.count_distinct(F.when(clean & labelled, F.col("semester"))).alias(
                "distinct_semesters"
            ),
        )
    )


def weather_quality(raw: DataFrame, rules: WeatherRules = WeatherRules()) -> DataFrame:
    """Missing values and unknown codes before filling, rows per bucket after it, and the first and
    last date as numbers like 20250915 (0 without any)."""

    def missing(column):
        return null_if_nan(F.col(column)).isNull()

    precip = F.coalesce(round_half_even(null_if_nan(F.col("precipitation_sum")), 2), F.lit(0.0))
    bucket = bucket_label(precip, rules.dry_label, rules.upper_bounds, rules.wettest_label)
    label = lookup(F.col("weathercode"), rules.code_labels, UNKNOWN)
    return _metrics(
        raw.agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(missing("precipitation_sum")).alias("null_precipitation"),
            (
                F.count_if(missing("temperature_2m_max"))
                + F.count_if(missing("temperature_2m_min"))
            ).alias("null_temperatures"),
            F.count_if(label == UNKNOWN).alias("unknown_codes"),
            *(F.count_if(bucket == b).alias(f"bucket_{b.lower()}") for b in rules.buckets),
            *(
                F.date_format(extreme(F.expr("try_cast(date AS date)")), "yyyyMMdd")
                .cast("bigint")
                .alias(f"{name}_date")
                for name, extreme in (("first", F.min), ("last", F.max))
            ),
        )
    )


def bucket_counts(weather: DataFrame, bucket: str = "precip_bucket") -> DataFrame:
    return (
        weather.groupBy(bucket)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .orderBy(F.desc("n_rows"), bucket)
    )


def missing_keys(
    fact: DataFrame, dimension: DataFrame, keys: Sequence[str] = schemas.WEATHER_KEY
) -> DataFrame:
    """Keys that the fact rows use and the dimension lacks."""
    return fact.select(*keys).distinct().join(dimension.select(*keys), list(keys), "left_anti")


def gap_ranges(keys: DataFrame, date: str = "date", by: Sequence[str] = ("campus",)) -> DataFrame:
    """Keys as ranges of days that follow each other: (by, first_date, last_date, days). Repeated keys count once, NULL
    dates are left out, and a NULL in `by` is a group like others. Dates less their rank are equal within a
    range, so an aggregate finds it; a window sees each day of a group once."""
    days = keys.filter(F.col(date).isNotNull()).select(*by, date).distinct()
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(date))
    ranges = days.withColumn("_island", F.date_sub(date, rank)).groupBy(*by, "_island")
    return ranges.agg(
        F.min(date).alias("first_date"), F.max(date).alias("last_date"), F.count(F.lit(1)).alias("days")
    ).drop("_island")


def day_bitmaps(df: DataFrame, by: Sequence[str], date: str = "date") -> DataFrame:
    """The days of each group as bitmaps over day numbers: (by, chunk, days), one row for each 32,768 days that a
    group has any of. Unlike distinct counts, these can be kept and merged. NULL dates are left out."""
    day = F.datediff(date, F.lit("1970-01-01").cast("date"))
    return (
        df.filter(F.col(date).isNotNull())
        .groupBy(*by, F.bitmap_bucket_number(day).alias("chunk"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(day)).alias("days"))
    )


def merge_bitmaps(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bitmaps of fewer or the same groups, from those of any number of loads or finer groups."""
    return bitmaps.groupBy(*by, "chunk").agg(F.bitmap_or_agg("days").alias("days"))


def count_days(bitmaps: DataFrame, by: Sequence[str], name: str = "days") -> DataFrame:
    """Distinct days of each group, from bitmaps that may still be in parts."""
    return merge_bitmaps(bitmaps, by).groupBy(*by).agg(F.sum(F.bitmap_count("days")).alias(name))


def join_coverage(
    fact: DataFrame, dimension: DataFrame, keys: Sequence[str] = schemas.WEATHER_KEY
) -> DataFrame:
    """One row: keys in the fact, those the dimension has, and their share."""
    known = dimension.select(*keys).distinct().withColumn("_known", F.lit(True))
    used = fact.select(*keys).distinct().join(known, list(keys), "left")
    matched = F.count_if(F.col("_known"))
    return used.agg(
        F.count(F.lit(1)).alias("fact_keys"),
        matched.alias("matched_keys"),
        F.try_divide(matched.cast("double"), F.count(F.lit(1))).alias("coverage"),
    )


def anomalies(citations: DataFrame) -> DataFrame:
    """Rows that failed validation, by type and amount."""
    return (
        citations.filter(~F.col("fine_validated"))
        .groupBy("violation_type", "fine_amount")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .orderBy(F.desc("n_rows"), "violation_type", "fine_amount")
    )
