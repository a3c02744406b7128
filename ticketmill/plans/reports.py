"""The eight reports.

Each report is a sum of four row measures over some keys, so it takes citations or a roll-up() of
them alike. Aggregation always comes before the join with weather: a task then sends one row per
day, campus (and hour), however many citations a day has, and both join sides are small.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketmill.functions.numeric import positive, positive_or_zero, ratio, weighted_mean

ROLLUP_KEYS = (
    "semester", "year", "month", "date", "hour", "campus", "location", "violation_type",
    "status", "is_credit_adjustment",
)
MEASURES = ("n_rows", "n_ids", "fines", "n_fines")


def with_measures(citations: DataFrame) -> DataFrame:
    """Citations with their measures; a roll-up has them and is returned as it is."""
    if set(MEASURES) <= set(citations.columns):
        return citations
    fine = F.col("fine_amount")
    return citations.withColumns(
        {
            "n_rows": F.lit(1),
            "n_ids": F.when(F.col("citation_id").isNotNull(), 1).otherwise(0),
            "fines": positive_or_zero(fine),
            "n_fines": F.when(positive(fine).isNotNull(), 1).otherwise(0),
        }
    )


def rollup(citations: DataFrame) -> DataFrame:
    """All reports in one scan of the citations: store this, then report from it."""
    return (
        with_measures(citations)
        .groupBy(*ROLLUP_KEYS)
        .agg(*(F.sum(m).alias(m) for m in MEASURES))
    )


def without_credits(citations: DataFrame) -> DataFrame:
    return citations.filter(~F.col("is_credit_adjustment"))


def _billable(citations: DataFrame) -> DataFrame:
    return with_measures(without_credits(citations))


def _count(name: str = "citation_count") -> Column:
    return F.sum("n_rows").alias(name)


def _fines(name: str) -> Column:
    return F.sum("fines").alias(name)


def _avg_fine() -> Column:
    return ratio(F.sum("fines"), F.sum("n_fines"), 2).alias("avg_fine")


def violations_by_type(citations: DataFrame) -> DataFrame:
    return (
        _billable(citations)
        .groupBy("violation_type")
        .agg(_count(), _fines("total_fines_collected"), _avg_fine())
    )


def monthly_volume_by_campus(citations: DataFrame) -> DataFrame:
    return (
        _billable(citations)
        .groupBy("semester", "year", "month", "campus")
        .agg(_count(), _fines("monthly_revenue"))
    )


def top_locations(citations: DataFrame, k: int = 20) -> DataFrame:
    """The k busiest locations over all campuses; ties go by campus and location."""
    return (
        _billable(citations)
        .groupBy("campus", "location")
        .agg(_count(), _fines("total_fines"))
        .orderBy(F.desc("citation_count"), "campus", "location")
        .limit(k)
    )


def status_breakdown(citations: DataFrame) -> DataFrame:
    """Share of each status in its semester, credits included."""
    n = F.col("citation_count")
    of_semester = F.sum(n).over(Window.partitionBy("semester"))
    return (
        with_measures(citations)
        .groupBy("semester", "status")
        .agg(_count())
        .withColumn("pct_of_semester", ratio(F.lit(100.0) * n, of_semester, 2))
    )


def hourly_patterns(citations: DataFrame) -> DataFrame:
    return _billable(citations).groupBy("hour", "campus").agg(_count())


def weather_citation_correlation(citations: DataFrame, weather: DataFrame) -> DataFrame:
    """Citations per bucket, condition and campus, keeping weather days without citations.

    The averages are over the rows of weather LEFT JOIN citations: a day counts once per citation,
    and once if it has none. Summed per day first, so that weight is a column, not a fan-out.
    """
    daily = (
        _billable(citations)
        .groupBy("date", "campus")
        .agg(*(F.sum(m).alias(m) for m in ("n_rows", "n_ids", "fines")))
    )
    weight = F.greatest(F.coalesce("n_rows", F.lit(0)), F.lit(1))
    return (
        weather.join(daily, ["date", "campus"], "left")
        .groupBy("precip_bucket", "condition_label", "campus")
        .agg(
            F.sum(F.coalesce("n_ids", F.lit(0))).alias("citation_count"),
            F.sum(F.coalesce("fines", F.lit(0))).alias("total_fines"),
            weighted_mean(F.col("temperature_2m_max"), weight, 1).alias("avg_high_temp_f"),
            weighted_mean(F.col("precipitation_sum"), weight, 2).alias("avg_precipitation_mm"),
        )
    )


def violation_summary(citations: DataFrame) -> DataFrame:
    """As violations_by_type, by campus. Rows without an id are not counted, but their fines are."""
    return (
        _billable(citations)
        .groupBy("violation_type", "campus")
        .agg(
            F.sum("n_ids").alias("citation_count"),
            _fines("total_fines_collected"),
            _avg_fine(),
        )
    )


def weather_hourly(citations: DataFrame, weather: DataFrame) -> DataFrame:
    """Citations per hour and bucket, and per day that has any in that hour and bucket."""
    hourly = (
        _billable(citations).groupBy("date", "campus", "hour").agg(F.sum("n_ids").alias("n_ids"))
    )
    return (
        hourly.join(weather.select("date", "campus", "precip_bucket"), ["date", "campus"], "left")
        .groupBy("hour", "precip_bucket")
        .agg(
            F.sum("n_ids").alias("citation_count"),
            F.count_distinct("date").alias("days_in_bucket"),
        )
        .withColumn(
            "avg_citations_per_day",
            ratio(F.col("citation_count"), F.col("days_in_bucket"), 2),
        )
    )


@dataclass(frozen=True)
class Report:
    """A named report. `order` is its row order; group keys break ties."""

    name: str
    build: Callable[..., DataFrame]
    order: Sequence[str]
    uses_weather: bool = False

    def sort_columns(self) -> list[Column]:
        return [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in self.order]

    def rows(self, citations: DataFrame, weather: DataFrame | None = None) -> DataFrame:
        return self.build(citations, weather) if self.uses_weather else self.build(citations)

    def frame(self, citations: DataFrame, weather: DataFrame | None = None) -> DataFrame:
        return self.rows(citations, weather).orderBy(*self.sort_columns())


# Reports over the stored tables.
TABLE_REPORTS = (
    Report("violations_by_type", violations_by_type, ("-citation_count", "violation_type")),
    Report(
        "monthly_volume_by_campus",
        monthly_volume_by_campus,
        ("year", "month", "campus", "semester"),
    ),
    Report("top_locations", top_locations, ("-citation_count", "campus", "location")),
    Report("status_breakdown", status_breakdown, ("semester", "-citation_count", "status")),
    Report("hourly_patterns", hourly_patterns, ("hour", "campus")),
    Report(
        "weather_citation_correlation",
        weather_citation_correlation,
        ("-citation_count", "precip_bucket", "condition_label", "campus"),
        uses_weather=True,
    ),
)

# Reports over the clean zone of the current batch, before it is merged.
ZONE_REPORTS = (
    Report(
        "violation_summary_spark",
        violation_summary,
        ("-citation_count", "violation_type", "campus"),
    ),
    Report(
        "weather_hourly_spark", weather_hourly, ("hour", "precip_bucket"), uses_weather=True
    ),
)
