"""Row-wise cleaning of citations. No step here shuffles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill import schemas
from ticketmill.functions.labels import lookup, range_label, weekday_name
from ticketmill.functions.numeric import is_true
from ticketmill.functions.text import strip
from ticketmill.settings import UNKNOWN, CitationRules

TRIMMED = ("violation_type", "status", "location", "campus")


def not_in(col: Column, values: Sequence) -> Column:
    """True also for NULL. Written so that Parquet can evaluate it (a coalesce would not push)."""
    if not values:
        return F.lit(True)
    return col.isNull() | ~col.isin(*values)


def exclude_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(not_in(F.col(column), values))


def trim_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: strip(F.col(c)) for c in columns})


def flag_negative(df: DataFrame, amount: str, flag: str) -> DataFrame:
    """A negative amount is a credit: keep the row, mark it."""
    return df.withColumn(flag, is_true(F.col(amount) < 0))


def validate_amount(
    df: DataFrame,
    schedule: Mapping[str, int],
    zero_statuses: Sequence[str],
    category: str = "violation_type",
    status: str = "status",
    amount: str = "fine_amount",
    credit: str = "is_credit_adjustment",
    flag: str = "fine_validated",
) -> DataFrame:
    """Mark rows whose amount is the scheduled one, whose status excuses it, or that are credits."""
    scheduled = is_true(F.col(amount) == lookup(F.col(category), schedule))
    excused = is_true(F.col(status).isin(*zero_statuses))
    return df.withColumn(flag, excused | scheduled | F.col(credit))


def add_calendar(df: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    ts = F.col(timestamp)
    day = F.to_date(ts)
    return df.withColumns(
        {
            "date": day,
            "year": F.year(ts),
            "month": F.month(ts),
            "day_of_week": weekday_name(day),
            "hour": F.hour(ts),
        }
    )


def label_period(
    df: DataFrame,
    ranges: Sequence[tuple[str, str, str]],
    timestamp: str = "timestamp",
    label: str = "semester",
    whole_last_day: bool = False,
) -> DataFrame:
    return df.withColumn(label, range_label(F.col(timestamp), ranges, UNKNOWN, whole_last_day))


def enrich_citations(raw: DataFrame, rules: CitationRules) -> DataFrame:
    """Every cleaning step but the exclusion, which must see the untrimmed category."""
    return (
        raw.withColumnsRenamed(schemas.CLEAN_NAMES)
        .transform(trim_columns, TRIMMED)
        .transform(flag_negative, "fine_amount", "is_credit_adjustment")
        .transform(validate_amount, rules.schedule, rules.zero_fine_statuses)
        .transform(add_calendar)
        .transform(label_period, rules.semesters, whole_last_day=rules.whole_last_day)
    )


def clean_citations(
    raw: DataFrame, rules: CitationRules = CitationRules(), keep: Sequence[str] = ()
) -> DataFrame:
    """Raw citations to the 15 contract columns, followed by the `keep` columns."""
    return (
        raw.transform(exclude_values, "Violation Type", rules.excluded_types)
        .transform(enrich_citations, rules)
        .select(*schemas.CITATIONS.names, *keep)
    )
