"""Row-wise cleaning of daily weather. No step here shuffles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill import schemas
from ticketmill.functions.labels import bucket_label, lookup
from ticketmill.functions.numeric import null_if_nan, round_half_even
from ticketmill.settings import UNKNOWN, WeatherRules

DECIMAL_PLACES = {"temperature_2m_max": 1, "temperature_2m_min": 1, "precipitation_sum": 2}


def parse_date(df: DataFrame, column: str = "date", strict: bool = True) -> DataFrame:
    """ISO text to date. A bad value fails the job, or becomes NULL if not strict."""
    text = F.col(column)
    parsed = F.try_to_date(text, "yyyy-MM-dd")
    if strict:
        # Said outright, so that it does not depend on the ANSI mode of the session.
        bad = text.isNotNull() & parsed.isNull()
        failure = F.raise_error(F.concat(F.lit(f"{column} is not a date: "), text))
        parsed = F.when(bad, failure).otherwise(parsed)
    return df.withColumn(column, parsed)


def round_measures(df: DataFrame, places: Mapping[str, int]) -> DataFrame:
    """Round half to even; NaN counts as missing."""
    return df.withColumns(
        {c: round_half_even(null_if_nan(F.col(c)), n) for c, n in places.items()}
    )


def fill_missing(df: DataFrame, column: str, value: float) -> DataFrame:
    return df.withColumn(column, F.coalesce(null_if_nan(F.col(column)), F.lit(value)))


def label_codes(
    df: DataFrame,
    labels: Mapping[int, str],
    code: str = "weathercode",
    label: str = "condition_label",
) -> DataFrame:
    return df.withColumn(label, lookup(F.col(code), labels, UNKNOWN))


def add_bucket(
    df: DataFrame,
    zero_label: str,
    upper_bounds: Sequence[tuple[float, str]],
    default: str,
    column: str = "precipitation_sum",
    bucket: str = "precip_bucket",
) -> DataFrame:
    return df.withColumn(bucket, bucket_label(F.col(column), zero_label, upper_bounds, default))


def clean_weather(
    raw: DataFrame, rules: WeatherRules = WeatherRules(), keep: Sequence[str] = ()
) -> DataFrame:
    """Raw daily weather to the 8 contract columns, followed by the `keep` columns."""
    return (
        raw.transform(parse_date)
        .transform(round_measures, DECIMAL_PLACES)
        .transform(fill_missing, "precipitation_sum", 0.0)
        .transform(label_codes, rules.code_labels)
        .transform(add_bucket, rules.dry_label, rules.upper_bounds, rules.wettest_label)
        .select(*schemas.WEATHER.names, *keep)
    )
