import pytest
from pyspark.sql import functions as F

from tests.conftest import day
from ticketmill import schemas
from ticketmill.operators.weather import clean_weather, parse_date

NAN = float("nan")


def test_traced_record(weather):
    r = weather(("2025-09-15", "Kennesaw", 87.2999999, 65.04, 0.0, 3)).first()
    assert r.date == day("2025-09-15") and r.temperature_2m_max == 87.3
    assert (r.temperature_2m_min, r.precipitation_sum) == (65.0, 0.0)
    assert (r.condition_label, r.precip_bucket) == ("Overcast", "None")


def test_contract_columns_and_types(raw_weather):
    clean = clean_weather(raw_weather(("2025-09-15", "Kennesaw", 1.0, 1.0, 0.0, 3)))
    assert [(f.name, f.dataType) for f in clean.schema] == [
        (f.name, f.dataType) for f in schemas.WEATHER
    ]


@pytest.mark.parametrize("missing", [None, NAN])
def test_missing_precipitation_is_dry_and_missing_temperature_stays(weather, missing):
    r = weather(("2025-09-15", "Kennesaw", missing, missing, missing, None)).first()
    assert (r.temperature_2m_max, r.temperature_2m_min) == (None, None)
    assert (r.precipitation_sum, r.precip_bucket) == (0.0, "None")
    assert r.condition_label == "Unknown"


def test_bucket_uses_the_rounded_value(weather):
    amounts = (0.004, 0.01, 5.004, 5.01, 15.02)
    rows = weather(*(("2025-09-15", "K", 1.0, 1.0, p, 0) for p in amounts))
    assert [r.precip_bucket for r in rows.collect()] == [
        "None", "Light", "Light", "Moderate", "Heavy",
    ]


def test_unknown_code(weather):
    assert weather(("2025-09-15", "K", 1.0, 1.0, 0.0, 42)).first().condition_label == "Unknown"


def test_bad_date_fails_or_becomes_null(spark, raw_weather):
    bad = raw_weather(("2025-13-01", "K", 1.0, 1.0, 0.0, 0))
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(Exception, match="date is not a date: 2025-13-01"):
                clean_weather(bad).collect()
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")
    assert parse_date(bad, strict=False).select(F.col("date").isNull()).first()[0]
