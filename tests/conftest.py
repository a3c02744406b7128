import sys
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from checks.compare import session
from checks.tables import remove_scratch
from ticketmill import schemas
from ticketmill.operators.citations import clean_citations
from ticketmill.operators.weather import clean_weather

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    spark = session()
    yield spark
    remove_scratch(spark)
    spark.stop()


@pytest.fixture(scope="session")
def raw(spark):
    """Raw citations from (id, timestamp, location, campus, type, status, fine) tuples."""
    schema = (
        "citation_id string, Timestamp timestamp_ntz, Location string, Campus string, "
        "`Violation Type` string, Status string, `Fine Amount` int, _seq int"
    )

    def make(*rows):
        def ts(value):
            return datetime.fromisoformat(value) if isinstance(value, str) else value

        return spark.createDataFrame(
            [(r[0], ts(r[1]), *r[2:], i) for i, r in enumerate(rows)], schema
        )

    return make


@pytest.fixture(scope="session")
def citations(raw):
    return lambda *rows: clean_citations(raw(*rows), keep=["_seq"])


@pytest.fixture(scope="session")
def raw_weather(spark):
    """Raw weather from (date, campus, high, low, precipitation, code) tuples."""
    schema = T.StructType([*schemas.RAW_WEATHER, T.StructField("_seq", T.IntegerType())])
    return lambda *rows: spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], schema)


@pytest.fixture(scope="session")
def weather(raw_weather):
    return lambda *rows: clean_weather(raw_weather(*rows), keep=["_seq"])


def day(text):
    return date.fromisoformat(text)
