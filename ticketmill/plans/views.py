from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def register_views(citations: DataFrame, weather: DataFrame) -> None:
    """Views `citations` and `daily_weather` for spark.sql.

    Flags are shown as 0 / 1, so SQL written as `is_credit_adjustment = 0` runs; Spark turns that
    back into a test of the stored boolean, which Parquet can evaluate.
    """
    flags = ("is_credit_adjustment", "fine_validated")
    citations.withColumns({f: F.col(f).cast("int") for f in flags}).createOrReplaceTempView(
        "citations"
    )
    weather.createOrReplaceTempView("daily_weather")
