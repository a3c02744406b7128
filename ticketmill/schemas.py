"""Column contracts of the raw, clean and stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw columns carry the names of the source file, including the space after "Citation ID".
RAW_CITATIONS = T.StructType(
    [
        T.StructField("Citation ID ", T.StringType()),
        T.StructField("Timestamp", T.TimestampNTZType()),
        T.StructField("Location", T.StringType()),
        T.StructField("Campus", T.StringType()),
        T.StructField("Violation Type", T.StringType()),
        T.StructField("Status", T.StringType()),
        T.StructField("Fine Amount", T.IntegerType()),
    ]
)

ID_HEADER = "Citation ID "

CLEAN_NAMES = {
    "Timestamp": "timestamp",
    "Location": "location",
    "Campus": "campus",
    "Violation Type": "violation_type",
    "Status": "status",
    "Fine Amount": "fine_amount",
}

CITATIONS = T.StructType(
    [
        T.StructField("citation_id", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("date", T.DateType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day_of_week", T.StringType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("campus", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("violation_type", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("fine_amount", T.IntegerType()),
        T.StructField("is_credit_adjustment", T.BooleanType()),
        T.StructField("fine_validated", T.BooleanType()),
        T.StructField("semester", T.StringType()),
    ]
)

CITATION_KEY = "citation_id"
CITATION_REQUIRED = ("timestamp", "campus", "violation_type", "status", "fine_amount")

WEATHER_VARIABLES = {
    "temperature_2m_max": T.DoubleType(),
    "temperature_2m_min": T.DoubleType(),
    "precipitation_sum": T.DoubleType(),
    "weathercode": T.IntegerType(),
}

# One payload per campus: parallel arrays, one element per day.
WEATHER_PAYLOAD = T.StructType(
    [
        T.StructField(
            "daily",
            T.StructType(
                [T.StructField("time", T.ArrayType(T.StringType()))]
                + [T.StructField(n, T.ArrayType(t)) for n, t in WEATHER_VARIABLES.items()]
            ),
        )
    ]
)

RAW_WEATHER = T.StructType(
    [T.StructField("date", T.StringType()), T.StructField("campus", T.StringType())]
    + [T.StructField(n, t) for n, t in WEATHER_VARIABLES.items()]
)

WEATHER = T.StructType(
    [T.StructField("date", T.DateType()), T.StructField("campus", T.StringType())]
    + [T.StructField(n, t) for n, t in WEATHER_VARIABLES.items()]
    + [
        T.StructField("condition_label", T.StringType()),
        T.StructField("precip_bucket", T.StringType()),
    ]
)

WEATHER_KEY = ("date", "campus")

# Position of a row in its source: decides which of two rows with one key came first.
SEQ = "_seq"

# One row for each id of a batch, with the number of rows that had it; incomplete rows as they came.
STAGED_CITATIONS = T.StructType(
    [*CITATIONS, T.StructField(SEQ, T.StringType()), T.StructField("copies", T.LongType()),
     T.StructField("complete", T.BooleanType())]
)
