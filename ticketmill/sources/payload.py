"""Payloads of parallel arrays to one row per day, and the dates to ask for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmill import schemas
from ticketmill.settings import CAMPUSES
from ticketmill.sources.scans import CORRUPT


def _arrays(df: DataFrame, payload: str) -> dict[str, Column | None]:
    """Array column per weather variable; None where the payload type does not have it."""
    field = df.schema[payload].dataType
    present = field.names if isinstance(field, T.StructType) else []
    return {
        name: F.col(f"{payload}.{name}") if name in present else None
        for name in schemas.WEATHER_VARIABLES
    }


def payload_problem(df: DataFrame, payload: str = "daily") -> Column:
    """Why a payload cannot be flattened, NULL if it can.

    A variable that is missing altogether is no problem: its column is NULL.
    """
    time = F.col(f"{payload}.time")
    problem = F.when(time.isNull(), F.lit("payload has no time axis"))
    for name, values in _arrays(df, payload).items():
        if values is not None:
            uneven = values.isNotNull() & (F.size(values) != F.size(time))
            problem = problem.when(uneven, F.lit(f"{name} and time differ in length"))
    return problem


def flatten_payloads(
    df: DataFrame,
    tags: Sequence[str] = ("campus",),
    payload: str = "daily",
    strict: bool = True,
    seq: str | None = None,
) -> DataFrame:
    """One row per element of the time array, with the tags of its payload.

    A bad payload fails the job; if not strict it is left out, and bad_payloads() lists it.
    `seq` names the source position of the payload, which becomes that of the element.
    Arrays are read by position with get(), since arrays_zip() is NULL as soon as one array is.
    """
    problem = payload_problem(df, payload)
    time = F.col(f"{payload}.time")
    if strict:
        time = F.when(problem.isNotNull(), F.raise_error(problem)).otherwise(time)
    else:
        df = df.filter(problem.isNull())
    arrays = _arrays(df, payload)

    def day(date: Column, i: Column) -> Column:
        fields = [date.alias("date")]
        for name, dtype in schemas.WEATHER_VARIABLES.items():
            values = arrays[name]
            value = F.lit(None) if values is None else F.get(values, i)
            fields.append(value.cast(dtype).alias(name))
        if seq is not None:
            position = F.struct(F.col(seq).alias("payload"), i.alias("element"))
            fields.append(position.alias(seq))
        return F.struct(*fields)

    flat = df.select(*tags, F.inline(F.transform(time, day)))
    ordered = [c for c in schemas.RAW_WEATHER.names if c in flat.columns]
    return flat.select(*ordered, *(c for c in flat.columns if c not in ordered))


def bad_payloads(
    df: DataFrame, tags: Sequence[str] = ("campus",), payload: str = "daily"
) -> DataFrame:
    """(tags, problem, text) of payloads that cannot be flattened; text is the payload as JSON, or the line itself
    where it is no JSON (a column CORRUPT says so, if there is one)."""
    problem, text = payload_problem(df, payload), F.to_json(payload)
    if CORRUPT in df.columns:
        broken = F.col(CORRUPT).isNotNull()
        problem = F.when(broken, F.lit("not a payload")).otherwise(problem)
        text = F.coalesce(CORRUPT, text)
    rows = df.select(*tags, problem.alias("problem"), text.alias("text"))
    return rows.filter(F.col("problem").isNotNull())


def load_window(df: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    """One row: first and last date, both inclusive."""
    return df.agg(
        F.to_date(F.min(timestamp)).alias("first_date"),
        F.to_date(F.max(timestamp)).alias("last_date"),
    )


def key_spine(window: DataFrame, campuses: Sequence[str] = CAMPUSES) -> DataFrame:
    """Every campus on every date of the window: the keys a complete weather table has."""
    return window.select(
        F.explode(F.sequence("first_date", "last_date", F.expr("INTERVAL 1 DAY"))).alias("date")
    ).select("date", F.explode(F.array(*map(F.lit, campuses))).alias("campus"))
