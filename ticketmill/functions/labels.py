from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def lookup(col: Column, mapping: Mapping, default=None) -> Column:
    """Value for a key, or `default` if the key is absent or NULL.

    The mapping comes from the caller's settings, so it becomes a literal in the plan: no join.
    For a lookup table that is itself data, use operators.joins.lookup_join.
    """
    if not mapping:
        return F.lit(default)
    table = F.create_map(*(F.lit(x) for x in chain.from_iterable(mapping.items())))
    return F.coalesce(F.try_element_at(table, col), F.lit(default))


def range_label(
    ts: Column,
    ranges: Sequence[tuple[str, str, str]],
    default: str,
    whole_last_day: bool = False,
) -> Column:
    """Label of the last range (label, start, end) that holds the timestamp, else `default`.

    Both bounds belong to the range. An end without a time of day means midnight, so later hours
    of that day are outside unless `whole_last_day` is set.
    """
    label = F.lit(default)
    for name, start, end in ranges:
        lower = F.lit(start).cast("timestamp_ntz")
        upper = F.lit(end).cast("timestamp_ntz")
        if whole_last_day:
            inside = (ts >= lower) & (ts < upper + F.expr("INTERVAL 1 DAY"))
        else:
            inside = (ts >= lower) & (ts <= upper)
        label = F.when(inside, F.lit(name)).otherwise(label)
    return label


def bucket_label(
    col: Column, zero_label: str, upper_bounds: Sequence[tuple[float, str]], default: str
) -> Column:
    """Zero has its own label; otherwise the first upper bound that is not exceeded decides."""
    label = F.when(col == 0.0, F.lit(zero_label))
    for bound, name in upper_bounds:
        label = label.when(col <= bound, F.lit(name))
    return label.otherwise(F.lit(default))


def weekday_name(date: Column) -> Column:
    """English weekday name. A literal array is cheaper than date_format(date, 'EEEE')."""
    return F.get(F.array(*map(F.lit, WEEKDAYS)), F.weekday(date))
