"""Labels from a table of ranges, for any number of ranges, overlapping in any way.

A range is cut into cells of fixed lengths, from thousands of days down to a second, each as large as fits, so a
range has few cells however long it is. Ranges that have the same cells of a length in a row are one there, before cells
are counted out. A cell that several ranges hold whole belongs to the last of them, which an aggregate finds. Each row then looks up the one cell of each length that it falls in, by equality, and the last
range of what it finds wins: no range is compared with a row, and no row is multiplied. Only what is left of
ranges at their ends, less than a second, is kept as bounds, and compared within that second.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECOND = 1_000_000
DAY = 86_400 * SECOND
#: Cell lengths in microseconds, each a multiple of the next.
LENGTHS = (4096 * DAY, 64 * DAY, DAY, 3_600 * SECOND, 60 * SECOND, SECOND)


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp without a time zone; no session setting plays a part."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def _down(value: Column, length: int) -> Column:
    return (value - F.pmod(value, F.lit(length))) / length


def _number(value: Column) -> Column:
    return value.cast("bigint")


def _up(value: Column, length: int) -> Column:
    return _down(value + (length - 1), length)


def _parts(first: Column, enter: Column, leave: Column, past: Column, names: tuple[str, str]) -> Column:
    """[first, enter) and [leave, past), or [first, past) if leave is before enter; those that hold anything."""
    def part(x: Column, y: Column) -> Column:
        return F.struct(x.alias(names[0]), y.alias(names[1]))

    parts = F.when(enter <= leave, F.array(part(first, enter), part(leave, past))).otherwise(F.array(part(first, past)))
    return F.filter(parts, lambda x: x[names[0]] < x[names[1]])


def spans(level: int) -> Column:
    """array<struct<first, past>>: the cells of a length that lie in [lo, hi) as a whole, and not in one of the next
    greater length that does too. Each span lies within one cell of that length."""
    length = LENGTHS[level]
    first, past = (_number(x) for x in (_up(F.col("lo"), length), _down(F.col("hi"), length)))
    if not level:
        return _parts(first, past, past, past, ("first", "past"))
    wide = LENGTHS[level - 1]
    enter, leave = (_number(x) * (wide // length) for x in (_up(F.col("lo"), wide), _down(F.col("hi"), wide)))
    return _parts(first, enter, leave, past, ("first", "past"))


def last_of_cells(ranges: DataFrame, level: int) -> DataFrame:
    """(cell, rank): of each cell of a length that spans() of ranges (lo, hi, rank) hold, the highest rank.

    Equal spans are one before they are taken apart, so a cell of the next length has so many of them at most, however
    many ranges there are; and all of them are in one task, so what they are taken apart into isn't shuffled."""
    rows = ranges.select(F.inline(spans(level)), "rank")
    once = rows.groupBy("first", "past").agg(F.max("rank").alias("rank"))
    ratio = LENGTHS[level - 1] // LENGTHS[level] if level else 1
    within = _number(_down(F.col("first"), ratio)) if level else F.lit(None).cast("bigint")
    once = once.withColumn("within", within)
    cells = (once.repartition("within") if level else once).select(
        "within", F.explode(F.sequence("first", F.col("past") - 1)).alias("cell"), "rank"
    )
    return cells.groupBy("within", "cell").agg(F.max("rank").alias("rank")).drop("within")


def ends_of(ranges: DataFrame) -> DataFrame:
    """(cell, lo, hi, rank): what is left of ranges (lo, hi, rank) beside whole seconds, by the second it lies in."""
    enter, leave = (_number(x) * SECOND for x in (_up(F.col("lo"), SECOND), _down(F.col("hi"), SECOND)))
    rows = ranges.select(F.inline(_parts(F.col("lo"), enter, leave, F.col("hi"), ("lo", "hi"))), "rank")
    return rows.select(_number(_down(F.col("lo"), SECOND)).alias("cell"), "lo", "hi", "rank")


def range_lookup_join(
    df: DataFrame,
    ranges: DataFrame,
    timestamp: str,
    label: str,
    default: str | None = None,
    start: str = "start",
    end: str = "end",
    name: str = "label",
    order: str = "position",
    whole_last_day: bool = False,
) -> DataFrame:
    """df with `label`: the name of the last range, by `order`, that holds the timestamp, else `default`.

    As functions.labels.range_label(), with the ranges from a table: both bounds belong to a range, and an end
    without a time of day means midnight, or the end of that day with `whole_last_day`. Of ranges with the same
    order the greater name counts; a range without a name gives NULL; one without a bound or an order, or that ends
    before it starts, holds nothing.
    A NULL timestamp gets `default`. Every row of df stays once, whatever the ranges. Which cell lengths the
    ranges need is found by one small job over the ranges, so df meets one table for each of these only; Spark
    broadcasts a table if its size allows, and sorts and merges else.
    """
    ordered = F.col(start).cast("timestamp_ntz") <= F.col(end).cast("timestamp_ntz")
    hi = micros(F.col(end)) + (F.lit(DAY) if whole_last_day else F.lit(1))
    rank = F.struct(F.col(order).alias("order"), F.col(name).alias("name"))
    bounded = ranges.filter(F.col(order).isNotNull() & ordered).select(micros(F.col(start)).alias("lo"), hi.alias("hi"), rank.alias("rank"))
    held = [F.max(F.size(spans(level)) > 0).alias(f"l{level}") for level in range(len(LENGTHS))]
    needed = bounded.agg(*held).first()
    at = _fresh("_at", df)
    found = df.withColumn(at, micros(F.col(timestamp)))
    ranks = []
    for level, length in enumerate(LENGTHS):
        if not needed[level]:
            continue
        cell, best = _fresh(f"_cell{length}", df), _fresh(f"_rank{length}", df)
        last = last_of_cells(bounded, level).toDF(cell, best)
        found = found.withColumn(cell, _number(_down(F.col(at), length))).join(last, cell, "left")
        ranks.append(F.col(best))
    cell, rest = _fresh("_cell", df), _fresh("_ends", df)
    held = ends_of(bounded).groupBy(F.col("cell").alias(cell)).agg(F.collect_set(F.struct("rank", "lo", "hi")).alias(rest))
    found = found.withColumn(cell, _number(_down(F.col(at), SECOND))).join(held, cell, "left")
    inside = F.filter(rest, lambda x: (x["lo"] <= F.col(at)) & (F.col(at) < x["hi"]))
    ranks.append(F.array_max(inside)["rank"])
    last = F.greatest(*ranks) if len(ranks) > 1 else ranks[0]
    return found.withColumn(label, F.when(last.isNull(), F.lit(default)).otherwise(last["name"])).select(
        *(F.col(f"`{c}`") for c in df.columns if c != label), label
    )


def _fresh(name: str, df: DataFrame) -> str:
    """The name, or a longer one if df has such a column."""
    while name in df.columns:
        name += "_"
    return name
