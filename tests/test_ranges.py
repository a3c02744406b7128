import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ticketmill.functions.labels import range_label
from ticketmill.operators.ranges import DAY, LENGTHS, SECOND, ends_of, last_of_cells, range_lookup_join, spans
from ticketmill.settings import SEMESTERS, UNKNOWN

RANGES = "label string, start timestamp_ntz, `end` timestamp_ntz, position int"


def drawn(seed, n):
    """Ranges of microseconds to centuries, and times at, just before and just after their bounds."""
    rng, base = random.Random(seed), datetime(2024, 3, 9)
    ranges, times = [], [None, datetime(1, 1, 1), datetime(9999, 12, 31, 23, 59, 59, 999999)]
    for i in range(n):
        start = base + timedelta(microseconds=rng.choice([1, 1_000_000, 60_000_000, 3_600_000_000]) * rng.randint(-5000, 5000))
        unit = rng.choice([1, 400_000, 1_000_000, 60_000_000, 3_600_000_000, 86_400_000_000, 10**13])
        end = start + timedelta(microseconds=unit * rng.randint(0, 90))
        if rng.random() < 0.3:
            start, end = (datetime(x.year, x.month, x.day) for x in (start, end))
        ranges.append((f"r{i % 7}", start, end, rng.randint(0, n // 2)))
        for edge in (start, end):
            times += [edge + timedelta(microseconds=d) for d in (-1, 0, 1, rng.randint(-(10**7), 10**7))]
    return ranges, times


@pytest.mark.parametrize("whole_last_day", [False, True])
def test_label_is_that_of_the_last_range_that_holds_the_time(spark, whole_last_day):
    ranges, times = drawn(3, 120)
    extra = [(None, times[8], times[8] + timedelta(1), 10**6), ("x", None, times[8], 10**7), ("x", times[8], None, 10**7),
             ("x", times[8], times[8] - timedelta(3), 10**7), ("x", times[8], times[8] + timedelta(400), None)]
    rows = spark.createDataFrame([(i, t, 1) for i, t in enumerate(times)], "_cell int, ts timestamp_ntz, _at int")
    table = spark.createDataFrame(ranges + extra, RANGES)
    found = range_lookup_join(rows, table, "ts", "label", "none", whole_last_day=whole_last_day).collect()
    assert sorted(r["_cell"] for r in found) == list(range(len(times)))
    for r in found:
        held = [
            (p, n or "")
            for n, a, b, p in ranges + extra
            if None not in (r["ts"], a, b, p) and a <= b
            and (a <= r["ts"] < b + timedelta(1) if whole_last_day else a <= r["ts"] <= b)
        ]
        assert (r["label"], r["_at"]) == ((max(held)[1] or None) if held else "none", 1), r


def test_equals_the_labels_from_literals(spark, citations):
    rows = [(str(i), f"2025-{m:02d}-{d:02d}T{h:02d}:00:00", "Lot", "K", "x", "Paid", 5)
            for i, (m, d, h) in enumerate([(7, 31, 23), (8, 1, 0), (12, 31, 0), (12, 31, 1), (10, 5, 9)])]
    table = spark.createDataFrame([(n, a, b, i) for i, (n, a, b) in enumerate(SEMESTERS)],
                                  "label string, start string, `end` string, position int")
    dates = table.withColumns({c: F.col(c).cast("date") for c in ("start", "end")})
    labelled = citations(*rows)
    for ranges in (table, dates):
        found = range_lookup_join(labelled, ranges, "timestamp", "term", UNKNOWN)
        assert found.filter("term <> semester").count() == 0 and found.count() == len(rows)
    same = range_label(F.col("timestamp"), SEMESTERS, UNKNOWN, True)
    found = range_lookup_join(labelled, table, "timestamp", "term", UNKNOWN, whole_last_day=True)
    assert found.filter(F.col("term") != same).count() == 0


def test_no_range_is_compared_with_a_row(spark):
    ranges, times = drawn(4, 50)
    rows = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    found = range_lookup_join(rows, spark.createDataFrame(ranges, RANGES), "ts", "label")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan
    physical = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in physical and "Cartesian" not in physical


def test_no_ranges_and_no_rows(spark):
    rows = spark.createDataFrame([(datetime(2024, 1, 1),)], "ts timestamp_ntz")
    none = spark.createDataFrame([], RANGES)
    assert [r["label"] for r in range_lookup_join(rows, none, "ts", "label", "none").collect()] == ["none"]
    some = spark.createDataFrame(drawn(4, 5)[0], RANGES)
    assert range_lookup_join(rows.filter("false"), some, "ts", "label").collect() == []


def test_spans_and_ends_make_up_a_range_once(spark):
    """Each within one cell of the next greater length, so that equal ones are few, however many ranges there are."""
    rng = random.Random(5)
    bounds = []
    for i in range(300):
        unit = rng.choice([1, SECOND, 60 * SECOND, 3600 * SECOND, DAY])
        lo = rng.randint(-(10**4), 10**4) * rng.choice([1, unit])
        bounds.append((i, lo, lo + rng.randint(1, 10**4) * unit))
    rows = spark.createDataFrame(bounds, "rank int, lo bigint, hi bigint")
    found = rows.select("*", *(spans(level).alias(f"l{level}") for level in range(len(LENGTHS)))).collect()
    ends = {}
    for r in ends_of(rows).collect():
        assert r["lo"] // SECOND == (r["hi"] - 1) // SECOND == r["cell"]
        ends.setdefault(r["rank"], []).append((r["lo"], r["hi"]))
    for r in found:
        parts = ends.get(r["rank"], [])
        for level, length in enumerate(LENGTHS):
            for first, past in r[f"l{level}"]:
                parts.append((first * length, past * length))
                wide = LENGTHS[level - 1] if level else None
                assert first < past and (not wide or first * length // wide == (past * length - 1) // wide)
        parts.sort()
        assert parts[0][0] == r["lo"] and parts[-1][1] == r["hi"]
        assert all(a[1] == b[0] for a, b in zip(parts, parts[1:]))


def test_equal_ranges_are_taken_apart_once(spark):
    rows = spark.range(5000).selectExpr(f"id % 5 * {SECOND} AS lo", f"70 * {SECOND} AS hi", "id AS rank")
    cells = last_of_cells(rows, LENGTHS.index(SECOND))  # the first minute of those from 0 on is whole
    assert sorted(map(tuple, cells.collect())) == [(c, 4995 + min(c, 4)) for c in range(1, 70)]
    plan = cells._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.rindex("Aggregate [first")  # the aggregate is below it
