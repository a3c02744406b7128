import random
from datetime import date, timedelta

from tests.conftest import day
from ticketmill.operators.citations import clean_citations
from ticketmill.operators.weather import clean_weather
from ticketmill.plans import quality

NAN = float("nan")


def metrics(df):
    return {r.metric: r.value for r in df.collect()}


def cite(id="1", ts="2025-09-15 10:00:00", loc="L", campus="K", type="Tow Fee", status="Unpaid",
         fine=60):
    return id, ts, loc, campus, type, status, fine


def test_citation_metrics(raw):
    rows = raw(
        cite(), cite(None), cite(ts=None), cite(campus=None), cite(fine=-60), cite(fine=0),
        cite(loc="M", type=" Tow Fee "), cite(type="DO NOT USE/TESTING", campus="Z", loc="Z"),
        cite(ts="2027-01-01 00:00:00"),
    )
    assert metrics(quality.citation_quality(rows)) == {
        "raw_rows": 9, "removed_rows": 1, "clean_rows": 8, "credit_rows": 1, "zero_fine_rows": 1,
        "validation_failures": 1, "null_citation_ids": 1, "null_timestamps": 1,
        "null_campuses": 1, "unknown_semester_rows": 2, "distinct_campuses": 1,
        "distinct_types": 1, "distinct_locations": 2, "distinct_semesters": 1,
    }


def test_metrics_of_nothing_are_zero(raw, raw_weather):
    assert set(metrics(quality.citation_quality(raw(cite()).limit(0))).values()) == {0}
    none = raw_weather(("2025-09-15", "K", 1.0, 1.0, 0.0, 0)).limit(0)
    assert set(metrics(quality.weather_quality(none)).values()) == {0}


def test_weather_metrics(raw_weather):
    rows = raw_weather(
        ("2025-09-15", "K", None, NAN, NAN, 3), ("2025-09-16", "K", 1.0, None, 5.004, 42),
        ("2025-09-17", "K", 1.0, 1.0, 9.0, None), ("2025-09-18", "K", 1.0, 1.0, 90.0, 0),
    )
    assert metrics(quality.weather_quality(rows)) == {
        "rows": 4, "null_precipitation": 1, "null_temperatures": 3, "unknown_codes": 2,
        "bucket_none": 1, "bucket_light": 1, "bucket_moderate": 1, "bucket_heavy": 1,
        "first_date": 20250915, "last_date": 20250918,
    }
    counts = quality.bucket_counts(clean_weather(rows)).collect()
    assert [tuple(r) for r in counts] == [
        ("Heavy", 1), ("Light", 1), ("Moderate", 1), ("None", 1),
    ]


def test_join_coverage_and_missing_keys(raw, weather):
    fact = clean_citations(raw(cite(), cite("2"), cite("3", ts="2025-09-16 00:00:00"),
                               cite("4", campus="M"), cite("5", ts=None)))
    sky = weather(("2025-09-15", "K", 1.0, 1.0, 0.0, 0), ("2025-09-15", "M", 1.0, 1.0, 0.0, 0),
                  ("2025-09-15", "M", 2.0, 1.0, 0.0, 0))
    assert tuple(quality.join_coverage(fact, sky).first()) == (4, 2, 0.5)
    missing = {tuple(r) for r in quality.missing_keys(fact, sky).collect()}
    assert missing == {(day("2025-09-16"), "K"), (None, "K")}
    assert tuple(quality.join_coverage(fact.limit(0), sky).first()) == (0, 0, None)


def test_anomalies_by_type_and_amount(raw):
    fact = clean_citations(raw(cite(fine=35), cite(fine=35), cite(fine=1), cite()))
    assert [tuple(r) for r in quality.anomalies(fact).collect()] == [
        ("Tow Fee", 35, 2), ("Tow Fee", 1, 1),
    ]


def test_gap_ranges_hold_the_days_of_the_gaps(spark):
    rng = random.Random(2)
    days = [(date(2024, 2, 20) + timedelta(i), c) for i in range(60) for c in ("K", "M", None) if rng.random() < 0.6]
    keys = spark.createDataFrame([*days, days[0], (None, "K")], "date date, campus string")
    found = quality.gap_ranges(keys).collect()
    listed = [(r.first_date + timedelta(i), r.campus) for r in found for i in range((r.last_date - r.first_date).days + 1)]
    assert sorted(listed, key=str) == sorted(days, key=str)
    assert all(r.days == (r.last_date - r.first_date).days + 1 for r in found)
    edges = {(r.last_date + timedelta(1), r.campus) for r in found}
    assert not edges & set(days)
    assert quality.gap_ranges(keys.filter("false")).collect() == []


def test_merged_bitmaps_count_distinct_days(spark):
    rng = random.Random(4)
    rows = [(date(1969, 12, 1) + timedelta(rng.randint(0, 90)), rng.choice("ab"), rng.choice("xyz")) for _ in range(300)]
    rows += [(date(1, 1, 1), "a", "x"), (date(9999, 12, 31), "a", "y"), (None, "a", "x"), (date(2024, 1, 1), None, "x")]
    df = spark.createDataFrame(rows, "date date, g string, load string")
    one, two = df.filter("load = 'x'"), df.filter("load <> 'x'")
    parts = quality.day_bitmaps(one, ["g"]).unionByName(quality.day_bitmaps(two, ["g"]))
    wanted = {}
    for d, g, _ in rows:
        if d is not None:
            wanted.setdefault(g, set()).add(d)
    assert dict(quality.count_days(parts, ["g"]).collect()) == {g: len(s) for g, s in wanted.items()}
    assert dict(quality.count_days(quality.merge_bitmaps(parts, ["g"]), ["g"]).collect()) == {g: len(s) for g, s in wanted.items()}
