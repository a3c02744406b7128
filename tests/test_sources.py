import json
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import day
from ticketmill import schemas
from ticketmill.sources.payload import bad_payloads, flatten_payloads, key_spine, load_window
from ticketmill.sources.scans import read_citations, read_payloads, read_quarantined, read_table
from ticketmill.sources.sinks import create_table, write_report, write_zone

HEADER = "Citation ID ,Timestamp,Location,Campus,Violation Type,Status,Fine Amount"


@pytest.fixture
def csv(tmp_path):
    def write(*lines, name="citations.csv"):
        (tmp_path / name).write_text("\n".join((HEADER, *lines)) + "\n")
        return str(tmp_path)

    return write


def test_scan_keeps_ids_and_values_as_they_are(spark, csv):
    path = csv(
        "00123456789012345678901234567890,2025-09-15 10:30:00, Lot A ,Kennesaw,Tow Fee,Unpaid,60",
        ",2025-09-15T10:30:00.5,,Marietta,,,",
    )
    first, second = read_citations(spark, path).orderBy(schemas.SEQ).collect()
    assert first.citation_id == "00123456789012345678901234567890"
    assert first["Location"] == " Lot A " and first["Fine Amount"] == 60
    assert second.citation_id is None and second["Timestamp"].microsecond == 500_000
    assert second["Fine Amount"] is None and second["Location"] is None


def test_missing_source_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_citations(spark, str(tmp_path / "none")).collect()


def test_unparsable_value_is_an_error(spark, csv):
    path = csv("1,yesterday,Lot A,Kennesaw,Tow Fee,Unpaid,60")
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
        read_citations(spark, path).collect()


def test_columns_go_by_name(spark, tmp_path):
    names = ["Extra", *reversed(HEADER.split(","))]
    (tmp_path / "c.csv").write_text(",".join(names) + "\nx,60,U,T,K,L,9/15/2025 10:30 AM,1\n")
    row = read_citations(spark, str(tmp_path), timestamp_format="M/d/yyyy h:mm a").first()
    assert row["citation_id"] == "1" and row["Fine Amount"] == 60 and row["Campus"] == "K"
    assert row["Timestamp"].hour == 10 and "Extra" not in row.asDict()


def test_missing_column_is_an_error(spark, tmp_path):
    (tmp_path / "c.csv").write_text("Citation ID ,Timestamp\n1,2025-09-15 10:30:00\n")
    with pytest.raises(ValueError, match="lacks .*Campus"):
        read_citations(spark, str(tmp_path))


def test_damaged_lines_are_kept_apart(spark, csv):
    good, bad = read_quarantined(
        spark,
        csv("1,2025-09-15 10:30:00,L,K,T,U,60", "2,yesterday,L,K,T,U,60", "3,2025-09-15 10:30:00,L,K,T,U,x"),
    )
    assert [r.citation_id for r in good.collect()] == ["1"]
    assert sorted(r["_corrupt"][0] for r in bad.collect()) == ["2", "3"]


def test_source_position_follows_age_and_line(spark, csv, tmp_path):
    for name, start in (("b.csv", 0), ("a.csv", 5000)):
        path = csv(*(f"{i},2025-09-15 10:30:00,L,K,T,U,60" for i in range(start, start + 5000)),
                   name=name)
        os.utime(tmp_path / name, (start, start))
    try:
        # Small splits, handed out by size: the order must not depend on that.
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        scan = read_citations(spark, path)
        assert scan.rdd.getNumPartitions() > 8
        ids = [int(r.citation_id) for r in scan.orderBy(schemas.SEQ).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert ids == list(range(10_000))


PAYLOAD = {
    "latitude": 34.0,
    "daily": {
        "time": ["2025-09-15", "2025-09-16"],
        "temperature_2m_max": [87.2999999, None],
        "temperature_2m_min": [65.0, 66.0],
        "precipitation_sum": [0.0, 1.5],
        "weathercode": [3, 61],
    },
}


@pytest.fixture
def payloads(spark, tmp_path):
    def land(indent=None, multi_line=False, **by_campus):
        for campus, payload in by_campus.items():
            folder = tmp_path / f"campus={campus}"
            folder.mkdir()
            (folder / "daily.json").write_text(json.dumps(payload, indent=indent))
        return read_payloads(spark, str(tmp_path), multi_line)

    return land


def without(*names):
    return {"daily": {k: v for k, v in PAYLOAD["daily"].items() if k not in names}}


def test_payloads_flatten_to_one_row_per_day(payloads):
    flat = flatten_payloads(payloads(Kennesaw=PAYLOAD, Marietta=PAYLOAD))
    assert flat.schema.simpleString() == schemas.RAW_WEATHER.simpleString()
    assert [tuple(r) for r in flat.orderBy("campus", "date").collect()] == [
        (d, c, *v)
        for c in ("Kennesaw", "Marietta")
        for d, v in (
            ("2025-09-15", (87.2999999, 65.0, 0.0, 3)),
            ("2025-09-16", (None, 66.0, 1.5, 61)),
        )
    ]


def test_payload_over_several_lines(payloads):
    assert flatten_payloads(payloads(indent=1, multi_line=True, Kennesaw=PAYLOAD)).count() == 2


def test_unexpected_layout_is_an_error(payloads):
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
        flatten_payloads(payloads(indent=1, Kennesaw=PAYLOAD)).collect()


def test_missing_variable_is_null(payloads):
    flat = flatten_payloads(payloads(Kennesaw=without("precipitation_sum")))
    assert [r.precipitation_sum for r in flat.collect()] == [None, None]
    assert [r.weathercode for r in flat.orderBy("date").collect()] == [3, 61]


def test_variable_missing_from_the_type_is_null(payloads):
    narrow = payloads(Kennesaw=PAYLOAD).withColumn(
        "daily", F.col("daily").dropFields("weathercode")
    )
    assert [r.weathercode for r in flatten_payloads(narrow).collect()] == [None, None]


@pytest.mark.parametrize(
    "payload, problem",
    [
        ({}, "payload has no time axis"),
        (without("time"), "payload has no time axis"),
        (
            {"daily": PAYLOAD["daily"] | {"weathercode": [3]}},
            "weathercode and time differ in length",
        ),
    ],
)
def test_bad_payload_fails_or_is_set_aside(payloads, payload, problem):
    df = payloads(Kennesaw=PAYLOAD, Marietta=payload)
    with pytest.raises(Exception, match=problem):
        flatten_payloads(df).collect()
    assert {r.campus for r in flatten_payloads(df, strict=False).collect()} == {"Kennesaw"}
    assert [tuple(r) for r in bad_payloads(df).drop("text").collect()] == [("Marietta", problem)]


def test_empty_time_axis_gives_no_rows(payloads):
    empty = {"daily": {k: [] for k in PAYLOAD["daily"]}}
    assert flatten_payloads(payloads(Kennesaw=empty)).count() == 0


def test_window_and_spine(spark, raw):
    rows = raw(("1", "2025-09-17 23:00:00", *"LKTU", 1), ("2", "2025-09-15 01:00:00", *"LKTU", 1))
    window = load_window(rows, "Timestamp")
    assert tuple(window.first()) == (day("2025-09-15"), day("2025-09-17"))
    spine = key_spine(window, ["Kennesaw", "Marietta"])
    assert spine.count() == 6 == spine.distinct().count()
    assert key_spine(load_window(rows.limit(0), "Timestamp"), ["Kennesaw"]).count() == 0


def test_report_is_one_sorted_csv_with_empty_nulls(spark, tmp_path):
    df = spark.createDataFrame([("b", 2, None), ("a", 2, 1.5), ("c", 9, 50.0)],
                               "violation_type string, n int, avg_fine double").repartition(3)
    path = tmp_path / "report"
    for _ in range(2):  # a second run overwrites
        write_report(df, str(path), [F.desc("n"), F.asc("violation_type")])
    (part,) = path.glob("part-*.csv")
    assert part.read_text() == "violation_type,n,avg_fine\nc,9,50.0\na,2,1.5\nb,2,\n"


@pytest.mark.parametrize("rebalance", [False, True])
def test_zone_round_trip(spark, citations, tmp_path, rebalance):
    rows = citations(("1", "2025-09-15 10:00:00", " ", " ", "T", "S", 1),
                     ("2", None, None, None, "T", "S", None)).drop("_seq")
    path = str(tmp_path / "zone")
    write_zone(rows, path, ["year", "month"], rebalance=rebalance)
    back = read_table(spark, path, schemas.CITATIONS)
    assert back.columns == schemas.CITATIONS.names
    assert sorted(back.collect(), key=str) == sorted(rows.collect(), key=str)
    assert next((tmp_path / "zone").rglob("*.snappy.parquet"))


def test_create_table_leaves_an_existing_one_alone(spark, citations, tmp_path):
    path = str(tmp_path / "t")
    create_table(spark, path, schemas.CITATIONS, ["year"])
    assert read_table(spark, path, schemas.CITATIONS).count() == 0
    write_zone(citations(("1", None, *"LCTS", 1)).drop("_seq"), path, ["year"], mode="append")
    create_table(spark, path, schemas.CITATIONS, ["year"])
    assert read_table(spark, path, schemas.CITATIONS).count() == 1
