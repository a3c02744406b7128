"""The whole job over landed files, run again, and run with corrections."""

import json
import os
import subprocess
import sys
from pathlib import Path

import pytest

from tests.test_sources import HEADER
from ticketmill import schemas
from ticketmill.operators.weather import clean_weather
from ticketmill.plans import batch
from ticketmill.plans.reports import TABLE_REPORTS, ZONE_REPORTS, Report
from ticketmill.sources import versions
from ticketmill.sources.scans import read_citations, read_payloads, read_quarantined, read_table

ROOT = Path(__file__).resolve().parent.parent

FIRST = [
    "A1,2025-09-15 10:30:00,East Deck,Kennesaw,No Valid Permit,Unpaid,50",
    "A2,2025-09-15 11:30:00,East Deck ,Kennesaw,No Valid Permit,Transfer,0",
    "A2,2025-09-15 11:30:00,East Deck,Kennesaw,No Valid Permit,Unpaid,50",
    "A3,2025-09-30 08:00:00,Lot B,Marietta,Boot Fee,Unpaid,35",
    "A4,2025-09-30 08:00:00,Lot B,Marietta,DO NOT USE/TESTING,Unpaid,35",
    "A5,2025-09-30 08:00:00,Lot B,,Boot Fee,Unpaid,60",
]
SECOND = [
    "A1,2025-09-15 10:30:00,East Deck,Kennesaw,No Valid Permit,Zero Balance,0",
    "A9,2025-10-01 09:00:00,Lot C,Marietta,Tow Fee,Unpaid,60",
]


def land(folder, lines, days):
    source, payloads = folder / "citations", folder / "payloads"
    source.mkdir(parents=True)
    (source / "citations.csv").write_text("\n".join((HEADER, *lines)) + "\n")
    for campus in ("Kennesaw", "Marietta"):
        (payloads / f"campus={campus}").mkdir(parents=True)
        daily = {"time": list(days), "weathercode": [3] * len(days)}
        daily |= {v: list(days.values()) for v in schemas.WEATHER_VARIABLES if v != "weathercode"}
        (payloads / f"campus={campus}" / "w.json").write_text(json.dumps({"daily": daily}))
    return str(source), str(payloads)


def run(spark, landed, root):
    return batch.run(
        spark, read_citations(spark, landed[0]), read_payloads(spark, landed[1]), str(root)
    )


def stored(spark, root):
    out = batch.Layout(str(root))
    cit = read_table(spark, out.citations, schemas.CITATIONS).orderBy("citation_id").collect()
    sky = batch.read_weather(spark, out.weather).orderBy("date", "campus").collect()
    return cit, sky


def csv_text(folder):
    (part,) = Path(folder).glob("part-*.csv")
    return part.read_text()


def test_job_is_repeatable_and_merges_later_loads(spark, tmp_path):
    root = tmp_path / "root"
    first = land(tmp_path / "1", FIRST, {"2025-09-15": 10.0, "2025-09-30": 0.0})
    outcome = run(spark, first, root)
    assert outcome.failed_reports == {}
    assert outcome.rows == {
        "raw_citations": 6, "raw_weather": 4, "clean_citations": 5, "clean_weather": 4,
        "rejected_citations": 1, "repeated_citations": 1, "known_citations": 0,
        "inserted_citations": 3, "inserted_without_id": 0, "stored_weather": 4,
        "report_violations_by_type": 2, "report_monthly_volume_by_campus": 2,
        "report_top_locations": 2, "report_status_breakdown": 2, "report_hourly_patterns": 3,
        "report_weather_citation_correlation": 4, "report_violation_summary_spark": 3,
        "report_weather_hourly_spark": 4,
    }
    assert outcome.failed_quality == {}
    cit, sky = stored(spark, root)
    assert [(r.citation_id, r.status, r.location) for r in cit] == [
        ("A1", "Unpaid", "East Deck"), ("A2", "Transfer", "East Deck"), ("A3", "Unpaid", "Lot B"),
    ]
    assert csv_text(root / "reports/violations_by_type") == (
        "violation_type,citation_count,total_fines_collected,avg_fine\n"
        "No Valid Permit,2,50,50.0\nBoot Fee,1,35,35.0\n"
    )
    # The batch reports see repeated ids and incomplete rows.
    assert csv_text(root / "reports/spark/violation_summary_spark").splitlines()[1] == (
        "No Valid Permit,Kennesaw,3,100,50.0"
    )
    for r in TABLE_REPORTS:
        assert csv_text(root / "reports" / r.name)
    for r in ZONE_REPORTS:
        assert csv_text(root / "reports/spark" / r.name)
    assert "validation_failures,1" in csv_text(root / "quality/citations")

    again = run(spark, first, root)
    assert again.rows["inserted_citations"] == 0
    assert stored(spark, root) == (cit, sky)

    # A later load: a new status for A1 is ignored, weather is corrected and extended.
    run(spark, land(tmp_path / "2", SECOND, {"2025-09-30": 7.0, "2025-10-01": 1.0}), root)
    cit, sky = stored(spark, root)
    assert [(r.citation_id, r.status) for r in cit] == [
        ("A1", "Unpaid"), ("A2", "Transfer"), ("A3", "Unpaid"), ("A9", "Unpaid"),
    ]
    assert [(str(r.date), r.precipitation_sum) for r in sky if r.campus == "Kennesaw"] == [
        ("2025-09-15", 10.0), ("2025-09-30", 7.0), ("2025-10-01", 1.0),
    ]


def test_a_failing_report_does_not_stop_the_others(spark, citations, tmp_path):
    rows = citations(("1", "2025-09-15 10:00:00", *"LKTU", 1))
    broken = Report("broken", lambda df: df.select("no_such_column"), ())
    done = batch.run_reports(
        [broken, *TABLE_REPORTS[:2]], lambda: rows, lambda: rows, str(tmp_path)
    )
    assert list(done.failed) == ["broken"] and "UNRESOLVED_COLUMN" in done.failed["broken"]
    assert done.rows == {r.name: 1 for r in TABLE_REPORTS[:2]}
    assert all((tmp_path / r.name / "_SUCCESS").exists() for r in TABLE_REPORTS[:2])


def test_last_element_of_a_payload_wins(spark, tmp_path):
    source, payloads = land(tmp_path, FIRST[:1], {"2025-09-15": 1.0})
    for campus in ("Kennesaw", "Marietta"):
        repeated = {"time": ["2025-09-15"] * 40}
        repeated |= {v: list(range(40)) for v in schemas.WEATHER_VARIABLES}
        path = Path(payloads) / f"campus={campus}" / "w.json"
        path.write_text(json.dumps({"daily": repeated}))
    out = batch.Layout(str(tmp_path / "root"))
    batch.ingest(read_citations(spark, source), read_payloads(spark, payloads), out)
    raw = spark.read.parquet(out.raw_weather)
    assert raw.count() == 80
    batch.merge_weather(spark, clean_weather(raw, keep=[schemas.SEQ]), out.weather)
    stored = batch.read_weather(spark, out.weather).collect()
    assert [r.weathercode for r in stored] == [39, 39]


def test_months_outside_the_batch_are_not_touched(spark, weather, tmp_path):
    path = str(tmp_path / "w")
    batch.merge_weather(spark, weather(("2025-08-01", "K", 1.0, 1.0, 0.0, 0),
                                       ("2025-09-01", "K", 1.0, 1.0, 0.0, 0)), path)
    before = sorted((tmp_path / "w").glob("data/*/partition=*"))
    assert batch.merge_weather(spark, weather(("2025-09-02", "K", 1.0, 1.0, 0.0, 0)), path) == 3
    new = set((tmp_path / "w").glob("data/*/partition=*")) - set(before)
    assert [p.name for p in new] == ["partition=202509"]


def test_a_load_that_breaks_off_leaves_the_old_rows(spark, weather, tmp_path, monkeypatch):
    path = str(tmp_path / "w")
    batch.merge_weather(spark, weather(("2025-08-01", "K", 1.0, 1.0, 0.0, 0)), path)
    before = batch.read_weather(spark, path).collect()

    def broken(*args):
        raise OSError("gone")

    later = weather(("2025-08-01", "K", 9.0, 9.0, 9.0, 9), ("2025-08-02", "K", 1.0, 1.0, 0.0, 0))
    with monkeypatch.context() as m:
        m.setattr(versions, "switch", broken)
        with pytest.raises(OSError):
            batch.merge_weather(spark, later, path)
    assert batch.read_weather(spark, path).collect() == before
    assert batch.merge_weather(spark, later, path) == 2


def test_a_load_into_many_months_writes_a_file_for_each(spark, tmp_path):
    from pyspark.sql import functions as F

    n = spark.range(0, 24_000, numPartitions=16)
    rows = n.select(
        *(
            F.lit("x").cast(f.dataType).alias(f.name)
            if f.dataType.simpleString() == "string"
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schemas.CITATIONS
        ),
        F.col("id").alias(schemas.SEQ),
    ).withColumns(
        {
            "citation_id": F.col(schemas.SEQ).cast("string"),
            "year": (F.lit(2020) + F.col(schemas.SEQ) % 2).cast("int"),
            "month": (F.lit(1) + F.floor(F.col(schemas.SEQ) / 2) % 12).cast("int"),
            "fine_amount": F.lit(1),
            "timestamp": F.lit("2020-01-01 00:00:00").cast("timestamp_ntz"),
        }
    )
    assert batch.merge_citations(spark, rows, str(tmp_path / "c")) == 24_000
    files = list((tmp_path / "c").glob("year=*/month=*/part-*"))
    assert 24 <= len(files) <= 30


def test_failing_steps_do_not_lose_the_outcome(spark, tmp_path, monkeypatch):
    def broken(*args, **kwargs):
        raise ValueError("no")

    monkeypatch.setattr(batch, "read_weather", broken)
    monkeypatch.setattr(batch.quality, "anomalies", broken)
    monkeypatch.setattr(batch, "merge_weather", lambda *args: 0)
    outcome = run(spark, land(tmp_path, FIRST, {"2025-09-15": 1.0}), tmp_path / "root")
    assert outcome.failed_reports == {"weather_citation_correlation": "ValueError: no"}
    assert outcome.failed_quality == {"anomalies": "ValueError: no"}
    assert outcome.rows["inserted_citations"] == 3


def test_merging_an_empty_weather_batch(spark, weather, tmp_path):
    none = weather(("2025-08-01", "K", 1.0, 1.0, 0.0, 0)).limit(0)
    assert batch.merge_weather(spark, none, str(tmp_path / "w")) == 0


@pytest.mark.parametrize("missing", [False, True])
def test_command_line(tmp_path, missing):
    source, payloads = land(tmp_path, FIRST[:1], {"2025-09-15": 0.0})
    done = subprocess.run(
        [sys.executable, "-m", "ticketmill", "--citations", source + "x" * missing,
         "--payloads", payloads, "--root", str(tmp_path / "root")],
        cwd=ROOT, capture_output=True, text=True, timeout=300,
        env=os.environ | {"SPARK_LOCAL_DIRS": str(tmp_path)},
    )
    assert (done.returncode != 0) == missing
    assert (tmp_path / "root/reports/violations_by_type/_SUCCESS").exists() != missing
    assert ("PATH_NOT_FOUND" in done.stderr) == missing


def test_an_empty_first_load_does_not_block_the_store(spark, weather, tmp_path):
    path, rows = str(tmp_path / "w"), weather(("2025-08-01", "K", 1.0, 1.0, 0.0, 0))
    for _ in range(2):
        assert batch.merge_weather(spark, rows.limit(0), path) == 0
    assert batch.merge_weather(spark, rows, path) == 1
    assert batch.merge_weather(spark, rows.limit(0), path) == 1


def test_a_manifest_that_broke_off_does_not_block_the_store(spark, weather, tmp_path):
    path, rows = str(tmp_path / "w"), weather(("2025-08-01", "K", 1.0, 1.0, 0.0, 0))
    batch.merge_weather(spark, rows, path)
    (tmp_path / "w/manifest/version=2/_temporary/0").mkdir(parents=True)
    assert batch.read_weather(spark, path).count() == 1
    assert batch.merge_weather(spark, weather(("2025-09-01", "K", 1.0, 1.0, 0.0, 0)), path) == 2
    assert (tmp_path / "w/manifest/version=3").exists()


@pytest.mark.parametrize("other_day", ["2025-10-01", "2025-08-07"])
def test_two_loads_at_once_lose_nothing(spark, weather, tmp_path, monkeypatch, other_day):
    """While a load is about to switch, another one replaces another month, or the same one."""
    path, switch, tried = str(tmp_path / "w"), versions.switch, []
    batch.merge_weather(spark, weather(("2025-08-01", "K", 1.0, 1.0, 0.0, 0)), path)

    def delayed(*args):
        tried.append(args)
        if len(tried) == 1:
            assert batch.merge_weather(spark, weather((other_day, "M", 5.0, 1.0, 0.0, 0)), path) == 2
        return switch(*args)

    monkeypatch.setattr(versions, "switch", delayed)
    assert batch.merge_weather(spark, weather(("2025-08-02", "K", 9.0, 1.0, 0.0, 0)), path) == 3
    days = sorted(str(r.date) for r in batch.read_weather(spark, path).collect())
    assert days == sorted(["2025-08-01", "2025-08-02", other_day])
    assert len(tried) == 3  # the other load's, the one that failed, the one that did not
    assert not list((tmp_path / "w/manifest").glob("_*"))


def test_large_batch_gives_the_same_store(spark, tmp_path):
    source = land(tmp_path / "1", FIRST, {"2025-09-15": 10.0})
    later = land(tmp_path / "2", SECOND, {"2025-09-15": 1.0})
    found = []
    for large in (False, True):
        root = tmp_path / f"root{large}"
        for s in (source, later):
            outcome = batch.run(
                spark, read_citations(spark, s[0]), read_payloads(spark, s[1]), str(root), large_batch=large
            )
        found.append((stored(spark, root), outcome.rows))
    assert found[0] == found[1]


def test_damaged_lines_and_payloads_are_set_apart(spark, tmp_path):
    source, payloads = land(tmp_path, FIRST, {"2025-09-15": 10.0})
    lines = Path(source) / "citations.csv"
    lines.write_text(lines.read_text() + "Z1,2025-09-16 10:00:00,Lot,K,x,Paid,much\n")
    good = Path(payloads) / "campus=Kennesaw" / "w.json"
    (good.parent / "broken.json").write_text('{"daily": {"time": ["2025-0')
    (good.parent / "empty.json").write_text('{"daily": {}}\n')
    lines, damaged = read_quarantined(spark, source)
    root = tmp_path / "root"
    outcome = batch.run(
        spark, lines, read_payloads(spark, payloads, quarantine=True), str(root), damaged=damaged
    )
    assert outcome.failed_reports == outcome.failed_quality == {}
    assert outcome.rows["damaged_citations"] == 1 and outcome.rows["raw_citations"] == len(FIRST)
    assert outcome.rows["landed_payloads"] == 4 and outcome.rows["bad_payloads"] == 2
    assert outcome.rows["raw_weather"] == 2
    bad = {r.problem: r.text for r in spark.read.parquet(str(root / "rejected/payloads")).collect()}
    assert bad == {"not a payload": '{"daily": {"time": ["2025-0', "payload has no time axis": "{}"}
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        batch.run(spark, lines, read_payloads(spark, payloads), str(tmp_path / "strict"))
