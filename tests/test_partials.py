import pytest
from pyspark.sql import functions as F

from ticketmill import schemas
from ticketmill.plans import batch, partials
from ticketmill.plans.reports import TABLE_REPORTS

TYPES = ("No Valid Permit", "Boot Fee", "Expired Permit")


def some(citations, first, n, months=(8, 9, 10)):
    return citations(*(
        (str(i), f"2025-{months[i % len(months)]:02d}-{1 + i % 27:02d}T{i % 24:02d}:15:00", f"Lot {i % 4}",
         "KM"[i % 2], TYPES[i % 3], ("Paid", "Transfer", "Unpaid")[i % 5 % 3], (-5, 0, 35, 50)[i % 4])
        for i in range(first, first + n)
    ))


def rows(report, citations, weather):
    return sorted(map(str, report.frame(citations, weather).collect()))


def test_two_loads_give_the_reports_of_one(spark, citations, weather, tmp_path, monkeypatch):
    out = batch.Layout(str(tmp_path / "root"))
    sky = weather(*((f"2025-{m:02d}-{d:02d}", c, 9.0, 1.0, float(d % 3), 0) for m in (8, 9, 10) for d in range(1, 28) for c in "KM"))
    batch.merge_weather(spark, sky, out.weather)
    made = []
    renew = partials.renew_months
    monkeypatch.setattr(partials, "renew_months", lambda *a: made.append(renew(*a)) or made[-1])
    loads = [some(citations, 0, 120), some(citations, 100, 60, months=(10, 11))]
    for load in loads:
        batch.counted_merge(spark, load, out)
        assert batch.table_reports(spark, out).failed == {}
    assert made == [{"202508", "202509", "202510"}, {"202510", "202511"}]
    whole = batch.stored_citations(spark, out.citations)
    assert whole.count() == 160
    kept = partials.read_sums(spark, out.report_sums)
    for report in TABLE_REPORTS:
        assert rows(report, partials.sums_of(kept, report.name), sky) == rows(report, whole, sky)
    assert partials.renew_months(spark, out.report_sums, out.citations) == set()


def test_a_load_that_breaks_off_leaves_no_old_sums(spark, citations, tmp_path, monkeypatch):
    out = batch.Layout(str(tmp_path / "root"))
    batch.counted_merge(spark, some(citations, 0, 30), out)
    partials.renew_months(spark, out.report_sums, out.citations)

    def broken(*args, **kwargs):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(batch, "append_citations", broken)
        with pytest.raises(OSError):
            batch.counted_merge(spark, some(citations, 30, 30, months=(9,)), out)
    assert partials.renew_months(spark, out.report_sums, out.citations) == {"202509"}
    kept = partials.read_sums(spark, out.report_sums)
    n = partials.sums_of(kept, "status_breakdown").agg(F.sum("n_rows")).first()[0]
    assert n == batch.stored_citations(spark, out.citations).count() == 30


def test_only_lacking_months_are_read(spark, citations, tmp_path):
    path = str(tmp_path / "c")
    batch.merge_citations(spark, some(citations, 0, 60), path)
    stored = batch.stored_citations(spark, path)
    plan = partials.month_sums(stored.filter((F.col("year") * 100 + F.col("month")).isin([202509])))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "202509" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert {r[partials.MONTH] for r in plan.collect()} == {"202509"}
    assert partials.stored_months(spark, path) == {"202508", "202509", "202510"}
    assert partials.stored_months(spark, str(tmp_path / "none")) == set()
    assert schemas.CITATIONS["campus"] in partials.PARTIALS.fields
