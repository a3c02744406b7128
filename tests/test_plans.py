"""What the physical plans must and must not contain."""

import re

import pytest

from checks import tables
from checks.queries import QUERIES
from tests.conftest import SF
from ticketmill import schemas
from ticketmill.operators import joins
from ticketmill.plans import reports
from ticketmill.sources.scans import read_table
from ticketmill.sources.sinks import write_zone


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("plans")
    write_zone(tables.citations(spark, SF), str(root / "c"), ["year", "month"])
    write_zone(tables.weather(spark, SF), str(root / "w"))
    return (
        read_table(spark, str(root / "c"), schemas.CITATIONS),
        read_table(spark, str(root / "w"), schemas.WEATHER),
    )


EAGER = ("batch_reports", "stage_counts", "raw_scan", "zone_scan", "report_sink")
LAZY = [name for name in QUERIES if name not in EAGER]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not re.search("CartesianProduct|BroadcastNestedLoop|Python|Pandas|Arrow", text)


@pytest.mark.parametrize("name", ["clean_fact", "clean_dim", "payload_flatten", "calendar_columns",
                                  "validate_schedule"])
def test_row_wise_steps_do_not_shuffle(spark, name):
    assert "Exchange" not in plan(QUERIES[name](spark, SF))


def test_report_scan_is_pruned_and_filtered(stored):
    text = plan(reports.hourly_patterns(stored[0]))
    assert "PushedFilters: [IsNotNull(is_credit_adjustment)," in text
    assert "Not(EqualTo(is_credit_adjustment,true))" in text
    (schema,) = re.findall(r"ReadSchema: struct<(.*?)>", text)
    columns = {c.split(":")[0] for c in schema.split(",")}
    assert {"hour", "campus", "is_credit_adjustment"} <= columns
    assert not columns & {"timestamp", "location", "status", "violation_type", "semester"}


def test_exclusion_reaches_the_scan(spark, tmp_path):
    from ticketmill.operators.citations import clean_citations

    tables.citations_raw(spark, SF).write.parquet(str(tmp_path / "raw"))
    text = plan(clean_citations(spark.read.parquet(str(tmp_path / "raw"))))
    assert "PushedFilters: [Or(IsNull(`Violation Type`),Not(EqualTo(`Violation Type`," in text


def test_month_filter_prunes_partitions(stored):
    text = plan(stored[0].filter("year = 2024 AND month = 1"))
    assert re.search(r"PartitionFilters: \[isnotnull\(year.*month", text)


def test_top_k_is_not_a_full_sort(stored):
    assert "TakeOrderedAndProject" in plan(reports.top_locations(stored[0]))


@pytest.mark.parametrize("report", [reports.weather_citation_correlation, reports.weather_hourly])
def test_citations_are_aggregated_before_they_are_shuffled(spark, stored, report):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if both were large
        text = plan(report(*stored))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    lines = text.splitlines()
    scan = next(
        i for i, x in enumerate(lines) if "is_credit_adjustment" in x and "FileScan" in x
    )
    above = "\n".join(lines[:scan])
    last_exchange = above.rindex("Exchange hashpartitioning")
    assert "partial_sum" in above[last_exchange:]


def test_weather_is_broadcast_only_while_it_is_small(spark, stored):
    assert "BroadcastHashJoin" in plan(joins.attach_weather(*stored))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
        text = plan(joins.attach_weather(*stored))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_small_batch_does_not_shuffle_the_stored_citations(spark, stored):
    from ticketmill.operators.merge import absent_rows

    new = absent_rows(stored[0], tables.citations(spark, SF), "citation_id", "_seq")
    lines = plan(new).splitlines()
    scan = next(i for i, line in enumerate(lines)
                if "FileScan" in line and "ReadSchema: struct<citation_id:string>" in line)
    depth = lines[scan].index("FileScan")
    for line in reversed(lines[:scan]):  # walk up to the join that holds the scan
        if "BroadcastHashJoin" in line and line.index("BroadcastHashJoin") < depth:
            break
        assert "Exchange" not in line
