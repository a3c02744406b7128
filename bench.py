"""Time the job stages, the reports over stored tables, and single operators; print one JSON line.

`python bench.py [name ...]` restricts it to some of them. Stage and report names match the table
time covers scan and cleaning too.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

from checks import queries, tables
from checks.compare import session
from ticketmill import schemas
from ticketmill.plans import batch
from ticketmill.plans.reports import TABLE_REPORTS, ZONE_REPORTS
from ticketmill.settings import WeatherRules
from ticketmill.sources.scans import read_table

OPERATORS = (
    "clean_fact",
    "clean_dim",
    "condition_correlation",
    "condition_hourly",
    "fact_enrichment",
    "insert_if_absent",
    "replace_by_key",
    "payload_flatten",
    "fact_quality",
    "join_coverage",
)


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def stages(spark, sf_dir: str) -> tuple[list[tuple[str, Callable]], Callable[[], batch.Layout]]:
    """The job, one stage per entry, each time in a new folder."""
    citations = queries.landed_citations(spark, sf_dir)
    payloads = queries.landed_payloads(spark, sf_dir)
    out: list[batch.Layout] = []

    def ingest():
        out.append(batch.Layout(tables.scratch(spark, "bench")))
        batch.ingest(citations, payloads, out[-1])

    return [
        ("stage_ingest", ingest),
        (
            "stage_transform",
            lambda: batch.transform(spark, out[-1], tables.RULES, WeatherRules()),
        ),
        ("stage_merge", lambda: batch.merge(spark, out[-1])),
        ("stage_table_reports", lambda: batch.table_reports(spark, out[-1])),
        ("stage_zone_reports", lambda: batch.zone_reports(spark, out[-1])),
    ], lambda: out[-1]


def measure(
    work: list[tuple[str, Callable]], seconds: dict[str, float], repeats: int = 3
) -> None:
    """One warm-up and some repeats of the list in order; keeps the best time of each entry."""
    for repeat in range(repeats + 1):
        for name, function in work:
            start = time.perf_counter()
            function()
            took = round(time.perf_counter() - start, 3)
            if repeat:
                seconds[name] = min(took, seconds.get(name, took))


def main(only: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    seconds: dict[str, float] = {}
    job, layout = stages(spark, sf_dir)
    measure(job, seconds)

    def report(r, citations, weather):
        return f"report_{r.name}", lambda: noop(r.frame(citations, weather))

    out = layout()
    stored = (
        read_table(spark, out.citations, schemas.CITATIONS),
        batch.read_weather(spark, out.weather),
    )
    reports = [report(r, *stored) for r in (*TABLE_REPORTS, *ZONE_REPORTS)]
    operators = [
        (name, lambda name=name: noop(queries.QUERIES[name](spark, sf_dir))) for name in OPERATORS
    ]
    measure([w for w in reports if not only or w[0] in only], seconds, repeats=8)
    measure([w for w in operators if not only or w[0] in only], seconds)
    tables.remove_scratch(spark)
    print(
        json.dumps(
            {
                "metric": "job stages, reports and operators, best time of each, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:])
