"""The batch job: ingest, clean, merge into the stored tables, report.

Every stage writes Parquet under one root and the next stage reads it back, so a lost executor or
a restarted driver never recomputes more than one stage. Run again on the same input, known citations
are skipped and weather rows are replaced by themselves; only citations without an id, which nothing
can recognise, are added again. Outcome counts them.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ticketmill import schemas
from ticketmill.operators.citations import clean_citations
from ticketmill.operators.merge import (
    absent_rows,
    has_key,
    replace_by_key,
    staged_batch,
    unstored,
)
from ticketmill.operators.weather import clean_weather
from ticketmill.plans import partials, quality
from ticketmill.plans.reports import TABLE_REPORTS, ZONE_REPORTS, Report
from ticketmill.settings import CAMPUSES, CitationRules, WeatherRules
from ticketmill.sources.payload import bad_payloads, flatten_payloads, key_spine, load_window
from ticketmill.sources.scans import CORRUPT, read_table
from ticketmill.sources.sinks import create_table, write_listing, write_report, write_zone
from ticketmill.sources.versions import read_versions, replace_partitions

log = logging.getLogger(__name__)

SEQ = schemas.SEQ
MONTH = "_month"


@dataclass(frozen=True)
class Layout:
    """Where the zones, tables and reports live below the root."""

    root: str

    def path(self, *parts: str) -> str:
        return "/".join((self.root.rstrip("/"), *parts))

    @property
    def raw_citations(self) -> str:
        return self.path("raw", "citations")

    @property
    def raw_weather(self) -> str:
        return self.path("raw", "weather")

    @property
    def clean_citations(self) -> str:
        return self.path("processed", "citations")

    @property
    def clean_weather(self) -> str:
        return self.path("processed", "weather")

    @property
    def citations(self) -> str:
        return self.path("tables", "citations")

    @property
    def weather(self) -> str:
        return self.path("tables", "daily_weather")

    @property
    def report_sums(self) -> str:
        return self.path("tables", "report_sums")

    @property
    def staged_citations(self) -> str:
        return self.path("staged", "citations")

    @property
    def rejected_citations(self) -> str:
        return self.path("rejected", "citations")

    @property
    def rejected_payloads(self) -> str:
        return self.path("rejected", "payloads")

    @property
    def damaged_citations(self) -> str:
        return self.path("rejected", "lines")

    @property
    def reports(self) -> str:
        return self.path("reports")

    @property
    def quality(self) -> str:
        return self.path("quality")


@dataclass
class Outcome:
    """Rows of each stage and report, and the errors of what failed. Of the clean citations, each is
    rejected, repeated in its batch, known already, or inserted: the four add up."""

    rows: dict[str, int] = field(default_factory=dict)
    failed_reports: dict[str, str] = field(default_factory=dict)
    failed_quality: dict[str, str] = field(default_factory=dict)


def side_by_side(work: Mapping[str, Callable[[], object]], workers: int = 8) -> dict:
    """Run independent jobs at once, so that the tail of one does not leave executors idle."""
    with ThreadPoolExecutor(workers) as pool:
        running = {name: pool.submit(job) for name, job in work.items()}
    return {name: job.result() for name, job in running.items()}


def write_counted(df: DataFrame, path: str, *args, **kwargs) -> int:
    """write_zone(), returning the row count that the write itself measured."""
    seen = Observation()
    write_zone(df, path, *args, seen=seen, **kwargs)
    return seen.get["rows"]


def ingest(
    citations: DataFrame, payloads: DataFrame, out: Layout, damaged: DataFrame | None = None
) -> dict[str, int]:
    """Land both sources in the raw zone, before any cleaning.

    Payloads read with `quarantine` (they have a column CORRUPT) don't fail the job: bad ones go to a zone by the
    reason, and the payloads are counted, so landed ones are the flattened and the bad ones. `damaged`: lines of
    the citations that read_quarantined() set apart; they are kept and counted too."""
    lenient = CORRUPT in payloads.columns
    source = payloads.filter(F.col(CORRUPT).isNull()).drop(CORRUPT) if lenient else payloads
    weather = flatten_payloads(source, strict=not lenient, seq=SEQ)
    work = {
        "raw_citations": lambda: write_counted(citations, out.raw_citations),
        "raw_weather": lambda: write_counted(weather, out.raw_weather),
    }
    if lenient:
        bad = bad_payloads(payloads, ("campus", SEQ))
        work["bad_payloads"] = lambda: write_counted(bad, out.rejected_payloads, ["problem"])
        work["landed_payloads"] = payloads.count
    if damaged is not None:
        work["damaged_citations"] = lambda: write_counted(damaged, out.damaged_citations)
    return side_by_side(work)


def transform(
    spark: SparkSession, out: Layout, citation_rules: CitationRules, weather_rules: WeatherRules
) -> dict[str, int]:
    citations = clean_citations(spark.read.parquet(out.raw_citations), citation_rules, [SEQ])
    weather = clean_weather(spark.read.parquet(out.raw_weather), weather_rules, [SEQ])
    return side_by_side(
        {
            "clean_citations": lambda: write_counted(citations, out.clean_citations),
            "clean_weather": lambda: write_counted(weather, out.clean_weather),
        }
    )


def stored_citations(
    spark: SparkSession, path: str, partition_by: Sequence[str] = ("year", "month")
) -> DataFrame:
    create_table(spark, path, schemas.CITATIONS, partition_by)
    return read_table(spark, path, schemas.CITATIONS)


def append_citations(
    new: DataFrame, path: str, partition_by: Sequence[str] = ("year", "month"), rebalance: bool = True
) -> int:
    """Append rows to the stored citations, sorted by id within each file and with a Bloom filter of the ids, so
    that later loads can look up single ids."""
    return write_counted(
        new, path, partition_by, mode="append", rebalance=rebalance, lookup_key=schemas.CITATION_KEY
    )


def merge_citations(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("year", "month"),
    rebalance: bool = True,
    large_batch: bool = False,
) -> int:
    """Append the batch rows whose id is not stored yet; return how many.

    Stored files are never rewritten. The default partitions are derived integers: a text column
    would lose the difference between an empty string and NULL in its directory name.
    """
    stored = stored_citations(spark, path, partition_by)
    new = absent_rows(
        stored, batch, schemas.CITATION_KEY, SEQ, schemas.CITATION_REQUIRED, large_batch
    )
    return append_citations(new, path, partition_by, rebalance)


def counted_merge(
    spark: SparkSession, batch: DataFrame, out: Layout, large_batch: bool = False
) -> dict[str, int]:
    """merge_citations(), with a count of every row that it does not insert; incomplete rows are kept
    in a zone of their own.

    The batch is read and shuffled once, to a staging zone with one row for each id; the write counts as it
    goes. What follows reads that zone."""
    key, required = schemas.CITATION_KEY, schemas.CITATION_REQUIRED
    staged = staged_batch(batch.select(*schemas.CITATIONS.names, SEQ), key, SEQ, required)
    complete, copies, seen = F.col("complete"), F.col("copies"), Observation()
    staged.observe(
        seen,
        F.count_if(~complete).alias("rejected"),
        F.count_if(complete & ~has_key(key)).alias("unkeyed"),
        F.count_if(complete & has_key(key)).alias("ids"),
        F.coalesce(F.sum(F.when(complete, copies - 1)), F.lit(0)).alias("repeated"),
    ).write.mode("overwrite").partitionBy("complete").parquet(out.staged_citations)
    n = seen.get
    rows = read_table(
        spark, out.staged_citations, schemas.STAGED_CITATIONS
    )
    fresh = rows.filter("complete").select(*schemas.CITATIONS.names)
    rejected = rows.filter("NOT complete").select(*schemas.CITATIONS.names, SEQ)
    stored = stored_citations(spark, out.citations)
    month = partials.month_name(F.col("year"), F.col("month"))
    touched = {r[0] for r in fresh.select(month).distinct().collect()}
    partials.forget_months(spark, out.report_sums, touched)
    new = unstored(stored, fresh, key, n["ids"], large_batch)
    work = side_by_side(
        {
            "rejected": lambda: write_counted(rejected, out.rejected_citations),
            "inserted": lambda: append_citations(new, out.citations),
        }
    )
    return {
        "rejected_citations": work["rejected"],
        "repeated_citations": n["repeated"],
        "known_citations": n["ids"] - (work["inserted"] - n["unkeyed"]),
        "inserted_citations": work["inserted"],
        "inserted_without_id": n["unkeyed"],
    }


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    return read_versions(spark, path, schemas.WEATHER)


def merge_weather(spark: SparkSession, batch: DataFrame, path: str) -> int:
    """Replace or add the batch rows; return the number of stored rows.

    Only the months that the batch has are read and written, to new folders; the switch to them is the
    last step, so a load that breaks off leaves the old rows readable, and one that runs at the same time
    loses none of its own. A NULL date fails the load, as any NULL in a key does.
    """
    month = F.date_format("date", "yyyyMM")
    months = {r[0] for r in batch.select(month).distinct().collect()}

    def merged(touched: DataFrame) -> DataFrame:
        return replace_by_key(touched, batch, schemas.WEATHER_KEY, SEQ).withColumn(MONTH, month)

    replace_partitions(spark, path, schemas.WEATHER, MONTH, months, merged)
    return read_weather(spark, path).count()


def merge(spark: SparkSession, out: Layout, large_batch: bool = False) -> dict[str, int]:
    citations = spark.read.parquet(out.clean_citations)
    weather = spark.read.parquet(out.clean_weather)
    work = side_by_side(
        {
            "citations": lambda: counted_merge(spark, citations, out, large_batch),
            "stored_weather": lambda: merge_weather(spark, weather, out.weather),
        }
    )
    return work["citations"] | {"stored_weather": work["stored_weather"]}


@dataclass
class Written:
    """Rows of what was written, errors of what failed."""

    rows: dict[str, int]
    failed: dict[str, str]


def write_each(work: Mapping[str, Callable[[], int]]) -> Written:
    """Run every write side by side; one failure stops no other."""

    def attempt(name: str) -> int | str:
        try:
            return work[name]()
        except Exception as e:
            log.exception("%s failed", name)
            return f"{type(e).__name__}: {e}"

    done = side_by_side({name: partial(attempt, name) for name in work})
    return Written(
        {name: n for name, n in done.items() if isinstance(n, int)},
        {name: error for name, error in done.items() if isinstance(error, str)},
    )


def run_reports(
    reports: Sequence[Report],
    citations: Callable[[], DataFrame],
    weather: Callable[[], DataFrame],
    directory: str,
) -> Written:
    """Write every report. The tables are opened for each one, so a report fails alone."""

    def write(report: Report) -> int:
        rows = report.rows(citations(), weather() if report.uses_weather else None)
        return write_report(rows, f"{directory}/{report.name}", report.sort_columns())

    return write_each({r.name: partial(write, r) for r in reports})


def table_reports(spark: SparkSession, out: Layout) -> Written:
    """Six reports over the stored tables, from the sums that are kept for each month: only months that the last
    loads touched are read from the citations. Where the sums can't be made, no report is."""
    try:
        renewed = partials.renew_months(spark, out.report_sums, out.citations)
        kept = partials.read_sums(spark, out.report_sums)
    except Exception as e:
        log.exception("report sums failed")
        return Written({}, {r.name: f"{type(e).__name__}: {e}" for r in TABLE_REPORTS})
    log.info("report sums made for %s months", len(renewed))

    def write(report: Report) -> int:
        sums = partials.sums_of(kept, report.name)
        rows = report.rows(sums, read_weather(spark, out.weather) if report.uses_weather else None)
        return write_report(rows, f"{out.reports}/{report.name}", report.sort_columns())

    return write_each({r.name: partial(write, r) for r in TABLE_REPORTS})


def zone_reports(spark: SparkSession, out: Layout) -> Written:
    """Two reports over the clean zone of this batch."""
    return run_reports(
        ZONE_REPORTS,
        lambda: read_table(spark, out.clean_citations, schemas.CITATIONS),
        lambda: read_table(spark, out.clean_weather, schemas.WEATHER),
        f"{out.reports}/spark",
    )


def check_quality(
    spark: SparkSession,
    out: Layout,
    citation_rules: CitationRules,
    weather_rules: WeatherRules,
    campuses: Sequence[str] = CAMPUSES,
) -> Written:
    """Metrics of this batch as CSV, next to the reports; listings that can grow are in parts."""

    def citations() -> DataFrame:
        return read_table(spark, out.clean_citations, schemas.CITATIONS)

    def weather() -> DataFrame:
        return read_table(spark, out.clean_weather, schemas.WEATHER)

    def metrics(name: str, df: DataFrame) -> int:
        return write_report(df, f"{out.quality}/{name}", [F.col(df.columns[0])])

    def listing(name: str, df: DataFrame) -> int:
        return write_listing(df, f"{out.quality}/{name}")

    def keys() -> int:
        """The days and campuses that citations use, read by both checks of the weather's keys."""
        used = f"{out.quality}/citation_keys"
        write_zone(citations().select(*schemas.WEATHER_KEY).distinct(), used)
        rows = spark.read.parquet(used)
        return metrics("join_coverage", quality.join_coverage(rows, weather())) + listing(
            "missing_keys", quality.missing_keys(rows, weather())
        )

    def gaps() -> DataFrame:
        return quality.missing_keys(key_spine(load_window(citations()), campuses), weather())

    return write_each(
        {
            "citations": lambda: metrics(
                "citations",
                quality.citation_quality(spark.read.parquet(out.raw_citations), citation_rules),
            ),
            "weather": lambda: metrics(
                "weather", quality.weather_quality(spark.read.parquet(out.raw_weather), weather_rules)
            ),
            "anomalies": lambda: listing("anomalies", quality.anomalies(citations())),
            "keys": keys,
            "weather_gaps": lambda: listing("weather_gaps", gaps()),
            "weather_gap_ranges": lambda: listing("weather_gap_ranges", quality.gap_ranges(gaps())),
        }
    )


def run(
    spark: SparkSession,
    citations: DataFrame,
    payloads: DataFrame,
    root: str,
    citation_rules: CitationRules = CitationRules(),
    weather_rules: WeatherRules = WeatherRules(),
    large_batch: bool = False,
    damaged: DataFrame | None = None,
) -> Outcome:
    """All stages in order, from frames as sources.scans returns them. `large_batch`: see operators.merge.unstored();
    `damaged`: see ingest()."""
    out = Layout(root)
    outcome = Outcome()
    for stage, work in {
        "ingest": lambda: ingest(citations, payloads, out, damaged),
        "transform": lambda: transform(spark, out, citation_rules, weather_rules),
        "merge": lambda: merge(spark, out, large_batch),
    }.items():
        rows = work()
        log.info("%s: %s", stage, rows)
        outcome.rows |= rows
    last = side_by_side(
        {
            "tables": lambda: table_reports(spark, out),
            "zones": lambda: zone_reports(spark, out),
            "quality": lambda: check_quality(spark, out, citation_rules, weather_rules),
        }
    )
    outcome.failed_reports = last["tables"].failed | last["zones"].failed
    outcome.failed_quality = last["quality"].failed
    for written in (last["tables"], last["zones"]):
        outcome.rows |= {f"report_{name}": n for name, n in written.rows.items()}
    log.info("reports: %s failed", len(outcome.failed_reports))
    return outcome
