"""One query per operator. Each takes (spark, sf_dir) and reads whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import tables as t
from ticketmill import schemas
from ticketmill.operators import citations as c
from ticketmill.operators import joins, merge, ranges
from ticketmill.operators import weather as w
from ticketmill.plans import batch, partials, quality, reports
from ticketmill.plans.views import register_views
from ticketmill.settings import WeatherRules
from ticketmill.sources import payload, scans, sinks

SEQ = schemas.SEQ
REPORTS = {r.name: r for r in (*reports.TABLE_REPORTS, *reports.ZONE_REPORTS)}


def _named(spark, sf):
    return t.citations_raw(spark, sf).withColumnsRenamed(schemas.CLEAN_NAMES)


def exclude_filter(spark, sf):
    kept = c.exclude_values(_named(spark, sf), "violation_type", t.RULES.excluded_types)
    return kept.select("citation_id", "violation_type")


def trim_columns(spark, sf):
    return c.trim_columns(_named(spark, sf), c.TRIMMED).select("citation_id", *c.TRIMMED)


def flag_negative(spark, sf):
    flagged = c.flag_negative(t.table(spark, sf, "customer"), "c_acctbal", "is_credit")
    return flagged.select("c_custkey", "c_acctbal", "is_credit")


def validate_schedule(spark, sf):
    trimmed = c.trim_columns(_named(spark, sf), c.TRIMMED)
    flagged = c.flag_negative(trimmed, "fine_amount", "is_credit_adjustment")
    return c.validate_amount(flagged, t.RULES.schedule, t.RULES.zero_fine_statuses).select(
        "citation_id", "violation_type", "status", "fine_amount", "fine_validated"
    )


def calendar_columns(spark, sf):
    return c.add_calendar(_named(spark, sf)).select(
        "citation_id", "date", "year", "month", "day_of_week", "hour"
    )


def range_label(spark, sf):
    return c.label_period(_named(spark, sf), t.RULES.semesters).select("citation_id", "semester")


def range_label_orders(spark, sf):
    ranges = [(str(y), f"{y}-02-01", f"{y}-11-30") for y in range(1995, 2001)]
    labelled = c.label_period(
        t.table(spark, sf, "orders"), ranges, "o_orderdate", "season", whole_last_day=True
    )
    return labelled.select("o_orderkey", "season")


def default_rules(spark, sf):
    """Cleaned by the default rules: every amount of the schedule, every excusing status, both semesters."""
    return c.clean_citations(t.ruled_citations(spark, sf), keep=[SEQ]).select(
        SEQ, "violation_type", "status", "fine_amount", "is_credit_adjustment", "fine_validated", "semester"
    )


def default_weather_rules(spark, sf):
    """Every weather code from 0 to 100, and precipitation on and around the bounds of the buckets."""
    rules, e = WeatherRules(), F.col(SEQ)
    rows = t.readings_raw(spark, sf).withColumns(
        {"weathercode": (e % 101).cast("int"), "precipitation_sum": (e % 41).cast("double") * 0.5}
    )
    rows = w.label_codes(rows, rules.code_labels)
    rows = w.add_bucket(rows, rules.dry_label, rules.upper_bounds, rules.wettest_label)
    return rows.select(SEQ, "weathercode", "condition_label", "precipitation_sum", "precip_bucket")


def sql_daily_weather(spark, sf):
    """Both views in one query."""
    register_views(t.citations(spark, sf).drop(SEQ), t.weather(spark, sf).drop(SEQ))
    return spark.sql("""
        SELECT w.condition_label, w.precip_bucket, COUNT(DISTINCT w.date, w.campus) AS weather_days,
               COUNT(c.citation_id) AS citation_count
        FROM daily_weather w LEFT JOIN citations c
          ON c.date = w.date AND c.campus = w.campus AND c.is_credit_adjustment = 0
        GROUP BY w.condition_label, w.precip_bucket
    """)


def range_lookup_join(spark, sf):
    """Every citation with the last of thousands of overlapping shifts."""
    rows = _named(spark, sf).select(SEQ, "timestamp")
    return ranges.range_lookup_join(rows, t.shifts(spark, sf), "timestamp", "shift", "Unknown")


def range_lookup_whole_days(spark, sf):
    rows = _named(spark, sf).select(SEQ, "timestamp")
    return ranges.range_lookup_join(rows, t.shifts(spark, sf), "timestamp", "shift", whole_last_day=True)


def clean_fact(spark, sf):
    return t.citations(spark, sf).drop(SEQ)


def parse_date(spark, sf):
    return w.parse_date(t.readings_raw(spark, sf)).select(SEQ, "date")


def parse_date_lenient(spark, sf):
    damaged = t.readings_raw(spark, sf).withColumn(
        "date", F.when(F.col(SEQ) % 50 == 0, "n/a").otherwise(F.col("date"))
    )
    return w.parse_date(damaged, strict=False).select(SEQ, "date")


def round_fill_dim(spark, sf):
    return (
        t.readings_raw(spark, sf)
        .transform(w.round_measures, w.DECIMAL_PLACES)
        .transform(w.fill_missing, "precipitation_sum", 0.0)
        .select(SEQ, *w.DECIMAL_PLACES)
    )


def code_label(spark, sf):
    labelled = w.label_codes(t.readings_raw(spark, sf), WeatherRules().code_labels)
    return labelled.select(SEQ, "weathercode", "condition_label")


def bucketize(spark, sf):
    rules = WeatherRules()
    rows = t.readings_raw(spark, sf)
    return w.add_bucket(
        rows, rules.dry_label, rules.upper_bounds, rules.wettest_label
    ).select(SEQ, "precipitation_sum", "precip_bucket")


def clean_dim(spark, sf):
    return t.readings(spark, sf)


def _report(name):
    report = REPORTS[name]

    def query(spark, sf):
        weather = t.weather(spark, sf) if report.uses_weather else None
        return report.frame(t.citations(spark, sf), weather)

    return query


def citation_rollup(spark, sf):
    return reports.rollup(t.citations(spark, sf))


def condition_correlation_preagg(spark, sf):
    """The report from a roll-up of the citations."""
    rolled = reports.rollup(t.citations(spark, sf))
    return REPORTS["weather_citation_correlation"].frame(rolled, t.weather(spark, sf))


def sql_status_share(spark, sf):
    """The views, queried with plain SQL."""
    register_views(t.citations(spark, sf).drop(SEQ), t.weather(spark, sf).drop(SEQ))
    return spark.sql("""
        SELECT campus, status, COUNT(*) AS citation_count,
               ROUND(100.0D * COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY campus), 2) AS pct
        FROM citations WHERE is_credit_adjustment = 0 GROUP BY campus, status
    """)


def fact_enrichment(spark, sf):
    return joins.attach_weather(t.citations(spark, sf), t.weather(spark, sf)).select(
        SEQ, "citation_id", "date", "campus", "precip_bucket", "condition_label"
    )


def fact_enrichment_salted(spark, sf):
    """The same with days that hold a large part of the citations dealt out."""
    return joins.attach_weather_salted(t.citations(spark, sf), t.weather(spark, sf), shares=200).select(
        SEQ, "citation_id", "date", "campus", "precip_bucket", "condition_label"
    )


def lookup_join(spark, sf):
    """Some customers have a nation that nobody knows, or none."""
    i, key = F.col("c_custkey"), F.col("c_nationkey")
    customers = t.table(spark, sf, "customer").select(
        "c_custkey",
        F.when(i % 17 == 3, key + 100).when(i % 19 != 4, key).alias("n_nationkey"),
    )
    nations = t.table(spark, sf, "nation")
    return joins.lookup_join(customers, nations, ["n_nationkey"], "n_name", "Unknown")


def required_columns(spark, sf):
    """Rejected rows."""
    _, rejected = merge.split_required(t.citations(spark, sf), schemas.CITATION_REQUIRED)
    return rejected.select(SEQ, *schemas.CITATION_REQUIRED)


def _insert(spark, sf, function):
    stored, incoming = t.insert_batch(spark, sf)
    return function(stored, incoming, schemas.CITATION_KEY, SEQ, schemas.CITATION_REQUIRED)


def insert_if_absent(spark, sf):
    return _insert(spark, sf, merge.insert_if_absent)


def insert_counts(spark, sf):
    return _insert(spark, sf, merge.insert_counts)


def replace_by_key(spark, sf):
    stored, incoming = t.replace_batch(spark, sf)
    return merge.replace_by_key(stored, incoming, schemas.WEATHER_KEY, SEQ)


def replace_counts(spark, sf):
    return merge.replace_counts(*t.replace_batch(spark, sf), schemas.WEATHER_KEY)


def load_window(spark, sf):
    return payload.load_window(_named(spark, sf))


def key_spine(spark, sf):
    return payload.key_spine(load_window(spark, sf), t.CAMPUSES)


def union_all(spark, sf):
    raw = t.weather_raw(spark, sf)
    frames = [raw.filter(F.col("campus") == name) for name in t.CAMPUSES]
    return joins.stack(*frames).drop(SEQ)


def payload_flatten(spark, sf):
    return payload.flatten_payloads(
        t.payloads(spark, sf), ("vec_id", "campus"), strict=False
    )


def payload_problems(spark, sf):
    return payload.bad_payloads(t.payloads(spark, sf), ("vec_id", "campus")).drop("text")


def payload_quarantine(spark, sf):
    """Payloads landed as JSON lines, every ninth broken off, and a job's first stage over them: the rows it wrote
    and what it set apart, by reason."""
    path, i = t.scratch(spark, "broken"), F.col("vec_id")
    line = F.to_json(F.struct("daily"), {"ignoreNullFields": "true"})
    cut = F.when(i % 9 == 4, F.expr("left(line, length(line) DIV 2)")).otherwise(F.col("line"))
    t.payloads(spark, sf).withColumn("line", line).select("campus", cut.alias("value")).write.partitionBy(
        "campus").text(path)
    out = batch.Layout(t.scratch(spark, "quarantine"))
    rows = batch.ingest(t.citations_raw(spark, sf), scans.read_payloads(spark, path, quarantine=True), out)
    bad = spark.read.parquet(out.rejected_payloads).groupBy("problem").agg(F.count("*").alias("n_rows"))
    counts = spark.createDataFrame(list(rows.items()), "problem string, n_rows bigint")
    return counts.unionByName(bad)


def fact_quality(spark, sf):
    return quality.citation_quality(t.citations_raw(spark, sf), t.RULES)


def dim_quality(spark, sf):
    return quality.weather_quality(t.readings_raw(spark, sf))


def bucket_counts(spark, sf):
    return quality.bucket_counts(t.readings(spark, sf))


def missing_keys(spark, sf):
    return quality.missing_keys(t.citations(spark, sf), t.weather(spark, sf))


def join_coverage(spark, sf):
    return quality.join_coverage(t.citations(spark, sf), t.weather(spark, sf))


def weather_gaps(spark, sf):
    """Days and campuses of the citations' window that have no weather."""
    spine = payload.key_spine(payload.load_window(t.citations(spark, sf)), t.CAMPUSES)
    return quality.missing_keys(spine, t.weather(spark, sf))


def weather_gap_ranges(spark, sf):
    """The same days as ranges."""
    return quality.gap_ranges(weather_gaps(spark, sf))


def days_in_bucket(spark, sf):
    """Distinct days of each hour and precipitation bucket, from bitmaps of each campus and semester that are
    merged."""
    rows = joins.attach_weather(t.citations(spark, sf), t.weather(spark, sf), ("precip_bucket",))
    parts = quality.day_bitmaps(rows, ["hour", "precip_bucket", "campus", "semester"])
    return quality.count_days(parts, ["hour", "precip_bucket"], "days_in_bucket")


def anomaly_listing(spark, sf):
    return quality.anomalies(t.citations(spark, sf))


def landed_citations(spark, sf):
    """The raw citations as a CSV file with the headers of the source, scanned again."""
    path = t.scratch(spark, "landed")
    t.citations_raw(spark, sf).drop(SEQ).withColumnRenamed(
        "citation_id", schemas.ID_HEADER
    ).write.options(
        header=True,
        timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSSSSS",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)
    return scans.read_citations(spark, path)


def raw_scan(spark, sf):
    return landed_citations(spark, sf).drop(SEQ).withColumnsRenamed(schemas.CLEAN_NAMES)


def raw_scan_quarantine(spark, sf):
    """A landed CSV file in which every 50th citation has a word for its fine and every 70th a day for
    its time, with its columns in another order and one more than declared."""
    path, e = t.scratch(spark, "damaged"), F.col(SEQ)
    raw = t.citations_raw(spark, sf)
    time = F.date_format("Timestamp", "M/d/yyyy h:mm:ss a")
    raw.select(
        e.alias("Row"),
        "Status",
        F.when(e % 50 == 0, "n/a").otherwise(F.col("Fine Amount").cast("string")).alias("Fine Amount"),
        "Campus",
        "Location",
        F.when(e % 70 == 0, "Monday").otherwise(time).alias("Timestamp"),
        "Violation Type",
        F.col("citation_id").alias(schemas.ID_HEADER),
    ).write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    good, bad = scans.read_quarantined(spark, path, timestamp_format="M/d/yyyy h:mm:ss a")
    return good.select(
        F.lit(False).alias("damaged"), "citation_id", F.col("Timestamp").alias("timestamp"),
        F.col("Fine Amount").alias("fine_amount"), F.lit(None).cast("string").alias("line_start"),
    ).unionByName(bad.select(
        F.lit(True).alias("damaged"), F.lit(None).cast("string").alias("citation_id"),
        F.lit(None).cast("timestamp_ntz").alias("timestamp"), F.lit(None).cast("int").alias("fine_amount"),
        F.split(scans.CORRUPT, ",")[0].alias("line_start"),
    ))


def zone_scan(spark, sf):
    path = t.scratch(spark, "zone")
    sinks.write_zone(t.citations(spark, sf), path, ["semester", "month"], rebalance=True)
    return scans.read_table(spark, path, schemas.CITATIONS)


def report_sink(spark, sf):
    report = REPORTS["violations_by_type"]
    path = t.scratch(spark, "report")
    sinks.write_report(report.rows(t.citations(spark, sf)), path, report.sort_columns())
    columns = "violation_type string, citation_count bigint, total_fines_collected bigint"
    return spark.read.schema(columns + ", avg_fine double").csv(path, header=True)


def landed_payloads(spark, sf):
    """The daily weather as JSON payloads, one per campus and month."""
    path = t.scratch(spark, "payloads")
    day = F.struct("date", *schemas.WEATHER_VARIABLES)
    months = (
        t.weather_raw(spark, sf)
        .groupBy("campus", F.substring("date", 1, 7).alias("month"))
        .agg(F.array_sort(F.collect_list(day)).alias("days"))
    )
    fields = {"time": "date"} | {v: v for v in schemas.WEATHER_VARIABLES}
    months.select(
        "campus",
        F.struct(*(F.col(f"days.{source}").alias(name) for name, source in fields.items())).alias(
            "daily"
        ),
    ).write.partitionBy("campus").option("ignoreNullFields", False).json(path)
    return scans.read_payloads(spark, path)


def stage_counts(spark, sf):
    """Rows that each stage of the job read or wrote, as the writes themselves counted them."""
    out = batch.Layout(t.scratch(spark, "stages"))
    rows = batch.ingest(landed_citations(spark, sf), landed_payloads(spark, sf), out)
    rows |= batch.transform(spark, out, t.RULES, WeatherRules())
    rows |= batch.merge(spark, out)
    return spark.createDataFrame(list(rows.items()), "stage string, n_rows bigint")


def _report_values(spark, found, directory) -> DataFrame:
    """Every value of the report files in a directory."""

    def values(report):
        lines = spark.read.csv(f"{directory}/{report.name}", header=True)
        keys = _GROUP_KEYS[report.name]
        measures = [c for c in lines.columns if c not in keys]
        return lines.select(
            F.lit(report.name).alias("report"),
            F.concat_ws("|", *(F.coalesce(F.col(k), F.lit("-")) for k in keys)).alias("keys"),
            *(F.col(m).cast("double").alias(m) for m in measures),
        ).unpivot(["report", "keys"], measures, "measure", "value")

    return reduce(DataFrame.unionByName, [values(r) for r in found])


def batch_reports(spark, sf) -> DataFrame:
    """The whole job from landed files; every value of all eight report files."""
    out = batch.Layout(t.scratch(spark, "batch"))
    batch.run(spark, landed_citations(spark, sf), landed_payloads(spark, sf), out.root, t.RULES)
    return _report_values(spark, reports.TABLE_REPORTS, out.reports).unionByName(
        _report_values(spark, reports.ZONE_REPORTS, f"{out.reports}/spark")
    )


def reports_after_two_loads(spark, sf) -> DataFrame:
    """Every value of the six table reports, after a load of one half of the citations, the reports, a load of
    the rest, and the reports again from the sums that both loads left."""
    out = batch.Layout(t.scratch(spark, "loads"))
    rows, half = t.citations(spark, sf), F.col("semester") == "First half"
    batch.merge_weather(spark, t.weather(spark, sf), out.weather)
    for part in (rows.filter(half), rows.filter(~half)):
        batch.counted_merge(spark, part, out)
        batch.table_reports(spark, out)
    return _report_values(spark, reports.TABLE_REPORTS, out.reports)


def month_sums(spark, sf) -> DataFrame:
    """What is kept of each month for the reports."""
    return partials.month_sums(t.citations(spark, sf))


_GROUP_KEYS = {
    "violations_by_type": ["violation_type"],
    "monthly_volume_by_campus": ["semester", "year", "month", "campus"],
    "top_locations": ["campus", "location"],
    "status_breakdown": ["semester", "status"],
    "hourly_patterns": ["hour", "campus"],
    "weather_citation_correlation": ["precip_bucket", "condition_label", "campus"],
    "violation_summary_spark": ["violation_type", "campus"],
    "weather_hourly_spark": ["hour", "precip_bucket"],
}

QUERIES = {
    "exclude_filter": exclude_filter,
    "trim_columns": trim_columns,
    "flag_negative": flag_negative,
    "validate_schedule": validate_schedule,
    "calendar_columns": calendar_columns,
    "range_label": range_label,
    "range_label_orders": range_label_orders,
    "default_rules": default_rules,
    "default_weather_rules": default_weather_rules,
    "sql_daily_weather": sql_daily_weather,
    "range_lookup_join": range_lookup_join,
    "range_lookup_whole_days": range_lookup_whole_days,
    "clean_fact": clean_fact,
    "parse_date": parse_date,
    "parse_date_lenient": parse_date_lenient,
    "round_fill_dim": round_fill_dim,
    "code_label": code_label,
    "bucketize": bucketize,
    "clean_dim": clean_dim,
    "category_summary": _report("violations_by_type"),
    "monthly_volume": _report("monthly_volume_by_campus"),
    "top_locations": _report("top_locations"),
    "status_share": _report("status_breakdown"),
    "hourly_patterns": _report("hourly_patterns"),
    "condition_correlation": _report("weather_citation_correlation"),
    "condition_correlation_preagg": condition_correlation_preagg,
    "category_site_summary": _report("violation_summary_spark"),
    "condition_hourly": _report("weather_hourly_spark"),
    "citation_rollup": citation_rollup,
    "sql_status_share": sql_status_share,
    "fact_enrichment": fact_enrichment,
    "fact_enrichment_salted": fact_enrichment_salted,
    "lookup_join": lookup_join,
    "required_columns": required_columns,
    "insert_if_absent": insert_if_absent,
    "insert_counts": insert_counts,
    "replace_by_key": replace_by_key,
    "replace_counts": replace_counts,
    "load_window": load_window,
    "key_spine": key_spine,
    "union_all": union_all,
    "payload_flatten": payload_flatten,
    "payload_problems": payload_problems,
    "fact_quality": fact_quality,
    "dim_quality": dim_quality,
    "bucket_counts": bucket_counts,
    "missing_keys": missing_keys,
    "join_coverage": join_coverage,
    "weather_gaps": weather_gaps,
    "weather_gap_ranges": weather_gap_ranges,
    "days_in_bucket": days_in_bucket,
    "payload_quarantine": payload_quarantine,
    "anomaly_listing": anomaly_listing,
    "raw_scan": raw_scan,
    "raw_scan_quarantine": raw_scan_quarantine,
    "zone_scan": zone_scan,
    "report_sink": report_sink,
    "stage_counts": stage_counts,
    "batch_reports": batch_reports,
    "reports_after_two_loads": reports_after_two_loads,
    "month_sums": month_sums,
}
