"""The queries again, as DuckDB SQL over the same tables."""

from __future__ import annotations

CITATIONS_RAW = """
citations_raw AS (
  SELECT CASE WHEN event_id % 733 <> 1 THEN CAST(event_id AS VARCHAR) END AS citation_id,
         CASE WHEN event_id % 727 <> 2 THEN ts END AS "timestamp",
         '  Lot ' || CAST(user_id % 37 AS VARCHAR) || ' ' AS location,
         CASE WHEN user_id % 8 = 0 THEN chr(9) || 'South' || chr(160)
              WHEN user_id % 4 = 0 THEN 'South '
              WHEN event_id % 743 <> 8 THEN 'North' END AS campus,
         CASE WHEN event_id % 997 = 5 THEN 'DO NOT USE/TESTING'
              WHEN event_id % 997 = 6 THEN 'DO NOT USE/TESTING '
              WHEN event_id % 701 <> 9 THEN event_type END AS violation_type,
         CASE WHEN event_id % 719 = 4 THEN NULL
              WHEN event_id % 5 = 0 THEN 'Unpaid' WHEN event_id % 5 = 1 THEN 'Transfer'
              WHEN event_id % 5 = 2 THEN 'Zero Balance' WHEN event_id % 5 = 3 THEN 'Inactive'
              ELSE 'Appeal Balance Due' END AS status,
         CAST(CASE WHEN event_id % 709 = 3 THEN NULL WHEN event_id % 601 = 7 THEN -50
                   WHEN event_id % 3 = 0 THEN 0 WHEN event_id % 41 = 1 THEN 40
                   WHEN event_type IN ('click', 'view') THEN 35 ELSE 50 END AS INTEGER)
           AS fine_amount,
         event_id AS _seq
  FROM events)"""

TRIMMED = """
trimmed AS (
  SELECT citation_id, "timestamp",
         trim(location, ' ' || chr(9) || chr(160)) AS location,
         trim(campus, ' ' || chr(9) || chr(160)) AS campus,
         trim(violation_type, ' ' || chr(9) || chr(160)) AS violation_type,
         trim(status, ' ' || chr(9) || chr(160)) AS status,
         fine_amount, _seq, violation_type IS NOT DISTINCT FROM 'DO NOT USE/TESTING' AS excluded
  FROM citations_raw)"""

TAGGED = """
tagged AS (
  SELECT *, CAST("timestamp" AS DATE) AS date,
         CAST(year("timestamp") AS INTEGER) AS year, CAST(month("timestamp") AS INTEGER) AS month,
         dayname("timestamp") AS day_of_week, CAST(hour("timestamp") AS INTEGER) AS hour,
         coalesce(fine_amount < 0, FALSE) AS is_credit_adjustment,
         coalesce(status IN ('Transfer', 'Zero Balance', 'Inactive'), FALSE)
           OR coalesce(fine_amount < 0, FALSE)
           OR coalesce(fine_amount = CASE WHEN violation_type IN ('click', 'view') THEN 35
                                          WHEN violation_type IN ('purchase', 'signup') THEN 50
                                     END, FALSE) AS fine_validated,
         CASE WHEN "timestamp" BETWEEN TIMESTAMP '2024-01-16' AND TIMESTAMP '2024-01-29'
                THEN 'Second half'
              WHEN "timestamp" BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-15'
                THEN 'First half'
              ELSE 'Unknown' END AS semester
  FROM trimmed)"""

COLUMNS = """citation_id, "timestamp", date, year, month, day_of_week, hour, campus, location,
  violation_type, status, fine_amount, is_credit_adjustment, fine_validated, semester"""

CITATIONS = f"""
citations AS (SELECT {COLUMNS}, _seq FROM tagged WHERE NOT excluded)"""

BILLABLE = """
billable AS (SELECT * FROM citations WHERE NOT is_credit_adjustment)"""

READINGS_RAW = """
readings_raw AS (
  SELECT CAST(CAST(ts AS DATE) + 3 AS VARCHAR) AS date,
         CASE WHEN user_id % 4 = 0 THEN 'South' ELSE 'North' END AS campus,
         CASE WHEN event_id % 17 = 5 THEN 'nan'::DOUBLE
              WHEN event_id % 13 <> 4 THEN value * 1.237E0 + 40.0E0 END AS temperature_2m_max,
         CASE WHEN event_id % 19 <> 2 THEN value * 0.337E0 END AS temperature_2m_min,
         CASE WHEN event_id % 5 = 0 THEN 0.0E0 WHEN event_id % 97 = 1 THEN -0.5E0
              WHEN event_id % 11 <> 3 THEN CAST(event_id * 7 % 23 AS DOUBLE) * 0.873E0 END
           AS precipitation_sum,
         CASE WHEN event_id % 89 <> 0
              THEN list_extract([0, 3, 51, 63, 80, 95, 42], CAST(event_id % 7 + 1 AS INTEGER)) END
           AS weathercode,
         event_id AS _seq
  FROM events)"""

WEATHER_RAW = """
weather_raw AS (
  SELECT CAST(day AS VARCHAR) AS date, campus, max(value) AS temperature_2m_max,
         min(value) AS temperature_2m_min,
         CASE WHEN count(*) % 5 = 0 THEN 0.0E0
              WHEN count(*) % 11 <> 3 THEN CAST(count(*) * 7 % 23 AS DOUBLE) * 0.873E0 END
           AS precipitation_sum,
         list_extract([0, 3, 51, 63, 80, 95, 42], CAST(sum(event_id) % 7 + 1 AS INTEGER))
           AS weathercode,
         max(event_id) AS _seq
  FROM (SELECT *, CAST(ts AS DATE) + 3 AS day,
               CASE WHEN user_id % 4 = 0 THEN 'South' ELSE 'North' END AS campus FROM events)
  GROUP BY day, campus)"""

CODE_LABEL = """CASE weathercode WHEN 0 THEN 'Clear sky' WHEN 3 THEN 'Overcast'
  WHEN 51 THEN 'Light drizzle' WHEN 63 THEN 'Moderate rain' WHEN 80 THEN 'Slight showers'
  WHEN 95 THEN 'Thunderstorm' ELSE 'Unknown' END"""


def bucket(p: str) -> str:
    return (
        f"CASE WHEN {p} = 0 THEN 'None' WHEN {p} <= 5 THEN 'Light' "
        f"WHEN {p} <= 15 THEN 'Moderate' ELSE 'Heavy' END"
    )


def denan(x: str) -> str:
    return f"CASE WHEN NOT isnan({x}) THEN {x} END"


def rounded(x: str, n: int) -> str:
    return f"round_even({denan(x)}, {n})"


PRECIP = f"coalesce({rounded('precipitation_sum', 2)}, 0.0E0)"


def clean_weather(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT CAST(date AS DATE) AS date, campus,
         {rounded("temperature_2m_max", 1)} AS temperature_2m_max,
         {rounded("temperature_2m_min", 1)} AS temperature_2m_min,
         {PRECIP} AS precipitation_sum,
         weathercode, {CODE_LABEL} AS condition_label, {bucket(PRECIP)} AS precip_bucket, _seq
  FROM {source})"""


READINGS = clean_weather("readings", "readings_raw")
WEATHER = clean_weather("weather", "weather_raw")

TO_CLEAN = [CITATIONS_RAW, TRIMMED, TAGGED, CITATIONS]
TO_BILLABLE = [*TO_CLEAN, BILLABLE]
TO_READINGS = [READINGS_RAW, READINGS]
TO_WEATHER = [WEATHER_RAW, WEATHER]


def sql(ctes: list[str], body: str) -> str:
    return f"WITH {','.join(ctes)}\n{body}"


def half_up(x: str, n: int) -> str:
    """Rounding of the printed decimal, ties away from zero."""
    return f"CAST(round(CAST({x} AS DECIMAL(28, 12)), {n}) AS DOUBLE)"


COUNT = "count(*) AS citation_count"
FINES = "CAST(sum(CASE WHEN fine_amount > 0 THEN fine_amount ELSE 0 END) AS BIGINT)"
AVG_FINE = half_up("avg(CASE WHEN fine_amount > 0 THEN fine_amount END)", 2) + " AS avg_fine"

VIOLATIONS_BY_TYPE = f"""SELECT violation_type, {COUNT}, {FINES} AS total_fines_collected,
  {AVG_FINE} FROM billable GROUP BY violation_type"""
MONTHLY_VOLUME = f"""SELECT semester, year, month, campus, {COUNT}, {FINES} AS monthly_revenue
  FROM billable GROUP BY semester, year, month, campus"""
TOP_LOCATIONS = f"""SELECT campus, location, {COUNT}, {FINES} AS total_fines FROM billable
  GROUP BY campus, location
  ORDER BY citation_count DESC, campus NULLS FIRST, location NULLS FIRST LIMIT 20"""
STATUS_SHARE = f"""SELECT semester, status, {COUNT},
  {half_up("100.0E0 * count(*) / sum(count(*)) OVER (PARTITION BY semester)", 2)}
    AS pct_of_semester
  FROM citations GROUP BY semester, status"""
HOURLY_PATTERNS = f"SELECT hour, campus, {COUNT} FROM billable GROUP BY hour, campus"
# Each weather day with what was billed on it, and the weight that a join row by row would give it.
CORRELATION = f"""SELECT precip_bucket, condition_label, campus,
  CAST(sum(ids) AS BIGINT) AS citation_count, CAST(sum(billed) AS BIGINT) AS total_fines,
  {half_up("CAST(sum(weight * CAST(high AS DECIMAL(18, 6))) AS DOUBLE)"
           " / sum(CASE WHEN high IS NOT NULL THEN weight END)", 1)} AS avg_high_temp_f,
  {half_up("CAST(sum(weight * CAST(rain AS DECIMAL(18, 6))) AS DOUBLE)"
           " / sum(CASE WHEN rain IS NOT NULL THEN weight END)", 2)} AS avg_precipitation_mm
  FROM (
    SELECT precip_bucket, condition_label, day.campus, temperature_2m_max AS high,
           precipitation_sum AS rain, coalesce(ids, 0) AS ids, coalesce(billed, 0) AS billed,
           greatest(coalesce(n, 0), 1) AS weight
    FROM weather day LEFT JOIN (
      SELECT date, campus, count(*) AS n, count(citation_id) AS ids,
             sum(greatest(fine_amount, 0)) AS billed
      FROM citations WHERE NOT is_credit_adjustment GROUP BY date, campus
    ) tickets ON tickets.date = day.date AND tickets.campus = day.campus
  ) GROUP BY precip_bucket, condition_label, campus"""
SITE_SUMMARY = f"""SELECT violation_type, campus, count(citation_id) AS citation_count,
  {FINES} AS total_fines_collected, {AVG_FINE} FROM billable GROUP BY violation_type, campus"""
CONDITION_HOURLY = f"""SELECT hour, precip_bucket, count(citation_id) AS citation_count,
  count(DISTINCT c.date) AS days_in_bucket,
  {half_up("count(citation_id)::DOUBLE / nullif(count(DISTINCT c.date), 0)", 2)}
    AS avg_citations_per_day
  FROM billable c LEFT JOIN weather w ON c.date = w.date AND c.campus = w.campus
  GROUP BY hour, precip_bucket"""

REQUIRED = ("timestamp", "campus", "violation_type", "status", "fine_amount")
COMPLETE = " AND ".join(f'"{c}" IS NOT NULL' for c in REQUIRED)

INSERT_BATCH = [
    *TO_CLEAN,
    f"stored AS (SELECT {COLUMNS} FROM citations WHERE semester = 'First half')",
    f"""incoming AS (
  SELECT {COLUMNS}, _seq FROM citations
  UNION ALL
  SELECT {COLUMNS.replace("status,", "'Late change' AS status,")}, _seq + 1000000000000000
  FROM citations
  UNION ALL
  SELECT {COLUMNS.replace("citation_id,", "'hot' AS citation_id,")}, _seq + 2000000000000000
  FROM citations)""",
    f"""ranked AS (
  SELECT *, row_number() OVER (PARTITION BY citation_id ORDER BY _seq) AS rn
  FROM incoming WHERE {COMPLETE})""",
    f"""fresh AS (
  SELECT {COLUMNS} FROM ranked r
  WHERE citation_id IS NULL
     OR (rn = 1 AND NOT EXISTS (SELECT 1 FROM stored s WHERE s.citation_id = r.citation_id)))""",
]

REPLACE_BATCH = [
    *TO_READINGS,
    *TO_WEATHER,
    "incoming AS (SELECT * REPLACE (date + 15 AS date) FROM readings)",
    """ranked AS (
  SELECT *, row_number() OVER (PARTITION BY date, campus ORDER BY _seq DESC) AS rn
  FROM incoming)""",
]
WEATHER_COLUMNS = """date, campus, temperature_2m_max, temperature_2m_min, precipitation_sum,
  weathercode, condition_label, precip_bucket"""

PAYLOADS = [
    """payloads AS (
  SELECT vec_id, 'Station ' || CAST(vec_id % 5 AS VARCHAR) AS campus,
         CAST(len(embedding) // 4 AS INTEGER) AS days,
         DATE '2024-01-01' + CAST(vec_id % 40 AS INTEGER) AS first_day, embedding
  FROM embeddings)"""
]


def metrics(pairs: dict[str, str], source: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS metric, CAST({value} AS BIGINT) AS value FROM {source}"
        for name, value in pairs.items()
    )


def rows_where(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


FACT_METRICS = {
    "raw_rows": "count(*)",
    "removed_rows": rows_where("excluded"),
    "clean_rows": rows_where("NOT excluded"),
    "credit_rows": rows_where("NOT excluded AND is_credit_adjustment"),
    "zero_fine_rows": rows_where("NOT excluded AND fine_amount = 0"),
    "validation_failures": rows_where("NOT excluded AND NOT fine_validated"),
    "null_citation_ids": rows_where("NOT excluded AND citation_id IS NULL"),
    "null_timestamps": rows_where('NOT excluded AND "timestamp" IS NULL'),
    "null_campuses": rows_where("NOT excluded AND campus IS NULL"),
    "unknown_semester_rows": rows_where("NOT excluded AND semester = 'Unknown'"),
    "distinct_campuses": "count(DISTINCT campus) FILTER (WHERE NOT excluded)",
    "distinct_types": "count(DISTINCT violation_type) FILTER (WHERE NOT excluded)",
    "distinct_locations": "count(DISTINCT location) FILTER (WHERE NOT excluded)",
    "distinct_semesters": "count(DISTINCT semester) FILTER (WHERE NOT excluded"
    " AND semester <> 'Unknown')",
}

DIM_METRICS = {
    "rows": "count(*)",
    "null_precipitation": rows_where("precipitation_sum IS NULL OR isnan(precipitation_sum)"),
    "null_temperatures": rows_where("temperature_2m_max IS NULL OR isnan(temperature_2m_max)")
    + " + "
    + rows_where("temperature_2m_min IS NULL OR isnan(temperature_2m_min)"),
    "unknown_codes": rows_where(f"{CODE_LABEL} = 'Unknown'"),
    "bucket_none": rows_where(f"{bucket(PRECIP)} = 'None'"),
    "bucket_light": rows_where(f"{bucket(PRECIP)} = 'Light'"),
    "bucket_moderate": rows_where(f"{bucket(PRECIP)} = 'Moderate'"),
    "bucket_heavy": rows_where(f"{bucket(PRECIP)} = 'Heavy'"),
    "first_date": "coalesce(replace(CAST(min(CAST(date AS DATE)) AS VARCHAR), '-', ''), '0')",
    "last_date": "coalesce(replace(CAST(max(CAST(date AS DATE)) AS VARCHAR), '-', ''), '0')",
}

KEYS_USED = """used AS (
  SELECT DISTINCT c.date, c.campus,
         EXISTS (SELECT 1 FROM weather w WHERE w.date = c.date AND w.campus = c.campus) AS known
  FROM citations c)"""


def report_values(name: str, keys: list[str], body: str) -> str:
    joined = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '-')" for k in keys)
    rest = f"COLUMNS(* EXCLUDE ({', '.join(keys)}))::DOUBLE"
    return f"""SELECT report, keys, measure, value FROM (
      SELECT * FROM (SELECT '{name}' AS report, {joined} AS keys, {rest} FROM ({body}))
      UNPIVOT INCLUDE NULLS (value FOR measure IN (* EXCLUDE (report, keys))))"""


# Six reports see the stored table, without incomplete rows; two see the whole clean batch.
BATCH = [
    *TO_CLEAN,
    "whole AS (SELECT * FROM citations)",
    f"kept AS (SELECT * FROM citations WHERE {COMPLETE})",
    *TO_WEATHER,
]


def batch_reports(only: int = 8) -> str:
    def over(table: str, body: str) -> str:
        source = f"""(WITH citations AS (SELECT * FROM {table}),
          billable AS (SELECT * FROM {table} WHERE NOT is_credit_adjustment) {body})"""
        return f"SELECT * FROM {source}"

    parts = [
        ("violations_by_type", ["violation_type"], over("kept", VIOLATIONS_BY_TYPE)),
        (
            "monthly_volume_by_campus",
            ["semester", "year", "month", "campus"],
            over("kept", MONTHLY_VOLUME),
        ),
        ("top_locations", ["campus", "location"], over("kept", TOP_LOCATIONS)),
        ("status_breakdown", ["semester", "status"], over("kept", STATUS_SHARE)),
        ("hourly_patterns", ["hour", "campus"], over("kept", HOURLY_PATTERNS)),
        (
            "weather_citation_correlation",
            ["precip_bucket", "condition_label", "campus"],
            over("kept", CORRELATION),
        ),
        ("violation_summary_spark", ["violation_type", "campus"], over("whole", SITE_SUMMARY)),
        ("weather_hourly_spark", ["hour", "precip_bucket"], over("whole", CONDITION_HOURLY)),
    ]
    return sql(BATCH, "\nUNION ALL ".join(report_values(*p) for p in parts[:only]))


MONTH_KEYS = ("violation_type", "semester", "year", "month", "campus", "location", "status", "hour", "date")


def month_sums() -> str:
    """The groups of each report, one select for each, with NULL for the keys that it doesn't use."""

    def part(name: str, keys: list[str]) -> str:
        columns = ", ".join(k if k in keys else f"NULL AS {k}" for k in MONTH_KEYS)
        by = ", ".join(["2", "is_credit_adjustment", *(f"g.{k}" for k in keys)])
        return f"""SELECT '{name}' AS report, strftime("timestamp", '%Y%m') AS _month, is_credit_adjustment,
          {columns}, count(*) AS n_rows, count(citation_id) AS n_ids, {FINES} AS fines,
          count(*) FILTER (WHERE fine_amount > 0) AS n_fines
        FROM citations g GROUP BY {by}"""

    return sql(TO_CLEAN, "\nUNION ALL ".join([
        part("violations_by_type", ["violation_type"]),
        part("monthly_volume_by_campus", ["semester", "year", "month", "campus"]),
        part("top_locations", ["campus", "location"]),
        part("status_breakdown", ["semester", "status"]),
        part("hourly_patterns", ["hour", "campus"]),
        part("weather_citation_correlation", ["date", "campus"]),
    ]))


KNOWN_TYPES = """['Area Not Designed For Parking', 'Boot Fee', 'Failed To Pay At Visitor Lot',
  'Fire Lane - Blocking/Impeding', 'No Valid Permit', 'Parked In Dedicated Space', 'Parked In Loading Zone',
  'Parked In Tow Zone', 'Parked In Wrong Direction', 'Tow Fee', 'Unauthorized Use of Permit',
  'Not Parked Between Lines', 'Not In Assigned Area', 'Parking For Clinic Patients Only', 'Abandoned Vehicle',
  'Backed In/Pulled Through Space', 'Expired Permit', 'Expired Hourly Parking', 'No License Plate Displayed',
  'Parked In Visitor Space', 'DO NOT USE/TESTING', 'Something else']"""
# The scheduled amount of each of these types, in their order.
KNOWN_FINES = "[50, 60, 35, 60, 50, 50, 35, 50, 35, 60, 60, 50, 50, 50, 50, 35, 50, 35, 35, 50, NULL, NULL]"
ALL_CODES = """CASE weathercode WHEN 0 THEN 'Clear sky' WHEN 1 THEN 'Mainly clear' WHEN 2 THEN 'Partly cloudy'
  WHEN 3 THEN 'Overcast' WHEN 45 THEN 'Fog' WHEN 48 THEN 'Icy fog' WHEN 51 THEN 'Light drizzle'
  WHEN 53 THEN 'Moderate drizzle' WHEN 55 THEN 'Heavy drizzle' WHEN 61 THEN 'Slight rain' WHEN 63 THEN 'Moderate rain'
  WHEN 65 THEN 'Heavy rain' WHEN 71 THEN 'Slight snow' WHEN 73 THEN 'Moderate snow' WHEN 75 THEN 'Heavy snow'
  WHEN 80 THEN 'Slight showers' WHEN 81 THEN 'Moderate showers' WHEN 82 THEN 'Violent showers'
  WHEN 95 THEN 'Thunderstorm' WHEN 96 THEN 'Thunderstorm w/ hail' WHEN 99 THEN 'Thunderstorm w/ heavy hail'
  ELSE 'Unknown' END"""

SHIFTS = """
shifts AS (
  SELECT 'Shift ' || CAST(i % 1000 AS VARCHAR) AS label, i * 104729 % 1000003 AS position,
         CASE WHEN i % 9 = 0 THEN date_trunc('day', start)::TIMESTAMP ELSE start END AS start,
         CASE WHEN i % 31 = 7 THEN NULL
              WHEN i % 9 = 0 THEN date_trunc('day', date_trunc('day', start)::TIMESTAMP + to_seconds(length))::TIMESTAMP
              ELSE start + to_seconds(length) END AS "end"
  FROM (SELECT i, start, CASE WHEN i % 23 = 4 THEN -length ELSE length END AS length
        FROM (SELECT o_orderkey AS i, TIMESTAMP '2024-01-01' + to_seconds(o_orderkey * 7919 % 2592000) AS start,
                     CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey * 31 % 1000000
                          WHEN o_orderkey % 2 = 0 THEN o_orderkey * 13 % 90
                          ELSE o_orderkey * 17 % 5000 END AS length FROM orders)))"""


def last_shift(inside: str, default: str) -> str:
    return f"""SELECT _seq, "timestamp", coalesce(shift, {default}) AS shift FROM (
      SELECT c._seq, any_value(c."timestamp") AS "timestamp",
             struct_extract(max(struct_pack(p := s.position, l := s.label)) FILTER (s.position IS NOT NULL), 'l') AS shift
      FROM citations_raw c LEFT JOIN shifts s ON c."timestamp" >= s.start AND s.start <= s."end" AND {inside}
      GROUP BY c._seq)"""


SEASON = " ".join(
    f"WHEN o_orderdate >= TIMESTAMP '{y}-02-01' AND o_orderdate < TIMESTAMP '{y}-12-01' THEN '{y}'"
    for y in range(1995, 2001)
)

ORACLE = {
    "exclude_filter": sql(
        [CITATIONS_RAW, TRIMMED],
        """SELECT citation_id, violation_type FROM citations_raw
           WHERE violation_type IS NULL OR violation_type <> 'DO NOT USE/TESTING'""",
    ),
    "trim_columns": sql(
        [CITATIONS_RAW, TRIMMED],
        "SELECT citation_id, violation_type, status, location, campus FROM trimmed",
    ),
    "flag_negative": "SELECT c_custkey, c_acctbal, coalesce(c_acctbal < 0, FALSE) AS is_credit"
    " FROM customer",
    "validate_schedule": sql(
        [CITATIONS_RAW, TRIMMED, TAGGED],
        "SELECT citation_id, violation_type, status, fine_amount, fine_validated FROM tagged",
    ),
    "calendar_columns": sql(
        [CITATIONS_RAW, TRIMMED, TAGGED],
        "SELECT citation_id, date, year, month, day_of_week, hour FROM tagged",
    ),
    "range_label": sql(
        [CITATIONS_RAW, TRIMMED, TAGGED], "SELECT citation_id, semester FROM tagged"
    ),
    "range_label_orders": f"""SELECT o_orderkey, CASE {SEASON} ELSE 'Unknown' END AS season
      FROM orders""",
    "default_rules": f"""
      SELECT _seq, violation_type, status, fine_amount, fine_amount < 0 AS is_credit_adjustment,
             fine_amount < 0 OR status IN ('Transfer', 'Zero Balance', 'Inactive')
               OR coalesce(fine_amount = scheduled, FALSE) AS fine_validated,
             CASE WHEN edge IN (1, 2, 7) THEN 'Fall 2025' WHEN edge IN (4, 5) THEN 'Spring 2026'
                  ELSE 'Unknown' END AS semester
      FROM (SELECT event_id AS _seq, {KNOWN_TYPES}[1 + event_id // 6 % 22] AS violation_type,
                   {KNOWN_FINES}[1 + event_id // 6 % 22] AS scheduled, event_id % 8 AS edge,
                   ['Unpaid', 'Transfer', 'Paid', 'Zero Balance', 'Inactive', 'Void', 'Appealed'][1 + event_id % 7]
                     AS status,
                   [35, 50, 60, 0, 40, -5][1 + event_id % 6] AS fine_amount FROM events)
      WHERE violation_type <> 'DO NOT USE/TESTING'""",
    "default_weather_rules": f"""
      SELECT _seq, weathercode, {ALL_CODES} AS condition_label, precipitation_sum,
             {bucket("precipitation_sum")} AS precip_bucket
      FROM (SELECT event_id AS _seq, CAST(event_id % 101 AS INTEGER) AS weathercode,
                   CAST(event_id % 41 AS DOUBLE) * 0.5E0 AS precipitation_sum FROM events)""",
    "sql_daily_weather": sql(
        [*TO_BILLABLE, *TO_WEATHER],
        """SELECT condition_label, precip_bucket, count(DISTINCT (w.date, w.campus)) AS weather_days,
                  count(citation_id) AS citation_count
           FROM weather w LEFT JOIN billable c ON c.date = w.date AND c.campus = w.campus
           GROUP BY condition_label, precip_bucket""",
    ),
    "range_lookup_join": sql(
        [CITATIONS_RAW, SHIFTS], last_shift('c."timestamp" <= s."end"', "'Unknown'")
    ),
    "range_lookup_whole_days": sql(
        [CITATIONS_RAW, SHIFTS],
        last_shift('c."timestamp" < s."end" + INTERVAL 1 DAY', "NULL"),
    ),
    "clean_fact": sql(TO_CLEAN, f"SELECT {COLUMNS} FROM citations"),
    "parse_date": sql([READINGS_RAW], "SELECT _seq, CAST(date AS DATE) AS date FROM readings_raw"),
    "parse_date_lenient": sql(
        [READINGS_RAW],
        """SELECT _seq, TRY_CAST(CASE WHEN _seq % 50 = 0 THEN 'n/a' ELSE date END AS DATE) AS date
           FROM readings_raw""",
    ),
    "round_fill_dim": sql(
        TO_READINGS,
        "SELECT _seq, temperature_2m_max, temperature_2m_min, precipitation_sum FROM readings",
    ),
    "code_label": sql(
        [READINGS_RAW],
        f"SELECT _seq, weathercode, {CODE_LABEL} AS condition_label FROM readings_raw",
    ),
    "bucketize": sql(
        [READINGS_RAW],
        f"""SELECT _seq, precipitation_sum, {bucket("precipitation_sum")} AS precip_bucket
            FROM readings_raw""",
    ),
    "clean_dim": sql(TO_READINGS, "SELECT * FROM readings"),
    "category_summary": sql(TO_BILLABLE, VIOLATIONS_BY_TYPE),
    "monthly_volume": sql(TO_BILLABLE, MONTHLY_VOLUME),
    "top_locations": sql(TO_BILLABLE, TOP_LOCATIONS),
    "status_share": sql(TO_CLEAN, STATUS_SHARE),
    "hourly_patterns": sql(TO_BILLABLE, HOURLY_PATTERNS),
    "condition_correlation": sql([*TO_CLEAN, *TO_WEATHER], CORRELATION),
    "condition_correlation_preagg": sql([*TO_CLEAN, *TO_WEATHER], CORRELATION),
    "category_site_summary": sql(TO_BILLABLE, SITE_SUMMARY),
    "condition_hourly": sql([*TO_BILLABLE, *TO_WEATHER], CONDITION_HOURLY),
    "citation_rollup": sql(
        TO_CLEAN,
        f"""SELECT semester, year, month, date, hour, campus, location, violation_type, status,
              is_credit_adjustment, count(*) AS n_rows, count(citation_id) AS n_ids,
              {FINES} AS fines, count(*) FILTER (WHERE fine_amount > 0) AS n_fines
            FROM citations GROUP BY ALL""",
    ),
    "sql_status_share": sql(
        TO_BILLABLE,
        f"""SELECT campus, status, {COUNT},
              {half_up("100.0E0 * count(*) / sum(count(*)) OVER (PARTITION BY campus)", 2)} AS pct
            FROM billable GROUP BY campus, status""",
    ),
    "fact_enrichment": sql(
        [*TO_CLEAN, *TO_WEATHER],
        """SELECT c._seq, c.citation_id, c.date, c.campus, w.precip_bucket, w.condition_label
           FROM citations c LEFT JOIN weather w ON c.date = w.date AND c.campus = w.campus""",
    ),
    "fact_enrichment_salted": sql(
        [*TO_CLEAN, *TO_WEATHER],
        """SELECT c._seq, c.citation_id, c.date, c.campus, w.precip_bucket, w.condition_label
           FROM citations c LEFT JOIN weather w ON c.date = w.date AND c.campus = w.campus""",
    ),
    "lookup_join": """SELECT c_custkey, c.n_nationkey, coalesce(n.n_name, 'Unknown') AS n_name
      FROM (SELECT c_custkey, CASE WHEN c_custkey % 17 = 3 THEN c_nationkey + 100
                                   WHEN c_custkey % 19 <> 4 THEN c_nationkey END AS n_nationkey
            FROM customer) c
      LEFT JOIN nation n ON c.n_nationkey = n.n_nationkey""",
    "required_columns": sql(
        TO_CLEAN,
        f"""SELECT _seq, {", ".join(f'"{c}"' for c in REQUIRED)} FROM citations
            WHERE NOT ({COMPLETE})""",
    ),
    "insert_if_absent": sql(
        INSERT_BATCH, f"SELECT {COLUMNS} FROM stored UNION ALL SELECT {COLUMNS} FROM fresh"
    ),
    "insert_counts": sql(
        INSERT_BATCH,
        f"""SELECT (SELECT count(*) FROM stored) AS rows_before,
                   (SELECT count(*) FROM incoming) AS batch_rows,
                   (SELECT count(*) FROM incoming WHERE NOT ({COMPLETE})) AS rejected_rows,
                   (SELECT count(*) FROM fresh) AS inserted_rows,
                   (SELECT count(*) FROM stored) + (SELECT count(*) FROM fresh) AS rows_after""",
    ),
    "replace_by_key": sql(
        REPLACE_BATCH,
        f"""SELECT {WEATHER_COLUMNS} FROM ranked WHERE rn = 1
            UNION ALL
            SELECT {WEATHER_COLUMNS} FROM weather w WHERE NOT EXISTS
              (SELECT 1 FROM incoming i WHERE i.date = w.date AND i.campus = w.campus)""",
    ),
    "replace_counts": sql(
        REPLACE_BATCH,
        """SELECT (SELECT count(*) FROM weather) AS rows_before,
             count(*) FILTER (WHERE known) AS replaced_rows,
             count(*) FILTER (WHERE NOT known) AS inserted_rows,
             (SELECT count(*) FROM weather) + count(*) FILTER (WHERE NOT known) AS rows_after
           FROM (SELECT EXISTS (SELECT 1 FROM weather w
                                WHERE w.date = r.date AND w.campus = r.campus) AS known
                 FROM ranked r WHERE rn = 1)""",
    ),
    "load_window": sql(
        [CITATIONS_RAW],
        """SELECT CAST(min("timestamp") AS DATE) AS first_date,
                  CAST(max("timestamp") AS DATE) AS last_date FROM citations_raw""",
    ),
    "key_spine": sql(
        [CITATIONS_RAW],
        """SELECT CAST(d.day AS DATE) AS date, s.campus FROM
             (SELECT unnest(generate_series(min("timestamp")::DATE, max("timestamp")::DATE,
                                            INTERVAL 1 DAY)) AS day FROM citations_raw) d,
             (VALUES ('North'), ('South')) s(campus)""",
    ),
    "union_all": sql([WEATHER_RAW], "SELECT * EXCLUDE (_seq) FROM weather_raw"),
    "payload_flatten": sql(
        [
            *PAYLOADS,
            """days AS (
  SELECT *, unnest(range(days)) AS i FROM payloads
  WHERE vec_id % 11 <> 5 AND vec_id % 13 <> 3)""",
        ],
        """SELECT CAST(first_day + CAST(i AS INTEGER) AS VARCHAR) AS date, campus,
             CAST(embedding[1 + i] AS DOUBLE) AS temperature_2m_max,
             CAST(embedding[1 + days + i] AS DOUBLE) AS temperature_2m_min,
             CASE WHEN vec_id % 7 <> 2 THEN CAST(embedding[1 + 2 * days + i] AS DOUBLE) END
               AS precipitation_sum,
             CAST(floor(abs(CAST(embedding[1 + 3 * days + i] AS DOUBLE)) * 100) AS INTEGER) AS weathercode,
             vec_id
           FROM days""",
    ),
    "payload_problems": sql(
        PAYLOADS,
        """SELECT vec_id, campus, CASE WHEN vec_id % 11 = 5 THEN 'payload has no time axis'
             ELSE 'temperature_2m_max and time differ in length' END AS problem
           FROM payloads WHERE vec_id % 11 = 5 OR vec_id % 13 = 3""",
    ),
    "fact_quality": sql([CITATIONS_RAW, TRIMMED, TAGGED], metrics(FACT_METRICS, "tagged")),
    "dim_quality": sql([READINGS_RAW], metrics(DIM_METRICS, "readings_raw")),
    "bucket_counts": sql(
        TO_READINGS,
        "SELECT precip_bucket, count(*) AS n_rows FROM readings GROUP BY precip_bucket",
    ),
    "missing_keys": sql(
        [*TO_CLEAN, *TO_WEATHER, KEYS_USED], "SELECT date, campus FROM used WHERE NOT known"
    ),
    "join_coverage": sql(
        [*TO_CLEAN, *TO_WEATHER, KEYS_USED],
        """SELECT count(*) AS fact_keys, count(*) FILTER (WHERE known) AS matched_keys,
             CAST(count(*) FILTER (WHERE known) AS DOUBLE) / count(*) AS coverage FROM used""",
    ),
    "weather_gaps": sql(
        [*TO_CLEAN, *TO_WEATHER],
        """SELECT CAST(d.day AS DATE) AS date, s.campus FROM
             (SELECT unnest(generate_series(min("timestamp")::DATE, max("timestamp")::DATE,
                                            INTERVAL 1 DAY)) AS day FROM citations) d,
             (VALUES ('North'), ('South')) s(campus)
           WHERE NOT EXISTS (SELECT 1 FROM weather w
                             WHERE w.date = CAST(d.day AS DATE) AND w.campus = s.campus)""",
    ),
    "weather_gap_ranges": sql(
        [*TO_CLEAN, *TO_WEATHER],
        """SELECT campus, min(day) AS first_date, max(day) AS last_date, count(*) AS days FROM (
             SELECT campus, day, datediff('day', DATE '2000-01-01', day)
                      - row_number() OVER (PARTITION BY campus ORDER BY day) AS island
             FROM (SELECT CAST(unnest(generate_series(min("timestamp")::DATE, max("timestamp")::DATE,
                                                      INTERVAL 1 DAY)) AS DATE) AS day FROM citations),
                  (VALUES ('North'), ('South')) s(campus)
             WHERE (day, campus) NOT IN (SELECT (date, campus) FROM weather))
           GROUP BY campus, island""",
    ),
    "days_in_bucket": sql(
        [*TO_CLEAN, *TO_WEATHER],
        """SELECT hour, precip_bucket, CAST(count(DISTINCT c.date) AS BIGINT) AS days_in_bucket
           FROM citations c LEFT JOIN weather w ON c.date = w.date AND c.campus = w.campus
           WHERE c.date IS NOT NULL GROUP BY hour, precip_bucket""",
    ),
    "payload_quarantine": sql(
        PAYLOADS,
        """SELECT problem, count(*) AS n_rows FROM (
             SELECT CASE WHEN vec_id % 9 = 4 THEN 'not a payload'
                         WHEN vec_id % 11 = 5 THEN 'payload has no time axis'
                         WHEN vec_id % 13 = 3 THEN 'temperature_2m_max and time differ in length' END AS problem
             FROM payloads) WHERE problem IS NOT NULL GROUP BY problem
           UNION ALL SELECT 'landed_payloads', count(*) FROM payloads
           UNION ALL SELECT 'bad_payloads', count(*) FROM payloads
             WHERE vec_id % 9 = 4 OR vec_id % 11 = 5 OR vec_id % 13 = 3
           UNION ALL SELECT 'raw_weather', CAST(sum(days) AS BIGINT) FROM payloads
             WHERE vec_id % 9 <> 4 AND vec_id % 11 <> 5 AND vec_id % 13 <> 3
           UNION ALL SELECT 'raw_citations', count(*) FROM events""",
    ),
    "anomaly_listing": sql(
        TO_CLEAN,
        """SELECT violation_type, fine_amount, count(*) AS n_rows FROM citations
           WHERE NOT fine_validated GROUP BY violation_type, fine_amount""",
    ),
    "raw_scan": sql([CITATIONS_RAW], "SELECT * EXCLUDE (_seq) FROM citations_raw"),
    "raw_scan_quarantine": sql(
        [CITATIONS_RAW],
        """SELECT damaged,
             CASE WHEN NOT damaged THEN citation_id END AS citation_id,
             CASE WHEN NOT damaged THEN date_trunc('second', "timestamp") END AS "timestamp",
             CASE WHEN NOT damaged THEN fine_amount END AS fine_amount,
             CASE WHEN damaged THEN CAST(_seq AS VARCHAR) END AS line_start
           FROM (SELECT *, _seq % 50 = 0 OR _seq % 70 = 0 AS damaged FROM citations_raw)""",
    ),
    "zone_scan": sql(TO_CLEAN, f"SELECT {COLUMNS} FROM citations"),
    "report_sink": sql(TO_BILLABLE, VIOLATIONS_BY_TYPE),
    "stage_counts": sql(
        [*TO_CLEAN, *TO_WEATHER],
        f"""SELECT 'raw_citations' AS stage, count(*) AS n_rows FROM citations_raw
            UNION ALL SELECT 'raw_weather', count(*) FROM weather_raw
            UNION ALL SELECT 'clean_citations', count(*) FROM citations
            UNION ALL SELECT 'clean_weather', count(*) FROM weather
            UNION ALL SELECT 'rejected_citations', count(*) FROM citations WHERE NOT ({COMPLETE})
            UNION ALL SELECT 'repeated_citations', 0
            UNION ALL SELECT 'known_citations', 0
            UNION ALL SELECT 'inserted_citations', count(*) FROM citations WHERE {COMPLETE}
            UNION ALL SELECT 'inserted_without_id', count(*) FROM citations
              WHERE {COMPLETE} AND citation_id IS NULL
            UNION ALL SELECT 'stored_weather', count(*) FROM weather""",
    ),
    "batch_reports": batch_reports(),
    "reports_after_two_loads": batch_reports(only=6),
    "month_sums": month_sums(),
}
