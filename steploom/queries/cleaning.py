"""Projections, filters and aggregations on readings and actuals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns
from ..operators import ingest, views
from ..schemas import HISTORY_START, KEYS, TIMEZONES
from .data import (
    DAILY_REGIONS,
    EVERY_DAILY_REGION,
    HOURLY_REGIONS,
    actuals,
    daily_readings,
    forecasts,
    hourly_actuals,
    hourly_readings,
    raw_readings,
    table,
)
from .registry import query
from .sql import with_views

_HOURLY_LIST = ", ".join(f"'{r}'" for r in HOURLY_REGIONS)


@query(
    """SELECT event_id, date_trunc('hour', ts) AS hourly, date_trunc('day', ts) AS daily,
              CAST(NULL AS TIMESTAMP) AS wrong FROM events""",
    ["hourly", "daily", "wrong"],
)
def parse_period(spark, sf_dir):
    """Hourly and daily text in their formats, and text in another format."""
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        columns.parse_period(F.date_format("ts", "yyyy-MM-dd'T'HH"), "hourly").alias("hourly"),
        columns.parse_period(F.date_format("ts", "yyyy-MM-dd"), "daily").alias("daily"),
        columns.parse_period(F.date_format("ts", "yyyy-MM-dd"), "hourly").alias("wrong"),
    )


@query(
    """SELECT event_id, value AS number, TRY_CAST(event_type AS DOUBLE) AS word,
              TRY_CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS padded, CAST(NULL AS DOUBLE) AS nothing
       FROM events""",
    doubles=["number", "word", "padded", "nothing"],
)
def coerce_numeric(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    digits = F.regexp_extract("props", "[0-9]+", 0)
    return events.select(
        "event_id",
        columns.coerce_numeric(F.col("value").cast("string")).alias("number"),
        columns.coerce_numeric(F.col("event_type")).alias("word"),
        columns.coerce_numeric(F.concat(F.lit("  "), digits, F.lit(" "))).alias("padded"),
        columns.coerce_numeric(F.concat(digits, F.lit("nan"))).alias("nothing"),
    )


@query(
    with_views(f"SELECT * FROM readings WHERE parent IN ({_HOURLY_LIST})", "readings"), ["period"], ["value"]
)
def normalize_readings(spark, sf_dir):
    rows = ingest.normalize_readings(raw_readings(spark, sf_dir), HOURLY_REGIONS)
    return rows.select("parent", "subba", "period", "value", "event_id")


@query(with_views("SELECT * FROM daily", "daily"), ["period"], ["value"], digits=2)
def select_timezone_copy(spark, sf_dir):
    """Daily readings once per timezone; one copy gives the right totals."""
    labels = F.array(*[F.lit(z) for z in TIMEZONES])
    copies = daily_readings(spark, sf_dir).withColumn("timezone", F.explode(labels))
    return ingest.region_total(ingest.select_timezone_copy(copies, "Eastern"), EVERY_DAILY_REGION, "daily")


@query(
    with_views(
        "SELECT * FROM hourly WHERE period >= (SELECT max(period) - INTERVAL 167 HOUR FROM hourly)", "hourly"
    ),
    ["period"],
    ["value"],
)
def trim_history_hours(spark, sf_dir):
    return ingest.trim_history(actuals(spark, sf_dir), hours=168)


@query(
    with_views("SELECT * FROM daily WHERE period >= (SELECT max(period) - INTERVAL 400 DAY FROM daily)", "daily"),
    ["period"],
    ["value"],
    digits=2,
)
def trim_history_days(spark, sf_dir):
    return ingest.trim_history(actuals(spark, sf_dir, "daily"), days=400)


@query(with_views("SELECT * FROM hourly WHERE region = 'PURCHASE'", "hourly"), ["period"], ["value"])
def filter_region(spark, sf_dir):
    return views.filter_region(hourly_actuals(spark, sf_dir), "purchase")


@query(
    with_views(
        "SELECT * FROM hforecasts WHERE issue_time = (SELECT max(issue_time) FROM hforecasts)", "hforecasts"
    ),
    ["issue_time", "target_time"],
    ["yhat"],
)
def latest_issue(spark, sf_dir):
    return views.latest_issue(forecasts(spark, sf_dir))


@query(
    with_views(
        """SELECT '{"region":"' || region || '","series":"' || series || '","period":"'
                  || strftime(period, '%Y-%m-%dT%H:%M:%S+00:00') || '","value":'
                  || coalesce(CAST(round(value, 2) AS VARCHAR), 'null') || '}' AS record
           FROM hgrid""",
        "hgrid",
    )
)
def to_records(spark, sf_dir):
    from ..operators.gridding import regular_grid

    rows = regular_grid(actuals(spark, sf_dir)).withColumn("value", F.round("value", 2))
    # Holes as NaN, the way an array-based client would hand them over.
    return views.to_records(rows.withColumn("value", F.coalesce("value", F.lit(float("nan")))))


@query("SELECT event_id, upper(event_type) || ' total' AS series FROM events")
def series_name(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", columns.series_name(F.upper("event_type")).alias("series")
    )


@query(with_views("SELECT * FROM hourly_allowed", "hourly_allowed"), ["period"], ["value"])
def region_total(spark, sf_dir):
    """Raw text readings to hourly region totals."""
    return ingest.region_total(raw_readings(spark, sf_dir), HOURLY_REGIONS)


@query(with_views("SELECT * FROM daily_allowed", "daily_allowed"), ["period"], ["value"], digits=2)
def region_total_daily(spark, sf_dir):
    return ingest.region_total(daily_readings(spark, sf_dir), DAILY_REGIONS, "daily")


@query(
    with_views(
        """SELECT region, series,
                  date_trunc('day', (period AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') AS period,
                  sum(value) AS value
           FROM hourly GROUP BY 1, 2, 3""",
        "hourly",
    ),
    ["period"],
    ["value"],
)
def daily_total(spark, sf_dir):
    return ingest.daily_total(hourly_actuals(spark, sf_dir), "Eastern")


@query(
    """SELECT DISTINCT event_type AS parent, CAST(user_id AS VARCHAR) AS subba,
              strftime(ts, '%Y-%m-%dT%H') AS period, CAST(value AS VARCHAR) AS value FROM events"""
)
def distinct_rows(spark, sf_dir):
    """Two overlapping pulls of the same readings."""
    pull = raw_readings(spark, sf_dir).select("parent", "subba", "period", "value")
    return ingest.distinct_rows(pull.unionByName(pull))


@query(
    with_views(
        """SELECT 'load' AS dataset, region || '|' || series AS partition_key, max(period) AS max_period
           FROM hourly GROUP BY region, series
           UNION ALL SELECT 'load', NULL, max(period) FROM hourly""",
        "hourly",
    ),
    ["max_period"],
)
def watermarks(spark, sf_dir):
    return ingest.watermarks(hourly_actuals(spark, sf_dir), "load")


@query(
    with_views(
        """SELECT count(*) AS rows, min(period) AS first_period, max(period) AS last_period,
                  string_agg(DISTINCT region, ',' ORDER BY region) AS regions FROM hourly""",
        "hourly",
    ),
    ["first_period", "last_period"],
)
def dataset_profile(spark, sf_dir):
    profile = views.dataset_profile(hourly_actuals(spark, sf_dir))
    return profile.withColumn("regions", F.array_join("regions", ","))


@query(
    with_views(
        """SELECT latest_actual, age_hours,
                  CASE WHEN age_hours <= 3 THEN 'Fresh' WHEN age_hours <= 30 THEN 'Delayed' ELSE 'Stale' END AS status
           FROM (SELECT max(period) AS latest_actual,
                        (epoch(TIMESTAMP '2024-01-31 04:30:00') - epoch(max(period))) / 3600.0 AS age_hours
                 FROM hourly)""",
        "hourly",
    ),
    ["latest_actual"],
    ["age_hours"],
)
def freshness(spark, sf_dir):
    now = F.lit("2024-01-31 04:30:00").cast("timestamp")
    return views.freshness(hourly_actuals(spark, sf_dir), now)


@query(
    with_views(
        """SELECT max(issue_time) AS latest_issue, max(target_time) AS latest_target,
                  date_sub('hour', max(issue_time), max(target_time)) AS horizon_hours FROM hforecasts""",
        "hforecasts",
    ),
    ["latest_issue", "latest_target"],
)
def forecast_span(spark, sf_dir):
    return views.forecast_span(forecasts(spark, sf_dir))


@query(
    with_views(
        """SELECT min(target_time) AS first_target, max(target_time) AS last_target,
                  date_sub('hour', min(target_time), max(target_time)) + 1 AS hours
           FROM hforecasts WHERE region = 'CLICK'""",
        "hforecasts",
    ),
    ["first_target", "last_target"],
)
def backtest_bounds(spark, sf_dir):
    return views.backtest_bounds(forecasts(spark, sf_dir), "CLICK")


@query(with_views(f"SELECT * FROM readings WHERE parent IN ({_HOURLY_LIST})", "readings"), ["period"], ["value"])
def allowed_regions(spark, sf_dir):
    """The allow-list as a table instead of literals."""
    names = spark.createDataFrame([(r,) for r in HOURLY_REGIONS], "name string")
    rows = hourly_readings(spark, sf_dir).withColumn("parent", F.upper("parent"))
    return ingest.allowed_regions(rows, names).select("parent", "subba", "period", "value", "event_id")


def _batches(spark, sf_dir):
    """Stored totals until the 20th and a pull with revised values from the 15th on."""
    totals = actuals(spark, sf_dir)
    existing = totals.where(F.col("period") < "2024-01-20")
    fresh = totals.where(F.col("period") >= "2024-01-15").withColumn("value", F.col("value") * 2)
    return existing, fresh


@query(
    with_views(
        """SELECT region, series, period,
                  CASE WHEN period >= TIMESTAMP '2024-01-15' THEN value * 2 ELSE value END AS value FROM hourly""",
        "hourly",
    ),
    ["period"],
    ["value"],
)
def upsert_latest(spark, sf_dir):
    existing, fresh = _batches(spark, sf_dir)
    return ingest.upsert_latest(existing, fresh)


@query(
    with_views(
        """SELECT parent AS region, parent || ' total' AS series, period, arg_max(value, event_id) AS value
           FROM readings GROUP BY parent, period""",
        "readings",
    ),
    ["period"],
    ["value"],
)
def dedup_periods(spark, sf_dir):
    """The last reading per event type and hour, by event number."""
    rows = hourly_readings(spark, sf_dir).select(
        F.upper("parent").alias("region"), columns.series_name(F.upper("parent")).alias("series"), "period", "value", "event_id"
    )
    return ingest.dedup_periods(rows, KEYS, ["event_id"]).select(*KEYS, "period", "value")


_DATASETS = [("load", "hourly"), ("load_daily", "daily"), ("load_new", "hourly")]


@query(
    with_views(
        """SELECT 'load' AS dataset, 'hourly' AS resolution, max(period) - INTERVAL 24 HOUR AS start,
                  TIMESTAMP '2024-02-01' AS "end" FROM hourly
           UNION ALL SELECT 'load_daily', 'daily', max(period) - INTERVAL 7 DAY, TIMESTAMP '2024-02-01' FROM daily
           UNION ALL SELECT 'load_new', 'hourly', TIMESTAMP '2023-01-01', TIMESTAMP '2024-02-01'""",
        "hourly",
        "daily",
    ),
    ["start", '"end"'],
)
def pull_range(spark, sf_dir):
    """Next pulls of two stored datasets and of one never pulled before."""
    state = ingest.watermarks(hourly_actuals(spark, sf_dir), "load").unionByName(
        ingest.watermarks(actuals(spark, sf_dir, "daily"), "load_daily")
    )
    datasets = spark.createDataFrame(_DATASETS, "dataset string, resolution string")
    return ingest.pull_range(state, datasets, F.lit("2024-02-01").cast("timestamp"), HISTORY_START)


@query(
    with_views(
        """, spans AS (
             SELECT 'load' AS dataset, min(period) AS lo, max(period) AS hi FROM readings
             UNION ALL SELECT 'load_daily', min(period), max(period) FROM dreadings),
           chunks AS (
             SELECT dataset, i AS chunk, lo + i * INTERVAL 1 MONTH AS lo,
                    least(lo + (i + 1) * INTERVAL 1 MONTH - INTERVAL 1 HOUR, hi) AS hi
             FROM spans, generate_series(0, 1000) AS s(i) WHERE lo + i * INTERVAL 1 MONTH <= hi),
           seen AS (SELECT 'load' AS dataset, period FROM readings UNION ALL SELECT 'load_daily', period FROM dreadings),
           counted AS (
             SELECT c.dataset, c.chunk, c.lo, c.hi, count(s.period) AS landed
             FROM chunks AS c LEFT JOIN seen AS s ON s.dataset = c.dataset AND s.period BETWEEN c.lo AND c.hi
             GROUP BY c.dataset, c.chunk, c.lo, c.hi)
           SELECT dataset, CAST(chunk AS INTEGER) AS chunk, lo, hi, landed,
                  CAST(ceil(landed / 5000.0) AS BIGINT) AS pages FROM counted""",
        "readings",
        "dreadings",
    ).replace("\n, spans", ",\nspans"),
    ["lo", "hi"],
)
def chunk_coverage(spark, sf_dir):
    """Monthly chunks of both readings tables and the rows landed in each."""
    rows = (
        hourly_readings(spark, sf_dir)
        .select(F.lit("load").alias("dataset"), "period")
        .unionByName(daily_readings(spark, sf_dir).select(F.lit("load_daily").alias("dataset"), "period"))
    )
    ranges = rows.groupBy("dataset").agg(F.min("period").alias("start"), F.max("period").alias("end"))
    return ingest.chunk_coverage(rows, ingest.pull_plan(ranges))
