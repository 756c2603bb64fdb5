"""Grids, features and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar
from ..operators import features, gridding, splits
from ..schemas import KEYS, model_for
from .data import actuals, forecasts, hourly_actuals
from .registry import query
from .sql import (
    CALENDAR_DAILY,
    CALENDAR_HOURLY,
    DAILY_LAGS,
    DAILY_ROLLS,
    HOURLY_LAGS,
    HOURLY_ROLLS,
    with_views,
)

HOURLY, DAILY = model_for("hourly"), model_for("daily")
_LAG = {"hourly": [f"lag_{k}" for k in HOURLY_LAGS], "daily": [f"lag_{k}" for k in DAILY_LAGS]}
_ROLL = {"hourly": [f"rollmean_{w}" for w in HOURLY_ROLLS], "daily": [f"rollmean_{w}" for w in DAILY_ROLLS]}
_WAVES_HOURLY = ["hour_sin", "hour_cos", "dow_sin", "dow_cos"]
_WAVES_DAILY = ["dow_sin", "dow_cos", "doy_sin", "doy_cos", "month_sin", "month_cos"]


def _filled(spark, sf_dir, resolution="hourly"):
    return gridding.regular_grid(actuals(spark, sf_dir, resolution), resolution=resolution, fill=True)


@query(with_views("SELECT * FROM hgrid", "hgrid"), ["period"], ["value"])
def regular_grid(spark, sf_dir):
    return gridding.regular_grid(actuals(spark, sf_dir))


@query(with_views("SELECT * FROM dgrid", "dgrid"), ["period"], ["value"], digits=6)
def regular_grid_daily(spark, sf_dir):
    return gridding.regular_grid(actuals(spark, sf_dir, "daily"), resolution="daily")


@query(with_views("SELECT * FROM hfilled", "hfilled"), ["period"], ["value"])
def fill_gaps(spark, sf_dir):
    return gridding.fill_gaps(gridding.regular_grid(actuals(spark, sf_dir)))


@query(with_views("SELECT * FROM dfilled", "dfilled"), ["period"], ["value"], digits=6)
def fill_gaps_daily(spark, sf_dir):
    return _filled(spark, sf_dir, "daily")


@query(with_views(f"SELECT region, period, value, {CALENDAR_HOURLY} FROM hourly", "hourly"), ["period"], ["value", *_WAVES_HOURLY])
def calendar_hourly(spark, sf_dir):
    rows = hourly_actuals(spark, sf_dir).select("region", "period", "value")
    return calendar.calendar_hourly(rows)


@query(with_views(f"SELECT region, period, value, {CALENDAR_DAILY} FROM daily", "daily"), ["period"], ["value", *_WAVES_DAILY])
def calendar_daily(spark, sf_dir):
    rows = actuals(spark, sf_dir, "daily").select("region", "period", "value")
    return calendar.calendar_daily(rows)


@query(
    with_views(f"SELECT region, series, period, value, {', '.join(_LAG['hourly'])} FROM hlook", "hlook"),
    ["period"],
    ["value", *_LAG["hourly"]],
)
def lag_features(spark, sf_dir):
    return features.lag_features(_filled(spark, sf_dir), HOURLY_LAGS)


@query(
    with_views(f"SELECT region, series, period, value, {', '.join(_LAG['daily'])} FROM dlook", "dlook"),
    ["period"],
    ["value", *_LAG["daily"]],
    digits=6,
)
def lag_features_daily(spark, sf_dir):
    return features.lag_features(_filled(spark, sf_dir, "daily"), DAILY_LAGS, resolution="daily")


@query(
    with_views(f"SELECT region, series, period, value, {', '.join(_ROLL['hourly'])} FROM hlook", "hlook"),
    ["period"],
    ["value", *_ROLL["hourly"]],
    digits=7,
)
def rolling_mean(spark, sf_dir):
    return features.rolling_mean(_filled(spark, sf_dir), HOURLY_ROLLS)


@query(
    with_views(f"SELECT region, series, period, value, {', '.join(_ROLL['daily'])} FROM dlook", "dlook"),
    ["period"],
    ["value", *_ROLL["daily"]],
    digits=6,
)
def rolling_mean_daily(spark, sf_dir):
    return features.rolling_mean(_filled(spark, sf_dir, "daily"), DAILY_ROLLS, resolution="daily")


@query(
    with_views("SELECT * FROM hfeatures", "hfeatures"),
    ["period"],
    ["y", *_WAVES_HOURLY, *_LAG["hourly"], *_ROLL["hourly"]],
    digits=7,
)
def feature_matrix(spark, sf_dir):
    return features.feature_matrix(actuals(spark, sf_dir), HOURLY)


@query(
    with_views("SELECT * FROM dfeatures", "dfeatures"),
    ["period"],
    ["y", *_WAVES_DAILY, *_LAG["daily"], *_ROLL["daily"]],
    digits=6,
)
def feature_matrix_daily(spark, sf_dir):
    return features.feature_matrix(actuals(spark, sf_dir, "daily"), DAILY)


def _split_sql(source: str, minimum: int) -> str:
    return f"""SELECT region, series, period, y, pos > n - n_test AS is_test, n - n_test AS train_rows, n_test AS test_rows
        FROM (SELECT *, CAST(round_even(n * 0.2, 0) AS BIGINT) AS n_test
              FROM (SELECT region, series, period, y,
                           row_number() OVER (PARTITION BY region, series ORDER BY period) AS pos,
                           count(*) OVER (PARTITION BY region, series) AS n FROM {source}))
        WHERE n >= {minimum} AND n_test >= 1 AND n - n_test >= 50"""


@query(with_views(_split_sql("hfeatures", 96), "hfeatures"), ["period"], ["y"])
def split_fraction(spark, sf_dir):
    split = splits.split_fraction(features.feature_matrix(actuals(spark, sf_dir), HOURLY), 0.2, HOURLY)
    return split.select(*KEYS, "period", "y", "is_test", "train_rows", "test_rows")


@query(with_views(_split_sql("dfeatures", 60), "dfeatures"), ["period"], ["y"], digits=6)
def split_fraction_daily(spark, sf_dir):
    split = splits.split_fraction(features.feature_matrix(actuals(spark, sf_dir, "daily"), DAILY), 0.2, DAILY)
    return split.select(*KEYS, "period", "y", "is_test", "train_rows", "test_rows")


@query(with_views("SELECT * FROM hholdout", "hholdout"), ["period", "test_start"], ["value"])
def split_holdout_calendar(spark, sf_dir):
    return splits.split_holdout_calendar(gridding.regular_grid(actuals(spark, sf_dir)), 168)


@query(
    with_views(
        """SELECT region, series, period, value, CAST(pos - n + 168 AS INTEGER) AS step_no,
                  min(period) OVER (PARTITION BY region, series) AS test_start
           FROM (SELECT region, series, period, value,
                        row_number() OVER (PARTITION BY region, series ORDER BY period) AS pos,
                        count(*) OVER (PARTITION BY region, series) AS n
                 FROM hgrid WHERE value IS NOT NULL)
           WHERE n >= 168 + 96 AND pos > n - 168""",
        "hgrid",
    ),
    ["period", "test_start"],
    ["value"],
)
def split_holdout_count(spark, sf_dir):
    return splits.split_holdout_count(gridding.regular_grid(actuals(spark, sf_dir)), 168, 96)


@query(
    with_views(
        """SELECT region, series, period, value
           FROM (SELECT *, row_number() OVER (PARTITION BY region, series ORDER BY period DESC) AS back
                 FROM hholdout WHERE NOT is_test) WHERE back <= 240""",
        "hholdout",
    ),
    ["period"],
    ["value"],
)
def trim_train(spark, sf_dir):
    split = splits.split_holdout_calendar(gridding.regular_grid(actuals(spark, sf_dir)), 168)
    return splits.trim_train(split.where(~F.col("is_test")), 240).select(*KEYS, "period", "value")


@query(
    """WITH pairs AS (
         SELECT upper(event_type) AS region, CAST(user_id AS VARCHAR) AS series, date_trunc('hour', ts) AS period,
                sum(value) AS value FROM events GROUP BY 1, 2, 3)
       SELECT region, series, period, value
       FROM (SELECT *, count(value) OVER (PARTITION BY region, series) AS n FROM pairs) WHERE n >= 15""",
    ["period"],
    ["value"],
)
def eligible_series(spark, sf_dir):
    """One series per event type and user; only those with enough values stay."""
    return splits.eligible_series(user_series(spark, sf_dir), 15)


def user_series(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.groupBy(
        F.upper("event_type").alias("region"),
        F.col("user_id").cast("string").alias("series"),
        F.date_trunc("hour", "ts").alias("period"),
    ).agg(F.sum("value").alias("value"))


@query(
    with_views(
        """SELECT region, series, origin AS issue_time, CAST(s.step_no AS INTEGER) AS step_no,
                  origin + s.step_no * INTERVAL 1 HOUR AS target_time
           FROM (SELECT region, series, max(period) AS origin FROM hourly GROUP BY region, series),
                (SELECT unnest(generate_series(1, 168)) AS step_no) AS s""",
        "hourly",
    ),
    ["issue_time", "target_time"],
)
def future_grid(spark, sf_dir):
    origins = hourly_actuals(spark, sf_dir).groupBy(*KEYS).agg(F.max("period").alias("origin"))
    return splits.future_grid(origins, 168)
