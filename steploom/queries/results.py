"""Views behind a service and dashboards."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..learners.seasonal import SeasonalNaive
from ..operators import evaluate, views
from ..operators.gridding import regular_grid
from ..plans.backtesting import holdout_backtest
from ..schemas import KEYS, model_for
from ..session import fresh_path
from ..sources import tables
from .data import actuals, forecasts
from .registry import query
from .sql import naive_forecast, with_views

# Forecasts of the held-out week by repeating the last day before it.
_TRAINED = "(SELECT region, series, period, value FROM hholdout WHERE NOT is_test)"


def _stored(spark, sf_dir, frames, name):
    path = fresh_path(spark, name)
    for key, df in frames.items():
        tables.write_table(df.withColumn("window", F.lit(key)), path, ["window"])
    return tables.read_series(spark, path)


@query(
    with_views(
        """, run AS (
             SELECT * FROM hforecasts WHERE region = 'SIGNUP'
               AND issue_time = (SELECT max(issue_time) FROM hforecasts WHERE region = 'SIGNUP'))
           SELECT '7d' AS "window", 'hourly' AS resolution, issue_time, (SELECT count(*) FROM run) AS count,
                  '{"region":"' || region || '","series":"' || series || '","issue_time":"'
                  || strftime(issue_time, '%Y-%m-%dT%H:%M:%S+00:00') || '","target_time":"'
                  || strftime(target_time, '%Y-%m-%dT%H:%M:%S+00:00') || '","yhat":'
                  || CAST(round(yhat, 2) AS VARCHAR) || '}' AS record
           FROM run""",
        "hforecasts",
    ).replace("\n, run", ",\nrun"),
    ["issue_time"],
)
def serve_forecast(spark, sf_dir):
    frames = {"7d": forecasts(spark, sf_dir), "3mo": forecasts(spark, sf_dir, "daily")}
    stored = _stored(spark, sf_dir, frames, "forecasts").withColumn("yhat", F.round("yhat", 2))
    return views.serve_forecast(stored, "7d", "signup")


def _metrics_of(spark, sf_dir, resolution):
    joined = evaluate.join_actual_forecast(
        actuals(spark, sf_dir, resolution), forecasts(spark, sf_dir, resolution)
    )
    scores = evaluate.forecast_metrics(joined)
    return scores.select(*KEYS, *[F.round(c, 2).alias(c) for c in ("mae", "rmse", "mape", "smape")], "n")


@query(
    with_views(
        """SELECT '7d' AS "window", '{"region":"' || region || '","series":"' || series
                  || '","mae":' || CAST(round(mae, 2) AS VARCHAR) || ',"rmse":' || CAST(round(rmse, 2) AS VARCHAR)
                  || ',"mape":' || CAST(round(mape, 2) AS VARCHAR) || ',"smape":' || CAST(round(smape, 2) AS VARCHAR)
                  || ',"n":' || CAST(n AS VARCHAR) || '}' AS record
           FROM by_series""",
        "by_series",
    )
)
def serve_metrics(spark, sf_dir):
    frames = {"7d": _metrics_of(spark, sf_dir, "hourly"), "3mo": _metrics_of(spark, sf_dir, "daily")}
    return views.serve_metrics(_stored(spark, sf_dir, frames, "metrics"), "7d")


@query(
    with_views(
        """SELECT period AS time, value AS mw, 'actual' AS type FROM hourly
           WHERE region = 'ERROR'
             AND period >= (SELECT max(period) - INTERVAL 14 DAY FROM hourly WHERE region = 'ERROR')
           UNION ALL
           SELECT target_time, yhat, 'forecast' FROM hforecasts
           WHERE region = 'ERROR' AND issue_time = (SELECT max(issue_time) FROM hforecasts)""",
        "hourly",
        "hforecasts",
    ),
    ["time"],
    ["mw"],
)
def actual_forecast_frame(spark, sf_dir):
    seen = actuals(spark, sf_dir)
    run = views.latest_issue(forecasts(spark, sf_dir, seen=seen))
    return views.actual_forecast_frame(seen, run, "ERROR", 14)


def _backtest(spark, sf_dir):
    forecast, _ = holdout_backtest(actuals(spark, sf_dir), 168, model_for("hourly"), SeasonalNaive())
    return forecast


_NAIVE_BACKTEST = f"""
    , trained AS {_TRAINED},
    spans AS (SELECT region, series, min(period) AS lo, max(period) AS hi FROM trained GROUP BY region, series),
    tfilled AS (
        SELECT region, series, period,
               CASE WHEN value IS NOT NULL THEN value WHEN pv IS NULL THEN nv WHEN nv IS NULL THEN pv
                    ELSE pv + (nv - pv) * (epoch(period) - epoch(pt)) / (epoch(nt) - epoch(pt)) END AS value
        FROM (SELECT *,
                     last_value(value IGNORE NULLS) OVER back AS pv,
                     last_value(CASE WHEN value IS NOT NULL THEN period END IGNORE NULLS) OVER back AS pt,
                     first_value(value IGNORE NULLS) OVER ahead AS nv,
                     first_value(CASE WHEN value IS NOT NULL THEN period END IGNORE NULLS) OVER ahead AS nt
              FROM trained
              WINDOW back AS (PARTITION BY region, series ORDER BY period
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                     ahead AS (PARTITION BY region, series ORDER BY period
                               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))),
    backtest AS ({naive_forecast("tfilled", "HOUR", 24, 168)})
"""


def backtest_views(select: str) -> str:
    """``select`` behind the held-out week and its naive forecast."""
    return with_views(_NAIVE_BACKTEST + select, "hourly", "hholdout").replace("\n, trained", ",\ntrained")


@query(
    backtest_views(
        """SELECT period AS time, value AS mw, 'actual' AS type FROM hourly
           WHERE region = 'CLICK'
             AND period >= (SELECT min(target_time) - INTERVAL 7 DAY FROM backtest WHERE region = 'CLICK')
           UNION ALL
           SELECT target_time, yhat, 'backtest forecast' FROM backtest WHERE region = 'CLICK'"""
    ),
    ["time"],
    ["mw"],
)
def backtest_overlay(spark, sf_dir):
    return views.backtest_overlay(actuals(spark, sf_dir), _backtest(spark, sf_dir), "CLICK")


@query(
    backtest_views(
        """SELECT g.region, g.series, g.period AS time, g.value AS mw,
                  CASE WHEN g.period < b.test_start THEN 'history' ELSE 'holdout actual' END AS type
           FROM hgrid AS g JOIN (SELECT region, min(target_time) AS test_start FROM backtest GROUP BY region) AS b
             USING (region)
           WHERE g.period >= b.test_start - INTERVAL 169 HOUR AND region IN (
             SELECT DISTINCT region FROM hgrid ORDER BY region LIMIT 4)
           UNION ALL SELECT region, series, target_time, yhat, 'forecast' FROM backtest
           WHERE region IN (SELECT DISTINCT region FROM hgrid ORDER BY region LIMIT 4)"""
    ),
    ["time"],
    ["mw"],
)
def best_config_frame(spark, sf_dir):
    """The chart shows the first four regions by name; that is its feature."""
    grid = regular_grid(actuals(spark, sf_dir))
    return views.best_config_frame(grid, _backtest(spark, sf_dir))


@query(
    with_views(
        "SELECT region, series, n, mae, rmse, mape, smape FROM by_series WHERE region = 'PURCHASE'", "by_series"
    ),
    doubles=["mae", "rmse", "mape", "smape"],
)
def region_metrics(spark, sf_dir):
    seen = actuals(spark, sf_dir)
    joined = evaluate.join_actual_forecast(seen, forecasts(spark, sf_dir, seen=seen))
    return views.region_metrics(evaluate.forecast_metrics(joined), "PURCHASE")


@query(
    with_views("SELECT * FROM hourly ORDER BY period DESC, region LIMIT 50", "hourly"), ["period"], ["value"]
)
def preview_actuals(spark, sf_dir):
    return views.preview(actuals(spark, sf_dir), "period", newest=True)


@query(
    with_views("SELECT * FROM hforecasts ORDER BY target_time, region LIMIT 50", "hforecasts"),
    ["issue_time", "target_time"],
    ["yhat"],
)
def preview_forecast(spark, sf_dir):
    return views.preview(forecasts(spark, sf_dir), "target_time")
