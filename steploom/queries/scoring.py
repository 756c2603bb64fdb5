"""Joins of actuals and forecasts, metrics, rankings and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate
from ..operators.views import region_list as sorted_regions
from ..plans import scorekeeping
from ..plans.backtesting import overlap_evaluation as score_overlap
from ..plans.tuning import grid_combos
from ..plans.tuning import series_x_params as cross_params
from ..schemas import KEYS, TreeSettings
from ..schemas import window_registry as registry
from ..session import fresh_path, materialize
from .data import actuals, forecasts, hourly_actuals, season_scores
from .registry import query
from .series import user_series
from .sql import metrics, with_views
from .tables import BEST, WINDOW_VALUES, best_documents

ERRORS = ["mae", "rmse", "mape", "smape"]


def _joined(spark, sf_dir):
    seen = actuals(spark, sf_dir)
    return evaluate.join_actual_forecast(seen, forecasts(spark, sf_dir, seen=seen))


def _by_series(spark, sf_dir):
    return evaluate.forecast_metrics(_joined(spark, sf_dir))


def _info(spark, sf_dir):
    """Criteria of the model that is always zero, per series."""
    n, energy = F.count(F.lit(1)), F.avg(F.col("value") * F.col("value"))
    return hourly_actuals(spark, sf_dir).groupBy(*KEYS).agg(
        n.alias("points"), (n * F.log(energy) + 2).alias("aic"), (n * F.log(energy) + F.log(n)).alias("bic")
    )


@query(with_views("SELECT * FROM joined", "joined"), ["period", "issue_time", "target_time"], ["value", "yhat"])
def join_actual_forecast(spark, sf_dir):
    return _joined(spark, sf_dir)


@query(with_views("SELECT * FROM by_series", "by_series"), doubles=ERRORS)
def forecast_metrics(spark, sf_dir):
    return _by_series(spark, sf_dir)


@query(with_views(f"SELECT {metrics()} FROM joined", "joined"), doubles=ERRORS)
def overall_metrics(spark, sf_dir):
    return evaluate.overall_metrics(_joined(spark, sf_dir))


@query(
    with_views("SELECT avg(aic) AS aic_mean_by_series, avg(bic) AS bic_mean_by_series FROM info", "info"),
    doubles=["aic_mean_by_series", "bic_mean_by_series"],
)
def mean_info(spark, sf_dir):
    return evaluate.mean_info(_info(spark, sf_dir))


@query(
    with_views("SELECT * FROM by_series LEFT JOIN info USING (region, series)", "by_series", "info"),
    doubles=[*ERRORS, "aic", "bic"],
)
def attach_info(spark, sf_dir):
    return evaluate.attach_info(_by_series(spark, sf_dir), _info(spark, sf_dir))


def _combos(spark, sf_dir):
    return evaluate.combo_scores(season_scores(spark, sf_dir), ["window", "combo_id"])


@query(
    with_views(
        """SELECT window_key AS "window", CAST(combo_id AS INTEGER) AS combo_id, mape, n_series FROM combos""", "combos"
    ),
    doubles=["mape"],
)
def combo_scores(spark, sf_dir):
    return _combos(spark, sf_dir)


@query(
    with_views(
        """SELECT window_key AS "window", CAST(combo_id AS INTEGER) AS combo_id, mape, n_series
           FROM (SELECT *, row_number() OVER (PARTITION BY window_key ORDER BY mape, combo_id) AS place FROM combos)
           WHERE place = 1""",
        "combos",
    ),
    doubles=["mape"],
)
def best_combo(spark, sf_dir):
    return evaluate.best_combo(_combos(spark, sf_dir))


@query(
    with_views(
        """SELECT window_key AS "window", CAST(combo_id AS INTEGER) AS combo_id, mape, n_series
           FROM combos ORDER BY mape, combo_id LIMIT 5""",
        "combos",
    ),
    doubles=["mape"],
)
def top_combos(spark, sf_dir):
    return evaluate.top_combos(_combos(spark, sf_dir), 5)


_COMBO_ROWS = ", ".join("(" + ", ".join(str(v) for v in c.values()) + ")" for c in grid_combos())


@query(
    f"""SELECT s.region, s.series, p.* FROM (
          SELECT DISTINCT upper(event_type) AS region, CAST(user_id AS VARCHAR) AS series FROM events) AS s
        CROSS JOIN (
          SELECT combo_id, n_estimators, max_depth, CAST(learning_rate AS DOUBLE) AS learning_rate,
                 CAST(subsample AS DOUBLE) AS subsample, CAST(colsample_bytree AS DOUBLE) AS colsample_bytree,
                 min_child_weight
          FROM (VALUES {_COMBO_ROWS}) AS v(combo_id, n_estimators, max_depth, learning_rate, subsample,
                                           colsample_bytree, min_child_weight)) AS p"""
)
def series_x_params(spark, sf_dir):
    series = user_series(spark, sf_dir).select(*KEYS).distinct()
    return cross_params(series, grid_combos())


_DEFAULTS = TreeSettings()


@query(
    with_views("SELECT * FROM combos", "combos").replace("\nSELECT * FROM combos", f",\n{BEST}\n")
    + f"""SELECT w.key, w.resolution, coalesce(b.n_estimators, {_DEFAULTS.n_estimators}) AS n_estimators,
                 coalesce(b.max_depth, {_DEFAULTS.max_depth}) AS max_depth,
                 CAST(coalesce(b.learning_rate, {_DEFAULTS.learning_rate}) AS DOUBLE) AS learning_rate,
                 CAST({_DEFAULTS.subsample} AS DOUBLE) AS subsample,
                 CAST({_DEFAULTS.colsample_bytree} AS DOUBLE) AS colsample_bytree,
                 coalesce(b.min_child_weight, {_DEFAULTS.min_child_weight}) AS min_child_weight,
                 b.window_key IS NOT NULL AS tuned
          FROM (VALUES {WINDOW_VALUES}) AS w(key, resolution, horizon)
          LEFT JOIN best AS b ON b.window_key = w.key"""
)
def params_or_default(spark, sf_dir):
    """Two windows have a stored winner, the others take the defaults."""
    return evaluate.params_or_default(registry(spark), best_documents(spark, sf_dir))


@query(
    with_views(
        """SELECT * FROM joined WHERE region IN (
             SELECT region FROM joined GROUP BY region, series ORDER BY count(*) DESC, region LIMIT 2)""",
        "joined",
    ),
    ["period", "issue_time", "target_time"],
    ["value", "yhat"],
)
def top_groups(spark, sf_dir):
    return evaluate.top_groups(_joined(spark, sf_dir), 2)


@query(
    with_views("SELECT * FROM by_series ORDER BY mape DESC, region", "by_series"), doubles=ERRORS
)
def rank_by_error(spark, sf_dir):
    return evaluate.rank_by_error(_by_series(spark, sf_dir))


@query(
    with_views("SELECT region FROM hourly UNION SELECT region FROM dforecasts", "hourly", "dforecasts")
)
def region_list(spark, sf_dir):
    return sorted_regions(hourly_actuals(spark, sf_dir), forecasts(spark, sf_dir, "daily"))


_REGISTRY_VALUES = ", ".join(
    f"('{k}', '{label}', {h}, '{r}', {hh})"
    for k, label, h, r, hh in (
        ("7d", "7 days", 168, "hourly", 168),
        ("14d", "14 days", 336, "hourly", 336),
        ("1mo", "1 month", 720, "hourly", 720),
        ("3mo", "3 months", 90, "daily", 2160),
        ("6mo", "6 months", 180, "daily", 4320),
        ("1yr", "1 year", 365, "daily", 8760),
    )
)


@query(
    with_views(
        f"""SELECT w.*, (SELECT count(*) FROM (
                SELECT 'hourly' AS resolution, count(value) AS n FROM hourly GROUP BY region, series
                UNION ALL SELECT 'daily', count(value) FROM daily GROUP BY region, series) AS s
              WHERE s.resolution = w.resolution AND s.n > w.horizon) AS series_long_enough
            FROM (VALUES {_REGISTRY_VALUES}) AS w(key, label, horizon, resolution, horizon_hours)""",
        "hourly",
        "daily",
    )
)
def window_registry(spark, sf_dir):
    """The windows, each with the number of series whose history exceeds its horizon."""
    sizes = None
    for resolution in ("hourly", "daily"):
        counts = actuals(spark, sf_dir, resolution).groupBy(*KEYS).agg(F.count("value").alias("_n"))
        counts = counts.groupBy("_n").agg(F.count(F.lit(1)).alias("_series"))
        counts = counts.select(F.lit(resolution).alias("resolution"), "_n", "_series")
        sizes = counts if sizes is None else sizes.unionByName(counts)
    windows = registry(spark)
    return (
        windows.join(sizes, "resolution", "left")
        .groupBy(*windows.columns)
        .agg(F.coalesce(F.sum(F.when(F.col("_n") > F.col("horizon"), F.col("_series"))), F.lit(0)).alias("series_long_enough"))
    )


@query(with_views("SELECT * FROM by_series", "by_series"), doubles=ERRORS)
def overlap_evaluation(spark, sf_dir):
    seen = actuals(spark, sf_dir)
    return score_overlap(seen, forecasts(spark, sf_dir, seen=seen)).by_series


@query(with_views("SELECT * FROM by_series", "by_series"), doubles=ERRORS)
def overlap_evaluation_by_arrivals(spark, sf_dir):
    """The same scores kept up to date in three arrivals: the first weeks, the rest, and some hours once more."""
    seen = materialize(actuals(spark, sf_dir), "seen")
    ahead = materialize(forecasts(spark, sf_dir, seen=seen), "ahead")
    path, start = fresh_path(spark, "sums"), seen.agg(F.min("period")).scalar()
    early = F.unix_timestamp("period") < F.unix_timestamp(start) + 25 * 86_400
    first, rest = seen.where(early), seen.where(~early)
    scorekeeping.update_scores(first, first, ahead, path)
    scorekeeping.update_scores(rest, seen, ahead, path)
    scorekeeping.update_scores(rest.where(F.hour("period") < 3), seen, ahead, path)
    return scorekeeping.kept_scores(spark, path)
