import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from steploom.learners.arima import ArimaLearner
from steploom.learners.boosted import BoostedLearner
from steploom.learners.linear import LinearLearner
from steploom.learners.seasonal import SeasonalNaive
from steploom.plans.backtesting import backtest_report, holdout_backtest, overlap_evaluation, refit_backtest, split_forecast
from steploom.plans.forecasting import forecast_grouped
from steploom.plans.tuning import arima_grid_search, best_params, grid_combos, grid_search, series_x_params
from steploom.plans.windows import config_for, resolve_windows, run_windows, tune_windows, write_windows
from steploom.schemas import WINDOWS, ForecastWindow, model_for, window, window_registry
from steploom.sources.tables import read_best_params, read_series

HOURLY = model_for("hourly")
TINY = {
    "n_estimators": [2, 3], "max_depth": [2], "learning_rate": [0.3],
    "subsample": [1.0], "colsample_bytree": [1.0], "min_child_weight": [1],
}


def sine(n, size=10):
    return [100 + size * math.sin(2 * math.pi * i / 24) for i in range(n)]


def test_refit_backtest_scores_every_held_out_value(series):
    report = refit_backtest(series(CISO=sine(200)), 24, HOURLY, ArimaLearner())
    rows = report.by_series.collect()
    assert len(rows) == 1 and rows[0].n == 24 and rows[0].mae < 1 and rows[0].aic is not None
    assert "aic_mean_by_series" in report.overall.columns and report.overall.first().n == 24


def test_holdout_labels_start_at_the_test_start(series):
    values = sine(200)
    values[174] = values[175] = None
    forecast, info = holdout_backtest(series(R=values), 24, HOURLY, SeasonalNaive())
    times = [r.target_time for r in forecast.orderBy("target_time").collect()]
    assert times[0] == datetime(2026, 1, 8, 8) and len(times) == 24
    row = info.first()
    assert row.issue_time == datetime(2026, 1, 8, 5) and row.train_points == 174


def test_holdout_trains_on_the_capped_history(series):
    _, info = holdout_backtest(series(R=sine(300)), 24, HOURLY, SeasonalNaive(), max_train_steps=100)
    assert info.first().train_points == 100 and info.first().train_rows == 100.0


def test_too_little_history_gives_empty_results(series):
    report = backtest_report(series(R=sine(20)), 24, HOURLY, LinearLearner())
    assert report.forecast.count() == report.by_series.count() == report.overall.count() == 0
    forecast, info = split_forecast(series(R=sine(100)), 0.2, HOURLY)
    assert forecast.count() == info.count() == 0


@pytest.mark.parametrize("learner", [LinearLearner(), BoostedLearner("series")])
def test_split_backtest(series, learner):
    config = model_for("hourly", {"n_estimators": 3, "max_depth": 3})
    report = backtest_report(series(A=sine(400), B=sine(300, 3)), 168, config, learner, fraction=0.2)
    got = {r.region: (r.n, r.train_rows, r.test_rows) for r in report.by_series.collect()}
    assert got == {"A": (46, 186, 46), "B": (26, 106, 26)}
    assert report.overall.first().n == 72


def test_overlap_evaluation_scores_what_has_arrived(series):
    y = sine(200)
    forecast = forecast_grouped(series(R=y[:180]), 48, HOURLY, SeasonalNaive())
    report = overlap_evaluation(series(R=y), forecast)
    assert report.overall.first().n == 20 and report.overall.first().mae < 1e-9


def test_grid_and_crossing(spark):
    combos = grid_combos()
    assert len(combos) == 16 and combos[1]["min_child_weight"] == 5 and isinstance(combos[0]["max_depth"], int)
    crossed = series_x_params(spark.createDataFrame([("A",), ("B",)], "region string"), combos)
    assert crossed.count() == 32 and crossed.distinct().count() == 32


def test_grid_search_and_stored_winner(spark, series, tmp_path):
    short = ForecastWindow("7d", "7 days", 24, "hourly")
    rows = series(A=sine(400), B=sine(300, 3), C=sine(100))
    results = grid_search(rows, short, BoostedLearner(), TINY)
    assert {r.n_series for r in results.collect()} == {2} and results.count() == 2
    best = best_params(results, short, TINY).first()
    assert best.combos_evaluated == 2 and best.best_mape == results.agg(F.min("mape")).first()[0]
    nothing = best_params(grid_search(series(C=sine(100)), short, SeasonalNaive(), TINY), short, TINY).first()
    assert nothing.params.n_estimators == 2 and nothing.best_mape is None and nothing.combos_evaluated == 0


def test_arima_grid_shares_one_fit(series):
    results = arima_grid_search(series(A=sine(300)), horizon=24).collect()
    assert len(results) == 36 and {r.n_series for r in results} == {1}
    assert min(r.mape for r in results) < 1


def test_windows(spark):
    rows = {r.key: (r.horizon, r.resolution, r.horizon_hours) for r in window_registry(spark).collect()}
    assert list(WINDOWS) == ["7d", "14d", "1mo", "3mo", "6mo", "1yr"]
    assert rows["7d"] == (168, "hourly", 168) and rows["3mo"] == (90, "daily", 2160)
    assert [w.key for w in resolve_windows()] == list(WINDOWS)
    with pytest.raises(KeyError):
        window("2d")


def test_windows_job_writes_partitioned_tables(spark, series, tmp_path):
    tables = {"hourly": series(A=sine(400)), "daily": series(step_hours=24, start="2020-01-01", A=sine(400))}
    results = run_windows(tables, SeasonalNaive(), ["7d", "3mo"], fraction=0.0)
    root = str(tmp_path / "out")
    write_windows(results, root)
    write_windows(run_windows(tables, SeasonalNaive(), ["3mo"], fraction=0.0), root)
    stored = read_series(spark, f"{root}/forecast")
    counts = {r.window: r["count"] for r in stored.groupBy("window").count().collect()}
    assert counts == {"7d": 168, "3mo": 90}
    assert {(r.window, r.region) for r in read_series(spark, f"{root}/forecast_regions").collect()} == {("7d", "A"), ("3mo", "A")}
    with pytest.raises(FileNotFoundError):
        run_windows({"hourly": tables["hourly"]}, SeasonalNaive(), ["3mo"])


def test_tuned_parameters_reach_the_job(spark, series, tmp_path):
    path = str(tmp_path / "params")
    rows = series(A=sine(500))
    assert config_for(spark, path, window("7d")) is None
    tune_windows({"hourly": rows}, BoostedLearner(), path, ["7d"], TINY)
    config = config_for(spark, path, window("7d"))
    assert config.trees.n_estimators in (2, 3) and config.trees.learning_rate == 0.3 and config.resolution == "hourly"
    assert config_for(spark, path, window("14d")) is None
    assert read_best_params(spark, path).count() == 1


@pytest.mark.parametrize("learner", [SeasonalNaive(), ArimaLearner()])
def test_windows_run_with_defaults_for_learners_without_a_split(series, learner):
    results = run_windows({"hourly": series(A=sine(500))}, learner, ["7d"])
    assert results["forecast"].count() == 168 and results["overall"].first().n == 168


def test_split_scale_ignores_test_rows(series):
    """What happens after the split does not change the predictions' inputs from before it."""
    model = model_for("hourly", lags=(1,), roll_windows=(), calendar=False, ridge=5.0)
    y = sine(300)
    a, _ = split_forecast(series(A=y), 0.2, model)
    b, _ = split_forecast(series(A=[*y[:299], 1e6]), 0.2, model)
    first = lambda df: df.orderBy("target_time").first().yhat
    assert abs(first(a) - first(b)) < 1e-9
