from datetime import datetime

import pytest

from steploom.functions.errors import by_series, error_sums
from steploom.operators.evaluate import (
    attach_info,
    best_combo,
    combo_scores,
    forecast_metrics,
    join_actual_forecast,
    mean_info,
    overall_metrics,
    rank_by_error,
    top_combos,
    top_groups,
)
from steploom.schemas import ACTUALS, FORECASTS

PAIRS = "region string, series string, period timestamp, value double, yhat double"
T0 = datetime(2026, 1, 1)
KEYS = ["region", "series"]


def test_formulas(spark):
    rows = spark.createDataFrame([("R", "s", T0, 10.0, 12.0), ("R", "s", T0, -4.0, -3.0), ("R", "s", T0, 0.0, 1.0)], PAIRS)
    m = forecast_metrics(rows).first()
    assert m.mae == pytest.approx(4 / 3) and m.rmse == pytest.approx(2**0.5) and m.n == 3
    assert m.mape == pytest.approx(100 * (0.2 + 0.25) / 2)
    assert m.smape == pytest.approx(100 * (2 / 11 + 1 / 3.5 + 1 / 0.5) / 3)


def test_zero_denominators(spark):
    rows = spark.createDataFrame([("R", "s", T0, 0.0, 0.0)], PAIRS)
    m = forecast_metrics(rows).first()
    assert (m.mae, m.rmse, m.mape, m.smape, m.n) == (0.0, 0.0, 0.0, 0.0, 1)
    assert by_series(error_sums(rows, KEYS), KEYS, empty=None).first().mape is None


def test_null_keys_count_only_overall(spark):
    actual = spark.createDataFrame([(None, "s", T0, 10.0), ("R", "s", T0, 20.0)], ACTUALS)
    forecast = spark.createDataFrame([(None, "s", T0, T0, 11.0), ("R", "s", T0, T0, 23.0)], FORECASTS)
    joined = join_actual_forecast(actual, forecast)
    assert [(r.region, r.mae) for r in forecast_metrics(joined).collect()] == [("R", 3.0)]
    total = overall_metrics(joined).first()
    assert (total.mae, total.n) == (2.0, 2)


def test_join_drops_missing_and_fans_out(spark):
    nan = float("nan")
    actual = spark.createDataFrame([("R", "s", T0, 1.0), ("R", "s", T0, 2.0), ("Q", "s", T0, nan)], ACTUALS)
    forecast = spark.createDataFrame([("R", "s", T0, T0, 5.0), ("Q", "s", T0, T0, 5.0), ("R", "s", T0, T0, nan)], FORECASTS)
    assert sorted(r.value for r in join_actual_forecast(actual, forecast).collect()) == [1.0, 2.0]


def test_no_pairs_give_no_rows(spark):
    rows = spark.createDataFrame([], PAIRS)
    assert forecast_metrics(rows).count() == 0 and overall_metrics(rows).count() == 0


def test_info_and_means(spark):
    scores = spark.createDataFrame([("A", "s", 1.0), ("B", "s", 2.0)], "region string, series string, mape double")
    info = spark.createDataFrame([("A", "s", 10.0, float("nan")), ("C", "s", 1.0, 1.0)], "region string, series string, aic double, bic double")
    joined = attach_info(scores, info)
    assert {(r.region, r.aic) for r in joined.collect()} == {("A", 10.0), ("B", None)}
    assert tuple(mean_info(info).first()) == (5.5, 1.0)


def test_score_ties_and_missing_scores(spark):
    rows = spark.createDataFrame(
        [("7d", 2, 5.0), ("7d", 1, 5.0), ("7d", 0, float("nan")), ("7d", 3, None)], "window string, combo_id int, mape double"
    )
    assert best_combo(rows).first().combo_id == 1
    assert [r.combo_id for r in top_combos(rows.where("mape < 10"), 2).collect()] == [1, 2]
    scores = combo_scores(rows.unionByName(rows.selectExpr("window", "combo_id", "9.0 as mape")), ["combo_id"])
    assert {(r.combo_id, r.mape, r.n_series) for r in scores.collect()} == {(0, 9.0, 2), (1, 7.0, 2), (2, 7.0, 2), (3, 9.0, 2)}


def test_rankings(spark):
    rows = [("A", "s", T0, 1.0, 1.0)] * 2 + [("B", "s", T0, 1.0, 2.0)] * 3 + [("C", "s", T0, 1.0, 3.0)] * 2
    joined = spark.createDataFrame(rows, PAIRS)
    assert {r.region for r in top_groups(joined, 2).collect()} == {"A", "B"}
    assert [r.region for r in rank_by_error(forecast_metrics(joined)).collect()] == ["C", "B", "A"]
