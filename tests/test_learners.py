import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from steploom.learners import arima
from steploom.learners.arima import ArimaLearner, Order, forecast_orders, order_grid
from steploom.learners.base import profile_of, scale
from steploom.learners.boosted import BoostedLearner, tree_arrays, walk
from steploom.learners.linear import LinearLearner
from steploom.learners.seasonal import SeasonalNaive
from steploom.operators.features import feature_matrix
from steploom.plans.forecasting import forecast_grouped
from steploom.schemas import model_for

KEYS = ["region", "series"]
HOURLY = model_for("hourly")
SMALL = model_for("hourly", {"n_estimators": 4, "max_depth": 3, "learning_rate": 0.3})


def seasonal(n, noise=0.0, seed=3):
    rng = random.Random(seed)
    return [
        100 + 20 * math.sin(2 * math.pi * i / 24) + 5 * math.sin(2 * math.pi * i / 168) + rng.gauss(0, noise)
        for i in range(n)
    ]


def test_linear_fit_equals_least_squares(series):
    config = model_for("hourly", lags=(1, 2, 24), roll_windows=(24,), ridge=0.0)
    rows = feature_matrix(series(A=seasonal(300, 3.0), B=seasonal(300, 2.0, 9)), config)
    model = LinearLearner().fit(rows, config)
    got = LinearLearner().predict(rows, model, config).toPandas()
    for _, part in got.groupby("region"):
        x = np.column_stack([np.ones(len(part)), part[config.feature_cols]])
        want = x @ np.linalg.lstsq(x, part["y"], rcond=None)[0]
        np.testing.assert_allclose(part["z"], want, rtol=1e-6)


def test_linear_recursion_feeds_on_itself(series):
    config = model_for("hourly", lags=(1, 2), roll_windows=(3,), calendar=False, ridge=0.0)
    y = seasonal(150, 4.0)
    got = [r.yhat for r in forecast_grouped(series(A=y), 12, config, LinearLearner()).orderBy("target_time").collect()]
    rows = [(y[i], y[i - 1], y[i - 2], sum(y[i - 3 : i]) / 3) for i in range(3, len(y))]
    a = np.array(rows)
    x = np.column_stack([np.ones(len(a)), a[:, 1:]])
    coef = np.linalg.lstsq(x, a[:, 0], rcond=None)[0]
    for _ in range(12):
        y.append(float(coef @ [1, y[-1], y[-2], sum(y[-3:]) / 3]))
    np.testing.assert_allclose(got, y[-12:], rtol=1e-7)


@pytest.mark.parametrize("learner", [LinearLearner(), SeasonalNaive(), BoostedLearner(), BoostedLearner("series"), ArimaLearner()])
def test_forecast_shape(series, learner):
    rows = series(A=seasonal(400), B=seasonal(420, 1.0))
    out = forecast_grouped(rows, 24, SMALL, learner).toPandas()
    assert list(out.columns) == [*KEYS, "issue_time", "target_time", "yhat"]
    assert len(out) == 48 and out["yhat"].notna().all()
    for _, part in out.groupby("region"):
        steps = part["target_time"].sort_values().diff().dropna().unique()
        assert len(steps) == 1 and steps[0] == np.timedelta64(1, "h")
        assert part["target_time"].min() - part["issue_time"].iloc[0] == np.timedelta64(1, "h")


def test_short_and_missing_series(series):
    rows = series(SHORT=[50.0] * 10).unionByName(series(NONE=[None] * 5))
    out = forecast_grouped(rows, 6, HOURLY, LinearLearner()).collect()
    assert [(r.region, r.yhat) for r in out] == [("SHORT", 50.0)] * 6


@pytest.mark.parametrize("learner", [LinearLearner(), BoostedLearner()])
def test_constant_series_stays_constant(series, learner):
    out = forecast_grouped(series(A=[7.0] * 300), 24, SMALL, learner).collect()
    assert all(abs(r.yhat - 7.0) < 1e-6 for r in out)


def test_daily_steps(series):
    values = [
        200000 + 30000 * math.sin(2 * math.pi * i / 7) + 50000 * math.sin(2 * math.pi * i / 365) for i in range(500)
    ]
    config = model_for("daily")
    assert config.lags == (1, 2, 3, 7, 14, 28, 365)
    out = forecast_grouped(series(start="2024-01-01", step_hours=24, A=values), 30, config, LinearLearner()).toPandas()
    assert len(out) == 30
    assert set(out["target_time"].sort_values().diff().dropna()) == {np.timedelta64(1, "D")}


def test_linear_model_follows_a_clean_season(series):
    y = seasonal(800)
    out = forecast_grouped(series(A=y[:-48]), 48, HOURLY, LinearLearner()).orderBy("target_time").collect()
    assert np.abs(np.array([r.yhat for r in out]) - y[-48:]).mean() < 0.5


def test_tree_walk_equals_the_model(spark, series):
    rows = feature_matrix(series(A=seasonal(400, 5.0)), SMALL)
    model = BoostedLearner().fit(rows, SMALL)
    want = model.transform(rows).orderBy("period").toPandas()
    trees = tree_arrays(model.stages[-1], spark)
    np.testing.assert_allclose(walk(trees, want[SMALL.feature_cols].to_numpy(dtype=float)), want["z"], rtol=1e-12)


def test_series_scope_fits_each_series_by_itself(series):
    both = forecast_grouped(series(A=seasonal(300), B=[2 * v for v in seasonal(300)]), 3, SMALL, BoostedLearner("series"))
    alone = forecast_grouped(series(B=[2 * v for v in seasonal(300)]), 3, SMALL, BoostedLearner("series"))
    rows = lambda df: sorted((r.target_time, round(r.yhat, 6)) for r in df.where("region = 'B'").collect())
    assert rows(both) == rows(alone) and both.count() == 6


def brute_arima(y, order, horizon, long=48):
    """The same two regressions written out for one series."""
    s = order.season
    w = np.array([y[t] - y[t - 1] - y[t - s] + y[t - s - 1] for t in range(s + 1, len(y))])
    lag = lambda x, k: np.concatenate([np.zeros(k), x[: len(x) - k]])
    m = min(long, len(w) // 3)
    x = np.column_stack([np.ones(len(w))] + [lag(w, k) for k in range(1, m + 1)])
    e = w - x @ np.linalg.lstsq(x, w, rcond=None)[0]
    x = np.column_stack([lag(w, k) for k in order.ar_lags] + [lag(e, k) for k in order.ma_lags])
    coef = np.linalg.lstsq(x, w, rcond=None)[0]
    rss, n, k = ((w - x @ coef) ** 2).sum(), len(w), len(coef) + 1
    llf = -n / 2 * (math.log(2 * math.pi * rss / n) + 1)
    w, e, y = list(w), list(e), list(y)
    for _ in range(horizon):
        w.append(sum(c * v[-k] for c, (v, k) in zip(coef, [(w, k) for k in order.ar_lags] + [(e, k) for k in order.ma_lags])))
        e.append(0.0)
        y.append(w[-1] + y[-1] + y[-s] - y[-s - 1])
    return y[-horizon:], 2 * k - 2 * llf


@pytest.mark.parametrize("width", [128, 4096])
def test_arima_matches_one_series_written_out(series, monkeypatch, width):
    monkeypatch.setattr(arima, "WIDTH", width)
    y = seasonal(400, 4.0)
    filled = series(A=y)
    profile = profile_of(filled)
    orders = [Order(multiplicative=False), Order(0, 1, 1, 0), Order(2, 0, 0, 0)]
    paths, info = forecast_orders(scale(filled, profile), profile, 30, HOURLY, orders)
    level, spread = profile.select("level", "spread").first()
    for combo, order in enumerate(orders):
        got = [level + spread * r.z for r in paths.where(F.col("combo_id") == combo).orderBy("step_no").collect()]
        want, aic = brute_arima(y, order, 30)
        np.testing.assert_allclose(got, want, rtol=1e-5)
        assert info.where(F.col("combo_id") == combo).first().aic == pytest.approx(aic, rel=1e-6)


def alternating(w, s, rounds=2000):
    """Best (phi, Phi) of (1 - phi B)(1 - Phi B^s): each is a plain regression while the other is held."""
    lag = lambda x, k: np.concatenate([np.zeros(k), x[: len(x) - k]])
    phi = big = 0.0
    for _ in range(rounds):
        y, x = w - big * lag(w, s), lag(w, 1) - big * lag(w, s + 1)
        phi = x @ y / (x @ x)
        y, x = w - phi * lag(w, 1), lag(w, s) - phi * lag(w, s + 1)
        big = x @ y / (x @ x)
    rest = w - phi * lag(w, 1) - big * lag(w, s) + phi * big * lag(w, s + 1)
    return phi, big, rest @ rest


def test_multiplicative_fit_finds_the_least_squares(series):
    s, y = 7, np.array(seasonal(500, 6.0))
    w = np.diff(y)[s:] - np.diff(y)[:-s]
    lag = lambda k: np.concatenate([np.zeros(k), w[: len(w) - k]])
    x = np.column_stack([lag(1), lag(s), lag(s + 1)])
    gram, moment = (x.T @ x)[None], (x.T @ w)[None]
    free = np.linalg.solve(gram, moment[..., None])[..., 0]
    order = Order(1, 0, 1, 0, s)
    coef, rss = arima.multiplicative_fit(gram, moment, np.array([w @ w]), order, free)
    phi, big, least = alternating(w, s)
    np.testing.assert_allclose(coef[0], [phi, big, -phi * big], atol=1e-6)
    start = w - x @ [free[0, 0], free[0, 1], -free[0, 0] * free[0, 1]]
    assert rss[0] == pytest.approx(least, rel=1e-10) and rss[0] <= start @ start
    out = forecast_grouped(series(A=y.tolist()), 5, HOURLY, ArimaLearner(order)).orderBy("target_time").collect()
    w, y = w.tolist(), y.tolist()
    for _ in range(5):
        w.append(phi * w[-1] + big * w[-s] - phi * big * w[-s - 1])
        y.append(w[-1] + y[-1] + y[-s] - y[-s - 1])
    np.testing.assert_allclose([r.yhat for r in out], y[-5:], rtol=1e-6)


def test_multiplicative_jacobian_and_parameters():
    order, r = Order(2, 2, 1, 1, 12), np.random.default_rng(4)
    free = r.normal(size=(3, order.parameters))
    coef, jacobian = arima.multiplied(order, free)
    assert coef.shape == (3, len(order.ar_lags + order.ma_lags)) and order.parameters == 6
    for k in range(order.parameters):
        up = free.copy()
        up[:, k] += 1e-6
        np.testing.assert_allclose((arima.multiplied(order, up)[0] - coef) / 1e-6, jacobian[:, :, k], atol=1e-5)
    assert not Order(1, 0, 0, 1).products and not Order(multiplicative=False).products
    gram = np.eye(len(coef[0]))[None].repeat(3, 0)
    start = r.normal(size=coef.shape)
    moment = r.normal(size=coef.shape)
    _, rss = arima.multiplicative_fit(gram, moment, np.full(3, 50.0), order, start)
    own = arima.multiplied(order, start[:, [0, 1, 2, 5, 6, 7]])[0]
    assert (rss <= 50 - 2 * (own * moment).sum(1) + (own**2).sum(1) + 1e-9).all()


def test_order_grid():
    grid = order_grid()
    assert len(grid) == 36 and grid[0].label == "(0,1,0)×(0,1,0,24)"
    assert Order().ar_lags == [1, 24, 25] and Order().ma_lags == [1, 2, 24, 25, 26]
