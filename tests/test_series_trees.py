"""Boosted trees of all series at once, their histograms, and the code of a series."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from steploom.learners.boosted import BoostedLearner
from steploom.learners.histogram import TreeRules, Trees, bins_of, grow, histogram, sampled
from steploom.learners.seriestrees import SeriesBoostedLearner, SeriesTreeOptions, edge_table, fit_series, predict_series
from steploom.operators.encoding import CODE, FOLDS, WEIGHT, code_sums, code_table, season_code
from steploom.operators.features import feature_matrix
from steploom.plans.forecasting import forecast_grouped
from steploom.plans.tuning import grid_combos, grid_search, shared_fits
from steploom.schemas import KEYS, ForecastWindow, TreeSettings, model_for
from steploom.session import materialize

TREES = {"n_estimators": 5, "max_depth": 3, "learning_rate": 0.3, "min_child_weight": 2}
SMALL = model_for("hourly", TREES)
LAGS = model_for("hourly", TREES, lags=(1, 24), roll_windows=(), calendar=False)


def wave(n, sign=1, noise=2.0, seed=1):
    r = random.Random(seed)
    return [100 + sign * 20 * math.sin(2 * math.pi * i / 24) + r.gauss(0, noise) for i in range(n)]


def fitted(rows, config, options):
    found = predict_series(rows, fit_series(rows, config, options), config, options)
    return found.orderBy(*KEYS, "period").toPandas()


@pytest.fixture(scope="module")
def two(series):
    return materialize(feature_matrix(series(A=wave(500), B=wave(320, -1, seed=4)), SMALL))


@pytest.mark.parametrize("edges", ["quantile", "width"])
def test_spread_series_get_the_same_trees(two, edges):
    here = fitted(two, SMALL, SeriesTreeOptions(edges=edges))
    spread = fitted(two, SMALL, SeriesTreeOptions(edges=edges, local_rows=0, refresh=2))
    mixed = fitted(two, SMALL, SeriesTreeOptions(edges=edges, local_rows=200, refresh=4))
    np.testing.assert_allclose(spread["z"], here["z"], rtol=1e-9)
    np.testing.assert_allclose(mixed["z"], here["z"], rtol=1e-9)
    assert ((here["z"] - here["y"]) ** 2).mean() < 0.1 * here["y"].var()


def brute(x, y, edges, rules):
    """The same boosting row by row: every node tries every edge of every feature."""
    s, p = rules.settings, [float(np.mean(y))] * len(y)
    value = lambda g, h: -s.learning_rate * g / (h + rules.penalty)
    score = lambda g, h: g * g / (h + rules.penalty)

    def split(rows, depth, gradients):
        g, h = sum(gradients[i] for i in rows), len(rows)
        best = None
        for f in range(len(edges)):
            for edge in edges[f][np.isfinite(edges[f])]:
                left = [i for i in rows if x[i][f] <= edge]
                if min(len(left), h - len(left)) < max(s.min_child_weight, 1):
                    continue
                gl = sum(gradients[i] for i in left)
                gain = (score(gl, len(left)) + score(g - gl, h - len(left)) - score(g, h)) / 2
                if gain > (best[0] + 1e-9 if best else 1e-6):
                    best = (gain, f, edge)
        if best is None or depth == s.max_depth:
            return [(i, value(g, h)) for i in rows]
        _, f, edge = best
        return [leaf for side in (True, False) for leaf in split([i for i in rows if (x[i][f] <= edge) == side], depth + 1, gradients)]

    for _ in range(s.n_estimators):
        gradients = [a - b for a, b in zip(p, y, strict=True)]
        for i, v in split(range(len(y)), 0, gradients):
            p[i] += v
    return p


def test_trees_match_a_search_over_all_splits(spark, series):
    config = model_for("hourly", TREES | {"subsample": 1.0, "colsample_bytree": 1.0}, lags=(1, 24), roll_windows=(), calendar=False)
    rows = feature_matrix(series(A=wave(150, noise=5.0), B=wave(90, -1)), config)
    options = SeriesTreeOptions(bins=16)
    rules = TreeRules(config.trees, options.penalty, options.bins)
    forests = {r.region: r for r in fit_series(rows, config, options).collect()}
    got = fitted(rows, config, options)
    for region, part in got.groupby("region"):
        x = part[config.feature_cols].to_numpy()
        want = brute(x.tolist(), part["y"].tolist(), edge_table(forests[region].edges, options.bins), rules)
        np.testing.assert_allclose(part["z"], want, rtol=1e-9)


def test_histograms_of_parts_add_up():
    r = np.random.default_rng(3)
    bins, place, g = r.integers(0, 16, (500, 4), dtype=np.uint8), r.integers(-1, 4, 500), r.normal(size=500)
    whole = histogram(bins, place, g, 4, 16)
    parts = sum(histogram(bins[i::3], place[i::3], g[i::3], 4, 16) for i in range(3))
    np.testing.assert_allclose(parts, whole, atol=1e-9)
    assert whole[..., 1].sum() == 4 * (place >= 0).sum()


def test_first_trees_of_a_longer_fit_are_those_of_a_shorter_one():
    r = np.random.default_rng(5)
    x, at = r.normal(size=(300, 3)), np.arange(300) * 3_600_000_000
    y = x[:, 0] * 2 + r.normal(size=300)
    edges = edge_table([np.quantile(x[:, f], np.arange(1, 64) / 64) for f in range(3)], 64)
    rules = lambda n: TreeRules(TreeSettings(n_estimators=n, max_depth=3))
    bins = bins_of(x, edges)
    long, short = grow(bins, y, at, 0.0, rules(8)), grow(bins, y, at, 0.0, rules(3))
    np.testing.assert_array_equal(long.sums(bins, 3), short.sums(bins))
    again = Trees.unpack(*long.pack(), rules(8).nodes)
    np.testing.assert_array_equal(again.sums(bins), long.sums(bins))
    assert 0.85 < sampled(at, 0, rules(1)).mean() < 0.95


def test_a_thousand_series_in_one_job(spark):
    start = datetime(2026, 1, 1)
    steps = spark.range(60).withColumn("period", F.lit(start) + F.make_interval(hours=F.col("id").cast("int")))
    names = spark.range(1000).select(F.format_string("S%04d", "id").alias("region"), (F.col("id") * 1.0).alias("level"))
    rows = steps.join(names).select(
        "region", F.col("region").alias("series"), "period", (F.col("level") + 10 * F.sin(F.col("id") * 2 * math.pi / 24)).alias("value")
    )
    features = materialize(feature_matrix(rows, LAGS))
    context = spark.sparkContext

    def jobs(table, group):
        context.setJobGroup(group, group)
        count = fit_series(table, LAGS).count()
        context.setLocalProperty("spark.jobGroup.id", None)
        return count, len(context.statusTracker().getJobIdsForGroup(group))

    many, many_jobs = jobs(features, "many")
    few, few_jobs = jobs(features.where("region < 'S0002'"), "few")
    assert (many, few) == (1000, 2) and abs(many_jobs - few_jobs) <= 2
    found = fitted(features, LAGS, SeriesTreeOptions())
    assert ((found["z"] - found["y"]) ** 2).mean() < 25


def test_null_keys_short_series_and_no_rows(spark):
    schema = "region string, series string, period timestamp, y double, lag_1 double, lag_24 double"
    at = datetime(2026, 1, 1)
    rows = [("", "one", at, 5.0, 1.0, 1.0), (None, "x", at, 1.0, 1.0, 1.0)] + [("C", "same", at + timedelta(hours=i), 7.0, 7.0, 7.0) for i in range(20)]
    for local_rows in (0, 1000):
        options = SeriesTreeOptions(local_rows=local_rows)
        df = spark.createDataFrame(rows, schema)
        found = predict_series(df, fit_series(df, LAGS, options), LAGS, options).collect()
        assert sorted((r.region, round(r.z, 9)) for r in found) == [("", 5.0)] + [("C", 7.0)] * 20
        assert fit_series(df.limit(0), LAGS, options).collect() == []


def test_forecast_equals_its_own_stages_and_backtests(series):
    rows = series(A=wave(400), B=wave(420, -1), SHORT=[5.0] * 10)
    out = forecast_grouped(rows, 24, SMALL, SeriesBoostedLearner()).toPandas()
    assert len(out) == 72 and out["yhat"].notna().all() and (out[out["region"] == "SHORT"]["yhat"] == 5.0).all()
    with pytest.raises(ValueError):
        SeriesTreeOptions(edges="other")
    with pytest.raises(ValueError):
        BoostedLearner("series", coded=True)


@pytest.mark.parametrize("learner", [BoostedLearner(), SeriesBoostedLearner()])
def test_shared_fits_score_like_single_ones(series, learner):
    rows, short = series(A=wave(400), B=wave(300, -1)), ForecastWindow("7d", "7 days", 24, "hourly")
    grid = {"n_estimators": [2, 4], "max_depth": [2], "learning_rate": [0.3], "subsample": [0.9], "colsample_bytree": [0.9], "min_child_weight": [1]}
    both = {r.n_estimators: r.mae for r in grid_search(rows, short, learner, grid).collect()}
    alone = {n: grid_search(rows, short, learner, grid | {"n_estimators": [n]}).first().mae for n in (2, 4)}
    assert both == pytest.approx(alone) and both[2] != both[4]


def test_the_default_grid_needs_eight_fits():
    groups = shared_fits(grid_combos(), SeriesBoostedLearner())
    assert len(groups) == 8 and all(sorted(c["n_estimators"] for c in g) == [300, 600] for g in groups)
    assert len(shared_fits(grid_combos(), object())) == 16


def test_codes_leave_out_their_own_fold(spark, series):
    rows = materialize(feature_matrix(series(A=wave(400), B=wave(320, -1)), SMALL))
    got = season_code(rows, code_sums(rows, SMALL), SMALL).toPandas()
    day = (got["period"].to_numpy(dtype="datetime64[D]").astype(int)) % FOLDS
    for i in range(0, len(got), 37):
        others = got[day != day[i]]
        own = others[(others["region"] == got["region"][i]) & (others["hour"] == got["hour"][i])]["y"]
        assert got[CODE][i] == pytest.approx((own.sum() + WEIGHT * others["y"].mean()) / (len(own) + WEIGHT))
    new = season_code(rows.withColumn("region", F.lit("NEW")), code_sums(rows, SMALL), SMALL, own_fold=False)
    assert new.select(CODE).distinct().count() == 1
    table = {r.region: r[CODE] for r in code_table(code_sums(rows, SMALL), SMALL).collect()}
    assert {len(v) for v in table.values()} == {24} and table["A"][6] > table["B"][6]


def test_a_coded_pooled_model_fits_opposite_patterns(series):
    config = model_for("hourly", {"n_estimators": 20, "max_depth": 3, "learning_rate": 0.3}, lags=(), roll_windows=())
    rows = series(A=wave(600, noise=0.5), B=wave(600, -1, noise=0.5))

    def error(learner):
        out = forecast_grouped(rows, 24, config, learner).toPandas()
        hour = (out["target_time"] - out["issue_time"]).dt.total_seconds() / 3600 + 599
        want = 100 + np.where(out["region"] == "A", 20, -20) * np.sin(2 * np.pi * hour / 24)
        return float(np.abs(out["yhat"] - want).mean())

    assert error(BoostedLearner()) > 8 and error(BoostedLearner(coded=True)) < 5
