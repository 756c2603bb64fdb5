"""Backtests: fit on the past of each series, score on what followed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import shift_steps
from ..functions.errors import by_series, error_sums, overall
from ..learners.base import Learner, forecast_filled, unscale
from ..learners.boosted import BoostedLearner
from ..learners.linear import LinearLearner
from ..learners.seriestrees import SeriesBoostedLearner
from ..operators.evaluate import attach_info, join_actual_forecast, mean_info
from ..operators.features import features_of
from ..operators.gridding import regular_grid
from ..operators.splits import (
    rows_before,
    split_fraction,
    split_holdout_calendar,
    split_holdout_count,
    split_info,
    trim_train,
)
from ..schemas import KEYS, SeriesModel
from ..session import materialize


@dataclass
class Backtest:
    """Forecast rows, training information and the scores of one backtest."""

    forecast: DataFrame
    by_series: DataFrame
    overall: DataFrame


def split_forecast(
    df: DataFrame,
    fraction: float,
    config: SeriesModel,
    learner: LinearLearner | BoostedLearner | SeriesBoostedLearner | None = None,
    keys: Sequence[str] = KEYS,
) -> tuple[DataFrame, DataFrame]:
    """Train on the first rows of each series, predict the rest from its true lags.

    Returns forecast rows and, per series, issue time and the sizes of both parts.
    Feature rows of a filled grid have no holes, so a row's place follows from its time.
    """
    keys, learner = list(keys), learner or LinearLearner()
    filled = regular_grid(df, keys, config.resolution, fill=True)
    features = materialize(features_of(filled, config, keys), "features")
    split = materialize(split_fraction(features, fraction, config, keys, contiguous=True), "split")
    # Only training rows set the scale; lags and means move with the values they are made of.
    spread = F.stddev_pop("y")
    profile = split.where(~F.col("is_test")).groupBy(*keys).agg(
        F.avg("y").alias("level"), F.when(spread > 0, spread).otherwise(1.0).alias("spread")
    )
    values = ["y", *config.columns["lag"], *config.columns["roll"]]
    scaled = split.join(profile, keys).withColumns({c: (F.col(c) - F.col("level")) / F.col("spread") for c in values})
    scaled = scaled.select(*split.columns)
    train, test = scaled.where(~F.col("is_test")), scaled.where("is_test")
    if isinstance(learner, (BoostedLearner, SeriesBoostedLearner)):
        predicted = learner.fit_predict(train, test, config, keys)
    else:
        predicted = learner.predict(test, learner.fit(train, config, keys), config, keys)
    info = split_info(split, keys)
    rows = unscale(predicted.select(*keys, "period", "z"), profile, keys)
    forecast = rows.join(info.select(*keys, "issue_time"), keys).select(
        *keys, "issue_time", F.col("period").alias("target_time"), "yhat"
    )
    return forecast, info


def holdout_backtest(
    df: DataFrame,
    horizon: int,
    config: SeriesModel,
    learner: Learner,
    keys: Sequence[str] = KEYS,
    max_train_steps: int | None = None,
    grid: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Forecast each series' last ``horizon`` steps from the history before them.

    Steps follow the resolution, and forecasts are labelled from the first held-out
    step even where the training data ends in a hole.  ``grid``: the regular grid of ``df``, if it is at hand.
    """
    keys = list(keys)
    grid = regular_grid(df, keys, config.resolution) if grid is None else grid
    split = split_holdout_calendar(grid, horizon, keys, config.resolution)
    train = trim_train(split.where(~F.col("is_test")), max_train_steps, keys, config.resolution)
    train = materialize(train.select(*keys, "period", "value", "test_start"), "train")
    about = (
        train.groupBy(*keys)
        .agg(
            F.max(F.when(F.col("value").isNotNull(), F.col("period"))).alias("issue_time"),
            F.count("value").alias("train_points"),
            F.first("test_start").alias("test_start"),
        )
        .where(F.col("train_points") > 0)
    )
    filled = materialize(regular_grid(train, keys, config.resolution, fill=True), "filled")
    steps, trained = forecast_filled(filled, horizon, config, learner, keys)
    forecast = steps.join(about, keys).select(
        *keys,
        "issue_time",
        shift_steps("test_start", F.col("step_no") - 1, config.step_us).alias("target_time"),
        "yhat",
    )
    info = about.select(*keys, "issue_time", F.lit(horizon).alias("holdout_steps"), "train_points").join(
        trained, keys, "left"
    )
    return forecast, info


def refit_backtest(
    df: DataFrame,
    horizon: int,
    config: SeriesModel,
    learner: Learner,
    keys: Sequence[str] = KEYS,
    min_observations: int | None = None,
) -> Backtest:
    """Hold out the last ``horizon`` observed values and pair forecasts by position."""
    keys = list(keys)
    minimum = config.min_observations if min_observations is None else min_observations
    grid = materialize(regular_grid(df, keys, config.resolution), "grid")
    held = materialize(split_holdout_count(grid, horizon, minimum, keys, config.resolution), "held")
    starts = held.where(F.col("step_no") == 1)
    train = rows_before(grid, starts, keys).select(*keys, "period", "value")
    filled = materialize(regular_grid(train, keys, config.resolution, fill=True), "filled")
    steps, trained = forecast_filled(filled, horizon, config, learner, keys)
    paired = held.join(steps, [*keys, "step_no"])
    sums = error_sums(paired, keys)
    scores = attach_info(by_series(sums, keys), trained, keys)
    pooled = overall(sums)
    criteria = [c for c in ("aic", "bic") if c in scores.columns]
    if criteria:
        # One row on each side.
        pooled = pooled.join(F.broadcast(mean_info(scores, criteria)), F.lit(True))
    forecast = paired.select(*keys, F.col("period").alias("target_time"), "step_no", "value", "yhat")
    return Backtest(forecast, scores, pooled)


def score(actual: DataFrame, forecast: DataFrame, info: DataFrame | None, keys: Sequence[str] = KEYS) -> Backtest:
    """Metrics of forecast rows against the actuals, with training information."""
    sums = error_sums(join_actual_forecast(actual, forecast, keys), keys)
    scores = by_series(sums, keys)
    return Backtest(forecast, scores if info is None else attach_info(scores, info, keys), overall(sums))


def backtest_report(
    df: DataFrame,
    horizon: int,
    config: SeriesModel,
    learner: Learner,
    fraction: float = 0.0,
    keys: Sequence[str] = KEYS,
    max_train_steps: int | None = None,
    grid: DataFrame | None = None,
) -> Backtest:
    """Backtest by chronological split when ``fraction`` is given and the learner has one, else by holdout."""
    if fraction > 0 and learner.splits:
        forecast, info = split_forecast(df, fraction, config, learner, keys)
    else:
        forecast, info = holdout_backtest(df, horizon, config, learner, keys, max_train_steps, grid)
    return score(df, materialize(forecast, "forecast"), info, keys)


def overlap_evaluation(actual: DataFrame, forecast: DataFrame, keys: Sequence[str] = KEYS) -> Backtest:
    """Score a saved forecast run on the actuals that have arrived since."""
    return score(actual, forecast, None, keys)
