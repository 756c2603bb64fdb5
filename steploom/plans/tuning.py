"""Grid searches over hyperparameters."""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.errors import by_series, error_sums
from ..learners.arima import Order, forecast_orders, order_grid
from ..learners.base import Learner, forecast_filled_stages, prepare, profile_of, scale, unscale
from ..operators.buckets import grid_positions
from ..operators.evaluate import best_combo, combo_scores, join_actual_forecast
from ..operators.gridding import regular_grid
from ..operators.splits import eligible_series, split_holdout_calendar, trim_train
from ..schemas import HYPERPARAMETERS, KEYS, TREE_GRID, ForecastWindow, model_for
from ..session import materialize, side_by_side

PARAMETERS = HYPERPARAMETERS.fieldNames()


def grid_combos(grid: dict[str, list] | None = None) -> list[dict]:
    """All combinations of a grid with their number, the last parameter varying fastest."""
    grid = grid or TREE_GRID
    kinds = {f.name: int if isinstance(f.dataType, T.IntegerType) else float for f in HYPERPARAMETERS.fields}
    rows = itertools.product(*[grid[p] for p in PARAMETERS])
    return [{"combo_id": i, **{p: kinds[p](v) for p, v in zip(PARAMETERS, row)}} for i, row in enumerate(rows)]


def shared_fits(combos: Sequence[dict], learner: Learner) -> list[list[dict]]:
    """Combinations that one fit serves: those that differ in the number of trees only, if the learner has stages."""
    if not hasattr(learner, "forecast_stages"):
        return [[c] for c in combos]
    groups: dict[tuple, list[dict]] = {}
    for c in combos:
        groups.setdefault(tuple(c[p] for p in PARAMETERS if p != "n_estimators"), []).append(c)
    return list(groups.values())


def series_x_params(series: DataFrame, combos: Sequence[dict]) -> DataFrame:
    """Each series with each combination; the combinations travel as one literal array."""
    rows = F.array(
        *[F.struct(*[F.lit(v).alias(k) for k, v in combo.items()]) for combo in combos]
    )
    return series.select("*", F.inline(rows))


def tuning_split(
    df: DataFrame, window: ForecastWindow, keys: Sequence[str] = KEYS, max_train_steps: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Training rows and held-out steps of the series long enough to tune a window.

    Holes are filled before the split, so filled values are also scored.
    """
    keys, config = list(keys), model_for(window.resolution)
    grid = regular_grid(df, keys, window.resolution)
    long = eligible_series(grid, window.horizon + config.min_observations + 1, keys)
    filled = regular_grid(long, keys, window.resolution, fill=True)
    placed = materialize(grid_positions(filled, keys, config.step_us), "tuning")
    held = placed.where(F.col("_pos") > F.col("_n") - window.horizon).select(
        *keys, (F.col("_pos") - F.col("_n") + window.horizon).cast("int").alias("step_no"), "period", "value"
    )
    train = placed.where(F.col("_pos") <= F.col("_n") - window.horizon).select(*keys, "period", "value")
    return trim_train(train, max_train_steps, keys, window.resolution), held


def score_combo(steps: DataFrame, held: DataFrame, horizon: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """Percentage error per series, NULL without usable actuals; incomplete forecasts are skipped."""
    sums = error_sums(held.join(steps.where(~F.isnan("yhat")), [*keys, "step_no"]), keys)
    return by_series(sums.where(F.col("n") == horizon), keys, empty=None)


def grid_search(
    df: DataFrame,
    window: ForecastWindow,
    learner: Learner,
    grid: dict[str, list] | None = None,
    keys: Sequence[str] = KEYS,
    max_train_steps: int | None = None,
) -> DataFrame:
    """Mean percentage error of each combination over all series of a window.

    The combinations are few and known up front; each fit is a distributed job over
    all series, and profiles, scaled grids and feature rows are made once for all.
    Combinations that differ in the number of trees share one fit: the shorter ones are
    scored by its first trees.
    """
    keys = list(keys)
    train, held = tuning_split(df, window, keys, max_train_steps)
    train, held = materialize(train, "train"), materialize(held, "held")
    prepared = prepare(train, model_for(window.resolution), learner, keys, store=True)

    def run(combos: list[dict]) -> DataFrame:
        most = max(combos, key=lambda c: c["n_estimators"])
        config = model_for(window.resolution, {p: most[p] for p in PARAMETERS})
        stages = [c["n_estimators"] for c in combos]
        paths = forecast_filled_stages(train, window.horizon, config, learner, stages, keys, prepared)
        parts = []
        for combo in combos:
            scores = score_combo(paths[combo["n_estimators"]], held, window.horizon, keys)
            parts.append(scores.select("*", *[F.lit(v).alias(k) for k, v in combo.items()]))
        return reduce(DataFrame.unionByName, parts)

    scored = side_by_side(df.sparkSession, (partial(run, group) for group in shared_fits(grid_combos(grid), learner)))
    results = reduce(DataFrame.unionByName, scored)
    measures = ["mae", "rmse", "mape", "smape"]
    return combo_scores(results, ["combo_id", *PARAMETERS], measures).select(
        F.lit(window.key).alias("window"), "combo_id", *PARAMETERS, *measures, "n_series"
    )


def best_params(results: DataFrame, window: ForecastWindow, grid: dict[str, list] | None = None) -> DataFrame:
    """The winner of a window as a best-params document.

    When nothing was scored the first value of every list is taken.
    """
    spark = results.sparkSession
    first = grid_combos(grid)[0]
    fallback = spark.createDataFrame(
        [(window.key, *[first[p] for p in PARAMETERS])],
        T.StructType([T.StructField("window", T.StringType()), *HYPERPARAMETERS.fields]),
    )
    scored = results.withColumn("_all", F.lit(1))
    counts = scored.groupBy("window").agg(F.count(F.lit(1)).cast("int").alias("combos_evaluated"))
    best = best_combo(scored.drop("_all"))
    found = fallback.select("window").join(best, "window", "left").join(counts, "window", "left")
    defaults = fallback.select("window", F.struct(*PARAMETERS).alias("_first"))
    chosen = found.join(defaults, "window")
    params = F.when(F.col("combo_id").isNotNull(), F.struct(*PARAMETERS)).otherwise(F.col("_first"))
    return chosen.select(
        "window",
        F.lit(window.resolution).alias("resolution"),
        F.lit(window.horizon).alias("horizon"),
        params.alias("params"),
        F.current_timestamp().alias("tuned_at"),
        F.col("mape").alias("best_mape"),
        F.coalesce("combos_evaluated", F.lit(0)).alias("combos_evaluated"),
    )


def arima_grid_search(
    df: DataFrame,
    orders: Sequence[Order] | None = None,
    horizon: int = 168,
    max_train_steps: int | None = None,
    min_observations: int = 96,
    keys: Sequence[str] = KEYS,
    resolution: str = "hourly",
) -> DataFrame:
    """Mean errors and criteria of each order over all series, from one shared fit."""
    keys, orders = list(keys), list(orders or order_grid())
    config = model_for(resolution)
    split = split_holdout_calendar(regular_grid(df, keys, resolution), horizon, keys, resolution)
    split = materialize(split, "split")
    train = trim_train(split.where(~F.col("is_test")), max_train_steps, keys, resolution)
    filled = materialize(
        regular_grid(train.select(*keys, "period", "value"), keys, resolution, fill=True), "filled"
    )
    profile = profile_of(filled, keys).where(F.col("points") >= min_observations)
    z, criteria = forecast_orders(scale(filled, profile, keys), profile, horizon, config, orders, keys)
    steps = unscale(z, profile, keys)
    ends = split.groupBy(*keys).agg(F.first("test_start").alias("test_start"))
    labelled = steps.join(ends, keys).select(
        *keys, "combo_id", "yhat",
        F.timestamp_micros(
            F.unix_micros("test_start") + (F.col("step_no") - 1) * F.lit(config.step_us)
        ).alias("target_time"),
    )
    actual = split.where("is_test").select(*keys, "period", "value")
    # Scored only when every held-out step has an actual, like positions that must line up.
    sums = error_sums(join_actual_forecast(actual, labelled, keys), [*keys, "combo_id"])
    scores = by_series(sums.where(F.col("n") == horizon), [*keys, "combo_id"], empty=None)
    rows = scores.join(criteria, [*keys, "combo_id"])
    means = combo_scores(rows, ["combo_id", "order"], ["mae", "rmse", "mape", "smape", "aic", "bic"])
    return means.withColumnsRenamed({"order": "params", "aic": "aic_mean", "bic": "bic_mean"})
