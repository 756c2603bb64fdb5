"""What every learner shares: scaling, tails and the persistence fallback."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.splits import future_grid, trim_train
from ..schemas import KEYS, SeriesModel
from ..session import materialize


class Learner(Protocol):
    """A forecaster for all series of a table at once.

    ``forecast`` gets filled grids of trainable series as ``keys, period, z`` (values
    scaled per series) with their ``profile`` and returns predictions
    ``keys, step_no, z`` and training information ``keys, *info_cols``.  ``splits``: whether
    it can also be fitted on feature rows and score later ones with their true lags.
    """

    info_cols: tuple[str, ...]
    splits: bool

    def trainable(self, config: SeriesModel) -> Column: ...

    def forecast(
        self, scaled: DataFrame, profile: DataFrame, horizon: int, config: SeriesModel, keys: Sequence[str]
    ) -> tuple[DataFrame, DataFrame]: ...


def profile_of(filled: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Length, last time, mean and spread of each filled grid."""
    spread = F.stddev_pop("value")
    return filled.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("points"),
        F.max("period").alias("origin"),
        F.avg("value").alias("level"),
        F.when(spread > 0, spread).otherwise(1.0).alias("spread"),
        F.max_by("value", "period").alias("last_value"),
    )


def scale(filled: DataFrame, profile: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Values of the profiled series as distance from their mean in spreads."""
    joined = filled.join(profile.select(*keys, "level", "spread"), list(keys))
    return joined.select(*keys, "period", ((F.col("value") - F.col("level")) / F.col("spread")).alias("value"))


def unscale(scaled: DataFrame, profile: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Predictions ``z`` back in the units of their series, as ``yhat``."""
    joined = scaled.join(profile.select(*keys, "level", "spread"), list(keys))
    return joined.withColumn("yhat", F.col("level") + F.col("spread") * F.col("z")).drop("z", "level", "spread")


def tails(
    df: DataFrame, length: int, config: SeriesModel, keys: Sequence[str] = KEYS, columns: Sequence[str] = ("value",)
) -> DataFrame:
    """The last ``length`` steps of each series as arrays, oldest first.

    ``length`` is fixed by the feature set, so the arrays do not grow with the data.
    """
    recent = trim_train(df, length, keys, config.resolution)
    rows = recent.groupBy(*keys).agg(
        F.max("period").alias("origin"), F.array_sort(F.collect_list(F.struct("period", *columns))).alias("_rows")
    )
    return rows.select(*keys, "origin", *[F.col("_rows")[c].alias(c) for c in columns])


def persistence(
    origins: DataFrame, horizon: int, resolution: str = "hourly", keys: Sequence[str] = KEYS
) -> DataFrame:
    """Repeat each series' last value; without any value the forecast is 0."""
    last = origins.withColumn("yhat", F.coalesce("last_value", F.lit(0.0)))
    return future_grid(last, horizon, resolution, keys, carry=["yhat"])


@dataclass(frozen=True)
class Prepared:
    """What all settings of a learner have in common: profiles, scaled grids and feature rows.

    ``features`` is None for learners that make their own.
    """

    profile: DataFrame
    ready: DataFrame
    scaled: DataFrame
    features: DataFrame | None


def prepare(
    filled: DataFrame, config: SeriesModel, learner: Learner, keys: Sequence[str] = KEYS, store: bool = False
) -> Prepared:
    """Profile and scale filled grids; ``store`` writes what several fits will read."""
    kept = materialize if store else lambda df, name: df
    profile = kept(profile_of(filled, keys), "profile")
    ready = profile.where(learner.trainable(config))
    scaled = kept(scale(filled, ready, keys), "scaled")
    return Prepared(profile, ready, scaled, learner.prepare(scaled, config, keys) if hasattr(learner, "prepare") else None)


def _joined(
    z: DataFrame, given: Prepared, horizon: int, config: SeriesModel, learner: Learner, keys: Sequence[str]
) -> DataFrame:
    """Scaled predictions in their series' units, with the persistence of the series that are too short."""
    columns = [*keys, "origin", "step_no", "yhat"]
    profiled = z.join(given.ready.select(*keys, "origin", "level", "spread"), list(keys))
    trained = profiled.withColumn("yhat", F.col("level") + F.col("spread") * F.col("z")).select(*columns)
    short = given.profile.where(~learner.trainable(config))
    repeated = persistence(short, horizon, config.resolution, keys).withColumnRenamed("issue_time", "origin")
    return trained.unionByName(repeated.select(*columns))


def forecast_filled(
    filled: DataFrame,
    horizon: int,
    config: SeriesModel,
    learner: Learner,
    keys: Sequence[str] = KEYS,
    prepared: Prepared | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Forecast every filled grid: trainable series by the learner, others by persistence.

    Returns ``keys, origin, step_no, yhat`` and the training information of trained series.
    Predictions meet their series' profile once, for scale and origin together.
    """
    given = prepared or prepare(filled, config, learner, keys)
    shared = {} if given.features is None else {"features": given.features}
    z, info = learner.forecast(given.scaled, given.ready, horizon, config, keys, **shared)
    return _joined(z, given, horizon, config, learner, keys), info


def forecast_filled_stages(
    filled: DataFrame,
    horizon: int,
    config: SeriesModel,
    learner: Learner,
    stages: Sequence[int],
    keys: Sequence[str] = KEYS,
    prepared: Prepared | None = None,
) -> dict[int, DataFrame]:
    """``forecast_filled`` after each number of trees, from one fit if the learner has stages."""
    if not hasattr(learner, "forecast_stages"):
        return dict.fromkeys(stages, forecast_filled(filled, horizon, config, learner, keys, prepared)[0])
    given = prepared or prepare(filled, config, learner, keys)
    shared = {} if given.features is None else {"features": given.features}
    paths, _ = learner.forecast_stages(given.scaled, given.ready, horizon, config, stages, keys, **shared)
    return {n: _joined(z, given, horizon, config, learner, keys) for n, z in paths.items()}
