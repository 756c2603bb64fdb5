"""Forward forecasts for all series of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import shift_steps
from ..learners.base import Learner, forecast_filled
from ..operators.gridding import regular_grid
from ..schemas import KEYS, SeriesModel
from ..session import materialize


def filled_to_the_end(df: DataFrame, resolution: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """The stored filled grid of each series up to its last value."""
    return materialize(regular_grid(df, keys, resolution, fill=True, trim_tail=True), "filled")


def forecast_grouped(
    df: DataFrame,
    horizon: int,
    config: SeriesModel,
    learner: Learner,
    keys: Sequence[str] = KEYS,
    issue_time: Column | None = None,
    filled: DataFrame | None = None,
) -> DataFrame:
    """``horizon`` steps after each series' last value, with one learner for all series.

    Holes after the last value are cut off before training, so the first prediction
    belongs to the step right behind it.  Series without any value give no rows; those
    too short to train repeat their last value.  Periods must be unique per series.
    ``filled``: what ``filled_to_the_end`` made of ``df``, if it is at hand.
    """
    filled = filled_to_the_end(df, config.resolution, keys) if filled is None else filled
    steps, _ = forecast_filled(filled, horizon, config, learner, keys)
    issued = F.col("origin") if issue_time is None else issue_time
    return steps.select(
        *keys,
        issued.alias("issue_time"),
        shift_steps("origin", F.col("step_no"), config.step_us).alias("target_time"),
        "yhat",
    )
