"""Train/test splits, training caps, eligibility and forecast labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import shift_steps
from ..schemas import KEYS, MIN_FEATURE_ROWS, STEP_SECONDS, SeriesModel
from .buckets import grid_positions, positions


def _step(resolution: str) -> int:
    return STEP_SECONDS[resolution] * 1_000_000


def split_fraction(
    features: DataFrame, fraction: float, config: SeriesModel, keys: Sequence[str] = KEYS, contiguous: bool = False
) -> DataFrame:
    """Flag the last ``fraction`` of each series' feature rows as test rows.

    The test size is rounded half to even.  Series with too few rows are left out.
    Adds ``is_test``, ``train_rows`` and ``test_rows``.  ``contiguous``: every series has a row for each step.
    """
    if not 0.0 < fraction < 1.0:
        raise ValueError("fraction must lie between 0 and 1")
    placed = (grid_positions if contiguous else positions)(features, keys, config.step_us)
    n_test = F.bround(F.col("_n") * F.lit(float(fraction)), 0).cast("long")
    sized = placed.withColumns({"test_rows": n_test, "train_rows": F.col("_n") - n_test})
    usable = (
        (F.col("_n") >= config.min_observations) & (F.col("test_rows") >= 1) & (F.col("train_rows") >= MIN_FEATURE_ROWS)
    )
    return (
        sized.where(usable).withColumn("is_test", F.col("_pos") > F.col("train_rows")).drop("_pos", "_n")
    )


def split_info(split: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Per series: last training time and the sizes of both parts."""
    return split.groupBy(*keys).agg(
        F.max(F.when(~F.col("is_test"), F.col("period"))).alias("issue_time"),
        F.max("train_rows").alias("train_rows"),
        F.max("test_rows").alias("test_rows"),
    )


def split_holdout_calendar(
    grid: DataFrame, horizon: int, keys: Sequence[str] = KEYS, resolution: str = "hourly"
) -> DataFrame:
    """Hold out the last ``horizon`` calendar steps up to the newest value.

    Adds ``test_start`` and ``is_test``.  Series with no more than ``horizon`` values
    are left out, as are rows after the newest value.
    """
    if horizon < 1:
        raise ValueError("horizon must be at least 1")
    seen = F.when(F.col("value").isNotNull(), F.col("period"))
    ends = (
        grid.groupBy(*keys)
        .agg(F.max(seen).alias("_last"), F.count(seen).alias("_seen"))
        .where(F.col("_seen") > horizon)
        .select(*keys, "_last", shift_steps("_last", -(horizon - 1), _step(resolution)).alias("test_start"))
    )
    return (
        grid.join(ends, list(keys))
        .where(F.col("period") <= F.col("_last"))
        .withColumn("is_test", F.col("period") >= F.col("test_start"))
        .drop("_last")
    )


def split_holdout_count(
    grid: DataFrame,
    horizon: int,
    min_observations: int,
    keys: Sequence[str] = KEYS,
    resolution: str = "hourly",
) -> DataFrame:
    """Hold out the last ``horizon`` observed values, whatever time they span.

    Returns the held-out rows with their position ``step_no`` (1 to horizon) and
    ``test_start``.  Forecasts are later paired by that position, so a hole in the
    holdout shifts the pairing; the calendar split is the aligned one.
    """
    if horizon < 1:
        raise ValueError("horizon must be at least 1")
    seen = positions(grid.where(F.col("value").isNotNull()), keys, _step(resolution))
    held = seen.where((F.col("_n") >= horizon + min_observations) & (F.col("_pos") > F.col("_n") - horizon))
    held = held.withColumn("step_no", (F.col("_pos") - F.col("_n") + horizon).cast("int")).drop("_pos", "_n")
    starts = held.where(F.col("step_no") == 1).select(*keys, F.col("period").alias("test_start"))
    return held.join(starts, list(keys))


def rows_before(grid: DataFrame, starts: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Grid rows of the listed series strictly before their ``test_start``."""
    return grid.join(starts.select(*keys, "test_start"), list(keys)).where(F.col("period") < F.col("test_start"))


def trim_train(
    train: DataFrame, steps: int | None, keys: Sequence[str] = KEYS, resolution: str = "hourly"
) -> DataFrame:
    """Each series' last ``steps`` grid steps; no limit when it is 0 or None."""
    if not steps:
        return train
    ends = train.groupBy(*keys).agg(F.max("period").alias("_end"))
    cutoff = shift_steps("_end", -(steps - 1), _step(resolution))
    return train.join(ends, list(keys)).where(F.col("period") >= cutoff).drop("_end")


def trainable(config: SeriesModel):
    """Whether a filled grid of ``points`` steps has enough complete feature rows."""
    return (F.col("points") >= config.min_observations) & (F.col("points") - config.reach >= MIN_FEATURE_ROWS)


def eligible_series(
    df: DataFrame, minimum: int, keys: Sequence[str] = KEYS, value: str = "value"
) -> DataFrame:
    """Rows of the series with at least ``minimum`` values."""
    counts = df.groupBy(*keys).agg(F.count(value).alias("_count")).where(F.col("_count") >= minimum)
    return df.join(counts.select(*keys), list(keys), "left_semi")


def future_grid(
    origins: DataFrame,
    horizon: int,
    resolution: str = "hourly",
    keys: Sequence[str] = KEYS,
    issue_time=None,
    origin: str = "origin",
    carry: Sequence[str] = (),
) -> DataFrame:
    """``horizon`` target times after each series' origin, numbered from 1.

    ``issue_time`` is the origin unless another column is given; ``carry`` names
    columns that every step takes along.
    """
    issued = F.col(origin) if issue_time is None else issue_time
    steps = origins.select(
        *keys,
        F.col(origin).alias("_origin"),
        issued.alias("issue_time"),
        F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step_no"),
        *carry,
    )
    target = shift_steps("_origin", F.col("step_no"), _step(resolution))
    return steps.select(*keys, "issue_time", "step_no", target.alias("target_time"), *carry)
