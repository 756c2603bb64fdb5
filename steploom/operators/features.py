"""Lag, rolling and calendar features on a regular grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import calendar_columns
from ..schemas import KEYS, STEP_SECONDS, SeriesModel
from .buckets import WIDTH, bucket_window, with_halo
from .gridding import regular_grid


def _lags(value: str, lags: Sequence[int], window) -> dict[str, Column]:
    return {f"lag_{k}": F.lag(value, k).over(window) for k in lags}


def _short_sum(value: str, width: int, window) -> Column:
    """Sum of the ``width`` rows before the current one, NULL unless all are finite."""
    frame = window.rowsBetween(-width, -1)
    finite = F.when(~F.isnan(value) & (F.abs(value) != float("inf")), F.col(value))
    return F.when(F.count(finite).over(frame) == width, F.sum(finite).over(frame))


def _rolling(value: str, widths: Sequence[int], window, short: str, base: int) -> dict[str, Column]:
    """Means over ``widths`` rows, longer ones put together from lagged short sums.

    A frame of 168 rows is added up anew for each row; seven lagged sums of 24 are not.
    """
    out = {}
    for w in widths:
        blocks, rest = divmod(w, base)
        parts = [F.lag(short, base * j).over(window) for j in range(blocks)]
        parts += [F.lag(value, base * blocks + i).over(window) for i in range(1, rest + 1)]
        total = parts[0]
        for part in parts[1:]:
            total = total + part
        out[f"rollmean_{w}"] = total / w
    return out


def lookback_features(
    df: DataFrame,
    lags: Sequence[int],
    roll_windows: Sequence[int],
    keys: Sequence[str] = KEYS,
    resolution: str = "hourly",
    value: str = "value",
    width: int = WIDTH,
) -> DataFrame:
    """Lags and trailing means of a regular grid in one shuffle and one sort.

    A mean covers the ``w`` rows before the current one and is NULL unless all of
    them are there.
    """
    step = STEP_SECONDS[resolution] * 1_000_000
    halo = max((*lags, *roll_windows, 0))
    window = bucket_window(keys)
    rows = with_halo(df, step, halo, width=max(width, halo))
    columns = _lags(value, lags, window)
    if roll_windows:
        base = min(roll_windows)
        rows = rows.withColumn("_short", _short_sum(value, base, window))
        columns |= _rolling(value, roll_windows, window, "_short", base)
    return rows.withColumns(columns).where("_own").drop("_own", "_bucket", "_short")


def lag_features(df: DataFrame, lags: Sequence[int], keys: Sequence[str] = KEYS, resolution: str = "hourly", **kw):
    return lookback_features(df, lags, (), keys, resolution, **kw)


def rolling_mean(df: DataFrame, widths: Sequence[int], keys: Sequence[str] = KEYS, resolution: str = "hourly", **kw):
    return lookback_features(df, (), widths, keys, resolution, **kw)


def features_of(filled: DataFrame, config: SeriesModel, keys: Sequence[str] = KEYS) -> DataFrame:
    """Complete feature rows of a filled grid; the target column is ``y``."""
    wide = lookback_features(filled, config.lags, config.roll_windows, keys, config.resolution)
    complete = wide.dropna(subset=["value", *config.columns["lag"], *config.columns["roll"]])
    calendar = calendar_columns("period", config.resolution)
    return complete.select(
        *keys,
        "period",
        F.col("value").alias("y"),
        *[calendar[c].alias(c) for c in config.columns["calendar"]],
        *config.columns["lag"],
        *config.columns["roll"],
    )


def feature_matrix(df: DataFrame, config: SeriesModel, keys: Sequence[str] = KEYS) -> DataFrame:
    """Actuals to feature rows: grid, gap fill, calendar, lags, rolling means."""
    return features_of(regular_grid(df, keys, config.resolution, fill=True), config, keys)
