"""Multi-step forecasts that feed on their own earlier steps.

One row per series goes in (its tail and, where models differ by series, its
coefficients); steps advance for all series of an Arrow batch together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import SeriesModel

Predict = Callable[[pd.DataFrame, np.ndarray], np.ndarray]


def _calendar(times: np.ndarray, config: SeriesModel) -> dict[str, np.ndarray]:
    at = pd.DatetimeIndex(times)
    wave = lambda v, n: (np.sin(2 * np.pi * v / n), np.cos(2 * np.pi * v / n))
    hour, dow, doy, month = (np.asarray(v, dtype=float) for v in (at.hour, at.dayofweek, at.dayofyear, at.month))
    out = {"hour": hour, "dayofweek": dow, "dayofyear": doy, "month": month, "is_weekend": (dow >= 5).astype(float)}
    for name, value, length in (("hour", hour, 24), ("dow", dow, 7), ("doy", doy, 365.25), ("month", month, 12)):
        out[f"{name}_sin"], out[f"{name}_cos"] = wave(value, length)
    return out


def advance_paths(batch: pd.DataFrame, horizon: int, config: SeriesModel, predict: Predict, keys: Sequence[str]) -> pd.DataFrame:
    """Paths ``z`` (arrays) of the series in a batch of states, one step of all of them after the other."""
    reach, step = config.reach, np.timedelta64(config.step_us, "us")
    seen = np.full((len(batch), reach + horizon), np.nan)
    for row, tail in enumerate(batch["value"]):
        tail = np.asarray(tail, dtype=float)[-reach:]
        seen[row, reach - len(tail) : reach] = tail
    origin = batch["origin"].to_numpy(dtype="datetime64[us]")
    for i in range(horizon):
        now = reach + i
        calendar = _calendar(origin + step * (i + 1), config) if config.calendar else {}
        x = np.column_stack(
            [calendar[c] for c in config.columns["calendar"]]
            + [seen[:, now - k] for k in config.lags]
            + [seen[:, now - w : now].mean(axis=1) for w in config.roll_windows]
        )
        seen[:, now] = predict(batch, x)
    out = batch[list(keys)].copy()
    out["z"] = list(seen[:, reach:])
    return out


def path_schema(states: DataFrame, keys: Sequence[str]) -> T.StructType:
    return T.StructType([states.schema[k] for k in keys] + [T.StructField("z", T.ArrayType(T.DoubleType()))])


def unfold_paths(paths: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row ``keys, step_no, z`` for each step of the paths."""
    steps = paths.select(*keys, F.posexplode("z").alias("_i", "z"))
    return steps.select(*keys, (F.col("_i") + 1).alias("step_no"), "z")


def recursive_forecast(
    states: DataFrame, horizon: int, config: SeriesModel, predict: Predict, keys: Sequence[str]
) -> DataFrame:
    """Predictions ``keys, step_no, z`` from ``keys, origin, value`` (tail array) states.

    ``predict`` gets the batch and its feature rows in ``config.feature_cols`` order.
    """
    keys = list(keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not batch.empty:
                yield advance_paths(batch, horizon, config, predict, keys)

    return unfold_paths(states.mapInPandas(run, path_schema(states, keys)), keys)
