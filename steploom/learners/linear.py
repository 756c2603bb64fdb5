"""Linear learner: one ridge regression per series on the feature rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.features import features_of
from ..operators.splits import trainable
from ..schemas import KEYS, SeriesModel
from .base import tails
from .gram import cross_products, solve, unpack
from .recursion import recursive_forecast

# Centre and width that bring calendar columns to the size of the scaled values.
CALENDAR_SCALE = {"hour": (11.5, 7.0), "dayofweek": (3.0, 2.0), "month": (6.5, 3.5), "dayofyear": (183.0, 105.0)}


def _centre(name: str) -> tuple[float, float]:
    return CALENDAR_SCALE.get(name, (0.0, 1.0))


class LinearLearner:
    """Least squares from distributed cross products; the only rows that reach Python
    are feature rows to be multiplied and one model row per series."""

    info_cols = ("train_rows", "n_features")
    splits = True

    def trainable(self, config: SeriesModel) -> Column:
        return trainable(config)

    def fit(self, features: DataFrame, config: SeriesModel, keys: Sequence[str] = KEYS) -> DataFrame:
        """Model table ``keys, train_rows, coef``; the intercept comes first."""
        keys, names, ridge = list(keys), config.feature_cols, config.ridge
        design = features.select(
            *keys, *[((F.col(c) - _centre(c)[0]) / _centre(c)[1]).alias(c) for c in names], "y"
        )
        products = cross_products(design, keys, [*names, "y"])
        size = len(names) + 2

        def solve_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if batch.empty:
                    continue
                full = unpack(np.stack(batch["products"].to_numpy()), size)
                out = batch[[*keys, "rows"]].rename(columns={"rows": "train_rows"})
                out["coef"] = list(solve(full[:, :-1, :-1], full[:, :-1, -1], ridge))
                yield out

        schema = T.StructType(
            [features.schema[k] for k in keys]
            + [T.StructField("train_rows", T.LongType()), T.StructField("coef", T.ArrayType(T.DoubleType()))]
        )
        return products.mapInPandas(solve_all, schema)

    def predict(
        self, features: DataFrame, model: DataFrame, config: SeriesModel, keys: Sequence[str] = KEYS
    ) -> DataFrame:
        """Feature rows with their prediction ``z``, computed in the JVM."""
        z = F.element_at("coef", 1)
        for i, c in enumerate(config.feature_cols, start=2):
            z = z + F.element_at("coef", i) * ((F.col(c) - _centre(c)[0]) / _centre(c)[1])
        return features.join(model.select(*keys, "coef"), list(keys)).withColumn("z", z).drop("coef")

    def forecast(
        self, scaled: DataFrame, profile: DataFrame, horizon: int, config: SeriesModel, keys: Sequence[str] = KEYS
    ) -> tuple[DataFrame, DataFrame]:
        model = self.fit(features_of(scaled, config, keys), config, keys)
        centre = np.array([_centre(c)[0] for c in config.feature_cols])
        width = np.array([_centre(c)[1] for c in config.feature_cols])

        def step(batch: pd.DataFrame, x: np.ndarray) -> np.ndarray:
            coef = np.stack(batch["coef"].to_numpy())
            return coef[:, 0] + (coef[:, 1:] * ((x - centre) / width)).sum(axis=1)

        states = tails(scaled, config.reach, config, keys).join(model.select(*keys, "coef"), list(keys))
        info = model.select(
            *keys,
            F.col("train_rows").cast("double").alias("train_rows"),
            F.lit(float(len(config.feature_cols))).alias("n_features"),
        )
        return recursive_forecast(states, horizon, config, step, keys), info
