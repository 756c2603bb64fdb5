"""Seasonal naive learner: repeat the last season."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.features import lag_features
from ..operators.splits import future_grid, trim_train
from ..schemas import KEYS, SeriesModel

SEASON = {"hourly": 24, "daily": 7}


def seasonal_naive(df: DataFrame, period: int, keys: Sequence[str] = KEYS, resolution: str = "hourly") -> DataFrame:
    """In-sample forecast of a filled grid: the value one season earlier."""
    lagged = lag_features(df, [period], keys, resolution)
    return lagged.withColumnRenamed(f"lag_{period}", "yhat")


class SeasonalNaive:
    """Baseline; needs one season of history."""

    info_cols = ("train_rows",)
    splits = False

    def season(self, config: SeriesModel) -> int:
        return SEASON[config.resolution]

    def trainable(self, config: SeriesModel):
        return F.col("points") >= self.season(config)

    def forecast(
        self, scaled: DataFrame, profile: DataFrame, horizon: int, config: SeriesModel, keys: Sequence[str] = KEYS
    ) -> tuple[DataFrame, DataFrame]:
        season = self.season(config)
        last = trim_train(scaled, season, keys, config.resolution)
        # Steps from the row's time to the end of the history give its place in the season.
        back = ((F.unix_micros("origin") - F.unix_micros("period")) / config.step_us).cast("int")
        place = last.join(profile.select(*keys, "origin"), list(keys)).select(
            *keys, (season - back).alias("_place"), F.col("value").alias("z")
        )
        ahead = future_grid(profile, horizon, config.resolution, keys).withColumn(
            "_place", F.pmod(F.col("step_no") - 1, F.lit(season)) + 1
        )
        info = profile.select(*keys, F.col("points").cast("double").alias("train_rows"))
        return ahead.join(place, [*keys, "_place"]).select(*keys, "step_no", "z"), info
