"""Forecast error measures as mergeable sums.

One partial aggregation per key feeds both the per-series and the pooled result,
so the joined rows are read and shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SUMS = ("n", "abs_sum", "sq_sum", "ape_sum", "ape_n", "sape_sum", "sape_n")


def error_sums(joined: DataFrame, keys: Sequence[str], actual: str = "value", forecast: str = "yhat") -> DataFrame:
    """Per key group (NULL keys included): row count and sums of the error terms."""
    y, p = F.col(actual), F.col(forecast)
    gap = F.abs(y - p)
    middle = (F.abs(y) + F.abs(p)) / 2
    return joined.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(gap).alias("abs_sum"),
        F.sum(gap * gap).alias("sq_sum"),
        F.sum(F.when(y != 0, gap / F.abs(y))).alias("ape_sum"),
        F.count(F.when(y != 0, 1)).alias("ape_n"),
        F.sum(F.when(middle != 0, gap / middle)).alias("sape_sum"),
        F.count(F.when(middle != 0, 1)).alias("sape_n"),
    )


def _percent(total: str, count: str, empty: float | None) -> Column:
    ratio = F.when(F.col(count) > 0, F.col(total) / F.col(count) * 100)
    return ratio if empty is None else F.coalesce(ratio, F.lit(empty))


def measures(empty: float | None = 0.0) -> list[Column]:
    """Final columns from the sums.

    ``empty`` is the percentage error when no row has a usable denominator:
    0 when scoring forecasts, NULL when ranking parameter combinations.
    """
    return [
        (F.col("abs_sum") / F.col("n")).alias("mae"),
        F.sqrt(F.col("sq_sum") / F.col("n")).alias("rmse"),
        _percent("ape_sum", "ape_n", empty).alias("mape"),
        _percent("sape_sum", "sape_n", empty).alias("smape"),
        F.col("n"),
    ]


def by_series(sums: DataFrame, keys: Sequence[str], empty: float | None = 0.0) -> DataFrame:
    """Measures per series; groups with a NULL key belong to no series."""
    return sums.dropna(subset=list(keys)).select(*keys, *measures(empty))


def summed(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Error sums of coarser groups from those of finer ones."""
    return sums.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _SUMS])


def overall(sums: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Measures pooled over all rows; no rows give no result row."""
    pooled = sums.groupBy(*keys) if keys else sums.groupBy()
    return pooled.agg(*[F.sum(c).alias(c) for c in _SUMS]).where(F.col("n") > 0).select(*keys, *measures())
