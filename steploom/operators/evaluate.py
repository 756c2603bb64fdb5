"""Joining forecasts with actuals, scoring and ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import not_nan
from ..functions.errors import by_series, error_sums, overall
from ..schemas import KEYS, TreeSettings


def join_actual_forecast(actual: DataFrame, forecast: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Pair actuals and forecasts on keys and time; NULL keys match each other.

    Rows without either value are dropped before the join, which gives the same
    pairs and shuffles less.  Doubled rows fan out.
    """
    left = actual.withColumn("value", not_nan(F.col("value").cast("double"))).dropna(subset=["value"])
    right = forecast.withColumn("yhat", not_nan(F.col("yhat").cast("double"))).dropna(subset=["yhat"])
    right = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    match = F.col("period").eqNullSafe(F.col("target_time"))
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_{k}"))
    shared = [c for c in left.columns if c in right.columns]
    right = right.drop(*shared)
    return left.join(right, match).drop(*[f"_{k}" for k in keys])


def forecast_metrics(joined: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """mae, rmse, mape, smape and n per series."""
    return by_series(error_sums(joined, keys), keys)


def overall_metrics(joined: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The same measures pooled over all joined rows, not averaged over series."""
    return overall(error_sums(joined, keys))


def attach_info(metrics: DataFrame, info: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Training information next to the metrics of each series."""
    return metrics.join(info, list(keys), "left")


def mean_info(metrics: DataFrame, columns: Sequence[str] = ("aic", "bic")) -> DataFrame:
    """Means over series of the information criteria, missing ones ignored."""
    return metrics.agg(*[F.avg(not_nan(F.col(c))).alias(f"{c}_mean_by_series") for c in columns])


def combo_scores(
    scores: DataFrame, combo: Sequence[str], measures: Sequence[str] = ("mape",)
) -> DataFrame:
    """Mean scores per parameter combination over its series, missing ones ignored."""
    return scores.groupBy(*combo).agg(
        *[F.avg(not_nan(F.col(m))).alias(m) for m in measures], F.count(F.lit(1)).alias("n_series")
    )


def best_combo(
    results: DataFrame, by: Sequence[str] = ("window",), score: str = "mape", tie: str = "combo_id"
) -> DataFrame:
    """The combination with the lowest score per group, unscored ones last."""
    rest = [c for c in results.columns if c not in by]
    order = F.struct(F.col(score).isNull() | F.isnan(score), F.col(score), F.col(tie))
    best = results.groupBy(*by).agg(F.min_by(F.struct(*rest), order).alias("_best"))
    return best.select(*by, *[F.col("_best")[c].alias(c) for c in rest])


def top_combos(results: DataFrame, k: int = 15, score: str = "mape", tie: str = "combo_id") -> DataFrame:
    """The first ``k`` combinations by score."""
    return results.orderBy(F.col(score).asc_nulls_last(), F.col(tie)).limit(k)


def top_groups(joined: DataFrame, k: int = 6, keys: Sequence[str] = KEYS) -> DataFrame:
    """All rows of the ``k`` series with most joined rows, in time order."""
    biggest = joined.groupBy(*keys).count().orderBy(F.desc("count"), *keys).limit(k)
    # At most k rows, so broadcasting them is safe whatever the table size.
    return joined.join(F.broadcast(biggest.select(*keys)), list(keys), "left_semi").orderBy(*keys, "period")


def rank_by_error(metrics: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Series from the worst to the best percentage error."""
    return metrics.orderBy(F.col("mape").desc_nulls_last(), *keys)


def params_or_default(windows: DataFrame, best: DataFrame) -> DataFrame:
    """Hyperparameters per window: tuned ones where stored, else the defaults."""
    tuned = best.select(F.col("window").alias("key"), "params")
    names = ("n_estimators", "max_depth", "learning_rate", "subsample", "colsample_bytree", "min_child_weight")
    base = TreeSettings()
    joined = windows.join(tuned, "key", "left")
    return joined.select(
        "key",
        "resolution",
        *[F.coalesce(F.col("params")[n], F.lit(getattr(base, n))).alias(n) for n in names],
        F.col("params").isNotNull().alias("tuned"),
    )
