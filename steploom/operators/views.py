"""Result tables and chart frames read by a service or dashboard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, TimestampNTZType, TimestampType

from ..functions.columns import as_double, iso, finite
from ..schemas import KEYS, window


def prepare_actuals(df: DataFrame) -> DataFrame:
    """Typed actuals without rows that miss a time or value."""
    return df.withColumns({"period": F.col("period").try_cast("timestamp"), "value": as_double(df, "value")}).dropna(
        subset=["period", "value"]
    )


def prepare_forecasts(df: DataFrame) -> DataFrame:
    """Typed forecasts without rows that miss a time or value."""
    return df.withColumns(
        {
            "issue_time": F.col("issue_time").try_cast("timestamp"),
            "target_time": F.col("target_time").try_cast("timestamp"),
            "yhat": as_double(df, "yhat"),
        }
    ).dropna(subset=["issue_time", "target_time", "yhat"])


def spellings(names: DataFrame, region: str) -> list[str]:
    """How a small table of regions writes a name; spellings differ in case only, so there are few."""
    return sorted(r.region for r in names.where(F.upper("region") == region.upper()).select("region").distinct().collect())


def filter_region(df: DataFrame, region: str | None, names: DataFrame | None = None) -> DataFrame:
    """Rows of one region, whatever the case of its name; all rows for None.

    ``names``: a side table with every region of ``df``.  With it the filter is one on plain
    values, which reaches the scan and skips row groups without the region.
    """
    if region is None:
        return df
    return df.where(F.upper("region") == region.upper() if names is None else F.col("region").isin(spellings(names, region)))


def latest_issue(df: DataFrame) -> DataFrame:
    """Rows of the newest forecast run in the given rows."""
    return df.where(F.col("issue_time") == df.agg(F.max("issue_time")).scalar())


def to_records(df: DataFrame, columns: Sequence[str] | None = None, extra: Sequence[str] = ()) -> DataFrame:
    """One JSON text per row: ISO-8601 times, NaN and infinities as null; ``extra`` columns stand beside it."""
    fields = []
    for f in (df if columns is None else df.select(*columns)).schema.fields:
        if isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            fields.append(iso(f.name).alias(f.name))
        elif isinstance(f.dataType, (DoubleType, FloatType)):
            fields.append(finite(F.col(f.name)).alias(f.name))
        else:
            fields.append(F.col(f.name))
    record = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return df.select(*extra, record.alias("record"))


def dataset_profile(df: DataFrame) -> DataFrame:
    """Row count, period range and the sorted regions; the set grows with regions only."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("period").alias("first_period"),
        F.max("period").alias("last_period"),
        F.array_sort(F.collect_set("region")).alias("regions"),
    )


def freshness(df: DataFrame, now: Column) -> DataFrame:
    """How old the newest actual is, and what that means."""
    newest = df.agg(F.max("period").alias("latest_actual"))
    age = (F.unix_micros(now) - F.unix_micros("latest_actual")) / 3_600_000_000
    status = (
        F.when(F.col("latest_actual").isNull(), "Missing")
        .when(F.col("age_hours") <= 3, "Fresh")
        .when(F.col("age_hours") <= 30, "Delayed")
        .otherwise("Stale")
    )
    return newest.withColumn("age_hours", age).withColumn("status", status)


def forecast_span(df: DataFrame) -> DataFrame:
    """Newest run, newest target and the whole hours between them."""
    ends = df.agg(F.max("issue_time").alias("latest_issue"), F.max("target_time").alias("latest_target"))
    return ends.withColumn("horizon_hours", _whole_hours("latest_issue", "latest_target"))


def backtest_bounds(df: DataFrame, region: str) -> DataFrame:
    """First and last target of a region and the hours they cover, both included."""
    ends = df.where(F.col("region") == region).agg(
        F.min("target_time").alias("first_target"), F.max("target_time").alias("last_target")
    )
    return ends.withColumn("hours", _whole_hours("first_target", "last_target") + 1)


def _whole_hours(start: str, end: str) -> Column:
    return F.timestamp_diff("HOUR", F.col(start), F.col(end))


def preview(df: DataFrame, time: str, k: int = 50, newest: bool = False, keys: Sequence[str] = KEYS) -> DataFrame:
    """The ``k`` newest or earliest rows, ties by key."""
    first = F.col(time).desc_nulls_last() if newest else F.col(time).asc_nulls_last()
    return df.orderBy(first, *keys).limit(k)


def region_list(actuals: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Sorted regions found in either table."""
    return actuals.select("region").distinct().union(forecasts.select("region").distinct()).distinct().orderBy("region")


def serve_forecast(forecasts: DataFrame, key: str, region: str | None = None, names: DataFrame | None = None) -> DataFrame:
    """Newest run of a window for one or all regions, as records with run and count.

    ``forecasts`` is partitioned by ``window``; an unknown window is an error and no
    rows mean "not found".  The region filter comes before the newest run is chosen; ``names`` is the
    side table of ``filter_region``, as ``write_windows`` stores it.
    """
    known = window(key)
    rows = filter_region(forecasts.where(F.col("window") == known.key), region, names)
    run = latest_issue(rows)
    count = run.agg(F.count(F.lit(1)))
    body = to_records(run, [*KEYS, "issue_time", "target_time", "yhat"], extra=["window", "issue_time"])
    return body.select(
        "window", F.lit(known.resolution).alias("resolution"), "issue_time", count.scalar().alias("count"), "record"
    )


def serve_metrics(metrics: DataFrame, key: str) -> DataFrame:
    """Per-series backtest metrics of a window, as records."""
    known = window(key)
    rows = metrics.where(F.col("window") == known.key)
    return to_records(rows, [c for c in metrics.columns if c != "window"], extra=["window"])


def _chart(df: DataFrame, time: str, value: str, kind: str) -> DataFrame:
    return df.select(F.col(time).alias("time"), F.col(value).alias("mw"), F.lit(kind).alias("type"))


def actual_forecast_frame(actuals: DataFrame, forecasts: DataFrame, region: str, history_days: int) -> DataFrame:
    """A region's last days of actuals followed by its forecast."""
    seen = actuals.where(F.col("region") == region)
    cutoff = seen.agg(F.max("period") - F.make_dt_interval(days=F.lit(history_days)))
    recent = seen.where(F.col("period") >= cutoff.scalar())
    ahead = forecasts.where(F.col("region") == region)
    both = _chart(recent, "period", "value", "actual").unionByName(_chart(ahead, "target_time", "yhat", "forecast"))
    return both.orderBy("time", "type")


def backtest_overlay(actuals: DataFrame, backtest: DataFrame, region: str, pre_days: int = 7) -> DataFrame:
    """A region's backtest over its actuals, with some days of history before it.

    Without backtest rows the cutoff is NULL and the frame is empty.
    """
    ahead = backtest.where(F.col("region") == region)
    cutoff = ahead.agg(F.min("target_time") - F.make_dt_interval(days=F.lit(pre_days)))
    recent = actuals.where((F.col("region") == region) & (F.col("period") >= cutoff.scalar()))
    both = _chart(recent, "period", "value", "actual").unionByName(
        _chart(ahead, "target_time", "yhat", "backtest forecast")
    )
    return both.orderBy("time", "type")


def best_config_frame(grid: DataFrame, backtest: DataFrame, regions: int = 4, history_days: int = 7) -> DataFrame:
    """First regions by name: history, held-out actuals and their forecast, tagged.

    Each region is shown by its first series; ``backtest`` has the holdout forecasts,
    and a region without any adds no rows.
    """
    first = grid.groupBy("region").agg(F.min("series").alias("series")).orderBy("region").limit(regions)
    # At most ``regions`` rows, safe to broadcast.
    chosen = backtest.join(F.broadcast(first), ["region", "series"], "left_semi")
    starts = chosen.groupBy("region", "series").agg(F.min("target_time").alias("test_start"))
    since = F.col("test_start") - F.make_dt_interval(days=F.lit(history_days)) - F.make_dt_interval(hours=F.lit(1))
    actual = grid.join(starts, ["region", "series"]).where(F.col("period") >= since)
    tag = F.when(F.col("period") < F.col("test_start"), "history").otherwise("holdout actual")
    seen = actual.select("region", "series", F.col("period").alias("time"), F.col("value").alias("mw"), tag.alias("type"))
    ahead = chosen.select(
        "region", "series", F.col("target_time").alias("time"), F.col("yhat").alias("mw"), F.lit("forecast").alias("type")
    )
    return seen.unionByName(ahead).orderBy("region", "time", "type")


def region_metrics(metrics: DataFrame, region: str) -> DataFrame:
    """Metric columns of one region."""
    return metrics.where(F.col("region") == region).select("region", "series", "n", "mae", "rmse", "mape", "smape")
