"""Splitting long series into bounded runs of steps.

A window over a whole series puts that series into one task.  Here each series is
cut into time buckets of ``WIDTH`` steps and windows run per (series, bucket); what
a row needs from outside its bucket comes either as a halo of copied rows or from a
small table with one row per bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 4096


def bucket_of(time: Column | str, step_us: int, width: int = WIDTH) -> Column:
    """Number of the bucket a time falls into, counted from the epoch."""
    us = F.unix_micros(time)
    span = F.lit(step_us * width)
    return ((us - F.pmod(us, span)) / span).cast("long")


def with_halo(
    df: DataFrame, step_us: int, halo: int, time: str = "period", width: int = WIDTH
) -> DataFrame:
    """Give each bucket a copy of the last ``halo`` steps before it.

    Adds ``_bucket`` and ``_own`` (false for copies).  Needs a regular grid, where
    step distance equals row distance.
    """
    if halo > width:
        raise ValueError("a bucket must be at least as long as its halo")
    home = bucket_of(time, step_us, width)
    place = F.pmod(F.unix_micros(time), F.lit(step_us * width))
    late = place >= (width - halo) * step_us
    both = F.when(late, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    copies = df.withColumn("_copy", F.explode(both)) if halo else df.withColumn("_copy", F.lit(0))
    return copies.select(
        *df.columns, (home + F.col("_copy")).alias("_bucket"), (F.col("_copy") == 0).alias("_own")
    )


def bucket_window(keys: Sequence[str], time: str = "period"):
    return Window.partitionBy(*keys, "_bucket").orderBy(time)


def positions(
    df: DataFrame, keys: Sequence[str], step_us: int, time: str = "period", width: int = WIDTH
) -> DataFrame:
    """1-based row number ``_pos`` in time order and row count ``_n`` of each series.

    Ranks within a bucket plus the number of rows in earlier buckets; only the
    per-bucket counts are ever ordered over a whole series.
    """
    rows = df.withColumn("_bucket", bucket_of(time, step_us, width))
    counts = rows.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_count"))
    series = Window.partitionBy(*keys)
    earlier = series.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *keys,
        "_bucket",
        F.coalesce(F.sum("_count").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_count").over(series).alias("_n"),
    )
    rank = F.row_number().over(bucket_window(keys, time))
    return (
        rows.join(offsets, [*keys, "_bucket"])
        .withColumn("_pos", F.col("_before") + rank)
        .drop("_bucket", "_before")
    )


def grid_positions(df: DataFrame, keys: Sequence[str], step_us: int, time: str = "period") -> DataFrame:
    """``positions`` of series without holes: a row's number follows from its time and the series' first one.

    One small table with two times per series, combined before it is shuffled, instead of ranks.
    """
    at = F.unix_micros(time)
    ends = df.groupBy(*keys).agg(F.min(at).alias("_first"), F.max(at).alias("_last"))
    steps = lambda a, b: F.call_function("div", a - b, F.lit(step_us)) + 1
    placed = df.join(ends, list(keys))
    return placed.withColumns({"_pos": steps(at, F.col("_first")), "_n": steps(F.col("_last"), F.col("_first"))}).drop("_first", "_last")
