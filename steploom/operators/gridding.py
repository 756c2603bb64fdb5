"""Regular time grids and gap filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import KEYS, STEP_SECONDS
from .buckets import WIDTH, bucket_of


def regular_grid(
    df: DataFrame,
    keys: Sequence[str] = KEYS,
    resolution: str = "hourly",
    fill: bool = False,
    trim_tail: bool = False,
    width: int = WIDTH,
) -> DataFrame:
    """One row per step from a series' first to its last period.

    The grid hangs on the series' own first time; rows off it are lost and steps
    without a row get a NULL value.  With ``fill`` holes are interpolated linearly
    and outer ones take the nearest value; a series without any value is then left
    out.  ``trim_tail`` ends the grid at the last value.  Periods must be unique.

    Instead of joining a generated spine, each row spreads over the steps up to the
    next row, so the rows are shuffled once.  What lies outside a row's bucket (next
    row, nearest values) comes from a table with one row per bucket.
    """
    step = STEP_SECONDS[resolution] * 1_000_000
    us = F.unix_micros("period")
    value = F.when(~F.isnan("value"), F.col("value"))
    rows = (
        df.dropna(subset=["period", *keys])
        .select(*keys, "period", value.alias("value"))
        .withColumns({"_us": us, "_bucket": bucket_of("period", step, width), "_phase": F.pmod(us, F.lit(step))})
    )

    seen = F.when(F.col("value").isNotNull(), F.col("_us"))
    edges = rows.groupBy(*keys, "_bucket", "_phase").agg(
        F.min("_us").alias("_first"),
        F.max("_us").alias("_last"),
        F.min(seen).alias("_first_seen"),
        F.min_by("value", seen).alias("_first_value"),
        F.max(seen).alias("_last_seen"),
        F.max_by("value", seen).alias("_last_value"),
    )
    bounds = edges.groupBy(*keys).agg(F.min("_first").alias("_start"), F.max("_last").alias("_stop"))

    series = Window.partitionBy(*keys)
    ordered = series.orderBy("_bucket")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    last_seen = F.max("_last_seen").over(series)
    around = (
        edges.join(bounds, list(keys))
        .where(F.col("_phase") == F.pmod(F.col("_start"), F.lit(step)))
        .select(
            *keys,
            "_bucket",
            "_phase",
            (last_seen if trim_tail else F.col("_stop")).alias("_stop"),
            F.lead("_first").over(ordered).alias("_next_first"),
            F.last("_last_seen", True).over(before).alias("_back_us"),
            F.last("_last_value", True).over(before).alias("_back_value"),
            F.expr("lead(_first_seen) ignore nulls").over(ordered).alias("_ahead_us"),
            F.expr("lead(_first_value) ignore nulls").over(ordered).alias("_ahead_value"),
        )
    )
    if trim_tail:
        around = around.where(F.col("_stop").isNotNull())

    inside = Window.partitionBy(*keys, "_bucket", "_phase").orderBy("_us")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # First step that belongs to the next row, or lies behind the grid's end.
    past_end = F.col("_stop") - F.pmod(F.col("_stop") - F.col("_us"), F.lit(step)) + step
    spread = (
        rows.withColumn("_seen", seen)
        .join(around, [*keys, "_bucket", "_phase"])
        .withColumns(
            {
                "_end": F.least(
                    F.coalesce(F.lead("_us").over(inside), F.col("_next_first"), past_end), past_end
                ),
                "_p_us": F.coalesce(F.last("_seen", True).over(upto), F.col("_back_us")),
                "_p_value": F.coalesce(F.last("value", True).over(upto), F.col("_back_value")),
                "_n_us": F.coalesce(F.expr("lead(_seen) ignore nulls").over(inside), F.col("_ahead_us")),
                "_n_value": F.coalesce(F.expr("lead(value) ignore nulls").over(inside), F.col("_ahead_value")),
            }
        )
        .withColumn("_steps", ((F.col("_end") - F.col("_us")) / step).cast("long"))
        .where(F.col("_steps") > 0)
    )
    # Two levels keep every generated array below the bucket width, however long the hole.
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_steps") - 1) / width)))
    within = F.explode(
        F.sequence(F.col("_chunk") * width, F.least(F.col("_steps"), (F.col("_chunk") + 1) * width) - 1)
    )
    steps = spread.withColumn("_chunk", chunk).withColumn("_i", within)
    at = F.col("_us") + F.col("_i") * step
    own = F.when(F.col("_i") == 0, F.col("value"))
    if fill:
        slope = (F.col("_n_value") - F.col("_p_value")) / ((F.col("_n_us") - F.col("_p_us")) / step)
        between = slope * ((at - F.col("_p_us")) / step) + F.col("_p_value")
        own = F.coalesce(own, between, F.col("_p_value"), F.col("_n_value"))
    out = steps.select(*keys, F.timestamp_micros(at).alias("period"), own.alias("value"))
    return out.dropna(subset=["value"]) if fill else out


def fill_gaps(grid: DataFrame, keys: Sequence[str] = KEYS, resolution: str = "hourly") -> DataFrame:
    """Fill the holes of a regular grid: linear inside, nearest value at the ends."""
    return regular_grid(grid, keys, resolution, fill=True)
