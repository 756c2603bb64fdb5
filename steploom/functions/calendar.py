"""Calendar features of a timestamp."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _wave(value: Column, length: float) -> tuple[Column, Column]:
    angle = value * F.lit(2 * math.pi) / F.lit(length)
    return F.sin(angle), F.cos(angle)


def calendar_columns(time: str, resolution: str) -> dict[str, Column]:
    """Name to expression; Monday counts as day 0."""
    t = F.col(time)
    dow, month = F.weekday(t), F.month(t)
    dow_sin, dow_cos = _wave(dow, 7)
    shared = {
        "dayofweek": dow,
        "month": month,
        "is_weekend": (dow >= 5).cast("int"),
        "dow_sin": dow_sin,
        "dow_cos": dow_cos,
    }
    if resolution == "hourly":
        hour = F.hour(t)
        hour_sin, hour_cos = _wave(hour, 24)
        return {**shared, "hour": hour, "hour_sin": hour_sin, "hour_cos": hour_cos}
    doy = F.dayofyear(t)
    doy_sin, doy_cos = _wave(doy, 365.25)
    month_sin, month_cos = _wave(month, 12)
    return {
        **shared,
        "dayofyear": doy,
        "doy_sin": doy_sin,
        "doy_cos": doy_cos,
        "month_sin": month_sin,
        "month_cos": month_cos,
    }


def calendar_hourly(df: DataFrame, time: str = "period") -> DataFrame:
    return df.withColumns(calendar_columns(time, "hourly"))


def calendar_daily(df: DataFrame, time: str = "period") -> DataFrame:
    return df.withColumns(calendar_columns(time, "daily"))
