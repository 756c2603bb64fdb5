"""Column expressions for parsing, cleaning and naming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

PERIOD_FORMATS = {"hourly": "yyyy-MM-dd'T'HH", "daily": "yyyy-MM-dd"}


def not_nan(col: Column) -> Column:
    """NaN becomes NULL, so sums and averages skip it."""
    return F.when(~F.isnan(col), col)


def parse_period(col: Column | str, resolution: str) -> Column:
    """Text in the declared format of the resolution to a timestamp, else NULL."""
    return F.try_to_timestamp(col, F.lit(PERIOD_FORMATS[resolution]))


def coerce_numeric(col: Column | str) -> Column:
    """Text to double; what is no number becomes NULL, infinities stay.

    The cast itself would also take Java literals such as ``1.5d``.
    """
    text = F.trim(col)
    return not_nan(F.when(~text.rlike("[0-9.][dDfF]$"), text.try_cast("double")))


def as_double(df: DataFrame, name: str) -> Column:
    """Numeric column of ``df``, parsed when it is text, NaN as NULL."""
    if isinstance(df.schema[name].dataType, StringType):
        return coerce_numeric(F.col(name))
    return not_nan(F.col(name).cast("double"))


def as_time(df: DataFrame, name: str, resolution: str = "hourly") -> Column:
    """Timestamp column of ``df``, parsed in the resolution's format when it is text."""
    if isinstance(df.schema[name].dataType, StringType):
        return parse_period(F.col(name), resolution)
    return F.col(name).cast("timestamp")


def series_name(region: Column | str) -> Column:
    return F.concat(F.col(region) if isinstance(region, str) else region, F.lit(" total"))


def iso(col: Column | str) -> Column:
    """ISO-8601 text of a UTC timestamp, with microseconds where there are any."""
    whole = F.unix_micros(F.col(col).cast("timestamp") if isinstance(col, str) else col.cast("timestamp")) % 1_000_000 == 0
    return F.when(whole, F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")).otherwise(
        F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    )


def finite(col: Column) -> Column:
    """NaN and the infinities become NULL, which JSON can hold."""
    return F.when(~F.isnan(col) & (F.abs(col) != float("inf")), col)


def shift_steps(time: Column | str, steps: Column | int, step_us: int) -> Column:
    """``time`` moved by a number of fixed-length steps."""
    offset = (F.lit(steps) if isinstance(steps, int) else steps).cast("long") * F.lit(step_us)
    return F.timestamp_micros(F.unix_micros(time) + offset)
