"""Scores of saved forecasts that are kept up to date as actuals arrive."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.errors import by_series, error_sums, overall, summed
from ..operators.evaluate import join_actual_forecast
from ..schemas import KEYS
from ..session import materialize, run_folder
from ..sources.tables import read_series, write_table


def _days_of(df: DataFrame, time: str, days: Sequence) -> DataFrame:
    """Rows of some days; their range reaches the scan as a plain filter on the time."""
    ends = F.lit(days[0]).cast("timestamp"), F.lit(days[-1] + timedelta(days=1)).cast("timestamp")
    within = (F.col(time) >= ends[0]) & (F.col(time) < ends[1])
    return df.where(within & F.to_date(time).isin(list(days)))


def update_scores(arrived: DataFrame, actual: DataFrame, forecast: DataFrame, path: str, keys: Sequence[str] = KEYS) -> list:
    """Bring the error sums at ``path`` up to date with newly arrived or revised actuals; returns the days that were joined.

    ``path`` holds mergeable error sums per series, forecast run and day.  Only the days that ``arrived``
    has rows of are joined again, from all actuals and forecasts of those days, and put in place of their
    old sums; so revisions count once and a repeated arrival changes nothing.  The
    list of days is short: it grows with the time that an arrival covers, not with its rows.
    Days on which nothing can be paired any more keep no sums.  NULL keys are kept for the pooled measures.
    """
    keys = list(keys)
    found = arrived.agg(F.collect_set(F.to_date("period")).alias("days")).first().days
    days = sorted(found)
    if not days:
        return days
    with run_folder(arrived.sparkSession):
        joined = join_actual_forecast(_days_of(actual, "period", days), _days_of(forecast, "target_time", days), keys)
        sums = error_sums(joined.withColumn("day", F.date_format("period", "yyyy-MM-dd")), [*keys, "issue_time", "day"])
        fresh = materialize(sums, "sums")
        # A day without pairs is written as one row without errors, so that its old sums go.
        present = arrived.sparkSession.createDataFrame([(d.isoformat(),) for d in days], "day string")
        missing = present.join(fresh.select("day").distinct(), "day", "left_anti")
        blank = missing.select(*[F.col("day") if f.name == "day" else _nothing(f) for f in fresh.schema.fields])
        write_table(fresh.unionByName(blank), path, ["day"])
    return days


def _nothing(field) -> Column:
    return (F.lit(0) if field.name in ("n", "ape_n", "sape_n") else F.lit(None)).cast(field.dataType).alias(field.name)


def kept_scores(spark: SparkSession, path: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Measures per series from the sums at ``path``, over all runs and days."""
    return by_series(summed(read_series(spark, path, required=True).where("n > 0"), keys), keys)


def kept_overall(spark: SparkSession, path: str) -> DataFrame:
    """The measures pooled over everything at ``path``."""
    return overall(read_series(spark, path, required=True).where("n > 0"))
