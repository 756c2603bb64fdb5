"""Given tables seen as readings and actuals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.errors import by_series, error_sums
from ..learners.seasonal import seasonal_naive
from ..operators.evaluate import join_actual_forecast
from ..operators.features import lag_features
from ..operators.gridding import regular_grid
from ..operators.ingest import region_total
from ..schemas import KEYS
from ..session import materialize

#: Allow-lists for the queries whose feature they are, and every region for all others.
HOURLY_REGIONS = ("CLICK", "ERROR", "PURCHASE", "SIGNUP")
DAILY_REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE")
EVERY_HOURLY_REGION = (*HOURLY_REGIONS, "VIEW")
EVERY_DAILY_REGION = (*DAILY_REGIONS, "MIDDLE EAST")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hourly_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as typed hourly readings of a user within an event type."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("parent"),
        F.col("user_id").cast("string").alias("subba"),
        F.date_trunc("hour", "ts").alias("period"),
        "value",
        "event_id",
    )


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as text, the way pages deliver readings."""
    return hourly_readings(spark, sf_dir).select(
        "parent",
        "subba",
        F.date_format("period", "yyyy-MM-dd'T'HH").alias("period"),
        F.col("value").cast("string").alias("value"),
        F.lit(None).cast("string").alias("timezone"),
        "event_id",
    )


def daily_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as daily readings of a nation within a region."""
    nations = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "n_name", "r_name")
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("r_name").alias("parent"),
            F.col("n_name").alias("subba"),
            F.col("o_orderdate").cast("timestamp").alias("period"),
            F.col("o_totalprice").alias("value"),
            F.col("o_orderkey").alias("order_id"),
        )
    )


def hourly_actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return region_total(hourly_readings(spark, sf_dir), EVERY_HOURLY_REGION)


def daily_actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return region_total(daily_readings(spark, sf_dir), EVERY_DAILY_REGION, "daily")


def actuals(spark: SparkSession, sf_dir: str, resolution: str = "hourly") -> DataFrame:
    """The stored actuals table that later steps start from, built from the readings.

    Totals are kept in cents, so engines that add in another order store the same.
    """
    build = hourly_actuals if resolution == "hourly" else daily_actuals
    totals = build(spark, sf_dir).withColumn("value", F.round("value", 2))
    return materialize(totals, f"actuals-{resolution}")


def forecasts(spark: SparkSession, sf_dir: str, resolution: str = "hourly", seen: DataFrame | None = None) -> DataFrame:
    """Seasonal forecasts of every step, issued at midnight or at the start of the month.

    ``seen``: the actuals, where the caller has them already.
    """
    season, issue = (24, "day") if resolution == "hourly" else (7, "month")
    seen = actuals(spark, sf_dir, resolution) if seen is None else seen
    filled = regular_grid(seen, resolution=resolution, fill=True)
    rows = seasonal_naive(filled, season, resolution=resolution).where(F.col("yhat").isNotNull())
    return rows.select(
        *KEYS, F.date_trunc(issue, "period").alias("issue_time"), F.col("period").alias("target_time"), "yhat"
    )


def season_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error of several season lengths per window and series, as parameter scores."""
    parts = []
    for key, resolution, seasons in (("7d", "hourly", (24, 48, 72, 168)), ("3mo", "daily", (7, 14, 28, 364))):
        seen = actuals(spark, sf_dir, resolution)
        lagged = lag_features(regular_grid(seen, resolution=resolution, fill=True), seasons, resolution=resolution)
        options = F.array(
            *[F.struct(F.lit(i).alias("combo_id"), F.col(f"lag_{s}").alias("yhat")) for i, s in enumerate(seasons)]
        )
        tried = lagged.select(*KEYS, F.col("period").alias("target_time"), F.inline(options))
        joined = join_actual_forecast(seen, tried)
        scored = by_series(error_sums(joined, ["combo_id", *KEYS]), ["combo_id", *KEYS], empty=None)
        parts.append(scored.select(F.lit(key).alias("window"), "combo_id", *KEYS, "mape"))
    return parts[0].unionByName(parts[1])


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as dense daily actuals, one series per return flag and line status."""
    rows = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_returnflag").alias("region"),
        F.concat("l_returnflag", F.lit(" "), "l_linestatus").alias("series"),
        F.col("l_shipdate").cast("timestamp").alias("period"),
    )
    return materialize(rows.agg(F.sum("l_extendedprice").alias("value")), "shipments")
