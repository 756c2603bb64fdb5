"""What the physical plans must look like to hold at scale."""

import re

from pyspark.sql import functions as F

from steploom.learners.linear import LinearLearner
from steploom.operators.buckets import grid_positions, positions
from steploom.operators.features import feature_matrix, lookback_features
from steploom.operators.gridding import regular_grid
from steploom.operators.ingest import dedup_periods, region_total
from steploom.plans import windows
from steploom.plans.forecasting import forecast_grouped
from steploom.schemas import model_for
from steploom.session import materialize

HOURLY = model_for("hourly")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_over_rows_stay_within_a_bucket(series):
    rows = materialize(series(A=[float(i) for i in range(50)]))
    looked = plan_of(lookback_features(rows, HOURLY.lags, HOURLY.roll_windows))
    windows = re.findall(r"windowspecdefinition\(([^)]*?) ASC", looked)
    assert windows and all("_bucket" in w for w in windows)
    # One shuffle and one sort carry all lags and means.
    assert len(re.findall(r"(?<!Broadcast)Exchange hashpartitioning", looked)) == 1
    assert len(re.findall(r"\bSort \[", looked)) == 1


def test_series_wide_windows_only_see_one_row_per_bucket(series):
    rows = materialize(series(A=[float(i) for i in range(50)]))
    for df in (positions(rows, ["region", "series"], HOURLY.step_us), regular_grid(rows, fill=True)):
        plan = plan_of(df)
        wide = [line for line in plan.splitlines() if "Window [" in line and "_bucket" not in line.split("], [")[-2]]
        # They sit on the aggregated bucket table, never on its source.
        assert wide and "Aggregate" in plan[plan.index(wide[-1]) :]


def test_totals_and_last_rows_combine_before_the_shuffle(spark, series):
    raw = spark.createDataFrame([("CISO", "A", "2026-01-01T00", "1")], "parent string, subba string, period string, value string")
    assert "partial_sum" in plan_of(region_total(raw, ["CISO"]))
    assert "partial_max_by" in plan_of(dedup_periods(series(A=[1.0])))


def test_a_long_series_spreads_over_tasks(spark):
    hours = spark.range(400_000).select(
        F.lit("A").alias("region"),
        F.lit("A total").alias("series"),
        F.timestamp_micros(F.col("id") * HOURLY.step_us).alias("period"),
        F.rand(1).alias("value"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = lookback_features(hours, (1, 168), (24,))
        tasks = rows.groupBy(F.spark_partition_id()).agg(F.count("value").alias("rows"), F.sum("lag_168"))
        sizes = [r.rows for r in tasks.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 4 and max(sizes) < 200_000 and sum(sizes) == 400_000


def test_features_from_a_stored_table_need_no_cross_join(series):
    rows = materialize(series(A=[float(i) for i in range(300)]))
    plan = plan_of(feature_matrix(rows, HOURLY))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_windows_share_grids_fits_and_paths(series, monkeypatch):
    made = []

    def counted(name):
        whole = getattr(windows, name)

        def call(*args, **options):
            made.append((name, args[1] if name == "forecast_grouped" else None))
            return whole(*args, **options)

        monkeypatch.setattr(windows, name, call)

    for name in ("filled_to_the_end", "forecast_grouped", "backtest_report", "regular_grid"):
        counted(name)
    config = model_for("hourly", lags=(1, 24), roll_windows=(), ridge=0.0)
    tables = {"hourly": series(A=[100.0 + i % 24 + (i * 7 % 5) for i in range(700)])}
    results = windows.run_windows(tables, LinearLearner(), ["7d", "14d", "1mo"], configure=lambda _: config)
    assert sorted(made, key=str) == [("backtest_report", None), ("filled_to_the_end", None), ("forecast_grouped", 720)]
    counts = {r["window"]: r["count"] for r in results["forecast"].groupBy("window").count().collect()}
    assert counts == {"7d": 168, "14d": 336, "1mo": 720}
    alone = {r.target_time: r.yhat for r in forecast_grouped(tables["hourly"], 168, config, LinearLearner()).collect()}
    assert {r.target_time: r.yhat for r in results["forecast"].where("window = '7d'").collect()} == alone
    # Other settings for one window make a fit of their own.
    made.clear()
    windows.run_windows(tables, LinearLearner(), ["7d", "14d"], configure=lambda t: config if t.key == "7d" else model_for("hourly", lags=(2,), roll_windows=()))
    assert sorted(n for n, _ in made) == ["backtest_report"] * 2 + ["filled_to_the_end"] + ["forecast_grouped"] * 2


def test_places_on_a_grid_equal_ranks(series):
    rows = materialize(regular_grid(series(A=[1.0] * 60, B=[None, 2.0, None, 4.0]).unionByName(series(start="2027-01-01", C=[5.0])), fill=True))
    keys = ["region", "series"]
    found = [sorted(tuple(map(str, r)) for r in f(rows, keys, HOURLY.step_us).select(*keys, "period", "_pos", "_n").collect()) for f in (positions, grid_positions)]
    assert found[0] == found[1] and "Window" not in plan_of(grid_positions(rows, keys, HOURLY.step_us))
