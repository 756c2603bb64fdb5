import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from steploom.operators import views
from steploom.schemas import FORECASTS

OLD, NEW = datetime(2024, 1, 1), datetime(2024, 1, 2)


@pytest.fixture(scope="module")
def stored(spark):
    rows = [
        ("CISO", "CISO total", OLD, datetime(2024, 1, 1, 1), 1.0),
        ("CISO", "CISO total", NEW, datetime(2024, 1, 2, 1), 100.0),
        ("CISO", "CISO total", NEW, datetime(2024, 1, 2, 2), float("nan")),
        ("PJM", "PJM total", OLD, datetime(2024, 1, 1, 1), 200.0),
    ]
    return spark.createDataFrame(rows, FORECASTS).withColumn("window", F.lit("7d"))


def test_serve_forecast_filters_before_choosing_the_run(stored):
    rows = views.serve_forecast(stored, "7d", "ciso").collect()
    assert [r["count"] for r in rows] == [2, 2] and {r.issue_time for r in rows} == {NEW}
    first = json.loads(min(r.record for r in rows))
    assert first["target_time"] == "2024-01-02T01:00:00+00:00" and first["yhat"] == 100.0
    assert '"yhat":null' in max(r.record for r in rows)
    assert views.serve_forecast(stored, "7d", "PJM").first().issue_time == OLD
    assert views.serve_forecast(stored, "7d").count() == 2
    assert views.serve_forecast(stored, "14d").count() == views.serve_forecast(stored, "7d", "x").count() == 0
    with pytest.raises(KeyError):
        views.serve_forecast(stored, "2d")


def test_region_filter_reaches_the_scan(spark, stored, tmp_path):
    path = str(tmp_path / "forecast")
    stored.write.partitionBy("window").parquet(path)
    table, names = spark.read.parquet(path), stored.select("region").distinct()
    rows = views.filter_region(table.where("window = '7d'"), "cIsO", names)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line][0].split("PushedFilters: ")[1]
    assert "region" in pushed.split("]")[0] and "CISO" in pushed
    assert rows.count() == 3 and views.filter_region(table, "none", names).count() == 0
    want = sorted(r.record for r in views.serve_forecast(table, "7d", "ciso").collect())
    assert sorted(r.record for r in views.serve_forecast(table, "7d", "ciso", names).collect()) == want


def test_freshness_levels(series):
    rows = series(R=[1.0])
    at = lambda text: F.lit(text).cast("timestamp")
    status = lambda df, now: views.freshness(df, at(now)).first().status
    assert status(rows, "2026-01-01 03:00:00") == "Fresh"
    assert status(rows, "2026-01-01 03:00:01") == "Delayed"
    assert status(rows, "2026-01-02 06:00:00") == "Delayed"
    assert status(rows, "2026-01-02 06:00:01") == "Stale"
    assert status(rows.limit(0), "2026-01-02 06:00:01") == "Missing"


def test_frames(series, stored):
    actuals = series(start="2023-12-20", CISO=[1.0] * (24 * 12 + 1))
    run = views.prepare_forecasts(views.latest_issue(stored))
    frame = views.actual_forecast_frame(actuals, run, "CISO", 3).collect()
    assert [r.type for r in frame] == ["actual"] * (3 * 24 + 1) + ["forecast"]
    overlay = views.backtest_overlay(actuals, run, "CISO", 1).collect()
    assert {r.type for r in overlay} <= {"actual", "backtest forecast"}
    assert views.backtest_overlay(actuals, run, "PJM").count() == 0


def test_spans_and_previews(series, stored):
    span = views.forecast_span(stored).first()
    assert (span.latest_issue, span.latest_target, span.horizon_hours) == (NEW, datetime(2024, 1, 2, 2), 2)
    bounds = views.backtest_bounds(stored, "CISO").first()
    assert bounds.hours == 26
    rows = series(A=[float(i) for i in range(60)])
    assert [r.value for r in views.preview(rows, "period", newest=True).collect()] == [float(i) for i in range(59, 9, -1)]
    profile = views.dataset_profile(rows.unionByName(series(B=[1.0]))).first()
    assert profile.rows == 61 and profile.regions == ["A", "B"]
    assert [r.region for r in views.region_list(rows, stored).collect()] == ["A", "CISO", "PJM"]


def test_records_keep_microseconds_and_drop_infinities(spark):
    rows = [(datetime(2026, 1, 1, 0, 0, 0, 123456), float("inf")), (datetime(2026, 1, 1), float("nan"))]
    records = [r.record for r in views.to_records(spark.createDataFrame(rows, "t timestamp, v double")).collect()]
    assert records == ['{"t":"2026-01-01T00:00:00.123456+00:00","v":null}', '{"t":"2026-01-01T00:00:00+00:00","v":null}']
