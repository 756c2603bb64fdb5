from datetime import datetime

import pytest
from pyspark.sql import functions as F

from steploom.functions.columns import coerce_numeric, parse_period
from steploom.operators import ingest
from steploom.schemas import ACTUALS, INGEST_STATE, REGIONS, TIMEZONES

READINGS = "parent string, subba string, period string, value string"


def test_region_total_sums_sub_areas(spark):
    raw = spark.createDataFrame(
        [
            ("CISO", "A", "2026-01-01T00", "10"),
            ("ciso", "B", "2026-01-01T00", "15"),
            ("PJM", "C", "2026-01-01T01", "20"),
            ("XXXX", "D", "2026-01-01T01", "99"),
            (None, "E", "2026-01-01T01", "99"),
        ],
        READINGS,
    )
    out = ingest.region_total(raw, REGIONS)
    assert out.columns == ["region", "series", "period", "value"]
    assert dict(out.dtypes)["period"] == "timestamp"
    assert {(r.region, r.series, r.period, r.value) for r in out.collect()} == {
        ("CISO", "CISO total", datetime(2026, 1, 1, 0), 25.0),
        ("PJM", "PJM total", datetime(2026, 1, 1, 1), 20.0),
    }


def test_empty_readings_keep_the_schema(spark):
    out = ingest.region_total(spark.createDataFrame([], READINGS), REGIONS)
    assert out.columns == ["region", "series", "period", "value"] and out.count() == 0


def test_bad_values(spark):
    texts = ["x", "", "nan", "inf", " 12.5 ", "1d", "2f", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.v for r in rows.select("i", coerce_numeric("t").alias("v")).collect()}
    assert got == {0: None, 1: None, 2: None, 3: float("inf"), 4: 12.5, 5: None, 6: None, 7: None}


def test_periods_parse_by_declared_resolution(spark):
    row = spark.createDataFrame([("2024-01-01T05", "2024-01-02")], "h string, d string").select(
        parse_period("h", "hourly").alias("h"),
        parse_period("d", "daily").alias("d"),
        parse_period("d", "hourly").alias("wrong"),
    )
    assert tuple(row.first()) == (datetime(2024, 1, 1, 5), datetime(2024, 1, 2), None)


def test_timezone_copies_count_once(spark):
    rows = [("CISO", "A", "2026-01-01", "10", z) for z in TIMEZONES]
    raw = spark.createDataFrame(rows, READINGS + ", timezone string")
    out = ingest.region_total(ingest.select_timezone_copy(raw), REGIONS, "daily")
    assert [r.value for r in out.collect()] == [10.0]


def test_daily_total_follows_the_day_boundary(series):
    # 05:00 UTC is midnight in the eastern zone in winter.
    out = ingest.daily_total(series(start="2026-01-01T03:00:00", R=[1.0, 2.0, 4.0, 8.0]))
    assert {(r.period, r.value) for r in out.collect()} == {
        (datetime(2025, 12, 31), 3.0),
        (datetime(2026, 1, 1), 12.0),
    }


def test_upsert_prefers_new_rows_and_is_idempotent(spark, series):
    old, new = series(CISO=[10.0, 11.0]), series(CISO=[12.0])
    once = ingest.upsert_latest(old, new)
    assert sorted(r.value for r in once.collect()) == [11.0, 12.0]
    again = ingest.upsert_latest(once, new)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, once.collect()))


def test_dedup_uses_the_given_order(spark):
    t = datetime(2026, 1, 1)
    rows = spark.createDataFrame(
        [("R", "R total", t, 5.0, 2), ("R", "R total", t, 9.0, 1)], "region string, series string, period timestamp, value double, n int"
    )
    assert [r.value for r in ingest.dedup_periods(rows, order=["n"]).collect()] == [5.0]


def test_watermarks_and_state(spark, series):
    rows = series(CISO=[1.0, 2.0]).unionByName(series(PJM=[3.0]))
    marks = ingest.watermarks(rows, "load")
    assert {(r.partition_key, r.max_period) for r in marks.collect()} == {
        (None, datetime(2026, 1, 1, 1)),
        ("CISO|CISO total", datetime(2026, 1, 1, 1)),
        ("PJM|PJM total", datetime(2026, 1, 1, 0)),
    }
    nothing = ingest.watermarks(spark.createDataFrame([], ACTUALS), "load")
    assert nothing.count() == 0
    assert ingest.merge_state(marks, "load", nothing).count() == 3
    later = ingest.watermarks(series(CISO=[1.0, 2.0, 3.0]), "load")
    assert ingest.merge_state(marks, "load", later).count() == 2


def test_pull_range_goes_back_behind_the_watermark(spark):
    state = spark.createDataFrame([("load", None, datetime(2026, 1, 10))], INGEST_STATE)
    datasets = spark.createDataFrame([("load", "hourly"), ("other", "daily")], "dataset string, resolution string")
    out = ingest.pull_range(state, datasets, F.lit("2026-02-01").cast("timestamp"))
    assert {(r.dataset, r.start) for r in out.collect()} == {
        ("load", datetime(2026, 1, 9)),
        ("other", datetime(2023, 1, 1)),
    }


def test_pull_plan_keeps_the_shortest_day(spark):
    ranges = spark.createDataFrame(
        [("load", datetime(2026, 1, 31, 5), datetime(2026, 4, 2))], "dataset string, start timestamp, end timestamp"
    )
    got = [(r.lo, r.hi) for r in ingest.pull_plan(ranges).orderBy("chunk").collect()]
    assert got == [
        (datetime(2026, 1, 31, 5), datetime(2026, 2, 28, 4)),
        (datetime(2026, 2, 28, 5), datetime(2026, 3, 28, 4)),
        (datetime(2026, 3, 28, 5), datetime(2026, 4, 2)),
    ]


def test_chunk_coverage_counts_each_reading_once(spark):
    ranges = spark.createDataFrame(
        [("load", datetime(2026, 1, 15), datetime(2026, 3, 20))], "dataset string, start timestamp, end timestamp"
    )
    hours = spark.range(0, 24 * 64).select(
        F.lit("load").alias("dataset"), F.expr("timestamp'2026-01-15' + make_dt_interval(0, cast(id as int))").alias("period")
    )
    totals = spark.createDataFrame([("load", 0, 744), ("load", 1, 999)], "dataset string, chunk int, reported long")
    plan = ingest.pull_plan(ranges)
    got = {r.chunk: (r.landed, r.pages, r.complete) for r in ingest.chunk_coverage(hours, plan, totals).collect()}
    assert got == {0: (744, 1, True), 1: (672, 1, False), 2: (120, 1, None)}


def test_trim_history_uses_one_global_cutoff(series):
    rows = series(A=[1.0] * 10).unionByName(series(B=[1.0] * 4))
    assert {r.region: r["count"] for r in ingest.trim_history(rows, hours=7).groupBy("region").count().collect()} == {
        "A": 7,
        "B": 1,
    }
    with pytest.raises(ValueError):
        ingest.trim_history(rows)


def test_rows_without_a_key_count_overall(spark):
    rows = [("A", "A total", datetime(2026, 1, 1), 1.0), (None, None, datetime(2026, 2, 1), 1.0)]
    marks = {r.partition_key: r.max_period for r in ingest.watermarks(spark.createDataFrame(rows, ACTUALS), "load").collect()}
    assert marks == {"A|A total": datetime(2026, 1, 1), None: datetime(2026, 2, 1)}
