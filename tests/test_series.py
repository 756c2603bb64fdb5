"""Grids, features and splits against pandas on small inputs, with buckets small enough to be crossed."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from steploom.operators.buckets import positions
from steploom.operators.features import feature_matrix, lag_features, lookback_features
from steploom.operators.gridding import fill_gaps, regular_grid
from steploom.operators.splits import (
    eligible_series,
    future_grid,
    split_fraction,
    split_holdout_calendar,
    split_holdout_count,
    split_info,
    trim_train,
)
from steploom.schemas import ACTUALS, model_for

HOUR = 3_600_000_000


def to_pandas(df, region):
    pdf = df.where(F.col("region") == region).toPandas().sort_values("period").set_index("period")
    return pdf


@pytest.fixture(scope="module")
def holey(spark):
    """Random series with holes, missing values and rows off the grid."""
    rng = random.Random(7)
    rows = []
    for region, start, drop in (("A", 0, 0.3), ("B", 5, 0.05), ("C", 40, 0.9)):
        anchor = datetime(2026, 1, 1) + timedelta(hours=start, minutes=30 if region == "B" else 0)
        for i in range(200):
            if i and rng.random() < drop:
                continue
            value = None if rng.random() < 0.1 else float("nan") if rng.random() < 0.05 else rng.uniform(1, 100)
            rows.append((region, f"{region} total", anchor + timedelta(hours=i), value))
            if rng.random() < 0.1:
                rows.append((region, f"{region} total", anchor + timedelta(hours=i, minutes=17), 5.0))
    return spark.createDataFrame(rows, ACTUALS)


def expected_grid(holey, region):
    pdf = to_pandas(holey, region)["value"].astype(float)
    return pdf.asfreq("h")


@pytest.mark.parametrize("width", [8, 4096])
@pytest.mark.parametrize("region", ["A", "B", "C"])
def test_grid_and_fill_match_pandas(holey, region, width):
    want = expected_grid(holey, region)
    got = to_pandas(regular_grid(holey, width=width), region)["value"].astype(float)
    assert list(got.index) == list(want.index)
    np.testing.assert_allclose(got.to_numpy(), want.to_numpy(), equal_nan=True)
    filled = to_pandas(regular_grid(holey, fill=True, width=width), region)["value"]
    np.testing.assert_allclose(
        filled.to_numpy(), want.interpolate(limit_direction="both").ffill().bfill().to_numpy(), rtol=1e-12
    )


def test_fill_gaps_works_on_a_grid(holey):
    grid = regular_grid(holey)
    a = sorted(map(tuple, fill_gaps(grid).collect()))
    assert a == sorted(map(tuple, regular_grid(holey, fill=True).collect()))


def test_gap_shapes(series):
    rows = series(R=[None, 2.0, None, None, 5.0, None])
    filled = [r.value for r in fill_gaps(rows).orderBy("period").collect()]
    assert filled == [2.0, 2.0, 3.0, 4.0, 5.0, 5.0]
    cut = regular_grid(rows, fill=True, trim_tail=True).orderBy("period").collect()
    assert [r.value for r in cut] == [2.0, 2.0, 3.0, 4.0, 5.0]


def test_off_grid_rows_are_lost(spark):
    times = [datetime(2026, 1, 1, 0, 30), datetime(2026, 1, 1, 1, 30), datetime(2026, 1, 1, 4, 0)]
    rows = spark.createDataFrame([("R", "R total", t, 1.0 + i) for i, t in enumerate(times)], ACTUALS)
    got = [(r.period, r.value) for r in regular_grid(rows).orderBy("period").collect()]
    assert got == [
        (datetime(2026, 1, 1, 0, 30), 1.0),
        (datetime(2026, 1, 1, 1, 30), 2.0),
        (datetime(2026, 1, 1, 2, 30), None),
        (datetime(2026, 1, 1, 3, 30), None),
    ]


def test_series_without_values(series):
    rows = series(R=[None, None, None])
    assert [r.value for r in regular_grid(rows).collect()] == [None] * 3
    assert regular_grid(rows, fill=True).count() == 0
    assert regular_grid(rows, fill=True, trim_tail=True).count() == 0


def test_one_huge_hole_stays_in_bounded_pieces(spark):
    rows = [("R", "R total", datetime(1990, 1, 1), 0.0), ("R", "R total", datetime(2026, 1, 1), 10.0)]
    filled = regular_grid(spark.createDataFrame(rows, ACTUALS), fill=True)
    stats = filled.agg(F.count("*"), F.min("value"), F.max("value"), F.avg("value")).first()
    hours = (datetime(2026, 1, 1) - datetime(1990, 1, 1)).days * 24
    assert stats[:3] == (hours + 1, 0.0, 10.0) and abs(stats[3] - 5.0) < 1e-6


@pytest.mark.parametrize("width", [30, 4096])
def test_lags_and_rolling_means_match_pandas(holey, width):
    filled = regular_grid(holey, fill=True)
    wide = lookback_features(filled, (1, 3, 24), (7, 24, 30), width=width)
    for region in "AB":
        got = to_pandas(wide, region)
        y = to_pandas(filled, region)["value"]
        for k in (1, 3, 24):
            np.testing.assert_allclose(got[f"lag_{k}"], y.shift(k), equal_nan=True)
        for w in (7, 24, 30):
            np.testing.assert_allclose(got[f"rollmean_{w}"], y.shift(1).rolling(w).mean(), equal_nan=True, rtol=1e-9)


def test_rolling_mean_needs_every_value(holey):
    grid = regular_grid(holey)
    got = to_pandas(lookback_features(grid, (), (3, 6)), "A")
    y = to_pandas(grid, "A")["value"].astype(float)
    for w in (3, 6):
        np.testing.assert_allclose(
            got[f"rollmean_{w}"].astype(float), y.shift(1).rolling(w).mean(), equal_nan=True, rtol=1e-9
        )


def test_buckets_grow_with_the_halo(holey):
    narrow = lookback_features(regular_grid(holey, fill=True), [9], [], width=4)
    wide = lookback_features(regular_grid(holey, fill=True), [9], [], width=4096)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(narrow) == rows(wide)


@pytest.mark.parametrize("width", [5, 4096])
def test_positions_match_row_numbers(holey, width):
    got = positions(holey, ["region", "series"], HOUR, width=width).toPandas()
    for _, rows in got.groupby("region"):
        rows = rows.sort_values("period")
        assert list(rows["_pos"]) == list(range(1, len(rows) + 1))
        assert set(rows["_n"]) == {len(rows)}


def test_feature_columns(series):
    daily = series(step_hours=24, R=[float(i) for i in range(420)])
    config = model_for("daily")
    rows = feature_matrix(daily, config)
    assert rows.columns == ["region", "series", "period", "y", *config.feature_cols]
    assert len(config.feature_cols) == 19 and len(model_for("hourly").feature_cols) == 17
    assert rows.count() == 420 - 365
    first = rows.orderBy("period").first()
    assert (first.lag_365, first.lag_1, first.rollmean_7) == (0.0, 364.0, 361.0)


@pytest.mark.parametrize("n,fraction,expected", [(125, 0.2, 25), (130, 0.25, 32), (134, 0.25, 34), (99, 0.2, None), (100, 0.001, None)])
def test_split_rounds_half_to_even(series, n, fraction, expected):
    rows = series(R=[float(i) for i in range(n)]).withColumnRenamed("value", "y")
    config = model_for("hourly", min_observations=100)
    split = split_fraction(rows, fraction, config)
    info = split_info(split).collect()
    if expected is None:
        assert info == []
        return
    assert (info[0].test_rows, info[0].train_rows) == (expected, n - expected)
    assert info[0].issue_time == datetime(2026, 1, 1) + timedelta(hours=n - expected - 1)
    assert split.where("is_test").count() == expected
    with pytest.raises(ValueError):
        split_fraction(rows, 1.0, config)


def test_calendar_and_count_holdouts_differ_on_holes(series):
    values = [float(i + 1) for i in range(30)]
    for hole in (19, 24, 25):
        values[hole] = None
    grid = regular_grid(series(R=[*values, None]))
    by_time = split_holdout_calendar(grid, 10).where("is_test")
    assert by_time.agg(F.min("period"), F.count("*")).first()[:] == (datetime(2026, 1, 1, 20), 10)
    by_count = split_holdout_count(grid, 10, 5).orderBy("step_no").collect()
    assert [r.step_no for r in by_count] == list(range(1, 11))
    assert by_count[0].period == datetime(2026, 1, 1, 17) == by_count[-1].test_start
    assert split_holdout_calendar(grid, 27).count() == 0
    assert split_holdout_count(grid, 10, 18).count() == 0


def test_trim_train_is_per_series(series):
    rows = series(A=[1.0] * 10).unionByName(series(B=[1.0] * 4))
    counts = {r.region: r["count"] for r in trim_train(rows, 6).groupBy("region").count().collect()}
    assert counts == {"A": 6, "B": 4}
    assert trim_train(rows, 0).count() == 14


def test_eligible_series(series):
    rows = series(A=[1.0, None, 2.0], B=[1.0, 2.0, 3.0])
    assert {r.region for r in eligible_series(rows, 3).collect()} == {"B"}


def test_future_grid_steps(spark):
    origins = spark.createDataFrame([("R", "R total", datetime(2026, 1, 31))], "region string, series string, origin timestamp")
    rows = future_grid(origins, 3, "daily").orderBy("step_no").collect()
    assert [r.target_time for r in rows] == [datetime(2026, 2, d) for d in (1, 2, 3)]
    assert {r.issue_time for r in rows} == {datetime(2026, 1, 31)}


def test_lags_longer_than_a_bucket(series):
    rows = lag_features(series(A=list(map(float, range(9000)))), [8760]).where("lag_8760 IS NOT NULL")
    assert [(r.value, r.lag_8760) for r in rows.orderBy("period").limit(2).collect()] == [(8760.0, 0.0), (8761.0, 1.0)]
    assert rows.count() == 240
