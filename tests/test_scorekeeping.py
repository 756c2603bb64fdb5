"""Scores kept up to date: arrivals in any pieces give the row of one full run."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from steploom.plans.backtesting import overlap_evaluation
from steploom.plans.scorekeeping import kept_overall, kept_scores, update_scores
from steploom.schemas import ACTUALS, FORECASTS

START = datetime(2026, 1, 1)


def rows_of(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


@pytest.fixture(scope="module")
def tables(spark):
    at = lambda i: START + timedelta(hours=i)
    actual = [(k, f"{k} total", at(i), float(i % 7 + (k == "B"))) for k in ("A", "B") for i in range(96)] + [(None, "x", at(3), 2.0)]
    ahead = [(k, f"{k} total", START - timedelta(days=d), at(i), float(i % 5)) for k in ("A", "B", "C") for d in (1, 2) for i in range(120)]
    ahead.append((None, "x", START, at(3), 1.0))
    return spark.createDataFrame(actual, ACTUALS), spark.createDataFrame(ahead, FORECASTS)


def test_arrivals_give_the_row_of_one_full_run(spark, tables, tmp_path):
    actual, ahead = tables
    path = str(tmp_path / "sums")
    first = actual.where(F.col("period") < F.lit(START + timedelta(hours=30)))
    second = actual.where(F.col("period") >= F.lit(START + timedelta(hours=30)))
    assert len(update_scores(first, first, ahead, path)) == 2
    assert rows_of(kept_scores(spark, path)) == rows_of(overlap_evaluation(first, ahead).by_series)
    assert len(update_scores(second, actual, ahead, path)) == 3
    full = overlap_evaluation(actual, ahead)
    for _ in range(2):
        assert rows_of(kept_scores(spark, path)) == rows_of(full.by_series)
        assert rows_of(kept_overall(spark, path)) == rows_of(full.overall)
        update_scores(second.limit(20), actual, ahead, path)


def test_only_new_days_are_joined_and_revisions_count_once(spark, tables, tmp_path):
    actual, ahead = tables
    path = str(tmp_path / "sums")
    update_scores(actual, actual, ahead, path)
    spark.sparkContext.setJobDescription(None)
    revised = actual.withColumn("value", F.when(F.to_date("period") == "2026-01-02", 100.0).otherwise(F.col("value")))
    files = lambda: {f.split("day=")[1] for f in spark.read.parquet(path).inputFiles()}
    before = files()
    days = update_scores(revised.where("value = 100").limit(1), revised, ahead, path)
    assert [d.isoformat() for d in days] == ["2026-01-02"]
    changed = files() ^ before
    assert changed and all(f.startswith("2026-01-02/") for f in changed)
    assert rows_of(kept_scores(spark, path)) == rows_of(overlap_evaluation(revised, ahead).by_series)


def test_withdrawn_days_and_empty_arrivals(spark, tables, tmp_path):
    actual, ahead = tables
    path = str(tmp_path / "sums")
    update_scores(actual, actual, ahead, path)
    gone = actual.withColumn("value", F.when(F.to_date("period") == "2026-01-01", None).otherwise(F.col("value")))
    update_scores(actual.where("to_date(period) = '2026-01-01'"), gone, ahead, path)
    assert rows_of(kept_scores(spark, path)) == rows_of(overlap_evaluation(gone, ahead).by_series)
    assert update_scores(actual.limit(0), actual, ahead, path) == []
