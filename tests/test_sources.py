from datetime import datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from steploom.schemas import ACTUALS, BEST_PARAMS, FORECASTS
from steploom.session import fresh_path, shared_folder
from steploom.sources.pages import read_landed_pages
from steploom.sources.reports import parse_metric_reports
from steploom.sources.tables import read_best_params, read_series, write_best_params, write_csv, write_table

WITH_CRITERIA = """Backtest metrics (load)
Holdout hours: 168

Overall metrics
   mae    rmse   mape  smape   n
1.5000  2.2500  3.100  4.200 336

Per-series metrics
region       series   n    mae   rmse  mape smape    aic    bic   hqic
  CISO   CISO total 168 1.0000 2.0000  3.00  4.00 -10.50  20.00  30.25
   PJM    PJM total 168 2.0000 2.5000  3.20  4.40  11.00  21.00  31.00
a line of another kind
"""
WITHOUT_CRITERIA = """Backtest metrics (load)
Train/test split: 80% train / 20% test

Overall metrics
No overlapping rows for metric calculation.

Per-series metrics
region       series   n  mae  rmse  mape smape
  CISO   CISO total 168 1.25  2.00  3.00  4.00
"""


def test_table_round_trip_and_missing_path(spark, series, tmp_path):
    path = str(tmp_path / "t")
    write_table(series(A=[1.0, 2.0]), path)
    assert read_series(spark, path, ACTUALS).count() == 2
    empty = read_series(spark, str(tmp_path / "none"), ACTUALS)
    assert empty.count() == 0 and empty.schema == ACTUALS
    with pytest.raises(FileNotFoundError):
        read_series(spark, str(tmp_path / "none"), ACTUALS, required=True)


def test_scan_is_pruned_and_filtered(spark, series, tmp_path):
    path = str(tmp_path / "t")
    write_table(series(A=[1.0], B=[2.0]).withColumn("window", F.lit("7d")), path, ["window"])
    query = read_series(spark, path).where((F.col("window") == "7d") & (F.col("region") == "A")).select("value")
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(region,A)" in plan and "PartitionFilters: [isnotnull(window" in plan
    assert "ReadSchema: struct<region:string,value:double>" in plan


def test_pages_flatten(spark, tmp_path):
    page = '{"response": {"total": "3", "data": [{"parent": "CISO", "subba": "A", "period": "2026-01-01T00", "value": 5}, {"parent": "PJM", "value": null}]}}'
    (tmp_path / "p.json").write_text(page + '\n{"response": {"total": "0", "data": []}}\n')
    rows = read_landed_pages(spark, str(tmp_path)).orderBy("parent").collect()
    assert [(r.parent, r.value, r.reported_total) for r in rows] == [("CISO", "5", 3), ("PJM", None, 3)]


def test_both_report_layouts(spark, tmp_path):
    (tmp_path / "a.txt").write_text(WITH_CRITERIA)
    (tmp_path / "b.txt").write_text(WITHOUT_CRITERIA)
    overall, rows = parse_metric_reports(spark, str(tmp_path))
    assert [tuple(r)[1:] for r in overall.collect()] == [(1.5, 2.25, 3.1, 4.2, 336.0)]
    got = {(r.report[-5], r.region): (r.series, r.n, r.mae, r.aic, r.hqic) for r in rows.collect()}
    assert got == {
        ("a", "CISO"): ("CISO total", 168.0, 1.0, -10.5, 30.25),
        ("a", "PJM"): ("PJM total", 168.0, 2.0, 11.0, 31.0),
        ("b", "CISO"): ("CISO total", 168.0, 1.25, None, None),
    }


def test_best_params_documents(spark, tmp_path):
    path = str(tmp_path / "params")
    params = (300, 4, 0.1, 0.9, 0.9, 5)
    row = lambda w, p: (w, "hourly", 168, p, datetime(2026, 1, 1), 3.5, 16)
    write_best_params(spark.createDataFrame([row("7d", params)], BEST_PARAMS), path)
    write_best_params(spark.createDataFrame([row("14d", None)], BEST_PARAMS), path)
    got = read_best_params(spark, path).collect()
    assert [(r.window, tuple(r.params)) for r in got] == [("7d", params)]
    assert read_best_params(spark, str(tmp_path / "none")).count() == 0


def test_csv_has_a_header(spark, tmp_path):
    path = str(tmp_path / "csv")
    write_csv(spark.createDataFrame([(1, 2.5)], "combo_id int, mape double").coalesce(1), path)
    assert spark.read.option("header", True).csv(path).columns == ["combo_id", "mape"]


class FakeSession:
    """Only what the choice of the shared folder looks at."""

    def __init__(self, folder, master):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = SimpleNamespace(master=master, applicationId=f"fake-{master}")


def test_intermediate_tables_use_the_named_folder(spark):
    assert shared_folder(FakeSession("hdfs://shared/ck/", "yarn")) == "hdfs://shared/ck"
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    local = FakeSession(None, "local[2]")
    assert shared_folder(local) == shared_folder(local)
    with pytest.raises(RuntimeError):
        shared_folder(FakeSession(None, "yarn"))


def test_forecast_schema_names():
    assert FORECASTS.fieldNames() == ["region", "series", "issue_time", "target_time", "yhat"]
