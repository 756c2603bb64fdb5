"""The registered queries, compared with DuckDB on the smallest tables."""

import duckdb
import numpy as np
import pytest

from __spark_entry__ import SMOKE_DIR, entry, oracle_sql, queries
from check import TABLES, rows_of

SAMPLE = (
    "parse_period region_total watermarks chunk_coverage upsert_latest regular_grid fill_gaps_daily feature_matrix "
    "split_fraction split_holdout_count join_actual_forecast forecast_metrics best_combo serve_forecast "
    "backtest_overlay forecast_grouped recursive_forecast parse_series_reports"
).split()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMOKE_DIR}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, db, name):
    got = queries()[name](spark, SMOKE_DIR).toPandas()
    want = db.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    texts = [c for c in sorted(got.columns) if got[c].dtype.kind != "f"]
    numbers = [c for c in sorted(got.columns) if c not in texts]
    got, want = (df.sort_values(texts + numbers).reset_index(drop=True) for df in (got, want))
    assert rows_of(got[texts]) == rows_of(want[texts])
    # A value on a rounding tie may differ by one in its last digit.
    np.testing.assert_allclose(got[numbers].to_numpy(), want[numbers].to_numpy(dtype=float), rtol=0, atol=1.1e-4)


def test_entry(spark):
    assert entry(spark).columns == ["region", "series", "mae", "rmse", "mape", "smape", "n"]


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_results_do_not_depend_on_the_partition_count(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    for count in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", count)
        results.append(rows_of(queries()["feature_matrix"](spark, SMOKE_DIR).toPandas()))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]


@pytest.mark.parametrize("name", ["feature_matrix", "split_fraction", "score_last_week", "latest_issue", "chunk_coverage"])
def test_no_cross_joins(spark, name):
    plan = queries()[name](spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
