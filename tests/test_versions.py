from datetime import datetime

import pytest

from steploom.operators.ingest import watermarks
from steploom.plans import ingest
from steploom.plans.ingest import ingest_batch, merge_totals, read_actuals, readings_path, table_months, table_span, table_state
from steploom.schemas import ACTUALS
from steploom.sources import versions

REGIONS = ("CISO", "PJM")
RAW = "parent string, subba string, period string, value string, pull string"


def pull(spark, name, *rows):
    return spark.createDataFrame([(*r, name) for r in rows], RAW)


def content(df):
    return {(r.region, r.period, r.value) for r in df.select("region", "period", "value").collect()}


OLD = {("CISO", datetime(2026, 1, 3), 1.0), ("PJM", datetime(2026, 2, 3), 2.0)}


@pytest.fixture
def path(spark, tmp_path):
    path = str(tmp_path / "load")
    ingest_batch(pull(spark, "pull-1", ("CISO", "A", "2026-01-03T00", "1"), ("PJM", "B", "2026-02-03T00", "2")), path, REGIONS)
    return path


def second(spark):
    return pull(spark, "pull-2", ("CISO", "A", "2026-01-03T00", "5"), ("PJM", "B", "2026-02-03T00", "6"), ("PJM", "B", "2026-02-04T00", "7"))


NEW = {("CISO", datetime(2026, 1, 3), 5.0), ("PJM", datetime(2026, 2, 3), 6.0), ("PJM", datetime(2026, 2, 4), 7.0)}


def test_a_failure_before_the_switch_leaves_the_old_state(spark, path, monkeypatch):
    marks = sorted(map(str, table_state(spark, path, "load").collect()))

    def fail(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(ingest, "switch_pointer", fail)
        with pytest.raises(RuntimeError, match="lost"):
            ingest_batch(second(spark), path, REGIONS)
    assert content(read_actuals(spark, path)) == OLD
    assert sorted(map(str, table_state(spark, path, "load").collect())) == marks
    ingest_batch(second(spark), path, REGIONS)
    assert content(read_actuals(spark, path)) == NEW


def test_readings_and_totals_switch_together(spark, path, monkeypatch):
    """A run that failed after its readings were written does not lend them to a later one."""
    with monkeypatch.context() as m:
        m.setattr(ingest, "switch_pointer", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest_batch(pull(spark, "pull-9", ("CISO", "Z", "2026-01-03T00", "100")), path, REGIONS)
    ingest_batch(second(spark), path, REGIONS)
    assert content(read_actuals(spark, path)) == NEW


def test_a_cut_off_pointer_is_passed_over(spark, path, tmp_path):
    number = versions.read_pointer(spark, path).number
    (tmp_path / "load" / "_pointers" / f"{number + 1:012d}").write_text('{"folders": {"act')
    assert content(read_actuals(spark, path)) == OLD
    ingest_batch(second(spark), path, REGIONS)
    assert content(read_actuals(spark, path)) == NEW


def test_the_second_of_two_writers_fails(spark, path):
    old = versions.read_pointer(spark, path)
    versions.switch_pointer(spark, path, old, old.folders, old.facts)
    with pytest.raises(Exception, match="[Ee]xist"):
        versions.switch_pointer(spark, path, old, {}, {})
    assert content(read_actuals(spark, path)) == OLD


def test_a_table_read_before_a_switch_stays_readable(spark, path, tmp_path):
    before = read_actuals(spark, path)
    ingest_batch(second(spark), path, REGIONS)
    assert content(before) == OLD
    for _ in range(3):
        ingest_batch(second(spark), path, REGIONS)
    # The counting version and the one before it, whatever failed or was replaced.
    for root in (path, readings_path(path)):
        for month in ("2026-01", "2026-02"):
            assert len(versions._children(spark, f"{root}/month={month}")) == 2
    assert len(list((tmp_path / "load" / "_pointers").glob("0*"))) == 2


def test_state_is_observed_by_the_write(spark, path):
    ingest_batch(second(spark), path, REGIONS)
    # An old month again: no watermark goes back.
    ingest_batch(pull(spark, "pull-3", ("CISO", "A", "2025-12-30T00", "1"), ("CISO", "B", "2026-01-03T00", "1")), path, REGIONS)
    actuals = read_actuals(spark, path)
    want = watermarks(actuals, "load").collect()
    assert sorted(map(str, table_state(spark, path, "load").collect())) == sorted(map(str, want))
    rows = {r["month"]: r["count"] for r in actuals.groupBy("month").count().collect()}
    assert {r.month: r.rows for r in table_months(spark, path).collect()} == rows == {"2025-12": 1, "2026-01": 1, "2026-02": 2}
    assert table_span(spark, path).first()[:] == (datetime(2025, 12, 30), datetime(2026, 2, 4), 4)
    assert "FileScan" not in table_state(spark, path, "load")._jdf.queryExecution().executedPlan().toString()


def test_without_a_table(spark, tmp_path):
    nothing = str(tmp_path / "none")
    assert read_actuals(spark, nothing).columns == [*ACTUALS.fieldNames(), "month"] and read_actuals(spark, nothing).count() == 0
    for facts in (table_state(spark, nothing, "load"), table_months(spark, nothing), table_span(spark, nothing)):
        assert facts.count() == 0
    with pytest.raises(FileNotFoundError):
        read_actuals(spark, nothing, required=True)


def test_totals_keep_their_state(spark, series, tmp_path):
    path = str(tmp_path / "totals")
    merge_totals(series(CISO=[1.0, 2.0]), path)
    merge_totals(series(CISO=[5.0], PJM=[7.0]), path)
    assert {(r.region, r.value) for r in read_actuals(spark, path).collect()} == {("CISO", 5.0), ("CISO", 2.0), ("PJM", 7.0)}
    assert table_months(spark, path).first()[:] == ("2026-01", 3)
    marks = {r.partition_key: r.max_period.hour for r in table_state(spark, path, "load").collect()}
    assert marks == {None: 1, "CISO|CISO total": 1, "PJM|PJM total": 0}


def test_month_filters_reach_the_scan(spark, path):
    plan = read_actuals(spark, path).where("month = '2026-01'").select("value")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "ReadSchema: struct<value:double>" in plan
