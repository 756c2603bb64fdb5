import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from steploom.plans.ingest import ingest_batch, read_actuals, table_state
from steploom.queries.tables import land_pages
from steploom.session import shared_folder
from steploom.streaming.readings import (
    current_totals,
    stream_dedup,
    stream_ingest,
    stream_region_totals,
    write_revisions,
)

REGIONS = ("CISO", "PJM")
RAW = "parent string, subba string, period string, value string, timezone string, pull string"
TYPED = "parent string, subba string, period timestamp, value double"


def pull(spark, name, rows):
    return spark.createDataFrame([(*r, None, name) for r in rows], RAW)


def both_pulls(spark):
    first = pull(
        spark,
        "pull-1",
        [("CISO", "A", "2026-01-31T23", "1"), ("CISO", "B", "2026-01-31T23", "2"), ("PJM", "C", "2026-02-01T00", "5")],
    )
    second = pull(
        spark,
        "pull-2",
        [("CISO", "A", "2026-01-31T23", "4"), ("CISO", "B", "2026-01-31T23", "4"), ("CISO", "A", "2026-03-01T00", "7")],
    )
    return first, second


EXPECTED = {
    ("CISO", datetime(2026, 1, 31, 23), 8.0),
    ("PJM", datetime(2026, 2, 1), 5.0),
    ("CISO", datetime(2026, 3, 1), 7.0),
}


def content(df):
    return {(r.region, r.period, r.value) for r in df.collect()}


def test_batches_merge_and_replay(spark, tmp_path):
    path = str(tmp_path / "load")
    first, second = both_pulls(spark)
    for batch in (first.unionByName(first), second, second):
        ingest_batch(batch, path, REGIONS)
    assert content(read_actuals(spark, path)) == EXPECTED
    marks = {r.partition_key: r.max_period for r in table_state(spark, path, "load").collect()}
    assert marks[None] == datetime(2026, 3, 1) and marks["PJM|PJM total"] == datetime(2026, 2, 1)
    ingest_batch(first.limit(0), path, REGIONS)
    assert content(read_actuals(spark, path)) == EXPECTED


def test_overlapping_pulls_in_one_batch_are_not_added_up(spark, tmp_path):
    path = str(tmp_path / "load")
    first, second = both_pulls(spark)
    ingest_batch(second.unionByName(first), path, REGIONS)
    assert content(read_actuals(spark, path)) == EXPECTED


def test_a_pull_may_arrive_in_parts(spark, tmp_path):
    """Totals do not depend on how the files of a pull fall into batches and runs."""
    rows = [("CISO", "A", "2026-01-01T00", "10"), ("CISO", "B", "2026-01-01T00", "15")]
    for case, options in (("runs", {}), ("files", {"max_files": 1})):
        landing, path, checkpoint = (str(tmp_path / case / n) for n in ("landing", "load", "checkpoint"))
        for row in rows:
            land_pages(pull(spark, "pull-1", [row]), "pull").write.mode("append").partitionBy("pull").json(landing)
            if case == "runs":
                stream_ingest(spark, landing, path, checkpoint, REGIONS).awaitTermination()
        stream_ingest(spark, landing, path, checkpoint, REGIONS, **options).awaitTermination()
        assert content(read_actuals(spark, path)) == {("CISO", datetime(2026, 1, 1), 25.0)}


def test_jobs_leave_nothing_behind(spark, tmp_path):
    before = set(os.listdir(shared_folder(spark)))
    ingest_batch(both_pulls(spark)[0], str(tmp_path / "load"), REGIONS)
    assert set(os.listdir(shared_folder(spark))) == before


def test_a_later_pull_revises_some_sub_areas(spark, tmp_path):
    path = str(tmp_path / "load")
    ingest_batch(pull(spark, "pull-1", [("CISO", "A", "2026-01-01T00", "10"), ("CISO", "B", "2026-01-01T00", "15")]), path, REGIONS)
    ingest_batch(pull(spark, "pull-2", [("CISO", "A", "2026-01-01T00", "1"), ("PJM", None, "2026-01-01T00", "2")]), path, REGIONS)
    assert content(read_actuals(spark, path)) == {("CISO", datetime(2026, 1, 1), 16.0), ("PJM", datetime(2026, 1, 1), 2.0)}


def test_stream_equals_batch_and_restarts(spark, tmp_path):
    landing, path, checkpoint = (str(tmp_path / n) for n in ("landing", "load", "checkpoint"))
    for p in both_pulls(spark):
        land_pages(p, "pull").write.mode("append").partitionBy("pull").json(landing)
        stream_ingest(spark, landing, path, checkpoint, REGIONS).awaitTermination()
    stream_ingest(spark, landing, path, checkpoint, REGIONS).awaitTermination()
    assert content(read_actuals(spark, path)) == EXPECTED


def write_file(spark, folder, rows):
    spark.createDataFrame(rows, TYPED).coalesce(1).write.mode("append").parquet(folder)


def test_late_readings_revise_or_are_dropped(spark, tmp_path):
    folder, path, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    t = datetime(2026, 1, 10, 12)

    def run():
        stream = spark.readStream.schema(TYPED).parquet(folder)
        write_revisions(stream_region_totals(stream, REGIONS), path, checkpoint).awaitTermination()

    write_file(spark, folder, [("CISO", "A", t, 1.0), ("PJM", "B", t, 3.0)])
    run()
    # Within a day of the newest reading: the total is revised.
    write_file(spark, folder, [("CISO", "A", t - timedelta(hours=20), 4.0), ("CISO", "B", t, 2.0)])
    run()
    # Two days later the first hours are closed.
    write_file(spark, folder, [("CISO", "A", t + timedelta(days=2), 9.0)])
    run()
    write_file(spark, folder, [("CISO", "A", t, 100.0)])
    run()
    assert content(current_totals(spark, path)) == {
        ("CISO", t, 3.0),
        ("PJM", t, 3.0),
        ("CISO", t - timedelta(hours=20), 4.0),
        ("CISO", t + timedelta(days=2), 9.0),
    }


def test_daily_readings_are_revised_for_a_week(spark, tmp_path):
    folder, path, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    t = datetime(2026, 1, 11)
    for rows in ([("CISO", "A", t, 1.0)], [("CISO", "A", t - timedelta(days=6), 2.0)], [("CISO", "A", t - timedelta(days=6), 3.0)]):
        write_file(spark, folder, rows)
        stream = spark.readStream.schema(TYPED).parquet(folder)
        write_revisions(stream_region_totals(stream, REGIONS, "daily"), path, checkpoint).awaitTermination()
    assert content(current_totals(spark, path)) == {("CISO", t, 1.0), ("CISO", t - timedelta(days=6), 5.0)}


def test_repeated_deliveries_are_stored_once(spark, tmp_path):
    folder = str(tmp_path / "in")
    rows = [("CISO", "A", datetime(2026, 1, 1, h), float(h)) for h in range(10)]
    write_file(spark, folder, rows)
    write_file(spark, folder, rows)
    stream = spark.readStream.schema(TYPED).option("maxFilesPerTrigger", 1).parquet(folder)
    out = stream_dedup(stream, ["parent", "subba", "period"])
    path = str(tmp_path / "out")
    out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(path).awaitTermination()
    assert spark.read.parquet(path).agg(F.count("*"), F.sum("value")).first()[:] == (10, 45.0)


def test_only_months_with_readings_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "load")
    months = ["2025-11", "2025-12", "2026-01", "2026-02"]
    ingest_batch(pull(spark, "pull-1", [("CISO", "A", f"{m}-03T00", "1") for m in months]), path, REGIONS)
    files = lambda: {m: sorted(os.listdir(f"{path}/month={m}")) for m in months}
    before = files()
    ingest_batch(pull(spark, "pull-2", [("CISO", "A", "2025-11-04T00", "2"), ("CISO", "A", "2026-02-03T00", "3")]), path, REGIONS)
    assert {m for m in months if files()[m] != before[m]} == {"2025-11", "2026-02"}
    assert read_actuals(spark, path).count() == 5
    assert {r.value for r in read_actuals(spark, path).where("month = '2026-02'").collect()} == {3.0}


def test_totals_count_repeated_deliveries_once(spark, tmp_path):
    landing, path = str(tmp_path / "landing"), str(tmp_path / "totals")
    at = lambda hours: datetime(2026, 1, 1) + timedelta(hours=hours)
    batches = [
        [("CISO", "A", at(0), 1.0), ("CISO", "B", at(0), 2.0), ("CISO", "A", at(0), 1.0)],
        [("CISO", "A", at(0), 1.0), ("CISO", "A", at(1), 5.0), ("CISO", "C", at(0), 4.0)],
        [("CISO", "B", at(0), 2.0), ("CISO", "A", at(1), 5.0)],
    ]
    for rows in batches:
        spark.createDataFrame(rows, TYPED).coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(TYPED).parquet(landing)
        totals = stream_region_totals(stream, REGIONS, identity=["parent", "subba"])
        write_revisions(totals, path, str(tmp_path / "checkpoint")).awaitTermination()
    assert content(current_totals(spark, path)) == {("CISO", at(0), 7.0), ("CISO", at(1), 5.0)}
