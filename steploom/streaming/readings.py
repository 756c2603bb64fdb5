"""Readings as streams: landed files, running totals, repeated deliveries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import as_time, series_name
from ..operators.ingest import normalize_readings
from ..plans.ingest import ingest_batch, merge_totals, read_actuals
from ..schemas import ACTUALS, BACKFILL_HOURS, LANDED_PAGE
from ..sources.pages import flatten_pages

_PAGES = T.StructType([*LANDED_PAGE.fields, T.StructField("pull", T.StringType())])


def stream_ingest(
    spark: SparkSession,
    landing_dir: str,
    table_path: str,
    checkpoint: str,
    regions: Sequence[str],
    resolution: str = "hourly",
    timezone: str | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Merge newly landed pages (``pull=<name>`` folders) into the actuals table and stop.

    The checkpoint remembers the files taken in; a batch repeated after a failure
    writes the same rows again.  A pull may land in any number of files, batches and
    runs, and ``max_files`` only sets how much a batch takes in.
    """
    reader = spark.readStream.schema(_PAGES)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    readings = flatten_pages(reader.json(landing_dir), "pull")

    def merge(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch, table_path, regions, resolution, timezone)

    return (
        readings.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def default_lateness(resolution: str) -> str:
    """How long readings are revised: the safety window that pulls go back by."""
    return f"{BACKFILL_HOURS[resolution]} hours"


def stream_region_totals(
    readings: DataFrame,
    regions: Sequence[str],
    resolution: str = "hourly",
    lateness: str | None = None,
    identity: Sequence[str] | None = None,
) -> DataFrame:
    """Running totals per region and hour or day.

    With ``identity`` a reading counts once however often it is delivered: two readings are the
    same if these columns and the period agree.  Repeats are dropped by a stateful step of the same query that
    forgets a reading once it is too old for its total, so both states are bounded by the lateness.
    Without it every row counts.

    A late reading revises its total while it is less than ``lateness`` behind the
    newest one (by default the resolution's safety window) and is dropped after that,
    which also lets the state be cleared.
    """
    typed = readings.withColumn("period", as_time(readings, "period", resolution))
    clean = normalize_readings(typed, regions, resolution)
    slot = F.window("period", "1 day" if resolution == "daily" else "1 hour")
    timed = clean.withWatermark("period", lateness or default_lateness(resolution))
    # The period is among the keys, so the state of a reading goes when the watermark passes it.
    once = timed if identity is None else timed.dropDuplicates([*identity, "period"])
    totals = (
        once.groupBy(F.col("parent").alias("region"), slot.alias("slot"))
        .agg(F.sum("value").alias("value"))
    )
    return totals.select(
        "region", series_name("region").alias("series"), F.col("slot.start").alias("period"), "value"
    )


def stream_dedup(
    readings: DataFrame, keys: Sequence[str], resolution: str = "hourly", lateness: str | None = None
) -> DataFrame:
    """Drop repeated deliveries of a reading that arrive within ``lateness``."""
    late = lateness or default_lateness(resolution)
    return readings.withWatermark("period", late).dropDuplicatesWithinWatermark(list(keys))


def write_revisions(totals: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Merge every changed total into a table by month; a repeated batch changes nothing.

    A batch carries whole totals, so the table holds one row per total however often it was revised.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        merge_totals(batch, path)

    return (
        totals.writeStream.foreachBatch(store)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_totals(spark: SparkSession, path: str) -> DataFrame:
    """The newest revision of every total."""
    return read_actuals(spark, path).select(*ACTUALS.fieldNames())
