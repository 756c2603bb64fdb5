"""Incremental and streaming ingestion."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans.ingest import ingest_batch as merge_batch
from ..plans.ingest import read_actuals
from ..session import fresh_path
from ..streaming import readings as streaming
from .data import HOURLY_REGIONS, raw_readings
from .registry import query
from .sql import with_views
from .tables import land_pages

# The second pull starts on the 15th and doubles every value.
_REVISED = """
    SELECT region, series, period,
           CASE WHEN period >= TIMESTAMP '2024-01-15' THEN value * 2 ELSE value END AS value FROM hourly_allowed"""


def _pulls(spark, sf_dir):
    """Two overlapping pulls of text readings, the later one with revised values."""
    rows = raw_readings(spark, sf_dir).drop("event_id")
    # Readings are told apart by sub-area and hour; several of one hour count as one.
    rows = rows.groupBy("parent", "subba", "period", "timezone").agg(F.sum(F.col("value").try_cast("double")).alias("value"))
    rows = rows.withColumn("value", F.col("value").cast("string"))
    first = rows.where(F.col("period") < "2024-01-20").withColumn("pull", F.lit("pull-001"))
    second = rows.where(F.col("period") >= "2024-01-15").withColumns(
        {"value": (F.col("value").cast("double") * 2).cast("string"), "pull": F.lit("pull-002")}
    )
    return first, second


@query(with_views(_REVISED, "hourly_allowed"), ["period"], ["value"])
def ingest_batch(spark, sf_dir):
    """Both pulls merged one after the other; readings that came twice count once."""
    path = fresh_path(spark, "load")
    for pull in _pulls(spark, sf_dir):
        merge_batch(pull.unionByName(pull), path, HOURLY_REGIONS)
    return read_actuals(spark, path).drop("month")


@query(with_views(_REVISED, "hourly_allowed"), ["period"], ["value"])
def stream_ingest(spark, sf_dir):
    """The same pulls as landed pages, taken in by a stream that is restarted in between."""
    landing, path, checkpoint = (fresh_path(spark, n) for n in ("landing", "load", "checkpoint"))
    for pull in _pulls(spark, sf_dir):
        land_pages(pull, "pull").write.mode("append").partitionBy("pull").json(landing)
        streaming.stream_ingest(spark, landing, path, checkpoint, HOURLY_REGIONS).awaitTermination()
    return read_actuals(spark, path).drop("month")


def event_stream(spark, sf_dir):
    """Events as a stream of typed readings."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return events.select(
        F.col("event_type").alias("parent"),
        F.col("user_id").cast("string").alias("subba"),
        F.col("ts").cast("timestamp").alias("period"),
        "value",
        "event_id",
    )


@query(with_views(_REVISED, "hourly_allowed"), ["period"], ["value"])
def stream_ingest_small_batches(spark, sf_dir):
    """The same pulls in many files, taken in one file at a time."""
    landing, path, checkpoint = (fresh_path(spark, n) for n in ("landing", "load", "checkpoint"))
    for pull in _pulls(spark, sf_dir):
        pages = land_pages(pull, "pull").repartition(2)
        pages.write.mode("append").partitionBy("pull").json(landing)
    streaming.stream_ingest(spark, landing, path, checkpoint, HOURLY_REGIONS, max_files=1).awaitTermination()
    return read_actuals(spark, path).drop("month")


@query(with_views("SELECT * FROM hourly_allowed", "hourly_allowed"), ["period"], ["value"])
def stream_region_totals(spark, sf_dir):
    path, checkpoint = fresh_path(spark, "revisions"), fresh_path(spark, "checkpoint")
    totals = streaming.stream_region_totals(event_stream(spark, sf_dir), HOURLY_REGIONS)
    streaming.write_revisions(totals, path, checkpoint).awaitTermination()
    return streaming.current_totals(spark, path)


@query(with_views("SELECT * FROM hourly_allowed", "hourly_allowed"), ["period"], ["value"])
def stream_region_totals_repeated(spark, sf_dir):
    """Every event delivered twice, in one query that drops repeats and then adds up."""
    path, checkpoint = fresh_path(spark, "revisions"), fresh_path(spark, "checkpoint")
    events = event_stream(spark, sf_dir)
    totals = streaming.stream_region_totals(events.unionByName(events), HOURLY_REGIONS, identity=["event_id"])
    streaming.write_revisions(totals, path, checkpoint).awaitTermination()
    return streaming.current_totals(spark, path)


@query(
    "SELECT event_id, event_type AS parent, ts AS period, value FROM events", ["period"], ["value"]
)
def stream_dedup(spark, sf_dir):
    """Every reading delivered twice, stored once."""
    events = event_stream(spark, sf_dir)
    once = streaming.stream_dedup(events.unionByName(events), ["event_id"])
    path, checkpoint = fresh_path(spark, "deduplicated"), fresh_path(spark, "checkpoint")
    once.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(
        path
    ).awaitTermination()
    return spark.read.parquet(path).select("event_id", "parent", "period", "value")
