"""Merging pulls of raw readings into an actuals table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone as tz

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import series_name
from ..operators.ingest import normalize_readings, select_timezone_copy, upsert_latest
from ..schemas import ACTUALS, INGEST_STATE
from ..session import materialize, run_folder
from ..sources.versions import Pointer, clear_pointers, clear_versions, read_pointer, stored_months, switch_pointer, write_months

_STORED = T.StructType([*ACTUALS.fields, T.StructField("month", T.StringType())])
_READING_KEYS = ("parent", "subba", "period")
_READINGS = T.StructType(
    [
        T.StructField("parent", T.StringType()),
        T.StructField("subba", T.StringType()),
        T.StructField("period", T.TimestampType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("pull", T.StringType()),
        T.StructField("month", T.StringType()),
    ]
)


def readings_path(path: str) -> str:
    """Where the readings behind the actuals table at ``path`` are kept."""
    return f"{path.rstrip('/')}_readings"


def read_actuals(spark: SparkSession, path: str, required: bool = False) -> DataFrame:
    """An actuals table as written by :func:`ingest_batch`, as of its last switch."""
    pointer = read_pointer(spark, path)
    if required and not pointer.folders:
        raise FileNotFoundError(f"no table at {path}")
    return _actuals(spark, path, pointer)


def _actuals(spark: SparkSession, path: str, pointer: Pointer, months: Sequence[str] | None = None) -> DataFrame:
    return stored_months(spark, path, pointer.folders.get("actuals", {}), _STORED, months)


def latest_readings(readings: DataFrame) -> DataFrame:
    """Per sub-area and period the distinct values of the last pull that has it (pulls ordered by name).

    A sub-area has few values per period, so the sets stay small; both steps combine map-side.
    """
    per_pull = readings.groupBy(*_READING_KEYS, "pull").agg(F.collect_set("value").alias("values"))
    last = per_pull.groupBy(*_READING_KEYS).agg(F.max_by(F.struct("pull", "values"), "pull").alias("last"))
    return last.select(*_READING_KEYS, F.explode("last.values").alias("value"), F.col("last.pull").alias("pull"))


def typed_readings(
    raw: DataFrame, regions: Sequence[str], resolution: str = "hourly", timezone: str | None = None
) -> DataFrame:
    """Readings of the allowed regions with the name of their pull.

    A batch that names no pull is one pull, named by the time it is taken in.
    """
    rows = raw if timezone is None else select_timezone_copy(raw, timezone)
    if "pull" not in rows.columns:
        rows = rows.withColumn("pull", F.lit(datetime.now(tz.utc).isoformat()))
    if "subba" not in rows.columns:
        rows = rows.withColumn("subba", F.lit(None).cast("string"))
    clean = normalize_readings(rows.select(*_READING_KEYS, "value", "pull"), regions, resolution)
    return clean.select(*_READING_KEYS, "value", F.coalesce("pull", F.lit("")).alias("pull"))


def extent_of(totals: DataFrame) -> tuple[list[str], list[tuple[str, str]]]:
    """The months that rows fall into and the series they are of, combined map-side.

    A few names for each year, and one for each region: totals are kept by region.
    """
    month, name = F.date_format("period", "yyyy-MM"), F.struct("region", "series")
    found = totals.agg(F.collect_set(month).alias("months"), F.collect_set(name).alias("series")).first()
    named = [(r.region, r.series) for r in found.series if r.region is not None and r.series is not None]
    return sorted(found.months), sorted(named)


def ingest_batch(
    raw: DataFrame,
    path: str,
    regions: Sequence[str],
    resolution: str = "hourly",
    timezone: str | None = None,
) -> None:
    """Merge a batch of raw readings into the actuals table at ``path``.

    Readings are kept by sub-area, so that it does not matter in how many batches a
    pull arrives: a pull's readings add up with its earlier ones and replace those of
    earlier pulls, and totals of the touched months are summed again.  Both tables are
    partitioned by month, and only the months that the batch has readings of are read
    and rewritten, however far they lie apart, so the work follows the batch, not the history.

    New months are written beside the old ones and count for both tables at once when a small
    pointer file is switched.  A job that fails before leaves the old state, and running the same batch again,
    as the stream does, changes nothing twice.  One writer at a time: of two that overlap the second fails.
    """
    spark = raw.sparkSession
    with run_folder(spark):
        fresh = materialize(typed_readings(raw, regions, resolution, timezone), "fresh")
        months, names = extent_of(fresh.select(F.col("parent").alias("region"), series_name("parent").alias("series"), "period"))
        if not months:
            return
        old = read_pointer(spark, path)
        # Equal readings of a pull fall together in the sets of latest_readings.
        kept = stored_months(spark, readings_path(path), old.folders.get("readings", {}), _READINGS, months).drop("month")
        merged = materialize(latest_readings(kept.unionByName(fresh)), "readings")
        versions = write_months(_by_month(merged), readings_path(path), months)
        totals = merged.groupBy(F.col("parent").alias("region"), "period").agg(F.sum("value").alias("value"))
        totals = totals.select("region", series_name("region").alias("series"), "period", "value")
        _replace(spark, path, old, totals, months, names, {"readings": versions})


def merge_totals(totals: DataFrame, path: str) -> None:
    """Put changed totals on top of the months they belong to; the newest value of a total wins."""
    spark = totals.sparkSession
    with run_folder(spark):
        fresh = materialize(totals.select(*ACTUALS.fieldNames()), "totals")
        months, names = extent_of(fresh)
        if months:
            _replace(spark, path, read_pointer(spark, path), fresh, months, names, {})


def _by_month(rows: DataFrame) -> DataFrame:
    return rows.withColumn("month", F.date_format("period", "yyyy-MM")).hint("rebalance", "month")


def _replace(
    spark: SparkSession, path: str, old: Pointer, totals: DataFrame, months: list[str], names: list[tuple[str, str]], written: dict
) -> None:
    """Write months of totals, then let them and the other tables ``written`` count.

    What the tables' state is made of is observed by the write itself, so nothing is read again for it.
    """
    rows = _by_month(upsert_latest(_actuals(spark, path, old, months).select(*ACTUALS.fieldNames()), totals))
    time = F.unix_micros("period")
    figures = [F.count_if(F.col("month") == m).alias(f"rows {m}") for m in months]
    figures += [
        F.max(F.when((F.col("region") == region) & (F.col("series") == series), time)).alias(f"newest {i}")
        for i, (region, series) in enumerate(names)
    ]
    # Above the last shuffle: each task of the write reports once, also if earlier stages run again.
    seen = Observation()
    observed = rows.observe(seen, *figures, F.min(time).alias("first"), F.max(time).alias("last"))
    written = {**written, "actuals": write_months(observed, path, months)}
    got, before = seen.get, old.facts

    # Periods never leave the table, so its ends and newest periods only move outwards.
    newest = dict(before.get("newest", {}))
    for i, name in enumerate(names):
        newest["|".join(name)] = max(got[f"newest {i}"], newest.get("|".join(name), got[f"newest {i}"]))
    facts = {
        "rows": {**before.get("rows", {}), **{m: got[f"rows {m}"] for m in months}},
        "newest": newest,
        "first": min(got["first"], before.get("first", got["first"])),
        "last": max(got["last"], before.get("last", got["last"])),
    }
    folders = {**old.folders, **{name: {**old.folders.get(name, {}), **v} for name, v in written.items()}}
    new = switch_pointer(spark, path, old, folders, facts)
    for name, root in (("actuals", path), ("readings", readings_path(path))):
        if name in written:
            clear_versions(spark, root, months, new.folders[name], old.folders.get(name, {}))
    clear_pointers(spark, path, new.number)


def table_state(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """Watermarks of the table, overall (``partition_key`` NULL) and by region and series.

    They are stored with the pointer that makes the table's rows count, so they cannot disagree with it; no row is read.
    """
    facts = read_pointer(spark, path).facts
    marks = [(None, facts["last"]), *facts["newest"].items()] if facts else []
    known = spark.createDataFrame(marks, "partition_key string, micros long")
    state = known.select(F.lit(dataset).alias("dataset"), "partition_key", F.timestamp_micros("micros").alias("max_period"))
    return state.select(*[F.col(f.name).cast(f.dataType) for f in INGEST_STATE.fields])


def table_months(spark: SparkSession, path: str) -> DataFrame:
    """``month``, ``rows``: how many totals each month holds, as observed when it was written."""
    rows = read_pointer(spark, path).facts.get("rows", {})
    return spark.createDataFrame(sorted(rows.items()), "month string, rows long")


def table_span(spark: SparkSession, path: str) -> DataFrame:
    """One row of the table's ``first_period``, ``last_period`` and ``rows``, as observed when it was written; none without a table."""
    facts = read_pointer(spark, path).facts
    span = [(facts["first"], facts["last"], sum(facts["rows"].values()))] if facts else []
    return spark.createDataFrame(span, "first long, last long, rows long").select(
        F.timestamp_micros("first").alias("first_period"), F.timestamp_micros("last").alias("last_period"), "rows"
    )
