"""From raw readings to merged actuals: cleaning, totals, upserts, watermarks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_double, as_time, series_name
from ..schemas import BACKFILL_HOURS, HISTORY_START, KEYS, PAGE_SIZE, TIMEZONES


def allowed_regions(df: DataFrame, regions: Sequence[str] | DataFrame, column: str = "parent") -> DataFrame:
    """Rows whose region is allowed; the list may be literals or a one-column table."""
    if isinstance(regions, DataFrame):
        names = regions.select(F.col(regions.columns[0]).alias(column)).distinct()
        return df.join(names, column, "left_semi")
    return df.where(F.col(column).isin(list(regions)))


def normalize_readings(df: DataFrame, regions: Sequence[str] | DataFrame, resolution: str = "hourly") -> DataFrame:
    """Typed readings of the allowed regions, without incomplete rows."""
    typed = df.withColumns(
        {
            "period": as_time(df, "period", resolution),
            "value": as_double(df, "value"),
            "parent": F.upper("parent"),
        }
    )
    return allowed_regions(typed, regions).dropna(subset=["period", "value"])


def select_timezone_copy(df: DataFrame, timezone: str = "Eastern") -> DataFrame:
    """Daily readings come once per day-boundary timezone; keep one copy."""
    return df.where(F.col("timezone") == timezone)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Drop readings that overlapping pulls delivered more than once."""
    return df.distinct()


def region_total(
    df: DataFrame,
    regions: Sequence[str] | DataFrame,
    resolution: str = "hourly",
    extra: Sequence[str] = (),
) -> DataFrame:
    """Sum of all sub-area readings per region and period.

    A plain sum combines map-side, so a region with a third of all readings sends
    only one partial row per period and task through the shuffle.
    """
    clean = normalize_readings(df, regions, resolution)
    totals = clean.groupBy(F.col("parent").alias("region"), "period", *extra).agg(F.sum("value").alias("value"))
    return totals.select("region", series_name("region").alias("series"), "period", "value", *extra)


def daily_total(df: DataFrame, timezone: str = "Eastern") -> DataFrame:
    """Daily sums of hourly actuals; the timezone decides where a day begins."""
    local = F.from_utc_timestamp("period", TIMEZONES.get(timezone, timezone))
    return df.groupBy("region", "series", F.date_trunc("day", local).alias("period")).agg(
        F.sum("value").alias("value")
    )


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the one that comes last by ``order``.

    ``max_by`` merges map-side, so many copies of one key never meet in one task.
    """
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*by)).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def upsert_latest(
    existing: DataFrame,
    new: DataFrame,
    keys: Sequence[str] = (*KEYS, "period"),
    order: Sequence[str] = (),
) -> DataFrame:
    """Existing rows with the new ones on top; per key the last row wins.

    ``order`` breaks ties among rows of the same side, which have no order of their own.
    """
    both = existing.withColumn("_batch", F.lit(0)).unionByName(
        new.withColumn("_batch", F.lit(1)), allowMissingColumns=True
    )
    value_cols = [c for c in both.columns if c not in (*keys, "_batch", *order)]
    # The payload itself ends the ordering, so equal orders still give one fixed answer.
    ranked = latest_rows(both, keys, ["_batch", *order, *value_cols])
    return ranked.drop("_batch")


def dedup_periods(df: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[str] = ()) -> DataFrame:
    """Within a series the last row per period, by an explicit order."""
    rest = [c for c in df.columns if c not in (*keys, "period", *order)]
    return latest_rows(df, [*keys, "period"], [*order, *rest])


def watermarks(df: DataFrame, dataset: str, partition_cols: Sequence[str] = KEYS) -> DataFrame:
    """Newest period per partition and overall (``partition_key`` NULL).

    The second grouping runs on one row per partition, not on the readings.  Rows with
    a NULL key belong to no partition and count overall.
    """
    cols = list(partition_cols)
    newest = df.groupBy(*cols).agg(F.max("period").alias("max_period"))
    levels = newest.groupingSets([[F.col(c) for c in cols], []], *[F.col(c) for c in cols]).agg(
        F.max("max_period").alias("max_period"), F.grouping_id().alias("_level")
    )
    named = F.lit(True)
    for c in cols:
        named = named & F.col(c).isNotNull()
    key = F.when(F.col("_level") == 0, F.concat_ws("|", *cols))
    kept = levels.where(F.col("max_period").isNotNull() & ((F.col("_level") > 0) | named))
    return kept.select(
        F.lit(dataset).alias("dataset"), key.alias("partition_key"), "max_period"
    )


def merge_state(state: DataFrame, dataset: str, fresh: DataFrame) -> DataFrame:
    """State with the dataset's rows replaced; an empty update leaves it unchanged."""
    stamped = fresh.where(F.col("partition_key").isNull()).select("dataset")
    keep = state.join(stamped.distinct(), "dataset", "left_anti")
    return keep.unionByName(fresh)


def pull_range(state: DataFrame, datasets: DataFrame, end: Column, history_start: str = HISTORY_START) -> DataFrame:
    """Start and end of the next pull per dataset.

    ``datasets`` has ``dataset`` and ``resolution``.  The start goes back behind the
    stored watermark by the resolution's safety window to catch revisions.
    """
    stored = state.where(F.col("partition_key").isNull()).select("dataset", "max_period")
    back = F.when(F.col("resolution") == "daily", F.make_dt_interval(hours=F.lit(BACKFILL_HOURS["daily"]))).otherwise(
        F.make_dt_interval(hours=F.lit(BACKFILL_HOURS["hourly"]))
    )
    start = F.coalesce(F.col("max_period") - back, F.lit(history_start).cast("timestamp"))
    return datasets.join(stored, "dataset", "left").select(
        "dataset", "resolution", start.alias("start"), end.alias("end")
    )


def trim_history(df: DataFrame, hours: int | None = None, days: int | None = None) -> DataFrame:
    """Recent rows by one cutoff for all series, from the newest period of the table."""
    if (hours is None) == (days is None):
        raise ValueError("give either hours or days")
    back = F.make_dt_interval(hours=F.lit(hours - 1)) if hours is not None else F.make_dt_interval(days=F.lit(days))
    cutoff = df.agg((F.max("period") - back).alias("cutoff"))
    return df.where(F.col("period") >= cutoff.scalar())


def pull_plan(ranges: DataFrame) -> DataFrame:
    """Closed one-month chunks of each pull range.

    A chunk ends an hour before the same day of the next month or at the range end.
    Month arithmetic starts from the previous chunk, so a start on the 31st moves to
    the shorter month's last day and stays there; ``least`` of the days seen so far
    expresses that without a loop.
    """
    month = F.col("_month")
    span = (F.year("end") * 12 + F.month("end")) - (F.year("start") * 12 + F.month("start"))
    starts = ranges.where(F.col("start") <= F.col("end")).withColumn("_months", F.sequence(F.lit(0), span + 1)).withColumn(
        "_starts",
        F.transform(
            "_months",
            lambda m: _month_start(F.col("start"), m),
        ),
    )
    chunks = starts.select("*", F.posexplode(F.slice("_starts", 1, F.size("_starts") - 1)).alias("_month", "lo"))
    following = F.element_at("_starts", month + 2) - F.expr("INTERVAL 1 HOUR")
    return chunks.where(F.col("lo") <= F.col("end")).select(
        "dataset", month.alias("chunk"), "lo", F.least(following, F.col("end")).alias("hi")
    )


def _month_start(start: Column, months: Column) -> Column:
    """``start`` moved by whole months, its day cut to the shortest month on the way."""
    first = F.trunc(start.cast("date"), "month")
    days = F.transform(F.sequence(F.lit(0), months), lambda m: F.dayofmonth(F.last_day(F.add_months(first, m))))
    day = F.least(F.dayofmonth(start), F.array_min(days))
    moved = F.date_add(F.add_months(first, months), day - 1)
    return F.timestamp_micros(
        F.unix_micros(moved.cast("timestamp")) + F.unix_micros(start) - F.unix_micros(F.date_trunc("day", start))
    )


def chunk_coverage(readings: DataFrame, plan: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Rows landed per planned chunk, its page count and whether all reported rows came.

    Readings are counted per dataset and period first; the range join then sees one
    row per period, keyed by dataset and month, and chunks without readings stay.
    """
    counts = readings.groupBy("dataset", "period").agg(F.count(F.lit(1)).alias("_n"))
    months = F.explode(
        F.sequence(F.trunc(F.col("lo").cast("date"), "month"), F.trunc(F.col("hi").cast("date"), "month"), F.expr("INTERVAL 1 MONTH"))
    )
    keyed = plan.withColumn("_m", months)
    hits = keyed.join(
        counts.withColumn("_m", F.trunc(F.col("period").cast("date"), "month")), ["dataset", "_m"], "left"
    )
    inside = F.when(F.col("period").between(F.col("lo"), F.col("hi")), F.col("_n"))
    report = hits.groupBy("dataset", "chunk", "lo", "hi").agg(
        F.coalesce(F.sum(inside), F.lit(0)).cast("long").alias("landed")
    )
    report = report.withColumn("pages", F.ceil(F.col("landed") / PAGE_SIZE).cast("long"))
    if totals is None:
        return report
    return report.join(totals, ["dataset", "chunk"], "left").withColumn(
        "complete", F.col("landed") == F.col("reported")
    )
