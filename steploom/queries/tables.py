"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.evaluate import best_combo, combo_scores, top_combos
from ..operators.views import prepare_actuals as prepare_actual_rows
from ..operators.views import prepare_forecasts as prepare_forecast_rows
from ..plans.tuning import PARAMETERS, grid_combos
from ..schemas import ACTUALS, BEST_PARAMS, FORECASTS, KEYS, PAGE_SIZE, WINDOWS
from ..session import fresh_path, materialize
from ..sources import pages, reports, tables
from .data import actuals, forecasts, hourly_actuals, raw_readings, season_scores
from .registry import query
from .sql import metrics, with_views


@query(with_views("SELECT * FROM hourly", "hourly"), ["period"], ["value"])
def read_series(spark, sf_dir):
    path = fresh_path(spark, "series")
    tables.write_table(hourly_actuals(spark, sf_dir), path)
    missing = tables.read_series(spark, f"{path}-missing", ACTUALS)
    return tables.read_series(spark, path, ACTUALS, required=True).unionByName(missing)


@query(
    "SELECT event_type AS region, event_id, ts AS period, value FROM events",
    ["period"],
    ["value"],
)
def prepare_actuals(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    rows = events.select(F.col("event_type").alias("region"), "event_id", F.col("ts").alias("period"), "value")
    # The same rows once more with values that are no numbers: none of them may stay.
    bad = rows.withColumn("value", F.lit(float("nan")))
    return prepare_actual_rows(rows.unionByName(bad)).withColumn("period", F.date_trunc("second", "period"))


@query(
    with_views("SELECT * FROM hforecasts", "hforecasts"), ["issue_time", "target_time"], ["yhat"]
)
def prepare_forecasts(spark, sf_dir):
    rows = forecasts(spark, sf_dir).withColumn("yhat", F.col("yhat").cast("string"))
    bad = rows.withColumn("yhat", F.lit("unknown"))
    return prepare_forecast_rows(rows.unionByName(bad))


@query(
    """SELECT event_type AS parent, CAST(user_id AS VARCHAR) AS subba,
              strftime(ts, '%Y-%m-%dT%H') AS period, value,
              count(*) OVER (PARTITION BY date_trunc('hour', ts)) AS reported_total
       FROM events""",
    doubles=["value"],
)
def read_landed_pages(spark, sf_dir):
    """Pages written from the events, one per hour, then read back and flattened."""
    path = fresh_path(spark, "pages")
    land_pages(raw_readings(spark, sf_dir)).write.json(path)
    rows = pages.read_landed_pages(spark, path)
    return rows.select("parent", "subba", "period", F.col("value").try_cast("double").alias("value"), "reported_total")


def land_pages(readings, *extra):
    """Page envelopes of text readings: each request asks for one period (of one pull).

    A page takes at most ``PAGE_SIZE`` neighbouring rows of a task, so pages stay small
    however many readings a period has; each reports the total of its request.
    """
    request = ["period", *extra]
    fields = F.struct("parent", "subba", "period", "value", "timezone")
    numbered = readings.withColumn("_page", F.floor(F.monotonically_increasing_id() / PAGE_SIZE))
    grouped = numbered.groupBy(*request, "_page").agg(F.collect_list(fields).alias("data"))
    totals = readings.groupBy(*request).agg(F.count(F.lit(1)).cast("string").alias("total"))
    return grouped.join(totals, request).select(F.struct("total", "data").alias("response"), *extra)


@query(
    with_views(
        """SELECT *, '7d' AS "window" FROM hforecasts UNION ALL SELECT *, '3mo' AS "window" FROM dforecasts""",
        "hforecasts",
        "dforecasts",
    ),
    ["issue_time", "target_time"],
    ["yhat"],
)
def write_table(spark, sf_dir):
    """Two windows written one after the other; the second leaves the first alone."""
    path = fresh_path(spark, "forecasts")
    for key, resolution in (("7d", "hourly"), ("3mo", "daily")):
        rows = forecasts(spark, sf_dir, resolution).withColumn("window", F.lit(key))
        tables.write_table(rows, path, ["window"])
    return tables.read_series(spark, path).select(*FORECASTS.fieldNames(), F.col("window").cast("string"))


def best_documents(spark, sf_dir):
    """Best-params documents of two windows from the season scores."""
    results = materialize(combo_scores(season_scores(spark, sf_dir), ["window", "combo_id"]), "scores")
    best = best_combo(results)
    combos = grid_combos()
    params = spark.createDataFrame([tuple(c.values()) for c in combos], ["combo_id", *PARAMETERS])
    windows = spark.createDataFrame(
        [(w.key, w.resolution, w.horizon) for w in WINDOWS.values()], "window string, resolution string, horizon int"
    )
    counts = results.groupBy("window").agg(F.count(F.lit(1)).cast("int").alias("combos_evaluated"))
    return (
        best.join(params, "combo_id")
        .join(windows, "window")
        .join(counts, "window")
        .select(
            "window",
            "resolution",
            "horizon",
            F.struct(*[F.col(p).cast(BEST_PARAMS["params"].dataType[p].dataType).alias(p) for p in PARAMETERS]).alias("params"),
            F.current_timestamp().alias("tuned_at"),
            F.col("mape").alias("best_mape"),
            "combos_evaluated",
        )
    )


COMBO_VALUES = ", ".join(
    f"({c['combo_id']}, {c['n_estimators']}, {c['max_depth']}, {c['learning_rate']}, {c['min_child_weight']})"
    for c in grid_combos()
)
WINDOW_VALUES = ", ".join(f"('{w.key}', '{w.resolution}', {w.horizon})" for w in WINDOWS.values())
BEST = f"""best AS (
    SELECT c.window_key, w.resolution, w.horizon, p.n_estimators, p.max_depth, p.learning_rate, p.min_child_weight,
           c.mape AS best_mape, c.tried AS combos_evaluated
    FROM (SELECT *, row_number() OVER (PARTITION BY window_key ORDER BY mape, combo_id) AS place,
                 count(*) OVER (PARTITION BY window_key) AS tried FROM combos) AS c
    JOIN (VALUES {COMBO_VALUES}) AS p(combo_id, n_estimators, max_depth, learning_rate, min_child_weight)
      USING (combo_id)
    JOIN (VALUES {WINDOW_VALUES}) AS w(window_key, resolution, horizon) USING (window_key)
    WHERE c.place = 1)"""


@query(
    with_views("SELECT * FROM combos", "combos").replace("\nSELECT * FROM combos", f",\n{BEST}\n")
    + """SELECT window_key AS "window", resolution, horizon, n_estimators, max_depth,
                CAST(learning_rate AS DOUBLE) AS learning_rate, min_child_weight, best_mape,
                CAST(combos_evaluated AS INTEGER) AS combos_evaluated FROM best""",
    doubles=["best_mape"],
)
def write_best_params(spark, sf_dir):
    """Winners stored as documents and read back; windows without one are absent."""
    path = fresh_path(spark, "params")
    tables.write_best_params(best_documents(spark, sf_dir), path)
    stored = tables.read_best_params(spark, path)
    return stored.select(
        "window", "resolution", "horizon",
        *[F.col("params")[p].alias(p) for p in ("n_estimators", "max_depth", "learning_rate", "min_child_weight")],
        "best_mape", "combos_evaluated",
    )


@query(
    with_views(
        """SELECT window_key AS "window", CAST(combo_id AS INTEGER) AS combo_id, mape, n_series FROM combos
           ORDER BY mape, combo_id LIMIT 15""",
        "combos",
    ),
    doubles=["mape"],
)
def write_csv(spark, sf_dir):
    """The ranked grid table as CSV, read back."""
    path = fresh_path(spark, "csv")
    results = combo_scores(season_scores(spark, sf_dir), ["window", "combo_id"])
    tables.write_csv(top_combos(results), path)
    return spark.read.option("header", True).schema("window string, combo_id int, mape double, n_series long").csv(path)


def _report_text(sums):
    """One text per day in the layout of a backtest report."""
    show = lambda c: F.format_string("%.10f", c)
    parts = ("mae", "rmse", "mape", "smape")
    line = F.concat_ws("  ", "region", "series", F.col("n").cast("string"), *[show(p) for p in parts])
    head = F.concat_ws("  ", *[show(f"all.{p}") for p in parts], F.col("all.n").cast("string"))
    rows = sums.withColumn("line", line).groupBy("day", "all").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    return rows.select(
        "day",
        F.concat_ws(
            "\n",
            F.lit("Errors of one day\n\nOverall metrics\n   mae   rmse   mape   smape   n"),
            head,
            F.lit("\nPer-series metrics\nregion  series  n  mae  rmse  mape  smape"),
            F.concat_ws("\n", "lines"),
            F.lit("end of report"),
        ).alias("value"),
    )


def written_reports(spark, sf_dir):
    """Daily backtest reports as text files, one per day."""
    from ..functions.errors import by_series, error_sums, overall
    from ..operators.evaluate import join_actual_forecast

    seen = actuals(spark, sf_dir)
    joined = join_actual_forecast(seen, forecasts(spark, sf_dir, seen=seen))
    day = F.date_format("period", "yyyy-MM-dd")
    sums = materialize(error_sums(joined.withColumn("day", day), ["day", *KEYS]), "sums")
    pooled = overall(sums, ["day"])
    pooled = pooled.select("day", F.struct(*[c for c in pooled.columns if c != "day"]).alias("all"))
    path = fresh_path(spark, "reports")
    _report_text(by_series(sums, ["day", *KEYS]).join(pooled, "day")).write.partitionBy("day").text(path)
    return path


def _day():
    return F.regexp_extract("report", r"day=([0-9-]+)", 1).alias("day")


@query(
    with_views(
        f"""SELECT strftime(period, '%Y-%m-%d') AS day, region, series,
                   CAST(n AS DOUBLE) AS n, mae, rmse, mape, smape
            FROM (SELECT {metrics("date_trunc('day', period) AS period, region, series")} FROM joined
                  GROUP BY date_trunc('day', period), region, series)""",
        "joined",
    ),
    doubles=["mae", "rmse", "mape", "smape"],
)
def parse_series_reports(spark, sf_dir):
    _, rows = reports.parse_metric_reports(spark, written_reports(spark, sf_dir))
    return rows.select(_day(), *KEYS, "n", "mae", "rmse", "mape", "smape")


@query(
    with_views(
        f"""SELECT strftime(period, '%Y-%m-%d') AS day, mae, rmse, mape, smape, CAST(n AS DOUBLE) AS n
            FROM (SELECT {metrics("date_trunc('day', period) AS period")} FROM joined
                  GROUP BY date_trunc('day', period))""",
        "joined",
    ),
    doubles=["mae", "rmse", "mape", "smape"],
)
def parse_overall_reports(spark, sf_dir):
    rows, _ = reports.parse_metric_reports(spark, written_reports(spark, sf_dir))
    return rows.select(_day(), "mae", "rmse", "mape", "smape", "n")
