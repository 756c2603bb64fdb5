"""Metric tables out of plain-text backtest reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Section titles and columns of a report, and how it writes numbers.
OVERALL_TITLE = "Overall metrics"
SERIES_TITLE = "Per-series metrics"
OVERALL_COLUMNS = ("mae", "rmse", "mape", "smape", "n")
SERIES_COLUMNS = ("region", "series", "n", "mae", "rmse", "mape", "smape", "aic", "bic", "hqic")
NUMBER = r"[-+]?\d*\.?\d+"
#: Fields at the end of a series line: a count and four errors, or those and three criteria.
_SHORT, _LONG = 5, 8


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """One row per report file: its path and its lines in order."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(
        F.input_file_name().alias("report"), F.split("value", r"\r\n|\r|\n").alias("lines")
    )


def _number(text: Column) -> Column:
    return F.when(text != "", text).try_cast("double")


def _fields(line: Column) -> Column:
    """What stands between the white space of a line."""
    return F.filter(F.split(line, r"\s+"), lambda x: x != "")


def overall_rows(reports: DataFrame) -> DataFrame:
    """The pooled metrics of each report.

    The title is followed by a header line and a value line; the first title whose
    two lines have equally many fields counts.
    """
    count = F.size("lines")
    places = F.filter(
        F.sequence(F.lit(1), count),
        lambda i: (F.trim(F.element_at("lines", i)) == OVERALL_TITLE)
        & (i + 2 <= count)
        & (F.size(_fields(F.try_element_at("lines", i + 1))) == F.size(_fields(F.try_element_at("lines", i + 2)))),
    )
    found = reports.withColumn("_at", F.try_element_at(places, F.lit(1))).where(F.col("_at").isNotNull())
    cells = found.select(
        "report",
        _fields(F.element_at("lines", F.col("_at") + 1)).alias("_names"),
        _fields(F.element_at("lines", F.col("_at") + 2)).alias("_values"),
    )
    cell = lambda name: F.when(
        F.array_position("_names", F.lit(name)) > 0,
        F.element_at("_values", F.array_position("_names", F.lit(name)).cast("int")),
    )
    return cells.select("report", *[_number(cell(c)).alias(c) for c in OVERALL_COLUMNS])


def series_rows(reports: DataFrame) -> DataFrame:
    """The per-series metrics of each report; lines of another shape are skipped."""
    start = F.array_position(F.transform("lines", lambda line: F.trim(line)), F.lit(SERIES_TITLE))
    tail = F.slice("lines", start.cast("int") + 1, F.size("lines"))
    lines = reports.where(start > 0).select("report", F.explode(tail).alias("line"))
    rows = lines.where(~F.ltrim("line").startswith("region")).select("report", _fields(F.col("line")).alias("_cells"))
    rows = rows.withColumn(
        "_tail", F.when(_ends_in(_LONG), F.lit(_LONG)).when(_ends_in(_SHORT), F.lit(_SHORT))
    ).where(F.col("_tail").isNotNull())
    named = F.size("_cells") - F.col("_tail")
    cell = lambda i: F.try_element_at("_cells", named + i + 1)
    return rows.select(
        "report",
        F.element_at("_cells", 1).alias("region"),
        F.array_join(F.slice("_cells", F.lit(2), named - 1), " ").alias("series"),
        *[_number(cell(i)).alias(name) for i, name in enumerate(SERIES_COLUMNS[2:])],
    )


def _ends_in(count: int) -> Column:
    """Whether a line has a region, a series and then ``count`` numbers, the first of them whole."""
    tail = F.slice("_cells", -count, count)
    return (
        (F.size("_cells") >= count + 2)
        & F.element_at("_cells", -count).rlike(r"^\d+$")
        & F.forall(tail, lambda x: x.rlike(f"^{NUMBER}$"))
    )


def parse_metric_reports(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Overall and per-series metrics of all reports below ``path``."""
    reports = read_reports(spark, path)
    return overall_rows(reports), series_rows(reports)
