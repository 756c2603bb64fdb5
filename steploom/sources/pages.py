"""Landed response pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LANDED_PAGE, READING


def flatten_pages(pages: DataFrame, *extra: str) -> DataFrame:
    """Reading rows of page envelopes, each with the total its page reports."""
    rows = pages.select(
        F.col("response.total").try_cast("long").alias("reported_total"),
        *extra,
        F.explode("response.data").alias("_reading"),
    )
    return rows.select(*[F.col("_reading")[n].alias(n) for n in READING.fieldNames()], "reported_total", *extra)


def read_landed_pages(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Readings of all pages below ``path``.

    One page per line lets Spark split files; ``multi_line`` is for pretty-printed
    pages, one per file.  Pages in ``pull=<name>`` folders also get that column.
    """
    pages = spark.read.schema(LANDED_PAGE).option("multiLine", multi_line).json(path)
    extra = ["pull"] if "pull" in pages.columns else []
    return flatten_pages(pages, *extra)
