"""Registered queries and the SQL each one is compared with."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, TimestampType

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_TIME_TEXT = "yyyy-MM-dd HH:mm:ss"


def present(df: DataFrame, digits: int) -> DataFrame:
    """Times as text and doubles rounded, so results compare across engines."""
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, TimestampType):
            c = F.date_format(c, _TIME_TEXT)
        elif isinstance(field.dataType, DoubleType):
            c = F.round(c, digits)
        columns.append(c.alias(field.name))
    return df.select(*columns)


def query(
    sql: str | None = None, times: Sequence[str] = (), doubles: Sequence[str] = (), digits: int = 7
) -> Callable:
    """Register a query under its function's name.

    ``times`` and ``doubles`` name the columns of ``sql`` that get the same
    presentation as the Spark result.
    """

    def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return present(fn(spark, sf_dir), digits)

        QUERIES[fn.__name__] = run
        if sql is not None:
            shown = [f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in times]
            shown += [f"round({c}, {digits}) + 0.0 AS {c}" for c in doubles]
            star = f"* REPLACE ({', '.join(shown)})" if shown else "*"
            ORACLES[fn.__name__] = f"SELECT {star} FROM ({sql.strip()}) AS result"
        return fn

    return register
