"""Parquet, JSON and CSV tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import BEST_PARAMS


def read_series(
    spark: SparkSession, path: str, schema: StructType | None = None, required: bool = False
) -> DataFrame:
    """Scan a Parquet table; a missing one is empty, or an error when required.

    Column pruning and filters on the result reach the scan.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        if required or schema is None:
            raise FileNotFoundError(f"no table at {path}") from error
        return spark.createDataFrame([], schema)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a table.

    With partition columns only the partitions present in ``df`` are replaced, so
    writing one forecast window leaves the others alone and a job may read the
    table it updates.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Export a result table with a header line."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_best_params(best: DataFrame, path: str) -> None:
    """Store the winners, one JSON document and one folder per window."""
    documents = best.select(*[F.col(f.name).cast(f.dataType) for f in BEST_PARAMS.fields])
    documents.write.mode("overwrite").partitionBy("window").option("partitionOverwriteMode", "dynamic").json(path)


def read_best_params(spark: SparkSession, path: str) -> DataFrame:
    """Stored winners; windows never tuned or stored without parameters are absent."""
    try:
        stored = spark.read.schema(BEST_PARAMS).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], BEST_PARAMS)
    some = F.coalesce(*[F.col("params")[f.name].cast("double") for f in BEST_PARAMS["params"].dataType.fields])
    return stored.where(some.isNotNull()).select(*BEST_PARAMS.fieldNames())
