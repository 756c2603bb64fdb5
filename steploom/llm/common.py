"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spaces between words: U+0020 and U+0009 to U+000D, nothing else.
SPACE_CLASS = "[\\x20\\x09-\\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Words of a text in order; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), "")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def spare_name(df: DataFrame, stem: str) -> str:
    """A column name that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    return stem if stem not in taken else f"{stem}_{uuid.uuid4().hex}"


def crc_of(key: Column) -> Column:
    """Unsigned crc32 of a key written as decimal text; NULL stays NULL."""
    return F.crc32(key.cast("string").cast("binary"))
