"""Tables by month that change all at once: new folders first, then one small pointer file."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_POINTERS = "_pointers"


@dataclass(frozen=True)
class Pointer:
    """What counts of the tables at a path.

    ``folders``: per table and month the version that counts.  ``facts``: small figures that
    writers keep about the tables.  ``number`` grows by one with every switch; 0 is a path without tables.
    """

    number: int = 0
    folders: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    facts: Mapping[str, Mapping] = field(default_factory=dict)


def _location(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def _children(spark: SparkSession, path: str) -> list[str]:
    files, target = _location(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(target)) if files.exists(target) else []


def read_pointer(spark: SparkSession, path: str) -> Pointer:
    """The newest whole pointer of the tables at ``path``; one that its writer left cut off is passed over."""
    numbers = [int(n) for n in _children(spark, f"{path}/{_POINTERS}") if n.isdigit()]
    for number in sorted(numbers, reverse=True):
        files, target = _location(spark, _pointer_file(path, number))
        stream = files.open(target)
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            stored = json.loads(text)
        except ValueError:
            continue
        return Pointer(max(numbers), stored["folders"], stored["facts"])
    return Pointer(max(numbers, default=0))


def _pointer_file(path: str, number: int) -> str:
    return f"{path}/{_POINTERS}/{number:012d}"


def switch_pointer(spark: SparkSession, path: str, old: Pointer, folders: Mapping, facts: Mapping) -> Pointer:
    """Make new folders count, those of all tables at once.

    The file is made only if it is not there, so of two writers that started from the same
    pointer the second fails and changes nothing.
    """
    new = Pointer(old.number + 1, folders, facts)
    files, target = _location(spark, _pointer_file(path, new.number))
    stream = files.create(target, False)
    try:
        stream.write(json.dumps({"folders": folders, "facts": facts}, sort_keys=True).encode())
    finally:
        stream.close()
    return new


def stored_months(spark: SparkSession, root: str, folders: Mapping[str, str], schema: T.StructType, months: Iterable[str] | None = None) -> DataFrame:
    """Rows of the months that count, or of some of them; ``schema`` ends with ``month``.

    Filters on months and columns reach the scan.
    """
    wanted = folders if months is None else {m: folders[m] for m in months if m in folders}
    if not wanted:
        return spark.createDataFrame([], schema)
    paths = [f"{root}/month={m}/version={v}" for m, v in sorted(wanted.items())]
    full = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
    return spark.read.schema(full).option("basePath", root).parquet(*paths).drop("version")


def write_months(rows: DataFrame, root: str, months: Iterable[str]) -> dict[str, str]:
    """Write rows with a ``month`` beside what is there; the version of each of the ``months``.

    Nothing counts before :func:`switch_pointer` names it.
    """
    version = uuid.uuid4().hex
    rows.withColumn("version", F.lit(version)).write.mode("append").partitionBy("month", "version").parquet(root)
    return dict.fromkeys(months, version)


def clear_versions(spark: SparkSession, root: str, months: Iterable[str], *kept: Mapping[str, str]) -> None:
    """Remove the versions of some months that none of ``kept`` names: old ones, and those of writers that failed.

    Callers keep the versions before the last switch, so that a table read shortly before it can be read to its end.
    """
    for month in months:
        names = {f"version={k[month]}" for k in kept if month in k}
        for child in _children(spark, f"{root}/month={month}"):
            if child not in names:
                files, target = _location(spark, f"{root}/month={month}/{child}")
                files.delete(target, True)


def clear_pointers(spark: SparkSession, path: str, newest: int, keep: int = 2) -> None:
    """Remove all but the last pointers."""
    for name in _children(spark, f"{path}/{_POINTERS}"):
        if name.isdigit() and int(name) <= newest - keep:
            files, target = _location(spark, f"{path}/{_POINTERS}/{name}")
            files.delete(target, False)
