"""Session settings and the shared folder used for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

R = TypeVar("R")
_LOCAL_FOLDERS: dict[str, str] = {}
_RUN_FOLDER: ContextVar[str | None] = ContextVar("run_folder", default=None)


def build_session(app_name: str = "steploom", **conf: str) -> SparkSession:
    """Session with the settings every operator here assumes.

    Times are UTC.  AQE picks the partition count after each shuffle, turns small
    join sides into broadcasts once their size is known and splits skewed ones.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as the session names it.

    Only a local session that names none gets a folder of its own; on a cluster a
    machine-local folder would lose data with the executor, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="steploom-")
    return _LOCAL_FOLDERS[app]


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for what a job stores on its way; it is removed when the job ends, well or not.

    For jobs that write their results elsewhere.  Tables returned to the caller may still
    read what was stored, so steps that return tables use no such folder of their own.
    """
    path = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"
    token = _RUN_FOLDER.set(path)
    try:
        yield path
    finally:
        _RUN_FOLDER.reset(token)
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the job's or the shared folder that no other run uses."""
    return f"{_RUN_FOLDER.get() or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def checkpoint_folder(spark: SparkSession) -> None:
    """Make sure that long iterations can cut their lineage in the shared folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))


def side_by_side(spark: SparkSession, steps: Iterable[Callable[[], R]], limit: int = 4) -> list[R]:
    """Run independent steps at the same time, so small jobs fill the cluster together.

    Each step only builds and submits Spark jobs; results keep the order of the steps.
    """
    with ThreadPoolExecutor(max_workers=limit) as pool:
        started = [pool.submit(copy_context().run, inheritable_thread_target(spark)(step)) for step in steps]
        return [f.result() for f in started]


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage on durable storage (a lost executor does not recompute it),
    keeps column pruning for later readers and gives the planner a real size.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
