"""Session helper and the folder all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tidemark import files


def get_spark(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator here is written for.

    Nothing is set that a cluster would want to choose itself: memory,
    executors and shuffle partitions come from the caller or the cluster.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables that every executor can reach.

    Taken from ``spark.checkpoint.dir``. Only a local session without that
    setting gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured is None:
        if context.getCheckpointDir() is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            own = tempfile.mkdtemp(prefix="tidemark-")
            atexit.register(shutil.rmtree, own, ignore_errors=True)
            context.setCheckpointDir(own)
        configured = context.getCheckpointDir()
    elif context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured.rstrip("/")


_released_at_exit: set[str] = set()


def _session_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tidemark/{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> None:
    """Remove all intermediate tables of the session; frames that read them end with it."""
    files.remove(files.folder(spark, _session_root(spark)))


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under :func:`shared_dir` no other run uses, removed when the driver exits."""
    root = _session_root(spark)
    if root not in _released_at_exit:
        _released_at_exit.add(root)
        atexit.register(files.remove, files.folder(spark, root), quiet=True)
    return f"{root}/{label}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning, _cleaning_lock = {"jobs": 0, "before": None}, threading.Lock()


@contextmanager
def _shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside go when a query ends, not when the driver
    happens to collect its plan. The session's own setting is back afterwards."""
    with _cleaning_lock:
        if not _cleaning["jobs"]:
            _cleaning["before"] = spark.conf.get(_CLEANUP, "false")
            spark.conf.set(_CLEANUP, "true")
        _cleaning["jobs"] += 1
    try:
        yield
    finally:
        with _cleaning_lock:
            _cleaning["jobs"] -= 1
            if not _cleaning["jobs"]:
                spark.conf.set(_CLEANUP, _cleaning["before"])


def materialised(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written once as a table in the shared folder.

    For rows that several parts of a plan read, which would each scan the
    source again, or that must not be numbered twice. The table outlives a lost
    executor, and unlike a checkpointed RDD it is read by column and its size is
    known to the planner. What was shuffled to make it is removed at once.
    """
    path = fresh_path(df.sparkSession, "cut")
    with _shuffles_released(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(stored: DataFrame) -> None:
    """Remove a table of :func:`materialised` that nothing reads any more."""
    spark = stored.sparkSession
    own = f"/tidemark/{spark.sparkContext.applicationId}/cut-"
    for path in {file.rpartition("/")[0] for file in stored.inputFiles()}:
        if own in path:
            files.remove(files.folder(spark, path), quiet=True)
