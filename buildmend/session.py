"""Session helpers: the shared scratch folder and lineage cuts."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_MADE: dict[str, list[str]] = {}  # paths by application
_STEP: ContextVar[list[str] | None] = ContextVar("step", default=None)  # paths of the innermost step


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    Where the setting is missing, a plain local master gets a folder of its
    own, as in tests; a cluster gets an error, since a machine-local folder
    would be invisible to the other executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = named or spark.sparkContext.getCheckpointDir()
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="buildmend-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, removed when the job releases it or ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    if _STEP.get() is not None:
        _STEP.get().append(path)
    return path


@contextlib.contextmanager
def step(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch tables made inside as soon as it ends; its results are to be written by then."""
    made: list[str] = []
    token = _STEP.set(made)
    try:
        yield
    finally:
        _STEP.reset(token)
        remove(spark, made)
        rest = _MADE.get(spark.sparkContext.applicationId, [])
        rest[:] = [path for path in rest if path not in set(made)]


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage: write a table to the shared folder and read it back.

    The rows survive the loss of executors, so a later stage never recomputes
    an iterative job from its start. Unlike a checkpoint the table is read by
    column and has a known size, by which Spark picks its joins.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Remove all scratch tables of this application; results that read them are to be used before."""
    remove(spark, _MADE.pop(spark.sparkContext.applicationId, []))


def remove(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@atexit.register
def _release_last() -> None:
    with contextlib.suppress(Exception):  # the JVM may have gone first
        spark = SparkSession.getActiveSession()
        if spark is not None and not spark.sparkContext._jsc.sc().isStopped():
            release(spark)
