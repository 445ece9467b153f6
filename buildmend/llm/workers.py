"""Memory of reused Python workers between the steps of a job."""

from __future__ import annotations

import ctypes
import gc
import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

#: Tasks for each core, so that every idle worker is likely to get one, and seconds that each keeps its worker.
TASKS, SECONDS = 2, 0.2


def give_back() -> None:
    """Drop what this process keeps for later tasks and return free memory to the system."""
    from buildmend.llm import alignment, decontamination, packing

    decontamination.LAST.clear()
    packing.ids_by.cache_clear()
    alignment.aligner.cache_clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        return


def relieve(spark: SparkSession) -> None:
    """Let idle workers give back their models, indexes and caches ahead of a step that has no use for them.

    Workers are reused from step to step, so that without this each keeps the
    most that any step has asked for. Nothing depends on which workers a task
    reaches: what a worker lacks later it makes again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            pass
        give_back()
        time.sleep(SECONDS)
        yield from ()

    tasks = TASKS * spark.sparkContext.defaultParallelism
    spark.range(0, tasks, 1, tasks).mapInArrow(run, "id long").write.format("noop").mode("overwrite").save()
