"""Streams: newly failed runs, and requests for repair."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from buildmend.functions.text import text_or_empty
from buildmend.operators.classify import fix_strategy, top_class

POLL = "300 seconds"


def landed_files(spark: SparkSession, path: str, schema: StructType | str, files_per_batch: int | None = None) -> DataFrame:
    """Stream over the JSON-lines files that land below ``path``."""
    reader = spark.readStream.schema(schema).option("mode", "DROPMALFORMED")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def classified_failures(runs: DataFrame) -> DataFrame:
    """Failed runs with their class and standard fix."""
    known = top_class(runs.filter(F.col("conclusion") == "failure")).withColumnsRenamed(
        {
            "heuristic_class": "failure_class",
            "heuristic_subclass": "failure_subclass",
            "heuristic_confidence": "confidence",
        }
    )
    return known.withColumn("fix_strategy", fix_strategy(F.col("failure_subclass")))


#: Keys that were seen are kept in RocksDB on the executors; a poll writes what it changed, not the whole state.
KEYED_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Settings that hold for what is started inside; the session keeps its own."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def first_failures(runs: DataFrame, keys: list[str] = ["repo", "run_id"], known: DataFrame | None = None) -> DataFrame:
    """Each failed run of a stream once, however often and however late it comes.

    The keys seen are keyed state of the stream, without a watermark: nothing
    is too old, and a poll looks up the keys that it brings and no others.
    Keys without a value are equal. ``known`` is a static table of runs that
    were handled before this stream had any state, as when it takes over.
    """
    failed = runs.filter(F.col("conclusion") == "failure")
    if known is not None:
        same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in keys))
        failed = failed.join(known.select(*[F.col(k).alias(f"_known_{k}") for k in keys]), same, "left_anti")
    return failed.dropDuplicates(keys)


def watch_failures(
    runs: DataFrame,
    output: str,
    checkpoint: str,
    keys: list[str] = ["repo", "run_id"],
    once: bool = False,
    poll: str = POLL,
    known: DataFrame | None = None,
) -> StreamingQuery:
    """Classify each failed run once and add it to the Parquet table ``output``.

    ``runs`` (repo, run_id, conclusion, created_at, ci_log) may repeat runs and
    bring them in any order, however late. The keys of runs that were seen are
    in the state of the stream (see ``first_failures``), so that the cost of a
    poll follows what has landed and not what is in the table, which is never
    read. State, progress and the list of the table's files are committed
    together by batch: a batch that is tried again adds nothing twice, and a
    restart with the same ``checkpoint`` goes on where it was.
    """
    fresh = classified_failures(first_failures(runs, keys, known))
    with settings(runs.sparkSession, KEYED_STATE):
        return run_to_files(fresh, output, checkpoint, once=once, poll=poll)


def watched(spark: SparkSession, output: str, runs: StructType | str) -> DataFrame:
    """What ``watch_failures`` has written to ``output``; no rows where no run has failed yet."""
    shape = classified_failures(spark.createDataFrame([], runs)).schema
    return spark.read.schema(shape).parquet(output)


def repair_requests(requests: DataFrame) -> DataFrame:
    """Requests marked queued, or rejected where repository or run are missing."""
    complete = (text_or_empty(F.col("repo")) != "") & (F.coalesce(F.col("run_id"), F.lit(0)) != 0)
    return requests.withColumn("status", F.when(complete, "queued").otherwise("rejected")).withColumn(
        "error", F.when(~complete, "repo and run_id required")
    )


def run_to_files(
    stream: DataFrame,
    output: str,
    checkpoint: str,
    partition_by: list[str] | None = None,
    once: bool = False,
    poll: str = POLL,
) -> StreamingQuery:
    """Write a stream to Parquet files exactly once.

    ``once`` takes what has landed and stops; otherwise the folder is looked
    at every ``poll``.
    """
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", output)
    writer = writer.option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=poll)
    return writer.start()
