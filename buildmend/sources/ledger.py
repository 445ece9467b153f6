"""Reading a folder of files as it grows: a ledger of file versions.

A version of a file is its place, size and time. Spark's file listing knows
these without opening a file, and the ledger holds those that a batch has
claimed. A pass reads only the files of versions that are not in the ledger:

1. The new versions are claimed: written to the ledger as one numbered batch.
2. Their rows are appended to the target under the same number.

A batch that is claimed and not appended (the job was killed in between) is
appended by the next pass, with the files that it claimed then. So a version is
read by one batch only and its rows are added once. A file that changes is a
new version; `current_rows` takes each file's rows from its newest batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from buildmend.sources.jsonl import JSONL_FILES, append_batch, read_batches
from buildmend.sources.marks import named, whole

#: Files that one batch claims: a plan names its files. More files make more batches.
FILES_PER_BATCH = 10_000
VERSION = ["source_file", "bytes", "modified"]


def versions(spark: SparkSession, path: str, files: str = JSONL_FILES) -> DataFrame:
    """(source_file, bytes, modified) of all files below ``path``; none is opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", files).load(path)
    return listed.select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("length").alias("bytes"),
        F.unix_micros("modificationTime").alias("modified"),
    )


def claims(spark: SparkSession, ledger: str) -> DataFrame:
    """(source_file, bytes, modified, batch) of all versions that were claimed."""
    folders = whole(spark, f"{ledger.rstrip('/')}/batch=*")
    schema = "source_file string, bytes long, modified long, batch string"
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", ledger).parquet(*folders)


def new_versions(spark: SparkSession, path: str, ledger: str, files: str = JSONL_FILES) -> DataFrame:
    """Versions that no batch has claimed."""
    return versions(spark, path, files).join(claims(spark, ledger).select(VERSION), VERSION, "left_anti")


def _numbers(spark: SparkSession, folder: str) -> list[str]:
    return [f.rsplit("batch=", 1)[1] for f in whole(spark, f"{folder.rstrip('/')}/batch=*")]


def read_claimed(spark: SparkSession, path: str, ledger: str, batch: str, schema: StructType | str, files: str = JSONL_FILES) -> DataFrame:
    """Rows of the files that a batch claimed, with their ``source_file``.

    The files are named in the plan, so that Spark leaves all others out ahead
    of opening them; a batch has a bounded number of them. Files that are gone
    by now give no rows.
    """
    mine = [r[0] for r in claims(spark, ledger).filter(F.col("batch") == batch).select("source_file").collect()]
    return (
        spark.read.schema(schema)
        .option("mode", "DROPMALFORMED")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", files)
        .option("ignoreMissingFiles", True)
        .json(path)
        .withColumn("source_file", F.col("_metadata.file_path"))
        .filter(F.col("_metadata.file_path").isin(mine))
    )


def ingest(
    spark: SparkSession,
    path: str,
    target: str,
    ledger: str,
    schema: StructType | str,
    change: Callable[[DataFrame], DataFrame] | None = None,
    files: str = JSONL_FILES,
    files_per_batch: int = FILES_PER_BATCH,
) -> list[str]:
    """Append the rows of all files of ``path`` that are new or have changed; returns the batches appended.

    ``change`` maps rows (with ``source_file``) on their way; it must keep that
    column. Blank and malformed lines are left out, empty files are claimed and
    give no rows. Batches left over from a killed pass come first. One pass at
    a time works on a ledger.
    """
    done = []

    def append(batch: str) -> None:
        rows = read_claimed(spark, path, ledger, batch, schema, files)
        append_batch(change(rows) if change else rows, target, batch)
        done.append(batch)

    claimed, appended = _numbers(spark, ledger), set(_numbers(spark, target))
    for batch in claimed:
        if batch not in appended:
            append(batch)
    last = max(map(int, claimed), default=0)
    # The oldest first, so that batches follow time; a bounded number for each batch, until none is left.
    while (fresh := new_versions(spark, path, ledger, files).orderBy("modified", "source_file").limit(files_per_batch)).head(1):
        last += 1
        named(fresh, f"{ledger.rstrip('/')}/batch={last:012d}")
        append(f"{last:012d}")
    return done


def current_rows(spark: SparkSession, target: str, ledger: str, schema: StructType | str) -> DataFrame:
    """Rows of each file's newest batch; ``schema`` is that of the rows without ``source_file``."""
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = read_batches(spark, target, StructType(fields.fields).add("source_file", "string"))
    newest = claims(spark, ledger).groupBy("source_file").agg(F.max("batch").alias("batch"))
    return rows.join(newest, ["source_file", "batch"], "left_semi").select(*fields.names, "source_file")
