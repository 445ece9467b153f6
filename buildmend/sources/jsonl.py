"""Lenient JSON-lines reading and writing."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from buildmend.sources.marks import MARK, whole

# Files as they land, and as Spark itself writes them.
JSONL_FILES = "*.{jsonl,json}"


def read_jsonl(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    with_file: bool = False,
    files: str = JSONL_FILES,
) -> DataFrame:
    """Records of all JSON-lines files below ``path``; blank and malformed lines are left out."""
    df = (
        spark.read.schema(schema)
        .option("mode", "DROPMALFORMED")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", files)
        .json(path)
    )
    return df.withColumn("source_file", F.col("_metadata.file_path")) if with_file else df


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Write JSON lines, replacing or adding to what is there."""
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be 'overwrite' or 'append'")
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)


def append_batch(df: DataFrame, path: str, batch: str) -> bool:
    """Add the rows of one named batch as JSON lines; repeating it adds nothing twice.

    A batch has a folder of its own, ``path/batch=<name>``, and counts once
    Spark has marked that folder as written whole. What an attempt that was
    ended has left is replaced by the next one. A batch that counts already is
    not computed again. One writer at a time may write a batch; different
    batches may be written side by side. Names have letters, digits, ``_``,
    ``.`` and ``-``. An empty batch counts too.

    Returns whether the rows were written by this call.
    """
    if not re.fullmatch(r"[\w.-]+", batch, re.A):
        raise ValueError("a batch is named by letters, digits, '_', '.' and '-'")
    folder = f"{path.rstrip('/')}/batch={batch}"
    if whole(df.sparkSession, folder):
        return False
    df.write.mode("overwrite").option(MARK, True).json(folder)
    return True


def read_batches(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Rows of all batches that were written whole, with their ``batch``; others, begun and not ended, are passed over."""
    folders = whole(spark, f"{path.rstrip('/')}/batch=*")
    reader = spark.read.schema(schema).option("mode", "DROPMALFORMED")
    df = reader.json(folders) if folders else spark.createDataFrame([], schema)
    name = F.regexp_extract(F.col("_metadata.file_path"), "/batch=([^/]+)/[^/]*$", 1) if folders else F.lit("")
    return df.withColumn("batch", name)


def read_json_files(spark: SparkSession, path: str, schema: StructType | str, files: str = "*.json") -> DataFrame:
    """The record or list of records of each file below ``path``, as bench cases are kept."""
    return (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("mode", "DROPMALFORMED")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", files)
        .json(path)
        .withColumn("source_file", F.col("_metadata.file_path"))
    )
