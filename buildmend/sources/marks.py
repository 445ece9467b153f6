"""Folders that count once Spark has marked them as written whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Sets the mark where a session has turned it off.
MARK = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


def whole(spark: SparkSession, folders: str) -> list[str]:
    """Those of the folders (a pattern) that Spark has marked as written whole, in order of name."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{folders}/_SUCCESS")
    found = mark.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(mark)
    return sorted(str(f.getPath().getParent()) for f in found or [])


def named(df: DataFrame, folder: str) -> None:
    """Write a table as Parquet, in place of what an attempt that was ended has left, and mark it."""
    df.write.mode("overwrite").option(MARK, True).parquet(folder)
