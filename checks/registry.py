"""The list of registered queries with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.views import ctes, spark_view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Views of one data folder by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self.made = spark, sf_dir, {}

    def __getattr__(self, name: str) -> DataFrame:
        return spark_view(self.spark, self.sf_dir, name, self.made)


def query(name: str, needs: list[str] | None = None, sql: str | None = None, steps: str = "", recursive: bool = False):
    """Register a query; ``sql`` with its ``steps`` (further CTEs) is the oracle."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql is not None:
            head = [part for part in (ctes(needs or []), steps.strip()) if part]
            word = "WITH RECURSIVE " if recursive else "WITH "
            ORACLES[name] = (word + ",\n".join(head) + "\n" if head else "") + sql.strip()
        return build

    return register
