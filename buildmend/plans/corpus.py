"""Whole jobs: from records to a failure report and to a training corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buildmend.operators.classify import class_distribution, fix_strategy, top_class
from buildmend.operators.dedup import near_dedup
from buildmend.operators.quality import quality_gate, with_quality
from buildmend.operators.shaping import keyed_order
from buildmend.session import durable
from buildmend.sources.jsonl import write_jsonl
from buildmend.sources.records import with_ci_log


def failure_report(records: DataFrame) -> DataFrame:
    """Which classes the failures fall in, and the standard fix of each sub-class."""
    classified = top_class(records).select("heuristic_class", "heuristic_subclass")
    return (
        classified.groupBy(
            F.col("heuristic_class").alias("failure_class"), F.col("heuristic_subclass").alias("failure_subclass")
        )
        .agg(F.count(F.lit(1)).alias("n_records"))
        .withColumn("fix_strategy", fix_strategy(F.col("failure_subclass")))
    )


def training_corpus(
    classified: DataFrame,
    key: str = "id",
    order: list[str] | None = None,
    min_confidence: float = 0.65,
    min_quality: float = 0.6,
) -> DataFrame:
    """Classified records without near-duplicates that pass the quality gate.

    Duplicates are removed ahead of the gate: a poor record that comes first
    takes its later copies with it.
    """
    distinct = near_dedup(with_ci_log(classified), key, order)
    return quality_gate(with_quality(distinct), min_confidence, min_quality)


def write_corpus(corpus: DataFrame, path: str, key: str = "id", seed: int = 42) -> DataFrame:
    """Write the corpus in seeded random order; returns its class distribution.

    The records are a table ahead of the sort, which reads its input twice:
    once for the bounds of its ranges.
    """
    write_jsonl(durable(corpus).orderBy(*keyed_order(key, seed)), path)
    return class_distribution(corpus.sparkSession.read.json(path))
