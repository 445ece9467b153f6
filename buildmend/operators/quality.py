"""Pair quality: score, gate and changed-line count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buildmend.functions.text import changed_lines, text_or_empty


def quality_score(log: Column, diff: Column) -> Column:
    """Score of a failure/fix pair in [0, 1].

    The deductions are made one after the other in doubles, since another
    order would round to other values.
    """
    log, diff = text_or_empty(log), text_or_empty(diff)
    lowered = F.lower(log)
    n_changed = changed_lines(diff)
    deductions = [
        (F.length(log) < 100, 0.4),
        (~lowered.contains("error") & ~lowered.contains("failed"), 0.3),
        (F.length(diff) < 20, 0.4),
        (~diff.contains("---") | ~diff.contains("+++"), 0.2),
        (n_changed > 100, 0.3),
        (n_changed == 0, 0.5),
    ]
    score = F.lit(1.0)
    for hit, amount in deductions:
        score = score - F.when(hit, F.lit(amount)).otherwise(F.lit(0.0))
    return F.greatest(score, F.lit(0.0))


def with_quality(df: DataFrame, log: str = "ci_log", diff: str = "fix_diff") -> DataFrame:
    """Add ``quality_score``; a score already stored on the record stands."""
    score = quality_score(F.col(log), F.col(diff))
    if "quality_score" in df.columns:
        score = F.coalesce(F.col("quality_score"), score)
    return df.withColumn("quality_score", score)


def quality_gate(
    df: DataFrame, min_confidence: float = 0.65, min_quality: float = 0.6
) -> DataFrame:
    """Keep pairs that are sure, known, fixed and of good quality."""
    return df.filter(
        (F.coalesce(F.col("classification_confidence"), F.lit(0.5)) >= min_confidence)
        & (F.coalesce(F.col("failure_class"), F.lit("UNKNOWN")) != "UNKNOWN")
        & F.coalesce(F.col("has_fix"), F.lit(False))
        & (F.col("quality_score") >= min_quality)
    )


def diff_line_count(df: DataFrame, diff: str = "fix_diff") -> DataFrame:
    return df.withColumn("changed_lines", changed_lines(F.col(diff)))
