"""Run logs put together from the files of a log archive."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from buildmend.functions.text import any_contains, cut, text_or_empty

# Name words that go first.
FIRST_WORDS = ["test", "build", "check", "lint"]
AGENT_FIRST_WORDS = ["test", "build", "check"]

# Neighbouring parts whose lengths are added up together.
PARTS_PER_PIECE = 1024


def leading_parts(placed: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """The parts of each run that can reach into its first ``limit`` characters.

    Lengths are added up by piece ahead of any sort of the parts themselves,
    so a run with a large share of all rows stays spread over many tasks.
    """
    place = [*keys, "_rank", "_piece"]
    pieces = placed.withColumn("_piece", F.floor(F.col("_place") / PARTS_PER_PIECE))
    in_order = (
        Window.partitionBy(*keys).orderBy("_rank", "_piece").rowsBetween(Window.unboundedPreceding, -1)
    )
    needed = (
        pieces.groupBy(*place)
        .agg(F.sum(F.length("text") + 1).alias("_chars"))
        .withColumn("_start", F.coalesce(F.sum("_chars").over(in_order), F.lit(0)))
        .filter(F.col("_start") <= limit)
        .select(*place)
    )
    return pieces.join(needed, place, "left_semi").drop("_piece")


def assemble_log_parts(
    parts: DataFrame, keys: list[str], words: list[str] = FIRST_WORDS, limit: int | None = None
) -> DataFrame:
    """One log per run from ``parts`` (keys, part_no, name, text).

    Parts named after tests and builds go first, the last of them foremost;
    the others follow in order. With ``limit`` the log is cut to so many
    characters, and parts that cannot reach into them are left out ahead of
    the sort; the plan is the same for all runs.
    """
    first = any_contains(F.lower(text_or_empty(F.col("name"))), words)
    placed = parts.select(
        *keys,
        F.when(first, 0).otherwise(1).alias("_rank"),
        F.when(first, -F.col("part_no")).otherwise(F.col("part_no")).alias("_place"),
        cut(text_or_empty(F.col("text")), limit).alias("text"),
    )
    if limit is not None:
        placed = leading_parts(placed, keys, limit)
    listed = F.array_sort(F.collect_list(F.struct("_rank", "_place", "text")))
    return placed.groupBy(*keys).agg(
        cut(F.array_join(F.transform(listed, lambda p: p["text"]), "\n"), limit).alias("ci_log")
    )
