"""Operators over ordered groups that hold when one group has most rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from buildmend.session import durable


def next_value(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: Column,
    chunk: Column,
    into: str = "next_value",
) -> DataFrame:
    """Add the next non-null ``value`` strictly behind each row of its group.

    A plain window would sort a whole group in one task. Here ``chunk``, which
    must never fall as ``order`` rises, cuts each group into pieces of bounded
    size: a window looks ahead inside the piece, and a small table with the
    first value of every piece answers for the rows that reach its end. Rows
    are shuffled once, by group and piece.
    """
    rows = df.withColumn("_chunk", chunk).withColumn("_value", value)
    backwards = [F.col(c).desc() for c in order]
    ahead = (
        Window.partitionBy(*keys, "_chunk").orderBy(*backwards)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = rows.withColumn("_inside", F.last("_value", ignorenulls=True).over(ahead))

    pieces = rows.groupBy(*keys, "_chunk").agg(
        F.min_by("_value", F.when(F.col("_value").isNotNull(), F.struct(*order))).alias("_first")
    )
    later = (
        Window.partitionBy(*keys).orderBy(F.col("_chunk").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    beyond = pieces.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_chunk").alias("_kc"),
        F.last("_first", ignorenulls=True).over(later).alias("_beyond"),
    ).filter(F.col("_beyond").isNotNull())

    same = F.col("_chunk").eqNullSafe(F.col("_kc"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return inside.join(beyond, same, "left").select(
        *df.columns, F.coalesce("_inside", "_beyond").alias(into)
    )


def first_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int | None) -> DataFrame:
    """The first ``n`` rows of each group; None keeps all.

    Spark limits each group ahead of the shuffle as well, so a task never
    receives more than ``n`` rows of a group from any one map task.
    """
    if n is None:
        return df
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n).drop("_n")


def numbered(df: DataFrame, order: list[str], into: str) -> DataFrame:
    """Number all rows from 0 in order, without gaps.

    Rows are sorted by ranges; a small table with the size of each range tells
    where its numbers begin. Rows equal in ``order`` get any order, once.
    """
    ranged = durable(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    # One row for each range goes through one task, and no other.
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_base")
    )
    inside = Window.partitionBy("_part").orderBy(*order)
    placed = ranged.withColumn("_place", F.row_number().over(inside) - 1).join(bases, "_part")
    return placed.withColumn(into, F.col("_base") + F.col("_place")).select(*df.columns, into)
