"""What the operators share: reading a table, Arrow batches, bounded samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_batch(df: DataFrame, make: Callable[[], Callable[[dict[str, list]], dict[str, list]]], schema: str) -> DataFrame:
    """Map Arrow batches to Arrow batches, as lists by column name.

    ``make`` runs once in each task and returns the function of a batch, so a
    model or an automaton is set up once. Batches bound the memory of a task,
    whatever the size of its partition.
    """
    fields = df.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out, fn = to_arrow_schema(fields), make()
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                piece = batch.slice(start, BATCH_ROWS)
                got = fn({name: piece.column(i).to_pylist() for i, name in enumerate(piece.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(got[f.name], f.type) for f in out], schema=out)

    return df.mapInArrow(run, fields)


#: Rows that a task holds as Python objects at a time.
BATCH_ROWS = 512


def unit_hash(*cols: Column | str, seed: int = 0) -> Column:
    """A number in (0, 1) that depends on the columns alone."""
    h = F.xxhash64(F.lit(seed), *[F.col(c) if isinstance(c, str) else c for c in cols])
    return (F.pmod(h, F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def bounded_sample(df: DataFrame, rows: int, group: str, groups: dict, seed: int, *key: str) -> DataFrame:
    """About ``rows`` rows of each group, by a hash of ``key``.

    ``groups`` holds the row count of each group. A group with fewer rows is
    taken whole. The expected size is bounded; no row is sorted or collected.
    """
    share = F.lit(0.0)
    for value, n in groups.items():
        share = F.when(F.col(group) == F.lit(value), F.lit(min(1.0, rows / max(n, 1)))).otherwise(share)
    return df.filter(unit_hash(*key, seed=seed) < share)


def range_of(value: Column, splitters: list, literal=lambda v: F.lit(v).cast("long")) -> Column:
    """Number of sorted ``splitters`` not above ``value``, by a two-level search.

    ``literal`` turns a splitter into a column. The search costs about twice
    the root of their number and stays in the JVM.
    """
    if not splitters:
        return F.lit(0)
    step = max(1, int(len(splitters) ** 0.5))
    blocks = [splitters[i : i + step] for i in range(0, len(splitters), step)]

    def pack(some: list) -> Column:
        return F.array(*[literal(s) for s in some])

    block = F.size(F.filter(pack([b[0] for b in blocks]), lambda s: s <= value))
    inside = F.size(F.filter(F.element_at(F.array(*[pack(b) for b in blocks]), block), lambda s: s <= value))
    return F.when(block == 0, 0).otherwise((block - 1) * step + inside)
