"""Best-fit packing planned over a histogram of lengths.

The plan places counts, not documents: for each length, longest first, runs of
equal sequences are filled from the best-fitting free room on. Its size depends
on the length of a sequence alone. Each piece then takes the slot of its rank
among the pieces of its length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from buildmend.llm.common import BATCH_ROWS, by_batch
from buildmend.llm.packing import ids_by
from buildmend.session import durable

#: Fixed value: most tokens of a sequence.
LENGTH = 4096


class Slots(NamedTuple):
    """``count`` pieces of ``size`` tokens from rank ``first`` on: ``per`` in each sequence from ``sequence`` on, behind ``offset``."""

    size: int
    first: int
    count: int
    sequence: int
    per: int
    offset: int


def planned(histogram: dict[int, int], length: int = LENGTH) -> list[Slots]:
    """Best-fit over counts, longest pieces first.

    A run of sequences with equal room takes as many pieces in each as fit,
    since the sequence that was just filled up is the best fit for the next
    piece of the same length as long as it has room. A length splits one run at
    most, so there are at most three runs a length, and none holds more than
    sqrt(2 * length) different lengths: the plan does not grow with the counts.
    """
    free: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []
    out: list[Slots] = []
    made = 0

    def keep(room: int, sequence: int, n: int) -> None:
        if room and n:
            if room not in free:
                free[room] = []
                insort(rooms, room)
            free[room].append((sequence, n))

    for size in sorted(histogram, reverse=True):
        left, rank = histogram[size], 0
        if not 0 < size <= length:
            raise ValueError(f"a piece of {size} tokens does not fit in {length}")
        while left:
            i = bisect_left(rooms, size)
            if i < len(rooms):
                room = rooms[i]
                sequence, n = free[room].pop()
                if not free[room]:
                    del free[room], rooms[i]
            else:
                room, sequence, n = length, made, -(-left // (length // size))
                made += n
            per = room // size
            full = min(n, left // per)
            if full:
                out.append(Slots(size, rank, full * per, sequence, per, length - room))
                keep(room - per * size, sequence, full)
                rank, left, sequence, n = rank + full * per, left - full * per, sequence + full, n - full
            if n and left:  # fewer than fill a sequence
                out.append(Slots(size, rank, left, sequence, left, length - room))
                keep(room - left * size, sequence, 1)
                left, sequence, n = 0, sequence + 1, n - 1
            keep(room, sequence, n)
    return out


def pieces(docs: DataFrame, path: str, doc_id: str, text: str, length: int, with_ids: bool) -> DataFrame:
    """id, piece, start, length, crc, tokens, lane (the task), local (pieces of this length before, in this lane), ids."""
    given = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("body"))
    fields = docs.sparkSession.createDataFrame([], (
        f"id {given.schema['id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long, doc_tokens long, lane long, local long"
        + ", ids binary" * with_ids
    )).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out, known, lane, seen = to_arrow_schema(fields), ids_by(path), TaskContext.get().partitionId(), {}
        for batch in batches:
            for first in range(0, batch.num_rows, BATCH_ROWS):
                rows = []
                some = batch.slice(first, BATCH_ROWS)
                names, bodies = (some.column(i).to_pylist() for i in range(2))
                for own, ids in zip(names, known.all_of([b or "" for b in bodies])):
                    wide = np.frombuffer(ids, dtype=known.kind).astype("<u4")
                    for piece, start in enumerate(range(0, len(wide), length)):
                        part = wide[start : start + length]
                        local = seen.get(len(part), 0)
                        seen[len(part)] = local + 1
                        held = part.tobytes()
                        rows.append((own, piece, start, len(part), zlib.crc32(held), len(wide), lane, local) + (held,) * with_ids)
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), out)], schema=out)
        known.known.clear()  # the worker goes on to other tasks

    return given.mapInArrow(run, fields)


def packed(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, with_ids: bool = False
) -> DataFrame:
    """Pack all documents into few sequences of at most ``length`` tokens.

    Only documents of more than ``length`` tokens are cut, into pieces of that
    length and a rest. Null and empty texts are the end id alone; repeated rows
    are documents of their own, an empty table gives no rows, long texts are
    encoded whole, and only the named columns are read.

    The driver sees one count for each length, at most ``length`` rows, and
    sends a plan whose size is bounded by ``length`` (see ``planned``). Ranks
    are those of the table's partitions, in which equal lengths are counted
    apart, so that a length that most pieces share is never in one task.

    Returns one row for each piece: ``<doc_id>``, piece, start, length,
    ids_crc32, doc_tokens, sequence_id, offset and, ``with_ids``, the ids as
    little-endian unsigned 32-bit numbers.
    """
    spark = docs.sparkSession
    rows = durable(pieces(docs, path, doc_id, text, length, with_ids))
    lanes = durable(rows.groupBy("length", "lane").agg(F.count("*").alias("n")))
    histogram = {r["length"]: r["n"] for r in lanes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    earlier = Window.partitionBy("length").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    bases = lanes.select("length", "lane", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = rows.join(bases, ["length", "lane"])
    plan = np.array(sorted(planned(histogram, length)), dtype=np.int64).reshape(-1, len(Slots._fields))
    sent = spark.sparkContext.broadcast(plan)
    given = [f for f in rows.columns if f not in ("lane", "local")]
    types = {f.name: f.dataType.simpleString() for f in rows.schema}

    def placing():
        size, first, _, sequence, per, offset = sent.value.T
        # Slots of a length lie together, by rank, so one search finds length and rank.
        span = int(first.max(initial=0)) + 1
        key = size * span + first

        def run(batch: dict[str, list]) -> dict[str, list]:
            own, rank = np.array(batch["length"], dtype=np.int64), np.array(batch["rank"], dtype=np.int64)
            at = np.searchsorted(key, own * span + np.minimum(rank, span - 1), "right") - 1
            inside = rank - first[at]
            return {name: batch[name] for name in given} | {
                "sequence_id": (sequence[at] + inside // per[at]).tolist(),
                "offset": (offset[at] + inside % per[at] * own).tolist(),
            }

        return run

    placed = by_batch(
        ranked.select(*given, (F.col("base") + F.col("local")).alias("rank")), placing,
        ", ".join(f"{name} {types[name]}" for name in given) + ", sequence_id long, offset long",
    )
    order = ["id", "piece", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    return placed.select(order).withColumnRenamed("id", doc_id)


def sequences(placed: DataFrame) -> DataFrame:
    """The ids of each sequence, from ``packed(..., with_ids=True)``: sequence_id, n_tokens, ids.

    A sequence is bounded by its length, so no task gathers more than that of one.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = F.aggregate(parts, F.lit(b""), lambda held, part: F.concat(held, part["ids"]))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), whole.alias("ids"))
