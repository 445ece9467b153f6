"""Mixture-controlled packing by deficit round-robin over source queues.

Documents queue by source. Each window serves the queues in turn with the
tokens that their deficits (tokens due by the target share, less tokens
served) entitle them to, and deficits are carried on. The tokens due before
any window have a closed form, so every task serves its part of the queues
from any window on, and deficits pass from partition to partition without a
task waiting for another.
"""

from __future__ import annotations

import heapq
import os
import re
import zlib
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from buildmend.llm.common import BATCH_ROWS
from buildmend.session import durable

#: Tokens of a sequence and the id that ends a document.
LENGTH, END = 2048, 1
#: Sequences of a window.
WINDOW = 64
#: Queues that the sources beyond the bound share.
SHARED = 256
#: Numbers that each cache of a schedule holds, all windows together.
NUMBERS = 1 << 21
#: Parts of texts whose ids a task keeps, and characters that are in parts at a time.
PARTS, CHARS = 350_000, 1 << 20
#: Parts that the tokenizer gets as one text.
TOGETHER = 200

#: Texts of these characters alone are cut into pieces here, as the tokenizer's own rule cuts them.
PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]*")
CUT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
#: A comma or full stop alone behind a letter is a piece of its own: a blank may go ahead of it.
STOP = re.compile(r"(?<=[a-zß-öø-ÿ])(?=[.,](?:[ \n]|\Z))")


class Ids:
    """Ids of texts as bytes. Parts between blanks are kept, and new ones go to the tokenizer together."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.end = np.array([END], dtype=self.kind).tobytes()
        self.known: dict[str, bytes] = {}
        # Texts may be cut here only if the tokenizer cuts alike.
        self.alike = True
        samples = ["It's a test, isn't it?  We'll SEE 1234 things -- ok!!\nÄrger über straße, ÉTÉ señor''s x_y 3.5%", "'sabc ''t ''" "'re l'été 'MM '5"]
        self.alike = self.all_of(samples) == [self.encode(t) + self.end for t in samples]

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.kind).tobytes()

    def learned(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of parts that are not kept; the pieces of some hundred parts are encoded as one text.

        What comes first is kept, up to a bound; frequent parts come early.
        """
        out: dict[str, bytes] = {}
        for start in range(0, len(parts), TOGETHER):
            some = parts[start : start + TOGETHER]
            cut = [[p] if p.isalpha() else CUT.findall(p) for p in some]
            found = self.tokenizer.encode(" ".join(piece for own in cut for piece in own), add_special_tokens=False)
            ids, words = np.array(found.ids, dtype=self.kind).tobytes(), np.array(found.word_ids, dtype=np.int64)
            behind = np.cumsum([0] + [len(own) for own in cut])
            edges = (np.searchsorted(words, behind) * self.kind.itemsize).tolist()
            out.update((part, ids[a:b]) for part, a, b in zip(some, edges, edges[1:]))
        if len(self.known) + len(out) <= PARTS:
            self.known.update(out)
        return out

    def all_of(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, each with the one that ends a document."""
        out, held, n = [], [], 0
        for text in texts:
            plain = self.alike and "<|" not in text and PLAIN.fullmatch(text)
            held.append(STOP.sub(" ", text.lower()).replace("\n", " ").split(" ") if plain else text)
            n += len(text)
            if n > CHARS:
                out += self.settled(held)
                held, n = [], 0
        return out + self.settled(held)

    def settled(self, held: list[list[str] | str]) -> list[bytes]:
        parts = [p for own in held if isinstance(own, list) for p in own]
        found = list(map(self.known.get, parts))
        new = [i for i, f in enumerate(found) if f is None]
        if new:
            own = self.learned(list({parts[i] for i in new}))
            for i in new:
                found[i] = own[parts[i]]
        out, at = [], 0
        for own in held:
            if isinstance(own, list):
                out.append(b"".join(found[at : at + len(own)]) + self.end)
                at += len(own)
            else:
                out.append(self.encode(own) + self.end)
        return out

    def of(self, text: str) -> bytes:
        return self.all_of([text])[0]


@lru_cache(maxsize=4)
def ids_by(path: str) -> Ids:
    """One for each worker process: reading the vocabulary takes longer than a small task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Ids(path)


def tokenized(docs: DataFrame, doc_id: str, text: str, queue: str, path: str) -> DataFrame:
    """id, queue, lane (the task), local (tokens of this queue before, in this lane), n, ids."""
    given = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(queue).cast("string"), F.lit("")).alias("queue"), F.col(text).alias("body"))
    fields = docs.sparkSession.createDataFrame([], (
        f"id {given.schema['id'].dataType.simpleString()}, queue string, lane long, local long, n long, width int, ids binary"
    )).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out, known, lane, served = to_arrow_schema(fields), ids_by(path), TaskContext.get().partitionId(), {}
        known.known.clear()
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                rows = []
                piece = batch.slice(start, BATCH_ROWS)
                names, queues, bodies = (piece.column(i).to_pylist() for i in range(3))
                for own, name, ids in zip(names, queues, known.all_of([b or "" for b in bodies])):
                    n, local = len(ids) // known.kind.itemsize, served.get(name, 0)
                    served[name] = local + n
                    rows.append((own, name, lane, local, n, known.kind.itemsize, ids))
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), out)], schema=out)
        known.known.clear()  # the worker goes on to other tasks

    return given.mapInArrow(run, fields)


class Schedule:
    """Tokens served from each queue before any window, and where they lie in it."""

    def __init__(self, totals: list[int], window: int = LENGTH * WINDOW, length: int = LENGTH):
        self.totals, self.window, self.length, self.total = totals, window, length, sum(totals)
        held = min(4096, max(16, NUMBERS // max(1, len(totals))))
        self.before = lru_cache(maxsize=held)(self.before)
        self.places = lru_cache(maxsize=held)(self.places)
        full = self.total // length * length
        self.tail, rest, at = [], self.total - full, full
        while rest:  # the rest is cut at powers of two, which need no padding
            part = 1 << rest.bit_length() - 1
            self.tail.append((at, part))
            at, rest = at + part, rest - part

    def before(self, w: int) -> tuple[int, ...]:
        """Tokens served from each queue before window ``w``.

        The k-th token of a queue falls due at (2k + 1) / (its total); tokens
        are served in this order, ties by queue. Each queue's deficit then
        stays about half a token and its count never falls as ``w`` rises.
        """
        n, k = min(w * self.window, self.total), len(self.totals)
        sure = max(0, n - k)
        served = [(2 * sure * t + self.total) // (2 * self.total) if sure else 0 for t in self.totals]
        due = [(Fraction(2 * s + 1, t), q) for q, (s, t) in enumerate(zip(served, self.totals)) if s < t]
        heapq.heapify(due)
        for _ in range(n - sum(served)):
            _, q = heapq.heappop(due)
            served[q] += 1
            if served[q] < self.totals[q]:
                heapq.heappush(due, (Fraction(2 * served[q] + 1, self.totals[q]), q))
        return tuple(served)

    def places(self, w: int) -> tuple[int, ...]:
        """Where each queue's tokens begin on the line of all tokens; the first queue takes turns."""
        now, then, at, k = self.before(w), self.before(w + 1), w * self.window, len(self.totals)
        out = [0] * k
        for i in range(k):
            q = (w + i) % k
            out[q] = at
            at += then[q] - now[q]
        return tuple(out)

    def pieces(self, queue: int, start: int, n: int) -> Iterator[tuple[int, int, int]]:
        """(place on the line, tokens before within the document, tokens) of a document."""
        w, at, end = start * self.total // (self.totals[queue] * self.window), start, start + n
        while w and self.before(w)[queue] > at:
            w -= 1
        while at < end:
            while self.before(w + 1)[queue] <= at:
                w += 1
            upto, place = min(end, self.before(w + 1)[queue]), self.places(w)[queue] + at - self.before(w)[queue]
            while at < upto:
                _, offset, room = self.sequence(place)
                part = min(upto - at, room - offset)
                yield place, at - start, part
                at, place = at + part, place + part

    def sequence(self, place: int) -> tuple[int, int, int]:
        """(sequence, offset in it, its length) of a place on the line."""
        if not self.tail or place < self.tail[0][0]:
            return place // self.length, place % self.length, self.length
        for i, (at, part) in enumerate(self.tail):
            if place < at + part:
                return self.total // self.length + i, place - at, part
        raise IndexError(place)


def packed(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", queue: str = "source",
    length: int = LENGTH, window: int = WINDOW, most_queues: int = 10_000,
) -> DataFrame:
    """Pack all documents into sequences of at most ``length`` tokens.

    The target share of a queue is its share of all tokens, so that all queues
    end together. A window has ``window`` sequences. Null and empty texts are
    the end id alone; a null source is the queue of no name. Repeated rows are
    documents of their own, an empty table gives no rows, and only the named
    columns are read. The order in a queue is that of the table's partitions.

    Any number of sources is packed. The ``most_queues`` with the most tokens
    have a queue each; the others are dealt by hash to ``SHARED`` queues, where
    they stand source by source in each partition. A shared queue has the share
    of its sources together in every window, and ``queue`` stays the source.

    Every sequence has ``length`` tokens but the last few, whose lengths are
    powers of two: there is no padding.

    Returns one row for each piece: ``<doc_id>``, start, length, ids_crc32,
    doc_tokens, sequence_id, offset, queue, window.
    """
    rows = durable(tokenized(docs, doc_id, text, queue, path))
    lanes = durable(rows.groupBy("lane", "queue").agg(F.sum("n").alias("tokens")))
    spark, sizes = docs.sparkSession, lanes.groupBy("queue").agg(F.sum("tokens").alias("tokens"))
    top = [r["queue"] for r in sizes.orderBy(F.desc("tokens"), "queue").limit(most_queues + 1).collect()]
    names = sorted(top[:most_queues])
    own_slots = spark.createDataFrame(list(zip(names, range(len(names)))), "queue string, slot int")
    shared = (F.pmod(F.xxhash64("queue"), F.lit(SHARED)) + len(names)).cast("int")
    dealt = lanes.join(own_slots, "queue", "left").select("lane", "queue", "tokens", F.coalesce("slot", shared).alias("slot"))
    totals = [0] * (len(names) + SHARED * (len(top) > most_queues))
    for r in dealt.groupBy("slot").agg(F.sum("tokens").alias("tokens")).collect():
        totals[r["slot"]] = r["tokens"]
    earlier = Window.partitionBy("slot").orderBy("lane", "queue").rowsBetween(Window.unboundedPreceding, -1)
    bases = dealt.select("lane", "queue", "slot", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base"))
    placed = rows.join(bases, ["lane", "queue"]).select("id", "queue", "slot", (F.col("base") + F.col("local")).alias("at"), "n", "width", "ids")
    sent = spark.sparkContext.broadcast(totals)
    fields = spark.createDataFrame([], (
        f"id {rows.schema['id'].dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long, queue string, window long"
    )).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out, plan = to_arrow_schema(fields), Schedule(sent.value, length * window, length)
        for batch in batches:
            for first in range(0, batch.num_rows, BATCH_ROWS):
                found, piece = [], batch.slice(first, BATCH_ROWS)
                for own, name, slot, at, n, width, ids in zip(*(piece.column(i).to_pylist() for i in range(7))):
                    wide = np.frombuffer(ids, dtype=f"<u{width}").astype("<u4")
                    for place, start, part in plan.pieces(slot, at, n):
                        sequence, offset, _ = plan.sequence(place)
                        found.append((own, start, part, zlib.crc32(wide[start : start + part].tobytes()), n, sequence, offset, name, place // plan.window))
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*found), out)], schema=out)

    return placed.mapInArrow(run, fields).withColumnRenamed("id", doc_id)
