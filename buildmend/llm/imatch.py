"""I-Match fingerprints over randomised lexicon subsets.

Terms whose inverse document frequency lies in a band make the lexicon. A text
is the sorted distinct terms that it has of the lexicon; the terms in each of
several random subsets of the lexicon are hashed together. Copies agree in all
hashes and edited texts in those whose subsets miss the edit.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buildmend.llm.common import BATCH_ROWS, by_batch, range_of
from buildmend.session import durable

TERM = re.compile(r"[^\W_]+")
#: Share of the lexicon in a subset, and how many subsets have it.
SUBSETS = [(4, 6), (16, 10), (64, 14), (256, 18)]
N_SUBSETS = sum(n for _, n in SUBSETS)
#: Hex digits of a subset's hash; a subset without terms has none set.
DIGITS = 4
LOWEST = -(1 << 63)
#: Terms that a task counts before it hands them on.
HELD = 300_000


def terms(text: str) -> set[str]:
    return set(TERM.findall(text.lower()))


def frequencies(docs: DataFrame, text: str) -> DataFrame:
    """term, df: the number of documents with each term, over all documents.

    Tasks count ahead of the shuffle. The row count comes as the null term.
    """
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    schema = StructType([StructField("term", StringType()), StructField("n", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = Counter(), 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"term": pa.array([*seen, None], pa.string()), "n": pa.array([*seen.values(), rows], pa.int64())})

        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                for body in batch.column(0).slice(start, BATCH_ROWS).to_pylist():
                    rows += 1
                    seen.update(terms(body or ""))
                if len(seen) >= HELD:
                    yield out()
                    seen, rows = Counter(), 0
        yield out()

    return docs.select(text).mapInArrow(run, schema).groupBy("term").agg(F.sum("n").alias("df"))


class Lexicon:
    """Terms of the band in sorted order, with the subsets that each is in."""

    def __init__(self, words: list[str]):
        self.words = sorted(words)
        self.number = {w: i for i, w in enumerate(self.words)}
        self.member = np.zeros((len(self.words), N_SUBSETS), dtype=bool)
        digest = np.array([int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") for w in self.words], dtype=np.uint64)
        row = 0
        for share, n in SUBSETS:
            for _ in range(n):
                self.member[:, row] = (mixed(digest ^ np.uint64((row + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> np.uint64(32)) % np.uint64(share) == 0
                row += 1
        self.digest = mixed(digest)

    def fingerprint(self, text: str) -> str:
        """Hash of all terms in the band, a colon, and the hash of each subset.

        The sorted distinct terms of a subset are hashed as the sum of their
        digests. A text without a term in the band is hashed by all its terms,
        and no subset is set.
        """
        own = terms(text)
        found = np.array(sorted(n for w in own if (n := self.number.get(w)) is not None), dtype=np.int64)
        if not len(found):
            whole = hashlib.blake2b(" ".join(sorted(own)).encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()
            return f"{whole}:{'0' * DIGITS * N_SUBSETS}"
        digests, member = self.digest[found], self.member[found]
        sums = mixed((member * digests[:, None]).sum(axis=0, dtype=np.uint64))
        parts = np.where(member.any(axis=0), (sums >> np.uint64(20)) % np.uint64(16**DIGITS - 1) + np.uint64(1), np.uint64(0))
        return f"{hashlib.blake2b(digests.tobytes(), digest_size=8).hexdigest()}:{parts.astype('>u2').tobytes().hex()}"


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def likeness(a: str, b: str) -> float:
    """Share of agreeing subsets among those that either text has terms in; 1 for equal fingerprints."""
    if a == b:
        return 1.0
    x, y = (np.frombuffer(bytes.fromhex(f.partition(":")[2]), dtype=">u2") for f in (a, b))
    either = int(np.count_nonzero(x | y))
    return int(np.count_nonzero((x == y) & (x > 0))) / either if either else 0.0


def lexicon(docs: DataFrame, text: str = "text", least: float = 0.001, most: float = 0.2) -> Lexicon:
    """Terms that between ``least`` and ``most`` of the documents have (at least two).

    Documents have m distinct terms on average, so no more than m / ``least``
    terms can be in the band, however many documents there are: that bounds
    what reaches the driver and each task.
    """
    df = durable(frequencies(docs, text))
    n = df.filter("term IS NULL").agg(F.sum("df")).first()[0] or 0
    return Lexicon([r["term"] for r in df.filter(F.col("term").isNotNull() & (F.col("df") >= max(2, ceil(least * n))) & (F.col("df") <= most * n)).select("term").collect()])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: Lexicon | None = None) -> DataFrame:
    """Fingerprint of every whole text: ``<doc_id>``, fingerprint.

    Null counts as empty; an empty text has the fingerprint of no terms.
    Repeated rows give a row each. Only the named columns are read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(words or lexicon(docs, text))

    def make():
        known = sent.value
        return lambda cells: {"id": cells["id"], "fingerprint": [known.fingerprint(t or "") for t in cells["body"]]}

    given = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("body"))
    return by_batch(given, make, f"id {given.schema['id'].dataType.simpleString()}, fingerprint string").withColumnRenamed("id", doc_id)


def with_next(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows by ranges of the id, each range ending with a guest: the first row of the next.

    Range bounds are quantiles of the id, so no range is a task of its own and
    every row moves once. Columns: part, guest, id, given, body.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(doc_id).alias("given"), F.coalesce(F.col(doc_id).cast("long"), F.lit(LOWEST)).alias("id"),
        F.coalesce(F.col(text), F.lit("")).alias("body"),
    )
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.select("id").approxQuantile("id", [i / parts for i in range(1, parts)], 1 / (8 * parts))
    splitters = sorted({int(c) for c in cuts})
    placed = rows.withColumn("part", range_of(F.col("id"), splitters))
    heads = {r["part"]: r["head"] for r in placed.groupBy("part").agg(F.min("id").alias("head")).collect()}
    line = sorted(heads)
    before = {p: line[i - 1] for i, p in enumerate(line)}
    slots = range(len(splitters) + 1)
    head = F.element_at(F.array(*[F.lit(heads.get(p, LOWEST)).cast("long") for p in slots]), F.col("part") + 1)
    prior = F.element_at(F.array(*[F.lit(before.get(p, 0)).cast("int") for p in slots]), F.col("part") + 1)
    here = F.struct(F.col("part").cast("int").alias("part"), F.lit(False).alias("guest"))
    there = F.struct(prior.alias("part"), F.lit(True).alias("guest"))
    both = F.when(F.col("id") == head, F.array(here, there)).otherwise(F.array(here))
    return (
        placed.select("given", "id", "body", F.explode(both).alias("to")).select("to.*", "given", "id", "body")
        .repartition("part").sortWithinPartitions("part", "guest", "id", "body")
    )


def edited(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: Lexicon | None = None) -> DataFrame:
    """Fingerprints of whole texts, of their edited texts, and how alike they are.

    The edited text has its last floor(n / 2) code points replaced by the
    first as many of the next document by id (after the last the first).
    Null text counts as empty, a null id sorts first, equal ids are ordered by
    text, and a lone document is its own next. An empty table gives no rows.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(words or lexicon(docs, text))
    moved = with_next(docs, doc_id, text)
    fields = spark.createDataFrame([], (
        f"given {moved.schema['given'].dataType.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        known, out = sent.value, to_arrow_schema(fields)
        held = None
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                piece, rows = batch.slice(start, BATCH_ROWS), []
                for part, guest, given, body in zip(*(piece.column(piece.schema.get_field_index(c)).to_pylist() for c in ("part", "guest", "given", "body"))):
                    if guest and (held is None or held[0] != part):
                        continue  # a further row with the first id of the next range
                    own = known.fingerprint(body)
                    if held is not None and held[0] == part:
                        _, before, text_before, print_before = held
                        half = len(text_before) // 2
                        new = text_before[: len(text_before) - half] + body[:half]
                        changed = known.fingerprint(new)
                        rows.append((
                            before, len(text_before), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), print_before,
                            changed, likeness(print_before, changed), likeness(print_before, own),
                        ))
                    held = None if guest else (part, given, body, own)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), out)], schema=out)

    return moved.mapInArrow(run, fields).withColumnRenamed("given", doc_id)
