"""Best-fit packing: the plan against one document at a time, and a round trip of all ids."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from buildmend.llm import best_fit
from buildmend.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("word_bpe_49k.json")


def one_by_one(histogram, length):
    """Rooms left by best fit decreasing over single pieces."""
    rooms = []
    for size in sorted(histogram, reverse=True):
        for _ in range(histogram[size]):
            fits = [r for r in rooms if r >= size]
            if fits:
                rooms.remove(min(fits))
                rooms.append(min(fits) - size)
            else:
                rooms.append(length - size)
    return sorted(rooms)


def laid(slots):
    """(offset, size) of the pieces of each sequence."""
    out = defaultdict(list)
    for s in slots:
        for i in range(s.count):
            out[s.sequence + i // s.per].append((s.offset + i % s.per * s.size, s.size))
    return out


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 24), st.integers(1, 30), max_size=12))
def test_plan_equals_best_fit_of_single_pieces(histogram):
    slots = best_fit.planned(histogram, 24)
    rooms = []
    for parts in laid(slots).values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        rooms.append(24 - at)
    assert sorted(rooms) == one_by_one(histogram, 24)
    for size, n in histogram.items():
        ranks = sorted(r for s in slots if s.size == size for r in range(s.first, s.first + s.count))
        assert ranks == list(range(n))


def test_plan_does_not_grow_with_the_counts():
    few = {size: 1 + size * 7919 % 50 for size in range(1, 513)}
    many = {size: n * 10**9 for size, n in few.items()}
    for histogram in (few, many):
        slots = best_fit.planned(histogram, 512)
        assert len(slots) < 3 * 512 * 32
        tokens = sum(size * n for size, n in histogram.items())
        assert max(s.sequence + -(-s.count // s.per) for s in slots) <= 1.005 * -(-tokens // 512) + 1


def test_a_piece_that_does_not_fit_is_refused():
    with pytest.raises(ValueError):
        best_fit.planned({5: 1}, 4)
    assert best_fit.planned({}) == []


def checked(got, texts, length):
    """Every id in one piece, sequences without gaps or overlaps, pieces cut only beyond the length."""
    own = Tokenizer.from_file(PATH)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(texts)
    for i, rows in by_doc.items():
        ids = np.array(own.encode(texts[i] or "", add_special_tokens=False).ids + [1], dtype="<u4")
        starts = list(range(0, len(ids), length))
        assert [(r["piece"], r["start"], r["length"], r["doc_tokens"], r["ids_crc32"]) for r in sorted(rows, key=lambda r: r["piece"])] == [
            (k, s, len(ids[s : s + length]), len(ids), zlib.crc32(ids[s : s + length].tobytes())) for k, s in enumerate(starts)
        ]
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= length
    return len(by_sequence)


def test_query_round_trip(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = QUERIES["op13_best_fit"](spark, FOLDER)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    rows = got.collect()
    used = checked(rows, texts, 4096)
    assert used <= -(-sum(r["length"] for r in rows) // 4096) + 1


def test_odd_rows(spark):
    long = "alpha beta gamma delta " * 5_000
    rows = [(1, None), (2, ""), (3, "  \n"), (4, long), (5, "<|endoftext|> a"), (6, "ünïcödé 日本 \x00"), (None, "no id"), (8, "same"), (9, "same")]
    docs = spark.createDataFrame([(i, t, 5, 6, "x") for i, t in rows], "doc_id long, text string, length int, lane int, ids string")
    assert checked(best_fit.packed(docs, PATH, length=64).collect(), dict(rows), 64) > 300
    twice = best_fit.packed(docs.filter("doc_id = 8").union(docs.filter("doc_id = 8")), PATH).collect()
    assert [r["length"] for r in twice] == [2, 2] and {r["offset"] for r in twice} == {0, 2}
    assert best_fit.packed(docs.limit(0), PATH).collect() == []


def test_one_length_for_most_documents_and_many_partitions(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "one two three").otherwise(F.repeat(F.lit("w "), (F.col("id") % 41).cast("int"))).alias("text")).repartition(13)
    rows = docs.collect()
    assert checked(best_fit.packed(docs, PATH, length=32).collect(), {r["doc_id"]: r["text"] for r in rows}, 32) > 0


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(i, f"word{i} " * (i % 7)) for i in range(60)], "doc_id long, text string")
    placed = best_fit.packed(docs, PATH, length=32, with_ids=True).cache()
    own, parts = Tokenizer.from_file(PATH), defaultdict(list)
    for r in placed.collect():
        parts[r["sequence_id"]].append((r["offset"], r["doc_id"]))
    for r in best_fit.sequences(placed).collect():
        want = [t for _, i in sorted(parts[r["sequence_id"]]) for t in own.encode(f"word{i} " * (i % 7), add_special_tokens=False).ids + [1]]
        assert np.frombuffer(r["ids"], "<u4").tolist() == want and r["n_tokens"] == len(want)
