"""Signatures of word sets: similar sets have one in common, and few others do.

Sets of x and y words are similar only if at most ``(1 - t) / (1 + t) * (x + y)``
words belong to one of them alone. Words are dealt by their hash to more parts
than that, so some parts hold the same words in both sets; the words of a part
together are a signature. Unlike one rare word, some five words together are
hardly ever shared by chance, however many records there are.

* Similar sets are of the same size class or of neighbouring ones. The number
  of parts is fixed for each pair of neighbours, and is enough for two sets of
  one class as well, so that a set gives signatures of two pairs and no more.
* There are ``spare`` parts beyond those that may differ, so that more than
  ``spare`` parts are the same. A set leaves out the ``spare`` parts whose words
  are the most common; the rarest of the parts that are the same is among the
  rest in both sets.
* A part that has only common words even so is given together with each of the
  set's rarest words, of which similar sets share one (prefix filter).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Words that a task looks at together.
CHUNK_WORDS = 1 << 19
#: Spare parts for each part that may differ.
SPARE = 0.5
#: A part of common words holds less than this share of the bits that tell a record from all others.
COMMON = 0.75
SLIGHT = 1e-6
#: 64-bit numbers of a wide sketch at least.
WIDE = 8


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def size_classes(largest: int, t: float) -> tuple[np.ndarray, np.ndarray]:
    """First and last size of each class; a size and the sizes similar to it span two classes at most."""
    first, last = [1], [int(1 / t + SLIGHT)]
    while last[-1] < largest:
        first.append(last[-1] + 1)
        last.append(int(first[-1] / t + SLIGHT))
    # One more, as the upper neighbour of the last.
    first.append(last[-1] + 1)
    last.append(int(first[-1] / t + SLIGHT))
    return np.array(first), np.array(last)


def leading(words: np.ndarray, sizes: np.ndarray, seen: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray]:
    """The rarest words of each set, as many as a similar set cannot do without; how many they are."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    ranked = words[np.lexsort((words, seen, owner))]
    at = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    n = sizes - np.ceil(t * sizes - 1e-9).astype(np.int64) + 1
    return ranked[at < n[owner]], n


def signs_of(words: np.ndarray, sizes: np.ndarray, counts: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of sets that lie one behind the other, and the set that each belongs to."""
    seen = counts[words.view(np.int64) % len(counts)]
    most = int(counts.max(initial=0)) + 1
    # Sixteenths of a bit, as whole numbers: a part weighs the same in every set.
    weight = np.round(16 * np.log2(most / np.clip(seen, 1, most))).astype(np.int64)
    enough = 16 * COMMON * np.log2(most)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    first, last = size_classes(int(sizes.max(initial=1)), t)
    own = np.searchsorted(first, np.maximum(sizes, 1), side="right") - 1
    place, content = mixed(words, 1) >> np.uint64(32), mixed(words, 2)
    keys, owners = [np.zeros(np.count_nonzero(sizes == 0), np.uint64)], [np.flatnonzero(sizes == 0)]
    for lower, upper in ((own, own + 1), (own - 1, own)):
        both = last[lower] + np.minimum(last[upper], (last[lower] / t + SLIGHT).astype(np.int64))
        differ = (both * ((1 - t) / (1 + t)) + SLIGHT).astype(np.int64)
        spare = (differ * SPARE).astype(np.int64)
        n_parts = np.where((sizes > 0) & (lower >= 0), differ + 1 + spare, 0)
        base = np.cumsum(n_parts) - n_parts
        used = n_parts[owner] > 0
        part = base[owner[used]] + (place[used] % n_parts[owner[used]].astype(np.uint64)).astype(np.int64)
        total = int(n_parts.sum())
        held = np.repeat(np.arange(len(sizes)), n_parts)
        sums = np.zeros(total, np.uint64)
        np.add.at(sums, part, content[used])
        number = (np.arange(total) - base[held]).astype(np.uint64)
        tag = (lower + upper).astype(np.uint64)[held]
        sign = mixed(sums ^ mixed((tag << np.uint64(32)) + number, 3), 4)
        weighs = np.bincount(part, weights=weight[used], minlength=total)
        order = np.lexsort((sign, weighs, held))
        stays = order[np.arange(total) - base[held] >= spare[held]]
        common = weighs[stays] < enough
        keys.append(sign[stays[~common]])
        owners.append(held[stays[~common]])
        chosen = stays[common]
        if len(chosen):
            some = np.bincount(held[chosen], minlength=len(sizes)) > 0
            mine = some[owner]
            rare, n_rare = leading(words[mine], sizes[some], seen[mine], t)
            row = np.cumsum(some) - 1
            times = n_rare[row[held[chosen]]]
            at = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
            again = np.repeat(chosen, times)
            with_rare = rare[(np.cumsum(n_rare) - n_rare)[row[held[again]]] + at]
            keys.append(mixed(sign[again] ^ mixed(with_rare, 5), 6))
            owners.append(held[again])
    return np.concatenate(keys), np.concatenate(owners)


def sketches(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Each set as 64 bits, a word turning one bit: sets differ in as many words at least as their bits do."""
    out = np.zeros(len(sizes), np.uint64)
    np.bitwise_xor.at(out, np.repeat(np.arange(len(sizes)), sizes), np.uint64(1) << (mixed(words, 7) >> np.uint64(58)))
    return out


def wide_sketches(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As `sketches`, with `WIDE` numbers a set, or as many more as give a set a bit for each word; how many they are.

    A set that has more words than bits has its bits turned at random, and they
    would rule out nothing. Numbers are a power of two, so that wide sketches fold into narrow ones.
    """
    width = WIDE << np.maximum(0, np.ceil(np.log2(np.maximum(sizes, 1) / (64 * WIDE)))).astype(np.int64)
    out = np.zeros(int(width.sum()), np.uint64)
    drawn, owner = mixed(words, 8), np.repeat(np.arange(len(sizes)), sizes)
    at = (np.cumsum(width) - width)[owner] + ((drawn >> np.uint64(32)) % width[owner].astype(np.uint64)).astype(np.int64)
    np.bitwise_xor.at(out, at, np.uint64(1) << (drawn >> np.uint64(58)))
    return out, width


def flat_sets(batch: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of a batch one behind the other, and where each set ends."""
    batch = batch.combine_chunks() if isinstance(batch, pa.ChunkedArray) else batch
    ends = np.asarray(batch.offsets).astype(np.int64)
    return np.asarray(batch.values).astype(np.int64, copy=False).view(np.uint64), ends


def wide_sketch(words: Column) -> Column:
    """The wide sketch of a column of word hashes."""

    @F.arrow_udf("array<bigint>")
    def sketched(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            flat, ends = flat_sets(batch)
            out, width = wide_sketches(flat[ends[0]:ends[-1]], np.diff(ends))
            offsets = pa.array(np.concatenate([[0], np.cumsum(width)]), pa.int32())
            yield pa.ListArray.from_arrays(offsets, pa.array(out.view(np.int64)))

    return sketched(words)


def folded_sketch(wide: Column) -> Column:
    """A wide sketch as 64 bits. A word turns one bit of these too: sets differ in as many words at least as their bits do."""
    return F.aggregate(wide, F.lit(0).cast("long"), lambda a, b: a.bitwiseXOR(b))


def narrowed(wide: Column, width: Column) -> Column:
    """A wide sketch as so many numbers, as the set would have it if it were smaller."""
    rounds = F.sequence(F.lit(0), (F.size(wide) / width).cast("int") - 1)
    none = F.array_repeat(F.lit(0).cast("long"), width)
    folded = F.aggregate(rounds, none, lambda total, n: F.zip_with(total, F.slice(wide, n * width + 1, width), lambda a, b: a.bitwiseXOR(b)))
    return F.when(F.size(wide) == width, wide).otherwise(folded)


def signatures(spark: SparkSession, words: Column, counts: np.ndarray, threshold: float) -> Column:
    """Struct (bits, signs) of a column of word hashes; ``counts`` tells rare words from common ones."""
    shared = spark.sparkContext.broadcast(counts)

    @F.arrow_udf("struct<bits: bigint, signs: array<bigint>>")
    def signed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = shared.value
        for batch in batches:
            flat, ends = flat_sets(batch)
            parts, start = [], 0
            while start < len(batch) or not parts:
                stop = max(start + 1, int(np.searchsorted(ends, ends[start] + CHUNK_WORDS, side="right")) - 1)
                stop = min(stop, len(batch))
                sizes = np.diff(ends[start:stop + 1])
                found = flat[ends[start]:ends[stop]]
                keys, owners = signs_of(found, sizes, table, threshold)
                order = np.argsort(owners, kind="stable")
                offsets = np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(sizes)))])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys[order].view(np.int64)))
                bits = pa.array(sketches(found, sizes).view(np.int64))
                parts.append(pa.StructArray.from_arrays([bits, lists], ["bits", "signs"]))
                start = stop
            yield pa.concat_arrays(parts)

    return signed(words)
