"""Benchmark decontamination by CGK embedding and bit-sampling.

A random walk over the words of a window (the CGK embedding) turns a small
edit distance into a small Hamming distance. Windows of bounded size, short
items nearly whole and long ones in many, are walked with several random
strings; sampled places of the embedded window make keys, and items that share
a key with a window are verified whole by exact edit distance.
"""

from __future__ import annotations

from math import floor
from uuid import uuid4
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buildmend.llm.common import by_batch

#: Everything that separates words, as spaces.
FLAT = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
#: Largest edit distance as a share of an item's words.
MOST_EDITS = 0.2
#: Window sizes in words; an item is searched with the largest size up to the share of its length.
#: A walk's keys find a window the less often the longer it is, so a longer item has more windows, not longer ones.
SIZES = [1, 2, 3, 4, 5, 6, 8, 12, 18, 27, 40]
SHARE = 0.75
#: Walks, keys of each walk, places of each key.
WALKS, KEYS, PLACES = 3, 4, 4
#: Slots for each key, as a power of two, of the filter ahead of the search.
SPARE = 6
#: Words of the texts that are in arrays at a time.
WORDS_AT_ONCE = 200_000
#: Words of items for which one index is made; more items take further passes.
BLOCK_WORDS = 400_000
PAD = np.uint32(0x5BD1E995)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(FLAT).split()


def hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, words), np.uint32, len(words))


def size_for(n_words: int) -> int:
    """Window size for an item: short items whole, others up to the share of their length."""
    return max(s for s in SIZES if s <= max(n_words * SHARE, min(n_words, 6)))


def stride_for(size: int) -> int:
    return max(1, size // 4)


class Walk:
    """One random string for windows of one size, and the keys that are sampled from it."""

    def __init__(self, size: int, seed: int):
        rng = np.random.default_rng([size, seed])
        self.steps = max(1, int(size * 1.25))
        self.odd = rng.integers(1, 1 << 31, self.steps, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        places = min(PLACES, self.steps)
        self.samples = [np.sort(rng.choice(self.steps, places, replace=False)) for _ in range(KEYS)]
        self.mix = rng.integers(1, 1 << 62, (KEYS, places), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.uses = [[(k, int(np.flatnonzero(s == step)[0])) for k, s in enumerate(self.samples) if step in s] for step in range(self.steps)]

    def keys(self, line: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Keys x windows. ``line`` must go on for as many words as there are steps."""
        at, out = starts.copy(), np.zeros((KEYS, len(starts)), dtype=np.uint64)
        for step in range(self.steps):
            symbol = line[at]
            for k, place in self.uses[step]:
                out[k] += symbol * self.mix[k, place]
            at += ((symbol * self.odd[step]) >> np.uint32(31)).astype(at.dtype)
        for k in range(KEYS):
            out[k] ^= out[k] >> np.uint64(29)
            out[k] *= np.uint64(0xBF58476D1CE4E5B9)
        return out


class Index:
    """Keys of the items' windows at every shift, by window size and walk."""

    def __init__(self, items: list[tuple[object, list[bytes]]]):
        self.items = [(item, words, hashed(words)) for item, words in items if words]
        self.lists = [own.tolist() for _, _, own in self.items]
        by_size: dict[int, list[int]] = {}
        for i, (_, words, _) in enumerate(self.items):
            by_size.setdefault(size_for(len(words)), []).append(i)
        self.tables = []
        for size, members in sorted(by_size.items()):
            owner, shift, lines, starts, at = [], [], [], [], 0
            for i in members:
                own = self.items[i][2]
                for s in range(len(own) - size + 1):
                    owner.append(i)
                    shift.append(s)
                    starts.append(at + s)
                lines += [own, np.full(size * 2, PAD)]
                at += len(own) + size * 2
            line, first = np.concatenate(lines), np.array(starts)
            walks, shift_by = [], np.uint64(64 - min(24, len(first).bit_length() + SPARE))
            for seed in range(WALKS):
                walk = Walk(size, seed)
                for k, keys in enumerate(walk.keys(line, first)):
                    order = np.argsort(keys, kind="stable")
                    near = np.zeros(1 << (64 - int(shift_by)), dtype=bool)
                    near[keys >> shift_by] = True
                    walks.append((walk if k == 0 else None, k, keys[order], np.array(owner)[order], np.array(shift)[order], near))
            self.tables.append((size, shift_by, walks))

    def candidates(self, line: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in the line, item, shift) of windows that share a key with an item."""
        places, items_met, shifts_met = [], [], []
        for size, shift_by, walks in self.tables:
            padded = np.concatenate([line, np.full(size * 2, PAD)])
            starts = np.flatnonzero(owner % stride_for(size) == 0)
            for walk, k, known, items, shifts, near in walks:
                keys = walk.keys(padded, starts) if walk is not None else keys
                maybe = np.flatnonzero(near[keys[k] >> shift_by])
                low = np.searchsorted(known, keys[k][maybe], "left")
                times = np.searchsorted(known, keys[k][maybe], "right") - low
                found = np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                places.append(np.repeat(starts[maybe], times))
                items_met.append(items[found])
                shifts_met.append(shifts[found])
        if not places:
            return (np.zeros(0, dtype=np.int64),) * 3
        return np.concatenate(places), np.concatenate(items_met), np.concatenate(shifts_met)


def row_by_row(item: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Edit distance of ``item`` to the best substring of ``text`` that ends behind each place."""
    at = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, dtype=np.int64)
    for i, word in enumerate(item):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[:-1] + (text != word), row[1:] + 1)
        row = np.minimum.accumulate(new - at) + at
    return row


def closest(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(distance, start, end) of the best substring; among equals the first end, then the last start."""
    ends = row_by_row(item, text)
    end = int(ends.argmin())
    starts = row_by_row(item[::-1], text[:end][::-1])
    return int(ends[end]), end - int(starts.argmin()), end


def search(line: np.ndarray, index: Index) -> dict[int, tuple[int, int, int]]:
    """Best occurrence (distance, start, end) of each item within the allowed edits in one text."""
    return search_many([line], index)[0]


def search_many(lines: list[np.ndarray], index: Index) -> list[dict[int, tuple[int, int, int]]]:
    found: list[dict[int, tuple[int, int, int]]] = [{} for _ in lines]
    lengths = np.array([len(x) for x in lines])
    if not lengths.sum():
        return found
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    whole = np.concatenate(lines)
    at, item, shift = index.candidates(whole, np.arange(len(whole)) - np.repeat(first, lengths))
    if not len(at):
        return found
    edits = np.array([floor(MOST_EDITS * len(own)) for _, _, own in index.items])
    doc = np.repeat(np.arange(len(lines)), lengths)[at]
    start = at - first[doc] - shift
    # Candidates of one diagonal are one.
    once = np.unique(np.column_stack([doc, item, start // (2 * edits[item] + 1)]), axis=0, return_index=True)[1]
    for d, i, s in zip(doc[once].tolist(), item[once].tolist(), start[once].tolist()):
        own, most = index.items[i][2], int(edits[i])
        low, high = max(0, s - 3 * most - 1), min(int(lengths[d]), s + len(own) + 3 * most + 1)
        region = lines[d][low:high]
        if sum(map(set(region.tolist()).__contains__, index.lists[i])) < len(own) - most:
            continue  # fewer words of the item than even the most edits leave
        distance, a, b = closest(own, region)
        if distance <= most:
            best = (distance, low + a, low + b)
            if i not in found[d] or best < found[d][i]:
                found[d][i] = best
    return found


def pieces(words: int, most: int, overlap: int):
    """Cut a long text into overlapping pieces."""
    start = 0
    while True:
        yield start, min(words, start + most + overlap)
        start += most
        if start >= words:
            return


def blocks_of(items: list[tuple[object, str]]) -> list[list[tuple[object, list[bytes]]]]:
    """Items in blocks of bounded numbers of words."""
    out, held, n = [], [], 0
    for item, text in items:
        words = words_of(text)
        if held and n + len(words) > BLOCK_WORDS:
            out.append(held)
            held, n = [], 0
        held.append((item, words))
        n += len(words)
    return out + [held] if held else out


#: The index that this worker process made last, by its token.
LAST: dict[str, Index] = {}


def index_of(token: str, items: list[tuple[object, list[bytes]]]) -> Index:
    """Tasks get the items; each worker process makes their index once."""
    if token not in LAST:
        LAST.clear()
        LAST[token] = Index(items)
    return LAST[token]


def leaks(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    flag: str | None = None, keep: list[str] | None = None,
) -> DataFrame:
    """Benchmark items that occur in whole texts within ``MOST_EDITS`` of their words.

    Words are runs of letters, digits and characters beyond ASCII in lower
    case. An item is searched in windows of at most the last of ``SIZES``, and
    of three quarters of its length, at every stride and with every shift of the
    item, so that unedited copies are always found; edited ones are found by
    chance, which one of an item's windows is enough for.
    Items without a word and null texts match nothing. The benchmark is a
    stated query set: it is sent in blocks of bounded size, one pass over the
    documents each. Repeated items are reported each, repeated rows give rows
    each; extra columns are not read.

    Returns ``<doc_id>``, ``<item_id>``, start, end (words), distance and
    similarity of the best occurrence of each item in each text; with ``flag``
    the columns ``keep`` (the text among them) of every row instead, and
    whether it holds an item.
    """
    spark = docs.sparkSession
    items = [(r[0], r[1]) for r in benchmark.select(item_id, item_text).orderBy(item_id, item_text).toLocalIterator()]
    blocks = blocks_of(items)
    item_type = benchmark.schema[item_id].dataType.simpleString()
    columns = keep or [doc_id]
    result = None
    for block in blocks or [[]]:
        sent, token = spark.sparkContext.broadcast(block), uuid4().hex

        def make(sent=sent, token=token):
            index = index_of(token, sent.value)
            longest = max((len(w) for _, w, _ in index.items), default=0)

            def batch(cells: dict[str, list]) -> dict[str, list]:
                bodies = cells["_body"]
                hits: list[dict[int, tuple[int, int, int]]] = [{} for _ in bodies]
                held, n = [], 0

                def settle() -> None:
                    nonlocal held, n
                    for (row, offset, _), best in zip(held, search_many([x[2] for x in held], index)):
                        for item, (distance, a, b) in best.items():
                            now = (distance, a + offset, b + offset)
                            if item not in hits[row] or now < hits[row][item]:
                                hits[row][item] = now
                    held, n = [], 0

                for row, body in enumerate(bodies):
                    line = hashed(words_of(body)) if index.items else []
                    for a, b in pieces(len(line), WORDS_AT_ONCE, 3 * longest) if len(line) else ():
                        held.append((row, a, line[a:b]))
                        n += b - a
                        if n >= WORDS_AT_ONCE:
                            settle()
                settle()
                if flag:
                    return {c: cells[c] for c in columns} | {flag: [x or bool(h) for x, h in zip(cells[flag], hits)]}
                out = {"id": [], "item": [], "start": [], "end": [], "distance": [], "similarity": []}
                for row, best in enumerate(hits):
                    for item, (distance, a, b) in sorted(best.items()):
                        name, words, _ = index.items[item]
                        for key, value in zip(out, (cells["_id"][row], name, a, b, distance, 1 - distance / len(words))):
                            out[key].append(value)
                return out

            return batch

        if flag:
            rows = docs.withColumn(flag, F.lit(False)) if result is None else result
            given = rows.select(*columns, flag, F.col(text).alias("_body"))
            result = by_batch(given, make, ", ".join(f"`{c}` {given.schema[c].dataType.simpleString()}" for c in columns) + f", {flag} boolean")
        else:
            given = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_body"))
            schema = f"id {given.schema['_id'].dataType.simpleString()}, item {item_type}, start long, end long, distance long, similarity double"
            part = by_batch(given, make, schema).withColumnsRenamed({"id": doc_id, "item": item_id})
            result = part if result is None else result.unionByName(part)
    return result
