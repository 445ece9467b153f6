"""Phrase collocations from a weighted de Bruijn graph of words.

Texts are cut into pieces and words. The graph's nodes are runs of ``longest``
- 1 words; each place of a piece is an edge of ``longest`` words between two
overlapping nodes, and the last places of a piece, which have no such edge, are
kept as shorter corrections. Edges and corrections are shuffled once, by ranges
of their words: what flows out of the nodes that begin with a phrase then lies
together, and its sum with the corrections that begin so is the phrase's count.
A phrase that flows on whole into one longer phrase lies on a unary path and is
compacted into it.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from buildmend.llm.common import BATCH_ROWS
from buildmend.session import durable

#: What ends a piece.
ENDS = b".,;:!?\n\x0b\x0c\r"
END = re.compile("[" + ENDS.decode() + "]")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + ENDS + b"\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * len(ENDS) + b" ")
#: Characters of text that a task cuts into words at a time.
TEXT_CHARS = 2 << 20
#: Ranges of phrases for each shuffle partition, the least number of all, and phrases that are looked at to choose each.
RANGES, LEAST_RANGES, LOOKS = 4, 1024, 8
#: Words that have a code of two bytes; most words of edges that a task sums for longer, and how many of these it holds.
CODES, SMALL, HELD = 1 << 15, 2, 300_000
#: What stands for a null language.
UNKNOWN = "und"


def literal(word: bytes) -> bytes:
    """A word behind its length: one byte, or 0x7f and four for long ones."""
    return (bytes([len(word)]) if len(word) < 0x7F else b"\x7f" + len(word).to_bytes(4, "big")) + word


def coded(words: list[bytes]) -> dict[bytes, bytes]:
    """Two bytes for each of the words, the first of them above those of any length."""
    return {w: bytes([0x80 + (i >> 8), i & 255]) for i, w in enumerate(words[:CODES])}


class Words(dict):
    """A number for each word, in order of appearance; 0 ends a piece, 1 is nothing.

    A phrase is shuffled as the codes of its words, one behind the other. No
    code begins another, so that all edges that begin with a phrase lie
    together in order of bytes.
    """

    def __init__(self, codes: dict[bytes, bytes] = {}):
        super().__init__({b"\n": 0, b"": 1})
        self.codes = codes
        self.listed: list[bytes] = [b"", b""]

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.listed)
        self.listed.append(self.codes.get(word) or literal(word))
        return number

    def cut(self, texts: list[str]) -> np.ndarray:
        """Numbers of all words; a piece, and each text, ends with 0."""
        held = "\n".join(texts).encode().translate(LOWER).replace(b"\n", b" \n ")
        found = np.fromiter(map(self.__getitem__, (held + b" \n").split(b" ")), dtype=np.int64)
        return found[found != 1]

    def keys(self, lang: bytes, rows: np.ndarray) -> pa.Array:
        """The codes of a language and of the words of each row, one behind the other; 0 is nothing."""
        sizes = np.array([len(w) for w in self.listed] + [len(lang)])
        ids = np.concatenate([np.full((len(rows), 1), len(self.listed)), rows], axis=1).ravel()
        letters, upto = gathered(np.frombuffer(b"".join(self.listed) + lang, dtype=np.uint8), (np.cumsum(sizes) - sizes)[ids], sizes[ids])
        offsets = np.concatenate([[0], upto.reshape(len(rows), rows.shape[1] + 1)[:, -1]])
        return binaries(letters, offsets)


def gathered(held: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``held``, one behind the other, and where each ends."""
    upto = np.cumsum(size)
    return held[np.repeat(start - (upto - size), size) + np.arange(size.sum())], upto


def binaries(letters: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(letters)])


def led(keys: pa.Array) -> np.ndarray:
    """The first eight bytes of each key as a number, with zeros behind short keys."""
    at = np.frombuffer(keys.buffers()[1], dtype=np.int32)[keys.offset : keys.offset + len(keys) + 1].astype(np.int64) if len(keys) else np.zeros(1, dtype=np.int64)
    held = np.concatenate([np.frombuffer(keys.buffers()[2] or b"", dtype=np.uint8), np.zeros(8, dtype=np.uint8)])
    heads = np.zeros(len(keys), dtype=np.uint64)
    size = np.diff(at)
    for k in range(8):
        heads = heads << np.uint64(8) | np.where(size > k, held[at[:-1] + np.minimum(k, size)], 0).astype(np.uint64)
    return heads


def placed(keys: pa.Array, splitters: list[bytes], heads: np.ndarray) -> np.ndarray:
    """How many splitters are not above each key; only keys that begin as a splitter does are compared whole."""
    own = led(keys)
    out, upto = np.searchsorted(heads, own, "left"), np.searchsorted(heads, own, "right")
    alike = np.flatnonzero(out < upto)
    out[alike] = [bisect_right(splitters, key, a, b) for key, a, b in zip(keys.take(pa.array(alike)).to_pylist(), out[alike].tolist(), upto[alike].tolist())]
    return out


def decoded(keys: pa.Array, longest: int, table: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Numbers of the language and the words of each key (-1 behind its end), and what they stand for."""
    at = np.frombuffer(keys.buffers()[1], dtype=np.int32)[keys.offset : keys.offset + len(keys) + 1].astype(np.int64)
    held = np.frombuffer(keys.buffers()[2] or b"", dtype=np.uint8)
    at, ends = at[:-1].copy(), at[1:]
    out = np.full((len(keys), longest + 1), -1, dtype=np.int64)
    spots, starts, sizes = [], [], []
    for k in range(longest + 1):
        some = np.flatnonzero(at < ends)
        place = at[some]
        lead = held[place].astype(np.int64)
        short, wide = lead >= 0x80, lead == 0x7F
        out[some[short], k] = (lead[short] - 0x80 << 8) + held[place[short] + 1]
        ahead, size = np.where(wide, 5, 1), lead.copy()
        if wide.any():
            size[wide] = held[place[wide][:, None] + np.arange(1, 5)].astype(np.int64) @ (256 ** np.arange(3, -1, -1))
        at[some] = np.where(short, place + 2, place + ahead + size)
        spots.append((some[~short], np.full((~short).sum(), k)))
        starts.append((place + ahead)[~short])
        sizes.append(size[~short])
    start, size = np.concatenate(starts), np.concatenate(sizes)
    letters, upto = gathered(held, start, size)
    found = binaries(letters, np.concatenate([[0], upto])).dictionary_encode()
    rows, columns = (np.concatenate(x) for x in zip(*spots))
    out[rows, columns] = found.indices.to_numpy().astype(np.int64) + CODES
    return out, table + [b""] * (CODES - len(table)) + found.dictionary.to_pylist()


def portions(text: str, size: int = TEXT_CHARS) -> Iterator[str]:
    """A text in parts of about ``size`` characters, each cut behind the end of a piece."""
    at = 0
    while len(text) - at > size and (end := END.search(text, at + size)):
        yield text[at : end.end()]
        at = end.end()
    yield text[at:]


def by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str]]]:
    """Languages with some of their texts, a bounded number of characters at a time."""
    held: dict[str, list[str]] = {}
    sizes: dict[str, int] = {}
    total = 0
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH_ROWS):
            langs, texts = (batch.column(i).slice(start, BATCH_ROWS).to_pylist() for i in range(2))
            for lang, text in zip(langs, texts):
                for part in portions(text or ""):
                    held.setdefault(lang, []).append(part)
                    sizes[lang] = sizes.get(lang, 0) + len(part)
                    total += len(part)
                    if total > TEXT_CHARS:
                        most = max(sizes, key=sizes.get)
                        total -= sizes.pop(most)
                        yield most, held.pop(most)
    yield from held.items()


def summed(words: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Different edges of a text, as rows of word numbers (0 behind the end of a piece), and how often each is there."""
    starts = np.flatnonzero(words)
    padded = np.concatenate([words, np.zeros(longest, dtype=np.int64)])
    rows = np.empty((len(starts), longest), dtype=np.int64)
    rows[:, 0] = padded[starts]
    for j in range(1, longest):
        rows[:, j] = np.where(rows[:, j - 1] > 0, padded[starts + j], 0)
    mixed = np.zeros(len(starts), dtype=np.uint64)
    for j in range(longest):
        mixed = (mixed + rows[:, j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    _, first, own, n = np.unique(mixed, return_index=True, return_inverse=True, return_counts=True)
    if (rows[first][own] != rows).any():  # two edges mix alike
        return np.unique(rows, axis=0, return_counts=True)
    return rows[first], n


def edges(given: DataFrame, longest: int, splitters: list[bytes], table: list[bytes]) -> DataFrame:
    """part, key, n: edges of ``longest`` words, and shorter ones where a piece ends, with their language, summed in the task."""
    sent = given.sparkSession.sparkContext.broadcast((splitters, table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitters, table = sent.value
        codes, held, heads = coded(table), {}, led(pa.array(splitters, pa.binary()))

        def told(keys: pa.Array, n: list[int] | np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(placed(keys, splitters, heads), pa.int32()), keys, pa.array(n, pa.int64())], names=["part", "key", "n"])

        def all_held() -> pa.RecordBatch:
            return told(pa.array(held, pa.binary()), list(held.values()))

        for lang, texts in by_language(batches):
            known = Words(codes)
            rows, n = summed(known.cut(texts), longest)
            own, small = codes.get(lang.encode()) or literal(lang.encode()), (rows[:, SMALL:] == 0).all(axis=1)
            # One task sees short ones again and again.
            for key, more in zip(known.keys(own, rows[small, :SMALL]).to_pylist(), n[small].tolist()):
                held[key] = held.get(key, 0) + more
            rows, n = rows[~small], n[~small]
            for start in range(0, len(rows), HELD):
                yield told(known.keys(own, rows[start : start + HELD]), n[start : start + HELD])
            if len(held) > HELD:
                yield all_held()
                held.clear()
        if held:
            yield all_held()

    return given.mapInArrow(run, "part int, key binary, n long")


def looked_at(given: DataFrame, longest: int) -> tuple[list[bytes], list[bytes]]:
    """Keys that cut all edges into parts of about equal size, and frequent words, from a bounded look at some texts.

    They decide where an edge is summed, how many bytes it takes, and nothing else.
    """
    parts = max(LEAST_RANGES, RANGES * int(given.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    texts = 2 + parts
    places = 1 + 2 * parts * LOOKS // texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                known = Words()
                words = known.cut([next(portions(text.as_py()))])
                rows, _ = summed(words, longest)
                rows = rows[np.arange(places) * len(rows) // places] if len(rows) else rows
                phrases = [[known.listed[i] for i in row if i] for row in rows.tolist()]
                often = np.argsort(-np.bincount(words, minlength=2)[2:], kind="stable")[:LOOKED_WORDS] + 2
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang.encode()], pa.binary()), pa.array([phrases], pa.list_(pa.list_(pa.binary()))),
                    pa.array([[known.listed[i] for i in often.tolist()]], pa.list_(pa.binary())),
                ], names=["lang", "phrases", "words"])

    share = min(1.0, 1.2 * texts / max(1, given.count()))
    fields = "lang binary, phrases array<array<binary>>, words array<binary>"
    found = given.filter("text != ''").sample(share, seed=7).mapInArrow(run, fields).limit(2 * texts).collect()
    # Words are taken from some texts and keys from others, in which words are as rare as everywhere.
    seen = Counter({bytes(r["lang"]): len(found) for r in found})
    for r in found[::2]:
        seen.update(w[1:] for w in map(bytes, r["words"]) if w[0] <= SIZE)
    table = [w for w, _ in seen.most_common(CODES)]
    codes = coded(table)
    plain = {literal(w): codes[w] for w in table}
    keys = sorted({
        b"".join([codes.get(bytes(r["lang"])) or literal(bytes(r["lang"])), *(plain.get(w, w) for w in map(bytes, phrase))])[:SIZE]
        for r in found[1::2] for phrase in r["phrases"]
    })
    return [keys[i * len(keys) // parts] for i in range(1, parts)] if len(keys) > parts else keys, table


#: Different words of a text that are looked at, and bytes of a word or key.
LOOKED_WORDS, SIZE = 2000, 64


def flows(ordered: DataFrame, least: int, longest: int, table: list[bytes]) -> DataFrame:
    """lang, phrase, k, a: counts of all phrases that occur ``least`` times, from edges in order; k = 0 counts all words.

    Edges that begin with a phrase lie together. A sum that is below ``least``
    is left out unless it may go on elsewhere: in the next batch, or in the
    next part.
    """
    sent = ordered.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            part, n = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            words, listed = decoded(batch.column(1), longest, sent.value)
            new = np.concatenate([[True], part[1:] != part[:-1]])
            edge = np.concatenate([new, [True]])  # where sums may go on elsewhere
            out: list[tuple[bytes, bytes, int, int]] = []
            for k in range(longest + 1):
                new[1:] |= words[1:, k] != words[:-1, k]
                first = np.flatnonzero(new)
                last = np.concatenate([first[1:], [len(n)]])
                a = np.add.reduceat(n, first)
                kept = (words[first, k] >= 0) & ((a >= least) | edge[first] | edge[last] | (k == 0))
                for row, times in zip(words[first[kept], : k + 1].tolist(), a[kept].tolist()):
                    out.append((listed[row[0]], b" ".join([listed[w] for w in row[1:]]), k, times))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), KINDS)], names=["lang", "phrase", "k", "a"])

    found = ordered.mapInArrow(run, "lang binary, phrase binary, k int, a long")
    total = found.groupBy("lang", "phrase", "k").agg(F.sum("a").alias("a")).filter((F.col("a") >= least) | (F.col("k") == 0))
    return total.select(F.col("lang").cast("string").alias("lang"), F.col("phrase").cast("string").alias("phrase"), "k", "a")


KINDS = [pa.binary(), pa.binary(), pa.int32(), pa.int64()]


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, longest: int = 5) -> DataFrame:
    """lang, phrase, k, a: every phrase of one to ``longest`` words that occurs ``least`` times or more, as a written table.

    The row with k = 0 of a language has the number of all its words.
    """
    given = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
    splitters, table = looked_at(given, longest)
    found = edges(given, longest, splitters, table)
    return durable(flows(found.repartition("part").sortWithinPartitions("key"), least, longest, table))


def compacted(counts: DataFrame, share: int) -> DataFrame:
    """lang, phrase of those that flow on into a longer phrase.

    If a longer phrase holds one with ``share`` of a hundred of its count, so
    does the one that is longer by just the next word on that side.
    """
    words = F.split("phrase", " ")
    inner = F.array(F.array_join(F.slice(words, 1, F.col("k") - 1), " "), F.array_join(F.slice(words, 2, F.col("k") - 1), " "))
    longer = counts.filter("k > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), F.col("a").alias("on"))
    flow = longer.groupBy("lang", "phrase").agg(F.max("on").alias("on"))
    whole = F.col("on").cast("decimal(38,0)") * 100 >= F.col("a").cast("decimal(38,0)") * share
    return counts.join(flow, ["lang", "phrase"]).filter(whole).select("lang", "phrase")


def exact_score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)) without rounding or overflow.

    Counts stay below 10^16, so that both products have 38 digits at most; the
    quotient is 1000 * n at most, since ``a`` is not above either part.
    """
    def wide(c: Column) -> Column:
        return c.cast("decimal(16,0)")

    product = wide(a) * wide(n) * F.lit(1000).cast("decimal(4,0)")
    parts = wide(left) * wide(right)
    return ((product - product % parts) / parts).cast("decimal(20,0)").cast("long")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, longest: int = 5,
                 share: int = 100, top: int = 2000) -> DataFrame:
    """The ``top`` phrases of two to ``longest`` words of each language.

    A candidate occurs ``least`` times or more. Its score is that of its worst
    cut in two: floor(1000 * a * n / (l * r)), of equal ones the first cut. A
    candidate inside a longer one that has ``share`` of a hundred of its count
    is dropped. Occurrences overlap; letters A-Z are lower-cased, no others.

    A null language is ``und``, null and empty texts have no words, repeated
    rows count each, long texts are cut whole, an empty table gives no rows,
    and only the two named columns are read.

    All texts are read once for their edges, and edges are shuffled once. A
    phrase that many edges begin with lies in as many ranges as it needs.

    Returns lang, rank, phrase, a, l, r, n, score.
    """
    counts = phrase_counts(docs, text, lang, least, longest)
    total = counts.filter("k = 0").select("lang", F.col("a").alias("n"))
    words = F.split("phrase", " ")
    cuts = F.transform(F.sequence(F.lit(1), F.col("k") - 1), lambda i: F.struct(
        i.alias("cut"), F.array_join(F.slice(words, 1, i), " ").alias("ahead"),
        F.array_join(F.slice(words, i + 1, F.col("k") - i), " ").alias("behind"),
    ))
    candidates = counts.filter("k > 1")
    kept = candidates.join(compacted(candidates, share), ["lang", "phrase"], "left_anti")
    cut = kept.select("lang", "phrase", "a", F.explode(cuts).alias("c")).select("lang", "phrase", "a", "c.*")
    parts = counts.filter("k > 0")
    ahead = parts.select("lang", F.col("phrase").alias("ahead"), F.col("a").alias("l"))
    behind = parts.select("lang", F.col("phrase").alias("behind"), F.col("a").alias("r"))
    scored = (
        cut.join(ahead, ["lang", "ahead"]).join(behind, ["lang", "behind"]).join(total, "lang")
        .withColumn("score", exact_score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
        .groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("s"))
        .select("lang", "phrase", "a", "s.l", "s.r", "n", "s.score")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
