"""Cross-tokenizer alignment by galloping intersection of token ends.

Two tokenizers cut the same bytes. The shorter list of token ends drives an
exponential and then a binary search into the longer one; the ends that both
have cut the tokens into groups, and differences of their ranks give the
tokens of each group on either side. Corpus-wide counts of the id pairs that
end together then say how usual each link is.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buildmend.llm.common import by_batch
from buildmend.session import durable

#: Fixed value: what stands for a space in a piece.
SPACE = "▁"
#: The rank file cuts these texts as the tokenizer file does; others, and very long runs, go to the tokenizer file.
PLAIN = re.compile(r"[\t\n\r\x20-ɏ‐-‧€]*")
RUN = re.compile(r"\S{1000}|\s{1000}")
NONE = np.zeros(0, dtype=np.int64)


def byte_letters() -> dict[str, int]:
    """The letter of each byte in byte-level vocabularies: itself where it prints, else one from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligned(NamedTuple):
    """Ids of both tokenizers and, for each group, how many tokens of either side lie before its end."""

    a: np.ndarray
    b: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray


NOTHING = Aligned(NONE, NONE, NONE, NONE)


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each value of ``short`` the first place in ``long`` that is not below it; both rise.

    All values search at once: each starts at its share of the longer list,
    doubles its steps up or down until it has passed its value, and halves the
    range that is left.
    """
    n = len(long)
    at = np.arange(len(short)) * n // max(1, len(short))
    up = long[at] < short if n else np.zeros(len(short), dtype=bool)
    lo, hi = np.where(up, at, at - 1), np.where(up, at + 1, at)  # long[lo] is below, long[hi] is not, once passed
    open_, step = np.flatnonzero(up), 1
    while len(open_ := open_[(hi[open_] < n)]) and len(open_ := open_[long[hi[open_]] < short[open_]]):
        lo[open_] = hi[open_]
        hi[open_] = np.minimum(hi[open_] + step, n)
        step *= 2
    open_, step = np.flatnonzero(~up), 1
    while len(open_ := open_[(lo[open_] >= 0)]) and len(open_ := open_[long[lo[open_]] >= short[open_]]):
        hi[open_] = lo[open_]
        lo[open_] = np.maximum(lo[open_] - step, -1)
        step *= 2
    open_ = np.flatnonzero(hi - lo > 1)
    while len(open_):
        middle = (lo[open_] + hi[open_]) // 2
        below = long[middle] < short[open_]
        lo[open_[below]], hi[open_[~below]] = middle[below], middle[~below]
        open_ = open_[hi[open_] - lo[open_] > 1]
    return hi


def common(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` of the values that both hold."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    at = gallop(short, long)
    inside = np.flatnonzero(at < len(long))
    inside = inside[long[at[inside]] == short[inside]]
    return (inside, at[inside]) if short is a else (at[inside], inside)


class Aligner:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str, a_ranks: str | None = None, pattern: str | None = None):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters, vocab = byte_letters(), self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode())
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in own]) for own in (self.a_bytes, self.b_bytes))
        self.fast = None
        if a_ranks is not None:
            import base64

            import tiktoken

            with open(a_ranks, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            if all(self.a_bytes[i] == token for token, i in ranks.items()):
                self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        #: What holds a link, by the size of the vocabularies.
        self.width = "<u4" if len(self.a_bytes) * len(self.b_bytes) <= 1 << 32 else "<u8"
        # Decimal ids with what may follow them in a digest.
        sizes = (len(self.a_bytes), ",|"), (len(self.b_bytes), ",;")
        self.words = np.array([f"{i}{end}" for n, ends in sizes for end in ends for i in range(n)], dtype=object)

    def a_ids(self, text: str) -> list[int]:
        if self.fast is not None and PLAIN.fullmatch(text) and not RUN.search(text):
            return self.fast.encode_ordinary(text)
        return self.a.encode(text, add_special_tokens=False).ids

    def align(self, text: str | None) -> Aligned:
        """Groups of the tokens of a text; nothing where either side does not give back the text's bytes."""
        if not text:
            return NOTHING
        whole = " " + text
        a, b, body = self.a_ids(whole), self.b.encode(text), whole.encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != body or b"".join(map(self.b_bytes.__getitem__, b)) != body:
            return NOTHING
        a, b = np.array(a), np.array(b)
        at_a, at_b = common(np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b]))
        return Aligned(a, b, at_a + 1, at_b + 1)

    def digest(self, of: Aligned) -> str:
        """SHA-256 of the groups as ``a1,a2|b1;a3|b2``; empty where there are no tokens."""
        if not len(of.a):
            return ""
        n, m = len(self.a_bytes), len(self.b_bytes)
        a_last, b_last = (np.zeros(len(x), dtype=np.int64) for x in (of.a, of.b))
        a_last[of.a_ends - 1], b_last[of.b_ends - 1] = 1, 1
        # Tokens of one side come behind the other side's groups ahead of them.
        out = np.empty(len(of.a) + len(of.b), dtype=object)
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        out[np.arange(len(of.a)) + np.concatenate([[0], of.b_ends])[a_group]] = self.words[of.a + n * a_last]
        out[np.arange(len(of.b)) + of.a_ends[b_group]] = self.words[2 * n + of.b + m * b_last]
        return hashlib.sha256("".join(out.tolist())[:-1].encode()).hexdigest()

    def links(self, of: Aligned) -> np.ndarray:
        """One number for each pair of tokens that end together."""
        return (of.a[of.a_ends - 1] * len(self.b_bytes) + of.b[of.b_ends - 1]).astype(self.width)


@lru_cache(maxsize=1)
def aligner(*of: str | None) -> Aligner:
    """One for each worker process: building the tables takes longer than a small task."""
    return Aligner(*of)


def groups(docs: DataFrame, a_path: str, b_path: str, a_ranks: str | None = None, pattern: str | None = None,
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokens of both sides and their groups, one row for each document.

    Returns ``<doc_id>``, a_ids, b_ids, a_ends, b_ends: group i holds the
    tokens from place ``ends[i - 1]`` (0 for the first) up to ``ends[i]`` of
    either side. Texts that are null, empty or not given back byte by byte by
    both tokenizers have empty lists. Long texts are aligned whole.
    """
    given = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("body"))

    def make():
        own = aligner(a_path, b_path, a_ranks, pattern)

        def run(batch: dict[str, list]) -> dict[str, list]:
            found = [own.align(t) for t in batch["body"]]
            return {"id": batch["id"]} | {name: [list(getattr(x, part)) for x in found] for name, part in zip(LISTS, Aligned._fields)}

        return run

    kind = given.schema["id"].dataType.simpleString()
    return by_batch(given, make, f"id {kind}, " + ", ".join(f"{name} array<int>" for name in LISTS)).withColumnRenamed("id", doc_id)


LISTS = ["a_ids", "b_ids", "a_ends", "b_ends"]


def alignment(docs: DataFrame, a_path: str, b_path: str, a_ranks: str | None = None, pattern: str | None = None,
              doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """How the tokens of two tokenizers meet in each document, against the whole corpus.

    ``a_path`` is a byte-level tokenizer file, which gets a space and the text;
    ``b_path`` a piece model with byte fallback, which adds the space itself.
    ``a_ranks`` with ``pattern`` may name a rank file of the same vocabulary,
    which is used for texts of plain letters, where both cut alike.

    A link is a pair of tokens that end at the same byte; its count is how many
    links of the corpus join the same two ids. Texts that are null, empty or
    not given back byte by byte have zeros and an empty digest. Long texts are
    aligned whole, repeated rows count each, an empty table gives no rows, and
    only the named columns are read.

    The counts are sent to all tasks: one of two tokens that end together ends
    with the other, so the number of different links is at most the number of
    bytes in both vocabularies, whatever the corpus.

    Returns ``<doc_id>``, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.
    """
    given = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("body"))
    kind = given.schema["id"].dataType.simpleString()

    def aligning():
        own = aligner(a_path, b_path, a_ranks, pattern)

        def run(batch: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {name: [] for name in ("id", "n_a", "n_b", "digest", "links")}
            for i, body in zip(batch["id"], batch["body"]):
                of = own.align(body)
                row = i, len(of.a), len(of.b), own.digest(of), own.links(of).tobytes()
                for name, value in zip(out, row):
                    out[name].append(value)
            return out

        return run

    rows = durable(by_batch(given, aligning, f"id {kind}, n_a long, n_b long, digest string, links binary"))

    own = aligner(a_path, b_path, a_ranks, pattern)
    width, pieces = own.width, len(own.b_bytes)

    def counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, LINK_ROWS):
                held = b"".join(batch.column(0).slice(start, LINK_ROWS).to_pylist())
                link, n = np.unique(np.frombuffer(held, dtype=width), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(link.astype(np.int64)), pa.array(n.astype(np.int64))], names=["link", "n"])

    counted = rows.select("links").mapInArrow(counting, "link long, n long").groupBy("link").agg(F.sum("n").alias("n")).toPandas()
    counted = counted.sort_values("link")
    link, n = counted["link"].to_numpy(dtype=np.int64), counted["n"].to_numpy(dtype=np.int64)
    highest = np.zeros(pieces, dtype=np.int64)
    np.maximum.at(highest, link % pieces, n)
    sent = docs.sparkSession.sparkContext.broadcast((link, n, n == highest[link % pieces]))

    def judging():
        link, n, best = sent.value

        def run(batch: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {name: [] for name in ("n_links", "n_best", "count_sum")}
            for held in batch["links"]:
                at = np.searchsorted(link, np.frombuffer(held, dtype=width).astype(np.int64))
                for name, value in zip(out, (len(at), int(best[at].sum()), int(n[at].sum()))):
                    out[name].append(value)
            return {name: batch[name] for name in ("id", "n_a", "n_b", "digest")} | {"n_groups": out["n_links"]} | out

        return run

    fields = f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, digest string"
    return by_batch(rows, judging, fields).withColumnsRenamed({"id": doc_id, "digest": "groups_sha256"})


#: Documents whose links are counted at a time.
LINK_ROWS = 256
