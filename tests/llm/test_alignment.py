"""Token alignment against plain sets of ends, and corpus-wide counts against a counter."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from buildmend.llm import alignment
from buildmend.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
A, B, RANKS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model", "byte_bpe_50k.tiktoken"))
ODD = [
    None, "", " ", "a", "  two  blanks\n\n\tand more ", "<|endoftext|> <s> </s> <unk> <0x41>", "▁ is no space", "\x00 nul", "ünïcödé 𝔘𝔫𝔦 ß İ ſ K", "日本語 и кириллица",
    "é ﬁ ½ ²", "x" * 5000, " " * 3000 + "end", "don't 'S 'll we're", "\r\n  　", "\U0001f600" * 50,
]
rising = st.lists(st.integers(0, 400), unique=True).map(sorted)


class Plain:
    """Both tokenizers from their files, and the groups by sets of ends."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.letter = alignment.byte_letters()

    def __call__(self, text):
        if not text:
            return [], [], []
        a, b = self.a.encode(" " + text, add_special_tokens=False), self.b.encode(text)
        a_bytes = [bytes(self.letter[c] for c in t) for t in a.tokens]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, self.b.id_to_piece(b))]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            return [], [], []
        ends_a, ends_b = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
        groups, links, at_a, at_b = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            i, j = ends_a.index(end, at_a) + 1, ends_b.index(end, at_b) + 1
            groups.append((a.ids[at_a:i], b[at_b:j]))
            links.append((a.ids[i - 1], b[j - 1]))
            at_a, at_b = i, j
        return [a.ids, b], groups, links


@pytest.fixture(scope="module")
def plain():
    return Plain()


def wanted(rows, plain):
    known = [(i, *plain(text)) for i, text in rows]
    counts = Counter(link for _, _, _, links in known for link in links)
    highest = defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    out = []
    for i, ids, groups, links in known:
        told = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((
            i, len(ids[0]) if ids else 0, len(ids[1]) if ids else 0, len(groups), len(links),
            sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links),
            hashlib.sha256(told.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=str)


def test_query_equals_sets_of_ends(spark, plain):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    got = QUERIES["op11_alignment"](spark, FOLDER)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == wanted(rows, plain)


@pytest.mark.parametrize("ranks", [None, RANKS])
def test_odd_texts_repeated_rows_and_extra_columns(spark, plain, ranks):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "a"), (None, "again and again"), (None, "again and again")]
    docs = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], "doc_id long, text string, n_a int, links string, digest int")
    got = alignment.alignment(docs, A, B, ranks, public_tokenizers.PATTERN)
    found = sorted((tuple(r) for r in got.collect()), key=str)
    assert found == wanted(rows, plain)
    assert {r[0] for r in found if r[1] == 0} == {0, 1, 6}
    assert alignment.alignment(docs.limit(0), A, B).collect() == []


def test_groups_give_back_both_sides(spark, plain):
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    for r in alignment.groups(docs, A, B).collect():
        ids, groups, _ = plain(ODD[r["doc_id"]])
        assert [r["a_ids"], r["b_ids"]] == (ids or [[], []])
        starts = zip([0] + r["a_ends"], r["a_ends"], [0] + r["b_ends"], r["b_ends"])
        assert [(r["a_ids"][i:j], r["b_ids"][k:m]) for i, j, k, m in starts] == groups


def test_links_are_bounded_by_the_vocabularies():
    own = alignment.aligner(A, B, None, None)
    ends = set(own.b_bytes)
    bound = sum(map(len, own.a_bytes)) + sum(map(len, own.b_bytes))
    found = sum(t[i:] in ends for t in own.a_bytes for i in range(len(t)))
    assert found < bound < 1_000_000


@settings(max_examples=300, deadline=None)
@given(rising, rising)
def test_gallop_finds_what_a_search_finds(a, b):
    a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
    assert alignment.gallop(a, b).tolist() == np.searchsorted(b, a).tolist()
    i, j = alignment.common(a, b)
    assert a[i].tolist() == b[j].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def test_gallop_over_far_places():
    long = np.arange(0, 1_000_000, 3)
    for short in (np.arange(5), np.arange(2_999_000, 2_999_900), np.array([0, 1, 999_999, 1_000_000]), np.arange(400_000, 400_500)):
        assert alignment.gallop(short, long).tolist() == np.searchsorted(long, short).tolist()
