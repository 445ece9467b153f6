"""Fingerprints, packing, sharding, decontamination, near-duplicates by brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from buildmend.llm import components, decontamination, imatch, near_dedup, packing, sharding
from buildmend.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def documents(spark):
    return [(r["doc_id"], r["text"] or "", r["source"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


def test_edited_texts_and_likeness(spark, documents):
    got = {r["doc_id"]: r for r in QUERIES["op5_imatch"](spark, FOLDER).collect()}
    order = sorted(documents)
    near, other = [], []
    for (i, text, _), (_, after, _) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        r = got[i]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        near.append(r["near_edited"])
        other.append(r["near_next"])
    by_text = defaultdict(set)
    for i, text, _ in documents:
        by_text[text].add(got[i]["fingerprint"])
    assert max(map(len, by_text.values())) == 1 and len(by_text) < len(documents)
    assert np.mean(near) > 5 * np.mean(other) and all(0 <= x <= 1 for x in near + other)


def test_lexicon_is_the_band_of_all_documents(spark, documents):
    df = defaultdict(int)
    for _, text, _ in documents:
        for t in set(re.findall(r"[^\W_]+", text.lower())):
            df[t] += 1
    n = len(documents)
    want = sorted(t for t, k in df.items() if max(2, -(-n // 100)) <= k <= 0.2 * n)
    assert imatch.lexicon(spark.read.parquet(f"{FOLDER}/documents.parquet"), least=0.01, most=0.2).words == want


def test_ids_equal_the_tokenizer(documents):
    known, own = packing.Ids(PATH), Tokenizer.from_file(PATH)
    assert known.alike
    odd = ["İstanbul Σας ﬁ ½ ² é  x", "<|endoftext|> a", "''s 'S 'LL d'accord ____ a_b 1a2", "", " \n", "ÀÖØöøÿß×÷ µªº", "tab\tcr\rnl\n x"]
    for text in odd + [t for _, t, _ in documents[:400]]:
        assert np.frombuffer(known.of(text), known.kind).tolist() == own.encode(text, add_special_tokens=False).ids + [1], text[:80]


def test_schedule_serves_every_window_by_share():
    totals = [50_000, 1, 0, 7_000, 120, 33_333]
    plan = packing.Schedule(totals, 1024, 256)
    last = (0,) * len(totals)
    for w in range(1, sum(totals) // 1024 + 2):
        now = plan.before(w)
        assert sum(now) == min(w * 1024, sum(totals)) and all(a >= b for a, b in zip(now, last))
        assert all(abs(a - sum(now) * t / sum(totals)) < len(totals) for a, t in zip(now, totals))
        last = now
    assert last == tuple(totals)


def test_packing_round_trip(spark, documents):
    got = QUERIES["op6_packing"](spark, FOLDER).collect()
    own = Tokenizer.from_file(PATH)
    ids = {i: np.array(own.encode(t, add_special_tokens=False).ids + [1], dtype="<u4") for i, t, _ in documents}
    spans, line, mixture = defaultdict(list), defaultdict(list), defaultdict(lambda: defaultdict(int))
    source = {i: s for i, _, s in documents}
    for r in got:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] > 0 and zlib.crc32(part.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        spans[r["doc_id"]].append((r["start"], r["length"]))
        line[r["sequence_id"]].append((r["offset"], r["length"]))
        mixture[r["window"]][source[r["doc_id"]]] += r["length"]
    for parts, size in [(sorted(spans[i]), len(x)) for i, x in ids.items()] + [(sorted(v), None) for v in line.values()]:
        at = 0
        for start, n in parts:
            assert start == at
            at += n
        assert size is None or at == size
    lengths = {s: sum(n for _, n in v) for s, v in line.items()}
    assert sorted(line) == list(range(len(line))) and max(lengths.values()) <= 2048
    assert all(n == 2048 or n & (n - 1) == 0 for n in lengths.values())
    total = sum(map(len, ids.values()))
    share = defaultdict(float)
    for i, x in ids.items():
        share[source[i]] += len(x) / total
    for w, own_mix in mixture.items():
        size = sum(own_mix.values())
        assert all(abs(own_mix[s] - share[s] * size) <= 2 * len(share) for s in share), w


def test_sources_beyond_the_bound_share_queues(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 90))), None if i % 50 == 0 else f"s{i % 50}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5, "doc_id")
    got = packing.packed(docs, PATH, length=64, window=4, most_queues=7).collect()
    spans, line = defaultdict(list), defaultdict(list)
    for r in got:
        assert r["queue"] == (rows[r["doc_id"]][2] or "")
        spans[r["doc_id"], r["doc_tokens"]].append((r["start"], r["length"]))
        line[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(i for i, _ in spans) == list(range(600))
    for parts, size in [(sorted(v), n) for (_, n), v in spans.items()] + [(sorted(v), None) for v in line.values()]:
        at = 0
        for start, n in parts:
            assert start == at
            at += n
        assert at == size if size else at == 64 or at & (at - 1) == 0
    assert sorted(line) == list(range(len(line)))


def test_shards(spark, documents):
    got = QUERIES["op8_sharding"](spark, FOLDER).collect()
    text = {i: t for i, t, _ in documents}
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in got:
        raw = text[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert len(got) == len(documents) and set(slots) == set(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    even = sum(sizes.values()) / 40
    assert max(abs(s - even) for s in sizes.values()) <= max(r["size"] for r in got)


def test_hot_key_is_cut_by_its_ids(spark):
    rows = [(i, "the same text" if i % 3 else f"text {i}") for i in range(6000)]
    got = sharding.sharded(spark.createDataFrame(rows, "doc_id long, text string"), 8, sample=512, ranges=64).collect()
    sizes = defaultdict(int)
    for r in got:
        sizes[r["shard"]] += r["size"]
    assert len(got) == 6000 and max(sizes.values()) - min(sizes.values()) <= 64


def edits(words, rate, rng):
    out = []
    for w in words:
        x = rng.random()
        if x < rate / 3:
            continue
        out.append(f"new{rng.randrange(10**6)}" if x < 2 * rate / 3 else w)
        if x > 1 - rate / 3:
            out.append(f"add{rng.randrange(10**6)}")
    return out


def planted(n_docs, rate, seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    word = lambda: vocabulary[min(2999, int(rng.paretovariate(0.7)))]
    items = [(k, " ".join(word() for _ in range(rng.randint(12, 60)))) for k in range(80)]
    docs = []
    for i in range(n_docs):
        body = [word() for _ in range(rng.randint(30, 300))]
        if i % 2:
            at = rng.randrange(len(body))
            body[at:at] = edits(items[i % 80][1].split(), rate, rng)
        docs.append((i, " ".join(body)))
    return docs, items


def brute_leaks(docs, items):
    want = {}
    for i, text in docs:
        line = decontamination.hashed(decontamination.words_of(text))
        for k, item in items:
            own = decontamination.hashed(decontamination.words_of(item))
            distance = int(decontamination.row_by_row(own, line).min())
            if distance <= int(0.2 * len(own)):
                want[i, k] = distance
    return want


@pytest.mark.parametrize(("rate", "least"), [(0.0, 1.0), (0.06, 0.95), (0.12, 0.9)])
def test_recall_against_brute_force(spark, rate, least):
    docs, items = planted(400, rate)
    want = brute_leaks(docs, items)
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in decontamination.leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert set(got) <= set(want) and all(got[p] >= want[p] for p in got)
    assert len(want) > 150 and len(got) / len(want) >= least


@pytest.mark.parametrize(("low", "high"), [(60, 100), (100, 200), (200, 400), (400, 600)])
@pytest.mark.parametrize("spread", ["random", "even"])
def test_recall_of_long_items_at_the_most_edits(low, high, spread):
    rng = random.Random(low)
    word = lambda: f"w{int(3000 ** rng.random())}"
    items, lines = [], []
    while len(items) < 60:
        own = [word() for _ in range(rng.randint(low, high))]
        copy = edits(own, 0.2, rng) if spread == "random" else [f"new{i}" if i % 5 == 4 else w for i, w in enumerate(own)]
        line = [word() for _ in range(150)] + copy + [word() for _ in range(150)]
        own, copy = ([w.encode() for w in x] for x in (own, copy))
        if decontamination.row_by_row(decontamination.hashed(own), decontamination.hashed(copy)).min() <= int(0.2 * len(own)):
            items.append((len(items), own))
            lines.append(decontamination.hashed([w.encode() for w in line]))
    found = decontamination.search_many(lines, decontamination.Index(items))
    assert sum(i in best for i, best in enumerate(found)) / len(items) >= 0.95


def test_edit_distance_of_the_best_substring():
    rng = np.random.default_rng(4)
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
            row = new
        return row[-1]
    for _ in range(60):
        item, text = rng.integers(0, 4, rng.integers(1, 7)), rng.integers(0, 4, rng.integers(0, 10))
        d, a, b = decontamination.closest(item, text)
        assert d == min(plain(item, text[i:j]) for i in range(len(text) + 1) for j in range(i, len(text) + 1)) == plain(item, text[a:b])


def test_pieces_of_a_long_text_miss_nothing(monkeypatch):
    docs, items = planted(40, 0.05)
    index = decontamination.Index([(k, decontamination.words_of(t)) for k, t in items])
    line = decontamination.hashed(decontamination.words_of(" ".join(t for _, t in docs)))
    whole = decontamination.search(line, index)
    parts = set()
    for a, b in decontamination.pieces(len(line), 500, 180):
        parts |= set(decontamination.search(line[a:b], index))
    assert whole and len(set(whole) - parts) <= 1


def brute_groups(docs, k, percent):
    sets = {}
    for i, text in docs:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets[i] = {tuple(words[j : j + k]) for j in range(max(1, len(words) - k + 1))} if words else set()
    parent = {i: i for i, _ in docs}
    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    at = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            at[x].append(i)
    for i, s in sets.items():
        meets = defaultdict(int)
        for x in s:
            for j in at[x]:
                meets[j] += 1
        for j, n in meets.items():
            if j < i and 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i, _ in docs}


def check_groups(got, docs, k, percent=80):
    want = brute_groups(docs, k, percent)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_given_documents_by_brute_force(spark, documents):
    check_groups(QUERIES["op10_near_dedup"](spark, FOLDER).collect(), [(i, t) for i, t, _ in documents], 4)


def test_one_hot_group_of_near_copies_and_a_common_passage(spark):
    rng = random.Random(8)
    base = [f"b{i}" for i in range(120)]
    passage = [f"p{i}" for i in range(60)]
    docs = []
    for i in range(900):
        if i % 3 == 0:
            body = edits(base, rng.choice([0.0, 0.02, 0.04]), rng)
        elif i % 3 == 1:
            body = passage + [f"x{rng.randrange(10**6)}" for _ in range(rng.randint(5, 120))]
        else:
            body = [f"y{rng.randrange(10**6)}" for _ in range(rng.randint(0, 60))]
        docs.append((i, " ".join(body)))
    got = near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), k=4).collect()
    check_groups(got, docs, 4)


def test_components_of_random_graphs(spark):
    rng = random.Random(2)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 620)]
    links = [(a, b) for a, b in links if a != b]
    parent = {}
    def root(x):
        parent.setdefault(x, x)
        return x if parent[x] == x else root(parent[x])
    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r["v"]: r["label"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {v: root(v) for v in list(parent)}
