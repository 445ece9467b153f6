"""Phrase collocations against counting of all phrases."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from buildmend.llm import collocations
from buildmend.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.01"


def plain(rows, least, longest=5, share=100, top=2000):
    """By counting every phrase of every piece."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            ws = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, longest + 1):
                f[lang].update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = {b[i : i + k] for b, a in found.items() for k in range(2, len(b)) for i in range(len(b) - k + 1) if 100 * a >= share * counts[b[i : i + k]]}
        scored = []
        for p, a in found.items():
            if p not in inside:
                score, cut = min((1000 * a * n[lang] // (counts[p[:c]] * counts[p[c:]]), c) for c in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:cut]], counts[p[cut:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(12)] + ["Ünter", "naïve", "don't", "日本", "a\x00b", "x-y", "(z)"]
    texts = []
    for i in range(400):
        t = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", " W0 w1 w2 w3 w4 w5 w6 "]) for _ in range(rng.randrange(60)))
        texts.append((t, rng.choice(["en", "en", "fr", None, "und"])))
    return texts + [(None, "en"), ("", None), (" .,;", "fr"), ("w0 " * 500, "en"), (texts[0][0], texts[0][1]), ("W1 w2. " * 300, "xx")]


@pytest.mark.parametrize("least,longest,share,top", [(5, 5, 100, 2000), (2, 5, 100, 50), (8, 4, 60, 2000), (3, 3, 90, 7), (4, 2, 100, 2000)])
def test_equals_counting(spark, corpus, least, longest, share, top):
    docs = spark.createDataFrame([(i, t, lang, 1, "p") for i, (t, lang) in enumerate(corpus)], "doc_id long, text string, lang string, n int, phrase string").repartition(5)
    got = collocations.collocations(docs, least=least, longest=longest, share=share, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert rows_of(got) == plain(corpus, least, longest, share, top)


def test_small_batches_and_many_ranges_count_alike(spark, corpus, monkeypatch):
    """Sums go on from batch to batch and from part to part."""
    docs = spark.createDataFrame(corpus, "text string, lang string").repartition(3)
    monkeypatch.setattr(collocations, "RANGES", 40)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert rows_of(collocations.collocations(docs, least=5)) == plain(corpus, 5)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_small_portions_and_long_texts_count_alike(spark, corpus, monkeypatch):
    joined = ". ".join(t for t, lang in corpus if lang == "en" and t)
    assert "".join(collocations.portions(joined, 100)) == joined and len(list(collocations.portions(joined, 100))) > 20
    assert list(collocations.portions("", 100)) == [""] and list(collocations.portions("x" * 500, 100)) == ["x" * 500]
    docs = spark.createDataFrame([(joined, "en"), (joined, "en")], "text string, lang string")
    assert rows_of(collocations.collocations(docs, least=5)) == plain([(joined, "en")] * 2, 5)


def test_query_equals_counting_and_its_sql(spark):
    got = rows_of(QUERIES["op12_collocations"](spark, FOLDER))
    rows = [(r["text"], r["lang"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert got == plain(rows, 100) and len(got) > 50
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
        assert got == sorted(con.execute(ORACLES["op12_collocations"]).fetchall())


def test_edges_that_mix_alike_are_told_apart(monkeypatch):
    words = collocations.Words().cut(["a b c a b. c a b c", "a b c"])
    rows, n = collocations.summed(words, 3)
    real = np.unique
    monkeypatch.setattr(collocations.np, "unique", lambda x, **k: real(x, **k) if "axis" in k else real(x * 0, **k))
    again, times = collocations.summed(words, 3)
    assert sorted(zip(map(tuple, rows.tolist()), n)) == sorted(zip(map(tuple, again.tolist()), times))


def test_scores_are_exact_beyond_64_bits(spark):
    rng = random.Random(1)
    rows = [(10**12, 10**15, 10**12, 10**12), (10**15, 10**15, 10**15, 10**15), (100, 10**15, 100, 100), (1, 1, 1, 1), (999_999_999_999, 999_999_999_999_999, 10**12 + 7, 10**13 - 9)]
    for _ in range(200):
        a = rng.randrange(100, 10**13)
        rows.append((a, rng.randrange(10**13, 9 * 10**15), rng.randrange(a, 10**13 + 1), rng.randrange(a, 10**13 + 1)))
    df = spark.createDataFrame(rows, "a long, n long, l long, r long").withColumn("score", collocations.exact_score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    for r in df.collect():
        assert r["score"] == 1000 * r["a"] * r["n"] // (r["l"] * r["r"])


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "text string, lang string, a long")
    assert collocations.collocations(docs).collect() == []
    assert collocations.collocations(spark.createDataFrame([(None, None, 1), ("", "en", 2)], docs.schema)).collect() == []


def test_a_batch_is_cut_by_its_own_words():
    known = collocations.Words()
    cut = known.cut(["A b\tB  a.", "", "b\x0bA"])
    assert [known.listed[i] if i else b"." for i in cut] == [b"\x01a", b"\x01b", b"\x01b", b"\x01a", b".", b".", b".", b"\x01b", b".", b"\x01a", b"."]
    assert known.keys(b"\x02en", np.array([[2, 3], [3, 0]])).to_pylist() == [b"\x02en\x01a\x01b", b"\x02en\x01b"]


def test_keys_are_read_back():
    table = [f"w{i}".encode() for i in range(1000)] + [b"", b"x" * 300]
    codes, rng = collocations.coded(table), random.Random(2)
    rows = [[rng.choice([*table[:-2], b"own", b"y" * 126, b"z" * 127, "é".encode(), b"\x80\x7f\x00", table[-1]]) for _ in range(rng.randrange(1, 5))] for _ in range(500)]
    keys = pa.array([b"".join(codes.get(w) or collocations.literal(w) for w in row) for row in rows], pa.binary())
    for some, want in ((keys, rows), (keys.slice(17, 100), rows[17:117]), (keys.slice(0, 0), [])):
        words, listed = collocations.decoded(some, 3, table)
        assert [[listed[i] for i in row if i >= 0] for row in words.tolist()] == want


def test_words_below_a_blank_come_back(spark):
    text = "a\x01b a a\x7fb \x00 \x1f a\x01b a\x7fb. " * 6 + "a b. " * 6
    docs = spark.createDataFrame([(text, "en")], "text string, lang string")
    assert rows_of(collocations.collocations(docs, least=6, share=101)) == plain([(text, "en")], 6, share=101)
    assert rows_of(collocations.collocations(docs, least=6)) == plain([(text, "en")], 6)


def test_places_of_keys_equal_those_by_whole_comparison():
    import random
    from bisect import bisect_right

    rng = random.Random(5)
    keys = [bytes(rng.choices([0, 1, 128, 255], k=rng.randint(0, 12))) for _ in range(5000)] + [b"", b"\0", b"\0" * 8, b"\0" * 9]
    for some in ([], [b""], sorted(set(rng.sample(keys, 300)))):
        got = collocations.placed(pa.array(keys, pa.binary()), some, collocations.led(pa.array(some, pa.binary())))
        assert got.tolist() == [bisect_right(some, k) for k in keys]
    cut = pa.array(keys, pa.binary()).slice(7, 100)
    assert collocations.placed(cut, [b"\x80"], collocations.led(pa.array([b"\x80"], pa.binary()))).tolist() == [bisect_right([b"\x80"], k) for k in keys[7:107]]
