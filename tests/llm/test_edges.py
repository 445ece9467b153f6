"""Nulls, empty and long texts, ties, repeated rows, empty tables, extra columns."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from buildmend.llm import decontamination, html_extraction, imatch, language_id, licences, near_dedup, packing, secrets, sharding, toxicity

PATH = public_tokenizers.path("word_bpe_49k.json")
EXTRA = "score double, shard int, n long, id string, v string, key string, _own int, spans string, label string, lane int, part int"
DOCS = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
LONG = "alpha beta gamma delta " * 30_000


def rows():
    extra = (None,) * 11
    base = [
        (1, "the quick brown fox jumps over the lazy dog", "en", "a", 43), (1, "the quick brown fox jumps over the lazy dog", "en", "a", 43),
        (2, None, None, None, None), (None, "le renard brun saute", "fr", "b", 20), (None, None, None, None, None),
        (3, "", "en", "a", 0), (4, "  \n\t ", "fr", "a", 5), (5, "1234 !!! ½", "en", None, 10), (6, LONG, "en", "a", len(LONG)),
        (7, "ünïcödé 𝔘𝔫𝔦 \x00 ß İ ſ K token = abcdefgh1234ABCD", None, "b", 30), (8, "the quick brown fox jumps over the lazy dog", "en", "c", 43),
    ]
    return [b + extra for b in base]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0), (1, 1), (2, None), (None, 1), (6, 0), (7, 0)], "doc_id long, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "Quick brown fox jumps over the lazy dog"), (1, None), (None, ""), (2, "renard"), (3, "renard")], "item_id long, text string")


def each(docs, labels, benchmark):
    n = docs.count()
    learn = F.col("doc_id").isNotNull()
    yield secrets.secrets(docs), n
    yield language_id.languages(docs, F.lit(True)), n
    yield toxicity.scored(docs, labels, learn), n
    yield imatch.edited(docs), n
    yield imatch.fingerprints(docs), n
    yield packing.packed(docs, PATH), None
    yield licences.licences(docs), n
    yield sharding.sharded(docs, 4), n
    yield decontamination.leaks(docs, benchmark), None
    yield near_dedup.near_duplicates(docs), n


def test_every_operator_takes_odd_rows(docs, labels, benchmark):
    for got, n in each(docs, labels, benchmark):
        found = got.collect()
        assert n is None or len(found) == n, got.columns


def test_every_operator_takes_an_empty_table(none, labels, benchmark):
    for got, _ in each(none, labels.limit(0), benchmark.limit(0)):
        assert got.collect() == [], got.columns


def test_no_labels_means_score_zero(docs, labels):
    assert {r["score"] for r in toxicity.scored(docs, labels.limit(0), F.lit(True)).collect()} == {0.0}


def test_text_without_a_letter_is_undetermined(docs):
    got = {r["doc_id"]: r for r in language_id.languages(docs.filter("doc_id is not null"), F.lit(True)).collect()}
    assert [got[i]["lang_pred"] for i in (2, 3, 4, 5)] == ["und"] * 4
    assert got[1]["lang_pred"] in ("en", "fr") and all(0 <= r["score"] <= 1 for r in got.values())


def test_nothing_to_learn_from_means_undetermined(docs):
    assert {r["lang_pred"] for r in language_id.languages(docs, F.lit(False)).collect()} == {"und"}


def test_copies_and_wordless_texts_in_groups(docs):
    got = near_dedup.near_duplicates(docs).collect()
    copies = [r for r in got if r["doc_id"] in (1, 8)]
    assert {r["component_id"] for r in copies} == {1} and sum(r["kept"] for r in copies) == 2
    assert all(r["kept"] and r["n_shingles"] == 0 for r in got if r["doc_id"] in (2, 3, 4))


def test_leaks_of_short_and_repeated_items(docs, benchmark):
    got = sorted((str(r["doc_id"]), r["item_id"], r["start"], r["distance"]) for r in decontamination.leaks(docs, benchmark).collect())
    assert got == [("1", 1, 1, 0), ("1", 1, 1, 0), ("8", 1, 1, 0), ("None", 2, 1, 0), ("None", 3, 1, 0)]


def test_pages(spark):
    schema = "page_id long, url string, html string, text string, id int, n_chars string"
    pages = [(1, "u", None), (1, "u", None), (2, None, ""), (None, "u", "<p>"), (3, "u", "<article><p>One &lt; two<p>Three" + " words" * 30), (4, "u", "<" * 500), (5, "u", "<div>" * 3000 + "deep, deep text in here.")]
    got = {(r["page_id"], r["url"]): r for r in html_extraction.extracted(spark.createDataFrame([p + (None,) * 3 for p in pages], schema), training_pages=60).collect()}
    assert got[1, "u"]["text"] == "" and got[2, None]["n_chars"] == 0
    assert got[3, "u"]["text"].startswith("One < two\nThree words")
    assert html_extraction.extracted(spark.createDataFrame([], schema), training_pages=60).collect() == []


def test_pipeline_takes_odd_rows_and_an_empty_table(spark, docs, none, labels, benchmark, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    for table, n in ((docs, 8), (none, 0)):
        now, counts = table, []
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{n}-{i}")
            now = spark.read.parquet(f"{tmp_path}/{n}-{i}")
            counts.append(now.count())
            if i < 4:
                assert now.columns == corpus_pipeline.COLUMNS
        if not n:
            assert counts == [0] * 5
        else:
            assert counts[0] == 11 and counts[1] == 9 and counts[2] == 7 and counts[3] == 7
