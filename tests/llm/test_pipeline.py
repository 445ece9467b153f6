"""The pipeline on given documents, each stage by what it must and must not do."""

import pytest

import corpus_pipeline
from buildmend.llm import decontamination, secrets
from buildmend.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    top = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    out.append(docs.toPandas())
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"{top}/{i}")
        docs = spark.read.parquet(f"{top}/{i}")
        out.append(docs.toPandas())
    return out


def test_toxic_documents_go(spark, tables):
    predicted = {r["doc_id"] for r in QUERIES["op4_toxicity"](spark, FOLDER).collect() if r["predicted"]}
    assert set(tables[0].doc_id) - set(tables[1].doc_id) == predicted and predicted


def test_one_document_of_a_group_stays(tables):
    from test_shapes import brute_groups

    want = {c for _, c in brute_groups(list(zip(tables[1].doc_id, tables[1].text)), 5, 80).values()}
    assert set(tables[2].doc_id) == want and len(tables[2]) == len(want)


def test_documents_with_benchmark_items_go(spark, tables):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    own = [decontamination.hashed(decontamination.words_of(t)) for _, t in items]
    gone = set(tables[2].doc_id) - set(tables[3].doc_id)
    for i, text in zip(tables[2].doc_id, tables[2].text):
        line = decontamination.hashed(decontamination.words_of(text))
        near = any(decontamination.row_by_row(o, line).min() <= int(0.2 * len(o)) for o in own)
        assert (i in gone) == near, i


def test_live_secrets_are_blotted_out_and_all_else_stays(tables):
    before, after = dict(zip(tables[3].doc_id, tables[3].text)), dict(zip(tables[4].doc_id, tables[4].text))
    assert before.keys() == after.keys()
    changed = [i for i in before if before[i] != after[i]]
    assert changed
    for i in before:
        if corpus_pipeline.BLOT in after[i] and i in changed:
            at = 0
            for part in after[i].split(corpus_pipeline.BLOT):
                at = before[i].index(part, at) + len(part)
        else:
            assert before[i] == after[i]
    assert all(n == len(t) for n, t in zip(tables[4].n_chars, tables[4].text))
    left = [v for t in after.values() for _, _, v in secrets.candidates(t) if secrets.looks_random(v)]
    assert len(left) < sum(len([v for _, _, v in secrets.candidates(t) if secrets.looks_random(v)]) for t in before.values())


def test_all_that_is_kept_is_packed(tables):
    assert set(tables[5].doc_id) == set(tables[4].doc_id)
