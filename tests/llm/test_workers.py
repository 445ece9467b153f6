import public_tokenizers

from buildmend.llm import packing, workers


def test_workers_give_back_and_make_again(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.createDataFrame([(1, "one two", "a"), (2, "three", "b")], "doc_id long, text string, source string")
    before = sorted(map(tuple, packing.packed(docs, path).collect()))
    workers.relieve(spark)
    assert sorted(map(tuple, packing.packed(docs, path).collect())) == before
    packing.ids_by(path)
    workers.give_back()
    assert packing.ids_by.cache_info().currsize == 0
