from pyspark.sql import functions as F

from buildmend.plans import corpus


def test_write_corpus_works_out_each_record_once(spark, tmp_path):
    """The sort looks at its input twice; what was classified ahead of it is not worked out again."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def classified(i):
        seen.add(1)
        return "ENV" if i % 3 else "LOGIC"

    records = spark.range(300).repartition(4).withColumn("failure_class", classified("id"))
    counts = {r.failure_class: r.n_records for r in corpus.write_corpus(records, str(tmp_path / "out")).collect()}
    assert counts == {"ENV": 200, "LOGIC": 100}
    assert seen.value == 300
    assert {r.id for r in spark.read.json(str(tmp_path / "out")).collect()} == set(range(300))
