"""A training corpus from raw documents, in stages.

Toxic documents go, one document of each near-duplicate group stays, documents
that hold benchmark items go, live secrets are blotted out, and what is left
is packed into training sequences. Each stage's table is written and read by
the next, so a lost executor never costs more than a part of one stage. Ahead
of each stage the Python workers give back what the stage before it has left.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buildmend.llm import decontamination, near_dedup, packing, secrets, toxicity
from buildmend.llm.common import fold, table
from buildmend.llm.workers import relieve
from buildmend.session import durable

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: What stands for a live secret.
BLOT = "[secret]"


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic. Null texts stay; repeated rows stay."""
    relieve(spark)
    known = toxicity.scored(docs, table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2, keep=COLUMNS)
    return known.filter("predicted = 0").select(COLUMNS)


def single(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8 or more.

    Texts without words are linked with nothing and stay. Rows that repeat an
    id and a text are one document.
    """
    relieve(spark)
    groups = near_dedup.near_duplicates(docs, k=5, percent=80)
    kept = durable(groups.filter(F.col("kept") | (F.col("n_shingles") == 0)).groupBy("doc_id", "text_key").agg(F.count("*").alias("times")))
    kept = kept.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "times")
    found = docs.select(COLUMNS).withColumn("_own", F.xxhash64("text")).join(
        kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_key"))
    )
    once = found.filter("times = 1").select(COLUMNS)
    again = found.filter("times > 1").select(COLUMNS).dropDuplicates(["doc_id", "text"])
    return once.unionByName(again)


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item. Null texts stay; repeated rows stay."""
    relieve(spark)
    known = decontamination.leaks(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"), flag="_leak", keep=COLUMNS)
    return known.filter(~F.col("_leak")).select(COLUMNS)


def discreet(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its live secrets blotted out and its length anew.

    Credentials that many owners have are examples and stay. Null texts stay null.
    """
    relieve(spark)
    found = secrets.secrets(docs, repo=F.concat_ws("/", "source", "lang"), owner=F.col("source"))
    live = F.transform(F.filter(F.split("spans", ","), lambda s: s.startswith("live:")), lambda s: F.struct(
        F.split(s, ":")[1].cast("int").alias("start"), F.split(s, ":")[2].cast("int").alias("end")
    ))
    spots = durable(found.filter("n_live > 0").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), live.alias("_live")).dropDuplicates(["_id", "_key"]))
    rows = docs.select(COLUMNS).withColumn("_own", F.xxhash64("text")).join(
        spots, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_key")), "left"
    )
    blotted = F.expr(f"""
        reduce(array_sort(_live), named_struct('out', '', 'at', 0),
            (held, s) -> if(s.start < held.at,
                named_struct('out', held.out, 'at', greatest(held.at, s.end)),
                named_struct('out', concat(held.out, substring(text, held.at + 1, s.start - held.at), '{BLOT}'), 'at', s.end)),
            held -> concat(held.out, substring(text, held.at + 1)))""")
    text = F.when(F.col("_live").isNull(), F.col("text")).otherwise(blotted)
    return rows.select("doc_id", text.alias("text"), "lang", "source").withColumn(
        "n_chars", F.char_length(F.coalesce("text", F.lit(""))).cast("long")
    ).select(COLUMNS)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences, mixed by source."""
    relieve(spark)
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", clean),
    ("near_duplicates", single),
    ("decontamination", unseen),
    ("secrets", discreet),
    ("packing", sequences),
]
#: No stage of these can be expressed in SQL as a whole.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
