import json
import os

import pytest
from pyspark.sql import functions as F

from buildmend.sources import ledger

SCHEMA = "id long, s string"


def put(folder, name, ids, time, s="x"):
    file = folder / name
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_text("".join(json.dumps({"id": i, "s": s}) + "\n" for i in ids) + "\nnot json\n")
    os.utime(file, (time, time))


def opened(df):
    """Files that a plan reads, by the count of its scan."""
    df.collect()
    plan, counts = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        found = node.metrics().get("numFiles")
        if found.isDefined():
            counts.append(found.get().value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan)
    return sum(counts)


@pytest.fixture
def places(tmp_path):
    return tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ledger")


def rows(spark, target, book):
    return sorted((r.id, r.s) for r in ledger.current_rows(spark, target, book, SCHEMA).collect())


def test_only_new_and_changed_files_are_read(spark, places):
    source, target, book = places
    for n in range(5):
        put(source, f"d {n}/a[{n}]%.jsonl", [n], 1_000 + n)
    put(source, "empty.jsonl", [], 900)
    assert len(ledger.ingest(spark, str(source), target, book, SCHEMA, files_per_batch=4)) == 2
    assert rows(spark, target, book) == [(n, "x") for n in range(5)]
    assert ledger.ingest(spark, str(source), target, book, SCHEMA) == []
    put(source, "d 1/a[1]%.jsonl", [1, 11], 2_000, "y")
    put(source, "late/old.jsonl", [7], 10)
    [batch] = ledger.ingest(spark, str(source), target, book, SCHEMA)
    assert opened(ledger.read_claimed(spark, str(source), book, batch, SCHEMA)) == 2
    assert rows(spark, target, book) == [(0, "x"), (1, "y"), (2, "x"), (3, "x"), (4, "x"), (7, "x"), (11, "y")]
    (source / "late/old.jsonl").unlink()
    assert ledger.ingest(spark, str(source), target, book, SCHEMA) == []
    assert (7, "x") in rows(spark, target, book)


def test_a_pass_that_is_killed_behind_its_claim_is_ended_by_the_next(spark, places):
    source, target, book = places
    put(source, "a.jsonl", range(3), 1_000)
    with pytest.raises(Exception, match="ended"):
        ledger.ingest(spark, str(source), target, book, SCHEMA, lambda df: df.withColumn("s", F.raise_error(F.lit("ended"))))
    assert rows(spark, target, book) == []
    put(source, "b.jsonl", range(3, 5), 1_100)
    assert len(ledger.ingest(spark, str(source), target, book, SCHEMA)) == 2
    assert rows(spark, target, book) == [(i, "x") for i in range(5)]
    assert ledger.ingest(spark, str(source), target, book, SCHEMA) == []


def test_an_empty_folder_gives_nothing(spark, places):
    source, target, book = places
    source.mkdir()
    assert ledger.ingest(spark, str(source), target, book, SCHEMA) == []
    assert rows(spark, target, book) == []
