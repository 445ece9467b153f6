"""Leases on repair requests, and rows numbered in order."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from buildmend.operators import bench, classify
from buildmend.operators.ordered import numbered
from buildmend.streaming import requests

START = datetime(2024, 1, 1)
ASKED = "request_id bigint, repo string, status string, error string"


def now(minutes):
    return F.lit(START + timedelta(minutes=minutes))


def test_each_request_is_handed_out_once_and_again_when_its_lease_ends(spark):
    rows = [(i, "o/r", "queued", None) for i in range(1, 8)] + [(8, "", "rejected", "repo and run_id required"), (None, "o/r", "queued", None), (3, "o/r", "queued", None)]
    asked = spark.createDataFrame(rows, ASKED)
    leases, done = spark.createDataFrame([], requests.LEASES), spark.createDataFrame([], "request_id bigint")

    def take(minutes, **options):
        nonlocal leases
        got = requests.hand_out(asked, leases, done, ["a", "b"], now(minutes), 600, **options).collect()
        leases = leases.union(spark.createDataFrame(got, requests.LEASES))
        return sorted((r.request_id, r.worker, r.attempt) for r in got)

    assert take(0, each=2) == [(1, "a", 1), (2, "b", 1), (3, "a", 1), (4, "b", 1)]
    assert take(1) == [(5, "a", 1), (6, "b", 1), (7, "a", 1)]
    assert take(9) == []  # all are held
    done = spark.createDataFrame([(1,), (3,), (None,)], "request_id bigint")
    assert take(10) == [(2, "a", 2), (4, "b", 2)]  # a lease holds up to its end, not at it
    assert take(11) == [(5, "a", 2), (6, "b", 2), (7, "a", 2)]
    assert take(30, max_attempts=2) == []
    tired = requests.given_up(asked, leases, done, now(30), 2)
    assert tired.columns == asked.columns
    assert {(r.request_id, r.status, r.error) for r in tired.collect()} == {(i, "rejected", "too many attempts") for i in (2, 4, 5, 6, 7)}


def test_a_lease_without_an_end_holds(spark):
    asked = spark.createDataFrame([(1, "o/r", "queued", None), (2, "o/r", "queued", None)], ASKED)
    leases = spark.createDataFrame([(1, "a", 1, START, START), (1, "b", 2, START, None)], requests.LEASES)
    none = spark.createDataFrame([], "request_id bigint")
    assert [(r.request_id, r.attempt) for r in requests.hand_out(asked, leases, none, ["x"], now(9), 1).collect()] == [(2, 1)]
    assert requests.hand_out(asked.limit(0), leases, none, ["x"], now(9), 1).collect() == []


def test_rows_are_numbered_without_gaps(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("v"), F.lit(1).alias("w")).repartition(7)
    got = numbered(df, ["v"], "place")
    assert got.columns == ["v", "w", "place"]
    assert [r.place for r in got.orderBy("v").collect()] == list(range(1000))
    same = numbered(spark.range(50).select(F.lit(1).alias("v")), ["v"], "place")
    assert sorted(r.place for r in same.collect()) == list(range(50))
    assert numbered(df.limit(0), ["v"], "place").collect() == []


def test_gaps_between_prompts_lose_no_completion(spark):
    prompts = spark.createDataFrame([(7, "c"), (0, "a"), (4, "b")], "prompt_idx bigint, repo string")
    completions = spark.range(14).withColumnRenamed("id", "completion_no")
    got = bench.prompt_of_completion(completions, prompts, 2)
    assert got.columns == ["prompt_idx", "completion_no", "repo"]
    assert [(r.completion_no, r.prompt_idx) for r in got.orderBy("completion_no").collect()] == [(i, [0, 4, 7][i // 2 % 3]) for i in range(14)]
    assert bench.prompt_of_completion(completions, prompts.limit(0), 2).collect() == []


def test_signals_without_evidence_are_the_same(spark):
    logs = ["", "timed out timed out deadlock", "ModuleNotFoundError: No module named 'x'\nmanifest unknown", "all fine", None]
    df = spark.createDataFrame(list(enumerate(logs)), "id int, ci_log string")
    for r in classify.with_signals(df).select("id", F.col("signals").alias("s")).join(classify.with_signals(df, evidence=False).select("id", F.col("signals").alias("t")), "id").collect():
        assert (r.s is None) == (r.t is None)
        assert [x.asDict() | {"evidence": None} for x in r.s or []] == [x.asDict() | {"evidence": None} for x in r.t or []]
