import datetime as dt
import random

from pyspark.sql import functions as F

from buildmend.operators import pairing
from buildmend.operators.ordered import first_per_group, next_value


def test_next_value_over_chunks_equals_one_sorted_list(spark):
    rng = random.Random(3)
    rows = []
    for key in ("hot", "cold", None):
        for n in rng.sample(range(5000), 900 if key == "hot" else 20):
            rows.append((key, n, rng.random() < 0.02))
    df = spark.createDataFrame(rows, "k string, n int, good boolean")
    value = F.when(F.col("good"), F.col("n"))
    for width in (1, 37, 10_000):
        out = next_value(df, ["k"], ["n"], value, F.floor(F.col("n") / width), "nxt").collect()
        assert len(out) == len(rows)
        for r in out:
            later = [n for k, n, good in rows if k == r.k and n > r.n and good]
            assert r.nxt == (min(later) if later else None)


def test_first_per_group(spark):
    df = spark.createDataFrame([("a", i) for i in range(9)] + [("b", 1)], "k string, n int")
    got = sorted((r.k, r.n) for r in first_per_group(df, ["k"], [F.col("n").desc()], 2).collect())
    assert got == [("a", 7), ("a", 8), ("b", 1)]


RUNS = "repo string, workflow_name string, run_number bigint, run_id bigint, head_sha string, head_branch string, conclusion string"


def test_chains_look_at_the_very_next_trunk_run(spark):
    runs = spark.createDataFrame([
        ("r", "w", 1, 1, "a", "main", "failure"), ("r", "w", 2, 2, "b", "feature", "success"), ("r", "w", 3, 3, "c", "develop", "success"),
        ("r", "w", 4, 4, "d", "main", "failure"), ("r", "w", 5, 5, "e", "main", "cancelled"), ("r", "w", 6, 6, "f", "main", "success"),
        ("r", "v", 1, 7, "g", "main", "failure"),
    ], RUNS)
    for width in (2, 1000):
        got = [(r.failed_run_id, r.fix_run_id) for r in pairing.failure_fix_chains(runs, chunk_rows=width).collect()]
        assert got == [(1, 3)]


def test_green_commit_latest_and_next(spark):
    day = lambda i: dt.datetime(2024, 1 + i // 20, 1 + i % 20)
    commits = spark.createDataFrame([("r", f"s{i}", day(i), i) for i in range(30)], "repo string, sha string, committed_at timestamp, commit_no int")
    runs = spark.createDataFrame(
        [("r", "s15", "w", "success"), ("r", "s18", "w", "success"), ("r", "s25", "other", "success"), ("r", "s12", "w", "success")],
        "repo string, head_sha string, workflow_name string, conclusion string",
    )
    failures = spark.createDataFrame([("r", "s13", "w"), ("r", "s16", "w"), ("r", "s19", "w"), ("r", "s2", "w"), ("r", "zz", "w")],
                                     "repo string, failing_sha string, workflow_name string")

    def found(**how):
        return {r.failing_sha: r.fix_sha for r in pairing.green_commit_fix(failures, commits, runs, **how).collect()}

    assert found(last=20) == {"s13": "s18", "s16": "s18", "s19": None, "s2": None, "zz": None}
    assert found(last=20, pick="next") == {"s13": "s15", "s16": "s18", "s19": None, "s2": None, "zz": None}
    assert found() == {"s13": "s18", "s16": "s18", "s19": None, "s2": "s18", "zz": None}
    assert found(pick="next") == {"s13": "s15", "s16": "s18", "s19": None, "s2": "s12", "zz": None}


def test_next_commit_by_whole_or_shortened_sha(spark):
    shas = ["aaaaaaaa1", "bbbbbbbb2", "aaaaaaaa3", "cccccccc4"]
    commits = spark.createDataFrame([("r", s, dt.datetime(2024, 1, i + 1), i, "m" * 300, "me") for i, s in enumerate(shas)],
                                    "repo string, sha string, committed_at timestamp, commit_no int, message string, author string")
    files = spark.createDataFrame(
        [("r", "bbbbbbbb2", i, f"f{i}.yml", "p" * 600) for i in range(12)] + [("r", "bbbbbbbb2", 99, "main.py", "q")],
        "repo string, sha string, file_no int, filename string, patch string",
    )
    names = ["aaaaaaaa1", "aaaaaaaa3", "aaaaaaaa", "aaaaaaaa1ff", "aaaaaaaa9", "bbbbbbbb", "cccccccc4", "none", None]
    failures = spark.createDataFrame([("r", n) for n in names], "repo string, failed_sha string")
    got = {r.failed_sha: r.fix_commit for r in pairing.next_commit_fix(failures, commits, files).collect()}
    # Unlike whole shas with one beginning are kept apart; of a shortened one the newest commit counts.
    assert {n: f.sha if f else None for n, f in got.items()} == {
        "aaaaaaaa1": "bbbbbbbb2", "aaaaaaaa3": "cccccccc4", "aaaaaaaa": "cccccccc4", "aaaaaaaa1ff": "bbbbbbbb2", "aaaaaaaa9": None,
        "bbbbbbbb": "aaaaaaaa3", "cccccccc4": None, "none": None, None: None,
    }
    fix = got["aaaaaaaa1"]
    assert (fix.message, fix.files_changed, fix.diff_patch) == ("m" * 300, 13, "\n".join(["p" * 600] * 12))
    assert fix.ci_files_changed == [f"f{i}.yml" for i in range(12)]
    few = pairing.next_commit_fix(failures, commits, files, 10, 3, 500, 200).filter("failed_sha = 'aaaaaaaa1'").first().fix_commit
    assert (len(few.message), few.ci_files_changed, few.diff_patch) == (200, [f"f{i}.yml" for i in range(10)], "\n".join(["p" * 500] * 3))


def test_job_numbers_of_two_projects_are_kept_apart(spark):
    workflows = spark.createDataFrame([("p", "a", 1, "w", 1, "failed"), ("q", "b", 2, "w", 1, "failed")],
                                      "project_slug string, pipeline_id string, workflow_id int, workflow_name string, workflow_no int, status string")
    jobs = spark.createDataFrame([("p", 1, 1, 17, "j", "failed"), ("q", 2, 1, 17, "j", "failed")],
                                 "project_slug string, workflow_id int, job_no int, job_number int, job_name string, status string")
    actions = spark.createDataFrame(
        [("p", 17, 1, 1, "failed", "u", ""), ("p", 17, 1, 2, "failed", "u", "second action"), ("p", 17, 2, 1, "failed", "u", "log of p"), ("q", 17, 1, 1, "failed", "u", "log of q")],
        "project_slug string, job_number int, step_no int, action_no int, status string, output_url string, step_log string",
    )
    got = {r.pipeline_id: (r.step_no, r.step_log) for r in pairing.first_failed_step(workflows, jobs, actions).collect()}
    assert got == {"a": (2, "log of p"), "b": (1, "log of q")}


def test_diff_keeps_first_files_then_those_with_a_patch(spark):
    rows = [("c", i, f"f{i}", None if i % 2 else "@@") for i in range(14)] + [("d", 0, "x", None)]
    df = spark.createDataFrame(rows, "k string, file_no int, filename string, patch string")
    for n, last in ((10, 10), (None, 14)):
        got = {r.k: r.diff for r in pairing.assemble_diff(df, ["k"], n).collect()}
        assert got == {"c": "\n".join(f"--- a/f{i}\n+++ b/f{i}\n@@" for i in range(0, last, 2)), "d": ""}


def test_language_filter_and_skip(spark):
    df = spark.createDataFrame([("org/Django",), ("org/rails",), ("org/x",)], "repo string")
    assert [r.repo for r in pairing.repo_language_filter(df, "Python").collect()] == ["org/Django"]
    assert pairing.repo_language_filter(df, "cobol").count() == 3
    assert pairing.repo_language_filter(df, None).count() == 3
    left = pairing.incremental_skip(df, spark.createDataFrame([("org/x",), ("org/x",)], "repo string"), ["repo"])
    assert sorted(r.repo for r in left.collect()) == ["org/Django", "org/rails"]
    todo = pairing.repos_to_process(df.union(df), df.filter("repo = 'org/x'"))
    assert sorted(r.repo for r in todo.collect()) == ["org/Django", "org/rails"]
