"""What the pairing steps move and write."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from buildmend.operators import pairing
from checks import q_pairing  # noqa: F401
from checks.registry import QUERIES, Tables

ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp, o_orderpriority string"
LINES = """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double,
    l_returnflag string, l_linestatus string, l_shipdate timestamp"""


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    place, day = str(tmp_path_factory.mktemp("lines")), lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)
    # Orders of one repository; those of F are green, those of O red.
    orders = [(i, 300, "FO"[i % 2 or i % 8 == 4], day(i), "1-URGENT") for i in range(64)]
    lines = [(i, 7, 3, n, 10.0 * n, 1.0, "RA"[n % 2], "FO"[i % 2], day(i)) for i in range(64) for n in range(1, 5)]
    documents = [(i, "x" * 300, "en", "s", 300) for i in range(12)]
    for name, rows, schema in [("orders", orders, ORDERS), ("lineitem", lines, LINES),
                               ("documents", documents, "doc_id bigint, text string, lang string, source string, n_chars bigint")]:
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{place}/{name}.parquet")
    return place


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_levels_of_pipelines_read_their_lines_from_one_table(spark, folder):
    t = Tables(spark, folder)
    levels = [t.circle_workflows, t.circle_jobs, t.circle_actions]
    read = [{f.rsplit("/", 1)[0] for f in level.inputFiles()} for level in levels]
    assert all(len(r) == 1 for r in read) and read[1] == read[2]
    assert not any("lineitem" in f for level in levels for f in level.inputFiles())
    assert t.circle_actions.count() == 4 * 2 * 256


def test_changed_files_are_dealt_by_their_commit_once(spark, folder):
    files = Tables(spark, folder).commit_files
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(files)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    # The lines by their order and the commits by their number, and nothing again.
    assert plan.count("Exchange hashpartitioning") == 2
    assert files.count() == 256


def test_failed_step_is_chosen_where_actions_meet_their_job(spark, monkeypatch):
    workflows = spark.createDataFrame([("p", "a", 1, "w", 1, "failed"), ("p", None, 2, "w", 1, "failed")],
                                      "project_slug string, pipeline_id string, workflow_id int, workflow_name string, workflow_no int, status string")
    jobs = spark.createDataFrame([("p", 1, 1, 17, "j", "failed"), ("p", 1, 2, 18, "k", "failed"), ("p", 2, 1, 19, "j", "failed")],
                                 "project_slug string, workflow_id int, job_no int, job_number int, job_name string, status string")
    actions = spark.createDataFrame([
        ("p", 17, 1, 1, "failed", "u", None), ("p", 17, 1, 2, "failed", "u", "second"), ("p", 17, 2, 1, "failed", "", "no place"),
        ("p", 17, 3, 4, "failed", "u", "log"), ("p", 17, 3, 4, "failed", "u", "log"), ("p", 17, 3, 5, "failed", "u", "later"),
        ("p", 17, 4, 1, "failed", "u", "later"), ("p", 18, 1, 1, "failed", "u", "other job"), ("p", 19, 1, 1, "failed", "u", "no pipeline"),
    ], "project_slug string, job_number int, step_no int, action_no int, status string, output_url string, step_log string")
    monkeypatch.setattr(pairing, "durable", None)  # no table is written
    got = [(r.pipeline_id, r.step_no, r.action_no, r.step_log) for r in pairing.first_failed_step(workflows, jobs, actions).collect()]
    assert got == [("a", 3, 4, "log")] * 2


def test_patches_of_a_fix_are_moved_once(spark):
    commits = spark.createDataFrame([("r", f"commit-{i}", dt.datetime(2024, 1, i + 1), i, "m", "me") for i in range(4)],
                                    "repo string, sha string, committed_at timestamp, commit_no int, message string, author string")
    files = spark.createDataFrame([("r", "commit-1", 1, "ci.yml", "p"), ("r", "commit-1", 2, "main.py", "q")],
                                  "repo string, sha string, file_no int, filename string, patch string")
    failures = spark.createDataFrame([("r", "commit-0"), ("r", "commit-0"), ("r", "unknown"), (None, "commit-0")], "repo string, failed_sha string")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = pairing.next_commit_fix(failures, commits, files)
        plan = plan_of(found)
        rows = [(r.repo, r.failed_sha, r.fix_commit and (r.fix_commit.files_changed, r.fix_commit.diff_patch)) for r in found.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert sorted(rows, key=str) == sorted([("r", "commit-0", (2, "p"))] * 2 + [("r", "unknown", None), (None, "commit-0", None)], key=str)
    # Above the texts of a commit there is no further shuffle.
    above = plan[:plan.index("array_join(transform(")]
    spine = [line for line in above.splitlines() if "Exchange" in line and line.lstrip().startswith("+-")]
    assert not spine


def test_only_files_of_fixes_are_assembled(spark, folder, monkeypatch):
    given = []

    def assemble(files, keys, n=None, whole=pairing.assemble_diff):
        given.append(files.select("sha").distinct().count())
        return whole(files, keys, n)

    monkeypatch.setattr(pairing, "assemble_diff", assemble)
    pairs = QUERIES["github_pairs"](spark, folder)
    assert given[0] <= 3  # the newest green commit of each workflow
    assert pairs.filter(F.col("has_fix") & (F.col("fix_diff") != "")).count() > 0
