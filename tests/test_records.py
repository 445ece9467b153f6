import json
import os

import pytest
from pyspark.sql import functions as F

from buildmend import schemas
from buildmend.operators import bench, deps, shaping
from buildmend.session import durable, release, scratch_path, shared_dir
from buildmend.sources import jsonl, log_parts, records

SCHEMA = "id bigint, ci_log string"


def test_lenient_scan_recurses_and_skips_bad_lines(spark, tmp_path):
    deep = tmp_path / "a" / "b"
    deep.mkdir(parents=True)
    (deep / "x.jsonl").write_text('{"id": 1, "ci_log": "l"}\n\n   \n{"id": 2, "ci_l\nnot json\n{"id": 3}\n')
    (tmp_path / "y.jsonl").write_text('{"id": 4, "extra": [1]}\n')
    (tmp_path / "z.txt").write_text('{"id": 5}\n')
    df = jsonl.read_jsonl(spark, str(tmp_path), SCHEMA, with_file=True)
    assert sorted((r.id, r.ci_log, r.source_file[-7:]) for r in df.collect()) == [(1, "l", "x.jsonl"), (3, None, "x.jsonl"), (4, None, "y.jsonl")]
    assert jsonl.read_jsonl(spark, str(tmp_path), SCHEMA).count() == 3


def test_landed_records_read_by_schema_and_unify(spark, tmp_path):
    (tmp_path / "g.jsonl").write_text('{"platform": "gitlab_ci", "project_path": "g/p", "pipeline_id": 3, "failure_log": "x", "fix_pipeline": {"sha": "s"}, "has_fix": true}\n')
    gitlab = jsonl.read_jsonl(spark, str(tmp_path), schemas.GITLAB_PAIRS)
    row = records.normalize_records({"gitlab_ci": gitlab}).first()
    assert (row.id, row.ci_log, row.fix_sha, row.fix_diff) == ("gitlab_ci_g__p_3", "x", "s", None)
    for name in [n for n in dir(schemas) if n.isupper()]:
        assert jsonl.read_jsonl(spark, str(tmp_path), getattr(schemas, name)).count() == 1, name


def test_sink_overwrites_and_appends(spark, tmp_path):
    df, path = spark.range(3), str(tmp_path / "out")
    jsonl.write_jsonl(df, path)
    jsonl.write_jsonl(df, path, "append")
    assert jsonl.read_jsonl(spark, path, "id bigint").count() == 6
    jsonl.write_jsonl(df, path)
    assert jsonl.read_jsonl(spark, path, "id bigint").count() == 3
    with pytest.raises(ValueError):
        jsonl.write_jsonl(df, path, "ignore")


def test_shared_folder_comes_from_the_session(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    assert spark.conf.get("spark.checkpoint.dir") == shared_dir(spark)
    assert durable(spark.range(5)).count() == 5


def test_scratch_tables_go_when_released(spark):
    table = durable(spark.range(7))
    place = table.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(place) and table.count() == 7
    release(spark)
    assert not os.path.exists(place)


def test_normalize_takes_the_log_under_either_name(spark):
    github = spark.createDataFrame([("g1", "log", "diff", True)], "id string, ci_log string, fix_diff string, has_fix boolean").withColumn("source", F.lit("github_actions"))
    circle = spark.createDataFrame([("github/o/r", 7, "flog", "sha0", ("sha1", "patch"), True)],
                                   "project_slug string, pipeline_id bigint, failure_log string, failed_sha string, fix_commit struct<sha:string,diff_patch:string>, has_fix boolean")
    rows = {r.id: r for r in records.normalize_records({"github_actions": github, "circleci": circle}, use_commit_patch=True).collect()}
    assert rows["g1"].ci_log == "log" and rows["g1"].ci_platform == "github_actions"
    c = rows["circleci_github__o__r_7"]
    assert (c.ci_log, c.fix_diff, c.failing_sha, c.fix_sha, c.source) == ("flog", "patch", "sha0", "sha1", "circleci")
    plain = records.normalize_records({"circleci": circle}).first()
    assert plain.fix_diff is None


def test_log_parts_order_and_cut(spark):
    rows = [(1, 0, "0_setup", "s"), (1, 1, "1_Test", "t1"), (1, 2, "2_build", "t2"), (1, 3, "3_lint", "l"), (2, 0, "a", "x" * 10), (2, 1, "b", "y")]
    parts = spark.createDataFrame(rows, "run_id int, part_no int, name string, text string")
    got = {r.run_id: r.ci_log for r in log_parts.assemble_log_parts(parts, ["run_id"]).collect()}
    assert got == {1: "l\nt2\nt1\ns", 2: "x" * 10 + "\ny"}
    agent = {r.run_id: r.ci_log for r in log_parts.assemble_log_parts(parts, ["run_id"], log_parts.AGENT_FIRST_WORDS).collect()}
    assert agent[1] == "t2\nt1\ns\nl"
    for limit in (1, 9, 10, 11, 12):
        cut = {r.run_id: r.ci_log for r in log_parts.assemble_log_parts(parts, ["run_id"], limit=limit).collect()}
        assert cut[2] == ("x" * 10 + "\ny")[:limit]


def test_run_with_very_many_parts(spark):
    rows = [(1, i, "build" if i % 3 else "other", "" if i % 2 else "ab") for i in range(5000)] + [(2, 0, "x", "y")]
    parts = spark.createDataFrame(rows, "run_id int, part_no int, name string, text string")
    first = [r[3] for r in reversed(rows[:5000]) if r[2] == "build"]
    want = "\n".join(first + [r[3] for r in rows[:5000] if r[2] == "other"])
    for limit in (100, 4000):
        got = {r.run_id: r.ci_log for r in log_parts.assemble_log_parts(parts, ["run_id"], limit=limit).collect()}
        assert got == {1: want[:limit], 2: "y"}


def test_step_messages(spark):
    rows = [('[{"message": "a"}, {"x": 1}, {"message": "b"}]',), ('{"message": "a"}',), ("broken [",), ("[]",)]
    df = spark.createDataFrame(rows, "t string").select(records.step_messages(F.col("t")))
    assert [r[0] for r in df.collect()] == ["a\n\nb", '{"message": "a"}', "", ""]


TITLES = {
    "Bump lodash from 4.17.20 to 4.17.21": ("lodash", "4.17.20", "4.17.21"),
    "chore(deps-dev): bump @types/node from 1.2 to 1.3": ("@types/node", "1.2", "1.3"),
    "Update rails requirement from >=5.0 to >=6.0": ("rails", ">=5.0", ">=6.0"),
    "Update numpy to 1.26": ("numpy", None, "1.26"),
    "Update black from 22.1 to 23.1": ("black from 22.1", None, "23.1"),
    "upgrade x from 1 to 2": ("x", "1", "2"),
    "Fix typo": None,
}


def test_bump_titles(spark):
    df = spark.createDataFrame([(t,) for t in TITLES], "title string")
    got = {r.title: r.bump_info and tuple(r.bump_info) for r in deps.dep_bump_parse(df).collect()}
    assert got == TITLES


def test_ecosystem_order(spark):
    rows = [
        ("t", ["Good first issue"], [], "", "go"), ("t", ["deps", "PIP"], ["package.json"], "", "pip"),
        ("t", None, ["x/Cargo.toml", "package.json"], "", "npm"), ("npm thing", [], [], "", "npm"),
        ("python", [], [], None, "pip"), ("t", [], [], "the Gemfile", "bundler"), ("t", [], [], "go.mod", "go"), (None, None, None, None, "unknown"),
    ]
    df = spark.createDataFrame(rows, "title string, labels array<string>, files array<string>, body string, want string")
    got = df.select(deps.detect_ecosystem(F.col("title"), F.col("labels"), F.col("files"), F.col("body")).alias("e"), "want").collect()
    assert all(r.e == r.want for r in got)


def test_dep_files_strict_and_loose(spark):
    df = spark.createDataFrame([(n,) for n in ("Cargo.toml", "a/package.json", "Pipfile", "go.mod", "x.py")], "filename string")
    assert sorted(r.filename for r in deps.dep_file_filter(df).collect()) == ["a/package.json", "go.mod"]
    assert deps.dep_file_filter(df, strict=False).count() == 4


def test_check_rollup(spark):
    prs = spark.createDataFrame([(i,) for i in range(5)], "pr int")
    checks = spark.createDataFrame([(0, "success"), (0, "timed_out"), (1, "success"), (2, "success"), (2, "neutral"), (3, None)], "pr int, conclusion string")
    got = {r.pr: r.status for r in deps.check_rollup(prs, checks, ["pr"]).collect()}
    assert got == {0: "failed", 1: "passed", 2: "partial", 3: "partial", 4: "unknown"}


def test_model_json(spark):
    good = {"failure_class": "ENV", "failure_subclass": None, "ci_log": "", "fix_diff": "d {x}"}
    replies = [
        json.dumps(good), "Sure! " + json.dumps(good) + " Bye.", json.dumps({k: v for k, v in good.items() if k != "ci_log"}),
        json.dumps(good)[:-2], "no json", "", json.dumps(good) + " trailing",
    ]
    df = spark.createDataFrame(list(enumerate(replies)), "request_id int, reply string")
    fields = {"failure_class": "string", "failure_subclass": "string", "ci_log": "string", "fix_diff": "string"}
    got = {r.request_id: (r.failure_class, r.ci_log, r.fix_diff) for r in shaping.parse_model_json(df, "reply", fields).collect()}
    assert got == {0: ("ENV", "", "d {x}"), 1: ("ENV", "", "d {x}")}


def test_repair_response(spark):
    rows = ["<classify> ENV — 3c missing — x </classify><fix>\n" + "d" * 21 + "\n</fix><validate>run</validate>", "<classify></classify>", "<classify>— 2a</classify>", "nothing"]
    got = shaping.parse_repair_response(spark.createDataFrame([(r,) for r in rows], "response string")).collect()
    assert [(r.predicted_class, r.predicted_subclass, r.success) for r in got] == [("ENV", "3c missing", True), ("UNKNOWN", "", False), ("UNKNOWN", "2a", False), ("UNKNOWN", "", False)]
    assert got[0].validate_text == "run"


def test_tasks_pairs_and_splits(spark):
    rows = [(i, "o/r" if i != 3 else "r", "Python" if i != 4 else "rust", "log", "d" * 30, i != 5) for i in range(10)]
    df = spark.createDataFrame(rows, "id int, repo string, language string, ci_log string, fix_diff string, has_fix boolean").withColumns(
        {"failing_sha": F.lit("s"), "failure_class": F.lit("ENV"), "failure_subclass": F.lit("3c")})
    tasks = shaping.rl_tasks(df, max_tasks=4).collect()
    assert [(t.id, t.language, t.test_command) for t in tasks] == [(i, "python", "pytest --tb=short -q") for i in (0, 1, 2, 6)]
    worse = spark.createDataFrame([(0, " " + "w" * 19 + " "), (1, "w" * 20), (2, "d" * 30), (5, "w" * 30)], "id int, rejected string")
    pairs = shaping.dpo_pairs(df, worse)
    assert sorted(r.id for r in pairs.collect()) == ["1_dpo", "2_dpo"]
    assert [r.id for r in shaping.dpo_chat(pairs, "sys").collect()] == ["1_dpo"]
    a, b = (shaping.train_eval_split(spark.range(5000).repartition(n), 0.1) for n in (1, 7))
    assert sorted(a.collect()) == sorted(b.collect())
    assert 400 < a.filter("split = 'eval'").count() < 600
    assert sorted(shaping.seeded_sample(spark.range(100).repartition(5), 10).collect()) == sorted(shaping.seeded_sample(spark.range(100).coalesce(1), 10).collect())


def test_sft_text(spark):
    df = spark.createDataFrame([(1, "o/r", "go", "L" * 7000, "DIFF", True, "ENV", None, "", "fix it", ["e1", "e2", "e3", "e4"])],
                               "id int, repo string, language string, ci_log string, fix_diff string, has_fix boolean, failure_class string, failure_subclass string, root_cause string, fix_strategy string, key_evidence array<string>")
    whole = shaping.sft_examples(df, "SYS").first().text
    assert "L" * 7000 in whole and "  - e3\n  - e4\n" in whole
    text = shaping.sft_examples(df, "SYS", log_chars=6000, context_chars=2000, bullets_shown=3).first().text
    assert text.startswith("<|im_start|>system\nSYS<|im_end|>\n<|im_start|>user\nRepository: o/r (go)\nCI Log:\n" + "L" * 6000 + "\n\nCode context:\n(not provided)\n\n")
    assert "<reason>\nfix it\n\nKey evidence from log:\n  - e1\n  - e2\n  - e3\n</reason>\n<fix>\nDIFF\n</fix>" in text


def test_synthesis_plan(spark):
    plan = shaping.synthesis_plan(spark, per_subclass=250)
    assert plan.count() == sum(min(250, n) for n in shaping.SYNTHESIS_TARGETS.values())
    assert {r.language for r in plan.select("language").distinct().collect()} == set(shaping.LANGUAGES)
    assert {r.repo_type for r in plan.select("repo_type").distinct().collect()} == set(shaping.REPO_TYPES)


def test_bench_verdicts_and_empty_summary(spark):
    cases = bench.built_in_cases(spark)
    plus = lambda n: "<classify>ENV — x</classify><fix>--- a\n+++ b\n" + "+line\n" * n + "</fix>"
    rows = [("env_001_ubuntu_pkg", plus(7), 1.0), ("logic_001_assertion", plus(8), 2.0), ("flaky_001_async_race", "", 3.0)]
    results = bench.bench_results(cases, spark.createDataFrame(rows, "case_id string, response string, latency_seconds double"))
    got = {r.case_id: (r.correct_classification, r.fix_applies_cleanly, r.fix_is_minimal) for r in results.collect()}
    assert got == {"env_001_ubuntu_pkg": (True, True, True), "logic_001_assertion": (False, True, False), "flaky_001_async_race": (False, False, True)}
    assert tuple(bench.bench_summary(results.filter("false")).first()) == (0, 0.0, 0.0, 0.0, 0.0)
    languages = bench.bench_by_language(results, cases.filter("id like 'env%'")).collect()
    assert {(r.language, r.total) for r in languages} == {("python", 1), ("unknown", 2)}


def test_first_case_of_an_id_stays(spark):
    own = bench.built_in_cases(spark)
    files = own.limit(1).withColumn("repo", F.lit("other")).withColumn("source_file", F.lit("z")).unionByName(
        own.limit(1).withColumns({"id": F.lit("new"), "source_file": F.lit("b"), "repo": F.lit("b")})
    ).unionByName(own.limit(1).withColumns({"id": F.lit("new"), "source_file": F.lit("a"), "repo": F.lit("a")}))
    got = {r.id: r.repo for r in bench.bench_cases([own, files], ["source_file"]).collect()}
    assert len(got) == 5 and got["dep_drift_001_psycopg3"] == "django/django" and got["new"] == "a"


def test_report_is_written(spark, tmp_path):
    rows = [("env_001_ubuntu_pkg", "<classify>ENV — x</classify>", 1.0)]
    results = bench.bench_results(bench.built_in_cases(spark), spark.createDataFrame(rows, "case_id string, response string, latency_seconds double"))
    bench.write_report(results, str(tmp_path))
    assert spark.read.json(str(tmp_path / "summary")).first().total_cases == 1
    assert spark.read.json(str(tmp_path / "cases")).first().id == "env_001_ubuntu_pkg"


def test_rewards(spark):
    fix = lambda n: "<fix>--- a\n" + "+x\n" * n + "</fix>"
    rows = [(0, fix(9), True, True, 1.1), (1, fix(10), True, False, 0.5), (2, fix(51), True, True, 0.9), (3, fix(51), True, False, 0.4), (4, fix(1), False, True, 0.0),
            (5, "no fix", True, True, 0.0), (6, "<fix>+x</fix>", True, True, 0.0), (7, fix(1), None, None, 0.0)]
    df = spark.createDataFrame(rows, "i int, response string, first_run_passed boolean, second_run_passed boolean, want double")
    out = bench.patch_reward(df.select("i", "response"), df.filter("i < 7"), ["i"])
    assert {r.i: r.reward for r in out.collect()} == {r[0]: r[4] for r in rows}
    stats = bench.reward_stats(out).first()
    assert (stats.n, stats.max_reward, stats.min_reward, stats.nonzero) == (8, 1.1, 0.0, 4)
    assert stats.mean_reward == pytest.approx(2.9 / 8)


def test_a_batch_that_is_ended_and_repeated_adds_its_rows_once(spark, tmp_path):
    path, schema = str(tmp_path / "out"), "id long, s string"
    rows = spark.createDataFrame([(i, None if i % 3 else f"s{i}") for i in range(50)], schema)
    assert jsonl.read_batches(spark, path, schema).count() == 0
    fails = rows.select(F.when(F.col("id") == 49, F.raise_error(F.lit("ended"))).otherwise(F.col("id")).cast("long").alias("id"), "s").repartition(4, "id")
    with pytest.raises(Exception, match="ended"):
        jsonl.append_batch(fails, path, "b-1")
    # What an attempt leaves that died while its files were moved.
    (tmp_path / "out" / "batch=b-1").mkdir(parents=True, exist_ok=True)
    (tmp_path / "out" / "batch=b-1" / "part-00000-x.json").write_text('{"id": 7}\n')
    assert jsonl.read_batches(spark, path, schema).count() == 0
    assert jsonl.append_batch(rows, path, "b-1") and not jsonl.append_batch(rows, path, "b-1")
    assert jsonl.append_batch(rows.limit(0), path, "none") and not jsonl.append_batch(rows, path, "none")
    assert jsonl.append_batch(rows.filter("id < 5"), path, "b.2")
    got = sorted((r.batch, r.id, r.s or "") for r in jsonl.read_batches(spark, path, schema).collect())
    assert got == sorted([("b-1", r.id, r.s or "") for r in rows.collect()] + [("b.2", r.id, r.s or "") for r in rows.collect() if r.id < 5])
    with pytest.raises(ValueError):
        jsonl.append_batch(rows, path, "a/b")
