"""Source, dependency, shaping and evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from buildmend.functions import taxonomy as tax
from buildmend.operators import bench, deps, shaping
from buildmend.session import scratch_path
from buildmend.sources import jsonl, ledger, log_parts, records
from checks.q_classify import resolved
from checks.registry import query
from checks.sql import block, n_changed, predicted, q, resolved_steps, top_steps, values

SYSTEM = "You repair failing CI runs with the smallest possible patch."


# -- sources -----------------------------------------------------------------

@query(
    "jsonl_lenient_scan", ["ci_pairs"],
    sql="SELECT id, repo, ci_log, has_fix FROM ci_pairs WHERE id % 6 <> 1",
)
def jsonl_lenient_scan(t):
    # Every record as a line: some cut short, some behind a blank line.
    line = F.to_json(F.struct("id", "repo", "ci_log", "has_fix"))
    written = t.ci_pairs.select(
        F.when(F.col("id") % 6 == 1, F.left(line, F.length(line) - 3))
        .when(F.col("id") % 6 == 2, F.concat(F.lit("\n  \n"), line))
        .otherwise(line).alias("value")
    )
    folder = scratch_path(t.spark, "landed")
    written.write.text(f"{folder}/deep/er")
    return jsonl.read_jsonl(t.spark, folder, "id bigint, repo string, ci_log string, has_fix boolean", files="*.txt")


@query(
    "jsonl_round_trip", ["ci_pairs"],
    sql="SELECT id, language, fix_diff FROM ci_pairs UNION ALL SELECT id, language, fix_diff FROM ci_pairs",
)
def jsonl_round_trip(t):
    folder = scratch_path(t.spark, "written")
    kept = t.ci_pairs.select("id", "language", "fix_diff")
    jsonl.write_jsonl(kept, folder, "overwrite", ["language"])
    jsonl.write_jsonl(kept, folder, "append", ["language"])
    return t.spark.read.schema("id bigint, fix_diff string, language string").json(folder).select("id", "language", "fix_diff")


@query(
    "jsonl_append_repeated", ["ci_pairs"],
    sql="SELECT id, language, fix_diff, CASE WHEN has_fix THEN 'fixed' ELSE 'open' END AS batch FROM ci_pairs",
)
def jsonl_append_repeated(t):
    """Two batches, each appended twice, the first of them after an attempt that was ended."""
    folder = scratch_path(t.spark, "batches")
    fixed = F.coalesce("has_fix", F.lit(False))
    kept = t.ci_pairs.select("id", "language", "fix_diff", fixed.alias("fixed"))
    kept.select("id").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", False).json(f"{folder}/batch=fixed")
    for _ in range(2):
        jsonl.append_batch(kept.filter("fixed").drop("fixed"), folder, "fixed")
        jsonl.append_batch(kept.filter("NOT fixed").drop("fixed"), folder, "open")
    return jsonl.read_batches(t.spark, folder, "id bigint, language string, fix_diff string")


@query(
    "ledger_ingest", ["ci_pairs"],
    sql="SELECT id, language, fix_diff FROM ci_pairs",
)
def ledger_ingest(t):
    """Files that land in two lots, read after each lot and once more."""
    landed, target, book = (scratch_path(t.spark, name) for name in ("landed", "target", "ledger"))
    fixed = F.coalesce("has_fix", F.lit(False))
    for lot in (fixed, ~fixed):
        t.ci_pairs.filter(lot).select("id", "language", "fix_diff").write.mode("append").json(landed)
        ledger.ingest(t.spark, landed, target, book, "id bigint, language string, fix_diff string")
    ledger.ingest(t.spark, landed, target, book, "id bigint, language string, fix_diff string")
    return ledger.current_rows(t.spark, target, book, "id bigint, language string, fix_diff string").drop("source_file")


@query(
    "normalize_records", ["ci_pairs", "gitlab_pipelines", "travis_builds"],
    sql="""SELECT CAST(id AS VARCHAR) AS id, source, repo, language, 'github_actions' AS ci_platform, failing_sha, NULL AS fix_sha, ci_log, has_fix FROM ci_pairs
    UNION ALL SELECT 'gitlab_ci_' || replace(project_path, '/', '__') || '_' || pipeline_id, 'gitlab_ci', project_path, 'ruby', 'gitlab_ci', sha, left(sha, 9), commit_message, true FROM gitlab_pipelines
    UNION ALL SELECT 'travis_ci_' || replace(repo_slug, '/', '__') || '_' || build_id, 'travis_ci', repo_slug, language, 'travis_ci', commit_sha, NULL, commit_message, false FROM travis_builds""",
)
def normalize_records(t):
    gitlab = t.gitlab_pipelines.select(
        "project_path", "pipeline_id", F.col("sha").alias("failed_sha"), F.lit("ruby").alias("language"),
        F.col("commit_message").alias("failure_log"), F.struct(F.left("sha", F.lit(9)).alias("sha")).alias("fix_pipeline"),
        F.lit(True).alias("has_fix"),
    )
    travis = t.travis_builds.select(
        "repo_slug", "build_id", F.col("commit_sha").alias("failed_sha"), "language",
        F.col("commit_message").alias("failure_log"), F.lit(False).alias("has_fix"),
    )
    unified = records.normalize_records({"github_actions": t.ci_pairs, "gitlab_ci": gitlab, "travis_ci": travis})
    return unified.select("id", "source", "repo", "language", "ci_platform", "failing_sha", "fix_sha", "ci_log", "has_fix")


_PARTS = """placed AS (SELECT run_id, text, CASE WHEN regexp_matches(lower(name), '{words}') THEN 0 ELSE 1 END AS late,
  CASE WHEN regexp_matches(lower(name), '{words}') THEN -part_no ELSE part_no END AS place FROM log_parts)"""


@query(
    "assemble_log_parts", ["log_parts"], steps=_PARTS.format(words="test|build|check|lint"),
    sql="SELECT run_id, string_agg(text, chr(10) ORDER BY late, place) AS ci_log FROM placed GROUP BY run_id",
)
def assemble_log_parts(t):
    return log_parts.assemble_log_parts(t.log_parts, ["run_id"])


@query(
    "assemble_log_parts_agent", ["log_parts"], steps=_PARTS.format(words="test|build|check"),
    sql="SELECT run_id, string_agg(text, chr(10) ORDER BY late, place) AS ci_log FROM placed GROUP BY run_id",
)
def assemble_log_parts_agent(t):
    return log_parts.assemble_log_parts(t.log_parts, ["run_id"], log_parts.AGENT_FIRST_WORDS)


@query(
    "join_step_messages", ["step_logs", "conversations"],
    sql="""SELECT s.job_id, s.step_no, CASE WHEN s.job_id % 4 = 0 THEN '{"message": "not a list"}' WHEN s.job_id % 4 = 1 THEN ''
      ELSE c.role || ' says' || chr(10) || chr(10) || 'turn ' || s.step_no END AS messages,
      CASE WHEN s.content <> '' THEN s.content WHEN s.log <> '' THEN s.log ELSE '' END AS job_log
    FROM step_logs s JOIN conversations c ON c.conv_id = s.job_id AND c.turn = s.step_no""",
)
def join_step_messages(t):
    return t.step_logs.select(
        "job_id", "step_no", records.step_messages(F.col("step_log")).alias("messages"),
        records.content_or_log(F.col("content"), F.col("log")).alias("job_log"),
    )


_BUILT_IN = values([c for c in bench.BUILT_IN_CASES], "id, repo, language, failure_class, failure_subclass, ci_log, correct_fix_diff, notes")


@query(
    "bench_cases_dedup", ["bench_case_files"], steps=f"""built_in AS ({_BUILT_IN}),
everything AS (SELECT *, '' AS source_file, 0 AS src FROM built_in UNION ALL SELECT *, 1 AS src FROM bench_case_files)""",
    sql="""SELECT id, repo, language, failure_class, ci_log, correct_fix_diff FROM everything
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY src, source_file) = 1""",
)
def bench_cases_dedup(t):
    cases = bench.bench_cases([bench.built_in_cases(t.spark), t.bench_case_files], ["source_file"])
    return cases.select("id", "repo", "language", "failure_class", "ci_log", "correct_fix_diff")


@query(
    "bench_cases_class", ["bench_case_files"], steps=f"""built_in AS ({_BUILT_IN}),
everything AS (SELECT *, '' AS source_file, 0 AS src FROM built_in UNION ALL SELECT *, 1 AS src FROM bench_case_files)""",
    sql="""SELECT id, failure_class FROM (SELECT * FROM everything QUALIFY row_number() OVER (PARTITION BY id ORDER BY src, source_file) = 1) WHERE failure_class = 'ENV'""",
)
def bench_cases_class(t):
    return bench.bench_cases([bench.built_in_cases(t.spark), t.bench_case_files], ["source_file"], "ENV").select("id", "failure_class")


@query("bench_cases_files", ["bench_case_files"], sql="SELECT id, repo, ci_log, correct_fix_diff, notes FROM bench_case_files")
def bench_cases_files(t):
    # Lists of cases in JSON files of many lines, one list in each of some folders.
    rows = t.bench_case_files.drop("source_file")
    case = F.to_json(F.struct(*rows.columns))
    lists = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(16))).groupBy("part").agg(
        F.concat(F.lit("[\n"), F.array_join(F.collect_list(case), ",\n"), F.lit("\n]")).alias("value")
    )
    folder = scratch_path(t.spark, "cases")
    lists.write.partitionBy("part").text(folder)
    return jsonl.read_json_files(t.spark, folder, bench.CASE_SCHEMA, files="*.txt").select("id", "repo", "ci_log", "correct_fix_diff", "notes")


# -- dependencies ------------------------------------------------------------

_BUMP_KINDS = """bumps AS (SELECT *, CASE WHEN title LIKE 'Bump %' OR title LIKE 'chore(deps): bump %' THEN 'bump' WHEN title LIKE 'Update % requirement from %' THEN 'requirement'
  WHEN title LIKE 'Update %' THEN 'update' WHEN title LIKE 'Upgrade %' THEN 'upgrade' END AS kind FROM dep_prs),
parsed AS (SELECT *, CASE kind WHEN 'bump' THEN regexp_extract(title, '(?i)bump (.+?) from ', 1) WHEN 'requirement' THEN regexp_extract(title, 'Update (.+?) requirement', 1)
    WHEN 'update' THEN regexp_extract(title, 'Update (.+?) to ', 1) WHEN 'upgrade' THEN regexp_extract(title, 'Upgrade (.+?) from', 1) END AS package,
  CASE WHEN kind IN ('bump', 'requirement', 'upgrade') THEN regexp_extract(title, ' from (\\S+) to ', 1) END AS from_version,
  CASE WHEN kind IS NOT NULL THEN regexp_extract(title, ' to (\\S+)$', 1) END AS to_version FROM bumps)"""


@query(
    "dep_bump_parse", ["dep_prs"], steps=_BUMP_KINDS,
    sql="SELECT pr_number, title, package, from_version, to_version FROM parsed",
)
def dep_bump_parse(t):
    return deps.dep_bump_parse(t.dep_prs).select("pr_number", "title", "bump_info.package", "bump_info.from_version", "bump_info.to_version")


_STRICT = "(" + " OR ".join(f"contains(lower(filename), {q(i)})" for inds in deps.ECOSYSTEMS.values() for i in inds) + ")"
_LOOSE = "(" + " OR ".join(f"contains(lower(filename), lower({q(i)}))" for inds in deps.ECOSYSTEMS.values() for i in inds) + ")"


@query(
    "dep_file_filter", ["commit_files"],
    sql=f"""SELECT repo, sha, file_no, filename, 'strict' AS rule FROM commit_files WHERE {_STRICT}
    UNION ALL SELECT repo, sha, file_no, filename, 'loose' AS rule FROM commit_files WHERE {_LOOSE}""",
)
def dep_file_filter(t):
    files = t.commit_files.select("repo", "sha", "file_no", "filename")
    return deps.dep_file_filter(files).withColumn("rule", F.lit("strict")).unionByName(
        deps.dep_file_filter(files, strict=False).withColumn("rule", F.lit("loose"))
    )


_ECO_ROWS = values([(i, eco, ind) for i, (eco, inds) in enumerate(deps.ECOSYSTEMS.items()) for ind in inds], "ord, eco, ind")
_ECO_STEPS = f"""ecos AS ({_ECO_ROWS}),
labelled AS (SELECT p.pr_number, unnest(string_split(p.label_list, ',')) AS label, unnest(range(len(string_split(p.label_list, ',')))) AS pos FROM dep_prs p),
by_label AS (SELECT l.pr_number, arg_min(e.eco, l.pos * 100 + e.ord) AS eco FROM labelled l JOIN ecos e ON contains(lower(l.label), e.eco) GROUP BY l.pr_number),
by_file AS (SELECT p.pr_number, arg_min(e.eco, e.ord) AS eco FROM dep_prs p JOIN ecos e ON contains(p.filename, e.ind) GROUP BY p.pr_number),
detected AS (SELECT p.*, coalesce(l.eco, f.eco, CASE
    WHEN contains(lower(coalesce(p.body, '')), 'package.json') OR contains(lower(p.title), 'npm') THEN 'npm'
    WHEN contains(lower(coalesce(p.body, '')), 'requirements') OR contains(lower(p.title), 'pip') OR contains(lower(p.title), 'python') THEN 'pip'
    WHEN contains(lower(coalesce(p.body, '')), 'cargo.toml') OR contains(lower(p.title), 'rust') THEN 'cargo'
    WHEN contains(lower(coalesce(p.body, '')), 'gemfile') OR contains(lower(p.title), 'ruby') THEN 'bundler'
    WHEN contains(lower(coalesce(p.body, '')), 'go.mod') THEN 'go' ELSE 'unknown' END) AS ecosystem
  FROM dep_prs p LEFT JOIN by_label l ON l.pr_number = p.pr_number LEFT JOIN by_file f ON f.pr_number = p.pr_number)"""


@query("ecosystem_detect", ["dep_prs"], steps=_ECO_STEPS, sql="SELECT pr_number, ecosystem FROM detected")
def ecosystem_detect(t):
    found = deps.detect_ecosystem(F.col("title"), F.split("label_list", ","), F.array("filename"), F.col("body"))
    return t.dep_prs.select("pr_number", found.alias("ecosystem"))


_ROLLUP = """counted AS (SELECT pr_number, count(*) AS total_checks, count(*) FILTER (conclusion = 'success') AS passed, count(*) FILTER (conclusion IN ('failure', 'timed_out')) AS failed
  FROM check_runs GROUP BY pr_number),
rolled AS (SELECT o.o_orderkey AS pr_number, coalesce(c.total_checks, 0) AS total_checks, coalesce(c.passed, 0) AS passed, coalesce(c.failed, 0) AS failed,
  CASE WHEN coalesce(c.total_checks, 0) = 0 THEN 'unknown' WHEN c.failed > 0 THEN 'failed' WHEN c.passed = c.total_checks THEN 'passed' ELSE 'partial' END AS status
  FROM orders o LEFT JOIN counted c ON c.pr_number = o.o_orderkey),
listed AS (SELECT pr_number, string_agg(name || '=' || conclusion, ',' ORDER BY k) AS checks FROM
  (SELECT *, row_number() OVER (PARTITION BY pr_number ORDER BY check_no, name, conclusion) AS k FROM check_runs) GROUP BY pr_number)"""


@query(
    "ci_check_rollup", ["check_runs"], steps=_ROLLUP,
    sql="SELECT r.*, coalesce(l.checks, '') AS checks FROM rolled r LEFT JOIN listed l ON l.pr_number = r.pr_number",
)
def ci_check_rollup(t):
    key = ["pr_number"]
    prs = t.orders.select(F.col("o_orderkey").alias("pr_number"))
    shown = F.transform("checks", lambda c: F.concat_ws("=", c["name"], c["conclusion"]))
    return deps.rolled_checks(prs, t.check_runs, key).withColumn("checks", F.coalesce(F.array_join(shown, ","), F.lit("")))


_PATCH = "@@ -1 +1 @@ "
_PR_SQL = f"""SELECT p.repo, 'https://github.com/' || p.repo AS repo_url, p.pr_number, p.html_url AS pr_url, p.title, p.package, p.from_version, p.to_version, d.ecosystem,
      CASE WHEN p.merged_at IS NOT NULL THEN 'merged' WHEN p.closed_at IS NOT NULL THEN 'closed' ELSE 'open' END AS merge_status,
      coalesce(r.status, 'unknown') AS ci_status, coalesce(r.total_checks, 0) AS total_checks, coalesce(r.status, 'unknown') = 'passed' AS ci_passed,
      coalesce(l.checks, '') AS checks,
      CASE WHEN {_STRICT.replace('filename', 'p.filename')} THEN 1 ELSE 0 END + p.pr_number % 60 AS num_dep_files_changed,
      CASE WHEN {_STRICT.replace('filename', 'p.filename')} THEN p.filename || ':' || repeat('{_PATCH}', 300) || CASE WHEN p.pr_number % 60 > 0 THEN ',' ELSE '' END ELSE '' END
        || coalesce((SELECT string_agg('dir' || k || '/yarn.lock:', ',' ORDER BY k) FROM range(2, 2 + p.pr_number % 60) AS g(k)), '') AS changed_dep_files,
      coalesce(p.body, '') AS body_snippet, p.label_list AS labels, p.author
    FROM parsed p JOIN detected d ON d.pr_number = p.pr_number LEFT JOIN rolled r ON r.pr_number = p.pr_number LEFT JOIN listed l ON l.pr_number = p.pr_number
    WHERE p.kind IS NOT NULL AND lower(p.author) IN ('dependabot[bot]', 'dependabot-preview[bot]', 'renovate[bot]', 'renovate')"""
# Every pull request changes its own file and up to 59 lock files, which name the ecosystem where the first file does not.
_PR_STEPS = _BUMP_KINDS + ",\n" + _ECO_STEPS.replace(
    "by_file AS (SELECT p.pr_number, arg_min(e.eco, e.ord) AS eco FROM dep_prs p JOIN ecos e ON contains(p.filename, e.ind) GROUP BY p.pr_number)",
    f"""named AS (SELECT pr_number, filename FROM dep_prs p WHERE {_STRICT.replace('filename', 'p.filename')} UNION ALL SELECT pr_number, 'dir/yarn.lock' FROM dep_prs WHERE pr_number % 60 > 0),
by_file AS (SELECT p.pr_number, arg_min(e.eco, e.ord) AS eco FROM named p JOIN ecos e ON contains(p.filename, e.ind) GROUP BY p.pr_number)""",
) + ",\n" + _ROLLUP


def _dep_pr_records(t, **options):
    prs = t.dep_prs.withColumn("labels", F.split("label_list", ","))
    own = t.dep_prs.select(
        "repo", "pr_number", F.lit(1).cast("long").alias("file_no"), "filename", F.lit("modified").alias("status"),
        F.lit(1).alias("additions"), F.lit(1).alias("deletions"), F.lit(_PATCH * 300).alias("patch"),
    )
    more = t.dep_prs.filter(F.col("pr_number") % 60 > 0).select(
        "repo", "pr_number", F.explode(F.sequence(F.lit(2).cast("long"), F.col("pr_number") % 60 + 1)).alias("file_no")
    ).select(
        "repo", "pr_number", "file_no", F.concat(F.lit("dir"), F.col("file_no"), F.lit("/yarn.lock")).alias("filename"),
        F.lit("added").alias("status"), F.lit(0).alias("additions"), F.lit(0).alias("deletions"), F.lit(None).cast("string").alias("patch"),
    )
    checks = t.check_runs.join(t.dep_prs.select("repo", "pr_number"), "pr_number")
    shown = F.transform("ci_result.checks", lambda c: F.concat_ws("=", c["name"], c["conclusion"]))
    files = F.transform("changed_dep_files", lambda f: F.concat(f["filename"], F.lit(":"), f["patch"]))
    return deps.dep_pr_records(prs, own.unionByName(more), checks, **options).select(
        "repo", "repo_url", "pr_number", "pr_url", "title", "bump_info.package", "bump_info.from_version", "bump_info.to_version",
        "ecosystem", "merge_status", F.col("ci_result.status").alias("ci_status"), F.col("ci_result.total_checks").alias("total_checks"),
        "ci_passed", F.coalesce(F.array_join(shown, ","), F.lit("")).alias("checks"),
        F.col("num_dep_files_changed").cast("long").alias("num_dep_files_changed"), F.array_join(files, ",").alias("changed_dep_files"),
        "body_snippet", F.array_join("labels", ",").alias("labels"), "author",
    )


@query("dep_pr_records", ["dep_prs", "check_runs"], steps=_PR_STEPS, sql=_PR_SQL)
def dep_pr_records(t):
    return _dep_pr_records(t)


@query("dep_pr_records_npm", ["dep_prs", "check_runs"], steps=_PR_STEPS, sql=f"SELECT * FROM ({_PR_SQL}) WHERE ecosystem = 'npm'")
def dep_pr_records_npm(t):
    return _dep_pr_records(t, ecosystem="npm")


# -- shaping -----------------------------------------------------------------

@query(
    "rl_tasks", ["ci_pairs", "model_verdicts"], steps=resolved_steps(),
    sql="""SELECT id, repo, failing_sha, language, ci_log, failure_class, failure_subclass,
      CASE language WHEN 'python' THEN 'pytest --tb=short -q' WHEN 'javascript' THEN 'npm test' ELSE 'go test ./...' END AS test_command, fix_diff AS ground_truth_diff
    FROM resolved WHERE language IN ('python', 'javascript', 'go') AND has_fix AND ci_log <> '' AND contains(repo, '/')""",
)
def rl_tasks(t):
    return shaping.rl_tasks(resolved(t))


_CHAT_HEAD = f"'<|im_start|>system' || chr(10) || {q(SYSTEM)} || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || "
_CHAT_TAIL = " || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)"
_NL = "chr(10)"


@query(
    "sft_examples", ["ci_pairs", "model_verdicts"], steps=resolved_steps(),
    sql=f"""SELECT id, {_CHAT_HEAD} 'Repository: ' || repo || ' (' || language || ')' || {_NL} || 'CI Log:' || {_NL} || ci_log || {_NL} || {_NL}
      || 'Code context:' || {_NL} || CASE WHEN code_context = '' THEN '(not provided)' ELSE code_context END || {_NL} || {_NL}
      || 'Analyze this CI failure and generate the minimal fix.' {_CHAT_TAIL}
      || '<classify>' || failure_class || ' — ' || coalesce(failure_subclass, '') || '</classify>' || {_NL} || '<reason>' || {_NL}
      || CASE WHEN coalesce(root_cause, '') <> '' THEN root_cause ELSE coalesce(fix_strategy, '') END || {_NL} || {_NL} || 'Key evidence from log:' || {_NL} || coalesce('  - ' || nullif(array_to_string(key_evidence, {_NL} || '  - '), ''), '  - (see log above)') || {_NL}
      || '</reason>' || {_NL} || '<fix>' || {_NL} || fix_diff || {_NL} || '</fix>' || {_NL} || '<validate>' || {_NL}
      || 'Run the failing test suite after applying this patch. Confirm CI is green on first and second run to verify stability.' || {_NL} || '</validate><|im_end|>' AS text
    FROM resolved WHERE has_fix AND fix_diff <> '' AND ci_log <> ''""",
)
def sft_examples(t):
    return shaping.sft_examples(resolved(t), SYSTEM)


@query(
    "rl_prompts", ["ci_pairs", "model_verdicts"], steps=resolved_steps(),
    sql=f"""SELECT id, {_CHAT_HEAD} 'Repository: ' || repo || ' (' || language || ')' || {_NL} || 'Known failure class: ' || failure_class || {_NL}
      || 'CI Log:' || {_NL} || ci_log || {_NL} || {_NL} || 'Generate the minimal fix.' || {_NL} {_CHAT_TAIL} AS prompt,
      failing_sha, 'pytest' AS test_command, language FROM resolved""",
)
def rl_prompts(t):
    return shaping.rl_prompts(resolved(t), SYSTEM).select("id", "prompt", "metadata.failing_sha", "metadata.test_command", "metadata.language")


_DPO = f"""pairs AS (SELECT p.id || '_dpo' AS id, 'Repository: ' || p.repo || ' (' || p.language || ')' || {_NL} || 'CI Log:' || {_NL} || p.ci_log || {_NL} || {_NL}
    || 'Generate the minimal fix.' AS prompt, p.fix_diff AS chosen, trim(r.rejected, chr(10) || ' ') AS rejected, p.failure_class, 'dpo_synthetic' AS source
  FROM resolved p JOIN rejected_candidates r ON r.id = p.id WHERE p.has_fix AND p.fix_diff <> '' AND length(trim(r.rejected, chr(10) || ' ')) >= 20)"""


@query(
    "dpo_pairs", ["ci_pairs", "model_verdicts", "rejected_candidates"], steps=resolved_steps() + ",\n" + _DPO,
    sql="SELECT * FROM pairs",
)
def dpo_pairs(t):
    return shaping.dpo_pairs(resolved(t), t.rejected_candidates)


@query(
    "dpo_chat", ["ci_pairs", "model_verdicts", "rejected_candidates"], steps=resolved_steps() + ",\n" + _DPO,
    sql=f"""SELECT id, {_CHAT_HEAD} prompt {_CHAT_TAIL} AS prompt, chosen || '<|im_end|>' AS chosen, rejected || '<|im_end|>' AS rejected
    FROM pairs WHERE prompt <> '' AND chosen <> '' AND rejected <> '' AND chosen <> rejected""",
)
def dpo_chat(t):
    return shaping.dpo_chat(dpo_pairs(t), SYSTEM)


_ABOUT = f"'Repository: ' || repo || ' (' || language || ')' || {_NL}"
_WORSE = (
    "Generate a DIFFERENT but WORSE fix for this CI failure. The fix should be plausible but suffer from one of these flaws: "
    "(1) too verbose — makes unnecessary changes, (2) fixes the symptom not the root cause, (3) disables/skips the failing test, "
    "(4) adds a band-aid retry without fixing the underlying issue."
)


@query(
    "model_requests", ["ci_pairs"], steps=top_steps() + """,
asked AS (SELECT p.*, t.h_class, t.h_conf, coalesce(t.h_sub, 'unknown') AS sub, printf('%.2f', t.h_conf) AS conf FROM ci_pairs p JOIN top t ON t.id = p.id)""",
    sql=f"""SELECT id, 'classify' AS kind, 'CI Log (truncated to key section):' || {_NL} || ci_log || {_NL} || {_NL} || 'Heuristic pre-classification hint: ' || h_class || ' (' || sub
      || ') — confidence ' || conf || {_NL} || {_NL} || 'Classify this CI failure.' AS request FROM asked WHERE ci_log <> '' AND h_conf < 0.9::DOUBLE
    UNION ALL SELECT id, 'classify_short', 'CI Log:' || {_NL} || ci_log || {_NL} || {_NL} || 'Heuristic hint: ' || h_class || ' (' || sub || ') — confidence ' || conf || {_NL} || {_NL}
      || 'Classify this CI failure.' FROM asked WHERE ci_log <> '' AND h_conf < 0.9::DOUBLE
    UNION ALL SELECT id, 'repair', {_CHAT_HEAD} {_ABOUT} || 'Workflow: ' || {_NL} || CASE WHEN h_class <> 'UNKNOWN' THEN {_NL} || '[Heuristic hint: ' || h_class || ' — ' || sub || ', confidence ' || conf || ']' ELSE '' END
      || {_NL} || 'CI Log:' || {_NL} || ci_log || {_NL} || {_NL} || 'Analyze this CI failure and generate the minimal fix.' || {_NL} {_CHAT_TAIL} FROM asked
    UNION ALL SELECT id, 'bench', {_CHAT_HEAD} {_ABOUT} || 'CI Log:' || {_NL} || ci_log || {_NL} || {_NL} || 'Analyze this CI failure and generate the minimal fix.' || {_NL} {_CHAT_TAIL} FROM asked
    UNION ALL SELECT id, 'patch', {_ABOUT} || 'Failure class: UNKNOWN — ' || {_NL} || {_NL} || 'CI Log:' || {_NL} || ci_log || {_NL} || {_NL} || 'Code context:' || {_NL}
      || CASE WHEN code_context = '' THEN '(not available)' ELSE code_context END || {_NL} || {_NL} || 'Generate the minimal fix.' FROM asked
    UNION ALL SELECT id, 'worse_patch', {q(_WORSE)} || {_NL} || {_NL} || 'CI Log:' || {_NL} || ci_log || {_NL} || {_NL} || 'Repository language: ' || language || {_NL}
      || 'Output ONLY the diff, no explanation.' FROM asked WHERE has_fix AND fix_diff <> ''""",
)
def model_requests(t):
    return shaping.model_requests(t.ci_pairs, system=SYSTEM)


_REPLY_SCHEMA = {"failure_class": "string", "failure_subclass": "string", "ci_log": "string", "fix_diff": "string"}


@query(
    "parse_model_json", ["ci_pairs"],
    sql="""SELECT 'synth_4a_test_expectation_drift_' || language || '_' || (('0x' || left(md5(CAST(id AS VARCHAR)), 8))::BIGINT % 90000 + 10000) AS id, 'synthesized' AS source,
      'LOGIC' AS failure_class, '4a_test_expectation_drift' AS failure_subclass, 'log of ' || source AS ci_log, 'diff {' || id || '}' AS fix_diff, true AS has_fix,
      false AS verified_sandbox, language, 'cli_tool' AS repo_type FROM ci_pairs WHERE id % 5 NOT IN (2, 3)""",
)
def parse_model_json(t):
    return shaping.synthesized_records(shaping.parse_model_json(t.model_replies, "reply", _REPLY_SCHEMA))


@query(
    "parse_repair_response", ["responses"],
    sql=f"""SELECT case_id, {predicted('response')} AS predicted_class,
      CASE WHEN contains({block('response', 'classify')}, '—') THEN trim(string_split({block('response', 'classify')}, '—')[2]) ELSE '' END AS predicted_subclass,
      {block('response', 'fix')} AS extracted_fix, {block('response', 'validate')} AS validate_text, length({block('response', 'fix')}) > 20 AS success FROM responses""",
)
def parse_repair_response(t):
    return shaping.parse_repair_response(t.responses.select("case_id", "response")).drop("response")


@query(
    "seeded_sample", ["ci_pairs"],
    sql="SELECT id, repo FROM ci_pairs ORDER BY md5('42:' || id), id LIMIT 300",
)
def seeded_sample(t):
    return shaping.seeded_sample(t.ci_pairs.select("id", "repo"), 300)


@query(
    "train_eval_split", ["ci_pairs"],
    sql="""SELECT id, CASE WHEN ('0x' || left(md5('42:' || id), 8))::BIGINT % 10000 < 1000 THEN 'eval' ELSE 'train' END AS split FROM ci_pairs""",
)
def train_eval_split(t):
    return shaping.train_eval_split(t.ci_pairs.select("id"))


# -- evaluation --------------------------------------------------------------

_FIX = block("r.response", "fix")
_RESULTS = f"""results AS (SELECT r.case_id, c.failure_class, {predicted('r.response')} AS predicted_class, {predicted('r.response')} = c.failure_class AS correct_classification,
    {_FIX} AS generated_fix, contains({_FIX}, '---') AND contains({_FIX}, '+++') AND length({_FIX}) > 20 AS fix_applies_cleanly,
    CASE WHEN {n_changed('c.correct_fix_diff')} > 0 THEN {n_changed(_FIX)} <= greatest({n_changed('c.correct_fix_diff')} * 1.5::DOUBLE, {n_changed('c.correct_fix_diff')} + 5)
      ELSE {n_changed(_FIX)} <= 15 END AS fix_is_minimal, r.latency_seconds, c.language
  FROM responses r JOIN bench_truth c ON c.id = r.case_id)"""
_SHARES = """count(*) FILTER (correct_classification)::DOUBLE / count(*) AS classification_accuracy, count(*) FILTER (fix_applies_cleanly)::DOUBLE / count(*) AS fix_application_rate"""
_MINIMAL = "count(*) FILTER (fix_is_minimal)::DOUBLE / count(*) AS fix_minimality_rate"


def _results(t):
    return bench.bench_results(t.bench_truth, t.responses)


@query(
    "bench_results", ["responses", "bench_truth"], steps=_RESULTS,
    sql="SELECT case_id, failure_class, predicted_class, correct_classification, generated_fix, fix_applies_cleanly, fix_is_minimal, latency_seconds FROM results",
)
def bench_results(t):
    return _results(t).drop("sandbox_passed")


@query(
    "bench_summary", ["responses", "bench_truth"], steps=_RESULTS,
    sql=f"SELECT count(*) AS total_cases, {_SHARES}, {_MINIMAL}, avg(latency_seconds) AS avg_latency FROM results",
)
def bench_summary(t):
    return bench.bench_summary(_results(t))


@query(
    "bench_by_class", ["responses", "bench_truth"], steps=_RESULTS,
    sql=f"SELECT failure_class, count(*) AS total, {_SHARES}, {_MINIMAL} FROM results GROUP BY failure_class",
)
def bench_by_class(t):
    return bench.bench_by_class(_results(t))


@query(
    "bench_by_language", ["responses", "bench_truth"], steps=_RESULTS,
    sql=f"SELECT coalesce(language, 'unknown') AS language, count(*) AS total, {_SHARES} FROM results GROUP BY 1",
)
def bench_by_language(t):
    return bench.bench_by_language(_results(t), t.bench_truth)


@query(
    "bench_report", ["responses", "bench_truth"], steps=_RESULTS,
    sql=f"""SELECT 'case' AS part, CAST(case_id AS VARCHAR) AS name, 1 AS total, CAST(correct_classification AS INT)::DOUBLE AS classification_accuracy,
      CAST(fix_applies_cleanly AS INT)::DOUBLE AS fix_application_rate FROM results
    UNION ALL SELECT 'class', failure_class, count(*), {_SHARES} FROM results GROUP BY failure_class
    UNION ALL SELECT 'summary', '', count(*), {_SHARES} FROM results""",
)
def bench_report(t):
    folder = scratch_path(t.spark, "report")
    bench.write_report(_results(t), folder)
    shares = ["classification_accuracy", "fix_application_rate"]
    cases = t.spark.read.schema("id long, correct_classification boolean, fix_applies boolean").json(f"{folder}/cases").select(
        F.lit("case").alias("part"), F.col("id").cast("string").alias("name"), F.lit(1).cast("long").alias("total"),
        F.col("correct_classification").cast("int").cast("double").alias(shares[0]), F.col("fix_applies").cast("int").cast("double").alias(shares[1]),
    )
    kinds = t.spark.read.schema("failure_class string, total long, classification_accuracy double, fix_application_rate double").json(f"{folder}/per_class")
    whole = t.spark.read.schema("total_cases long, classification_accuracy double, fix_application_rate double").json(f"{folder}/summary")
    return cases.unionByName(kinds.select(F.lit("class").alias("part"), F.col("failure_class").alias("name"), "total", *shares)).unionByName(
        whole.select(F.lit("summary").alias("part"), F.lit("").alias("name"), F.col("total_cases").alias("total"), *shares)
    )


_REWARDS = f"""fixes AS (SELECT r.prompt_id, r.generation, {block('r.response', 'fix')} AS fix, o.first_run_passed AS one, o.second_run_passed AS two
  FROM rl_responses r LEFT JOIN patch_outcomes o ON o.prompt_id = r.prompt_id AND o.generation = r.generation),
based AS (SELECT *, {n_changed('fix')} AS n, CASE WHEN NOT contains(fix, '---') OR NOT one THEN 0.0::DOUBLE WHEN two THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS base FROM fixes),
rewards AS (SELECT prompt_id, generation, CAST(n AS INT) AS diff_lines,
  CASE WHEN base = 0 THEN base WHEN n < 10 THEN base + 0.1::DOUBLE WHEN n > 50 THEN base - 0.1::DOUBLE ELSE base END AS reward FROM based)"""


def _rewards(t):
    return bench.patch_reward(t.rl_responses, t.patch_outcomes, ["prompt_id", "generation"])


@query("patch_reward", ["rl_responses"], steps=_REWARDS, sql="SELECT * FROM rewards")
def patch_reward(t):
    return _rewards(t)


@query(
    "reward_stats", ["rl_responses"], steps=_REWARDS,
    sql="""SELECT count(*) AS n, sum(reward::DECIMAL(28,10))::DOUBLE / count(*) AS mean_reward, max(reward) AS max_reward, min(reward) AS min_reward,
      count(*) FILTER (reward > 0) AS nonzero FROM rewards""",
)
def reward_stats(t):
    return bench.reward_stats(_rewards(t))


@query(
    "completion_prompts", ["ci_pairs"],
    sql="""SELECT e.event_id AS completion_no, (e.event_id // 8) % (SELECT max(id) + 1 FROM ci_pairs) AS prompt_idx, p.repo
    FROM events e JOIN ci_pairs p ON p.id = (e.event_id // 8) % (SELECT max(id) + 1 FROM ci_pairs)""",
)
def completion_prompts(t):
    prompts = t.ci_pairs.select(F.col("id").alias("prompt_idx"), "repo")
    completions = t.events.select(F.col("event_id").alias("completion_no"))
    return bench.prompt_of_completion(completions, prompts, 8).select("completion_no", "prompt_idx", "repo")
