"""Driver tables seen as CI data.

Each view is one SQL text that Spark and DuckDB both run, so a query and its
oracle start from the same rows. ``NEEDS`` lists the views a view reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from buildmend.session import durable

BASE = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

LOG_LINES = [
    "ERROR: operation timed out",
    "fatal: DATA RACE detected",
    "No space left on device: disk full",
    "bind: port 8080 already in use",
    "setUp of suite failed, fixtures missing",
    "ModuleNotFoundError: x",
    "conflicting dependencies found",
    "npm ERR! code ELIFECYCLE",
    "poetry.lock is out of sync",
    "ERROR: python 3.7 is not supported",
    "DeprecationWarning: np.int was removed in 1.24",
    "manifest unknown: FROM python:3.10-slim",
    "Package libfoo has no installation candidate",
    "E: Unable to locate package libssl-dev on ubuntu-22.04",
    "secret DEPLOY was not found: $DEPLOY_TOKEN",
    "ubuntu-18.04 is deprecated, use runner ubuntu-latest",
    "actions/checkout needs a newer version",
    "AssertionError: 404",
    "TypeError: unexpected keyword argument",
    "sqlite3.OperationalError: no such column",
    "no module named yaml",
    "AttributeError: object has no attribute foo",
    "error CVE-2024-12345 found",
    "GPL conflict in left-pad",
    "gitleaks: secret was detected in $API_TOKEN and $SIGN_KEY",
    "sbom check failed",
    "flake8 reported 3 error lines",
    "mypy found problems",
    "F401 imported but unused",
    "C901 function is too complex",
    "black: would reformat a.py",
    "undefined reference to foo",
    "missing dist folder",
    "cache miss for key deps",
    "cmake version 3.10 is incompatible",
    "SyntaxError: invalid syntax in build step",
    "Build failed: python 3.9 and node 18.19, Python-3.11.4 and node:v16.20.2",
    "all good",
    "Job failed: exit status 1",
    "FROM node:18-alpine on Ubuntu-22.04 and ubuntu-20.04",
    "Address already in use (EADDRINUSE)",
    "The command bundle install exited with 1",
    "RuntimeError: no running event loop, Event loop is closed",
    "${{ secrets.NPM_PUBLISH }} is empty in requests==2.31.4",
    "Error: step exit code 3",
    "console.log ends here",
]
N_LINES = len(LOG_LINES)

_lines = ",\n  ".join(f"({i}, '{line}')" for i, line in enumerate(LOG_LINES))

# Views that others read many times over, each time with other columns, so that
# Spark would sort their lines again for each: a query writes them once.
WRITTEN = {"circle_lines", "circle_jobs"}

# Tables that a view's window and join both want by a key, under two names. Dealt
# by the key as they are read they are moved once, and ahead of any text made of them.
DEALT = {("commit_files", "lineitem"): "l_orderkey"}

# name -> (views it reads, SQL)
VIEWS: dict[str, tuple[list[str], str]] = {}


def _view(name: str, needs: list[str], sql: str) -> None:
    VIEWS[name] = (needs, sql)


_view("log_templates", [], f"""
SELECT * FROM (VALUES
  {_lines}) AS t(tid, line)
""")

_view("ci_runs", ["events"], """
SELECT event_id AS run_id, event_id AS run_number,
  concat('org', CAST(user_id % 5 AS STRING), '/repo') AS repo,
  concat('wf', CAST(user_id % 3 AS STRING)) AS workflow_name,
  md5(CAST(event_id AS STRING)) AS head_sha,
  CASE event_id % 4 WHEN 0 THEN 'main' WHEN 1 THEN 'master' WHEN 2 THEN 'develop' ELSE 'feature' END AS head_branch,
  CASE event_id % 10 WHEN 0 THEN 'dependabot[bot]' WHEN 1 THEN 'Renovate-Team' ELSE 'dev' END AS actor_login,
  CASE WHEN event_type IN ('error', 'view') THEN 'failure'
       WHEN event_type IN ('purchase', 'signup') THEN 'success' ELSE 'cancelled' END AS conclusion,
  ts AS created_at
FROM events
""")

# Two templates per log: one repeated, one once; every 13th log has escape codes.
_view("ci_pairs", ["documents", "log_templates"], f"""
SELECT d.doc_id AS id, concat('org', CAST(d.doc_id % 9 AS STRING), '/repo') AS repo,
  CASE d.lang WHEN 'en' THEN 'python' WHEN 'de' THEN 'javascript' WHEN 'fr' THEN 'go' ELSE 'rust' END AS language,
  md5(CAST(d.doc_id AS STRING)) AS failing_sha,
  concat(d.text, chr(10), CASE WHEN d.doc_id % 13 = 0 THEN concat(chr(27), '[31mERROR:', chr(27), '[0m step broke', chr(10)) ELSE '' END,
    repeat(concat(t.line, chr(10)), CAST(1 + d.doc_id % 3 AS INT)),
    CASE WHEN d.doc_id % 2 = 0 THEN concat(u.line, chr(10)) ELSE '' END) AS ci_log,
  concat('--- a/', CASE d.doc_id % 5 WHEN 0 THEN 'Dockerfile' WHEN 1 THEN 'ci.yml' ELSE 'f.txt' END, chr(10), '+++ b/f.txt', chr(10),
    repeat(concat('-old', chr(10), '+new', chr(10)), CAST(d.doc_id % 60 AS INT))) AS fix_diff,
  CASE WHEN d.doc_id % 3 = 0 THEN '' ELSE concat('def f', CAST(d.doc_id AS STRING), '(): pass') END AS code_context,
  d.doc_id % 7 <> 0 AS has_fix, d.source AS source
FROM documents d
JOIN log_templates t ON (d.doc_id * 7) % {N_LINES} = t.tid
JOIN log_templates u ON (d.doc_id * 11 + 3) % {N_LINES} = u.tid
""")

_view("model_verdicts", ["labels"], """
SELECT doc_id AS id, CASE WHEN quality = 1 THEN 'LOGIC' ELSE 'ENV' END AS failure_class,
  CASE WHEN quality = 1 THEN '4a_test_expectation_drift' ELSE CAST(NULL AS STRING) END AS failure_subclass,
  CASE WHEN toxic = 1 THEN CAST(NULL AS DOUBLE) ELSE CAST(0.75 AS DOUBLE) END AS confidence,
  concat('cause ', CAST(doc_id AS STRING)) AS root_cause,
  CASE WHEN quality = 1 THEN split(concat('line ', CAST(doc_id AS STRING), ',second,third,fourth'), ',') END AS key_evidence
FROM labels
""")

_view("check_runs", ["lineitem"], """
SELECT l_orderkey AS pr_number, l_linenumber AS check_no,
  CASE WHEN l_quantity < 5 THEN 'neutral' WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'failure'
       WHEN l_returnflag = 'R' AND l_quantity > 45 THEN 'timed_out' ELSE 'success' END AS conclusion,
  concat('check', CAST(l_suppkey AS STRING), '-', CAST(l_partkey AS STRING)) AS name,
  CASE WHEN l_linestatus = 'F' THEN 'ci-app' ELSE CAST(NULL AS STRING) END AS app
FROM lineitem
""")

# One outcome per key, the green-most, since lineitem keys repeat.
_view("patch_outcomes", ["lineitem"], """
SELECT l_orderkey AS prompt_id, l_linenumber AS generation,
  max(CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END) = 1 AS first_run_passed,
  max(CASE WHEN l_returnflag <> 'R' AND l_linestatus = 'F' THEN 1 ELSE 0 END) = 1 AS second_run_passed,
  CAST(max(l_quantity) AS INT) * 2 AS diff_lines
FROM lineitem GROUP BY l_orderkey, l_linenumber
""")

_view("rl_responses", ["patch_outcomes"], """
SELECT prompt_id, generation,
  CASE WHEN prompt_id % 5 = 0 THEN 'no patch here'
       WHEN prompt_id % 11 = 0 THEN '<fix></fix>'
       ELSE concat('<classify>ENV</classify>', chr(10), '<fix>', chr(10), '--- a/f', chr(10), '+++ b/f', chr(10),
         repeat(concat('+x', chr(10)), CAST(diff_lines AS INT)), '</fix>') END AS response
FROM patch_outcomes
""")

_view("commits", ["orders"], """
SELECT concat('org', CAST(o_custkey % 300 AS STRING), '/repo') AS repo, md5(CAST(o_orderkey AS STRING)) AS sha,
  o_orderdate AS committed_at, o_orderkey AS commit_no,
  concat('fix ', o_orderpriority, ' ', CAST(o_orderkey AS STRING)) AS message,
  concat('dev', CAST(o_custkey % 7 AS STRING)) AS author
FROM orders
""")

_view("commit_runs", ["orders"], """
SELECT concat('org', CAST(o_custkey % 300 AS STRING), '/repo') AS repo, md5(CAST(o_orderkey AS STRING)) AS head_sha,
  concat('wf', CAST(o_orderkey % 3 AS STRING)) AS workflow_name, o_orderkey AS run_id,
  CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failure' ELSE 'cancelled' END AS conclusion,
  CASE WHEN o_custkey % 10 = 0 THEN 'dependabot[bot]' WHEN o_custkey % 10 = 1 THEN 'Renovate-Team' ELSE 'dev' END AS actor_login,
  CASE o_custkey % 3 WHEN 0 THEN 'python' WHEN 1 THEN 'go' ELSE 'ruby' END AS language,
  o_orderdate AS created_at
FROM orders
""")

# Lines of an order as the changed files of its commit; keys repeat in
# lineitem, so files are numbered over all of their columns.
_view("commit_files", ["lineitem", "commits"], """
SELECT c.repo, c.sha, f.file_no, f.filename, f.patch, f.additions, f.deletions, f.status, f.commit_no FROM commits c JOIN (
  SELECT l_orderkey AS commit_no,
    CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS BIGINT) AS file_no,
    concat(CASE l_linenumber % 7 WHEN 0 THEN 'package-lock.json' WHEN 1 THEN 'requirements.txt' WHEN 2 THEN 'Cargo.toml'
      WHEN 3 THEN 'ci/build.yml' WHEN 4 THEN 'Dockerfile' WHEN 5 THEN 'go.mod' ELSE 'src/main.py' END) AS filename,
    CASE WHEN l_quantity < 5 THEN CAST(NULL AS STRING)
      ELSE repeat(concat('-old', CAST(l_partkey AS STRING), chr(10), '+new', chr(10)), CAST(l_quantity AS INT)) END AS patch,
    CAST(l_quantity AS INT) AS additions, CAST(l_linenumber AS INT) AS deletions,
    CASE l_linestatus WHEN 'F' THEN 'modified' ELSE 'added' END AS status
  FROM lineitem) f ON f.commit_no = c.commit_no
""")

_view("dep_prs", ["part"], """
SELECT concat('org', CAST(p_partkey % 4 AS STRING), '/repo') AS repo, p_partkey AS pr_number, CASE p_partkey % 7
  WHEN 0 THEN concat('Bump ', p_name, ' from 1.', CAST(p_size AS STRING), ' to 2.0')
  WHEN 1 THEN concat('chore(deps): bump ', p_name, ' from 1.0 to 1.', CAST(p_size AS STRING))
  WHEN 2 THEN concat('Update ', p_name, ' requirement from >=1.0 to >=1.', CAST(p_size AS STRING))
  WHEN 3 THEN concat('Update ', p_name, ' to 3.', CAST(p_size AS STRING))
  WHEN 4 THEN concat('Upgrade ', p_name, ' from 1.0 to 2.0')
  WHEN 5 THEN concat('Update ', p_name, ' from 1.', CAST(p_size AS STRING), ' to 2.1') ELSE p_name END AS title,
  CASE p_size % 5 WHEN 0 THEN 'package-lock.json' WHEN 1 THEN 'requirements.txt' WHEN 2 THEN 'Cargo.toml'
    WHEN 3 THEN 'go.mod' ELSE 'README.md' END AS filename,
  CASE p_size % 9 WHEN 0 THEN 'Good first issue' WHEN 1 THEN 'dependencies,NPM' WHEN 2 THEN 'dependencies,pip'
    ELSE 'dependencies' END AS label_list,
  CASE p_size % 6 WHEN 0 THEN 'Bumps the package.json file' WHEN 1 THEN 'changes requirements' WHEN 2 THEN 'edits Cargo.toml'
    WHEN 3 THEN 'edits the Gemfile' WHEN 4 THEN 'edits go.mod' ELSE CAST(NULL AS STRING) END AS body,
  CASE p_partkey % 5 WHEN 0 THEN 'Dependabot[bot]' WHEN 1 THEN 'renovate[bot]' WHEN 2 THEN 'renovate' WHEN 3 THEN 'dependabot-preview[bot]' ELSE 'a-person' END AS author,
  concat('https://example.org/', CAST(p_partkey AS STRING)) AS html_url,
  '2024-01-01' AS created_at,
  CASE WHEN p_size % 2 = 0 THEN '2024-01-02' ELSE CAST(NULL AS STRING) END AS merged_at,
  CASE WHEN p_size % 3 = 0 THEN '2024-01-03' ELSE CAST(NULL AS STRING) END AS closed_at
FROM part
""")

_view("log_parts", ["conversations"], """
SELECT conv_id AS run_id, turn AS part_no,
  concat(CASE turn % 3 WHEN 0 THEN '1_test' WHEN 1 THEN '2_setup' ELSE '3_Build' END, '.txt') AS name, text
FROM conversations
""")

# Every event as a GitLab pipeline of one of eleven projects.
_view("gitlab_pipelines", ["events"], """
SELECT concat('group/p', CAST(user_id % 11 AS STRING)) AS project_path, event_id AS pipeline_id,
  CASE event_id % 3 WHEN 0 THEN 'main' ELSE 'develop' END AS ref, md5(CAST(event_id AS STRING)) AS sha,
  CASE WHEN event_type IN ('error', 'view') THEN 'failed' WHEN event_type = 'signup' THEN 'success' ELSE 'running' END AS status,
  concat('merge ', CAST(event_id AS STRING)) AS commit_message, concat('https://example.org/-/', CAST(event_id AS STRING)) AS web_url,
  value AS duration, CAST(event_id AS STRING) AS created_at
FROM events
""")

_view("gitlab_projects", ["events"], """
SELECT DISTINCT concat('group/p', CAST(user_id % 11 AS STRING)) AS project_path, concat('https://example.org/p', CAST(user_id % 11 AS STRING)) AS project_url,
  CAST((user_id % 11) * 20 AS BIGINT) AS star_count,
  CASE WHEN user_id % 11 = 5 THEN '' WHEN user_id % 11 = 6 THEN CAST(NULL AS STRING) ELSE 'ruby' END AS predominant_language
FROM events
""")

# Jobs of a pipeline or build: the log of a record, where one has its id.
_view("run_jobs", ["ci_pairs"], """
SELECT id AS run_id, 1 AS job_no, 'lint' AS name, 'check' AS stage, 'success' AS status, 'clean' AS log FROM ci_pairs
UNION ALL
SELECT id AS run_id, 2 AS job_no, 'unit' AS name, 'test' AS stage, CASE WHEN id % 10 = 0 THEN 'success' ELSE 'failed' END AS status, ci_log AS log FROM ci_pairs
UNION ALL
SELECT id AS run_id, 3 AS job_no, 'pack' AS name, 'dist' AS stage, 'failed' AS status, 'never read' AS log FROM ci_pairs
""")

_view("travis_builds", ["events"], """
SELECT concat('org', CAST(user_id % 6 AS STRING), CASE user_id % 6 WHEN 0 THEN '/Django' WHEN 1 THEN '/rails' WHEN 2 THEN '/eslint' ELSE '/app' END) AS repo_slug,
  event_id AS build_number, event_id AS build_id,
  CASE WHEN event_id % 5 = 0 THEN 'dev' ELSE 'master' END AS branch,
  CASE WHEN event_type = 'error' THEN 'errored' WHEN event_type = 'view' THEN 'failed' WHEN event_type = 'signup' THEN 'passed' ELSE 'canceled' END AS state,
  md5(CAST(event_id AS STRING)) AS commit_sha, concat('change ', CAST(event_id AS STRING)) AS commit_message,
  concat('https://example.org/c/', CAST(event_id AS STRING)) AS compare_url, value AS duration,
  CASE WHEN user_id % 6 = 3 THEN CAST(NULL AS STRING) ELSE 'python' END AS language,
  CASE WHEN user_id % 2 = 0 THEN 'osx' ELSE CAST(NULL AS STRING) END AS os, CAST(NULL AS STRING) AS dist, CAST(event_id AS STRING) AS started_at
FROM events
""")

# CircleCI levels: order -> line -> part of a line. Line keys repeat, so each
# line is numbered over all of its columns and that number is its key.
_view("circle_lines", ["lineitem", "commits"], """
SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_quantity, l_partkey, concat('github/', c.repo) AS project_slug,
  l_orderkey * 1000 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS line_id
FROM lineitem JOIN commits c ON c.commit_no = l_orderkey
""")

_view("circle_pipelines", ["orders", "commits"], """
SELECT o.o_orderkey AS pipeline_id, concat('github/', c.repo) AS project_slug, c.repo, concat('https://example.org/', c.repo) AS repo_url,
  'main' AS branch, CASE o.o_orderstatus WHEN 'F' THEN 'errored' WHEN 'O' THEN 'created' ELSE 'setup' END AS state,
  c.sha AS failed_sha, CAST(o.o_orderkey AS STRING) AS created_at
FROM orders o JOIN commits c ON c.commit_no = o.o_orderkey
""")

_view("circle_workflows", ["circle_lines"], """
SELECT project_slug, l_orderkey AS pipeline_id, line_id AS workflow_id, line_id AS workflow_no, concat('flow', CAST(l_linenumber AS STRING)) AS workflow_name,
  CASE l_returnflag WHEN 'R' THEN 'failed' WHEN 'A' THEN 'error' ELSE 'success' END AS status
FROM circle_lines
""")

# Jobs are numbered within their project, so that numbers repeat across projects.
_view("circle_jobs", ["circle_lines"], """
SELECT project_slug, workflow_id, job_no, job_name, status, CAST(row_number() OVER (PARTITION BY project_slug ORDER BY workflow_id, job_no) AS BIGINT) AS job_number FROM (
  SELECT project_slug, line_id AS workflow_id, 1 AS job_no, 'build' AS job_name,
    CASE WHEN l_quantity < 10 THEN 'success' WHEN l_quantity < 30 THEN 'blocked' ELSE 'failed' END AS status FROM circle_lines
  UNION ALL
  SELECT project_slug, line_id AS workflow_id, 2 AS job_no, 'test' AS job_name,
    CASE WHEN l_linestatus = 'F' THEN 'failed' ELSE 'success' END AS status FROM circle_lines) AS j
""")

_view("circle_actions", ["circle_jobs"], """
SELECT project_slug, job_number, 1 AS step_no, 1 AS action_no, 'success' AS status, 'https://example.org/1' AS output_url, 'fine' AS step_log FROM circle_jobs
UNION ALL
SELECT project_slug, job_number, 2 AS step_no, 1 AS action_no, 'failed' AS status, CASE WHEN job_number % 3 = 0 THEN '' ELSE 'https://example.org/2' END AS output_url,
  CASE WHEN job_number % 5 = 0 THEN '' ELSE concat('step two of ', CAST(workflow_id AS STRING), chr(10), repeat(concat('before', chr(10)), CAST(job_number % 6 AS INT)),
    'Error: exit code 2', chr(10), repeat(concat('behind', chr(10)), CAST(job_number % 40 AS INT)), project_slug) END AS step_log FROM circle_jobs
UNION ALL
SELECT project_slug, job_number, 2 AS step_no, 2 AS action_no, 'failed' AS status, 'https://example.org/3' AS output_url, 'second action' AS step_log FROM circle_jobs
UNION ALL
SELECT project_slug, job_number, 3 AS step_no, 1 AS action_no, CASE WHEN job_number % 7 = 0 THEN 'success' ELSE 'failed' END AS status, 'https://example.org/4' AS output_url, 'third step' AS step_log FROM circle_jobs
""")

_view("step_logs", ["conversations"], """
SELECT conv_id AS job_id, turn AS step_no, CASE conv_id % 4 WHEN 0 THEN '{"message": "not a list"}' WHEN 1 THEN 'not json'
  ELSE concat('[{"message": "', role, ' says"}, {"type": "out"}, {"message": "turn ', CAST(turn AS STRING), '"}]') END AS step_log,
  CASE WHEN turn % 2 = 0 THEN text ELSE '' END AS content, CASE WHEN turn % 3 = 0 THEN role ELSE CAST(NULL AS STRING) END AS log
FROM conversations
""")

_view("responses", ["ci_pairs", "log_templates"], f"""
SELECT p.id AS case_id,
  concat('Thinking...', chr(10),
    CASE WHEN p.id % 11 = 0 THEN '<classify></classify>'
         ELSE concat('<classify> ', CASE p.id % 4 WHEN 0 THEN 'ENV' WHEN 1 THEN 'LOGIC' WHEN 2 THEN 'FLAKY' ELSE 'DEP_DRIFT' END, ' — 4a_test_expectation_drift </classify>') END,
    chr(10), '<reason>', t.line, '</reason>', chr(10),
    CASE WHEN p.id % 5 = 0 THEN '' ELSE concat('<fix>', chr(10),
      CASE WHEN p.id % 9 = 1 THEN concat(p.fix_diff, repeat(concat('+more', chr(10)), 30)) ELSE p.fix_diff END, '</fix>') END,
    '<validate> run tests ', CAST(p.id AS STRING), '</validate>') AS response,
  CAST(p.id % 16 AS DOUBLE) / 4 AS latency_seconds
FROM ci_pairs p JOIN log_templates t ON p.id % {N_LINES} = t.tid
""")

_view("bench_case_files", ["ci_pairs"], """
SELECT CASE WHEN id = 1 THEN 'env_001_ubuntu_pkg' ELSE concat('case_', CAST(id % 700 AS STRING)) END AS id, repo, language,
  CASE id % 4 WHEN 0 THEN 'ENV' WHEN 1 THEN 'LOGIC' WHEN 2 THEN 'FLAKY' ELSE 'DEP_DRIFT' END AS failure_class,
  '4a_test_expectation_drift' AS failure_subclass, ci_log, fix_diff AS correct_fix_diff, source AS notes,
  concat('case-', lpad(CAST(id AS STRING), 12, '0'), '.json') AS source_file
FROM ci_pairs
""")

_view("bench_truth", ["ci_pairs"], """
SELECT id, repo, CASE WHEN language = 'rust' THEN CAST(NULL AS STRING) ELSE language END AS language,
  CASE WHEN id % 3 = 0 THEN 'ENV' WHEN id % 3 = 1 THEN 'LOGIC' ELSE 'FLAKY' END AS failure_class,
  concat('--- a/f.txt', chr(10), '+++ b/f.txt', chr(10), repeat(concat('+new', chr(10)), CAST(id % 40 AS INT))) AS correct_fix_diff
FROM ci_pairs
""")

_view("rejected_candidates", ["ci_pairs"], """
SELECT id + 1 AS id, CASE WHEN id % 6 = 0 THEN 'too short' WHEN id % 10 = 3 THEN concat('  ', fix_diff, '  ')
  ELSE concat('# retry it', chr(10), fix_diff) END AS rejected FROM ci_pairs
""")

# Replies as a model writes them: plain, wrapped in prose, incomplete, broken.
_view("model_replies", ["ci_pairs"], """
SELECT id AS request_id, '4a_test_expectation_drift' AS asked_subclass, language, 'cli_tool' AS repo_type,
  concat(CASE WHEN id % 5 = 1 THEN 'Here you are: ' ELSE ' ' END,
    '{"failure_class": "LOGIC", "failure_subclass": "4a_test_expectation_drift", ',
    CASE WHEN id % 5 = 2 THEN '' ELSE concat('"ci_log": "log of ', source, '", ') END,
    '"fix_diff": "diff {', CAST(id AS STRING), '}", "extra": {"a": 1}',
    CASE WHEN id % 5 = 3 THEN '' ELSE '}' END, CASE WHEN id % 5 = 1 THEN ' Good luck!' ELSE '' END) AS reply
FROM ci_pairs
""")


def order_of(names: list[str]) -> list[str]:
    """The named views and all they need, dependencies first."""
    done: list[str] = []

    def visit(name: str) -> None:
        if name in done or name in BASE:
            return
        for need in VIEWS[name][0]:
            visit(need)
        done.append(name)

    for name in names:
        visit(name)
    return done


def spark_view(spark: SparkSession, sf_dir: str, name: str, made: dict[str, DataFrame] | None = None) -> DataFrame:
    """A driver table or derived view as a DataFrame; ``made`` keeps the written views of a query."""
    made = {} if made is None else made
    if name in BASE:
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        # The driver writes documents as one row group, which is one task.
        return table.repartition("doc_id") if name == "documents" else table
    for view in order_of([name]):
        if view not in made:
            for need in VIEWS[view][0]:
                if need in BASE:
                    table, key = spark_view(spark, sf_dir, need), DEALT.get((view, need))
                    (table.repartition(key) if key else table).createOrReplaceTempView(need)
            rows = spark.sql(VIEWS[view][1])
            if view in WRITTEN:
                rows = made[view] = durable(rows)
        else:
            rows = made[view]
        rows.createOrReplaceTempView(view)
    return spark.table(name)


def ctes(names: list[str]) -> str:
    """The views as the head of a WITH clause for DuckDB."""
    return ",\n".join(f"{name} AS ({VIEWS[name][1]})" for name in order_of(names))
