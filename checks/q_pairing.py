"""Queries that pair red runs with their fixes."""

from __future__ import annotations

from pyspark.sql import functions as F

from buildmend.operators import context, pairing
from buildmend.session import durable
from checks.registry import query
from checks.sql import any_of, context_steps

_CHAINS = """trunk AS (SELECT * FROM ci_runs WHERE head_branch IN ('main', 'master', 'develop')),
followed AS (SELECT *, lead(conclusion) OVER w AS next_conclusion, lead(run_id) OVER w AS fix_run_id, lead(head_sha) OVER w AS fix_sha
  FROM trunk WINDOW w AS (PARTITION BY repo, workflow_name ORDER BY run_number, run_id)),
chains AS (SELECT repo, workflow_name, run_id AS failed_run_id, run_number AS failed_run_number, head_sha AS failing_sha, fix_run_id, fix_sha
  FROM followed WHERE conclusion = 'failure' AND next_conclusion = 'success')"""


@query("failure_fix_chains", ["ci_runs"], steps=_CHAINS, sql="SELECT * FROM chains")
def failure_fix_chains(t):
    return pairing.failure_fix_chains(t.ci_runs, chunk_rows=1000)


@query(
    "chains_capped", ["ci_runs"], steps=_CHAINS,
    sql="""SELECT repo, workflow_name, failed_run_id, fix_run_id FROM chains
    QUALIFY row_number() OVER (PARTITION BY repo ORDER BY workflow_name, failed_run_number, failed_run_id) <= 30""",
)
def chains_capped(t):
    return pairing.chains_capped(pairing.failure_fix_chains(t.ci_runs), 30).select(
        "repo", "workflow_name", "failed_run_id", "fix_run_id"
    )


@query(
    "pairs_per_repo", ["ci_runs"], steps=_CHAINS,
    sql="SELECT repo, count(*) AS n_pairs FROM chains GROUP BY ROLLUP (repo)",
)
def pairs_per_repo(t):
    return pairing.pairs_per_repo(pairing.failure_fix_chains(t.ci_runs))


@query(
    "bot_filter", ["ci_runs"],
    sql="""SELECT run_id, actor_login FROM ci_runs WHERE lower(actor_login) LIKE '%dependabot%' OR lower(actor_login) LIKE '%renovate%'""",
)
def bot_filter(t):
    return pairing.bot_runs(t.ci_runs).select("run_id", "actor_login")


@query("env_diff_filter", ["ci_pairs"], sql=f"SELECT id FROM ci_pairs WHERE {any_of('fix_diff', pairing.ENV_MARKERS)}")
def env_diff_filter(t):
    return pairing.env_diff_filter(t.ci_pairs).select("id")


@query(
    "repo_language_filter", ["travis_builds"],
    sql=f"""SELECT 'python' AS language, build_id, repo_slug FROM travis_builds WHERE {any_of('lower(repo_slug)', pairing.REPO_KEYWORDS['python'])}
    UNION ALL SELECT 'ruby', build_id, repo_slug FROM travis_builds WHERE {any_of('lower(repo_slug)', pairing.REPO_KEYWORDS['ruby'])}
    UNION ALL SELECT 'node', build_id, repo_slug FROM travis_builds WHERE {any_of('lower(repo_slug)', pairing.REPO_KEYWORDS['node'])}
    UNION ALL SELECT 'cobol', build_id, repo_slug FROM travis_builds""",
)
def repo_language_filter(t):
    parts = [
        pairing.repo_language_filter(t.travis_builds, language, "repo_slug").select(
            F.lit(language).alias("language"), "build_id", "repo_slug"
        )
        for language in ("python", "ruby", "node", "cobol")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query(
    "incremental_skip", ["ci_runs", "ci_pairs"],
    sql="SELECT run_id, repo FROM ci_runs WHERE run_id NOT IN (SELECT id FROM ci_pairs)",
)
def incremental_skip(t):
    done = t.ci_pairs.select(F.col("id").alias("run_id"))
    return pairing.incremental_skip(t.ci_runs, done, ["run_id"]).select("run_id", "repo")


_GREEN = """numbered AS (SELECT *, row_number() OVER (PARTITION BY repo ORDER BY committed_at DESC, commit_no DESC) AS pos FROM commits),
seen AS (SELECT * FROM numbered),
failures AS (SELECT repo, run_id, workflow_name, head_sha AS failing_sha FROM commit_runs WHERE conclusion = 'failure'),
candidates AS (SELECT f.repo, f.run_id, c.sha, c.pos FROM failures f JOIN seen s ON s.repo = f.repo AND s.sha = f.failing_sha
  JOIN seen c ON c.repo = f.repo AND c.pos < s.pos
  WHERE EXISTS (SELECT 1 FROM commit_runs r WHERE r.repo = c.repo AND r.head_sha = c.sha AND r.workflow_name = f.workflow_name AND r.conclusion = 'success')),
fixes AS (SELECT repo, run_id, arg_min(sha, pos) AS latest_sha, arg_max(sha, pos) AS next_sha FROM candidates GROUP BY repo, run_id)"""


def _failed_commit_runs(t):
    return t.commit_runs.filter(F.col("conclusion") == "failure").withColumnRenamed("head_sha", "failing_sha")


@query(
    "fix_commit_latest_green", ["commits", "commit_runs"], steps=_GREEN,
    sql="""SELECT f.repo, f.run_id, f.workflow_name, f.failing_sha, x.latest_sha AS fix_sha FROM failures f LEFT JOIN fixes x ON x.repo = f.repo AND x.run_id = f.run_id""",
)
def fix_commit_latest_green(t):
    failures = _failed_commit_runs(t).select("repo", "run_id", "workflow_name", "failing_sha")
    return pairing.green_commit_fix(failures, t.commits, t.commit_runs)


@query(
    "fix_commit_next_green", ["commits", "commit_runs"], steps=_GREEN,
    sql="""SELECT f.repo, f.run_id, f.workflow_name, f.failing_sha, x.next_sha AS fix_sha FROM failures f LEFT JOIN fixes x ON x.repo = f.repo AND x.run_id = f.run_id""",
)
def fix_commit_next_green(t):
    failures = _failed_commit_runs(t).select("repo", "run_id", "workflow_name", "failing_sha")
    return pairing.green_commit_fix(failures, t.commits, t.commit_runs, pick="next")


_DIFF = """texts AS (SELECT repo, sha, string_agg('--- a/' || filename || chr(10) || '+++ b/' || filename || chr(10) || patch, chr(10) ORDER BY file_no)
  FILTER (patch IS NOT NULL AND patch <> '') AS diff FROM commit_files GROUP BY repo, sha)"""


@query("assemble_diff", ["commit_files"], steps=_DIFF, sql="SELECT repo, sha, coalesce(diff, '') AS diff FROM texts")
def assemble_diff(t):
    return pairing.assemble_diff(t.commit_files, ["repo", "sha"])


@query(
    "github_pairs", ["commits", "commit_runs", "commit_files", "ci_pairs"], steps=_GREEN + ",\n" + _DIFF + """,
bots AS (SELECT r.* FROM commit_runs r WHERE r.conclusion = 'failure' AND (contains(lower(actor_login), 'dependabot') OR contains(lower(actor_login), 'renovate'))),
logs AS (SELECT (id + 1) * 4 AS run_id, ci_log FROM ci_pairs WHERE length(ci_log) >= 200)""",
    sql="""SELECT 'github_actions_' || replace(b.repo, '/', '__') || '_' || b.run_id AS id, 'github_actions' AS source, b.repo, b.language, b.run_id, b.workflow_name,
      b.head_sha AS failing_sha, x.latest_sha AS fix_sha, l.ci_log, CASE WHEN x.latest_sha IS NOT NULL THEN coalesce(d.diff, '') END AS fix_diff,
      x.latest_sha IS NOT NULL AS has_fix, true AS dep_drift_mode
    FROM bots b JOIN logs l ON l.run_id = b.run_id LEFT JOIN fixes x ON x.repo = b.repo AND x.run_id = b.run_id LEFT JOIN texts d ON d.repo = b.repo AND d.sha = x.latest_sha""",
)
def github_pairs(t):
    failures = _failed_commit_runs(t)
    bots = pairing.bot_runs(failures).select("run_id")
    # Logs are left out by their run first, so that only those of bots' failures are moved on.
    logs = durable(
        t.ci_pairs.select(((F.col("id") + 1) * 4).alias("run_id"), "ci_log").join(bots, "run_id", "left_semi")
        .join(t.commit_runs.select("run_id", "repo"), "run_id")
    )
    failures = failures.join(logs.select("repo", "run_id"), ["repo", "run_id"], "left_semi")
    fixes = durable(pairing.green_commit_fix(failures.select("repo", "run_id", "workflow_name", "failing_sha"), t.commits, t.commit_runs))
    # The commit's own files stand for the comparison with the failing commit; files of no fix are left out.
    files = t.commit_files.join(fixes.select("repo", F.col("fix_sha").alias("sha")).distinct(), ["repo", "sha"], "left_semi")
    diffs = fixes.select("repo", "failing_sha", "fix_sha").distinct().join(
        pairing.assemble_diff(files, ["repo", "sha"]).withColumnRenamed("sha", "fix_sha"), ["repo", "fix_sha"]
    )
    return pairing.github_pairs(failures, logs, fixes.select("repo", "run_id", "fix_sha"), diffs, bots_only=True).drop("ci_platform")


@query(
    "history_pairs", ["ci_runs", "ci_pairs"], steps=_CHAINS,
    sql="""SELECT 'ci_history_' || replace(c.repo, '/', '__') || '_' || c.failed_run_id AS id, c.repo, c.workflow_name, c.failing_sha, c.fix_sha, c.failed_run_id, c.fix_run_id,
      l.ci_log, d.fix_diff, true AS has_fix, true AS env_mode
    FROM chains c JOIN ci_pairs d ON d.id = c.fix_run_id LEFT JOIN ci_pairs l ON l.id = c.failed_run_id
    WHERE contains(d.fix_diff, 'Dockerfile') OR contains(d.fix_diff, '.yml') OR contains(d.fix_diff, '.yaml') OR contains(d.fix_diff, 'apt-get') OR contains(d.fix_diff, 'FROM ')""",
)
def history_pairs(t):
    chains = pairing.failure_fix_chains(t.ci_runs)
    texts = t.ci_pairs.select(F.col("id").alias("fix_run_id"), F.col("fix_diff").alias("diff"))
    diffs = chains.join(texts, "fix_run_id").select("repo", "failing_sha", "fix_sha", "diff")
    logs = t.ci_pairs.select(F.col("id").alias("run_id"), "ci_log").join(t.ci_runs.select("run_id", "repo"), "run_id")
    return pairing.history_pairs(chains, diffs, logs, env_mode=True).drop("source", "language", "ci_platform")


_PIPE = """red AS (SELECT * FROM gitlab_pipelines WHERE status = 'failed'),
green AS (SELECT * FROM gitlab_pipelines WHERE status = 'success')"""


@query(
    "fix_pipeline_latest", ["gitlab_pipelines"], steps=_PIPE,
    sql="""SELECT r.project_path, r.pipeline_id, max(g.pipeline_id) AS fix_pipeline_id, arg_max(g.sha, g.pipeline_id) AS fix_sha,
      arg_max(g.commit_message, g.pipeline_id) AS fix_message, count(g.pipeline_id) > 0 AS has_fix
    FROM red r LEFT JOIN green g ON g.project_path = r.project_path AND g.ref = r.ref AND g.pipeline_id > r.pipeline_id GROUP BY r.project_path, r.pipeline_id""",
)
def fix_pipeline_latest(t):
    red = t.gitlab_pipelines.filter(F.col("status") == "failed")
    return pairing.green_pipeline_fix(red, t.gitlab_pipelines).select(
        "project_path", "pipeline_id", F.col("fix_pipeline.pipeline_id").alias("fix_pipeline_id"),
        F.col("fix_pipeline.sha").alias("fix_sha"), F.col("fix_pipeline.commit_message").alias("fix_message"),
        F.col("fix_pipeline").isNotNull().alias("has_fix"),
    )


@query(
    "fix_gitlab_next_green", ["gitlab_pipelines"], steps=_PIPE,
    sql="""SELECT r.project_path, r.pipeline_id, min(g.pipeline_id) AS fix_pipeline_id
    FROM red r LEFT JOIN green g ON g.project_path = r.project_path AND g.ref = r.ref AND g.pipeline_id > r.pipeline_id GROUP BY r.project_path, r.pipeline_id""",
)
def fix_gitlab_next_green(t):
    red = t.gitlab_pipelines.filter(F.col("status") == "failed")
    return pairing.green_pipeline_fix(red, t.gitlab_pipelines, pick="next", chunk_ids=1000).select(
        "project_path", "pipeline_id", F.col("fix_pipeline.pipeline_id").alias("fix_pipeline_id")
    )


_GITLAB_LINES = r"(ERROR|FAILED|error:)\s+|Job failed|Build failed|Pipeline failed|exit status \d+|make\[\d+\].*Error \d+|fatal:|FAIL\s+"
_TRAVIS_LINES = r"The command .+ exited with \d+|(FAILED|ERROR|error:)\s+|Build failed|bundler: failed|rake aborted!|npm ERR!|Test failed"


def _context(rule: context.ContextRule, pattern: str) -> str:
    return """job AS (SELECT run_id, arg_min(name, job_no) AS name, arg_min(stage, job_no) AS stage, arg_min(log, job_no) AS log FROM run_jobs
  WHERE status = 'failed' GROUP BY run_id),
""" + context_steps(pattern, rule.before, rule.after, True, "job", "run_id", "log") + """,
chosen AS (SELECT * FROM near WHERE has_err = 0 OR keep = 1),
ctx AS (SELECT id, string_agg(line, chr(10) ORDER BY i) AS failure_log FROM chosen GROUP BY id)"""


@query(
    "gitlab_pairs", ["gitlab_pipelines", "gitlab_projects", "run_jobs"], steps=_PIPE + ",\n" + _context(context.GITLAB, _GITLAB_LINES) + """,
best AS (SELECT project_path, ref, max(pipeline_id) AS pid, arg_max(sha, pipeline_id) AS sha FROM green GROUP BY project_path, ref)""",
    sql="""SELECT r.project_path, p.project_url, r.pipeline_id, r.sha AS failed_sha, r.ref AS branch, j.name AS failed_job_name, j.stage AS failed_stage, c.failure_log,
      b.sha AS fix_sha, b.sha IS NOT NULL AS has_fix, coalesce(nullif(p.predominant_language, ''), 'unknown') AS language, p.star_count AS project_stars, r.created_at
    FROM red r JOIN gitlab_projects p ON p.project_path = r.project_path AND p.star_count >= 50 JOIN job j ON j.run_id = r.pipeline_id JOIN ctx c ON c.id = r.pipeline_id
    LEFT JOIN best b ON b.project_path = r.project_path AND b.ref = r.ref AND b.pid > r.pipeline_id""",
)
def gitlab_pairs(t):
    jobs = t.run_jobs.withColumnsRenamed({"run_id": "pipeline_id", "log": "trace"})
    return pairing.gitlab_pairs(t.gitlab_pipelines, jobs, t.gitlab_projects).select(
        "project_path", "project_url", "pipeline_id", "failed_sha", "branch", "failed_job_name", "failed_stage", "failure_log",
        F.col("fix_pipeline.sha").alias("fix_sha"), "has_fix", "language", "project_stars", "created_at",
    )


_BUILDS = """passing AS (SELECT *, first_value(CASE WHEN state = 'passed' THEN build_number END IGNORE NULLS)
  OVER (PARTITION BY repo_slug, branch ORDER BY build_number, build_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS fix_number FROM travis_builds),
broken AS (SELECT * FROM passing WHERE state IN ('failed', 'errored'))"""


@query(
    "fix_build_asof", ["travis_builds"], steps=_BUILDS,
    sql="""SELECT b.repo_slug, b.build_number, b.fix_number AS fix_build_number, f.commit_sha AS fix_sha, f.commit_message AS fix_message, f.duration AS fix_duration
    FROM broken b LEFT JOIN travis_builds f ON f.repo_slug = b.repo_slug AND f.build_number = b.fix_number""",
)
def fix_build_asof(t):
    return pairing.passing_build_fix(t.travis_builds, chunk_rows=1000).select(
        "repo_slug", "build_number", F.col("fix_build.build_number").alias("fix_build_number"),
        F.col("fix_build.commit_sha").alias("fix_sha"), F.col("fix_build.commit_message").alias("fix_message"),
        F.col("fix_build.duration").alias("fix_duration"),
    )


@query(
    "travis_pairs", ["travis_builds", "run_jobs"], steps=_BUILDS + ",\n" + _context(context.TRAVIS, _TRAVIS_LINES),
    sql="""SELECT b.repo_slug, b.build_number, b.build_id, b.branch, coalesce(b.language, 'unknown') AS language, j.stage AS failed_job_name, b.commit_sha AS failed_sha,
      b.commit_message, c.failure_log, b.fix_number AS fix_build_number, b.fix_number IS NOT NULL AS has_fix, coalesce(b.os, 'linux') AS os, coalesce(b.dist, '') AS dist, b.started_at
    FROM broken b JOIN job j ON j.run_id = b.build_id JOIN ctx c ON c.id = b.build_id""",
)
def travis_pairs(t):
    jobs = t.run_jobs.withColumnsRenamed({"run_id": "build_id", "status": "state"})
    return pairing.travis_pairs(t.travis_builds, jobs).select(
        "repo_slug", "build_number", "build_id", "branch", "language", "failed_job_name", "failed_sha", "commit_message", "failure_log",
        F.col("fix_build.build_number").alias("fix_build_number"), "has_fix", "os", "dist", "started_at",
    )


_CIRCLE = """wf AS (SELECT * FROM circle_workflows WHERE status IN ('failed', 'error') QUALIFY row_number() OVER (PARTITION BY project_slug, pipeline_id ORDER BY workflow_no) = 1),
jb AS (SELECT * FROM circle_jobs WHERE status IN ('failed', 'blocked') QUALIFY row_number() OVER (PARTITION BY project_slug, workflow_id ORDER BY job_no) = 1),
tried AS (SELECT * FROM circle_actions WHERE status = 'failed' AND output_url <> '' QUALIFY row_number() OVER (PARTITION BY project_slug, job_number, step_no ORDER BY action_no) = 1),
st AS (SELECT * FROM tried WHERE step_log <> '' QUALIFY row_number() OVER (PARTITION BY project_slug, job_number ORDER BY step_no) = 1),
failed AS (SELECT wf.project_slug, wf.pipeline_id, wf.workflow_name, jb.job_name, jb.job_number, st.step_no, st.action_no, st.step_log
  FROM wf JOIN jb ON jb.project_slug = wf.project_slug AND jb.workflow_id = wf.workflow_id JOIN st ON st.project_slug = jb.project_slug AND st.job_number = jb.job_number)"""


@query("first_failed_step", ["circle_workflows", "circle_jobs", "circle_actions"], steps=_CIRCLE, sql="SELECT * FROM failed")
def first_failed_step(t):
    return pairing.first_failed_step(t.circle_workflows, t.circle_jobs, t.circle_actions)


_NEXT_COMMIT = """chain AS (SELECT repo, sha, lead(sha) OVER w AS next_sha, lead(message) OVER w AS next_message, lead(author) OVER w AS next_author
  FROM commits WINDOW w AS (PARTITION BY repo ORDER BY committed_at, commit_no)),
ci_files AS (SELECT *, row_number() OVER (PARTITION BY repo, sha ORDER BY file_no) AS k FROM commit_files
  WHERE contains(filename, '.yml') OR contains(filename, '.yaml') OR contains(filename, '.json') OR contains(filename, 'Dockerfile') OR contains(filename, 'requirements') OR contains(filename, 'package')),
counts AS (SELECT repo, sha, count(*) AS n FROM commit_files GROUP BY repo, sha),
named AS (SELECT repo, sha, string_agg(filename, ',' ORDER BY k) AS names, string_agg(coalesce(patch, ''), chr(10) ORDER BY k) AS patch
  FROM ci_files GROUP BY repo, sha),
fixed AS (SELECT c.repo, c.sha AS failed_sha, c.next_sha AS fix_sha, c.next_message AS fix_message, c.next_author AS fix_author,
    CASE WHEN c.next_sha IS NOT NULL THEN coalesce(k.n, 0) END AS files_changed,
    CASE WHEN c.next_sha IS NOT NULL THEN coalesce(m.names, '') END AS ci_files_changed, CASE WHEN c.next_sha IS NOT NULL THEN coalesce(m.patch, '') END AS diff_patch
  FROM chain c LEFT JOIN counts k ON k.repo = c.repo AND k.sha = c.next_sha LEFT JOIN named m ON m.repo = c.repo AND m.sha = c.next_sha)"""


@query(
    "fix_next_commit", ["commits", "commit_files"], steps=_NEXT_COMMIT,
    sql="SELECT repo, failed_sha, fix_sha, fix_message, fix_author, CAST(files_changed AS INT) AS files_changed, ci_files_changed, diff_patch FROM fixed",
)
def fix_next_commit(t):
    failures = t.commits.select("repo", F.col("sha").alias("failed_sha"))
    return pairing.next_commit_fix(failures, t.commits, t.commit_files).select(
        "repo", "failed_sha", F.col("fix_commit.sha").alias("fix_sha"), F.col("fix_commit.message").alias("fix_message"),
        F.col("fix_commit.author").alias("fix_author"), "fix_commit.files_changed",
        F.array_join("fix_commit.ci_files_changed", ",").alias("ci_files_changed"), "fix_commit.diff_patch",
    )


_CIRCLE_LINES = r"Error|Exception|FAILED|FAILURE|npm ERR!|exit code \d+"


@query(
    "circleci_pairs", ["circle_pipelines", "circle_workflows", "circle_jobs", "circle_actions", "commits", "commit_files"],
    steps=_CIRCLE + ",\n" + _NEXT_COMMIT + ",\n" + context_steps(
        _CIRCLE_LINES, context.CIRCLECI.before, context.CIRCLECI.after, False, "failed", "pipeline_id", "step_log"
    ) + """,
chosen AS (SELECT * FROM near WHERE has_err = 0 OR keep = 1),
ctx AS (SELECT id, string_agg(line, chr(10) ORDER BY i) AS failure_log FROM chosen GROUP BY id)""",
    sql="""SELECT p.project_slug, p.repo_url, p.pipeline_id, f.workflow_name, f.job_name AS failed_job_name, p.failed_sha, p.branch, c.failure_log,
      x.fix_sha, x.fix_message, x.fix_author, CAST(x.files_changed AS INT) AS files_changed, x.ci_files_changed, x.diff_patch, x.fix_sha IS NOT NULL AS has_fix, p.created_at
    FROM circle_pipelines p JOIN failed f ON f.project_slug = p.project_slug AND f.pipeline_id = p.pipeline_id JOIN ctx c ON c.id = p.pipeline_id
    JOIN fixed x ON x.repo = p.repo AND x.failed_sha = p.failed_sha
    WHERE p.state IN ('errored', 'created') AND c.failure_log <> ''""",
)
def circleci_pairs(t):
    return pairing.circleci_pairs(
        t.circle_pipelines, t.circle_workflows, t.circle_jobs, t.circle_actions, t.commits, t.commit_files
    ).select(
        "project_slug", "repo_url", "pipeline_id", "workflow_name", "failed_job_name", "failed_sha", "branch", "failure_log",
        F.col("fix_commit.sha").alias("fix_sha"), F.col("fix_commit.message").alias("fix_message"),
        F.col("fix_commit.author").alias("fix_author"), "fix_commit.files_changed",
        F.array_join("fix_commit.ci_files_changed", ",").alias("ci_files_changed"), "fix_commit.diff_patch", "has_fix", "created_at",
    )


@query(
    "repos_to_process", ["ci_runs", "commit_runs"],
    sql="SELECT DISTINCT repo FROM commit_runs WHERE repo NOT IN (SELECT repo FROM ci_runs)",
)
def repos_to_process(t):
    return pairing.repos_to_process(t.commit_runs.select("repo"), t.ci_runs.select("repo"))
