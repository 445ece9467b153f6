"""Pairing of red CI runs with what turned them green, and the pair records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from buildmend.functions.text import any_contains, cut, slug, text_or_empty
from buildmend.operators.context import CIRCLECI, GITLAB, TRAVIS, error_context
from buildmend.operators.ordered import first_per_group, next_value
from buildmend.session import durable

# Branches, bots, states, markers and keyword lists.
TRUNK_BRANCHES = ["main", "master", "develop"]
BOT_WORDS = ["dependabot", "renovate"]
ENV_MARKERS = ["Dockerfile", ".yml", ".yaml", "apt-get", "FROM "]
TRAVIS_FAILED = ["failed", "errored"]
GITLAB_FAILED = ["failed"]
CIRCLECI_FAILED_WORKFLOW = ["failed", "error"]
CIRCLECI_FAILED_JOB = ["failed", "blocked"]
CIRCLECI_PIPELINE_STATES = ["errored", "created"]
CI_FILE_MARKERS = [".yml", ".yaml", ".json", "Dockerfile", "requirements", "package"]
REPO_KEYWORDS = {
    "python": [
        "django", "flask", "request", "pip", "sqlalchemy", "pytest", "numpy", "pandas", "scikit",
        "celery", "redis", "boto", "docker", "paramiko", "httpie", "scrapy", "ansible",
    ],
    "ruby": ["rails", "jekyll", "ruby", "rubocop", "bundler", "sinatra"],
    "node": ["express", "lodash", "npm", "eslint", "prettier", "babel", "jest", "mocha"],
}
MIN_LOG_CHARS = 200
MIN_STARS = 50
# Rows of one group that one task may sort; see `next_value`.
RUNS_PER_CHUNK = 50_000


# -- filters -----------------------------------------------------------------

def bot_runs(runs: DataFrame, login: str = "actor_login") -> DataFrame:
    """Runs started by a dependency bot."""
    return runs.filter(any_contains(F.lower(text_or_empty(F.col(login))), BOT_WORDS))


def env_diff_filter(df: DataFrame, diff: str = "fix_diff") -> DataFrame:
    """Pairs whose diff touches images, workflow files or system packages."""
    return df.filter(any_contains(F.col(diff), ENV_MARKERS))


def repo_language_filter(df: DataFrame, language: str | None, repo: str = "repo") -> DataFrame:
    """Repositories whose name hints at ``language``; an unlisted language keeps all."""
    words = REPO_KEYWORDS.get((language or "").lower())
    return df if words is None else df.filter(any_contains(F.lower(F.col(repo)), words))


def incremental_skip(df: DataFrame, processed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys were not processed before."""
    return df.join(processed.select(*keys), keys, "left_anti")


def repos_to_process(repos: DataFrame, processed: DataFrame, repo: str = "repo") -> DataFrame:
    """Each repository once, however many lists name it, less those done before."""
    return incremental_skip(repos.dropDuplicates([repo]), processed, [repo])


# -- finding the fix ---------------------------------------------------------

def failure_fix_chains(
    runs: DataFrame, branches: list[str] = TRUNK_BRANCHES, chunk_rows: int = RUNS_PER_CHUNK
) -> DataFrame:
    """Failed trunk runs whose very next run of the same workflow is green."""
    trunk = runs.filter(F.col("head_branch").isin(branches)).select(
        "repo", "workflow_name", "run_number", "run_id", "head_sha", "conclusion"
    )
    follower = F.struct("run_id", "run_number", "head_sha", "conclusion")
    chunk = F.floor(F.col("run_number") / chunk_rows)
    chained = next_value(
        trunk, ["repo", "workflow_name"], ["run_number", "run_id"], follower, chunk, "next_run"
    )
    return chained.filter(
        (F.col("conclusion") == "failure") & (F.col("next_run.conclusion") == "success")
    ).select(
        "repo", "workflow_name",
        F.col("run_id").alias("failed_run_id"),
        F.col("run_number").alias("failed_run_number"),
        F.col("head_sha").alias("failing_sha"),
        F.col("next_run.run_id").alias("fix_run_id"),
        F.col("next_run.head_sha").alias("fix_sha"),
    )


def chains_capped(chains: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` chains of each repository; None keeps all."""
    order = [F.col("workflow_name"), F.col("failed_run_number"), F.col("failed_run_id")]
    return first_per_group(chains, ["repo"], order, n)


def green_commit_fix(
    failures: DataFrame,
    commits: DataFrame,
    runs: DataFrame,
    last: int | None = None,
    pick: str = "latest",
) -> DataFrame:
    """The commit that brought the failed workflow back to green.

    ``commits`` (repo, sha, committed_at, commit_no) is looked at from the
    newest down, all of them or the ``last`` per repository. ``pick`` takes the
    newest green commit behind the failing one, or the next one. Failures
    without a fix keep a null ``fix_sha``.
    """
    place = F.struct("committed_at", "commit_no")
    keys = ["repo", "workflow_name"]
    seen = commits.select("repo", "sha", "committed_at", "commit_no")
    if last is not None:
        seen = first_per_group(
            seen, ["repo"], [F.col("committed_at").desc(), F.col("commit_no").desc()], last
        )
    # Only green runs of workflows that failed are placed; repeats do no harm.
    # A table, whose size tells Spark whether runs have to be moved to meet it.
    broken_workflows = durable(failures.select(*keys).distinct())
    green = (
        runs.filter(F.col("conclusion") == "success")
        .select("repo", F.col("head_sha").alias("sha"), "workflow_name")
        .join(broken_workflows, keys, "left_semi")
        .join(seen, ["repo", "sha"])
    )
    broken = failures.join(
        seen.select("repo", F.col("sha").alias("failing_sha"), "committed_at", "commit_no"),
        ["repo", "failing_sha"],
        "left",
    )
    if pick == "latest":
        newest = durable(green.groupBy(*keys).agg(
            F.max_by("sha", place).alias("_sha"), F.max(place).alias("_place")
        ))
        # A failing commit that was not looked at has no place to compare with.
        behind = F.col("committed_at").isNotNull() & (F.col("_place") > place)
        return broken.join(newest, keys, "left").select(
            *failures.columns, F.when(behind, F.col("_sha")).alias("fix_sha")
        )
    if pick != "next":
        raise ValueError(f"pick must be 'latest' or 'next', not {pick!r}")
    events = green.select(
        *keys, "committed_at", "commit_no", F.lit(0).alias("_is_failure"),
        F.col("sha").alias("_green"),
    ).unionByName(
        broken.withColumn("_is_failure", F.lit(1)), allowMissingColumns=True
    )
    followed = next_value(
        events, keys, ["committed_at", "commit_no", "_is_failure"], F.col("_green"),
        F.date_trunc("day", "committed_at"), "fix_sha",
    )
    return followed.filter(F.col("_is_failure") == 1).select(
        *failures.columns, F.when(F.col("committed_at").isNotNull(), F.col("fix_sha")).alias("fix_sha")
    )


def green_pipeline_fix(
    failed: DataFrame, pipelines: DataFrame, pick: str = "latest", chunk_ids: int = 1_000_000,
    message_chars: int | None = None,
) -> DataFrame:
    """The green pipeline behind a failed one on the same project and ref.

    The latest green pipeline of a ref fixes every earlier failure, so one
    partial maximum per ref replaces an inequality join.
    """
    keys = ["project_path", "ref"]
    details = F.struct(
        "pipeline_id", "sha", "ref",
        cut(text_or_empty(F.col("commit_message")), message_chars).alias("commit_message"),
        text_or_empty(F.col("web_url")).alias("web_url"),
        F.coalesce(F.col("duration"), F.lit(0.0)).alias("duration"),
    )
    green = pipelines.filter(F.col("status") == "success")
    if pick == "latest":
        newest = green.groupBy(*keys).agg(F.max_by(details, "pipeline_id").alias("fix_pipeline"))
        return failed.join(newest, keys, "left").withColumn(
            "fix_pipeline",
            F.when(F.col("fix_pipeline.pipeline_id") > F.col("pipeline_id"), F.col("fix_pipeline")),
        ).select(*failed.columns, "fix_pipeline")
    if pick != "next":
        raise ValueError(f"pick must be 'latest' or 'next', not {pick!r}")
    events = green.select(*keys, "pipeline_id", details.alias("_green")).unionByName(
        failed.withColumn("_failed", F.lit(True)), allowMissingColumns=True
    )
    followed = next_value(
        events, keys, ["pipeline_id"], F.col("_green"),
        F.floor(F.col("pipeline_id") / chunk_ids), "fix_pipeline",
    )
    return followed.filter("_failed").select(*failed.columns, "fix_pipeline")


def passing_build_fix(
    builds: DataFrame, chunk_rows: int = RUNS_PER_CHUNK, sha_chars: int | None = None, message_chars: int | None = None
) -> DataFrame:
    """Failed builds with the first passing build behind them on the branch."""
    passed = F.when(
        F.col("state") == "passed",
        F.struct(
            "build_number",
            cut(F.col("commit_sha"), sha_chars).alias("commit_sha"),
            cut(text_or_empty(F.col("commit_message")), message_chars).alias("commit_message"),
            text_or_empty(F.col("compare_url")).alias("compare_url"),
            F.coalesce(F.col("duration"), F.lit(0.0)).alias("duration"),
        ),
    )
    followed = next_value(
        builds, ["repo_slug", "branch"], ["build_number", "build_id"], passed,
        F.floor(F.col("build_number") / chunk_rows), "fix_build",
    )
    return followed.filter(F.col("state").isin(TRAVIS_FAILED))


#: Leading characters that a shortened sha has at least.
SHORT_SHA = 7


def commits_named(named: DataFrame, history: DataFrame) -> DataFrame:
    """What stands behind the commit that each (repo, failed_sha) names.

    Whole shas are compared as they are. A sha that no commit has is taken as
    shortened (or as whole where the history has shortened ones) and compared
    by its beginning within the repository; of several the newest counts.

    Both kinds are found in one join: equal shas and shas of which one begins
    the other have the same first characters, so that a bucket holds the few
    commits of a repository that begin alike, and never a whole repository.
    Rows are dealt by bucket once: repeats fold and the best is chosen there.
    """
    start = F.left("sha", F.lit(SHORT_SHA)).alias("_start")
    wanted = (
        named.select("repo", F.left("failed_sha", F.lit(SHORT_SHA)).alias("_start"), "failed_sha")
        .repartition("repo", "_start").distinct()
    )
    found = wanted.join(history.select("repo", start, "sha", "committed_at", "commit_no", "next_commit"), ["repo", "_start"])
    whole = F.col("sha") == F.col("failed_sha")
    long_enough = F.least(F.length("sha"), F.length("failed_sha")) >= SHORT_SHA
    begins = F.col("sha").startswith(F.col("failed_sha")) | F.col("failed_sha").startswith(F.col("sha"))
    return (
        found.filter(whole | (long_enough & begins))
        .groupBy("repo", "_start", "failed_sha")
        .agg(F.max_by("next_commit", F.struct(whole.alias("whole"), "committed_at", "commit_no")).alias("next_commit"))
        .drop("_start")
    )


def next_commit_fix(
    failures: DataFrame,
    commits: DataFrame,
    files: DataFrame,
    max_files: int | None = None,
    max_patches: int | None = None,
    patch_chars: int | None = None,
    message_chars: int | None = None,
) -> DataFrame:
    """The commit right behind the failing one.

    ``files`` (repo, sha, file_no, filename, patch) gives the changed files;
    names and patches are those of the files that concern CI. The fixes found
    are a table of a row for each sha, so that the history is ordered once.
    Failures meet their fix's place first and its files last, so that patches
    are moved once, and those of other files never.
    """
    history = next_value(
        commits.select("repo", "sha", "committed_at", "commit_no", "message", "author"),
        ["repo"], ["committed_at", "commit_no"],
        F.struct("sha", "message", "author"), F.date_trunc("day", "committed_at"), "next_commit",
    )
    fixes = durable(commits_named(failures, history).select(
        "repo", "failed_sha", F.col("next_commit.sha").alias("_fix_sha"),
        F.col("next_commit.message").alias("_message"), F.col("next_commit.author").alias("_author"),
    ))
    for_ci = any_contains(text_or_empty(F.col("filename")), CI_FILE_MARKERS)
    file = F.struct("file_no", "filename", cut(text_or_empty(F.col("patch")), patch_chars).alias("patch"))
    # Files of other commits are left out ahead of any grouping.
    changed = files.select("repo", "sha", F.when(for_ci, file).alias("_file")).join(
        fixes.select("repo", F.col("_fix_sha").alias("sha")).distinct(), ["repo", "sha"], "left_semi"
    )
    listed = F.array_sort(F.collect_list("_file"))

    def first(items: Column, n: int | None) -> Column:
        return items if n is None else F.slice(items, 1, n)

    per_commit = (
        changed.groupBy("repo", "sha")
        .agg(F.count(F.lit(1)).cast("int").alias("files_changed"), first(listed, max_files).alias("_l"))
        .select(
            "repo", F.col("sha").alias("_at"), "files_changed",
            F.transform("_l", lambda f: f["filename"]).alias("ci_files_changed"),
            F.array_join(F.transform(first(F.col("_l"), max_patches), lambda f: f["patch"]), "\n").alias("diff_patch"),
        )
    )
    nothing = F.array().cast("array<string>")
    # Failures without a fix keep their own sha as a place, so that they do not all go to one task.
    placed = failures.join(fixes, ["repo", "failed_sha"], "left").withColumn("_at", F.coalesce("_fix_sha", "failed_sha"))
    return placed.join(per_commit, ["repo", "_at"], "left").select(
        *failures.columns,
        F.when(
            F.col("_fix_sha").isNotNull(),
            F.struct(
                F.col("_fix_sha").alias("sha"),
                cut(text_or_empty(F.col("_message")), message_chars).alias("message"),
                text_or_empty(F.col("_author")).alias("author"),
                F.coalesce("files_changed", F.lit(0)).alias("files_changed"),
                F.coalesce("ci_files_changed", nothing).alias("ci_files_changed"),
                F.coalesce("diff_patch", F.lit("")).alias("diff_patch"),
            ),
        ).alias("fix_commit"),
    )


def assemble_diff(files: DataFrame, keys: list[str], n: int | None = None) -> DataFrame:
    """One unified diff per comparison, from all or its first ``n`` files.

    Files without a patch count towards ``n`` but add no text; a comparison
    whose files have none keeps an empty diff.
    """
    few = first_per_group(files, keys, [F.col("file_no")], n)
    text = F.concat(
        F.lit("--- a/"), F.col("filename"), F.lit("\n+++ b/"), F.col("filename"), F.lit("\n"), F.col("patch")
    )
    part = F.when(text_or_empty(F.col("patch")) != "", F.struct("file_no", text.alias("text")))
    return few.groupBy(*keys).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(part)), lambda p: p["text"]), "\n"
        ).alias("diff")
    )


def first_failed_step(workflows: DataFrame, jobs: DataFrame, actions: DataFrame) -> DataFrame:
    """From each pipeline down to the log of its first failed step.

    Job numbers count within a project, so ``project_slug`` is part of their
    key. Each level is chosen by positions alone and meets the next level
    once, so that every table is read once. The failed actions of the chosen
    jobs meet them by job, and the step is chosen right there: they are
    neither moved nor written again. The chosen workflows and jobs, one for
    each pipeline, are looked up in hash tables of one partition each, so that
    the many jobs and logs they leave out are never sorted. Within a step only
    the first failed action that has a log place counts; where that log is
    empty the next step is tried.
    """
    pipeline = ["project_slug", "pipeline_id"]
    workflow = (
        workflows.filter(F.col("status").isin(CIRCLECI_FAILED_WORKFLOW))
        .groupBy(*pipeline)
        .agg(F.min(F.struct("workflow_no", "workflow_id", "workflow_name")).alias("w"))
        .select(*pipeline, "w.workflow_id", "w.workflow_name")
    )
    broken_jobs = jobs.filter(F.col("status").isin(CIRCLECI_FAILED_JOB)).select(
        "project_slug", "workflow_id", "job_no", "job_number", "job_name"
    )
    job = (
        broken_jobs.join(workflow.hint("shuffle_hash"), ["project_slug", "workflow_id"])
        .groupBy(*pipeline, "workflow_name")
        .agg(F.min(F.struct("job_no", "job_number", "job_name")).alias("j"))
        .select(*pipeline, "workflow_name", "j.job_name", "j.job_number")
    )
    has_place = (F.col("status") == "failed") & (text_or_empty(F.col("output_url")) != "")
    tried = (
        actions.filter(has_place)
        .select("project_slug", "job_number", "step_no", "action_no", "step_log")
        .join(job.hint("shuffle_hash"), ["project_slug", "job_number"])
    )
    # A pipeline has one job by now, so its steps are steps of that job, and
    # rows that lie together by job need no shuffle to be looked at by pipeline.
    in_pipeline = Window.partitionBy("project_slug", "job_number", "pipeline_id")
    in_step = Window.partitionBy("project_slug", "job_number", "pipeline_id", "step_no")
    has_log = text_or_empty(F.col("step_log")) != ""
    first = F.min(F.struct("action_no", has_log.alias("has_log"))).over(in_step)
    step = F.min(F.when(F.col("_a.has_log"), F.struct("step_no", "_a.action_no"))).over(in_pipeline)
    return (
        tried.withColumn("_a", first).withColumn("_s", step)
        .filter((F.col("step_no") == F.col("_s.step_no")) & (F.col("action_no") == F.col("_s.action_no")))
        .filter(F.col("pipeline_id").isNotNull())
        .select(*pipeline, "workflow_name", "job_name", "job_number", "step_no", "action_no", "step_log")
    )


# -- pair records ------------------------------------------------------------

def github_pairs(
    failures: DataFrame,
    logs: DataFrame,
    fixes: DataFrame,
    diffs: DataFrame,
    bots_only: bool = False,
    per_repo: int | None = None,
) -> DataFrame:
    """Records of failed runs with a usable log.

    ``logs`` (repo, run_id, ci_log); ``fixes`` (repo, run_id, fix_sha);
    ``diffs`` (repo, failing_sha, fix_sha, diff). With ``per_repo`` only the
    newest failures of a repository are taken, before their logs are looked at.
    """
    runs = bot_runs(failures) if bots_only else failures
    runs = first_per_group(
        runs, ["repo"], [F.col("created_at").desc(), F.col("run_id").desc()], per_repo
    ).filter(text_or_empty(F.col("failing_sha")) != "")
    usable = logs.filter(F.length("ci_log") >= MIN_LOG_CHARS)
    return (
        runs.join(usable, ["repo", "run_id"])
        .join(fixes, ["repo", "run_id"], "left")
        .join(diffs, ["repo", "failing_sha", "fix_sha"], "left")
        .select(
            F.concat_ws("_", F.lit("github_actions"), slug(F.col("repo")), F.col("run_id")).alias("id"),
            F.lit("github_actions").alias("source"),
            "repo", "language",
            F.lit("github_actions").alias("ci_platform"),
            "run_id", "workflow_name", "failing_sha", "fix_sha", "ci_log",
            F.when(F.col("fix_sha").isNotNull(), text_or_empty(F.col("diff"))).alias("fix_diff"),
            F.col("fix_sha").isNotNull().alias("has_fix"),
            F.lit(bots_only).alias("dep_drift_mode"),
        )
    )


def history_pairs(
    chains: DataFrame,
    diffs: DataFrame,
    logs: DataFrame | None = None,
    env_mode: bool = False,
    per_repo: int | None = None,
) -> DataFrame:
    """Records of adjacent red/green runs that have a diff.

    ``logs`` (repo, run_id, ci_log) adds the log of the failed run where known.
    """
    pairs = (
        chains_capped(chains, per_repo)
        .filter((text_or_empty(F.col("failing_sha")) != "") & (text_or_empty(F.col("fix_sha")) != ""))
        .join(diffs.filter(text_or_empty(F.col("diff")) != ""), ["repo", "failing_sha", "fix_sha"])
        .withColumnRenamed("diff", "fix_diff")
    )
    if env_mode:
        pairs = env_diff_filter(pairs)
    log: Column = F.lit(None).cast("string")
    if logs is not None:
        pairs = pairs.join(
            logs.select("repo", F.col("run_id").alias("failed_run_id"), F.col("ci_log")),
            ["repo", "failed_run_id"], "left",
        )
        log = F.col("ci_log")
    return pairs.select(
        F.concat_ws("_", F.lit("ci_history"), slug(F.col("repo")), F.col("failed_run_id")).alias("id"),
        F.lit("ci_history").alias("source"),
        "repo",
        (F.col("language") if "language" in pairs.columns else F.lit("unknown")).alias("language"),
        F.lit("github_actions").alias("ci_platform"),
        "workflow_name", "failing_sha", "fix_sha", "failed_run_id", "fix_run_id",
        log.alias("ci_log"),
        "fix_diff",
        F.lit(True).alias("has_fix"),
        F.lit(env_mode).alias("env_mode"),
    )


def first_failed_job(jobs: DataFrame, red: DataFrame, key: str, state: str, failed: list[str], log: str) -> DataFrame:
    """The first failed job of each red run, where it has a log.

    The job is chosen by its number among jobs of red runs; logs of other jobs
    are not moved.
    """
    broken = jobs.filter(F.col(state).isin(failed))
    chosen = (
        broken.select(key, "job_no").join(red.select(key), key, "left_semi")
        .groupBy(key).agg(F.min("job_no").alias("job_no"))
    )
    return broken.join(chosen, [key, "job_no"]).filter(text_or_empty(F.col(log)) != "")


def gitlab_pairs(
    pipelines: DataFrame, jobs: DataFrame, projects: DataFrame, min_stars: int = MIN_STARS
) -> DataFrame:
    """Records of failed pipelines: first failed job, its error context, the fix.

    ``jobs`` (pipeline_id, job_no, name, stage, status, trace).
    """
    liked = projects.filter(F.col("star_count") >= min_stars)
    red = pipelines.filter(F.col("status").isin(GITLAB_FAILED)).join(liked, "project_path")
    job = first_failed_job(jobs, red, "pipeline_id", "status", GITLAB_FAILED, "trace").select(
        "pipeline_id", F.struct("name", "stage", "trace").alias("job")
    )
    return (
        green_pipeline_fix(red, pipelines)
        .join(job, "pipeline_id")
        .select(
            F.lit("gitlab_ci").alias("platform"),
            "project_path",
            text_or_empty(F.col("project_url")).alias("project_url"),
            "pipeline_id",
            F.col("sha").alias("failed_sha"),
            F.col("ref").alias("branch"),
            F.col("job.name").alias("failed_job_name"),
            F.col("job.stage").alias("failed_stage"),
            error_context(F.col("job.trace"), GITLAB).alias("failure_log"),
            "fix_pipeline",
            F.col("fix_pipeline").isNotNull().alias("has_fix"),
            F.coalesce(F.nullif("predominant_language", F.lit("")), F.lit("unknown")).alias("language"),
            F.col("star_count").alias("project_stars"),
            "created_at",
        )
    )


def travis_pairs(
    builds: DataFrame, jobs: DataFrame, sha_chars: int | None = None, message_chars: int | None = None
) -> DataFrame:
    """Records of failed builds: first failed job, its error context, the fix.

    ``jobs`` (build_id, job_no, stage, state, log).
    """
    red = builds.filter(F.col("state").isin(TRAVIS_FAILED))
    job = first_failed_job(jobs, red, "build_id", "state", TRAVIS_FAILED, "log").select(
        "build_id", F.struct("stage", "log").alias("job")
    )
    return (
        passing_build_fix(builds, sha_chars=sha_chars, message_chars=message_chars)
        .join(job, "build_id")
        .select(
            F.lit("travis_ci").alias("platform"),
            "repo_slug", "build_number", "build_id", "branch",
            F.coalesce("language", F.lit("unknown")).alias("language"),
            F.coalesce("job.stage", F.lit("test")).alias("failed_job_name"),
            cut(F.col("commit_sha"), sha_chars).alias("failed_sha"),
            cut(text_or_empty(F.col("commit_message")), message_chars).alias("commit_message"),
            error_context(F.col("job.log"), TRAVIS).alias("failure_log"),
            "fix_build",
            F.col("fix_build").isNotNull().alias("has_fix"),
            F.coalesce("os", F.lit("linux")).alias("os"),
            F.coalesce("dist", F.lit("")).alias("dist"),
            "started_at",
        )
    )


def circleci_pairs(
    pipelines: DataFrame,
    workflows: DataFrame,
    jobs: DataFrame,
    actions: DataFrame,
    commits: DataFrame,
    files: DataFrame,
    log_chars: int | None = None,
) -> DataFrame:
    """Records of pipelines with a failed step: its error context and the next commit.

    ``pipelines`` (pipeline_id, project_slug, repo, repo_url, branch, state,
    failed_sha, created_at).
    """
    red = pipelines.filter(F.col("state").isin(CIRCLECI_PIPELINE_STATES))
    # A table, since its shas are looked up ahead of the join with what was found.
    failed = durable(
        red.join(first_failed_step(workflows, jobs, actions), ["project_slug", "pipeline_id"])
        .withColumn("failure_log", error_context(F.col("step_log"), CIRCLECI))
        .filter(F.col("failure_log") != "")
        .drop("step_log")
    )
    return next_commit_fix(failed, commits, files).select(
        F.lit("circleci").alias("platform"),
        "project_slug", "repo_url", "pipeline_id", "workflow_name",
        F.col("job_name").alias("failed_job_name"),
        "failed_sha", "branch",
        cut(F.col("failure_log"), log_chars).alias("failure_log"),
        "fix_commit",
        F.col("fix_commit").isNotNull().alias("has_fix"),
        "created_at",
    )


def pairs_per_repo(pairs: DataFrame, repo: str = "repo") -> DataFrame:
    """Pairs of each repository, and in total (null repository)."""
    return pairs.rollup(repo).agg(F.count(F.lit(1)).alias("n_pairs"))
