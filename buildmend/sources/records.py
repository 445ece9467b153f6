"""One record schema for the pairs of all platforms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buildmend.functions.text import slug, text_or_empty

CANONICAL = {
    "id": "string",
    "source": "string",
    "repo": "string",
    "language": "string",
    "ci_platform": "string",
    "workflow_name": "string",
    "failing_sha": "string",
    "fix_sha": "string",
    "ci_log": "string",
    "fix_diff": "string",
    "has_fix": "boolean",
}

# Where the platforms keep what the canonical record holds.
FIELD_SOURCES = {
    "github_actions": {},
    "ci_history": {},
    "gitlab_ci": {
        "repo": "project_path", "failing_sha": "failed_sha", "workflow_name": "failed_job_name",
        "fix_sha": "fix_pipeline.sha",
    },
    "travis_ci": {
        "repo": "repo_slug", "failing_sha": "failed_sha", "workflow_name": "failed_job_name",
        "fix_sha": "fix_build.commit_sha",
    },
    "circleci": {
        "repo": "project_slug", "failing_sha": "failed_sha", "fix_sha": "fix_commit.sha",
    },
}
RUN_NUMBER = {"gitlab_ci": "pipeline_id", "travis_ci": "build_id", "circleci": "pipeline_id"}


def with_ci_log(df: DataFrame) -> DataFrame:
    """Keep the log under one name, whichever of the two a record uses."""
    names = [c for c in ("ci_log", "failure_log") if c in df.columns]
    log = F.coalesce(*[F.col(c) for c in names]) if names else F.lit(None).cast("string")
    return df.withColumn("ci_log", log).drop("failure_log")


def canonical(df: DataFrame, platform: str, use_commit_patch: bool = False) -> DataFrame:
    """The records of one platform in the canonical schema.

    ``use_commit_patch`` takes the patch text of a CircleCI fix commit as the
    diff; otherwise records of that platform carry none.
    """
    df = with_ci_log(df)
    fields = dict(FIELD_SOURCES[platform])
    if use_commit_patch and platform == "circleci":
        fields["fix_diff"] = "fix_commit.diff_patch"

    def value(name: str) -> Column:
        if name in ("source", "ci_platform"):
            own = F.col(name) if name in df.columns else F.lit(platform)
            return own
        if name == "id" and "id" not in df.columns:
            return F.concat_ws("_", F.lit(platform), slug(F.col(fields["repo"])), F.col(RUN_NUMBER[platform]))
        place = fields.get(name, name)
        return F.col(place) if place.split(".")[0] in df.columns else F.lit(None)

    return df.select(*[value(name).cast(kind).alias(name) for name, kind in CANONICAL.items()])


def normalize_records(sources: dict[str, DataFrame], use_commit_patch: bool = False) -> DataFrame:
    """All platforms' records as one bag."""
    parts = [canonical(df, platform, use_commit_patch) for platform, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def has_required(names: list[str]) -> Column:
    """All named fields are there; an empty text counts as there."""
    return reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])


def step_messages(step_log: Column) -> Column:
    """Lines of a step log: the messages of a JSON list, the text itself for
    any other JSON value, nothing for what is not JSON."""
    valid = F.try_parse_json(step_log).isNotNull()
    items = F.from_json(step_log, "array<struct<message:string>>")
    lines = F.array_join(F.transform(items, lambda m: text_or_empty(m["message"])), "\n")
    return F.when(~valid, "").when(F.ltrim(step_log).startswith("["), lines).otherwise(step_log)


def content_or_log(content: Column, log: Column) -> Column:
    """The content of a job log, else its log field, else nothing."""
    return F.coalesce(F.nullif(content, F.lit("")), F.nullif(log, F.lit("")), F.lit(""))
