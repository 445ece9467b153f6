"""Dependency-bump pull requests: titles, ecosystems, files and check results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buildmend.functions.text import any_case, any_contains, cut, strip, text_or_empty
from buildmend.operators.ordered import first_per_group

# Title patterns (first match wins), ecosystem indicators (in
# order), words of titles and bodies, bot logins.
BUMP_TITLES = [
    r"Bump (.+?) from ([\d.]+) to ([\d.]+)",
    r"Update (.+?) requirement from ([\d.>=<^~]+) to ([\d.>=<^~]+)",
    r"chore\(deps\): bump (.+?) from ([\d.]+) to ([\d.]+)",
    r"chore\(deps-dev\): bump (.+?) from ([\d.]+) to ([\d.]+)",
    r"Update (.+?) to ([\d.]+)",
    r"Upgrade (.+?) from ([\d.]+) to ([\d.]+)",
]
TWO_PART_TITLES = {4}

ECOSYSTEMS = {
    "npm": ["package.json", "package-lock.json", "yarn.lock", "node_modules"],
    "pip": ["requirements.txt", "Pipfile", "Pipfile.lock", "setup.py", "pyproject.toml"],
    "maven": ["pom.xml", "build.gradle", "build.gradle.kts"],
    "cargo": ["Cargo.toml", "Cargo.lock"],
    "bundler": ["Gemfile", "Gemfile.lock"],
    "go": ["go.mod", "go.sum"],
    "composer": ["composer.json", "composer.lock"],
    "nuget": [".csproj", "packages.config", "*.nuspec"],
}

BOT_LOGINS = ["dependabot[bot]", "dependabot-preview[bot]", "renovate[bot]", "renovate"]
# Ecosystem, words of a body and words of a title that hint at it, in order.
ECOSYSTEM_WORDS = [
    ("npm", ["package.json"], ["npm"]),
    ("pip", ["requirements"], ["pip", "python"]),
    ("cargo", ["cargo.toml"], ["rust"]),
    ("bundler", ["gemfile"], ["ruby"]),
    ("go", ["go.mod"], []),
]


def parse_bump(title: Column) -> Column:
    """Package and versions named by a bump title, null for other titles."""
    parsed = F.lit(None)
    for i, pattern in reversed(list(enumerate(BUMP_TITLES))):
        rx = any_case(pattern)
        part = [F.regexp_extract(title, rx, g) for g in (1, 2)]
        if i in TWO_PART_TITLES:
            from_version, to_version = F.lit(None).cast("string"), part[1]
        else:
            from_version, to_version = part[1], F.regexp_extract(title, rx, 3)
        found = F.struct(
            strip(part[0]).alias("package"),
            from_version.alias("from_version"),
            to_version.alias("to_version"),
        )
        parsed = F.when(title.rlike(rx), found).otherwise(parsed)
    return parsed


def dep_bump_parse(prs: DataFrame, title: str = "title") -> DataFrame:
    return prs.withColumn("bump_info", parse_bump(F.col(title)))


def is_dep_file(filename: Column, strict: bool = True) -> Column:
    """Whether a changed file belongs to a package manager.

    The name is lower-cased while the indicators are not, so indicators with
    capitals never match; ``strict=False`` lower-cases both sides.
    """
    indicators = [ind for inds in ECOSYSTEMS.values() for ind in inds]
    if not strict:
        indicators = [ind.lower() for ind in indicators]
    return any_contains(F.lower(filename), indicators)


def dep_file_filter(files: DataFrame, strict: bool = True) -> DataFrame:
    return files.filter(is_dep_file(F.col("filename"), strict))


def detect_ecosystem(title: Column, labels: Column, filenames: Column, body: Column) -> Column:
    """Ecosystem by label, else by changed file, else by words of title and body."""
    title, body = F.lower(text_or_empty(title)), F.lower(text_or_empty(body))
    empty = F.array().cast("array<string>")

    def by_name(label: Column) -> Column:
        hit = F.lit(None).cast("string")
        for eco in reversed(ECOSYSTEMS):
            hit = F.when(F.lower(label).contains(eco), F.lit(eco)).otherwise(hit)
        return hit

    from_labels = F.get(
        F.filter(F.transform(F.coalesce(labels, empty), by_name), lambda e: e.isNotNull()), F.lit(0)
    )
    def any_named(indicators: list[str]) -> Column:
        return F.exists(F.coalesce(filenames, empty), lambda f: any_contains(f, indicators))

    from_files = F.lit(None).cast("string")
    for eco, indicators in reversed(ECOSYSTEMS.items()):
        from_files = F.when(any_named(indicators), F.lit(eco)).otherwise(from_files)
    from_words = F.lit(None).cast("string")
    for eco, in_body, in_title in reversed(ECOSYSTEM_WORDS):
        from_words = F.when(any_contains(body, in_body) | any_contains(title, in_title), F.lit(eco)).otherwise(from_words)
    return F.coalesce(from_labels, from_files, from_words, F.lit("unknown"))


def rolled_checks(
    prs: DataFrame, checks: DataFrame, key: list[str], listed: bool = True, n: int | None = None
) -> DataFrame:
    """Overall check result and list of checks of each pull request, also of those without checks.

    Checks of other pull requests are left out first; counts and list come
    from one aggregation. ``n`` keeps the first checks of each list.
    """
    wanted = prs.select(*key).distinct()
    totals = [
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("conclusion") == "success").alias("passed"),
        F.count_if(F.col("conclusion").isin("failure", "timed_out")).alias("failed"),
    ]
    if listed:
        in_order = F.array_sort(F.collect_list(F.struct("check_no", "name", "conclusion", "app")))
        totals.append(F.transform(
            in_order if n is None else F.slice(in_order, 1, n),
            lambda c: F.struct(c["name"].alias("name"), c["conclusion"].alias("conclusion"), c["app"].alias("app")),
        ).alias("checks"))
    counted = checks.join(wanted, key, "left_semi").groupBy(*key).agg(*totals)
    zero = F.lit(0).cast("bigint")
    joined = wanted.join(counted, key, "left").withColumns(
        {c: F.coalesce(c, zero) for c in ("total_checks", "passed", "failed")}
    )
    return joined.withColumn(
        "status",
        F.when(F.col("total_checks") == 0, "unknown")
        .when(F.col("failed") > 0, "failed")
        .when(F.col("passed") == F.col("total_checks"), "passed")
        .otherwise("partial"),
    )


def check_rollup(prs: DataFrame, checks: DataFrame, key: list[str]) -> DataFrame:
    """Overall check result of each pull request, also of those without checks."""
    return rolled_checks(prs, checks, key, listed=False)


def dep_pr_records(
    prs: DataFrame,
    files: DataFrame,
    checks: DataFrame,
    ecosystem: str | None = None,
    max_files: int | None = None,
    max_checks: int | None = None,
    patch_chars: int | None = None,
    body_chars: int | None = None,
) -> DataFrame:
    """Records of bot pull requests whose title is a dependency bump.

    ``prs`` (repo, pr_number, title, body, author, labels, html_url,
    created_at, merged_at, closed_at); ``files`` and ``checks`` carry the same
    (repo, pr_number) key.
    """
    key = ["repo", "pr_number"]
    bumps = (
        prs.filter(F.lower(text_or_empty(F.col("author"))).isin(BOT_LOGINS))
        .withColumn("bump_info", parse_bump(text_or_empty(F.col("title"))))
        .filter(F.col("bump_info").isNotNull())
    )
    # Files of other pull requests are left out ahead of any grouping.
    own = files.join(bumps.select(*key).distinct(), key, "left_semi")
    few = first_per_group(own, key, [F.col("file_no")], max_files)
    file = F.struct(
        "file_no", "filename", "status",
        F.coalesce("additions", F.lit(0)).alias("additions"),
        F.coalesce("deletions", F.lit(0)).alias("deletions"),
        cut(text_or_empty(F.col("patch")), patch_chars).alias("patch"),
    )
    changed = dep_file_filter(few).groupBy(*key).agg(
        F.transform(F.array_sort(F.collect_list(file)), lambda f: f.dropFields("file_no")).alias("changed_dep_files")
    )
    rolled = rolled_checks(bumps, checks, key, n=max_checks)
    kept = F.coalesce("changed_dep_files", F.array().cast(changed.schema["changed_dep_files"].dataType))
    records = (
        bumps.join(changed, key, "left")
        .join(rolled, key, "left")
        .withColumn("changed_dep_files", kept)
        .withColumn(
            "ecosystem",
            detect_ecosystem(
                F.col("title"), F.col("labels"),
                F.transform("changed_dep_files", lambda f: f["filename"]), F.col("body"),
            ),
        )
    )
    if ecosystem is not None:
        records = records.filter(F.col("ecosystem") == ecosystem)
    return records.select(
        F.lit("dependabot_pr").alias("type"),
        "repo",
        F.concat(F.lit("https://github.com/"), F.col("repo")).alias("repo_url"),
        "pr_number",
        F.col("html_url").alias("pr_url"),
        "title", "bump_info", "ecosystem",
        F.when(F.col("merged_at").isNotNull(), "merged")
        .when(F.col("closed_at").isNotNull(), "closed")
        .otherwise("open").alias("merge_status"),
        F.struct("status", "total_checks", "passed", "failed", "checks").alias("ci_result"),
        (F.col("status") == "passed").alias("ci_passed"),
        "changed_dep_files",
        F.size("changed_dep_files").alias("num_dep_files_changed"),
        cut(text_or_empty(F.col("body")), body_chars).alias("body_snippet"),
        "created_at", "merged_at", "labels",
        text_or_empty(F.col("author")).alias("author"),
    )
