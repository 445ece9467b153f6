"""Deterministic mutation of failure logs.

Each strategy rewrites one place of a log. Which place and which new value is
picked by a hash of the log and the strategy's number, so the same record
always gives the same variants, on any number of partitions.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buildmend.functions.text import any_case, let, same_case, text_or_empty

# Versions, images, suffixes, bumps and patterns.
PYTHON_VERSIONS = ["3.8", "3.8.18", "3.9", "3.9.18", "3.10", "3.10.13", "3.11", "3.11.7", "3.12", "3.12.1"]
NODE_VERSIONS = ["16", "16.20.2", "18", "18.19.0", "20", "20.10.0", "21", "21.5.0"]
RUNNERS = ["ubuntu-20.04", "ubuntu-22.04", "ubuntu-latest", "ubuntu:20.04", "ubuntu:22.04"]
PYTHON_IMAGES = [
    "python:3.9-slim", "python:3.10-slim", "python:3.11-slim",
    "python:3.9-alpine", "python:3.10-alpine", "python:3.11-alpine",
    "python:3.9-bullseye", "python:3.10-bullseye", "python:3.11-bookworm",
]
NODE_IMAGES = [
    "node:16-slim", "node:18-slim", "node:20-slim",
    "node:16-alpine", "node:18-alpine", "node:20-alpine",
    "node:16-bullseye", "node:18-bullseye",
]
NAME_SUFFIXES = ["_V2", "_NEW", "_2024", "_PROD", "_UPDATED"]
VERSION_BUMPS = ["minor_bump", "patch_bump", "major_constraint"]
PYTHON_VERSION = r"python(\s+|\-|:)([23]\.\d+(?:\.\d+)?)"
NODE_VERSION = r"node(\s+|\-|:)(v?1[46-9]|2[01])\.\d+(?:\.\d+)?"
RUNNER = r"ubuntu-(\d+\.\d+|latest)"
IMAGE = r"FROM\s+(python|node):([^\s\n]+)"
SECRET_NAME = r"\$\{\{?\s*secrets\.(\w+)\s*\}\}?|\$(\w+_KEY|\w+_TOKEN|\w+_SECRET)"
PACKAGE_VERSION = r"[=<>^~\s:]+(\d+)\.(\d+)\.(\d+)"
RUNNER_PREFIX = "ubuntu-"
PYTHON_CHANGED = "Python version changed from "
NODE_CHANGED = "Node.js version changed from "
RUNNER_CHANGED = "Runner changed from "
IMAGE_CHANGED = "Docker base image changed from "
SECRET_RENAMED = "Environment variable renamed from "
PACKAGE_CHANGED = " version changed from "
TO = " to "


def draw(log: Column, index: int, turn: int, n: Column) -> Column:
    """A number in [0, n) fixed by the log, the strategy's number and the turn."""
    seed = F.sha2(F.concat(F.sha2(log, 256), F.lit(f":{index}:{turn}")), 256)
    return F.conv(F.left(seed, F.lit(8)), 16, 10).cast("bigint") % n


def pick(options: Column, log: Column, index: int, turn: int) -> Column:
    return F.get(options, draw(log, index, turn, F.size(options)).cast("int"))


def texts(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def all_groups(log: Column, pattern: str, groups: list[int]) -> Column:
    """Per match of ``pattern`` a struct g0, g1, ... of the groups asked for."""
    found = [F.regexp_extract_all(log, F.lit(pattern), g).alias(f"g{g}") for g in groups]
    return F.arrays_zip(*found)


def length_before(log: Column, pattern: str, matches: Column, k: Column) -> Column:
    """Characters in front of match number ``k`` (from 0)."""
    earlier = F.aggregate(
        F.slice(matches, F.lit(1), k), F.lit(0), lambda n, m: n + F.length(m["g0"])
    )
    between = F.aggregate(
        F.slice(F.split(log, pattern, -1), F.lit(1), k + 1), F.lit(0), lambda n, s: n + F.length(s)
    )
    return earlier + between


def spliced(log: Column, start: Column, width: Column, new: Column) -> Column:
    """``log`` with ``width`` characters behind ``start`` replaced by ``new``."""
    return F.concat(F.left(log, start), new, F.substr(log, start + width + 1))


def swap_first(log: Column, old: Column, new: Column) -> Column:
    """Replace the first literal occurrence, if there is one."""
    at = F.instr(log, old)
    return F.when(at > 0, spliced(log, at - 1, F.length(old), new)).otherwise(log)


def outcome(text: Column, description: Column) -> Column:
    return F.struct(text.alias("ci_log"), description.alias("mutation_description"))


def python_version(log: Column, index: int) -> Column:
    rx = any_case(PYTHON_VERSION)

    def rewrite(found: Column) -> Column:
        def at(k: Column) -> Column:
            m = F.get(found, k)
            old = m["g2"]
            new = pick(F.filter(texts(PYTHON_VERSIONS), lambda v: v != old), log, index, 1)
            start = length_before(log, rx, found, k) + F.length(m["g0"]) - F.length(old)
            return outcome(
                spliced(log, start, F.length(old), new),
                F.concat(F.lit(PYTHON_CHANGED), old, F.lit(TO), new),
            )

        return F.when(F.size(found) > 0, let(draw(log, index, 0, F.size(found)).cast("int"), at))

    return let(all_groups(log, rx, [0, 2]), rewrite)


def node_version(log: Column, index: int) -> Column:
    rx = any_case(NODE_VERSION)

    def rewrite(found: Column) -> Column:
        def at(k: Column) -> Column:
            m = F.get(found, k)
            old = m["g2"]
            new = pick(F.filter(texts(NODE_VERSIONS), lambda v: ~v.startswith(old)), log, index, 1)
            start = length_before(log, rx, found, k) + F.lit(len("node")) + F.length(m["g1"])
            return outcome(
                spliced(log, start, F.length(old), new),
                F.concat(F.lit(NODE_CHANGED), old, F.lit(TO), new),
            )

        return F.when(F.size(found) > 0, let(draw(log, index, 0, F.size(found)).cast("int"), at))

    return let(all_groups(log, rx, [0, 1, 2]), rewrite)


def runner_version(log: Column, index: int) -> Column:
    rx = any_case(RUNNER)

    def rewrite(found: Column) -> Column:
        old = F.concat(F.lit(RUNNER_PREFIX), pick(found, log, index, 0))

        def renamed(old: Column) -> Column:
            new = pick(F.filter(texts(RUNNERS), lambda r: r != old), log, index, 1)
            return outcome(
                swap_first(log, old, new),
                F.concat(F.lit(RUNNER_CHANGED), old, F.lit(TO), new),
            )

        return F.when(F.size(found) > 0, let(old, renamed))

    return let(F.regexp_extract_all(log, F.lit(rx), 1), rewrite)


def docker_image(log: Column, index: int) -> Column:
    rx = any_case(IMAGE)
    kind, tag = F.regexp_extract(log, rx, 1), F.regexp_extract(log, rx, 2)
    whole = F.regexp_extract(log, rx, 0)
    old = F.concat(kind, F.lit(":"), tag)

    def renamed(new: Column) -> Column:
        start = F.length(F.get(F.split(log, rx, 2), F.lit(0))) + F.length(whole) - F.length(old)
        return F.when(
            new != old,
            outcome(
                spliced(log, start, F.length(old), new),
                F.concat(F.lit(IMAGE_CHANGED), old, F.lit(TO), new),
            ),
        )

    options = F.when(F.lower(kind) == "python", texts(PYTHON_IMAGES)).otherwise(texts(NODE_IMAGES))
    return F.when(log.rlike(rx), let(pick(options, log, index, 0), renamed))


def env_var(log: Column, index: int) -> Column:
    rx = same_case(SECRET_NAME)

    def rewrite(found: Column) -> Column:
        def renamed(old: Column) -> Column:
            new = F.concat(old, pick(texts(NAME_SUFFIXES), log, index, 1))
            return outcome(
                swap_first(log, old, new),
                F.concat(F.lit(SECRET_RENAMED), old, F.lit(TO), new),
            )

        m = F.get(found, draw(log, index, 0, F.size(found)).cast("int"))
        name = F.when(text_or_empty(m["g1"]) != "", m["g1"]).otherwise(m["g2"])
        return F.when(F.size(found) > 0, let(name, renamed))

    return let(all_groups(log, rx, [1, 2]), rewrite)


def package_version(package: str) -> Callable[[Column, int], Column]:
    """Strategy that bumps the version of one named package."""
    rx = any_case(r"\Q" + package + r"\E" + PACKAGE_VERSION)

    def strategy(log: Column, index: int) -> Column:
        parts = [F.regexp_extract(log, rx, g) for g in (1, 2, 3)]
        major, minor, patch = [p.try_cast("decimal(38,0)") for p in parts]
        kind = pick(texts(VERSION_BUMPS), log, index, 0)
        dot = F.lit(".")
        new = (
            F.when(
                kind == "patch_bump",
                F.concat(major, dot, minor, dot, patch + 1 + draw(log, index, 1, F.lit(5))),
            )
            .when(
                kind == "minor_bump",
                F.concat(major, dot, minor + 1 + draw(log, index, 1, F.lit(3)), F.lit(".0")),
            )
            .otherwise(F.concat(major + 1, F.lit(".0.0")))
        )
        written = sum((F.length(p) for p in parts), F.lit(2))
        start = (
            F.length(F.get(F.split(log, rx, 2), F.lit(0)))
            + F.length(F.regexp_extract(log, rx, 0)) - written
        )
        described = F.concat(
            F.lit(package + PACKAGE_CHANGED), major, dot, minor, dot, patch, F.lit(TO), new
        )
        return F.when(
            log.rlike(rx) & described.isNotNull(), outcome(spliced(log, start, written, new), described)
        )

    return strategy


class Strategy(NamedTuple):
    name: str
    rewrite: Callable[[Column, int], Column]
    needs: str = ""  # a lower-case word without which the strategy never applies


STRATEGIES = [
    Strategy("python_version", python_version, "python"),
    Strategy("node_version", node_version, "node"),
    Strategy("runner_version", runner_version, RUNNER_PREFIX),
    Strategy("docker_image", docker_image, "from"),
    Strategy("env_var", env_var, "$"),
]

RECORD_KEYS = ["pipeline_id", "build_id", "pr_number"]


def mutate(
    df: DataFrame,
    strategies: list[Strategy] | None = None,
    per_record: int | None = None,
    names: list[str] | None = None,
    log: str = "ci_log",
) -> DataFrame:
    """Variants of each record: all strategies that apply, or the first ``per_record``.

    The fix stays the same; the provenance of a variant is added to it.
    """
    chosen = [s for s in strategies or STRATEGIES if names is None or s.name in names]
    text = F.col(log)

    def attempt(index: int, strategy: Strategy) -> Column:
        def changed(r: Column) -> Column:
            variant = F.struct(
                r["ci_log"].alias("ci_log"),
                F.lit(strategy.name).alias("mutation_strategy"),
                r["mutation_description"].alias("mutation_description"),
                F.lit(index).alias("mutation_index"),
            )
            return F.when(r.isNotNull() & (r["ci_log"] != text), variant)

        result = strategy.rewrite(text, index)
        # The needed word settles most logs without running the pattern.
        return let(F.when(F.lower(text).contains(strategy.needs), result), changed)

    tries = [attempt(index, strategy) for index, strategy in enumerate(chosen)]
    applied = F.filter(F.array(*tries), lambda t: t.isNotNull())
    if per_record is not None:
        applied = F.slice(applied, 1, per_record)
    own_key = [
        F.nullif(F.nullif(F.col(k).cast("string"), F.lit("")), F.lit("0"))
        for k in RECORD_KEYS
        if k in df.columns
    ]
    by_text = F.sha2(text, 256)  # of the whole log: logs of one workflow begin alike
    kept = [c for c in df.columns if c != log]
    return (
        df.filter(text_or_empty(text) != "")
        .withColumn("_m", F.explode(applied))
        .select(
            *kept,
            F.col("_m.ci_log").alias(log),
            F.lit(True).alias("is_synthetic"),
            "_m.mutation_strategy",
            "_m.mutation_description",
            F.coalesce(*own_key, by_text).alias("original_record_id"),
            "_m.mutation_index",
        )
    )
