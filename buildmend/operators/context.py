"""Error context: the lines of a log around its error lines.

The work stays inside the row. A log of n lines costs n pattern tests and n
looks at a window of flags, and no line is ever shuffled.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buildmend.functions.prefilter import may_match
from buildmend.functions.text import any_case, cut, let

# Escape sequences, error patterns and sizes per platform.
ANSI = r"\x1B(?:[@-Z\\-_]|\[[0-?]*[ -/]*[@-~])"

GITLAB_ERRORS = [
    r"(ERROR|FAILED|Error|error:)\s+.*",
    r"(Job failed|Build failed|Pipeline failed)",
    r"exit status \d+",
    r"make\[\d+\].*Error \d+",
    r"fatal:.*",
    r"FAIL\s+",
]

TRAVIS_ERRORS = [
    r"(The command .+ exited with \d+)",
    r"(FAILED|ERROR|error:)\s+",
    r"Build failed",
    r"bundler: failed",
    r"rake aborted!",
    r"npm ERR!",
    r"Test failed",
]

CIRCLECI_ERRORS = [
    r"(Error|Exception|FAILED|FAILURE|error:).*",
    r"(npm ERR!|yarn error|pip.*error).*",
    r"exit code \d+",
]


class ContextRule(NamedTuple):
    errors: list[str]
    before: int  # lines kept ahead of an error line
    after: int  # lines kept behind it
    strip_ansi: bool
    # Budgets, off by default: lines of a log without error lines, lines of a
    # context, characters of a context, whether characters count without errors.
    tail: int | None = None
    max_lines: int | None = None
    max_chars: int | None = None
    cut_tail: bool = False


GITLAB = ContextRule(GITLAB_ERRORS, 3, 19, True)
TRAVIS = ContextRule(TRAVIS_ERRORS, 5, 24, True)
CIRCLECI = ContextRule(CIRCLECI_ERRORS, 3, 19, False)


def error_context(log: Column, rule: ContextRule) -> Column:
    if rule.strip_ansi:
        log = F.when(log.contains("\x1b"), F.regexp_replace(log, ANSI, "")).otherwise(log)
    is_error = any_case("|".join(f"(?:{e})" for e in rule.errors))

    def around(lines: Column) -> Column:
        def flag(line: Column) -> Column:
            return may_match(F.lower(line), rule.errors) & line.rlike(is_error)

        return let(F.transform(lines, flag), lambda flags: pick(lines, flags))

    def pick(lines: Column, flags: Column) -> Column:
        def near_error(_line: Column, i: Column) -> Column:
            first = F.greatest(i - rule.after, F.lit(0))
            return F.array_contains(F.slice(flags, first + 1, i + rule.before - first + 1), True)

        kept = F.filter(lines, near_error)
        if rule.max_lines is not None:
            kept = F.slice(kept, 1, rule.max_lines)
        rest = lines if rule.tail is None else F.slice(
            lines, F.greatest(F.size(lines) - rule.tail, F.lit(0)) + 1, F.lit(rule.tail)
        )
        tail = cut(F.array_join(rest, "\n"), rule.max_chars if rule.cut_tail else None)
        return F.when(F.array_contains(flags, True), cut(F.array_join(kept, "\n"), rule.max_chars)).otherwise(tail)

    return let(F.split(log, "\n"), around)


def with_error_context(
    df: DataFrame, rule: ContextRule, log: str = "ci_log", into: str = "failure_log"
) -> DataFrame:
    return df.withColumn(into, error_context(F.col(log), rule))
