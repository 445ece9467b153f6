"""Cheap tests that rule a pattern out before it runs.

A pattern without case can only match a text that holds the literal words of
one of its branches. Looking for words in a lower-cased text is many times
faster than running the pattern, and most logs miss most patterns.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters beyond ASCII that equal an ASCII letter when case is ignored but
# do not become it in lower case.
ODD_LETTERS = ["ſ", "ı", "İ"]


def words_of(branch: str) -> list[str]:
    """The literal runs of a pattern without groups, in lower case."""
    runs, run = [], ""
    for token in re.findall(r"\\.|\[[^\]]*\]|\{\d+\}|.", branch):
        if len(token) == 2 and not token[1].isalnum():
            run += token[1]
        elif len(token) == 1 and token not in ".*+?":
            run += token
        else:
            if token in ("*", "?"):
                run = run[:-1]
            runs.append(run)
            run = ""
    return [r.lower() for r in runs + [run] if len(r) > 1]


def branches(pattern: str) -> list[list[str]]:
    """Words of each branch of ``(a|b|c)rest``, or of a pattern without groups."""
    if not pattern.startswith("("):
        if "(" in pattern.replace(r"\(", ""):
            raise ValueError(f"groups are only understood in front: {pattern}")
        return [words_of(pattern)]
    inside, rest = pattern[1:].split(")", 1)
    if "(" in inside or "(" in rest:
        raise ValueError(f"only one group is understood: {pattern}")
    return [words_of(branch) + words_of(rest) for branch in inside.split("|")]


def has_odd_letters(lowered: Column) -> Column:
    return reduce(lambda a, b: a | b, [lowered.contains(letter.lower()) for letter in ODD_LETTERS])


def may_match(lowered: Column, patterns: list[str], odd: Column | None = None) -> Column:
    """False only if none of the caseless ``patterns`` can match the text
    whose lower-cased form is given.

    ``odd`` is `has_odd_letters` of that text, for a caller that asks often.
    """

    def all_there(words: list[str]) -> Column:
        # Long words are rare: they settle most texts at the first look.
        ordered = sorted(set(words), key=lambda w: (-len(w), w))
        return reduce(lambda a, b: a & b, [lowered.contains(w) for w in ordered], F.lit(True))

    options = [all_there(words) for pattern in patterns for words in branches(pattern)]
    return reduce(lambda a, b: a | b, options, has_odd_letters(lowered) if odd is None else odd)
