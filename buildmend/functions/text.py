"""Text functions as Spark column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as Unicode defines it, plus the four ASCII separators. Written out,
# since a listed class is much faster than a Unicode property.
BLANK = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


#: The same characters one by one.
BLANKS = "".join(
    [*map(chr, range(0x09, 0x0E)), *map(chr, range(0x1C, 0x21)), "\x85", "\xa0", "\u1680"]
    + [*map(chr, range(0x2000, 0x200B)), "\u2028", "\u2029", "\u202f", "\u205f", "\u3000"]
)


def any_case(pattern: str) -> str:
    """Unicode-wide case-insensitive form of ``pattern`` in which only a line
    feed ends a line (the other terminators belong to the log text)."""
    return "(?idU)" + pattern


def same_case(pattern: str) -> str:
    """As `any_case`, but case matters."""
    return "(?dU)" + pattern


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it many times in ``body``.

    Inside a lambda Spark re-evaluates a captured expression per element;
    binding it as a lambda variable keeps the work linear.
    """
    return F.transform(F.array(value), body).getItem(0)


def strip(col: Column) -> Column:
    """Remove leading and trailing whitespace of any kind."""
    return F.btrim(col, F.lit(BLANKS))


def text_or_empty(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def filled(col: Column) -> Column:
    """True for a present, non-empty string."""
    return text_or_empty(col) != ""


def any_contains(col: Column, needles: list[str]) -> Column:
    """True if ``col`` holds any of the literal ``needles``."""
    found = F.lit(False)
    for needle in needles:
        found = found | col.contains(needle)
    return found


def cut(col: Column, n: int | None) -> Column:
    """The first ``n`` characters; None keeps all."""
    return col if n is None else F.left(col, F.lit(n))


def slug(repo: Column) -> Column:
    return F.replace(repo, F.lit("/"), F.lit("__"))


def tagged_block(col: Column, tag: str) -> Column:
    """Stripped text of the first ``<tag>...</tag>`` block, empty if none."""
    text, start, end = text_or_empty(col), f"<{tag}>", f"</{tag}>"
    # No pattern steps through the text: both marks are looked up whole.
    at = F.instr(text, start)
    rest = F.when(at > 0, F.substr(text, at + len(start))).otherwise("")
    return F.when(rest.contains(end), strip(F.substring_index(rest, end, 1))).otherwise("")


def changed_lines(diff: Column) -> Column:
    """Added and removed lines of a unified diff, file headers left out."""
    return F.regexp_count(text_or_empty(diff), F.lit(r"(?dm)^(?:\+(?!\+\+)|-(?!--))"))


def words(col: Column) -> Column:
    """Lower-cased whitespace-separated words."""
    return F.array_remove(F.split(F.lower(col), f"{BLANK}+"), "")


def list_repr(items: Column) -> Column:
    """A list of strings written as ``['a', "b's"]``."""

    def quoted(s: Column) -> Column:
        s = F.replace(s, F.lit("\\"), F.lit("\\\\"))
        s = F.replace(s, F.lit("\r"), F.lit("\\r"))
        s = F.replace(s, F.lit("\t"), F.lit("\\t"))
        double = s.contains("'") & ~s.contains('"')
        return F.when(double, F.concat(F.lit('"'), s, F.lit('"'))).otherwise(
            F.concat(F.lit("'"), F.replace(s, F.lit("'"), F.lit("\\'")), F.lit("'"))
        )

    return F.concat(F.lit("["), F.array_join(F.transform(items, quoted), ", "), F.lit("]"))
