import random
import re

from pyspark.sql import functions as F

from buildmend.functions.text import changed_lines, list_repr, strip, tagged_block, words
from buildmend.operators import context, quality


def by_lines(log, rule):
    """Error context the plain way."""
    if rule.strip_ansi:
        log = re.sub(context.ANSI, "", log)
    lines = log.split("\n")
    errors = [i for i, line in enumerate(lines) if any(re.search(p, line, re.I) for p in rule.errors)]
    if not errors:
        tail = "\n".join(lines if rule.tail is None else lines[-rule.tail:])
        return tail[: rule.max_chars] if rule.cut_tail else tail
    near = {j for e in errors for j in range(e - rule.before, e + rule.after + 1) if 0 <= j < len(lines)}
    kept = [lines[i] for i in sorted(near)][: rule.max_lines]
    return "\n".join(kept)[: rule.max_chars]


def test_error_context_equals_plain_python(spark):
    rng = random.Random(7)
    words_ = ["ok", "\x1b[31mERROR:\x1b[0m bad", "FAIL x", "exit code 3", "npm ERR! y", "fatal: z", "long " * 200, "", "make[2]: *** Error 1", "The command a exited with 1"]
    logs = ["", "one line", "\n", "Error: x", "a\r\nERROR \r\nb\n"]
    for size in (5, 60, 150, 400):
        for weight in (0.0, 0.02, 0.3):
            logs.append("\n".join(rng.choice(words_) if rng.random() < weight else f"line {i}" for i in range(size)))
    logs.append("\n".join("x" * 200 for _ in range(90)))
    df = spark.createDataFrame([(i, log) for i, log in enumerate(logs)], "id int, ci_log string")
    whole = [context.GITLAB, context.TRAVIS, context.CIRCLECI]
    for rule in whole + [r._replace(tail=80, max_lines=100, max_chars=5000, cut_tail=r is context.CIRCLECI) for r in whole]:
        got = {r.id: r.failure_log for r in context.with_error_context(df, rule).collect()}
        assert got == {i: by_lines(log, rule) for i, log in enumerate(logs)}


def py_score(log, diff):
    score = 1.0
    if len(log) < 100:
        score -= 0.4
    if "error" not in log.lower() and "failed" not in log.lower():
        score -= 0.3
    if len(diff) < 20:
        score -= 0.4
    if "---" not in diff or "+++" not in diff:
        score -= 0.2
    n = py_changed(diff)
    if n > 100:
        score -= 0.3
    if n == 0:
        score -= 0.5
    return max(score, 0.0)


def py_changed(diff):
    return sum(1 for s in diff.split("\n") if s[:1] in ("+", "-") and s[:3] not in ("+++", "---"))


DIFFS = ["", "--- a\n+++ b\n-x\n+y\n", "+a\r-b\n+", "-\n+\n--\n++\n---\n+++", "--- a\n+++ b\n" + "+x\n" * 101, " -no\n+yes with text long enough"]


def test_quality_and_changed_lines(spark):
    logs = ["", "short error", "x" * 99, "x" * 100, "FAILED" + "y" * 100]
    rows = [(log, diff) for log in logs for diff in DIFFS]
    df = spark.createDataFrame(rows, "ci_log string, fix_diff string")
    got = quality.with_quality(df).withColumn("n", changed_lines(F.col("fix_diff"))).collect()
    assert [(r.quality_score, r.n) for r in got] == [(py_score(a, b), py_changed(b)) for a, b in rows]


def test_stored_quality_stands_and_gate_defaults(spark):
    rows = [(None, "ENV", True, 0.9), (0.65, "ENV", True, 0.6), (0.65, "ENV", True, 0.59), (0.9, None, True, 0.9), (0.9, "ENV", False, 0.9)]
    df = spark.createDataFrame(rows, "classification_confidence double, failure_class string, has_fix boolean, quality_score double")
    full = quality.with_quality(df.withColumns({"ci_log": F.lit(""), "fix_diff": F.lit("")}))
    assert [r.quality_score for r in full.collect()] == [0.9, 0.6, 0.59, 0.9, 0.9]
    assert quality.quality_gate(full).count() == 1
    assert quality.quality_gate(full, min_confidence=0.5).count() == 2


def test_text_functions(spark):
    df = spark.createDataFrame([("  a b C \x1c\n",)], "t string")
    row = df.select(strip(F.col("t")).alias("s"), words(F.col("t")).alias("w")).first()
    assert (row.s, row.w) == ("a b C", ["a", "b", "c"])
    text = "<fix>\n a\nb </fix> <fix>later</fix>"
    one = spark.createDataFrame([(text,)], "t string").select(tagged_block(F.col("t"), "fix"), tagged_block(F.col("t"), "none")).first()
    assert tuple(one) == ("a\nb", "")
    items = ["plain", "it's", 'say "x"', "both ' and \"", "back\\slash", "tab\t"]
    shown = spark.createDataFrame([(items,)], "l array<string>").select(list_repr(F.col("l"))).first()[0]
    assert shown == str(items)
