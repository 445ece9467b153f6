import re

import pytest
from pyspark.sql import functions as F

from buildmend.functions import taxonomy as tax
from buildmend.functions.prefilter import branches, may_match
from buildmend.functions.text import any_case
from buildmend.operators import bench, classify


def py_signals(log):
    """The same scoring, one log at a time."""
    out = []
    for p in tax.PATTERNS:
        found = re.findall(p.regex, log, re.I)
        if found:
            conf = min(p.confidence + 0.05 * (len(found) - 1), 0.95)
            out.append((p.failure_class, p.failure_subclass, conf, f"Pattern '{p.regex}' matched {len(found)} times: {found}"))
    return sorted(out, key=lambda s: -s[2])


LOGS = [
    "ERROR: operation timed out\nconnection reset\nTIMEOUT again\ntimed out",
    "OOM in the room: no space left\nTypeError: unexpected keyword argument 'x'",
    "secret 'API' was not found; it's \"odd\"\ntable users doesn't exist",
    "race condition" + "\nconcurrent" * 20,
    "nothing to see",
    "",
    "poetry.lock is out of sync\r\nGemfile.lock\tout of sync\nflake8 gave an ERROR",
    "TİMEOUT and tımed out, tooLong, deadlocK, miſſing dist",
    "python 3.7 is not supported, requires python >=3.8\nCVE-2024-12345 CVE-2023-1",
    "setUp of x failed \\ fixtures\ttab",
]


@pytest.fixture(scope="module")
def logs(spark):
    return spark.createDataFrame([(i, log) for i, log in enumerate(LOGS)], "id bigint, ci_log string")


def test_signals_equal_plain_python(logs):
    rows = classify.heuristic_signals(logs).orderBy("id", "signal_rank").collect()
    for i, log in enumerate(LOGS):
        got = [(r.failure_class, r.failure_subclass, r.confidence, r.evidence) for r in rows if r.id == i]
        assert got == py_signals(log), log


def test_every_pattern_has_words_and_is_never_ruled_out_wrongly(spark):
    samples = {p.regex: log for p in tax.PATTERNS for log in LOGS if re.search(p.regex, log, re.I)}
    rows = [(rx, log) for rx, log in samples.items()]
    df = spark.createDataFrame(rows, "rx string, log string")
    for p in tax.PATTERNS:
        assert all(branches(p.regex)), p.regex
        if p.regex in samples:
            one = df.filter(F.col("rx") == p.regex)
            seen = one.select(may_match(F.lower("log"), [p.regex]).alias("m"), F.col("log").rlike(any_case(p.regex)).alias("r"))
            assert seen.first() == (True, True), p.regex


def test_built_in_cases(spark):
    top = classify.top_class(bench.built_in_cases(spark)).select("id", "heuristic_class", "heuristic_subclass", "heuristic_confidence")
    got = {r.id: (r.heuristic_class, r.heuristic_subclass[:2], r.heuristic_confidence) for r in top.collect()}
    assert got == {
        "dep_drift_001_psycopg3": ("LOGIC", "4c", 0.8),
        "flaky_001_async_race": ("FLAKY", "1a", 0.8),
        "env_001_ubuntu_pkg": ("ENV", "3c", 0.85),
        "logic_001_assertion": ("LOGIC", "4a", 0.6),
    }


def test_ties_are_exact_doubles(spark):
    # Two matches at 0.80 give 0.8500000000000001, which beats a base of 0.85.
    log = "conflicting dependencies, incompatible\nE: Unable to locate package x"
    df = spark.createDataFrame([(1, log)], "id int, ci_log string")
    assert classify.top_class(df).first().heuristic_class == "DEP_DRIFT"


def test_unknown_and_null_logs(spark):
    df = spark.createDataFrame([(1, "fine"), (2, None), (3, "")], "id int, ci_log string")
    for r in classify.top_class(df).collect():
        assert (r.heuristic_class, r.heuristic_subclass, r.heuristic_confidence) == ("UNKNOWN", None, 0.0)


def test_primary_and_secondary(spark):
    df = spark.createDataFrame([(1, "deadlock\nmypy\ntimed out\nmanifest unknown"), (2, "ok")], "id int, ci_log string")
    one, two = classify.primary_secondary(df).orderBy("id").collect()
    assert (one.primary_class, one.secondary_classes) == ("ENV", ["FLAKY", "LINT_FORMATTING"])
    assert (two.primary_class, two.primary_subclass, two.primary_confidence, two.secondary_classes) == ("UNKNOWN", None, 0.0, [])


def test_fix_strategy_covers_all_subclasses(spark):
    assert set(tax.FIX_STRATEGIES) == set(tax.SUBCLASSES)
    df = spark.createDataFrame([(s,) for s in tax.SUBCLASSES] + [("9z",), (None,)], "failure_subclass string")
    got = {r.failure_subclass: r.fix_strategy for r in classify.fix_strategy_lookup(df).collect()}
    assert got == {**tax.FIX_STRATEGIES, "9z": tax.DEFAULT_FIX, None: tax.DEFAULT_FIX}


def test_known_patterns(spark):
    rows = [
        (1, "EADDRINUSE: Address already in use", "Python"),
        (2, "EADDRINUSE", "rust"),
        (3, "EADDRINUSE", None),
        (4, "port 80 already in use", "python"),  # the pattern-like signature is literal
        (5, "timezone utcnow pydantic", "python"),
    ]
    df = spark.createDataFrame(rows, "id int, ci_log string, language string")
    got = [(r.id, r.name, r.signature_hits) for r in classify.known_pattern_match(df).orderBy("id", "match_rank").collect()]
    assert got == [
        (1, "port_already_in_use", 2), (3, "port_already_in_use", 1),
        (5, "datetime_timezone_flaky", 2), (5, "pydantic_v1_v2_migration", 1),
    ]


def test_resolve(spark):
    logs = spark.createDataFrame(
        [(1, ""), (2, "manifest unknown"), (3, "timed out"), (4, "timed out"), (5, "timed out"), (6, "fine")], "id int, ci_log string"
    )
    verdicts = spark.createDataFrame(
        [(2, "LOGIC", 0.9, "x", ["q"]), (3, "ENV", None, None, ["a", "b"]), (4, "", 0.9, "x", None)],
        "id int, failure_class string, confidence double, root_cause string, key_evidence array<string>",
    )
    got = {r.id: r for r in classify.classify_resolve(logs, verdicts, model="m").collect()}
    assert (got[1].failure_class, got[1].classification_source, got[1].fix_strategy) == ("UNKNOWN", "no_log", None)
    assert (got[2].failure_class, got[2].classification_source, got[2].root_cause, got[2].key_evidence) == ("ENV", "heuristic", "", [])
    assert (got[3].failure_class, got[3].classification_confidence, got[3].classification_source) == ("ENV", 0.7, "m")
    assert (got[3].fix_strategy, got[3].key_evidence) == ("", ["a", "b"])
    for i in (4, 5):
        assert (got[i].failure_class, got[i].classification_confidence) == ("FLAKY", 0.7 * 0.8)
        assert (got[i].classification_source, got[i].root_cause) == ("heuristic_fallback", None)
    assert (got[6].failure_class, got[6].classification_confidence, got[6].fix_strategy) == ("UNKNOWN", 0.0, "")
    only = classify.classify_resolve(logs, verdicts, heuristic_only=True)
    assert {r.classification_source for r in only.collect()} == {"no_log", "heuristic"}


def test_gate_counters(spark):
    rows = [("a", 0.65, "ENV", True), ("a", 0.64, "ENV", True), ("b", 0.9, "UNKNOWN", True), ("b", None, "ENV", True), ("b", 0.9, "ENV", None)]
    df = spark.createDataFrame(rows, "unit string, classification_confidence double, failure_class string, has_fix boolean")
    got = {r.unit: (r.processed, r.passed, r.skipped) for r in classify.gate_counters(df, "unit").collect()}
    assert got == {"a": (2, 1, 1), "b": (3, 0, 3), None: (5, 1, 4)}


def test_blocks_and_blanks_without_patterns(spark):
    from pyspark.sql import functions as F

    from buildmend.functions import text

    pairs = [(f"{chr(c)}a{chr(c)}b{chr(c)}", c) for c in [*range(1, 0x250), *range(0x1670, 0x1690), *range(0x1FF0, 0x2070), 0x3000, 0xFEFF]]
    df = spark.createDataFrame(pairs, "t string, c int")
    by_pattern = F.regexp_replace("t", rf"\A{text.BLANK}+|{text.BLANK}+\z", "")
    assert df.filter(text.strip(F.col("t")) != by_pattern).count() == 0
    cases = [
        None, "", "<fix></fix>", "<fix> a </fix> b</fix>", "<fix>a", "</fix><fix>a<fix>b</fix>c", "é<fix>\n\u3000ü\n</fix>", "a</fix>", "<FIX>a</FIX>",
        "<fix>a</fix><fix>b</fix>", "<fix<fix>>x</fix>", "</fix>a<fix>", " \x85 ",
    ]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    body = F.regexp_extract(F.coalesce("t", F.lit("")), "(?s)<fix>(.*?)</fix>", 1)
    got = df.select(text.tagged_block(F.col("t"), "fix").alias("a"), text.strip(body).alias("b")).collect()
    assert all(r.a == r.b for r in got) and got[6].a == "ü"
    # No pattern is in the plan.
    plan = df.select(text.tagged_block(F.col("t"), "fix"))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan
