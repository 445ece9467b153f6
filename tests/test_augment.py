import hashlib
import re

import pytest
from pyspark.sql import functions as F

from buildmend.operators import augment

LOGS = [
    "Using python 3.9 and Python-3.11.4 then python:2.7 end",
    "node 18.19.0 failed, Node:v16.2, node-20.1",
    "runs-on: ubuntu-22.04 then Ubuntu-20.04 and ubuntu-latest",
    "FROM python:3.10-slim\nRUN x\nFROM node:18",
    "from Node:16-slim",
    "$MY_TOKEN ${{ secrets.DEPLOY }} ${secrets.OTHER} $A_KEY",
    "needs requests==2.31.0 or Requests: 1.2.3",
    "nothing here",
    "",
]


def draw(log, index, turn, n):
    inner = hashlib.sha256(log.encode()).hexdigest()
    return int(hashlib.sha256(f"{inner}:{index}:{turn}".encode()).hexdigest()[:8], 16) % n


def expected(log, index, name):
    """What a strategy should give, with the same draws."""
    if name == "python_version":
        found = list(re.finditer(augment.PYTHON_VERSION, log, re.I))
        if found:
            m = found[draw(log, index, 0, len(found))]
            options = [v for v in augment.PYTHON_VERSIONS if v != m[2]]
            return log[: m.start(2)] + options[draw(log, index, 1, len(options))] + log[m.end(2):]
    if name == "node_version":
        found = list(re.finditer(augment.NODE_VERSION, log, re.I))
        if found:
            m = found[draw(log, index, 0, len(found))]
            options = [v for v in augment.NODE_VERSIONS if not v.startswith(m[2])]
            return log[: m.start(2)] + options[draw(log, index, 1, len(options))] + log[m.end(2):]
    if name == "runner_version":
        found = list(re.finditer(augment.RUNNER, log, re.I))
        if found:
            old = "ubuntu-" + found[draw(log, index, 0, len(found))][1]
            options = [r for r in augment.RUNNERS if r != old]
            return log.replace(old, options[draw(log, index, 1, len(options))], 1)
    if name == "docker_image":
        m = re.search(augment.IMAGE, log, re.I)
        if m:
            options = augment.PYTHON_IMAGES if m[1].lower() == "python" else augment.NODE_IMAGES
            new = options[draw(log, index, 0, len(options))]
            return None if new == f"{m[1]}:{m[2]}" else log[: m.start(1)] + new + log[m.end(2):]
    if name == "env_var":
        found = list(re.finditer(augment.SECRET_NAME, log))
        if found:
            m = found[draw(log, index, 0, len(found))]
            old = m[1] or m[2]
            return log.replace(old, old + augment.NAME_SUFFIXES[draw(log, index, 1, 5)], 1)
    return None


@pytest.fixture(scope="module")
def logs(spark):
    # The same logs behind different heads, so that many draws are seen.
    rows = [(f"{i}-{k}", f"{'run ' * k}{log}" if log else "") for i, log in enumerate(LOGS) for k in range(12)]
    return spark.createDataFrame(rows, "id string, ci_log string").withColumn("fix_diff", F.lit("d"))


def test_each_strategy(logs):
    texts = {r.id: r.ci_log for r in logs.collect()}
    for s in augment.STRATEGIES:
        got = {r.id: r.ci_log for r in augment.mutate(logs, names=[s.name]).collect()}
        want = {i: expected(t, 0, s.name) for i, t in texts.items()}
        assert got == {i: v for i, v in want.items() if v is not None and v != texts[i]}, s.name


def test_first_three_that_apply(spark):
    log = "python 3.9 node 18.1 ubuntu-22.04 FROM python:3.9 $A_KEY"
    df = spark.createDataFrame([(1, log, 0, "b7")], "id int, ci_log string, pipeline_id bigint, build_id string")
    assert [r.mutation_index for r in augment.mutate(df).orderBy("mutation_index").collect()] == [0, 1, 2, 3, 4]
    rows = augment.mutate(df, per_record=3).orderBy("mutation_index").collect()
    assert [r.mutation_index for r in rows] == [0, 1, 2]
    assert [r.ci_log for r in rows] == [expected(log, i, s.name) for i, s in enumerate(augment.STRATEGIES[:3])]
    assert {r.original_record_id for r in rows} == {"b7"} and all(r.is_synthetic for r in rows)
    assert augment.mutate(df, per_record=9).count() == 5
    by_text = augment.mutate(df.drop("pipeline_id", "build_id")).first()
    assert by_text.original_record_id == hashlib.sha256(log.encode()).hexdigest()


def test_package_bump(logs):
    strategy = augment.Strategy("package_version", augment.package_version("requests"), "requests")
    rows = augment.mutate(logs, [strategy]).collect()
    assert len(rows) == 12
    for r in rows:
        old, new = re.fullmatch(r"requests version changed from ([\d.]+) to ([\d.]+)", r.mutation_description).groups()
        assert old == "2.31.0" and f"requests=={new} or Requests: 1.2.3" in r.ci_log
        a, b, c = map(int, new.split("."))
        assert (a, b, c) == (3, 0, 0) or (a == 2 and b in (32, 33, 34) and c == 0) or (a == 2 and b == 31 and 1 <= c <= 5)
    assert len({r.mutation_description for r in rows}) > 2
