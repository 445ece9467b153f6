"""Evaluation of repair predictions and rewards of generated patches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from buildmend.functions.text import changed_lines, tagged_block, text_or_empty
from buildmend.operators.ordered import numbered
from buildmend.operators.shaping import predicted_class

CASE_SCHEMA = (
    "id string, repo string, language string, failure_class string, failure_subclass string, "
    "ci_log string, correct_fix_diff string, notes string"
)

# The built-in cases.
BUILT_IN_CASES = [
    (
        "dep_drift_001_psycopg3", "django/django", "python", "DEP_DRIFT", "2a_direct_dep_breaking_change",
        """
FAILED tests/backends/test_postgresql.py::PostgreSQLTestCase::test_connect
ImportError: cannot import name 'connect' from 'psycopg' (psycopg 3.0 changed API)

Traceback (most recent call last):
  File "django/db/backends/postgresql/base.py", line 12, in <module>
    from psycopg import connect, OperationalError
ImportError: cannot import name 'connect' from 'psycopg'
""",
        """--- a/requirements.txt
+++ b/requirements.txt
@@ -5,7 +5,7 @@
-psycopg>=3.0
+psycopg>=2.9,<3.0
""",
        "psycopg3 changed the public API; pin to 2.x branch",
    ),
    (
        "flaky_001_async_race", "encode/httpx", "python", "FLAKY", "1a_race_condition",
        """
FAILED tests/test_async.py::test_concurrent_requests - RuntimeError: Event loop is closed
RuntimeError: Event loop is closed
During handling of the above exception, another exception occurred:
  File "tests/conftest.py", line 45, in event_loop
    loop = asyncio.get_event_loop()
""",
        """--- a/tests/conftest.py
+++ b/tests/conftest.py
@@ -42,6 +42,9 @@ import pytest
 @pytest.fixture
-def event_loop():
-    loop = asyncio.get_event_loop()
+def event_loop():
+    loop = asyncio.new_event_loop()
+    asyncio.set_event_loop(loop)
     yield loop
+    loop.close()
""",
        "Event loop reuse across tests; each test needs a fresh loop",
    ),
    (
        "env_001_ubuntu_pkg", "psf/requests", "python", "ENV", "3c_missing_system_dep",
        """
Run apt-get install -y libssl-dev
E: Package 'libssl-dev' has no installation candidate
Error: Process completed with exit code 100.
""",
        """--- a/.github/workflows/tests.yml
+++ b/.github/workflows/tests.yml
@@ -18,7 +18,7 @@
       - name: Install system deps
-        run: sudo apt-get install -y libssl-dev
+        run: sudo apt-get install -y libssl-dev openssl
""",
        "Ubuntu 24.04 renamed some ssl packages; openssl provides libssl-dev equivalent",
    ),
    (
        "logic_001_assertion", "pallets/flask", "python", "LOGIC", "4a_test_expectation_drift",
        """
FAILED tests/test_basic.py::test_404_response_code
AssertionError: assert 404 == 200
  - Expected 200 (route existed before refactor)
  - Got 404 (route was moved to /api/v2/users in latest PR)
""",
        """--- a/tests/test_basic.py
+++ b/tests/test_basic.py
@@ -34,7 +34,7 @@
 def test_404_response_code(client):
-    response = client.get('/users')
+    response = client.get('/api/v2/users')
     assert response.status_code == 200
""",
        "Route was moved; test expectation not updated in the same PR",
    ),
]


def built_in_cases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BUILT_IN_CASES, CASE_SCHEMA)


def bench_cases(
    sources: list[DataFrame], order: list[str], failure_class: str | None = None, max_cases: int | None = None
) -> DataFrame:
    """Cases of all sources; of equal ids the first one by source and ``order`` stays.

    Source and ``order`` must tell the cases of an id apart.

    A partial minimum per id replaces a window, and no text is part of it.
    """
    names = [c for c in sources[0].columns if c not in order]
    ranked = None
    for rank, source in enumerate(sources):
        for extra in order:
            if extra not in source.columns:
                source = source.withColumn(extra, F.lit(None).cast("string"))
        part = source.select(*names, F.struct(F.lit(rank).alias("_source"), *order).alias("_rank"))
        ranked = part if ranked is None else ranked.unionByName(part)
    # The place of a case is chosen first; its texts move once, for the chosen alone.
    chosen = ranked.groupBy("id").agg(F.min("_rank").alias("_rank"))
    first = ranked.join(chosen, ["id", "_rank"]).select("id", "_rank", *[c for c in names if c != "id"])
    if failure_class is not None:
        first = first.filter(F.col("failure_class") == failure_class)
    if max_cases is not None:
        first = first.orderBy("_rank", "id").limit(max_cases)
    return first.select(*names)


def bench_results(cases: DataFrame, predictions: DataFrame) -> DataFrame:
    """Verdict on each prediction (case_id, response, latency_seconds)."""
    fix = tagged_block(F.col("response"), "fix")
    read = predictions.select(
        F.col("case_id"),
        predicted_class(tagged_block(F.col("response"), "classify")).alias("predicted_class"),
        fix.alias("generated_fix"),
        "latency_seconds",
    )
    truth = cases.select(
        F.col("id").alias("case_id"), "failure_class", changed_lines(F.col("correct_fix_diff")).alias("_true_lines")
    )
    made, true = changed_lines(F.col("generated_fix")), F.col("_true_lines")
    return read.join(truth, "case_id").select(
        "case_id", "failure_class", "predicted_class",
        (F.col("predicted_class") == F.col("failure_class")).alias("correct_classification"),
        "generated_fix",
        (
            F.col("generated_fix").contains("---") & F.col("generated_fix").contains("+++")
            & (F.length("generated_fix") > 20)
        ).alias("fix_applies_cleanly"),
        F.when(true > 0, made <= F.greatest(true * 1.5, (true + 5).cast("double")))
        .otherwise(made <= 15).alias("fix_is_minimal"),
        F.lit(None).cast("boolean").alias("sandbox_passed"),
        "latency_seconds",
    )


def share(flag: str) -> Column:
    """Share of true rows, 0 where there are none."""
    return F.coalesce(F.try_divide(F.count_if(F.col(flag)), F.count(F.lit(1))), F.lit(0.0))


def bench_summary(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count(F.lit(1)).alias("total_cases"),
        share("correct_classification").alias("classification_accuracy"),
        share("fix_applies_cleanly").alias("fix_application_rate"),
        share("fix_is_minimal").alias("fix_minimality_rate"),
        F.coalesce(F.avg("latency_seconds"), F.lit(0.0)).alias("avg_latency"),
    )


def bench_by_class(results: DataFrame) -> DataFrame:
    return results.groupBy("failure_class").agg(
        F.count(F.lit(1)).alias("total"),
        share("correct_classification").alias("classification_accuracy"),
        share("fix_applies_cleanly").alias("fix_application_rate"),
        share("fix_is_minimal").alias("fix_minimality_rate"),
    )


def bench_by_language(results: DataFrame, cases: DataFrame) -> DataFrame:
    languages = cases.select(F.col("id").alias("case_id"), "language")
    return (
        results.join(languages, "case_id", "left")
        .groupBy(F.coalesce("language", F.lit("unknown")).alias("language"))
        .agg(
            F.count(F.lit(1)).alias("total"),
            share("correct_classification").alias("classification_accuracy"),
            share("fix_applies_cleanly").alias("fix_application_rate"),
        )
    )


def write_report(results: DataFrame, folder: str) -> None:
    """Summary, per-class rows and case rows as JSON below ``folder``."""
    bench_summary(results).write.mode("overwrite").json(f"{folder}/summary")
    bench_by_class(results).write.mode("overwrite").json(f"{folder}/per_class")
    results.select(
        F.col("case_id").alias("id"), "failure_class", "predicted_class", "correct_classification",
        F.col("fix_applies_cleanly").alias("fix_applies"), F.col("fix_is_minimal").alias("fix_minimal"),
        F.col("latency_seconds").alias("latency"),
    ).write.mode("overwrite").json(f"{folder}/cases")


def reward(diff: Column, first_passed: Column, second_passed: Column) -> Column:
    """Reward of a patch by its runs, moved a little by its size."""
    valid = text_or_empty(diff).contains("---")
    green = valid & F.coalesce(first_passed, F.lit(False))
    base = F.when(green & F.coalesce(second_passed, F.lit(False)), 1.0).when(green, 0.5).otherwise(0.0)
    n = changed_lines(diff)
    sized = F.when(base == 0, base).when(n < 10, base + 0.1).when(n > 50, base - 0.1).otherwise(base)
    return F.least(F.greatest(sized, F.lit(0.0)), F.lit(1.1))


def patch_reward(responses: DataFrame, outcomes: DataFrame, keys: list[str]) -> DataFrame:
    """Rewards of generated responses; one without a run outcome earns nothing."""
    found = responses.withColumn("fix", tagged_block(F.col("response"), "fix"))
    runs = outcomes.select(*keys, "first_run_passed", "second_run_passed")
    return found.join(runs, keys, "left").select(
        *keys,
        changed_lines(F.col("fix")).alias("diff_lines"),
        reward(F.col("fix"), F.col("first_run_passed"), F.col("second_run_passed")).alias("reward"),
    )


def prompt_of_completion(completions: DataFrame, prompts: DataFrame, generations: int) -> DataFrame:
    """Match flat completion numbers with the prompt each was generated for.

    ``prompts`` (prompt_idx, ...) are taken in the order of their numbers, as a
    list would be: gaps in the numbers lose no completion. Completions beyond
    the last prompt start over; without prompts there is nothing to match.
    """
    listed = numbered(prompts, ["prompt_idx"], "_place")
    n = listed.count()
    place = F.floor(F.col("completion_no") / generations) % F.nullif(F.lit(n), F.lit(0))
    others = [c for c in prompts.columns if c != "prompt_idx"]
    return completions.withColumn("_place", place).join(listed, "_place").select("prompt_idx", *completions.columns, *others)


def reward_stats(rewards: DataFrame) -> DataFrame:
    """Mean, extremes and share of non-zero rewards.

    The mean adds decimals, so it does not depend on the order of the rows.
    """
    n = F.count(F.lit(1))
    total = F.sum(F.col("reward").cast("decimal(28,10)")).cast("double")
    return rewards.agg(
        n.alias("n"),
        F.try_divide(total, n).alias("mean_reward"),
        F.max("reward").alias("max_reward"),
        F.min("reward").alias("min_reward"),
        F.count_if(F.col("reward") > 0).alias("nonzero"),
    )
