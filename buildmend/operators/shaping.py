"""Prompts, requests, replies and the data sets shaped from classified pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from buildmend.functions.text import cut, filled, strip, tagged_block, text_or_empty
from buildmend.operators.classify import top_class
from buildmend.sources.records import has_required

# Test commands, languages, repository types, targets and the
# sentences of the prompts.
TEST_COMMANDS = {
    "python": "pytest --tb=short -q",
    "javascript": "npm test",
    "go": "go test ./...",
    "java": "mvn test -q",
    "ruby": "bundle exec rspec",
    "rust": "cargo test",
}
TASK_LANGUAGES = ["python", "javascript", "go"]
LANGUAGES = ["python", "javascript", "go", "java", "ruby", "rust"]
REPO_TYPES = [
    "web_framework", "data_library", "cli_tool", "database_orm", "authentication_service",
    "api_client", "testing_framework", "build_tool", "monitoring", "message_queue",
]
SYNTHESIS_TARGETS = {
    "1a_race_condition": 3000,
    "1b_external_dependency": 4000,
    "1c_resource_exhaustion": 2000,
    "1d_test_ordering": 2000,
    "2a_direct_dep_breaking_change": 5000,
    "2b_transitive_dep_conflict": 4000,
    "2c_build_tool_version": 2000,
    "2d_lockfile_stale": 3000,
    "3a_base_image_update": 3000,
    "3b_runner_os_tool_change": 2000,
    "3c_missing_system_dep": 3000,
    "3d_secret_env_var_missing": 1000,
    "4a_test_expectation_drift": 4000,
    "4b_api_contract_break": 4000,
    "4c_schema_mismatch": 2000,
    "4d_import_error": 2000,
    "5a_vulnerability_found": 400,
    "5b_license_violation": 200,
    "5c_secret_detected_in_code": 200,
    "5d_sbom_mismatch": 100,
    "6a_style_violation": 400,
    "6b_type_error": 300,
    "6c_unused_import_variable": 200,
    "6d_complexity_threshold": 100,
    "7a_compile_error": 400,
    "7b_missing_build_artifact": 200,
    "7c_build_cache_invalid": 150,
    "7d_build_tool_version_incompatible": 250,
}
DEFAULT_LANGUAGE = DEFAULT_REPO = "unknown"
MIN_REJECTED_CHARS = 20
REPLY_FIELDS = ["failure_class", "failure_subclass", "ci_log", "fix_diff"]
ASK_FOR_ANALYSIS = "Analyze this CI failure and generate the minimal fix."
ASK_FOR_FIX = "Generate the minimal fix."
ASK_FOR_CLASS = "Classify this CI failure."
HOW_TO_VALIDATE = (
    "Run the failing test suite after applying this patch. "
    "Confirm CI is green on first and second run to verify stability."
)
ASK_FOR_WORSE_FIX = (
    "Generate a DIFFERENT but WORSE fix for this CI failure. "
    "The fix should be plausible but suffer from one of these flaws: "
    "(1) too verbose — makes unnecessary changes, "
    "(2) fixes the symptom not the root cause, "
    "(3) disables/skips the failing test, "
    "(4) adds a band-aid retry without fixing the underlying issue."
)
ASK_FOR_DIFF_ONLY = "Output ONLY the diff, no explanation."
ASK_FOR_SCENARIO = "Generate a realistic CI failure scenario with these specifications:"
SCENARIO_RULES = (
    "The scenario must be specific and realistic — it should look like a real CI log "
    "from a real open source project. Include actual package names, version numbers, "
    "and error messages that would appear in this type of failure.\n\n"
    "The fix_diff must be minimal — only the exact lines needed to fix the failure."
)
REPOSITORY_LABEL = "Repository: "
LOG_LABEL = "CI Log:\n"
KEY_LOG_LABEL = "CI Log (truncated to key section):\n"
CONTEXT_LABEL = "Code context:\n"
CLASS_LABEL = "Known failure class: "
WORKFLOW_LABEL = "Workflow: "
LANGUAGE_LABEL = "\n\nRepository language: "
HINT_LABEL = "\n\nHeuristic pre-classification hint: "
SHORT_HINT_LABEL = "\n\nHeuristic hint: "
INLINE_HINT_LABEL = "\n[Heuristic hint: "
EVIDENCE_LABEL = "\n\nKey evidence from log:\n"
NO_EVIDENCE = "  - (see log above)"
NOT_PROVIDED = "(not provided)"
NOT_AVAILABLE = "(not available)"


def say(*parts: Column | str) -> Column:
    """Concatenate columns and literal texts, a null counting as empty."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else text_or_empty(p.cast("string")) for p in parts])


def field(df: DataFrame, name: str, default: str = "") -> Column:
    """A text column, with ``default`` for a null or a column the data lacks."""
    return F.coalesce(F.col(name), F.lit(default)) if name in df.columns else F.lit(default)


def chat(system: str, user: Column, reply: Column | None = None) -> Column:
    parts: list[Column | str] = [
        f"<|im_start|>system\n{system}<|im_end|>\n<|im_start|>user\n", user, "<|im_end|>\n<|im_start|>assistant\n",
    ]
    if reply is not None:
        parts += [reply, "<|im_end|>"]
    return say(*parts)


def keyed_order(key: str, seed: int) -> list[Column]:
    """An order that looks random but is fixed by key and seed."""
    return [F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), F.col(key)]


def seeded_sample(df: DataFrame, n: int, key: str = "id", seed: int = 42) -> DataFrame:
    """``n`` rows in seeded order, the same under any partitioning."""
    return df.orderBy(*keyed_order(key, seed)).limit(n)


def train_eval_split(df: DataFrame, eval_share: float = 0.1, key: str = "id", seed: int = 42) -> DataFrame:
    """Add ``split``: a row's side depends on its key and the seed alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    bucket = F.conv(F.left(digest, F.lit(8)), 16, 10).cast("bigint") % 10_000
    return df.withColumn("split", F.when(bucket < round(eval_share * 10_000), "eval").otherwise("train"))


def rl_tasks(
    df: DataFrame, languages: list[str] = TASK_LANGUAGES, max_tasks: int | None = None, key: str = "id"
) -> DataFrame:
    """Tasks that a sandbox can run: known language, a fix, a log, a full repository name.

    ``max_tasks`` keeps the first by key.
    """
    language = F.lower(field(df, "language"))
    command = F.create_map(*[F.lit(x) for item in TEST_COMMANDS.items() for x in item])
    fit = (
        language.isin(languages)
        & F.coalesce(F.col("has_fix"), F.lit(False))
        & filled(F.col("ci_log"))
        & text_or_empty(F.col("repo")).contains("/")
    )
    tasks = df.filter(fit).select(
        key, "repo", "failing_sha", language.alias("language"), "ci_log",
        "failure_class", "failure_subclass",
        F.coalesce(F.try_element_at(command, language), F.lit("pytest")).alias("test_command"),
        text_or_empty(F.col("fix_diff")).alias("ground_truth_diff"),
    )
    return tasks if max_tasks is None else tasks.orderBy(key).limit(max_tasks)


def sft_examples(
    df: DataFrame, system: str, key: str = "id",
    log_chars: int | None = None, context_chars: int | None = None, bullets_shown: int | None = None,
) -> DataFrame:
    """Chat text of each pair that has a log and a fix. The budgets of a prompt are off by default."""
    context = field(df, "code_context")
    cause = field(df, "root_cause")
    evidence = F.coalesce(
        F.col("key_evidence") if "key_evidence" in df.columns else F.lit(None).cast("array<string>"),
        F.array().cast("array<string>"),
    )
    shown = evidence if bullets_shown is None else F.slice(evidence, 1, bullets_shown)
    bullets = F.when(F.size(evidence) == 0, F.lit(NO_EVIDENCE)).otherwise(
        F.array_join(F.transform(shown, lambda e: F.concat(F.lit("  - "), e)), "\n")
    )
    user = say(
        REPOSITORY_LABEL, field(df, "repo", DEFAULT_REPO), " (", field(df, "language", DEFAULT_LANGUAGE), ")\n",
        LOG_LABEL, cut(F.col("ci_log"), log_chars), "\n\n",
        CONTEXT_LABEL, F.when(context == "", NOT_PROVIDED).otherwise(cut(context, context_chars)), "\n\n",
        ASK_FOR_ANALYSIS,
    )
    reply = say(
        "<classify>", field(df, "failure_class", "UNKNOWN"), " — ", field(df, "failure_subclass"),
        "</classify>\n<reason>\n",
        F.when(cause == "", field(df, "fix_strategy")).otherwise(cause),
        EVIDENCE_LABEL, bullets, "\n</reason>\n<fix>\n", F.col("fix_diff"),
        "\n</fix>\n<validate>\n", HOW_TO_VALIDATE, "\n</validate>",
    )
    usable = (
        F.coalesce(F.col("has_fix"), F.lit(False)) & filled(F.col("fix_diff")) & filled(F.col("ci_log"))
    )
    return df.filter(usable).select(key, chat(system, user, reply).alias("text"))


def rl_prompts(tasks: DataFrame, system: str, key: str = "id", log_chars: int | None = None) -> DataFrame:
    """Prompt and run metadata of each task that has log, class and repository."""
    language = field(tasks, "language", DEFAULT_LANGUAGE)
    user = say(
        REPOSITORY_LABEL, F.col("repo"), " (", language, ")\n",
        CLASS_LABEL, F.col("failure_class"), "\n",
        LOG_LABEL, cut(F.col("ci_log"), log_chars), "\n\n", ASK_FOR_FIX, "\n",
    )
    return tasks.filter(has_required(["ci_log", "failure_class", "repo"])).select(
        key,
        chat(system, user).alias("prompt"),
        F.struct(
            "repo",
            (F.col("failing_sha") if "failing_sha" in tasks.columns else F.lit(None).cast("string")).alias("failing_sha"),
            field(tasks, "test_command", "pytest").alias("test_command"),
            language.alias("language"),
        ).alias("metadata"),
    )


def dpo_pairs(df: DataFrame, rejected: DataFrame, key: str = "id", log_chars: int | None = None) -> DataFrame:
    """Preference pairs: the true fix against a worse candidate.

    ``rejected`` (key, rejected) holds the candidates made elsewhere.
    """
    prompt = say(
        REPOSITORY_LABEL, field(df, "repo", DEFAULT_REPO), " (", field(df, "language", DEFAULT_LANGUAGE), ")\n",
        LOG_LABEL, cut(text_or_empty(F.col("ci_log")), log_chars), "\n\n", ASK_FOR_FIX,
    )
    chosen = df.filter(F.coalesce(F.col("has_fix"), F.lit(False)) & filled(F.col("fix_diff"))).select(
        F.col(key).alias("_key"), prompt.alias("prompt"), F.col("fix_diff").alias("chosen"), "failure_class"
    )
    worse = rejected.select(F.col(key).alias("_key"), strip(F.col("rejected")).alias("rejected")).filter(
        F.length("rejected") >= MIN_REJECTED_CHARS
    )
    return chosen.join(worse, "_key").select(
        F.concat(F.col("_key").cast("string"), F.lit("_dpo")).alias("id"),
        "prompt", "chosen", "rejected", "failure_class",
        F.lit("dpo_synthetic").alias("source"),
    )


def dpo_chat(pairs: DataFrame, system: str) -> DataFrame:
    """Chat form of the usable pairs: nothing empty, the two fixes differ."""
    usable = (
        filled(F.col("prompt")) & filled(F.col("chosen")) & filled(F.col("rejected"))
        & (F.col("chosen") != F.col("rejected"))
    )
    return pairs.filter(usable).select(
        "id",
        chat(system, F.col("prompt")).alias("prompt"),
        say(F.col("chosen"), "<|im_end|>").alias("chosen"),
        say(F.col("rejected"), "<|im_end|>").alias("rejected"),
    )


REQUEST_KINDS = ["classify", "classify_short", "repair", "bench", "patch", "worse_patch"]


def model_requests(
    df: DataFrame, kinds: list[str] = REQUEST_KINDS, system: str = "", key: str = "id", sure: float = 0.90,
    log_chars: dict[str, int] | None = None, context_chars: int | None = None,
) -> DataFrame:
    """Request texts for a model outside Spark, one row per record and kind.

    ``classify`` and ``classify_short`` skip logs that the patterns settle on
    their own; ``repair`` and ``bench`` are whole chats; ``patch`` and
    ``worse_patch`` are user messages. All kinds come from one pass over the logs.
    ``log_chars`` may give a budget of log characters for a kind.
    """
    budget = log_chars or {}
    log = text_or_empty(F.col("ci_log"))
    about = say(REPOSITORY_LABEL, field(df, "repo", DEFAULT_REPO), " (", field(df, "language", DEFAULT_LANGUAGE), ")\n")
    ask = f"\n\n{ASK_FOR_ANALYSIS}\n"
    subclass = F.coalesce("heuristic_subclass", F.lit("unknown"))
    confidence = F.format_string("%.2f", "heuristic_confidence")
    hint = say(F.col("heuristic_class"), " (", subclass, ") — confidence ", confidence)
    inline_hint = F.when(
        F.col("heuristic_class") != "UNKNOWN",
        say(INLINE_HINT_LABEL, F.col("heuristic_class"), " — ", subclass, ", confidence ", confidence, "]"),
    )
    context = field(df, "code_context")
    unsure = filled(F.col("ci_log")) & (F.col("heuristic_confidence") < sure)
    fixed = F.coalesce(F.col("has_fix"), F.lit(False)) & filled(F.col("fix_diff"))
    always = F.lit(True)

    wanted: dict[str, tuple[Column, Column]] = {
        "classify": (unsure, say(
            KEY_LOG_LABEL, cut(log, budget.get("classify")),
            HINT_LABEL, hint, "\n\n", ASK_FOR_CLASS,
        )),
        "classify_short": (unsure, say(
            LOG_LABEL, cut(log, budget.get("classify_short")), SHORT_HINT_LABEL, hint, "\n\n", ASK_FOR_CLASS,
        )),
        "repair": (always, chat(system, say(
            about, WORKFLOW_LABEL, field(df, "workflow_name"), "\n", inline_hint, "\nCI Log:\n", cut(log, budget.get("repair")), ask,
        ))),
        "bench": (always, chat(system, say(about, LOG_LABEL, cut(log, budget.get("bench")), ask))),
        "patch": (always, say(
            about, "Failure class: ", field(df, "failure_class", "UNKNOWN"), " — ", field(df, "failure_subclass"),
            "\n\nCI Log:\n", cut(log, budget.get("patch")), "\n\nCode context:\n",
            F.when(context == "", NOT_AVAILABLE).otherwise(cut(context, context_chars)), "\n\n", ASK_FOR_FIX,
        )),
        "worse_patch": (fixed, say(
            ASK_FOR_WORSE_FIX, "\n\nCI Log:\n", cut(log, budget.get("worse_patch")),
            LANGUAGE_LABEL, field(df, "language", DEFAULT_LANGUAGE), "\n", ASK_FOR_DIFF_ONLY,
        )),
    }
    seen = top_class(df) if {"classify", "classify_short", "repair"} & set(kinds) else df
    made = F.array(*[
        F.when(wanted[kind][0], F.struct(F.lit(kind).alias("kind"), wanted[kind][1].alias("request"))) for kind in kinds
    ])
    return seen.select(key, F.explode(F.filter(made, lambda r: r.isNotNull())).alias("r")).select(key, "r.*")


def synthesis_plan(spark: SparkSession, per_subclass: int = 250, seed: int = 42) -> DataFrame:
    """Scenarios to ask a model for: a number per sub-class, each with a
    language and repository type fixed by sub-class, number and seed."""
    listed = spark.createDataFrame(list(SYNTHESIS_TARGETS.items()), "failure_subclass string, target int")
    tasks = listed.select(
        "failure_subclass",
        F.explode(F.sequence(F.lit(1), F.least("target", F.lit(per_subclass)))).alias("task_no"),
    )
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), "failure_subclass", "task_no"))

    def choice(values: list[str], start: int) -> Column:
        at = F.conv(F.substr(digest, F.lit(start), F.lit(8)), 16, 10).cast("bigint") % len(values)
        return F.get(F.array(*[F.lit(v) for v in values]), at.cast("int"))

    picked = tasks.withColumn("language", choice(LANGUAGES, 1)).withColumn("repo_type", choice(REPO_TYPES, 9))
    return picked.withColumn(
        "prompt",
        say(
            ASK_FOR_SCENARIO, "\n- failure_subclass: ", F.col("failure_subclass"),
            "\n- language: ", F.col("language"), "\n- repo_type: ", F.col("repo_type"), "\n\n", SCENARIO_RULES,
        ),
    )


def json_part(reply: Column) -> Column:
    """The JSON object of a model reply: all of it, or from the first ``{`` to the last ``}``."""
    text = strip(reply)
    return F.when(text.startswith("{"), text).otherwise(F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit("")))


def is_one_object(text: Column) -> Column:
    """Whether ``text`` is one JSON object and nothing behind it.

    The parsers stop at the end of the first value; inside a list anything
    that follows it must make the list longer or break it.
    """
    listed = F.concat(F.lit("["), text, F.lit("]"))
    return (
        text.startswith("{") & text.endswith("}")
        & F.try_parse_json(listed).isNotNull()
        & (F.json_array_length(listed) == 1)
    )


def parse_model_json(
    replies: DataFrame, reply: str, fields: dict[str, str], required: list[str] = REPLY_FIELDS
) -> DataFrame:
    """Fields of the replies that are JSON objects with every required field."""
    schema = ", ".join(f"`{name}` {kind}" for name, kind in fields.items())
    parsed = replies.withColumn("_json", json_part(F.col(reply))).withColumn(
        "_whole", is_one_object(F.col("_json"))
    ).withColumn("_keys", F.when(F.col("_whole"), F.json_object_keys("_json")))
    complete = F.size(F.array_except(F.array(*[F.lit(r) for r in required]), "_keys")) == 0
    kept = [c for c in replies.columns if c != reply and c not in fields]
    return (
        parsed.filter(F.col("_keys").isNotNull() & complete)
        .withColumn("_v", F.from_json("_json", schema))
        .select(*kept, "_v.*")
    )


def synthesized_records(parsed: DataFrame, request_key: str = "request_id") -> DataFrame:
    """Stamp parsed replies with the identity and origin of a synthesised pair.

    ``parsed`` carries the asked-for ``asked_subclass``, ``language`` and
    ``repo_type`` beside the reply's own fields.
    """
    number = F.conv(F.left(F.md5(F.col(request_key).cast("string")), F.lit(8)), 16, 10).cast("bigint") % 90_000 + 10_000
    return parsed.select(
        F.concat_ws("_", F.lit("synth"), "asked_subclass", "language", number).alias("id"),
        F.lit("synthesized").alias("source"),
        "failure_class", "failure_subclass", "ci_log", "fix_diff",
        F.lit(True).alias("has_fix"),
        F.lit(False).alias("verified_sandbox"),
        "language", "repo_type",
    )


def predicted_class(info: Column) -> Column:
    """First word ahead of the dash; UNKNOWN for an empty or missing block."""
    word = F.regexp_extract(F.get(F.split(info, "—"), F.lit(0)), r"(?U)^\s*(\S+)", 1)
    return F.when(word == "", "UNKNOWN").otherwise(word)


def parse_repair_response(df: DataFrame, response: str = "response") -> DataFrame:
    """Add class, sub-class, fix and validation text of a tagged reply."""
    info = tagged_block(F.col(response), "classify")
    fix = tagged_block(F.col(response), "fix")
    return (
        df.withColumn("predicted_class", predicted_class(info))
        .withColumn("predicted_subclass", strip(F.coalesce(F.get(F.split(info, "—"), F.lit(1)), F.lit(""))))
        .withColumn("extracted_fix", fix)
        .withColumn("validate_text", tagged_block(F.col(response), "validate"))
        .withColumn("success", F.length("extracted_fix") > 20)
    )
