"""Classification, error context, quality and near-duplicate queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from buildmend.functions import taxonomy as tax
from buildmend.operators import classify, context, dedup, quality
from buildmend.plans import corpus
from buildmend.session import scratch_path
from checks.registry import query
from checks.sql import (
    DEDUP_STEPS, FIX_ROWS, MATCH_LIST, context_steps, dedup_steps, n_changed, q, quality as quality_sql,
    resolved_steps, signal_steps, top_steps, values,
)


@query(
    "class_distribution", ["ci_pairs"], steps=top_steps() + ",\n" + FIX_ROWS,
    sql=f"""SELECT t.h_class AS failure_class, t.h_sub AS failure_subclass, count(*) AS n_records,
      coalesce(max(f.strategy), {q(tax.DEFAULT_FIX)}) AS fix_strategy
    FROM top t LEFT JOIN fixes f ON f.sub = t.h_sub GROUP BY t.h_class, t.h_sub""",
)
def class_distribution(t):
    return corpus.failure_report(t.ci_pairs)


@query(
    "label_distribution", ["ci_pairs", "model_verdicts"],
    sql="""SELECT coalesce(v.failure_class, 'UNKNOWN') AS failure_class, count(*) AS n_records
    FROM ci_pairs p LEFT JOIN model_verdicts v ON v.id = p.id GROUP BY 1""",
)
def label_distribution(t):
    stored = t.ci_pairs.select("id").join(t.model_verdicts.select("id", "failure_class"), "id", "left")
    return classify.class_distribution(stored)


@query(
    "heuristic_signals", ["ci_pairs"], steps=signal_steps(),
    sql=f"""SELECT id, CAST(signal_rank AS INT) AS signal_rank, cls AS failure_class, sub AS failure_subclass, conf AS confidence,
      'Pattern ''' || regex || ''' matched ' || len(m) || ' times: ' || {MATCH_LIST} AS evidence FROM ranked""",
)
def heuristic_signals(t):
    return classify.heuristic_signals(t.ci_pairs)


@query(
    "top_class", ["ci_pairs"], steps=top_steps(),
    sql="SELECT id, h_class AS heuristic_class, h_sub AS heuristic_subclass, h_conf AS heuristic_confidence FROM top",
)
def top_class(t):
    return classify.top_class(t.ci_pairs.select("id", "ci_log")).drop("ci_log")


@query(
    "multilabel_signals", ["ci_pairs"], steps=signal_steps(),
    sql="SELECT id, cls AS failure_class, sub AS failure_subclass, conf AS confidence FROM ranked WHERE conf >= 0.5",
)
def multilabel_signals(t):
    return classify.multilabel_signals(t.ci_pairs).select("id", "failure_class", "failure_subclass", "confidence")


@query(
    "primary_secondary", ["ci_pairs"], steps=top_steps() + """,
others AS (SELECT r.id, array_to_string(list_sort(list(DISTINCT r.cls)), ',') AS classes FROM ranked r JOIN top t ON t.id = r.id AND r.cls <> t.h_class
  WHERE r.conf >= 0.5 GROUP BY r.id)""",
    sql="""SELECT t.id, t.h_class AS primary_class, t.h_sub AS primary_subclass, t.h_conf AS primary_confidence, coalesce(o.classes, '') AS secondary_classes
    FROM top t LEFT JOIN others o ON o.id = t.id""",
)
def primary_secondary(t):
    return classify.primary_secondary(t.ci_pairs.select("id", "ci_log")).select(
        "id", "primary_class", "primary_subclass", "primary_confidence",
        F.array_join("secondary_classes", ",").alias("secondary_classes"),
    )


@query(
    "fix_strategy_lookup", ["ci_pairs"], steps=top_steps() + ",\n" + FIX_ROWS,
    sql=f"""SELECT t.id, t.h_sub AS failure_subclass, coalesce(f.strategy, {q(tax.DEFAULT_FIX)}) AS fix_strategy
    FROM top t LEFT JOIN fixes f ON f.sub = t.h_sub""",
)
def fix_strategy_lookup(t):
    top = classify.top_class(t.ci_pairs).select("id", F.col("heuristic_subclass").alias("failure_subclass"))
    return classify.fix_strategy_lookup(top)


_KNOWN = values(
    [
        (i, k.name, k.failure_class, k.failure_subclass, s.lower(), "," + ",".join(k.languages) + ",", k.fix_template, k.description)
        for i, k in enumerate(tax.KNOWN_FAILURES)
        for s in k.signatures
    ],
    "rank, name, cls, sub, sig, langs, fix_template, description",
)


@query(
    "known_pattern_match", ["ci_pairs"], steps=f"""known AS ({_KNOWN}),
found AS (SELECT p.id, k.rank, k.name, k.cls, k.sub, k.fix_template, k.description, count(*) AS hits FROM ci_pairs p
  JOIN known k ON contains(lower(p.ci_log), k.sig) AND contains(k.langs, ',' || lower(p.language) || ',') GROUP BY ALL)""",
    sql="""SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY hits DESC, rank) AS INT) AS match_rank, name, cls AS failure_class, sub AS failure_subclass,
      fix_template, description, CAST(hits AS INT) AS signature_hits FROM found""",
)
def known_pattern_match(t):
    return classify.known_pattern_match(t.ci_pairs)


def resolved(t):
    return classify.classify_resolve(t.ci_pairs, t.model_verdicts)


@query(
    "classify_resolve", ["ci_pairs", "model_verdicts"], steps=resolved_steps(),
    sql="""SELECT id, failure_class, failure_subclass, classification_confidence, classification_source, root_cause, fix_strategy FROM resolved""",
)
def classify_resolve(t):
    return resolved(t).select(
        "id", "failure_class", "failure_subclass", "classification_confidence", "classification_source", "root_cause", "fix_strategy"
    )


_GATE = "classification_confidence >= 0.65::DOUBLE AND failure_class <> 'UNKNOWN' AND has_fix"


@query(
    "classified_gate", ["ci_pairs", "model_verdicts"], steps=resolved_steps(),
    sql=f"SELECT id, failure_class, classification_confidence, has_fix FROM resolved WHERE {_GATE}",
)
def classified_gate(t):
    return classify.classified_gate(resolved(t)).select("id", "failure_class", "classification_confidence", "has_fix")


@query(
    "gate_counters", ["ci_pairs", "model_verdicts"], steps=resolved_steps(),
    sql=f"""SELECT source, count(*) AS processed, count(*) FILTER ({_GATE}) AS passed, count(*) FILTER (NOT ({_GATE})) AS skipped
    FROM resolved GROUP BY ROLLUP (source)""",
)
def gate_counters(t):
    return classify.gate_counters(resolved(t), "source")


def _context_query(name: str, rule: context.ContextRule, line_pattern: str) -> None:
    query(
        name, ["ci_pairs"], steps=context_steps(line_pattern, rule.before, rule.after, rule.strip_ansi),
        sql="SELECT id, string_agg(line, chr(10) ORDER BY i) AS failure_log FROM near WHERE has_err = 0 OR keep = 1 GROUP BY id",
    )(lambda t: context.with_error_context(t.ci_pairs.select("id", "ci_log"), rule).drop("ci_log"))


_context_query(
    "error_context_gitlab", context.GITLAB,
    r"(ERROR|FAILED|error:)\s+|Job failed|Build failed|Pipeline failed|exit status \d+|make\[\d+\].*Error \d+|fatal:|FAIL\s+",
)
_context_query(
    "error_context_travis", context.TRAVIS,
    r"The command .+ exited with \d+|(FAILED|ERROR|error:)\s+|Build failed|bundler: failed|rake aborted!|npm ERR!|Test failed",
)
_context_query(
    "error_context_circleci", context.CIRCLECI,
    r"Error|Exception|FAILED|FAILURE|npm ERR!|exit code \d+",
)


@query(
    "diff_line_count", ["ci_pairs"],
    sql=f"SELECT id, CAST({n_changed('fix_diff')} AS INT) AS changed_lines FROM ci_pairs",
)
def diff_line_count(t):
    return quality.diff_line_count(t.ci_pairs.select("id", "fix_diff")).drop("fix_diff")


@query(
    "quality_score", ["ci_pairs"],
    sql=f"SELECT id, {quality_sql('ci_log', 'fix_diff')} AS quality_score FROM ci_pairs",
)
def quality_score(t):
    return quality.with_quality(t.ci_pairs.select("id", "ci_log", "fix_diff")).select("id", "quality_score")


@query(
    "quality_gate", ["ci_pairs", "model_verdicts"], steps=resolved_steps() + f""",
rated AS (SELECT *, {quality_sql('ci_log', 'fix_diff')} AS quality_score FROM resolved)""",
    sql=f"SELECT id, failure_class, quality_score FROM rated WHERE {_GATE} AND quality_score >= 0.6::DOUBLE",
)
def quality_gate(t):
    return quality.quality_gate(quality.with_quality(resolved(t))).select("id", "failure_class", "quality_score")


@query(
    "quality_gate_stored", ["ci_pairs", "model_verdicts"], steps=resolved_steps() + f""",
rated AS (SELECT *, CASE WHEN id % 4 = 0 THEN 0.6::DOUBLE WHEN id % 4 = 1 THEN 0.59::DOUBLE ELSE {quality_sql('ci_log', 'fix_diff')} END AS quality_score FROM resolved)""",
    sql=f"SELECT id, failure_class, quality_score FROM rated WHERE {_GATE} AND quality_score >= 0.6::DOUBLE",
)
def quality_gate_stored(t):
    stored = F.when(F.col("id") % 4 == 0, 0.6).when(F.col("id") % 4 == 1, 0.59)
    return quality.quality_gate(quality.with_quality(resolved(t).withColumn("quality_score", stored))).select("id", "failure_class", "quality_score")


@query(
    "near_dedup", ["ci_pairs"], recursive=True, steps=DEDUP_STEPS,
    sql="SELECT id, repo, length(ci_log)::INT AS log_chars FROM ci_pairs WHERE id NOT IN (SELECT id FROM gone)",
)
def near_dedup(t):
    return dedup.near_dedup(t.ci_pairs).select("id", "repo", F.length("ci_log").alias("log_chars"))


@query(
    "near_dedup_increments", ["ci_pairs"], recursive=True, steps=DEDUP_STEPS,
    sql="SELECT id, repo FROM ci_pairs WHERE id NOT IN (SELECT id FROM gone)",
)
def near_dedup_increments(t):
    """The whole table in two increments, the later half of the ids second; the second is repeated."""
    index = scratch_path(t.spark, "index")
    middle = t.ci_pairs.agg(F.percentile_approx("id", 0.5)).first()[0] or 0
    first, second = t.ci_pairs.filter(F.col("id") <= middle), t.ci_pairs.filter(F.col("id") > middle)
    kept = dedup.add_increment(first, index, "1")
    for _ in range(2):
        later = dedup.add_increment(second, index, "2")
    return kept.unionByName(later).select("id", "repo")


@query(
    "near_dup_pairs", ["ci_pairs"], recursive=True, steps=DEDUP_STEPS,
    sql="""SELECT later AS dup_id, min(earlier) AS kept_id, arg_min(similarity, earlier) AS similarity FROM alike
    WHERE later IN (SELECT id FROM gone) AND earlier NOT IN (SELECT id FROM gone) GROUP BY later""",
)
def near_dup_pairs(t):
    return dedup.near_dup_pairs(t.ci_pairs)


@query(
    "dedup_repeated_ids", ["ci_pairs"], recursive=True, steps=dedup_steps("a.id // 3 = b.id // 3"),
    sql="SELECT id AS ord, id // 3 AS id FROM ci_pairs WHERE id NOT IN (SELECT id FROM gone)",
)
def dedup_repeated_ids(t):
    renamed = t.ci_pairs.select(F.col("id").alias("ord"), F.floor(F.col("id") / 3).alias("id"), "ci_log", "fix_diff")
    return dedup.near_dedup(renamed, key="id", order=["ord"]).select("ord", "id")


@query(
    "dedup_counts", ["ci_pairs"], recursive=True, steps=DEDUP_STEPS,
    sql="""SELECT count(*) AS n_records, count(*) - (SELECT count(*) FROM gone) AS n_kept, (SELECT count(*) FROM gone) AS n_removed FROM ci_pairs""",
)
def dedup_counts(t):
    return dedup.dedup_counts(dedup.dedup_decisions(t.ci_pairs))


@query(
    "training_corpus", ["ci_pairs", "model_verdicts"], recursive=True, steps=resolved_steps() + ",\n" + DEDUP_STEPS + f""",
rated AS (SELECT *, {quality_sql('ci_log', 'fix_diff')} AS quality_score FROM resolved WHERE id NOT IN (SELECT id FROM gone))""",
    sql=f"""SELECT id, failure_class, failure_subclass, classification_confidence, quality_score, ci_log, fix_diff
    FROM rated WHERE {_GATE} AND quality_score >= 0.6::DOUBLE""",
)
def training_corpus(t):
    return corpus.training_corpus(resolved(t)).select(
        "id", "failure_class", "failure_subclass", "classification_confidence", "quality_score", "ci_log", "fix_diff"
    )


@query(
    "corpus_written", ["ci_pairs", "model_verdicts"], steps=resolved_steps() + f""",
rated AS (SELECT *, {quality_sql('ci_log', 'fix_diff')} AS quality_score FROM resolved)""",
    sql=f"""SELECT failure_class, count(*) AS n_records FROM rated WHERE {_GATE} AND quality_score >= 0.6::DOUBLE GROUP BY failure_class""",
)
def corpus_written(t):
    gated = quality.quality_gate(quality.with_quality(resolved(t)))
    return corpus.write_corpus(gated, scratch_path(t.spark, "corpus"))
