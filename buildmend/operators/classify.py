"""Classification of failure logs by weighted patterns and model verdicts.

Everything here is a row-wise projection: no shuffle but for the join with the
verdict table. A pattern runs at most once over a log, and only where the log
holds the words that the pattern cannot match without.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buildmend.functions import taxonomy as tax
from buildmend.functions.prefilter import has_odd_letters, may_match
from buildmend.functions.text import any_case, filled, list_repr, text_or_empty


def with_signals(df: DataFrame, log: str = "ci_log", shown: int | None = None, evidence: bool = True) -> DataFrame:
    """Add ``signals``: the matched patterns of a log, best first, null if none.

    Confidence grows with each repeated match up to a ceiling; equal
    confidences keep the order of the pattern list. The evidence names all
    matches or the first ``shown``; without ``evidence`` matches are counted
    and their texts are never made.
    """
    text, lowered, odd = F.col(log), F.col("_lowered"), F.col("_odd")

    def matches(pattern: tax.Pattern) -> Column:
        regex = F.lit(any_case(pattern.regex))
        return F.regexp_extract_all(text, regex, 1) if evidence else F.regexp_count(text, regex)

    found = [F.when(may_match(lowered, [p.regex], odd), matches(p)) for p in tax.PATTERNS]

    def times(hit: Column) -> Column:
        return F.size(hit["found"]) if evidence else hit["found"]

    listed = F.array(
        *[
            F.struct(
                F.lit(rank).alias("rank"),
                F.lit(p.failure_class).alias("failure_class"),
                F.lit(p.failure_subclass).alias("failure_subclass"),
                F.lit(p.confidence).alias("base"),
                F.lit(p.regex).alias("regex"),
            )
            for rank, p in enumerate(tax.PATTERNS)
        ]
    )

    def scored(hit: Column) -> Column:
        pattern, n = hit["pattern"], times(hit)
        confidence = F.least(
            pattern["base"] + F.lit(tax.REPEAT_BONUS) * (n - 1).cast("double"),
            F.lit(tax.MAX_CONFIDENCE),
        )
        return F.struct(
            (-confidence).alias("order_by"),
            pattern["rank"].alias("rank"),
            pattern["failure_class"].alias("failure_class"),
            pattern["failure_subclass"].alias("failure_subclass"),
            confidence.alias("confidence"),
            *told(pattern, hit),
        )

    def told(pattern: Column, hit: Column) -> list[Column]:
        if not evidence:
            return []
        some = hit["found"] if shown is None else F.slice(hit["found"], 1, shown)
        return [F.concat(
            F.lit("Pattern '"), pattern["regex"], F.lit("' matched "), times(hit).cast("string"), F.lit(" times: "), list_repr(some)
        ).alias("evidence")]

    # The matches are a step of their own, so that they run as compiled code
    # and not inside the lambdas. Spark keeps the steps apart because each
    # result is looked at more than once.
    matched = (
        df.withColumn("_lowered", F.lower(text))
        .withColumn("_odd", has_odd_letters(lowered))
        .withColumn("_found", F.array(*found))
    )
    pairs = F.arrays_zip(listed.alias("pattern"), F.col("_found").alias("found"))
    hits = F.filter(pairs, lambda hit: times(hit) > 0)
    signals = F.when(
        F.exists("_found", lambda f: f.isNotNull()), F.array_sort(F.transform(hits, scored))
    )
    return matched.withColumn("signals", signals).drop("_lowered", "_odd", "_found")


def heuristic_signals(df: DataFrame, key: str = "id", log: str = "ci_log") -> DataFrame:
    """One row per log and matched pattern."""
    # Given a bare column, Spark would filter on its size first and run all
    # the patterns again for that; given an expression it does not.
    each = F.posexplode(F.slice("signals", 1, len(tax.PATTERNS)))
    return (
        with_signals(df.select(key, log), log)
        .select(key, each.alias("pos", "s"))
        .select(
            key,
            (F.col("pos") + 1).alias("signal_rank"),
            "s.failure_class", "s.failure_subclass", "s.confidence", "s.evidence",
        )
    )


def top_class(df: DataFrame, log: str = "ci_log") -> DataFrame:
    """Add the best class, sub-class and confidence; UNKNOWN, null and 0.0
    where no pattern is sure enough."""
    return (
        with_signals(df, log, evidence=False)
        .withColumn("_top", F.get("signals", F.lit(0)))
        .withColumn("_sure", F.coalesce(F.col("_top.confidence") >= tax.MIN_SIGNAL, F.lit(False)))
        .withColumn("heuristic_class", F.when(F.col("_sure"), F.col("_top.failure_class")).otherwise("UNKNOWN"))
        .withColumn("heuristic_subclass", F.when(F.col("_sure"), F.col("_top.failure_subclass")))
        .withColumn("heuristic_confidence", F.when(F.col("_sure"), F.col("_top.confidence")).otherwise(0.0))
        .drop("signals", "_top", "_sure")
    )


def multilabel_signals(df: DataFrame, key: str = "id", log: str = "ci_log") -> DataFrame:
    """All signals that are sure enough, so that a log may carry many classes."""
    return heuristic_signals(df, key, log).filter(F.col("confidence") >= tax.MIN_SIGNAL)


def primary_secondary(df: DataFrame, log: str = "ci_log") -> DataFrame:
    """Add the primary class and the sorted set of other classes seen."""
    top = F.get("signals", F.lit(0))
    sure = F.filter("signals", lambda s: s["confidence"] >= tax.MIN_SIGNAL)
    others = F.array_except(F.transform(sure, lambda s: s["failure_class"]), F.array("primary_class"))
    return (
        with_signals(df, log, evidence=False)
        .withColumn("primary_class", F.coalesce(top["failure_class"], F.lit("UNKNOWN")))
        .withColumn("primary_subclass", top["failure_subclass"])
        .withColumn("primary_confidence", F.coalesce(top["confidence"], F.lit(0.0)))
        .withColumn(
            "secondary_classes", F.coalesce(F.array_sort(others), F.array().cast("array<string>"))
        )
        .drop("signals")
    )


def fix_strategy(subclass: Column) -> Column:
    """Standard fix of a sub-class, or the triage text for an unlisted one."""
    listed = F.create_map(*[F.lit(x) for item in tax.FIX_STRATEGIES.items() for x in item])
    return F.coalesce(F.try_element_at(listed, subclass), F.lit(tax.DEFAULT_FIX))


def fix_strategy_lookup(df: DataFrame, subclass: str = "failure_subclass") -> DataFrame:
    return df.withColumn("fix_strategy", fix_strategy(F.col(subclass)))


def known_pattern_match(
    df: DataFrame, key: str = "id", log: str = "ci_log", language: str | None = "language"
) -> DataFrame:
    """Known failures of each log, those with most signatures first.

    The known failures are a handful of literals, so they are tested inside
    the row; the languages of a failure apply only where the log names one.
    """
    lowered = F.lower(F.col(log))

    def entry(rank: int, k: tax.KnownFailure) -> Column:
        hits = sum((lowered.contains(s.lower()).cast("int") for s in k.signatures), F.lit(0))
        if language is not None:
            named = filled(F.col(language))
            hits = F.when(named & ~F.lower(F.col(language)).isin(k.languages), 0).otherwise(hits)
        return F.struct(
            (-hits).alias("order_by"),
            F.lit(rank).alias("rank"),
            F.lit(k.name).alias("name"),
            F.lit(k.failure_class).alias("failure_class"),
            F.lit(k.failure_subclass).alias("failure_subclass"),
            F.lit(k.fix_template).alias("fix_template"),
            F.lit(k.description).alias("description"),
        )

    tried = F.array(*[entry(i, k) for i, k in enumerate(tax.KNOWN_FAILURES)])
    matched = F.array_sort(F.filter(tried, lambda s: s["order_by"] < 0))
    return (
        df.select(key, F.posexplode(matched).alias("pos", "s"))
        .select(
            key,
            (F.col("pos") + 1).alias("match_rank"),
            "s.name", "s.failure_class", "s.failure_subclass", "s.fix_template", "s.description",
            (-F.col("s.order_by")).alias("signature_hits"),
        )
    )


VERDICT_FIELDS = {
    "failure_class": "string",
    "failure_subclass": "string",
    "confidence": "double",
    "root_cause": "string",
    "fix_strategy": "string",
    "key_evidence": "array<string>",
}


def classify_resolve(
    df: DataFrame,
    verdicts: DataFrame,
    key: str = "id",
    log: str = "ci_log",
    model: str = "model",
    heuristic_only: bool = False,
    sure: float = 0.90,
) -> DataFrame:
    """Merge pattern results with the verdicts of an outside model.

    A very sure pattern result stands alone; otherwise a verdict that names a
    class wins; otherwise the pattern result is kept at four fifths of its
    confidence. Records without a log are UNKNOWN.
    """
    have = set(verdicts.columns)
    verdict = F.struct(
        *[
            (F.col(name) if name in have else F.lit(None)).cast(kind).alias(name)
            for name, kind in VERDICT_FIELDS.items()
        ]
    )
    v = verdicts.select(F.col(key), verdict.alias("_v"))
    joined = top_class(df, log).join(v, key, "left")

    no_log = ~filled(F.col(log))
    by_pattern = F.lit(heuristic_only) | (F.col("heuristic_confidence") >= sure)
    by_model = F.coalesce(F.col("_v.failure_class") != "", F.lit(False))
    pattern_fix = F.when(
        F.col("heuristic_subclass").isNotNull(), fix_strategy(F.col("heuristic_subclass"))
    ).otherwise("")
    no_text = F.lit(None).cast("string")
    no_list = F.lit(None).cast("array<string>")
    nothing = F.array().cast("array<string>")

    def choose(empty: Column, pattern: Column, verdict: Column, fallback: Column) -> Column:
        return (
            F.when(no_log, empty).when(by_pattern, pattern).when(by_model, verdict).otherwise(fallback)
        )

    h_class, h_sub, h_conf = (
        F.col("heuristic_class"), F.col("heuristic_subclass"), F.col("heuristic_confidence")
    )
    return joined.select(
        *[F.col(c) for c in df.columns],
        choose(F.lit("UNKNOWN"), h_class, F.col("_v.failure_class"), h_class).alias("failure_class"),
        choose(no_text, h_sub, F.col("_v.failure_subclass"), h_sub).alias("failure_subclass"),
        choose(
            F.lit(0.0), h_conf, F.coalesce(F.col("_v.confidence"), F.lit(0.7)), h_conf * F.lit(0.8)
        ).alias("classification_confidence"),
        choose(
            F.lit("no_log"), F.lit("heuristic"), F.lit(model), F.lit("heuristic_fallback")
        ).alias("classification_source"),
        choose(no_text, F.lit(""), text_or_empty(F.col("_v.root_cause")), no_text).alias("root_cause"),
        choose(no_text, pattern_fix, text_or_empty(F.col("_v.fix_strategy")), pattern_fix).alias("fix_strategy"),
        choose(
            no_list, nothing, F.coalesce(F.col("_v.key_evidence"), nothing), no_list
        ).alias("key_evidence"),
    )


def passes_classified_gate(min_confidence: float = 0.65) -> Column:
    return (
        (F.coalesce(F.col("classification_confidence"), F.lit(0.0)) >= min_confidence)
        & (F.coalesce(F.col("failure_class"), F.lit("UNKNOWN")) != "UNKNOWN")
        & F.coalesce(F.col("has_fix"), F.lit(False))
    )


def classified_gate(df: DataFrame, min_confidence: float = 0.65) -> DataFrame:
    """Keep sure, known and fixed records."""
    return df.filter(passes_classified_gate(min_confidence))


def gate_counters(df: DataFrame, unit: str, min_confidence: float = 0.65) -> DataFrame:
    """Records seen, passed and skipped per unit, and in total (null unit)."""
    gate = passes_classified_gate(min_confidence)
    return (
        df.select(unit, gate.alias("_pass"))
        .rollup(unit)
        .agg(
            F.count(F.lit(1)).alias("processed"),
            F.count_if("_pass").alias("passed"),
            F.count_if(~F.col("_pass")).alias("skipped"),
        )
    )


def class_distribution(df: DataFrame, label: str = "failure_class") -> DataFrame:
    return (
        df.groupBy(F.coalesce(F.col(label), F.lit("UNKNOWN")).alias("failure_class"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
