"""Pieces of oracle SQL, written apart from the Spark code."""

from __future__ import annotations

from buildmend.functions import taxonomy as tax


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def values(rows: list[tuple], names: str) -> str:
    def cell(v) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return str(v).lower()
        if isinstance(v, float):
            return f"{v!r}::DOUBLE"
        return str(v) if isinstance(v, int) else q(v)

    body = ",\n".join("(" + ", ".join(cell(c) for c in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({names})"


def choice(options: list[str]) -> str:
    return "[" + ", ".join(q(o) for o in options) + "]"


PATTERN_ROWS = "patterns AS (" + values(
    [(i, p.failure_class, p.failure_subclass, p.confidence, p.regex) for i, p in enumerate(tax.PATTERNS)],
    "rank, cls, sub, base, regex",
) + ")"

# A list of matches in brackets, each quoted.
_ESC = "replace(replace(replace(x, '\\', '\\\\'), chr(13), '\\r'), chr(9), '\\t')"
MATCH_LIST = (
    "'[' || array_to_string(list_transform(m, lambda x: CASE WHEN contains(x, '''') AND NOT contains(x, '\"') "
    f"THEN '\"' || {_ESC} || '\"' ELSE '''' || replace({_ESC}, '''', '\\''') || '''' END), ', ') || ']'"
)


def signal_steps(table: str = "ci_pairs", key: str = "id", log: str = "ci_log") -> str:
    """CTEs up to ``ranked``: every signal of every log with its rank in the log."""
    return f"""{PATTERN_ROWS},
hits AS (SELECT p.{key} AS id, k.*, regexp_extract_all(p.{log}, '(?i)' || k.regex, 1) AS m FROM {table} p CROSS JOIN patterns k),
scored AS (SELECT *, least(base + 0.05::DOUBLE * (len(m) - 1), 0.95::DOUBLE) AS conf FROM hits WHERE len(m) > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY conf DESC, rank) AS signal_rank FROM scored)"""


def top_steps(table: str = "ci_pairs", key: str = "id", log: str = "ci_log") -> str:
    """CTEs up to ``top``: class, sub-class and confidence of every log."""
    return signal_steps(table, key, log) + f""",
top AS (SELECT p.{key} AS id, coalesce(r.cls, 'UNKNOWN') AS h_class, r.sub AS h_sub, coalesce(r.conf, 0.0::DOUBLE) AS h_conf
  FROM {table} p LEFT JOIN ranked r ON r.id = p.{key} AND r.signal_rank = 1)"""


FIX_ROWS = "fixes AS (" + values(list(tax.FIX_STRATEGIES.items()), "sub, strategy") + ")"


def resolved_steps() -> str:
    """CTEs up to ``resolved``: pattern results merged with the verdicts."""
    return top_steps() + f""",
{FIX_ROWS},
resolved AS (
  SELECT p.id, p.has_fix, p.source, p.repo, p.language, p.ci_log, p.fix_diff, p.code_context, p.failing_sha,
    CASE WHEN p.ci_log = '' THEN 'UNKNOWN' WHEN t.h_conf >= 0.9::DOUBLE THEN t.h_class WHEN v.failure_class <> '' THEN v.failure_class ELSE t.h_class END AS failure_class,
    CASE WHEN p.ci_log = '' THEN NULL WHEN t.h_conf >= 0.9::DOUBLE THEN t.h_sub WHEN v.failure_class <> '' THEN v.failure_subclass ELSE t.h_sub END AS failure_subclass,
    CASE WHEN p.ci_log = '' THEN 0.0::DOUBLE WHEN t.h_conf >= 0.9::DOUBLE THEN t.h_conf WHEN v.failure_class <> '' THEN coalesce(v.confidence, 0.7::DOUBLE)
      ELSE t.h_conf * 0.8::DOUBLE END AS classification_confidence,
    CASE WHEN p.ci_log = '' THEN 'no_log' WHEN t.h_conf >= 0.9::DOUBLE THEN 'heuristic' WHEN v.failure_class <> '' THEN 'model' ELSE 'heuristic_fallback' END AS classification_source,
    CASE WHEN p.ci_log = '' THEN NULL WHEN t.h_conf >= 0.9::DOUBLE THEN '' WHEN v.failure_class <> '' THEN coalesce(v.root_cause, '') ELSE NULL END AS root_cause,
    CASE WHEN p.ci_log = '' THEN NULL WHEN t.h_conf < 0.9::DOUBLE AND v.failure_class <> '' THEN '' ELSE coalesce(f.strategy, '') END AS fix_strategy,
    CASE WHEN p.ci_log <> '' AND t.h_conf < 0.9::DOUBLE AND v.failure_class <> '' THEN v.key_evidence END AS key_evidence
  FROM ci_pairs p JOIN top t ON t.id = p.id LEFT JOIN model_verdicts v ON v.id = p.id LEFT JOIN fixes f ON f.sub = t.h_sub)"""


def n_changed(diff: str) -> str:
    return (
        f"len(list_filter(string_split({diff}, chr(10)), lambda l: (starts_with(l, '+') OR starts_with(l, '-')) "
        "AND NOT starts_with(l, '+++') AND NOT starts_with(l, '---')))"
    )


def quality(log: str, diff: str) -> str:
    n = n_changed(diff)
    return f"""greatest(1.0::DOUBLE
      - (CASE WHEN length({log}) < 100 THEN 0.4 ELSE 0 END)::DOUBLE
      - (CASE WHEN NOT contains(lower({log}), 'error') AND NOT contains(lower({log}), 'failed') THEN 0.3 ELSE 0 END)::DOUBLE
      - (CASE WHEN length({diff}) < 20 THEN 0.4 ELSE 0 END)::DOUBLE
      - (CASE WHEN NOT contains({diff}, '---') OR NOT contains({diff}, '+++') THEN 0.2 ELSE 0 END)::DOUBLE
      - (CASE WHEN {n} > 100 THEN 0.3 ELSE 0 END)::DOUBLE
      - (CASE WHEN {n} = 0 THEN 0.5 ELSE 0 END)::DOUBLE, 0.0::DOUBLE)"""


def any_of(col: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({col}, {q(w)})" for w in words) + ")"


def block(col: str, tag: str) -> str:
    return f"trim(regexp_extract({col}, '(?s)<{tag}>(.*?)</{tag}>', 1), chr(10) || chr(13) || chr(9) || ' ')"


def predicted(col: str) -> str:
    return f"coalesce(nullif(regexp_extract(string_split({block(col, 'classify')}, '—')[1], '^\\s*(\\S+)', 1), ''), 'UNKNOWN')"


def context_steps(pattern: str, before: int, after: int, strip: bool, table: str = "ci_pairs", key: str = "id", log: str = "ci_log") -> str:
    """CTEs up to ``near``: every line of every log, whether its log has errors, whether it is near one."""
    text = f"regexp_replace({log}, '\\x1B(?:[@-Z\\\\-_]|\\[[0-?]*[ -/]*[@-~])', '', 'g')" if strip else log
    return f"""split_logs AS (SELECT {key} AS id, string_split({text}, chr(10)) AS ls FROM {table}),
lines AS (SELECT id, unnest(ls) AS line, unnest(range(len(ls))) AS i, len(ls) AS n FROM split_logs),
flagged AS (SELECT *, CASE WHEN regexp_matches(line, '(?i){pattern}') THEN 1 ELSE 0 END AS err FROM lines),
near AS (SELECT *, max(err) OVER (PARTITION BY id ORDER BY i ROWS BETWEEN {after} PRECEDING AND {before} FOLLOWING) AS keep,
  max(err) OVER (PARTITION BY id) AS has_err FROM flagged)"""


def dedup_steps(same_id: str = "false") -> str:
    """CTEs up to ``gone``: the greedy removal of near-duplicates, one record after the other.

    ``same_id`` says when records a and b have one id.
    """
    return f"""worded AS MATERIALIZED (SELECT id, list_distinct(list_transform(list_filter(string_split_regex(lower(concat(ci_log, fix_diff)), '\\s+'), lambda x: x <> ''), lambda x: hash(x))) AS w FROM ci_pairs),
sized AS (SELECT id, w, len(w) AS n FROM worded),
compared AS (SELECT a.id AS earlier, b.id AS later, len(list_intersect(a.w, b.w)) AS i, a.n + b.n AS t, {same_id} AS same_id
  FROM sized a JOIN sized b ON a.id < b.id AND (least(a.n, b.n) >= 0.85::DOUBLE * greatest(a.n, b.n) OR {same_id})),
alike AS MATERIALIZED (SELECT earlier, later, i::DOUBLE / (t - i) AS similarity FROM compared WHERE i::DOUBLE / (t - i) >= 0.85::DOUBLE OR same_id),
o AS MATERIALIZED (SELECT later AS id, list(earlier) AS nb, row_number() OVER (ORDER BY later) AS rn FROM alike GROUP BY later),
g AS (SELECT 0::BIGINT AS rn, []::BIGINT[] AS dropped
  UNION ALL
  SELECT o.rn, CASE WHEN len(list_filter(o.nb, lambda x: NOT list_contains(g.dropped, x))) > 0 THEN list_append(g.dropped, o.id) ELSE g.dropped END
  FROM g JOIN o ON o.rn = g.rn + 1),
gone AS (SELECT unnest(dropped) AS id FROM (SELECT dropped FROM g ORDER BY rn DESC LIMIT 1))"""


DEDUP_STEPS = dedup_steps()


# A number in [0, n) drawn for a log, as the mutation strategies draw it.
def drawn(log: str, index: int, turn: int, n: str) -> str:
    return f"(('0x' || substr(sha256(sha256({log}) || ':{index}:{turn}'), 1, 8))::BIGINT % {n})"
