"""One registered query for each operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from buildmend.llm import (
    alignment, best_fit, collocations, decontamination, html_extraction, imatch, language_id, licences, near_dedup, packing, secrets,
    sharding, toxicity,
)
from buildmend.llm.common import fold, table
from buildmend.llm.registry import ORACLES, QUERIES, query  # noqa: F401

WORD_CLASSES = [
    "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in secrets.WORDS
]
ASSIGN_SQL = f"""({"|".join(WORD_CLASSES)})["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def places(name: str, kind: int, least: int, group: int, pattern: str) -> str:
    """SQL list of {s, k, m, v} for the matches of one kind, from its parts and matches."""
    return f"""
    list_filter(list_transform(range(1, len({name}m) + 1), lambda i: {{
        's': coalesce(list_sum(list_transform({name}p[1:i], lambda x: length(x))), 0)::BIGINT
             + coalesce(list_sum(list_transform({name}m[1:i - 1], lambda x: length(x))), 0)::BIGINT,
        'k': {kind}, 'm': {name}m[i], 'v': regexp_extract({name}m[i], '{pattern}', {group})
    }}), lambda p: length(p.v) >= {least})"""


#: Runs are maximal, so asking for the least length loses none.
PATTERNS = {"a": ASSIGN_SQL, "c": "AKIA[A-Z0-9]{14,}", "h": "[0-9a-f]{16,}", "g": "[A-Za-z0-9+/_-]{24,}"}


PLACEHOLDERS_SQL = "|".join(secrets.PLACEHOLDER)
SECRETS_SQL = f"""
WITH d AS (SELECT doc_id, source, row_number() OVER () AS uid, coalesce(text, '') AS t FROM documents),
p AS MATERIALIZED (SELECT doc_id, source, uid,
    {", ".join(f"regexp_split_to_array(t, '{x}') AS {n}p, regexp_extract_all(t, '{x}') AS {n}m" for n, x in PATTERNS.items())} FROM d),
f AS MATERIALIZED (SELECT doc_id, source, uid,
    {places("a", 1, secrets.LEAST["assign"], 2, ASSIGN_SQL)} AS a,
    {places("c", 2, secrets.LEAST["access"], 0, PATTERNS["c"])} AS c,
    {places("h", 3, secrets.LEAST["hex"], 0, PATTERNS["h"])} AS h,
    {places("g", 4, 24, 0, PATTERNS["g"])} AS g FROM p),
cand AS (SELECT DISTINCT uid, source, p.s + length(p.m) - length(p.v) AS s, p.s + length(p.m) AS e, p.v AS v
    FROM (SELECT uid, source, unnest(list_concat(list_concat(a, c), list_concat(h, g))) AS p FROM f)),
own AS (SELECT v, count(DISTINCT source) AS owners, count(DISTINCT source || '/' || lang) AS repos
    FROM cand JOIN (SELECT row_number() OVER () AS uid, lang FROM documents) USING (uid) GROUP BY v),
judged AS (SELECT uid, s, e, owners > 1 OR repos > 2 AS example,
    len(list_distinct(string_split(v, ''))) >= 8 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')
    AND NOT regexp_matches(lower(v), '{PLACEHOLDERS_SQL}') AS rnd FROM cand JOIN own USING (v)),
per AS (SELECT uid, list({{'s': s, 'k': 4, 'e': e}}) FILTER (WHERE rnd AND NOT example) AS l,
    count(*) FILTER (WHERE example) AS n_example, count(*) FILTER (WHERE rnd AND NOT example) AS n_live FROM judged GROUP BY uid),
b AS (SELECT doc_id, uid, len(a) AS n_assign, len(c) AS n_access, len(h) AS n_hex,
    list_transform(list_concat(a, list_concat(c, h)), lambda p: {{'s': p.s, 'k': p.k, 'e': p.s + length(p.m)}}) AS base FROM f)
SELECT doc_id, n_assign, n_access, n_hex,
    sha256(array_to_string(list_transform(list_sort(base), lambda p: ['assign', 'access', 'hex'][p.k] || ':' || p.s || ':' || p.e), ',')) AS base_sha256,
    array_to_string(list_transform(list_sort(list_concat(base, coalesce(l, []))),
        lambda p: ['assign', 'access', 'hex', 'live'][p.k] || ':' || p.s || ':' || p.e), ',') AS spans,
    coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM b LEFT JOIN per USING (uid)"""

@query("op1_html_extraction")
def op1(spark, sf_dir):
    return html_extraction.extracted(table(spark, sf_dir, "pages"))


@query("op2_secrets", SECRETS_SQL)
def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    # The SQL twin counts owners of copies each, and these bounds are its own.
    found = secrets.secrets(docs, repo=F.concat_ws("/", "source", "lang"), owner=F.col("source"), max_owners=1, max_repos=2, fold=False)
    return found.drop("text_key")


@query("op3_language_id")
def op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold("doc_id", 3) == 1)
    return language_id.languages(docs, ~F.col("held_out"), keep=["doc_id", "held_out"]).select(
        "doc_id", "held_out", "lang_pred", "score", "ambiguous"
    )


@query("op4_toxicity")
def op4(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold("doc_id", 4) == 2)
    return toxicity.scored(docs, table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2, keep=["doc_id", "held_out"]).select(
        "doc_id", "held_out", "score", "predicted", "passages"
    )


@query("op5_imatch")
def op5(spark, sf_dir):
    return imatch.edited(table(spark, sf_dir, "documents"))


@query("op6_packing")
def op6(spark, sf_dir):
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op7_licences")
def op7(spark, sf_dir):
    return licences.licences(table(spark, sf_dir, "documents"))


SHARDING_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
k AS (SELECT doc_id, octet_length(encode(t)) + 16 AS size, ('0x' || left(md5(t), 15))::BIGINT AS key,
    list_reduce(list_concat([4294967295], flatten(list_transform(regexp_extract_all(hex(encode(t)), '..'),
        lambda x: [('0x' || x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
        lambda a, e: xor(xor(a, e) >> 1, (xor(a, e) & 1) * 3988292384)) AS crc FROM d),
c AS (SELECT doc_id, size, xor(crc, 4294967295) AS text_crc32,
    2 * sum(size) OVER (ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) - size AS middle,
    row_number() OVER (ORDER BY key, doc_id) AS r, sum(size) OVER () AS total FROM k),
s AS (SELECT *, least(39, middle * 40 // (2 * total))::INTEGER AS shard FROM c)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
    r - min(r) OVER (PARTITION BY shard) AS slot, NULL::INTEGER AS grown_shard FROM s"""

@query("op8_sharding", SHARDING_SQL)
def op8(spark, sf_dir):
    got = sharding.sharded(table(spark, sf_dir, "documents"), shards=40)
    return got.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op9_decontamination")
def op9(spark, sf_dir):
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_near_dedup")
def op10(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80).drop("text_key")


@query("op11_alignment")
def op11(spark, sf_dir):
    return alignment.alignment(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"),
        a_ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern=public_tokenizers.PATTERN,
    )


COLLOCATIONS_SQL = """
WITH t AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS uid,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
p AS (SELECT lang, uid, unnest(regexp_split_to_array(body, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS MATERIALIZED (SELECT lang, row_number() OVER () AS pid, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, unnest(flatten(list_transform(range(1, len(ws) + 1), lambda i: list_transform(range(1, least(5, len(ws) - i + 1) + 1),
    lambda k: {'k': k, 'phrase': array_to_string(ws[i:i + k - 1], ' ')})))) AS x FROM w),
f AS MATERIALIZED (SELECT lang, x.k AS k, x.phrase AS phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
total AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
cand AS (SELECT * FROM f WHERE k > 1),
inside AS (SELECT DISTINCT s.lang, s.phrase FROM cand s JOIN cand b ON s.lang = b.lang AND b.k > s.k AND 100 * b.a >= 100 * s.a
    AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' ')),
cut AS (SELECT lang, phrase, a, string_split(phrase, ' ') AS ws, unnest(range(1, k)) AS c FROM cand ANTI JOIN inside USING (lang, phrase)),
scored AS (SELECT cut.lang, cut.phrase, cut.a, c, l.a AS l, r.a AS r, n, (1000::HUGEINT * cut.a * n) // (l.a::HUGEINT * r.a) AS score
    FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = array_to_string(ws[1:c], ' ')
    JOIN f r ON r.lang = cut.lang AND r.phrase = array_to_string(ws[c + 1:], ' ') JOIN total ON total.lang = cut.lang),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM worst)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked WHERE rank <= 2000"""


@query("op12_collocations", COLLOCATIONS_SQL)
def op12(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op13_best_fit")
def op13(spark, sf_dir):
    return best_fit.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
