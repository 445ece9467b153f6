"""Secret scan with corpus-wide ownership frequency.

Every credential-like value is hashed and counted over the corpus by distinct
repositories and owners; copies of one document fold by the words around the
value. A value that many owners have is a copied example; a value that stays
with its owner and looks random is reported as live.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buildmend.llm.common import by_batch
from buildmend.session import durable

#: The base kinds in their order, their words and least lengths.
KINDS = ["assign", "access", "hex", "live"]
WORDS = ["password", "passwd", "secret", "token", "api_?key"]
LEAST = {"assign": 12, "access": 18, "hex": 16}

ASSIGN = re.compile(rf"""(?:{"|".join(WORDS)})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
HINT = re.compile("pass|secret|token|api_?key", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
#: Method's own candidate: long runs of mixed letters and digits.
GENERIC = re.compile(r"[A-Za-z0-9+/_-]{24,}")
PLACEHOLDER = ["example", "changeme", "placeholder", "xxxxxx", "sample"]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds, by start, then as listed."""
    found = []
    if HINT.search(text):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda f: (f[0], KINDS.index(f[2])))


def candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, end, value) of the credential values, each span once."""
    spans = set()
    if HINT.search(text):
        spans |= {m.span(1) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= LEAST["assign"]}
    if "AKIA" in text:
        spans |= {m.span() for m in ACCESS.finditer(text)}
    spans |= {m.span() for m in GENERIC.finditer(text)} | {m.span() for m in HEX.finditer(text)}
    return sorted((a, b, text[a:b]) for a, b in spans)


def looks_random(value: str) -> bool:
    """Letters and digits, at least eight different characters, no placeholder."""
    low = value.lower()
    return (
        len(set(value)) >= 8 and re.search("[0-9]", value) is not None and re.search("[A-Za-z]", value) is not None
        and not any(p in low for p in PLACEHOLDER)
    )


#: Words on one side of a value by which copies of a document are known, the least number where the text ends before, and
#: characters that are read for them. Snippets that are quoted with fewer words do not make a copy.
AROUND, FEWEST, READ = 8, 3, 400


def sides(text: str, start: int, end: int) -> tuple[str | None, str | None]:
    """Hashes of the words ahead of and behind a place; None where there are too few to tell copies."""
    before = re.findall(r"\w+", text[max(0, start - READ) : start].lower())[-AROUND:]
    after = re.findall(r"\w+", text[end : end + READ].lower())[:AROUND]
    return tuple(hashlib.md5(" ".join(w).encode("utf-8", "surrogatepass")).hexdigest() if len(w) >= FEWEST else None for w in (before, after))


def found_in(text: str) -> list[dict]:
    """Values with their hashes; those of one value in one text have one context, the least."""
    out, around = [], {}
    for a, b, v in candidates(text):
        name = hashlib.md5(v.encode()).hexdigest()
        out.append({"start": a, "end": b, "hash": name, "random": looks_random(v)})
        around.setdefault(name, []).append(sides(text, a, b))
    least = {name: [min(filter(None, side), default=None) for side in zip(*own)] for name, own in around.items()}
    return [f | dict(zip(("before", "after"), least[f["hash"]])) for f in out]


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scanned(docs: DataFrame, doc_id: str, text: str, repo: Column, owner: Column) -> DataFrame:
    """One row per document: base spans, and the values with their hashes."""

    def make():
        def batch(rows: dict[str, list]) -> dict[str, list]:
            out = {k: [] for k in ("id", "key", "repo", "owner", "n_assign", "n_access", "n_hex", "base", "found")}
            for doc, key, body, own_repo, own in zip(rows["id"], rows["key"], rows["body"], rows["repo"], rows["owner"]):
                base = base_spans(body or "")
                out["id"].append(doc)
                out["key"].append(key)
                out["repo"].append(own_repo)
                out["owner"].append(own)
                for kind in ("assign", "access", "hex"):
                    out[f"n_{kind}"].append(sum(k == kind for _, _, k in base))
                out["base"].append(joined(base))
                out["found"].append(found_in(body or ""))
            return out

        return batch

    given = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("key"), F.col(text).alias("body"), repo.cast("string").alias("repo"), owner.cast("string").alias("owner"))
    id_type = given.schema["id"].dataType.simpleString()
    return by_batch(given, make, (
        f"id {id_type}, key long, repo string, owner string, n_assign long, n_access long, n_hex long, base string, "
        "found array<struct<start: int, end: int, hash: string, random: boolean, before: string, after: string>>"
    ))


def ownership(scan: DataFrame, fold: bool) -> DataFrame:
    """Distinct repositories and owners of every value, over the whole corpus.

    With ``fold`` there are no more of them than different words ahead of the
    value, or behind it, so that copies of a document count once. Where a side
    has too few words each owner or repository counts by itself. Equal rows
    fold ahead of the shuffle; a value that a third of all documents have
    arrives as one row from each task.
    """
    sides = ["before", "after"] if fold else []
    rows = scan.select(F.explode("found").alias("f"), "repo", "owner").select("f.hash", "repo", "owner", *[f"f.{s}" for s in sides]).distinct()

    def number(whose: str) -> Column:
        counts = [F.countDistinct(whose)] + [F.countDistinct(F.coalesce(s, F.concat(F.lit("own "), whose))) for s in sides]
        return (F.least(*counts) if fold else counts[0]).alias(f"n_{whose}s")

    return rows.groupBy("hash").agg(number("repo"), number("owner"))


#: Parts over which the places of one value are spread in the join.
SALTS = 16


def secrets(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", repo: Column | None = None, owner: Column | None = None,
    max_owners: int = 4, max_repos: int | None = None, fold: bool = True,
) -> DataFrame:
    """Find secrets in whole texts and tell live ones from copied examples.

    A value is live if it looks random and has at most ``max_owners`` distinct
    owners and, where given, ``max_repos`` distinct repositories; a null owner
    or repository is not counted. With ``fold`` copies of a document, and near
    copies with the same ``AROUND`` words ahead of the value or behind it (or all
    words to the text's end, where these are fewer), count
    once, whoever owns them; near copies edited on both sides count each. Null and empty texts have no spans. Repeated rows are
    scanned each and count once for a value. An empty table gives no rows.
    Only the named columns are read, so extra columns cannot clash.

    Returns: ``<doc_id>``, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example,
    text_key (hash of the text).
    """
    owner = F.col("source") if owner is None else owner
    repo = owner if repo is None else repo
    scan = durable(scanned(docs, doc_id, text, repo, owner).withColumn("uid", F.monotonically_increasing_id()))
    many = F.col("n_owners") > max_owners
    copied = ownership(scan, fold).filter(many if max_repos is None else many | (F.col("n_repos") > max_repos))
    spread = copied.select("hash", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    places = scan.select("uid", F.explode("found").alias("f")).select("uid", "f.start", "f.end", "f.hash", "f.random").withColumn("salt", F.pmod(F.xxhash64("uid"), F.lit(SALTS)).cast("int"))
    marked = places.join(spread.withColumn("example", F.lit(True)), ["hash", "salt"], "left")
    live = F.col("random") & F.col("example").isNull()
    judged = marked.groupBy("uid").agg(
        F.collect_set(F.when(live, F.struct("start", "end"))).alias("live"),
        F.sum(F.col("example").isNotNull().cast("long")).alias("n_example"),
    )
    plain = scan.select("uid", "id", "key", "n_assign", "n_access", "n_hex", "base", F.size("found").alias("n_found"))
    both = plain.filter("n_found > 0").join(judged, "uid", "left").select("id", "key", "n_assign", "n_access", "n_hex", "base", "live", "n_example")
    none = plain.filter("n_found = 0").select(
        "id", "key", "n_assign", "n_access", "n_hex", "base",
        F.array().cast("array<struct<start: int, end: int>>").alias("live"), F.lit(0).cast("long").alias("n_example"),
    )
    base = F.transform(F.filter(F.split("base", ","), lambda s: s != ""), lambda s: F.struct(
        F.split(s, ":")[1].cast("int").alias("start"),
        F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.split(s, ":")[0]).cast("int").alias("kind"),
        F.split(s, ":")[2].cast("int").alias("end"),
    ))
    found = F.transform("live", lambda s: F.struct(s["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), s["end"].alias("end")))
    spans = F.array_join(F.transform(F.array_sort(F.concat(base, found)), lambda s: F.concat_ws(
        ":", F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"]), s["start"].cast("string"), s["end"].cast("string")
    )), ",")
    return both.unionByName(none).select(
        F.col("id").alias(doc_id), "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"),
        F.when(F.size(found) == 0, F.col("base")).otherwise(spans).alias("spans"), F.size("live").cast("long").alias("n_live"), "n_example",
        F.col("key").alias("text_key"),
    )
