"""Near-duplicates by chosen-path set similarity join.

Documents are branched recursively by minwise tokens: a node picks one place
of the MinHash signature, now and then two, and its documents go on to the
child of their token there. Small nodes are compared exhaustively; independent
trees are repeated until pairs at the least similarity meet almost surely.
Every link is confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5
from zlib import adler32, crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buildmend.llm.common import by_batch
from buildmend.llm.components import components
from buildmend.session import durable

#: Places of a signature.
PLACES = 64
#: Trees whose top level links most groups at first, and all trees.
FIRST_TREES, TREES = 1, 14
#: Bits of the filter that spares texts without a candidate the exact comparison.
FILTER = 1 << 24
#: Rows up to which a node is compared by pairs, and levels below the top ones.
SMALL, LEVELS = 8, 6
#: Documents of a block, where a node that no level has parted is compared in blocks.
BLOCK = 1024
#: Agreeing places, as a share below the least similarity, under which a pair is not fetched: five standard deviations.
MARGIN = 0.25
#: Lower case for A-Z alone.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
RNG = np.random.default_rng(20)
ODD = RNG.integers(1, 1 << 63, PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = RNG.integers(0, 1 << 63, PLACES, dtype=np.uint64)
MIX = RNG.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, k: int) -> np.ndarray:
    """Distinct hashed shingles of ``k`` words in order; fewer words are one shingle, none give none.

    Words are cut at spaces and the control characters 9 to 13.
    """
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    n = len(words)
    h = np.fromiter(map(crc32, words), np.uint64, n) << np.uint64(32) | np.fromiter(map(adler32, words), np.uint64, n)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    width = min(k, n)
    out = np.zeros(n - width + 1, dtype=np.uint64)
    for i in range(width):
        out += h[i : i + len(out)] * MIX[i % 64]
        out ^= out >> np.uint64(31)
    return np.unique(out * np.uint64(0x94D049BB133111EB) + np.uint64(n if n < k else k))


def signature(found: np.ndarray) -> list[int]:
    """Least value of each of ``PLACES`` hash functions."""
    low = np.full(PLACES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(found), 2048):
        part = found[start : start + 2048, None] * ODD + ADD
        np.minimum(low, part.min(axis=0), out=low)
    return (low >> np.uint64(33)).astype(np.int64).tolist()


def signed(docs: DataFrame, doc_id: str, text: str, k: int) -> DataFrame:
    """given, key (of the text), set (a hash of it), n (shingles), sig."""

    def make():
        def batch(cells: dict[str, list]) -> dict[str, list]:
            out = {"given": cells["given"], "key": cells["key"], "set": [], "n": [], "sig": []}
            for body in cells["body"]:
                found = shingles(body, k)
                out["set"].append(md5(found.tobytes()).digest())
                out["n"].append(len(found))
                out["sig"].append(signature(found) if len(found) else [])
            return out

        return batch

    given = docs.select(F.col(doc_id).cast("long").alias("given"), F.xxhash64(text).alias("key"), F.col(text).alias("body"))
    return by_batch(given, make, "given long, key long, set binary, n long, sig array<int>")


def sets_of(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str, k: int) -> DataFrame:
    """v and whole set of the texts named by ``wanted`` (v, given, key).

    A filter of ``FILTER`` bits, whatever the number of texts, passes the
    wanted texts and few others, so that texts are not shuffled; the join
    behind it is exact.
    """
    words = wanted.groupBy(F.expr(f"pmod(key, {FILTER}) div 64").alias("at")).agg(
        F.expr(f"bit_or(shiftleft(1L, cast(pmod(key, {FILTER}) % 64 AS int)))").alias("bits")
    )
    table = np.zeros(FILTER // 64, dtype=np.int64)
    for r in words.collect():
        table[r["at"]] = r["bits"]
    sent = docs.sparkSession.sparkContext.broadcast(table.view(np.uint64))

    def make():
        bits = sent.value

        def batch(cells: dict[str, list]) -> dict[str, list]:
            at = np.array(cells["key"], dtype=np.int64) % FILTER
            hit = np.flatnonzero(bits[at // 64] >> (at % 64).astype(np.uint64) & np.uint64(1)).tolist()
            return {
                "given": [cells["given"][i] for i in hit], "key": [cells["key"][i] for i in hit],
                "whole": [shingles(cells["body"][i], k).view(np.int64) for i in hit],
            }

        return batch

    rows = docs.select(F.col(doc_id).cast("long").alias("given"), F.xxhash64(text).alias("key"), F.col(text).alias("body"))
    found = by_batch(rows, make, "given long, key long, whole array<long>")
    named = wanted.withColumnsRenamed({"given": "_given", "key": "_key"})
    return found.join(named, found["given"].eqNullSafe(named["_given"]) & (found["key"] == named["_key"])).select("v", "whole").dropDuplicates(["v"])


def top(trees: range) -> Column:
    """Nodes of the first level: one place for each tree, two for every fourth."""
    rng = np.random.default_rng(len(trees) + 100 * trees.start)
    nodes = []
    for tree in trees:
        for place in rng.choice(PLACES, 2 if tree % 4 == 0 else 1, replace=False).tolist():
            nodes.append(F.xxhash64(F.lit(tree), F.lit(place), F.col("sig")[place]))
    return F.array(*nodes)


def mixed(*parts: np.ndarray | int) -> np.ndarray:
    """A 64-bit hash of unsigned numbers, element by element."""
    h = np.uint64(0x9E3779B97F4A7C15)
    for part in parts:
        h = (np.asarray(part, dtype=np.uint64) ^ h) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        h = h ^ (h >> np.uint64(29))
    return h


def descendants(node: np.ndarray, sig: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, level, node) of all nodes that documents reach below theirs.

    A node branches at one place of the signature, every fourth at two; the
    place depends on the node alone.
    """
    rows, now, out = np.arange(len(node)), node.astype(np.uint64), []
    for level in range(1, levels + 1):
        one, two = ((mixed(now, turn) % np.uint64(PLACES)).astype(np.int64) for turn in (1, 2))
        second = np.flatnonzero((mixed(now, 3) % np.uint64(4) == 0) & (one != two))
        at, place = np.concatenate([np.arange(len(now)), second]), np.concatenate([one, two[second]])
        now = mixed(now[at], place, sig[rows[at], place].astype(np.uint64))
        rows = rows[at]
        out.append((rows, np.full(len(rows), level), now))
    return tuple(np.concatenate(part) for part in zip(*out))


def deeper(large: DataFrame, levels: int) -> DataFrame:
    """Rows (node, v, label, n, level) of all nodes below those of ``large`` (node, v, label, n, sig)."""

    def make():
        def batch(cells: dict[str, list]) -> dict[str, list]:
            if not cells["node"]:
                return {"node": [], "v": [], "label": [], "n": [], "level": []}
            node = np.array(cells["node"], dtype=np.int64).view(np.uint64)
            row, level, to = descendants(node, np.array(cells["sig"]), levels)
            own = {c: np.array(cells[c], dtype=np.int64)[row] for c in ("v", "label", "n")}
            return {"node": to.view(np.int64), "level": level} | own

        return batch

    return by_batch(large.select("node", "v", "label", "n", "sig"), make, "node long, v long, label long, n long, level int")


def pair(x: Column, y: Column) -> Column:
    return F.struct(F.least(x["v"], y["v"]).alias("a"), F.greatest(x["v"], y["v"]).alias("b"))


def can_link(x: Column, y: Column, percent: int) -> Column:
    """Unlike labels, and sizes that allow the least similarity."""
    return (x["label"] != y["label"]) & (100 * F.least(x["n"], y["n"]) >= percent * F.greatest(x["n"], y["n"]))


def met(rows: DataFrame, percent: int, pivots: bool = True) -> tuple[DataFrame, DataFrame]:
    """Pairs that meet in the nodes of ``rows`` (node, v, label, n, level), and the rows of large nodes.

    Nodes with one document go first, by their counts alone; then those whose
    documents are all linked already. Rows of a small node all meet; in a
    large one each meets one pivot, unless without ``pivots``, and goes on.
    """
    own = F.struct("v", "label", "n")
    shared = durable(rows.groupBy("node").agg(F.count("*").alias("rows")).filter("rows > 1").select("node"))
    active = durable(rows.join(shared, "node", "left_semi"))
    stats = durable(
        active.groupBy("node").agg(
            F.count("*").alias("rows"), F.min("label").alias("low"), F.max("label").alias("high"),
            F.min(F.struct(F.xxhash64("node", "v").alias("rank"), "v", "label", "n")).alias("pivot"),
        ).filter(F.col("low") != F.col("high")).select("node", "rows", "pivot")
    )
    placed = durable(active.join(stats, "node"))
    small = placed.filter(F.col("rows") <= SMALL).groupBy("node").agg(F.collect_list(own).alias("all"))
    together = F.flatten(F.transform("all", lambda x: F.transform(
        F.filter("all", lambda y: (y["v"] > x["v"]) & can_link(x, y, percent)), lambda y: pair(x, y)
    )))
    pairs = small.select(F.explode(together).alias("p")).select("p.*")
    large = placed.filter(F.col("rows") > SMALL)
    if not pivots:
        return pairs, large.select("node", "v", "label", "n", "level")
    starred = large.filter(can_link(own, F.col("pivot"), percent)).select(pair(own, F.col("pivot")).alias("p")).select("p.*")
    return pairs.unionByName(starred), large.select("node", "v", "label", "n", "level")


def confirmed(pairs: list[DataFrame], vertices: DataFrame, docs: DataFrame, doc_id: str, text: str, k: int, percent: int) -> DataFrame:
    """Links among candidate pairs: fetch pairs whose signatures agree enough, compare whole sets.

    Signatures are compared by eight bits of each place.
    """
    all_pairs = pairs[0]
    for more in pairs[1:]:
        all_pairs = all_pairs.unionByName(more)
    short = vertices.select("v", F.transform("sig", lambda x: (x.bitwiseAND(255) - 128).cast("byte")).alias("sig"), "n")
    left = short.select(F.col("v").alias("a"), F.col("sig").alias("sig_a"), F.col("n").alias("n_a"))
    right = short.select(F.col("v").alias("b"), F.col("sig").alias("sig_b"), F.col("n").alias("n_b"))
    agree = F.size(F.filter(F.zip_with("sig_a", "sig_b", lambda x, y: x == y), lambda e: e))
    near = durable(
        all_pairs.distinct().join(left, "a").join(right, "b")
        .filter(agree >= F.lit(PLACES * max(0.0, percent / 100 - MARGIN))).select("a", "b", "n_a", "n_b")
    )
    ends = near.select(F.col("a").alias("v")).unionByName(near.select(F.col("b").alias("v"))).distinct()
    wanted = durable(vertices.select("v", "given", "key").join(ends, "v"))
    whole = durable(sets_of(docs, wanted, doc_id, text, k))
    both = near.join(whole.select(F.col("v").alias("a"), F.col("whole").alias("whole_a")), "a").join(
        whole.select(F.col("v").alias("b"), F.col("whole").alias("whole_b")), "b"
    )
    common = F.size(F.array_intersect("whole_a", "whole_b"))
    return durable(both.filter(100 * common >= percent * (F.col("n_a") + F.col("n_b") - common)).select("a", "b"))


def common_counts(sets: list[np.ndarray]) -> Iterator[np.ndarray]:
    """For each set, how many elements it has in common with every one."""
    lengths = np.array([len(x) for x in sets])
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    own = np.zeros(ids.max() + 1, dtype=np.int64)
    for start, n in zip(starts, lengths):
        own[ids[start : start + n]] = 1
        yield np.add.reduceat(own[ids], starts)
        own[ids[start : start + n]] = 0


def compared(left: DataFrame, vertices: DataFrame, docs: DataFrame, doc_id: str, text: str, k: int, percent: int) -> DataFrame:
    """Links between unlike labels of each node of ``left`` (node, v, label), all against all.

    Nodes with the same documents count once. A node is cut into blocks and
    each pair of blocks is a task's group of bounded size; pairs are compared
    on whole sets within the group and only links leave it.
    """
    left = durable(left.select("node", "v", "label"))
    alike = left.groupBy("node").agg(F.bit_xor(F.xxhash64("v")).alias("all"), F.count("*").alias("rows"))
    once = durable(alike.groupBy("all", "rows").agg(F.min("node").alias("node")).select("node", F.ceil(F.col("rows") / BLOCK).alias("blocks")))
    wanted = durable(vertices.select("v", "given", "key").join(left.select("v").distinct(), "v"))
    whole = durable(sets_of(docs, wanted, doc_id, text, k))
    rows = left.join(once, "node").join(whole, "v").withColumn("own", F.pmod(F.xxhash64("v"), F.col("blocks")))
    met_with = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "node", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "v", "label", "whole"
    )

    def links(group: pa.Table) -> pa.Table:
        v, label, own = (group.column(c).to_numpy() for c in ("v", "label", "own"))
        low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
        offsets = group.column("whole").combine_chunks()
        sets = [offsets[i].values.to_numpy() for i in range(len(v))]
        sizes, out = np.array([len(x) for x in sets]), []
        for i, common in enumerate(common_counts(sets)):
            hit = (100 * common >= percent * (sizes + sizes[i] - common)) & (label != label[i]) & (v > v[i])
            if low != high:
                hit &= own != own[i]
            out += [(int(v[i]), int(v[j])) for j in np.flatnonzero(hit)]
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return durable(met_with.groupBy("node", "low", "high").applyInArrow(links, "a long, b long").distinct())


def labelled(vertices: DataFrame, links: DataFrame) -> DataFrame:
    """Vertices with the label of their component so far."""
    found = components(links)
    return durable(vertices.select("v", "n", "sig").join(found, "v", "left").select("v", "n", "sig", F.coalesce("label", "v").alias("label")))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """Group documents whose shingle sets have a similarity of ``percent`` or more.

    Documents with equal sets are one vertex from the start, so copies never
    make pairs. Links, not groups, are exact: a group is what links connect.
    Null and empty texts have no shingles and are linked with nothing. A null
    id is the least. Repeated rows are linked by their equal sets. An empty
    table gives no rows. Extra columns are not read.

    Returns for each row: ``<doc_id>``, n_shingles, component_id (least id
    reachable), kept (the id is that one), text_key (hash of the text).
    """
    rows = durable(signed(docs, doc_id, text, k))
    full = rows.filter("n > 0")
    vertices = durable(full.groupBy("set").agg(
        F.min(F.struct("given", "key")).alias("head"), F.min("n").alias("n"), F.min("sig").alias("sig")
    ).select(F.monotonically_increasing_id().alias("v"), "set", "head.given", "head.key", "n", "sig"))

    def tops(known: DataFrame, trees: range) -> DataFrame:
        return known.select("v", "label", "n", F.lit(0).alias("level"), F.explode(top(trees)).alias("node"))

    def linked(*pairs: DataFrame) -> DataFrame:
        return confirmed(list(pairs), vertices, docs, doc_id, text, k, percent)

    pairs, _ = met(tops(vertices.withColumn("label", F.col("v")), range(FIRST_TREES)), percent)
    links = linked(pairs)

    known = labelled(vertices, links)
    pairs, large = met(tops(known, range(FIRST_TREES, TREES)), percent)
    more, left = met(deeper(large.join(known.select("v", "sig"), "v"), LEVELS), percent, pivots=False)
    links = links.unionByName(linked(pairs, more))

    left = left.filter(F.col("level") == LEVELS)
    if not left.isEmpty():  # exact way for what no level has parted
        known = labelled(vertices, links)  # nodes whose documents are linked by now go
        pairs, left = met(left.select("node", "v", "n", "level").join(known.select("v", "label"), "v"), percent)
        links = links.unionByName(linked(pairs)).unionByName(compared(left, vertices, docs, doc_id, text, k, percent))

    joined = components(links)
    of = vertices.select("v", "set", "given").join(joined, "v", "left").select("set", "given", F.coalesce("label", "v").alias("label"))
    least = of.groupBy("label").agg(F.min(F.struct(F.col("given").isNotNull().alias("known"), "given"))["given"].alias("component_id"))
    component = durable(of.join(least, "label").select("set", "component_id"))
    some = full.join(component, "set").select("given", "n", "component_id", "key")
    none = rows.filter("n = 0").select("given", "n", F.col("given").alias("component_id"), "key")
    return some.unionByName(none).select(
        F.col("given").alias(doc_id), F.col("n").alias("n_shingles"), "component_id",
        F.col("given").eqNullSafe(F.col("component_id")).alias("kept"), F.col("key").alias("text_key"),
    )
