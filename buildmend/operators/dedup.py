"""Near-duplicate removal: the first record of each kind stays.

Reading the records in order, a record is kept if no kept record is similar to
it (Jaccard of word sets) or has its id. Records that differ from each other
may both be similar to a third, so this is not a matter of connected groups.

How it scales:

* Records with the same word set are folded first, by a partial aggregation;
  a text copied a billion times costs one row from there on.
* Two sets at the threshold share a signature of some five words
  (`signatures`). Records meet only where they share one and have nearly the
  same size. This loses no pair, and records that share single words by chance
  do not meet, however many there are.
* Records are read in batches that double in size: a few thousand, then as many
  as were read before, and so on. A batch is compared with the records kept so
  far and then within itself. Of a hot group only what is kept goes on, so its
  pairs are never listed, and the number of passes grows with the logarithm of
  the table, not with any group or bucket.
* A pair that meets goes on only if 64 bits of each set, and 512 bits or more (one
  for each word) after that, leave room for enough shared words; others are never fetched.
* Every comparison is checked on the whole word sets, which are read only of
  records that meet others. They are by far the largest table and are written once;
  short lists of records are sent to them. Joins are between tables, so that a hot signature
  is split over tasks.
* New records are compared with a stored index of what is kept (`add_increment`),
  never with the texts of the corpus.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from buildmend.functions.text import text_or_empty, words
from buildmend.operators.signatures import folded_sketch, narrowed, signatures, wide_sketch
from buildmend.session import durable, step
from buildmend.sources.marks import named, whole

THRESHOLD = 0.85
SEED = 42
BATCH_ROWS = 8192  # of the first batch
#: Slots of the table that tells rare words from common ones: its size is fixed.
SLOTS = 1 << 20
#: Records whose places mark out the batches.
MARKS = 100_000
#: Rows of a list of records that is sent to every task, so that the word sets need not be dealt out to meet it.
SENT_ROWS = 500_000


def hashed_words(content: Column) -> Column:
    """Sorted distinct hashes of the words of a text."""
    return F.sort_array(F.array_distinct(F.transform(words(content), lambda w: F.xxhash64(w))))


def distinct_sets(records: DataFrame) -> DataFrame:
    """Fold records of equal word sets into those that can still be kept.

    ``records`` (ord, id, set_key). Of a set the first record with an id of its
    own decides for all behind it. Records ahead of it whose id occurs again
    elsewhere stay, since they may fall to their id and not to their text.
    """
    slim = records.select("ord", "id", "set_key")
    firsts = slim.groupBy("set_key", "id").agg(F.min("ord").alias("ord"))
    repeated = (
        slim.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id", F.lit(True).alias("again"))
    )
    marked = firsts.join(repeated, "id", "left").withColumn("again", F.coalesce("again", F.lit(False)))
    # The copies of a hot text end here, in the partial aggregation.
    decisive = marked.filter(~F.col("again")).groupBy("set_key").agg(F.min("ord").alias("decisive"))
    ahead = (
        marked.filter("again").join(decisive, "set_key", "left")
        .filter(F.col("decisive").isNull() | (F.col("ord") < F.col("decisive")))
    )
    return decisive.select(F.col("decisive").alias("ord"), F.lit(False).alias("again")).unionByName(
        ahead.select("ord", "again")
    )


def place(order: list[str]) -> Column:
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def part_of(place_col: str, order: list[str], name: str) -> Column:
    return F.col(place_col) if len(order) == 1 else F.col(f"{place_col}.{name}")


def words_by_slot(sets: DataFrame) -> DataFrame:
    slot = F.pmod("word", F.lit(SLOTS)).cast("int").alias("slot")
    return sets.select(F.explode("words").alias("word")).groupBy(slot).agg(F.count(F.lit(1)).alias("n"))


def count_table(seen: DataFrame) -> np.ndarray:
    counts = np.zeros(SLOTS, dtype=np.int64)
    table = seen.toArrow()
    counts[table["slot"].to_numpy()] = table["n"].to_numpy()
    return counts


def slot_counts(sets: DataFrame) -> np.ndarray:
    """How many records have a word of each slot; words of a slot count together."""
    return count_table(words_by_slot(sets))


def sent(rows: DataFrame) -> DataFrame:
    """A table that joins without moving the other side, if it has few rows."""
    return F.broadcast(rows) if rows.limit(SENT_ROWS + 1).count() <= SENT_ROWS else rows


def row_of() -> Column:
    """Which of several records in one place a row is."""
    return F.xxhash64("id", "set_key").alias("row")


def only(records: DataFrame, rows: DataFrame) -> DataFrame:
    """The records (ord, id, words, set_key) that are among ``rows`` (ord, id, set_key), with ``n_words``.

    Nearly all of them are, so the list of the others is what is sent to the
    word sets, which are larger than all else and stay where they lie.
    """
    others = records.select("ord", row_of()).join(rows.select("ord", row_of()), ["ord", "row"], "left_anti")
    others = durable(others.filter(F.col("ord").isNotNull()).distinct())
    few = sent(others)
    left = records.filter(F.col("ord").isNotNull()).select("*", row_of()).join(few, ["ord", "row"], "left_anti")
    left = left.select("ord", "id", "words", "set_key", F.size("words").alias("n_words"))
    return left if few is not others else durable(left)  # dealt out once, and not by each that reads it


def shared_places(sets: DataFrame, threshold: float, by_id: DataFrame | None = None) -> DataFrame:
    """(ord, bucket, same_id) of the records that share a bucket, a signature or an id, with others.

    Most signatures belong to one record. All of them are dealt by bucket once, with
    nothing but their record, and are counted where they lie: the places of one bucket,
    a few numbers for each set of words, are in one task, which spills where they are many.
    """
    made = sets.select("ord", signatures(sets.sparkSession, F.col("words"), slot_counts(sets), threshold).alias("s"))
    by_words = made.select("ord", F.explode("s.signs").alias("bucket"), F.lit(False).alias("same_id"))
    by_id = sets if by_id is None else by_id
    by_id = by_id.filter("again").select("ord", F.xxhash64("id").alias("bucket"), F.lit(True).alias("same_id"))
    inside = F.count(F.lit(1)).over(Window.partitionBy("bucket", "same_id"))
    return durable(by_words.unionByName(by_id).withColumn("n", inside).filter("n > 1").drop("n"))


def meetings(sets: DataFrame, threshold: float, by_id: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """`meeting_places`, the records (ord) that are in them, and the sets (ord, words, n_words, wide) of these."""
    shared = shared_places(sets, threshold, by_id)
    live = durable(shared.select("ord").distinct())
    met_sets = durable(sketched(sets.join(sent(live), "ord", "left_semi")))
    bits = met_sets.select("ord", "n_words", folded_sketch(F.col("wide")).alias("bits"))
    return durable(shared.join(bits, "ord")), live, met_sets


def sketched(sets: DataFrame) -> DataFrame:
    """Sets as (ord, words, n_words, wide)."""
    return sets.select("ord", "words", "n_words", wide_sketch(F.col("words")).alias("wide"))


def meeting_places(sets: DataFrame, threshold: float) -> DataFrame:
    """(ord, n_words, bits, bucket, same_id) of the records that share a bucket with others."""
    return meetings(sets, threshold)[0]


def may_differ(n_words: Column, threshold: float) -> Column:
    """How many words at most are in one alone of two similar sets that have so many words together."""
    return n_words * ((1 - threshold) / (1 + threshold)) + 1e-6


def pairs_met(later: DataFrame, earlier: DataFrame, threshold: float, backward: bool = True) -> DataFrame:
    """Pairs (ord, earlier, same_id) that share a signature or an id and may be similar by sizes and bits.

    Sets of x and y words are similar only if ``(1 - t) / (1 + t) * (x + y)``
    words at most are in one of them alone; their bits differ in no more.
    """
    other = earlier.select(
        "bucket", "same_id", F.col("ord").alias("earlier"), F.col("n_words").alias("n_earlier"), F.col("bits").alias("bits_earlier")
    )
    small, large = F.least("n_words", "n_earlier"), F.greatest("n_words", "n_earlier")
    differ = may_differ(F.col("n_words") + F.col("n_earlier"), threshold)
    alike = (small >= large * threshold) & (F.bit_count(F.col("bits").bitwiseXOR(F.col("bits_earlier"))) <= differ)
    before = (F.col("earlier") < F.col("ord")) if backward else F.lit(True)
    return (
        later.join(other, ["bucket", "same_id"])
        .filter(before & (F.col("same_id") | alike))
        .groupBy("ord", "earlier")
        .agg(F.max("same_id").alias("same_id"))
    )


def similarity_of(a: str, b: str) -> Column:
    shared = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - shared
    return F.when(either == 0, 1.0).otherwise(shared / either)


def close(met: DataFrame, ours: DataFrame, theirs: DataFrame, threshold: float) -> DataFrame:
    """The pairs (ord, earlier, same_id) that may be similar by the wide sketches of (ord, n_words, wide)."""
    a = ours.select("ord", F.col("n_words").alias("n_a"), F.col("wide").alias("wide_a"))
    b = theirs.select(F.col("ord").alias("earlier"), F.col("n_words").alias("n_b"), F.col("wide").alias("wide_b"))
    width = F.least(F.size("wide_a"), F.size("wide_b"))
    bits = F.zip_with(narrowed(F.col("wide_a"), width), narrowed(F.col("wide_b"), width), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    differ = F.aggregate(bits, F.lit(0), lambda total, n: total + n)
    alike = differ <= may_differ(F.col("n_a") + F.col("n_b"), threshold)
    return met.join(a, "ord").join(b, "earlier").filter(F.col("same_id") | alike).select("ord", "earlier", "same_id")


def similar(later: DataFrame, earlier: DataFrame, ours: DataFrame, theirs: DataFrame, threshold: float) -> DataFrame:
    """Edges (ord, earlier, similarity) between records that meet, checked on their whole sets (ord, words, n_words, wide)."""
    return checked(durable(pairs_met(later, earlier, threshold)), ours, theirs, threshold)


def checked(met: DataFrame, ours: DataFrame, theirs: DataFrame, threshold: float) -> DataFrame:
    """Those of the pairs (ord, earlier, same_id) that are edges, by sketches first."""
    met = durable(close(met, ours, theirs, threshold))
    # Whole sets are read only of records that are in a pair, ahead of any shuffle of sets.
    ours = ours.select("ord", F.col("words").alias("a")).join(met.select("ord").distinct(), "ord", "left_semi")
    theirs = theirs.select(F.col("ord").alias("earlier"), F.col("words").alias("b"))
    theirs = theirs.join(met.select("earlier").distinct(), "earlier", "left_semi")
    similarity = similarity_of("a", "b")
    edges = met.join(ours, "ord").join(theirs, "earlier").select("ord", "earlier", "same_id", similarity.alias("similarity"))
    return durable(edges.filter(F.col("same_id") | (F.col("similarity") >= threshold)).drop("same_id"))


def settle(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """The records (ord) that stay, of one batch.

    A record goes once an earlier similar record stays, and stays once all its
    earlier similar ones have gone. Each turn reads and writes only what is
    still undecided.
    """
    kept = durable(vertices.join(edges.select("ord").distinct(), "ord", "left_anti"))
    stays, open_edges = [kept], edges
    while not open_edges.isEmpty():
        gone = open_edges.join(kept.select(F.col("ord").alias("earlier")), "earlier", "left_semi").select("ord").distinct()
        gone = durable(gone)
        waiting = durable(open_edges.select("ord").distinct().join(gone, "ord", "left_anti"))
        open_edges = durable(
            open_edges.join(waiting, "ord", "left_semi")
            .join(gone.select(F.col("ord").alias("earlier")), "earlier", "left_anti")
        )
        kept = durable(waiting.join(open_edges.select("ord").distinct(), "ord", "left_anti"))
        stays.append(kept)
    return union(stays)


def union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def batch_marks(live: DataFrame, first: int) -> list:
    """Places in the order that part it into batches of doubling size.

    Marks come from a bounded sample; a table within the first batch needs none.
    """
    n = live.count()
    if n <= first:
        return []
    drawn = live.filter(F.pmod(F.xxhash64(F.lit(SEED), "ord"), F.lit(1 << 20)) < min(1.0, MARKS / n) * (1 << 20))
    marks = [r[0] for r in drawn.orderBy("ord").select("ord").collect()]
    ends, size = [], first
    while size < n and marks:
        ends.append(marks[min(len(marks) - 1, size * len(marks) // n)])
        size *= 2
    return [m for i, m in enumerate(ends) if i == 0 or m != ends[i - 1]]


def literal(mark) -> Column:
    return F.struct(*[F.lit(v).alias(k) for k, v in mark.asDict().items()]) if hasattr(mark, "asDict") else F.lit(mark)


def decide(
    df: DataFrame,
    key: str,
    order: list[str] | None,
    text: list[str] = ["ci_log", "fix_diff"],
    threshold: float = THRESHOLD,
    batch_rows: int = BATCH_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """All records (ord, id, set_key), and the decisions on the folded ones
    (ord, set_key, state, kept_ord, similarity)."""
    return decide_sets(durable(word_sets(df, key, order, text)), threshold, batch_rows)


def word_sets(df: DataFrame, key: str, order: list[str] | None, text: list[str]) -> DataFrame:
    """Records as (ord, id, words, set_key)."""
    ord_col = place(order or [key])
    content = F.concat(*[text_or_empty(F.col(c)) for c in text])
    worded = df.select(ord_col.alias("ord"), F.col(key).alias("id"), hashed_words(content).alias("words"))
    set_key = F.concat_ws("-", F.xxhash64("words"), F.xxhash64(F.lit(SEED), "words"), F.size("words"))
    return worded.withColumn("set_key", set_key)


def decide_sets(
    records: DataFrame, threshold: float, batch_rows: int = BATCH_ROWS, rows: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """As `decide`, from a table of word sets, or of those of them that are among ``rows`` (ord, id, set_key)."""
    everyone = records.select("ord", "id", "set_key") if rows is None else rows
    standing = durable(everyone.join(distinct_sets(everyone), "ord"))
    sets = only(records, standing)

    # From here on only records that meet others are read.
    places, live, met_sets = meetings(sets, threshold, standing)
    marks = batch_marks(live, batch_rows)
    decided, kept = [], None
    for start, end in zip([None, *marks], [*marks, None]):
        inside = F.lit(True) if start is None else F.col("ord") >= literal(start)
        if end is not None:
            inside = inside & (F.col("ord") < literal(end))
        now, rest, ours = places.filter(inside), live.filter(inside), met_sets.filter(inside)
        if kept is not None:
            # What lies ahead doubles with each batch, so over all batches it is read about once.
            ahead = F.col("ord") < literal(start)
            held = places.filter(ahead).join(kept, "ord", "left_semi")
            edges = similar(now, held, ours, met_sets.filter(ahead), threshold)
            gone = durable(repeats(edges))
            decided.append(gone)
            now, rest = now.join(gone, "ord", "left_anti"), rest.join(gone, "ord", "left_anti")
        now, rest = durable(now), durable(rest)
        edges = similar(now, now, ours, ours, threshold)
        stays = durable(settle(rest, edges))
        among = edges.join(stays.select(F.col("ord").alias("earlier")), "earlier", "left_semi").join(stays, "ord", "left_anti")
        decided.append(durable(repeats(among)))
        kept = stays if kept is None else kept.unionByName(stays)

    state = (
        standing.select("ord", "set_key")
        .join(union(decided), "ord", "left")
        .withColumn("state", F.when(F.col("kept_ord").isNull(), "keep").otherwise("drop"))
    )
    return everyone, state


def repeats(edges: DataFrame) -> DataFrame:
    """Each removed record with the earliest kept one that it repeats."""
    first = edges.groupBy("ord").agg(F.min(F.struct("earlier", "similarity")).alias("_first"))
    return first.select("ord", F.col("_first.earlier").alias("kept_ord"), F.col("_first.similarity").alias("similarity"))


def dedup_decisions(df: DataFrame, key: str = "id", order: list[str] | None = None, **options) -> DataFrame:
    """For each record (ord, id): whether it stays, and if not which kept record it repeats.

    ``order`` must tell all records apart; it defaults to the key alone.
    """
    return carried_over(*decide(df, key, order, **options))


def carried_over(everyone: DataFrame, state: DataFrame) -> DataFrame:
    """The decisions on the folded records, carried over to all records."""
    own = state.select("ord", "state", "kept_ord", "similarity")
    # The record that stands for a whole set: its kept member, else what its last member repeats.
    speaker = state.groupBy("set_key").agg(
        F.min(F.when(F.col("state") == "keep", F.col("ord"))).alias("_kept"),
        F.max_by(F.struct("kept_ord", "similarity"), "ord").alias("_last"),
    )
    joined = everyone.join(own, "ord", "left").join(speaker, "set_key")
    folded = F.col("state").isNull()
    return joined.select(
        "ord", "id",
        (F.coalesce("state", F.lit("drop")) == "keep").alias("kept"),
        F.when(folded, F.coalesce("_kept", "_last.kept_ord")).otherwise(F.col("kept_ord")).alias("kept_ord"),
        F.when(folded, F.when(F.col("_kept").isNotNull(), 1.0).otherwise(F.col("_last.similarity")))
        .otherwise(F.col("similarity")).alias("similarity"),
    )


def near_dedup(df: DataFrame, key: str = "id", order: list[str] | None = None, **options) -> DataFrame:
    """The records that stay."""
    order = order or [key]
    _, state = decide(df, key, order, **options)
    keep = state.filter(F.col("state") == "keep")
    return df.join(keep.select(*[part_of("ord", order, c).alias(c) for c in order]), order, "left_semi")


def near_dup_pairs(df: DataFrame, key: str = "id", order: list[str] | None = None, **options) -> DataFrame:
    """Each removed record with the kept record it repeats and their similarity."""
    order = order or [key]
    shown = key if key in order else order[-1]
    return (
        dedup_decisions(df, key, order, **options)
        .filter(~F.col("kept"))
        .select(
            part_of("ord", order, shown).alias("dup_id"),
            part_of("kept_ord", order, shown).alias("kept_id"),
            "similarity",
        )
    )


def dedup_counts(decisions: DataFrame) -> DataFrame:
    return decisions.agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count_if("kept").alias("n_kept"),
        F.count_if(~F.col("kept")).alias("n_removed"),
    )


# -- increments ---------------------------------------------------------------

def index_batches(spark, index: str) -> DataFrame | None:
    """What the index holds, of increments that were written whole: (ord, id, words, set_key, n_words, bits, signs, batch)."""
    folders = whole(spark, f"{index.rstrip('/')}/batch=*")
    return spark.read.option("basePath", index).parquet(*folders) if folders else None


def stored_counts(sets: DataFrame, index: str) -> np.ndarray:
    """Slot counts that tell rare words from common ones in this index, from its first increment on."""
    spark, folder = sets.sparkSession, f"{index.rstrip('/')}/counts"
    if not whole(spark, folder):
        named(words_by_slot(sets), folder)
    return count_table(spark.read.schema("slot int, n long").parquet(folder))


def add_increment(
    df: DataFrame,
    index: str,
    batch: str,
    key: str = "id",
    order: list[str] | None = None,
    text: list[str] = ["ci_log", "fix_diff"],
    threshold: float = THRESHOLD,
    batch_rows: int = BATCH_ROWS,
) -> DataFrame:
    """The records of an increment that stay, given all that is kept from earlier increments.

    ``index`` is a folder that holds the ids, word hashes and signatures of
    kept records, never their texts; its first increment fixes which
    words are rare, for every later one too. Increments whose orders follow one
    another keep what one run over all of them keeps. Where orders overlap, what
    is kept stays kept.

    A record that repeats a kept one by id or by words goes first: it can
    remove nothing. What is left decides among itself. An increment counts
    once its part of the index is written whole; repeating it, also after it
    was killed, gives the same rows again and adds nothing twice. One increment
    at a time; ``key``, ``order``, ``text`` and ``threshold`` are those of the
    whole index. An empty increment is one too.
    """
    spark, order = df.sparkSession, order or [key]
    folder = f"{index.rstrip('/')}/batch={batch}"
    if not whole(spark, folder):
        with step(spark):
            records = durable(word_sets(df, key, order, text))
            counts = stored_counts(records, index)
            held = index_batches(spark, index)
            rows = records.select("ord", "id", "set_key")
            if held is not None:
                rows = durable(unlike(records, held, counts, threshold))
            _, state = decide_sets(records, threshold, batch_rows, rows)
            kept = rows.join(state.filter(F.col("state") == "keep").select("ord"), "ord", "left_semi")
            made = signatures(spark, F.col("words"), counts, threshold)
            named(only(records, kept).withColumn("s", made).select("*", "s.bits", "s.signs").drop("s"), folder)
    kept = spark.read.parquet(folder).select("ord")
    return df.join(kept.select(*[part_of("ord", order, c).alias(c) for c in order]), order, "left_semi")


def unlike(records: DataFrame, held: DataFrame, counts: np.ndarray, threshold: float) -> DataFrame:
    """Those of the records, as (ord, id, set_key), that repeat nothing in the index, by id or by words."""
    fresh = durable(
        records.select("ord", "id", "set_key")
        .join(held.select("id"), "id", "left_anti")
        .join(held.select("set_key"), "set_key", "left_anti")
        .select("ord", "id", "set_key")
    )
    # One record stands for all of its set.
    first = fresh.groupBy("set_key").agg(F.min(F.when(F.col("ord").isNotNull(), F.struct("ord", "id"))).alias("_first")).select("set_key", "_first.*")
    first = durable(first)
    sets = only(records, first)
    no = F.lit(False).alias("same_id")
    made = sets.select("ord", "n_words", signatures(sets.sparkSession, F.col("words"), counts, threshold).alias("s"))
    ours = made.select("ord", "n_words", "s.bits", F.explode("s.signs").alias("bucket"), no)
    theirs = held.select("ord", "n_words", "bits", F.explode("signs").alias("bucket"), no)
    met = durable(pairs_met(ours, theirs, threshold, backward=False))
    # Sets are read only of records that were met, whole ones only of those that their sketches leave.
    ours = sets.join(sent(met.select("ord").distinct()), "ord", "left_semi")
    theirs = held.join(sent(met.select(F.col("earlier").alias("ord")).distinct()), "ord", "left_semi")
    gone = checked(met, sketched(ours), sketched(theirs), threshold).select("ord").distinct()
    stays = first.join(gone, "ord", "left_anti").select("set_key")
    return fresh.join(stays, "set_key", "left_semi").select("ord", "id", "set_key")
