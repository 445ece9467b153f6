import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from buildmend.operators import dedup, signatures
from buildmend.session import durable, scratch_path, step


def greedy(rows, threshold=0.85):
    """Kept record numbers, reading rows (ord, id, text) one after the other."""
    kept, ids = [], set()
    for ord_, id_, text in sorted(rows):
        words = set(text.lower().split())
        alike = any(len(words & w) >= threshold * len(words | w) if words | w else True for _, w in kept)
        if not alike and id_ not in ids:
            kept.append((ord_, words))
            ids.add(id_)
    return {o for o, _ in kept}


def run(spark, rows, **options):
    df = spark.createDataFrame([(o, i, t, "") for o, i, t in rows], "ord int, id string, ci_log string, fix_diff string")
    out = dedup.near_dedup(df, key="id", order=["ord"], **options)
    return {r.ord for r in out.collect()}


def words(rng, n):
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def varied(rng, base, swaps):
    out = list(base)
    for i in rng.sample(range(len(out)), swaps):
        out[i] = f"v{rng.randrange(10**6)}"
    return " ".join(out)


def test_chain_is_not_a_connected_group(spark):
    base = [f"w{i}" for i in range(100)]
    a, b, c = base, base[:92] + [f"x{i}" for i in range(8)], base[8:92] + [f"x{i}" for i in range(8)] + [f"y{i}" for i in range(8)]
    rows = [(1, "a", " ".join(a)), (2, "b", " ".join(b)), (3, "c", " ".join(c))]
    assert greedy(rows) == {1, 3}
    assert run(spark, rows) == {1, 3}


def test_random_families_equal_greedy(spark):
    rng = random.Random(11)
    rows = []
    for family in range(25):
        base = words(rng, rng.choice([12, 40, 120]))
        for _ in range(rng.randrange(1, 8)):
            rows.append(varied(rng, base, rng.randrange(0, max(1, len(base) // 5))))
    rows += ["", "   ", "one", "ONE", "one two"]
    rng.shuffle(rows)
    rows = [(i, f"id{i}", t) for i, t in enumerate(rows)]
    assert run(spark, rows) == greedy(rows)


def test_hot_group_of_near_copies(spark):
    rng = random.Random(5)
    base = words(rng, 60)
    rows = [(i, f"id{i}", varied(rng, base, rng.choice([0, 1, 2, 3, 4, 6, 8]))) for i in range(150)]
    rows += [(1000 + i, f"jd{i}", " ".join(words(rng, 60))) for i in range(30)]
    assert run(spark, rows) == greedy(rows)
    assert run(spark, rows, batch_rows=20) == greedy(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_ids(spark, seed):
    rng = random.Random(seed)
    texts = [" ".join(words(rng, 30)) for _ in range(8)]
    rows = [(i, f"id{rng.randrange(10)}", rng.choice(texts)) for i in range(60)]
    assert run(spark, rows) == greedy(rows)


def test_pairs_name_a_kept_record(spark):
    rng = random.Random(9)
    base = words(rng, 50)
    rows = [(i, f"id{i}", varied(rng, base, i % 3)) for i in range(20)] + [(50, "x", " ".join(base)), (51, "y", " ".join(base))]
    df = spark.createDataFrame([(o, i, t, "") for o, i, t in rows], "ord int, id string, ci_log string, fix_diff string")
    kept = greedy(rows)
    texts = {o: set(t.split()) for o, _, t in rows}
    for batch_rows in (4, 8192):
        pairs = dedup.near_dup_pairs(df, key="id", order=["ord"], batch_rows=batch_rows).collect()
        assert {p.dup_id for p in pairs} == set(texts) - kept
        for p in pairs:
            a, b = texts[p.dup_id], texts[p.kept_id]
            assert p.similarity == len(a & b) / len(a | b) >= 0.85
            assert p.kept_id == min(k for k in kept if k < p.dup_id and len(texts[k] & a) >= 0.85 * len(texts[k] | a))


def test_passes_do_not_grow_with_a_bucket(spark, monkeypatch):
    """Records of one workflow share most words without being duplicates."""
    passes = {}
    for n in (300, 600, 5000):
        made = []
        monkeypatch.setattr(dedup, "durable", lambda df, made=made: made.append(1) or durable(df))
        common = [f"c{i}" for i in range(100)]
        rows = [(i, f"id{i}", " ".join(common + [f"o{i}-{j}" for j in range(30)])) for i in range(n)]
        assert len(run(spark, rows)) == n
        passes[n] = len(made)
    assert len(set(passes.values())) == 1 and passes[300] < 20


def test_same_result_on_one_partition(spark):
    rng = random.Random(2)
    base = words(rng, 40)
    rows = [(i, f"id{i}", varied(rng, base, i % 5)) for i in range(40)]
    df = spark.createDataFrame([(o, i, t, "") for o, i, t in rows], "ord int, id string, ci_log string, fix_diff string")
    one = {r.ord for r in dedup.near_dedup(df.coalesce(1), key="id", order=["ord"]).collect()}
    assert one == run(spark, rows) == greedy(rows)


def increments(spark, rows, parts, index, **options):
    """What stays of rows given as increments, each repeated once."""
    kept = set()
    for n, part in enumerate(parts):
        df = spark.createDataFrame([(o, i, t, "") for o, i, t in part], "ord int, id string, ci_log string, fix_diff string")
        once = {r.ord for r in dedup.add_increment(df, index, f"b{n}", order=["ord"], **options).collect()}
        assert once == {r.ord for r in dedup.add_increment(df, index, f"b{n}", order=["ord"], **options).collect()}
        kept |= once
    return kept


@pytest.mark.parametrize("seed", [3, 4])
def test_increments_equal_one_run(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = []
    for family in range(20):
        base = words(rng, rng.choice([1, 2, 7, 40, 120]))
        for _ in range(rng.randrange(1, 8)):
            rows.append(varied(rng, base, rng.randrange(0, max(1, len(base) // 5))))
    rows += ["", "  ", "one", "ONE", "one two", ""]
    rng.shuffle(rows)
    rows = [(i, f"id{rng.randrange(60)}" if i % 3 else f"own{i}", t) for i, t in enumerate(rows)]
    cut = len(rows) // 3
    parts = [rows[:cut], [], rows[cut:2 * cut], rows[2 * cut:]]
    got = increments(spark, rows, parts, str(tmp_path / "index"), batch_rows=16)
    assert got == greedy(rows) == run(spark, rows)


def test_a_killed_increment_is_written_anew(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, f"id{i}", " ".join(words(rng, 20))) for i in range(6)]
    index = tmp_path / "index"
    assert increments(spark, rows, [rows[:3]], str(index)) == {0, 1, 2}
    # What an attempt leaves that ended ahead of its mark.
    left = index / "batch=b1"
    left.mkdir()
    (left / "part-0.parquet").write_bytes(b"half a file")
    df = spark.createDataFrame([(o, i, t, "") for o, i, t in rows[1:]], "ord int, id string, ci_log string, fix_diff string")
    assert {r.ord for r in dedup.add_increment(df, str(index), "b1", order=["ord"]).collect()} == {3, 4, 5}
    assert dedup.index_batches(spark, str(index)).count() == 6


def test_places_of_shared_words_rule_out_pairs_and_lose_none(spark):
    """Independent records of 100 words that share 50 common ones and some rare ones."""
    rng = random.Random(2)
    common, rare = [f"c{i}" for i in range(50)], [f"r{i}" for i in range(400)]
    rows = [(i, f"id{i}", " ".join(common + rng.sample(rare, 50))) for i in range(200)]
    rows += [(200 + i, f"copy{i}", varied(rng, rows[i][2].split(), 1 + i % 7)) for i in range(40)]  # equal sets would be folded
    df = spark.createDataFrame([(o, i, t, "") for o, i, t in rows], "ord int, id string, ci_log string, fix_diff string")
    records = durable(dedup.word_sets(df, "id", ["ord"], ["ci_log", "fix_diff"]))
    sets = durable(records.join(dedup.distinct_sets(records), "ord").selectExpr("*", "size(words) AS n_words"))
    places = dedup.meeting_places(sets, 0.85)
    met = {(r.ord, r.earlier) for r in dedup.pairs_met(places, places, 0.85).collect()}
    share = places.alias("a").join(places.alias("b"), "bucket").filter("a.ord > b.ord").select("a.ord", "b.ord").distinct().count()
    texts = {o: set(t.split()) for o, _, t in rows}
    alike = {(a, b) for a in texts for b in texts if b < a and len(texts[a] & texts[b]) >= 0.85 * len(texts[a] | texts[b])}
    assert len(alike) >= 35 and alike <= met and len(met) < share / 2


def test_independent_records_do_not_meet(spark):
    """Prose of a few thousand words: every word is shared by many records, few records are alike."""
    rng = random.Random(4)
    stock = [f"w{i}" for i in range(3000)]
    rows = [(i, f"id{i}", " ".join(rng.choices(stock, weights=[1 / (k + 20) for k in range(3000)], k=rng.choice([8, 30, 150])))) for i in range(600)]
    rows += [(600 + i, f"copy{i}", varied(rng, rows[i][2].split(), 1)) for i in range(60)]
    df = spark.createDataFrame([(o, i, t, "") for o, i, t in rows], "ord int, id string, ci_log string, fix_diff string")
    records = durable(dedup.word_sets(df, "id", ["ord"], ["ci_log", "fix_diff"]))
    sets = durable(records.join(dedup.distinct_sets(records), "ord").selectExpr("*", "size(words) AS n_words"))
    places = dedup.meeting_places(sets, 0.85)
    met = {(r.ord, r.earlier) for r in dedup.pairs_met(places, places, 0.85).collect()}
    share = places.alias("a").join(places.alias("b"), "bucket").filter("a.ord > b.ord").select("a.ord", "b.ord").distinct().count()
    texts = {o: set(t.split()) for o, _, t in rows}
    alike = {(a, b) for a in texts for b in texts if b < a and len(texts[a] & texts[b]) >= 0.85 * len(texts[a] | texts[b])}
    assert len(alike) >= 40 and alike <= met and share < 500  # of 217,470 pairs
    assert run(spark, rows) == greedy(rows)


def test_wide_sketches_rule_out_large_sets_and_lose_none(spark):
    """Sets of so many words that 64 bits say nothing: only pairs that may be alike have their words fetched."""
    rng = random.Random(6)
    common = [f"c{i}" for i in range(400)]
    rows = [(i, f"id{i}", " ".join(common + words(rng, 800))) for i in range(30)]
    rows += [(100 + i, f"copy{i}", varied(rng, rows[i][2].split(), 20 + 20 * i)) for i in range(6)]
    df = spark.createDataFrame([(o, i, t, "") for o, i, t in rows], "ord int, id string, ci_log string, fix_diff string")
    sets = durable(
        dedup.word_sets(df, "id", ["ord"], ["ci_log", "fix_diff"])
        .select("ord", "words").selectExpr("*", "size(words) AS n_words").withColumn("wide", dedup.wide_sketch(F.col("words")))
    )
    every = sets.select("ord").crossJoin(sets.select(F.col("ord").alias("earlier"))).filter("earlier < ord")
    texts = {o: set(t.split()) for o, _, t in rows}
    alike = {(a, b) for a in texts for b in texts if b < a and len(texts[a] & texts[b]) >= 0.85 * len(texts[a] | texts[b])}
    for same_id in (False, True):
        left = {tuple(r) for r in dedup.close(every.withColumn("same_id", F.lit(same_id)), sets, sets, 0.85).select("ord", "earlier").collect()}
        assert len(left) == every.count() if same_id else len(alike) >= 4 and alike <= left and len(left) <= 8
    assert run(spark, rows) == greedy(rows)


def test_a_batch_reads_only_sets_ahead_of_it(spark, monkeypatch):
    """Over all batches the table is read about once, not once for each batch."""
    rng = random.Random(8)
    bases = [words(rng, 40) for _ in range(30)]
    rows = [(i, f"id{i}", varied(rng, bases[i % 30], rng.randrange(1, 9))) for i in range(150)]
    seen, real = [], dedup.similar

    def looked_at(later, earlier, ours, theirs, threshold):
        seen.append((ours.agg(F.min("ord")).first()[0], theirs.agg(F.max("ord")).first()[0], earlier.agg(F.max("ord")).first()[0], ours is theirs))
        return real(later, earlier, ours, theirs, threshold)

    monkeypatch.setattr(dedup, "similar", looked_at)
    assert run(spark, rows, batch_rows=20) == greedy(rows)
    across = [s for s in seen if not s[3]]
    assert len(across) >= 2
    for first, read, met, _ in across:
        assert read < first and (met is None or met < first)


def test_sketches_rule_out_sets_of_thousands_of_words(spark):
    """Sets of more words than 512 bits can tell apart, on both sides of a size at which sketches widen."""
    rng = random.Random(7)
    common = [f"c{i}" for i in range(900)]
    rows = [(i, f"id{i}", " ".join(common + words(rng, 2800 + 90 * (i % 10)))) for i in range(20)]
    rows += [(100 + i, f"copy{i}", varied(rng, rows[i][2].split(), 40 + 30 * i)) for i in range(6)]
    rows += [(200 + i, f"long{i}", rows[i][2] + " " + " ".join(words(rng, 450))) for i in range(10)]
    df = spark.createDataFrame([(o, i, t, "") for o, i, t in rows], "ord int, id string, ci_log string, fix_diff string")
    sets = durable(dedup.sketched(dedup.word_sets(df, "id", ["ord"], ["ci_log", "fix_diff"]).selectExpr("*", "size(words) AS n_words")))
    assert {r.n for r in sets.selectExpr("size(wide) AS n").collect()} == {64, 128}
    every = sets.select("ord").crossJoin(sets.select(F.col("ord").alias("earlier"))).filter("earlier < ord").withColumn("same_id", F.lit(False))
    left = {tuple(r) for r in dedup.close(every, sets, sets, 0.85).select("ord", "earlier").collect()}
    texts = {o: set(t.split()) for o, _, t in rows}
    alike = {(a, b) for a in texts for b in texts if b < a and len(texts[a] & texts[b]) >= 0.85 * len(texts[a] | texts[b])}
    assert len(alike) >= 15 and alike <= left and len(left) <= len(alike) + 10  # of 630 pairs
    assert run(spark, rows) == greedy(rows)


def test_a_set_gives_signatures_of_two_pairs_of_sizes():
    """Two sets of one size class meet in the signatures that they have with the classes beside it."""
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (100, 300, 1000)]
    keys, owners = signatures.signs_of(np.concatenate(sets), np.array([len(s) for s in sets]), np.zeros(64, np.int64), 0.85)
    given = np.bincount(owners)
    assert all(given < [45, 125, 410])
    for s in sets:
        n = int(len(s) * 0.15 / 1.85)  # of each, so that 0.85 are shared
        other = np.concatenate([s[n:], rng.integers(0, 2**63, n).astype(np.uint64)])
        both, of = signatures.signs_of(np.concatenate([s, other]), np.array([len(s)] * 2), np.zeros(64, np.int64), 0.85)
        assert set(both[of == 0]) & set(both[of == 1])


def scratch_tables(spark):
    place = spark._jvm.org.apache.hadoop.fs.Path(spark.conf.get("spark.checkpoint.dir"))
    return {str(f.getPath()) for f in place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)}


def test_an_increment_leaves_its_index_and_no_scratch_tables(spark, tmp_path):
    rng = random.Random(12)
    rows = [(i, f"id{i}", " ".join(words(rng, 20))) for i in range(30)]
    rows += [(30 + i, f"jd{i}", varied(rng, rows[i][2].split(), 1)) for i in range(10)]
    before = scratch_tables(spark)
    assert increments(spark, rows, [rows[:20], rows[20:]], str(tmp_path / "index")) == greedy(rows)
    assert scratch_tables(spark) == before


def test_a_step_removes_only_its_own_tables(spark):
    outer = scratch_path(spark, "outer")
    spark.range(1).write.parquet(outer)
    with pytest.raises(ValueError), step(spark):
        made = durable(spark.range(3))
        with step(spark):
            durable(spark.range(2))
        assert made.count() == 3
        between = scratch_tables(spark)
        raise ValueError
    left = scratch_tables(spark)
    assert len(between - left) == 1 and left < between and spark.read.parquet(outer).count() == 1


def test_increments_write_word_sets_once_and_do_not_move_them(spark, tmp_path, monkeypatch):
    """Besides the index, one table of whole sets is written for each increment, and copies of sets that meet others."""
    rng = random.Random(13)
    rows = [(i, f"id{i}", " ".join(words(rng, 30))) for i in range(60)]
    rows += [(60 + i, f"jd{i}", rows[i][2]) for i in range(5)] + [(70 + i, f"kd{i}", varied(rng, rows[i][2].split(), 1)) for i in range(5)]
    written, real = [], dedup.durable

    def counted(df):
        out = real(df)
        if "words" in df.columns:
            written.append(out.count())
        return out

    monkeypatch.setattr(dedup, "durable", counted)
    assert increments(spark, rows, [rows[:40], rows[40:]], str(tmp_path / "index")) == greedy(rows)
    whole_sets = [n for n in written if n >= 25]
    assert whole_sets == [40, 30] and len(written) == 4


def test_lists_too_long_to_be_sent_give_the_same_rows(spark, tmp_path, monkeypatch):
    rng = random.Random(14)
    base = words(rng, 40)
    rows = [varied(rng, base, i % 9) for i in range(25)] + [" ".join(words(rng, 30)) for _ in range(15)]
    rows = [(i, f"id{rng.randrange(30)}" if i % 3 else f"own{i}", t) for i, t in enumerate(rows + rows[:10])]
    monkeypatch.setattr(dedup, "SENT_ROWS", 0)
    assert increments(spark, rows, [rows[:20], rows[20:]], str(tmp_path / "index")) == greedy(rows)
