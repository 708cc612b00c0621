"""Exact, near and passage deduplication against brute force."""

import hashlib
import os
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from batchwork.llm import common, exact_dedup, jaccard_join, suffix_dedup

SCHEMA = "doc_id long, text string, digest string, n long, id string, rank int"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))


def table(spark, rows):
    """Documents with extra columns whose names clash with those used inside."""
    return spark.createDataFrame([(i, t, "x", 7, "y", 1) for i, t in rows], SCHEMA)


def corpus(seed=5):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rnd.choice(vocabulary) for _ in range(60)]
    rows = []
    for i in range(0, 200, 4):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([1, 3, 4, 5, 6, 40, 120, 300]))]
        edited = list(base)
        for _ in range(max(1, len(base) // 60)):
            edited[rnd.randrange(len(edited))] = "EDIT"
        holder = [rnd.choice(vocabulary) for _ in range(30)] + passage + [rnd.choice(vocabulary) for _ in range(30)]
        rows += [(i, " ".join(base)), (i + 1, "\n".join(edited)), (i + 2, "  ".join(base).upper()), (i + 3, " ".join(holder))]
    long = [rnd.choice(vocabulary) for _ in range(60_000)]
    rows += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, ""), (1004, " ".join(long)), (1005, " ".join(long[:59_900])),
             (1006, "a" * 300_000), (1007, "É é ﬁ 漢字 \x1c x"), (1007, "É é ﬁ 漢字 \x1c x"), (3, rows[0][1]), (None, rows[0][1]), (None, "only null id here")]
    family = [rnd.choice(vocabulary) for _ in range(100)]
    for i in range(2000, 2120):
        member = list(family)
        member[rnd.randrange(100)] = f"u{i}"
        rows.append((i, " ".join(member)))
    return rows


def brute_components(rows):
    sets = []
    for _, t in rows:
        w = split(t)
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[find(a)] = min(i, least.get(find(a), i))
    return sorted(((i, len(sets[a]), least.get(find(a)) if sets[a] else i) for a, (i, _) in enumerate(rows)), key=str)


def test_jaccard_components_match_brute_force(spark):
    rows = corpus()
    got = jaccard_join.jaccard_components(table(spark, rows), count_bits=16)
    assert sorted(map(tuple, got.select("id", "n_shingles", "component").collect()), key=str) == brute_components(rows)


def test_jaccard_regions_come_from_the_distinct_sets(spark, monkeypatch):
    """Pivots of tokens are aggregated over one posting per set, not taken by a window over the documents."""
    seen, write = {}, jaccard_join.write_scratch
    monkeypatch.setattr(jaccard_join, "write_scratch", lambda df, name: seen.update({name: df}) or write(df, name))
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(words)) for i in range(50)] + [(50, " ".join(words[:39] + ["x"]))]
    got = jaccard_join.jaccard_components(table(spark, rows), count_bits=16)
    assert {r.component for r in got.collect()} == {0}
    regions = seen["jaccard-regions"]
    assert "Window" not in regions._jdf.queryExecution().toString()
    assert regions.inputFiles() and all("jaccard-points" in f for f in regions.inputFiles())


def test_jaccard_hot_shingle_among_unlike_texts(spark):
    """Short texts that share most of a passage: many regions stay open and take more pivots."""
    rnd = random.Random(2)
    passage = [f"p{i}" for i in range(12)]
    rows = [(i, " ".join(passage[:rnd.randint(5, 12)] + [f"x{rnd.randint(0, 3)}" for _ in range(rnd.randint(0, 4))])) for i in range(150)]
    got = jaccard_join.jaccard_components(table(spark, rows), count_bits=16)
    assert sorted(map(tuple, got.select("id", "n_shingles", "component").collect()), key=str) == brute_components(rows)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(-40, 40)] + [(100, 200), (200, 300), (100, 300)], "a long, b long")
    got = dict(map(tuple, jaccard_join.components(edges, "chain").select("node", "root").collect()))
    assert got == {**{i: -40 for i in range(-40, 41)}, 100: 100, 200: 100, 300: 100}


def test_prefix_size_meets_the_threshold():
    # 4 of 5 shared: sets of 4 and 5 may be linked, so one token is needed of 4 and two of 5
    assert [jaccard_join.prefix_size(n, 80) for n in (1, 4, 5, 10, 100)] == [1, 1, 2, 3, 21]


def test_components_never_returns_split_ones(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(80)], "a long, b long")
    with pytest.raises(RuntimeError, match="still changing"):
        jaccard_join.components(edges, "short", most_rounds=2)


def test_keep_one_keeps_rows_and_columns(spark):
    rows = corpus()
    docs = table(spark, rows)
    kept = jaccard_join.keep_one(docs, count_bits=16)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _, c in brute_components(rows) if i is None or i == c)


def brute_exact(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    out = []
    for (i, _), t in zip(rows, norm):
        ids = [j for (j, _), u in zip(rows, norm) if u == t]
        keep = min((j for j in ids if j is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def test_exact_dedup_matches_brute_force(spark):
    rows = corpus()
    got = exact_dedup.exact_dedup(table(spark, rows))
    assert sorted(map(tuple, got.select("id", "keep_id", "group_size", "kept", "digest").collect()), key=str) == brute_exact(rows)


def test_exact_dedup_checks_full_texts_when_digests_collide(spark):
    """A digest of three values: every hit must be told apart by its text."""
    rows = [r for r in corpus() if r[0] is not None]
    got = exact_dedup.exact_dedup(table(spark, rows), digest=lambda norm: (F.length(norm) % 3).cast("string"))
    want = [r[:4] for r in brute_exact(rows)]
    assert sorted(map(tuple, got.select("id", "keep_id", "group_size", "kept").collect()), key=str) == sorted(want, key=str)


def test_exact_dedup_state_survives_a_second_run_of_the_stream(spark, tmp_path):
    """Rows that come later meet the state that earlier batches left."""
    from batchwork.session import scratch_path
    source = scratch_path(spark, "late-rows")
    exact_dedup.digest_rows(table(spark, [(5, "a  b"), (6, "c")])).coalesce(1).write.parquet(source)
    exact_dedup.digest_rows(table(spark, [(2, "a b"), (9, "c")])).coalesce(1).write.mode("append").parquet(source)
    schema = spark.read.parquet(source).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    state = exact_dedup.stream_state(stream, "late").select("id", "n").collect()
    assert sorted(map(tuple, state)) == [(2, 2), (6, 2)]


def test_keep_first(spark):
    rows = corpus()
    docs = table(spark, rows)
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _, _, k, _ in brute_exact(rows) if k or i is None)


def brute_passages(rows, n=50):
    by_id = {}
    for i, t in rows:
        by_id.setdefault((i, t or ""), split(t))
    holders = {}
    for (i, _), w in by_id.items():
        for s in range(len(w) - n + 1):
            holders.setdefault(tuple(w[s:s + n]), set()).add(i)
    out = set()
    for (i, _), w in by_id.items():
        flags = [False] * (len(w) + 1)
        for s in range(len(w) - n + 1):
            if len(holders[tuple(w[s:s + n])]) > 1:
                flags[s:s + n] = [True] * n
        start = None
        for x, f in enumerate(flags):
            if f and start is None:
                start = x
            elif not f and start is not None:
                out.add((i, start, x - start))
                start = None
    return out


@pytest.mark.parametrize("partitions", ["1", "13"])
def test_passages_match_brute_force(spark, partitions):
    rows = corpus()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = suffix_dedup.repeated_passages(table(spark, rows))
        assert {tuple(r) for r in got.select("id", "start_word", "n_words").collect()} == brute_passages(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_passages_one_word_under_and_at_the_limit(spark):
    shared = [f"s{i}" for i in range(50)]
    rows = [(1, " ".join(["a"] * 70 + shared[:49] + ["b"] * 70)), (2, " ".join(["c"] * 70 + shared[:49] + ["d"] * 70)),
            (3, " ".join(["e"] * 30 + shared + ["f"] * 30)), (4, " ".join(["g"] * 33 + shared + ["h"] * 9))]
    got = suffix_dedup.repeated_passages(table(spark, rows))
    assert {tuple(r) for r in got.select("id", "start_word", "n_words").collect()} == {(3, 30, 50), (4, 33, 50)}


def test_empty_tables(spark):
    empty = table(spark, [])
    assert exact_dedup.exact_dedup(empty).count() == 0
    assert exact_dedup.keep_first(empty).count() == 0
    assert jaccard_join.jaccard_components(empty).count() == 0
    assert suffix_dedup.repeated_passages(empty).count() == 0
    nothing = table(spark, [(1, None), (2, ""), (3, " ")])
    assert sorted(map(tuple, jaccard_join.jaccard_components(nothing).select("id", "n_shingles", "component").collect())) == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]
    assert suffix_dedup.repeated_passages(nothing).count() == 0


def test_sketch_never_counts_more_than_the_sets_differ():
    rnd = random.Random(3)
    for size in (1, 20, 400, 30_000):
        a = np.array([rnd.getrandbits(64) for _ in range(size)], np.uint64)
        b = np.concatenate([a[size // 7:], np.array([rnd.getrandbits(64) for _ in range(size // 9)], np.uint64)])
        one, two = (jaccard_join.sketch(jaccard_join.profile(np.unique(s))) for s in (a, b))
        assert sum(bin((x ^ y) & (1 << 64) - 1).count("1") for x, y in zip(one, two)) <= len(set(a.tolist()) ^ set(b.tolist()))


def test_regions_whose_members_hang_together_need_no_further_rounds(spark, monkeypatch):
    """Pairs that share a rare shingle by chance: one member beside the pivot has nobody left to meet."""
    rnd, written = random.Random(11), []
    rows = []
    for i in range(0, 40, 2):
        shared = [f"s{i}_{k}" for k in range(5)]
        rows += [(i + j, " ".join(shared + [f"t{rnd.random()}" for _ in range(30)])) for j in (0, 1)]
    monkeypatch.setattr(jaccard_join, "write_scratch", lambda df, name, write=jaccard_join.write_scratch: written.append(name) or write(df, name))
    got = jaccard_join.jaccard_components(table(spark, rows), count_bits=16)
    assert sorted(map(tuple, got.select("id", "n_shingles", "component").collect()), key=str) == brute_components(rows)
    assert not [n for n in written if n.startswith("jaccard-members")]


def test_scratch_writes_leave_no_shuffle_files(spark):
    """A job of many rounds would else hold every round's shuffle files until the driver collects garbage."""
    folder = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {x for d in folder.localDirs() for _, _, names in os.walk(d.getPath()) for x in names if x.startswith("shuffle_")}
    a = spark.range(2000).withColumn("k", F.col("id") % 97)
    joined = a.join(a.groupBy("k").agg(F.sum("id").alias("s")).hint("merge"), "k").repartition(3, "s")
    setting, before = spark.conf.get(common.DROP_SHUFFLED), files()
    written = common.write_scratch(joined, "left-over")
    end = time.time() + 10  # executors drop them a moment later
    while time.time() < end and files() - before:
        time.sleep(0.2)
    assert files() - before == set()
    assert written.count() == 2000
    assert spark.conf.get(common.DROP_SHUFFLED) == setting
