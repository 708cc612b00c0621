"""Language identification, ranked search and whitening against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from batchwork.llm import language_id, ranked_search, whitening
from batchwork.llm.common import load
from batchwork.llm.queries import QUERIES
from batchwork.llm.sentencepiece import read_model
from batchwork.session import scratch_path

SMALL = "/root/testdata/sf0.01"
CLASH = "doc_id long, text string, lang string, score string, row int, id string, h string, lang_pred string"


def clash(spark, rows):
    return spark.createDataFrame([(i, t, la, "s", 1, "i", "h", "p") for i, t, la in rows], CLASH)


# language identification

@pytest.fixture(scope="module")
def pieces():
    raw = language_id.load_model()
    vocabulary = language_id.Vocabulary(raw)
    plain = sorted({p.encode() for p in read_model(raw).ids})
    plain = [p for p in plain if language_id.MARK not in p[1:] and p != language_id.MARK and len(p) > 1]
    probability = np.random.default_rng(5).random((vocabulary.size, 3))
    return vocabulary, {p: 256 + i for i, p in enumerate(plain)}, probability / probability.sum(0)


def piece_of(ids, part):
    return part[0] if len(part) == 1 else ids.get(part)


def flat(texts):
    marked = [language_id.MARK + t.encode() for t in texts]
    return np.frombuffer(b"".join(marked), np.uint8), np.array([len(m) for m in marked])


def test_forward_sums_all_segmentations(pieces):
    vocabulary, ids, p = pieces
    texts = ["the", "ciónrr", "a", "ünß", "thtion漢", "b" * 300, "the" * 40]
    got = language_id.Lattice(vocabulary, *flat(texts)).scores(p)
    for row, t in zip(got, texts):
        w = language_id.MARK + t.encode()
        for k in range(3):
            f, log = [1.0] + [0.0] * len(w), 0.0
            for end in range(1, len(w) + 1):
                f[end] = sum(f[s] * p[i, k] for s in range(max(0, end - 40), end) if (i := piece_of(ids, w[s:end])) is not None)
                if f[end] < 1e-200:  # in step with the window that later ends look back to
                    f, log = [x * 1e100 if x < 1e100 else 0.0 for x in f], log - 100 * math.log(10)
            assert row[k] == pytest.approx(math.log(f[-1]) + log, rel=1e-9)


def test_expected_counts_equal_enumeration(pieces):
    vocabulary, ids, p = pieces

    def segmentations(w):
        if not w:
            yield []
        for end in range(1, len(w) + 1):
            i = piece_of(ids, w[:end])
            if i is not None:
                yield from ([i] + rest for rest in segmentations(w[end:]))
    texts, counts, want = ["the", "cióne", "a", "ünß"], np.array([2, 3, 1, 5]), np.zeros(vocabulary.size)
    for t, n in zip(texts, counts):
        ways = [(math.prod(p[i, 1] for i in s), s) for s in segmentations(language_id.MARK + t.encode())]
        total = sum(q for q, _ in ways)
        for q, s in ways:
            for i in s:
                want[i] += n * q / total
    got = language_id.Lattice(vocabulary, *flat(texts)).expected(p[:, 1], counts)
    assert np.abs(got - want).max() < 1e-9


def test_language_on_held_out_rows(spark):
    rows = QUERIES["op11_language_id"](spark, SMALL).join(load(spark, SMALL, "documents").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 200 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_odd_rows(spark):
    odd = [(1, None, "aa"), (2, "", "aa"), (3, " 12 — !\n", "bb"), (4, "x" * 3000, "aa"), (5, "word " * 20_000, "aa"), (6, "É ﬁ 漢 😀 \x00 ▁", None), (6, "É ﬁ 漢 😀 \x00 ▁", None),
           (None, "WORD word", "aa"), (7, "другое слово", "bb"), (8, "Другое", None)]
    docs = clash(spark, odd)
    model = language_id.fit(docs)
    out = language_id.identify(docs, model)
    assert out.columns == [c for c in docs.columns if c not in ("lang_pred", "score")] + ["lang_pred", "score"]
    got = [(r.doc_id, r.text, r.lang_pred, r.score) for r in out.collect()]
    assert sorted(x[0] or 0 for x in got) == sorted(x[0] or 0 for x in odd)
    for i, t, lang, score in got:
        assert (lang == "und" and score == 0) == (i in (1, 2, 3)) and 0 <= score <= 1
    assert {lang for i, _, lang, _ in got if i in (5, None)} == {"aa"} and {lang for i, _, lang, _ in got if i in (7, 8)} == {"bb"}
    # nothing learned, nothing to judge, and names of one's own
    none = language_id.fit(clash(spark, []))
    assert {(r.l, r.s) for r in language_id.identify(docs, none, lang_out="l", score_out="s").collect()} == {("und", 0.0)}
    assert language_id.identify(clash(spark, []), model).count() == 0
    assert language_id.fit(docs, known=F.col("doc_id") < 0).languages == []


def test_equal_evidence_goes_to_the_first_name(spark):
    docs = clash(spark, [(1, "same text", "zz"), (2, "same text", "aa")])
    assert {r.lang_pred for r in language_id.identify(docs, language_id.fit(docs)).collect()} == {"aa"}


def test_sample_counts_a_text_once(spark):
    """A text that fills most of a language neither crowds the sample nor empties it."""
    docs = clash(spark, [(i, "immer gleich" if i % 10 else f"wort{i} ding", "de") for i in range(2000)] + [(i, f"thing{i} word", "en") for i in range(200)])
    take, counted = language_id.training_rows(docs, F.lit(True), "text", "lang", 100, 10)
    assert [(r.lang, r.n) for r in counted] == [("de", 2000), ("en", 200)]
    per = {r.lang: r["count"] for r in take.groupBy("lang").count().collect()}
    assert 50 < per["de"] < 160 and 50 < per["en"] < 160
    only = language_id.training_rows(docs.where("doc_id % 10 = 1 and lang = 'de'"), F.lit(True), "text", "lang", 100, 10)[0]
    assert only.count() == 1
    assert [r.lang for r in language_id.training_rows(docs, F.lit(True), "text", "lang", 100, 1)[1]] == ["de"]


# ranked search

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(FOLD))


def brute_search(docs, queries, k):
    held = [(i, Counter(split(t))) for i, t in docs if split(t)]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for item, text in queries:
        asked.setdefault(item, set()).update(split(text))
    out = []
    for item, terms in asked.items():
        found = []
        for i, c in held:
            m = 10 + 90 * sum(c.values()) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if s > 0:
                found.append((-s, i is None, i))
        found.sort(key=lambda x: x[:2] + ((x[2],) if x[2] is not None else ()))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(found[:k], 1)]
    return out


def same(got, want):
    return sorted(map(str, got)) == sorted(map(str, want))


@pytest.mark.parametrize("seed", range(3))
def test_search_equals_brute_force(spark, monkeypatch, seed):
    """Many shards, windows, lists of several blocks, ties, repeated and missing ids."""
    rnd = random.Random(seed)
    monkeypatch.setattr(ranked_search, "SHARD_BYTES", 20_000)
    monkeypatch.setattr(ranked_search, "BLOCK", 8)
    monkeypatch.setattr(ranked_search, "WINDOWS", (4, 16, 64))
    common, rare = ["the", "of", "É漢", "a1"], [f"w{j}" for j in range(300)]

    def text():
        return " ".join(rnd.choice(common) if rnd.random() < 0.5 else rnd.choice(rare) for _ in range(rnd.randint(0, 40)))
    docs = [(rnd.choice([None, *range(500)]), text()) for _ in range(800)] + [(rnd.randint(0, 999), "The copy of w7 W8") for _ in range(200)]
    docs += [(1000, None), (1001, ""), (1002, "!? \n"), (1003, "w1 " * 30_000)]
    queries = [(j, text()) for j in range(12)] + [(20, None), (21, "nowhere"), (22, "w1"), (None, "w7 the"), (None, "of"), (23, "the the OF")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, term string, score int").repartition(3)
    found = ranked_search.search(ranked_search.build_index(df), spark.createDataFrame(queries, "item_id long, text string"), k=10)
    assert same([tuple(r) for r in found.collect()], brute_search(docs, queries, 10))


def test_search_in_blocks_of_queries_and_text_ids(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "QUERY_TERMS", 8)
    docs = [(f"d{i}", f"alpha w{i % 7} w{i % 3} beta") for i in range(60)] + [(None, "alpha w1")]
    queries = [(f"q{j}", f"w{j} alpha") for j in range(9)]
    path = scratch_path(spark, "index")
    ranked_search.build_index(spark.createDataFrame(docs, "name string, body string"), path, id_col="name", text_col="body")
    found = ranked_search.search(ranked_search.open_index(spark, path), spark.createDataFrame(queries, "item_id string, text string"), k=3)
    assert same([tuple(r) for r in found.collect()], brute_search(docs, queries, 3))


def test_search_of_empty_tables(spark):
    some, none = spark.createDataFrame([(1, "word")], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, text string")
    for docs, queries in ((none, some), (some, none), (none, none), (spark.createDataFrame([(1, "!")], "doc_id long, text string"), some)):
        assert ranked_search.search(ranked_search.build_index(docs), queries, item_col="doc_id").count() == 0


def test_most_blocks_stay_packed(spark):
    """A query of a rare and a common word: block maxima keep most of the common list packed."""
    rnd = random.Random(3)
    shard = ranked_search._Shard(20_000, 20_000 * 12)
    import pyarrow as pa
    texts = ["common " * rnd.randint(1, 3) + "filler " * 9 + ("rare" if i % 4000 == 7 else "") for i in range(20_000)]
    shard.add(pa.array(range(20_000)), pa.array(texts))
    lists = ranked_search._Lists(pa.Table.from_batches(list(shard.rows(0, pa.int64()))))
    h = {w: int(ranked_search.words.Hasher(ranked_search.words.ALNUM).words(*ranked_search.words.text_bytes(pa.array([w])))[0].view(np.int64)[0]) for w in ("rare", "common")}
    hits, floor = ranked_search._search_shard(lists, [(h["rare"], 9000), (h["common"], 5)], 3, 1), 1
    got, best = next(hits, None), []
    while got is not None:
        best = sorted(best + got[1].tolist(), reverse=True)[:3]
        try:
            got = hits.send(best[-1] if len(best) == 3 else 1)
        except StopIteration:
            got = None
    blocks = -(-20_000 // ranked_search.BLOCK)
    assert len(best) == 3 and len(lists.unpacked) < 0.7 * blocks


# whitening

def known_matrix(values, seed=0):
    d = len(values)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0].astype(np.longdouble)
    for _ in range(4):
        q = q @ (1.5 * np.eye(d) - 0.5 * q.T @ q)
    a = (q * np.array(values, np.longdouble)) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("gap", [0, 1e-2, 1e-5, 1e-8, 1e-11])
def test_refined_eigenvectors_of_clusters(gap):
    values = [3, 3 - gap, 3 - 2 * gap, 3 - 3 * gap, 1 + gap, 1, *np.linspace(0.1, 0.9, 34)]
    a = known_matrix(values)
    e, x = whitening.refined_eigen(a)
    assert np.abs(e - np.sort(np.array(values, np.longdouble))[::-1]).max() < 1e-17
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 1e-17 and np.abs(a @ x - x * e).max() < 1e-17
    if gap == 1e-8:  # float32 alone can't tell the cluster's vectors apart
        first = np.linalg.eigh(a.astype(np.float32))[1][:, -1]
        assert abs(float(first @ x[:, 0])) < 0.999
    assert np.abs(np.abs(np.diag(x.T @ a @ x)) - np.abs(e)).max() < 1e-17


def brute_whitening(vectors, components=16):
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], object)
    fit = sorted({tuple(r) for r in x.tolist()})
    n, d = len(fit), len(fit[0])
    sums = [sum(r[j] for r in fit) for j in range(d)]
    centred = np.array([[(n * r[j] - sums[j]) / n for j in range(d)] for r in fit])
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    order = np.argsort(-e)[:components]
    order = order[e[order] > 1e-9 * e.sum()]
    white = [[sum((n * r[j] - sums[j]) / n * u[j, k] for j in range(d)) / math.sqrt(e[k]) for k in order] for r in x.tolist()]
    return n, [sum((n * r[j] - sums[j]) ** 2 for j in range(d)) for r in x.tolist()], np.array(white), e[order] / e.sum()


def test_whitening_equals_brute_force(spark):
    rnd = np.random.default_rng(2)
    vectors = (rnd.normal(size=(150, 20)) * np.linspace(1, 4, 20)).tolist()
    vectors += [vectors[0]] * 40
    bad = [None, [], [1.0] * 19 + [None], [float("nan")] * 20, [float("inf")] + [0.0] * 19, [1.0] * 3]
    rows = [(i, v, "a", 1) for i, v in enumerate(vectors)] + [(None, vectors[1], "a", 1)] + [(1000 + i, v, "a", 1) for i, v in enumerate(bad)]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>, component string, n int")).toPandas()
    n, deviation, white, explained = brute_whitening(vectors + [vectors[1]])
    assert len(out) == 191 * 16 and set(out.n) == {n} and out.identity_error.max() < 1e-12
    ids = [*range(190), None]
    for k in range(16):
        mine = out[out.component == k + 1]
        got = np.array([mine[mine.id.isna() if i is None else mine.id == i].whitened.iloc[0] for i in ids])
        sign = 1 if abs(got - white[:, k]).max() < abs(got + white[:, k]).max() else -1
        assert np.abs(sign * got - white[:, k]).max() < 1e-9 and abs(mine.explained.iloc[0] - explained[k]) < 1e-12
    assert [int(out[(out.id == i) & (out.component == 1)].deviation.iloc[0]) for i in range(190)] == deviation[:190]


def test_whitening_of_few_and_flat_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]):
        assert whitening.whiten(spark.createDataFrame(rows, schema)).count() == 0
    out = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0, 0.0]), (2, [3.0, 2.0, 0.0]), (2, [3.0, 2.0, 0.0])], schema)).collect()
    assert [(r.id, r.component) for r in sorted(out, key=lambda r: r.id)] == [(1, 1), (2, 1), (2, 1)]
    assert all(abs(abs(r.whitened) - 1) < 1e-12 and r.explained == pytest.approx(1) for r in out)


def test_whitening_of_huge_entries(spark):
    rows = [(i, [1e30 if i == 0 else float(i), float(i * i)]) for i in range(6)]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.id for r in out} == set(range(6)) and all(r.deviation is None for r in out)
    far = [(i, [float(i) * 1e6, float(i % 7) * 1e5]) for i in range(2000)]
    got = {r.id: r.deviation for r in whitening.whiten(spark.createDataFrame(far, "vec_id long, embedding array<double>")).where("component = 1").collect()}
    want = brute_whitening([v for _, v in far])[1]
    assert [got[i] for i in range(2000)] == [x if x < 1 << 63 else None for x in want]


def test_whitening_names_vectors_of_the_commonest_length(spark):
    rows = [(i, [float(i), 1.0 / (i + 1)]) for i in range(5)] + [(9, [1.0, 2.0, 3.0])]
    assert {r.id for r in whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()} == set(range(5))
