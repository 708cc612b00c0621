"""The registered queries against their SQL twins, and the pipeline against brute force."""

import os
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from batchwork.llm import sentencepiece, toxicity
from batchwork.llm.common import load
from batchwork.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_its_sql(spark, key):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        p = f"{SF}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    got = QUERIES[key](spark, SF)
    want = con.sql(ORACLES[key])
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    order = [want.columns.index(c) for c in names]
    assert sorted(str(tuple(r[c] for c in names)) for r in got.collect()) == sorted(str(tuple(r[i] for i in order)) for r in want.fetchall())


def test_every_operator_has_its_query():
    assert [int(re.match(r"op(\d+)_", k)[1]) for k in sorted(QUERIES, key=lambda k: int(re.match(r"op(\d+)_", k)[1]))] == list(range(1, 14))


def brute_pipeline(rows, scores, items):
    rows = [(i, t) for i, t in rows if scores[i] < 0.5]
    first = {}
    for i, t in sorted(rows):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), i)
    rows = [(i, t) for i, t in rows if i in set(first.values())]

    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(FOLD))
        return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    sets, root = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            common = len(sets[a] & sets[b]) if b < a else 0
            if common and 100 * common >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    rows = [(i, t) for i, t in rows if find(i) == i]

    def split(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(FOLD))
    windows = {tuple(w[s:s + 10]) for w in map(split, items) if w for s in range(max(len(w) - 9, 1))}
    sizes = {len(x) for x in windows}
    return [(i, t) for i, t in rows if not any(tuple(w[s:s + n]) in windows for w in [split(t)] for n in sizes for s in range(len(w) - n + 1))]


def test_pipeline_equals_brute_force(spark):
    import sentencepiece as library
    docs = load(spark, SF, "documents")
    model = toxicity.fit(docs, load(spark, SF, "labels"))
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    kept = brute_pipeline([(r.doc_id, r.text) for r in docs.collect()], scores, [r.text for r in load(spark, SF, "benchmark").collect()])
    assert 0 < len(kept) < docs.count()
    lib = library.SentencePieceProcessor(model_file=sentencepiece.MODEL)
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: r.ids for r in got} == {i: lib.encode(t) for i, t in kept} and len(got) == len(kept)


def test_stages_keep_the_columns_and_clean_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, id string, score double, text_hash long"
    rows = [(i, t, "en", "s", 1, "x", 0.5, 3) for i, t in ((1, None), (2, ""), (3, "a clean text of some words"), (3, "another clean text under one id"), (None, "no id at all"))]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        kept = {r.text or "" for r in out.collect()}
        assert kept == {"", *(t for _, t, *_ in rows if t)}, name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    assert corpus_pipeline.tokens(spark, docs, SF).count() == len(rows)


def test_tokens_are_decoded_again(spark):
    docs = spark.createDataFrame([(1, "Some  text\n漢字 😀"), (2, None), (None, "x")], "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s")})
    got = {r.doc_id: (r.decoded_chars, r.round_trip) for r in corpus_pipeline.tokens(spark, docs, SF).collect()}
    assert got == {1: (15, True), 2: (0, True), None: (1, True)}


def test_stages_drop_null_ids_too(spark):
    """Contaminated, copied and nearly copied rows without an id go; one stays where no row of the group has one."""
    item = max((r.text for r in load(spark, SF, "benchmark").collect()), key=lambda t: len(t or ""))
    near = " ".join(f"n{k}" for k in range(60))
    alone = " ".join(f"m{k}" for k in range(60))
    rows = [(1, "a copied text"), (None, "a  copied text"), (None, "a copied text"), (None, "no other id"), (None, "no  other id"), (None, "no other id"),
            (2, near), (None, near + " x"), (None, near + " x"), (None, alone), (None, alone + " y"), (None, alone.upper()), (None, alone),
            (None, f"words before {item} words after"), (None, "clean and single"), (None, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", f"s{k}", 1) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")

    def kept(stage, some):
        out = stage(spark, some, SF)
        assert out.columns == some.columns
        return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    exact = kept(corpus_pipeline.exact, docs)
    assert len(exact) == 10 and [t for i, t in exact if (t or "").replace("  ", " ") in ("a copied text", "no other id")][:1] == ["a copied text"]
    assert sorted(re.sub(" +", " ", t or "") for i, t in exact) == sorted({re.sub(" +", " ", t or "") for _, t in rows})
    left = kept(corpus_pipeline.near, docs)
    assert [(i, t) for i, t in left if t and t.startswith("n0")] == [(2, near)]
    assert sum((t or "").lower().startswith("m0") for _, t in left) == 1
    assert sum(not t for _, t in left) == 2 and (None, "clean and single") in left and (1, "a copied text") in left
    assert kept(corpus_pipeline.decontaminate, docs) == sorted((r for r in rows if item not in (r[1] or "")), key=str)
