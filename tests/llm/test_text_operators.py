"""Scores, decontamination, tokens, chat, WARC and URL filters against brute force."""

import base64
import gzip
import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from batchwork.llm import chat, decontamination, quality, sentencepiece, toxicity, url_filter, warc, words
from batchwork.llm.common import held_out, load
from batchwork.session import scratch_path

SMALL = "/root/testdata/sf0.01"
CLASH = "doc_id long, text string, score string, row int, ids string, id string, lang string, source string"


def clash(spark, rows):
    return spark.createDataFrame([(i, t, "s", 1, "i", "x", "en", None if i is None else f"src{i % 3}") for i, t in rows], CLASH)


ODD_TEXTS = [(1, None), (2, ""), (3, " \n"), (4, "x" * 200_000), (5, "word " * 50_000), (6, "É ﬁ 漢 😀 \x00 ▁"), (6, "É ﬁ 漢 😀 \x00 ▁"), (None, "no id")]


# words

@given(st.lists(st.text(alphabet="aB \n\té漢\x00", max_size=40), max_size=8))
@settings(max_examples=60, deadline=None)
def test_word_hashes_follow_the_words(texts):
    import pyarrow as pa
    hasher = words.Hasher(words.WHITESPACE)
    data, offsets = words.text_bytes(pa.array(texts, pa.string()))
    h, start, end, row = hasher.words(data, offsets)
    want = [(i, w) for i, t in enumerate(texts) for w in re.findall(r"[^\x20\x09-\x0D]+", t)]
    raw = data.tobytes()
    assert [(r, raw[a:b].decode()) for r, a, b in zip(row.tolist(), start.tolist(), end.tolist())] == want
    seen = {}
    for (_, w), x in zip(want, h.tolist()):
        assert seen.setdefault(w.replace("B", "b"), x) == x
    assert len(set(seen.values())) == len(seen)


def test_word_hashes_across_blocks(monkeypatch):
    import pyarrow as pa
    text = ["ab cd " * 50, "", "x" * 90, "ab", "cd ab"]
    whole = words.Hasher(words.WHITESPACE).words(*words.text_bytes(pa.array(text)))
    monkeypatch.setattr(words, "BLOCK_BYTES", 16)
    cut = words.Hasher(words.WHITESPACE).words(*words.text_bytes(pa.array(text)))
    assert all((a == b).all() for a, b in zip(whole, cut))


# toxicity

def test_toxicity_on_held_out_rows(spark):
    docs, labels = load(spark, "/root/testdata/sf0.1", "documents"), load(spark, "/root/testdata/sf0.1", "labels")
    scored = toxicity.score(docs, toxicity.fit(docs, labels)).join(labels, "doc_id").where(held_out("doc_id")).select("score", "toxic").collect()
    right = sum((r.score >= 0.5) == (r.toxic == 1) for r in scored)
    assert len(scored) > 300 and right / len(scored) > 0.97


def test_non_negative_risk_learns_from_unlabelled():
    rnd = np.random.default_rng(1)
    y = rnd.random(4000) < 0.2
    x = rnd.random((4000, 6)) < np.where(y[:, None], [0.9, 0.8, 0.5, 0.1, 0.5, 0.2], [0.05, 0.1, 0.5, 0.4, 0.5, 0.2])
    positives = x[:2000][y[:2000]]
    w, b = toxicity.nn_pu(np.nonzero(positives), len(positives), np.nonzero(x[2000:]), 2000, 6, 0.2)
    found = x[2000:] @ w + b > 0
    assert (found == y[2000:]).mean() > 0.93


def test_toxicity_odd_rows_and_no_labels(spark):
    docs = clash(spark, ODD_TEXTS)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    out = toxicity.score(docs, toxicity.fit(docs, none), score_col="toxic_score")
    assert out.columns == [*docs.columns, "toxic_score"] and {r.toxic_score for r in out.collect()} == {0.0} and out.count() == len(ODD_TEXTS)
    labels = spark.createDataFrame([(3, 1), (4, 0), (5, None), (6, 1), (None, 1), (6, 1)], "doc_id long, toxic int")
    out = toxicity.score(docs, toxicity.fit(docs, labels), score_col="toxic_score").collect()
    assert len(out) == len(ODD_TEXTS) and all(0 <= r.toxic_score <= 1 for r in out)
    assert toxicity.score(clash(spark, []), toxicity.fit(clash(spark, []), labels), score_col="s").count() == 0


# quality

def test_quality_on_held_out_rows(spark):
    out = quality.quality(load(spark, SMALL, "documents"), load(spark, SMALL, "labels")).withColumnRenamed("id", "doc_id")
    rows = out.join(load(spark, SMALL, "labels"), "doc_id").where(held_out("doc_id")).select("keep", "quality").collect()
    assert sum(r.keep == (r.quality == 1) for r in rows) / len(rows) > 0.95


def test_quality_shrinks_sparse_sites(spark):
    """Equal texts, so equal evidence: sites alone differ, and sparse ones stay near the whole."""
    rows = [(i, "same text here", None, 0, "", "", "en", "big-bad" if i < 400 else "big-good" if i < 800 else "tiny") for i in range(801)]
    docs = spark.createDataFrame(rows, CLASH)
    labels = spark.createDataFrame([(i, int(i >= 400)) for i in range(800)], "doc_id long, quality int")
    by = {r.source: r.s for r in quality.quality(docs, labels).join(docs.select(F.col("doc_id").alias("id"), "source"), "id")
          .where(~held_out("id")).groupBy("source").agg(F.avg("host_posterior").alias("s")).collect()}
    assert by["big-bad"] < 0.2 < 0.8 < by["big-good"] and 0.3 < by.get("tiny", 0.5) < 0.7


def test_quality_odd_rows(spark):
    labels = spark.createDataFrame([(3, 1), (4, 0), (6, None), (None, 0)], "doc_id long, quality int")
    for some in (labels, labels.limit(0)):
        out = quality.quality(clash(spark, ODD_TEXTS), some)
        assert out.count() == len(ODD_TEXTS) and all(0 <= r.score <= 1 for r in out.collect())
    assert quality.quality(clash(spark, []), labels).count() == 0


def test_ids_on_many_rows_leave_the_training_sample_bounded(spark, monkeypatch):
    """Every labelled id stands on 60 texts and 60 copies: far more rows than ids come out of the join."""
    seen = {}
    docs = clash(spark, [(i, f"same text {i}" if k < 60 else f"text {i} of words {k}") for i in range(10) for k in range(120)])
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(10)], "doc_id long, quality int, toxic int")
    logistic, nn_pu = quality.logistic, toxicity.nn_pu
    monkeypatch.setattr(quality, "logistic", lambda x, y, *a: seen.update(quality=len(y)) or logistic(x, y, *a))
    monkeypatch.setattr(toxicity, "nn_pu", lambda p, n_p, u, n_u, *a: seen.update(toxicity=max(n_p, n_u)) or nn_pu(p, n_p, u, n_u, *a))
    known = labels.select(F.col("doc_id").alias("__id"), F.col("quality").cast("double").alias("label"))
    quality.fit(docs, known, "doc_id", "text", max_train=20)
    toxicity.fit(docs, labels, max_positive=8, max_unlabelled=12)
    assert 0 < seen["quality"] <= 40 and 0 < seen["toxicity"] <= 40
    quality.fit(docs, known, "doc_id", "text")
    assert seen["quality"] == 10 * 61


# decontamination

def brute_hits(rows, items):
    def split(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for i, t in items:
        w = split(t)
        for s in range(max(len(w) - 9, 1) if w else 0):
            windows.setdefault(tuple(w[s:s + 10]), set()).add(str(i))
    out = []
    for i, t in rows:
        w, hit, found = split(t), set(), set()
        for n in {len(x) for x in windows}:
            for s in range(len(w) - n + 1):
                ids = windows.get(tuple(w[s:s + n]))
                if ids:
                    hit |= set(range(s, s + n))
                    found |= ids
        out.append((i, len(w), len(hit), len(found), sorted(found), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [200_000, 0])
def test_decontamination_matches_brute_force(spark, limit):
    rnd = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([1, 2, 3, 9, 10, 11, 30])) )) for i in range(20)]
    items += [(20, None), (21, ""), (22, items[5][1]), (None, items[6][1]), (23, "same same " * 12)]
    items = [(i, t) for i, t in items if t is None or len(t.split()) != 1 or i > 10]
    rows = [(i, " ".join([*(rnd.choice(vocabulary) for _ in range(50)), *(items[i % len(items)][1] or "").upper().split(), *(rnd.choice(vocabulary) for _ in range(9))])) for i in range(60)]
    rows += [(100, None), (100, None), (101, ""), (102, "same, " * 3000), (None, items[6][1]), (103, items[4][1].replace(" ", "-É-")), (5, items[7][1])]
    got = decontamination.decontaminate(clash(spark, rows), spark.createDataFrame(items, "item_id long, text string"), max_broadcast_rows=limit)
    got = sorted((tuple(r) for r in got.select("id", "n_words", "n_hit", "n_items", "items", "contaminated").collect()), key=str)
    want = brute_hits(rows, [(i, t) for i, t in items if i is not None])
    # a null item id marks words but has no name to list
    named = brute_hits(rows, items)
    assert [(g[0], g[1], g[2], g[5]) for g in got] == [(w[0], w[1], w[2], w[5]) for w in named]
    assert [g[4] for g in got if g[2]] == [w[4] for w, n in zip(want, named) if n[2]]


def test_decontamination_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b c d e f g h i j k")], "item_id long, text string")
    docs = clash(spark, ODD_TEXTS)
    assert decontamination.decontaminate(clash(spark, []), items).count() == 0
    assert decontamination.drop_contaminated(docs, items.limit(0)).count() == len(ODD_TEXTS)
    assert decontamination.drop_contaminated(docs, items).columns == docs.columns


def test_decontamination_plan_is_native(spark):
    docs, items = load(spark, SMALL, "documents"), load(spark, SMALL, "benchmark")
    split = decontamination.split_documents(docs)
    plan = decontamination.find_windows(split, decontamination.item_windows(items, "item_id", "text", 10))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


# SentencePiece

def library():
    import sentencepiece as library_
    return library_.SentencePieceProcessor(model_file=sentencepiece.MODEL)


def test_sentencepiece_equals_the_library(spark):
    rnd = random.Random(3)
    texts = [t for _, t in ODD_TEXTS] + ["".join(rnd.choice("  ab\n\tthe ing▁é漢😀\x00") for _ in range(rnd.randint(0, 400))) for _ in range(150)]
    texts += ["<s></s><0x41>", "the" * 4000, "  lead", "trail  ", "▁▁", "\n"]
    rows = clash(spark, [(i, t) for i, t in enumerate(texts)])
    out = sentencepiece.decode(sentencepiece.encode(rows, ids_col="tokens"), ids_col="tokens").orderBy("doc_id").collect()
    lib = library()
    assert [r.tokens for r in out] == [lib.encode(t or "") for t in texts]
    assert [r.decoded for r in out] == [lib.decode(lib.encode(t or "")) for t in texts]


def test_sentencepiece_on_documents(spark):
    rows = sentencepiece.encode(load(spark, SMALL, "documents").select("doc_id", "text")).collect()
    lib = library()
    assert [r.ids for r in rows] == lib.encode([r.text for r in rows])
    both = sentencepiece.encode(load(spark, SMALL, "documents").select("doc_id", "text"), decoded_col="back")
    assert both.where("back <> text or back is null").count() == 0


def test_sentencepiece_small_index_blocks(monkeypatch):
    monkeypatch.setattr(sentencepiece, "INDEX_CHARS", 50)
    monkeypatch.setattr(sentencepiece, "MAX_CACHED", 10)
    encoder, lib = sentencepiece.Encoder(sentencepiece.read_model(sentencepiece.load_model())), library()
    for text in ("the quick brown fox jumps over the lazy dog " * 9, "unbreakable" * 30, "a b c d e f g h i j k l m"):
        assert encoder.encode([text, "", text[:7]])[0].tolist() == lib.encode(text) + lib.encode(text[:7])


def test_unigram_relaxation_finds_the_best_path():
    pieces = ["<unk>", "a", "b", "c", "ab", "bc", "abc", "ca", "cab", "▁", "▁a"]
    rnd = random.Random(9)
    scores = [0.0] + [-rnd.random() * 5 for _ in pieces[1:]]
    model = sentencepiece.Model(pieces, np.array(scores), [2] + [1] * (len(pieces) - 1), False, True)
    encoder = sentencepiece.Encoder(model)

    def best(t):
        value = {0: (0.0, [])}
        for j in range(1, len(t) + 1):
            value[j] = max((value[i][0] + (scores[pieces.index(t[i:j])] if t[i:j] in pieces else min(scores) - 10), value[i][1] + [pieces.index(t[i:j]) if t[i:j] in pieces else 0])
                           for i in range(max(0, j - 3), j) if t[i:j] in pieces or j - i == 1)
        return value[len(t)][1]
    texts = ["".join(rnd.choice("abc d") for _ in range(30)) for _ in range(40)]
    flat, offsets = encoder.encode(texts)
    assert [flat[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [best("▁" + t.replace(" ", "▁")) for t in texts]


def test_sentencepiece_empty_table(spark):
    assert sentencepiece.decode(sentencepiece.encode(clash(spark, []), ids_col="tokens"), ids_col="tokens").count() == 0


# chat

CONTROLISH = st.lists(st.sampled_from(["<", "[", "\\", "s>", "/s>", "<s>", "</s>", "[INST]", "[/INST]", "INST]", "<<SYS>>", "<</SYS>>", "SYS>>", "[ROLE]", "x", " ", "\n", "é"]), max_size=12).map("".join)


@given(CONTROLISH)
@settings(max_examples=300, deadline=None)
def test_escape_is_reversible_and_leaves_no_control(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text and not any(c in hidden for c in chat.CONTROLS)


@given(st.sampled_from(["user", "assistant", "system", "tool", "", "[ROLE]"]), CONTROLISH)
@settings(max_examples=200, deadline=None)
def test_turn_round_trip(role, text):
    encode = lambda s: [ord(c) for c in s]
    ids, mask = chat.assemble(chat.turn_segments(role, text), encode, 0x110000)
    back = chat.read_tokens(ids.tolist(), mask.tolist(), lambda x: "".join(map(chr, x)), 0x110000)
    assert back[:2] == (role, text) and back[3] == (text if role == "assistant" else "")


def test_chat_round_trip(spark):
    rows = [(7, 0, "user", "</s>[INST] ok [/INST]", 1), (7, 1, "assistant", "</s>[INST] ok [/INST]", 1), (7, 2, "assistant", None, 1), (8, 0, "system", "be <<SYS>> \\", 1),
            (8, 1, "tool", "", 1), (8, 1, "tool", "", 1), (8, None, None, "first", 1), (None, 0, "assistant", "É漢 " * 5000, 1), (None, 0, "user", "<\\s>", 1), (9, 0, "assistant", "", 1)]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seq int")
    formatted = chat.format_chat(docs)
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    for conv in (7, 8, 9, None):
        turns = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x, _ in rows if c == conv))
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        digest = hashlib.sha256("".join(f"{r}\n{x}\n" for _, _, r, x in turns).encode()).hexdigest()
        r = got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(turns), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for r in formatted.collect():
        assert len(r.ids) == len(r.loss_mask)
    offsets = sorted((r.seq, r.token_offset, len(r.ids)) for r in formatted.where("conv_id = 8").collect())
    assert all(a[1] + a[2] == b[1] for a, b in zip(offsets, offsets[1:])) and offsets[0][1] == 0
    assert chat.read_back(chat.format_chat(docs.limit(0))).count() == 0


# WARC

def test_warc_round_trip_over_small_ranges(spark):
    rnd = random.Random(1)
    noise = "".join(chr(rnd.randrange(32, 0x2000)) for _ in range(30_000))
    pages = [(i, f"http://h/{i}", "<p>" + noise[:rnd.randrange(3000)]) for i in range(120)]
    pages += [(200, None, None), (201, "http://x/ \n y", ""), (202, "http://a", pages[3][2]), (1, "http://b", pages[3][2]), (203, "u", noise), (None, "v", noise), (204, "w", "\x1f\x8b\x08 é" * 500)]
    df = spark.createDataFrame([(*p, 1, "x") for p in pages], "page_id long, url string, html string, bytes int, digest string")
    path = scratch_path(spark, "warc-test")
    warc.write_archives(warc.plan_records(df.repartition(3)), path)
    first = {}
    for i, _, h in sorted(pages, key=lambda p: (p[0] is None, p[0] or 0)):
        first.setdefault((h or ""), i)
    want = sorted(((i, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(),
                    "response" if first[h or ""] == i else "revisit", None if first[h or ""] == i else first[h or ""]) for i, _, h in pages), key=str)
    for size in (1 << 24, 5000, 97):
        got = warc.read_archives(spark, path, range_bytes=size, with_payload=False)
        assert got.count() == got.select("path", "offset").distinct().count() == len(pages)
    assert sorted((tuple(r) for r in warc.page_records(spark, path).collect()), key=str) == want
    payloads = {r.record_id: bytes(r.payload) for r in warc.read_archives(spark, path, 3000).where("record_type = 'response'").collect()}
    assert payloads["<urn:page:203>"].decode() == noise


def test_warc_files_are_plain_gzip_and_damage_is_skipped(spark, tmp_path):
    members = [warc.encode_record(str(i), "http://h/", hashlib.sha1(b"x" * i).hexdigest(), i, None, b"x" * i) for i in range(50)]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(members))
    assert gzip.decompress((tmp_path / "a.warc.gz").read_bytes()).count(b"WARC/1.1") == 50
    # false magic in a stored member, a cut member and noise between records
    nested = gzip.compress(b"WARC? no", 0)
    (tmp_path / "b.warc.gz").write_bytes(members[1] + nested + members[2] + warc.MAGIC + members[3][:20] + members[4])
    for size in (1 << 20, 64):
        ids = sorted((r.path[-9], r.record_id) for r in warc.read_archives(spark, f"file://{tmp_path}", size).collect())
        assert len([x for x in ids if x[0] == "a"]) == 50
        assert {x[1] for x in ids if x[0] == "b"} >= {"<urn:page:1>", "<urn:page:4>"}


def test_warc_minimum_payload_and_empty_table(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    plan = {r.id: r.refers_to for r in warc.plan_records(df, min_bytes=3).collect()}
    assert plan == {"1": None, "2": None, "3": None, "4": "3"}
    path = scratch_path(spark, "warc-empty")
    warc.write_archives(warc.plan_records(df.limit(0)), path)
    assert warc.page_records(spark, path).count() == 0


# URL filter

def brute_rule(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [(len(h + p), h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else None


def test_url_rules_match_brute_force(spark):
    urls = [r.url for r in load(spark, SMALL, "pages").select("url").collect()]
    urls += [None, "", "no scheme", "HTTP://A.NET", "http://net/", "http://planet/x", "http://EXAMPLE.net/en/x?y#z", "x://org/fr/://net/", "http://a.example.com/de", "http://a.org/fr/?q", "//net/", "ftp://ÀB.net/é"]
    rows = spark.createDataFrame([(i, u, "h", 0.5) for i, u in enumerate(urls)], "page_id long, url string, label string, extra double")
    got = url_filter.url_filter(rows).orderBy("page_id").collect()
    for r in got:
        host, path, rule, verdict = brute_rule(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow"))
    assert len(got) == len(urls)


def test_url_trees_learn_given_labels(spark):
    rnd = random.Random(6)

    def url(bad):
        return f"http://{'x-' * rnd.randint(3, 6) if bad else ''}{rnd.choice(['news', 'blog'])}.test/{rnd.randint(1, 10 ** (9 if bad else 2))}"
    rows = [(i, url(i % 2), i % 2) for i in range(600)]
    labelled = spark.createDataFrame([(u, b) for _, u, b in rows[:400]], "url string, label int")
    out = url_filter.url_filter(spark.createDataFrame(rows[400:], "page_id long, url string, bad int"), labels=labelled).collect()
    assert sum((r.verdict == "block") == (r.bad == 1) for r in out) / len(out) > 0.95


def test_url_filter_without_labels(spark):
    none = spark.createDataFrame([("http://a.com/x",), (None,)], "url string")
    assert {r.verdict for r in url_filter.url_filter(none).collect()} == {"allow"}
    assert url_filter.url_filter(none.limit(0)).count() == 0


def test_url_training_takes_each_url_once(spark, monkeypatch):
    seen, write = {}, url_filter.write_scratch

    def noted(df, name):
        seen[name] = write(df, name)
        return seen[name]
    monkeypatch.setattr(url_filter, "write_scratch", noted)
    labelled = spark.createDataFrame([(f"http://{'bad-' * 4 if i % 2 else ''}h{i}.test/", i % 2) for i in range(20) for _ in range(100)], "url string, label int")
    urls = labelled.select("url").distinct()
    out = url_filter.url_filter(urls, labels=labelled, max_train=40).collect()
    assert seen["url-train"].agg(F.count("*"), F.sum("weight")).first() == (20, 2000.0)
    assert all((r.verdict == "block") == ("bad" in r.url) for r in out)
    # a sample without rows, or of one kind, fits nothing
    out = url_filter.url_filter(urls, labels=labelled, max_train=0).collect()
    assert len(out) == 20 and {(r.score, r.verdict) for r in out} == {(0.5, "block")}


def test_non_negative_risk_equals_plain_python():
    """Ten rows, loops instead of arrays: the same risk, the same rule, the same steps."""
    import math
    rnd = random.Random(4)
    positive = [sorted(rnd.sample(range(4), rnd.randint(0, 3))) for _ in range(4)]
    unlabelled = [sorted(rnd.sample(range(4), rnd.randint(0, 3))) for _ in range(6)]

    def flat(rows):
        return np.array([i for i, r in enumerate(rows) for _ in r], np.int64), np.array([j for r in rows for j in r], np.int64)
    for prior in (0.2, 0.7):
        w, b = [0.0] * 4, math.log(prior / (1 - prior))
        m, v = [0.0] * 5, [0.0] * 5
        for step in range(1, 31):
            def margin(r):
                return b + sum(w[j] for j in r)

            def sigmoid(f):
                return 1 / (1 + math.exp(-f))
            negative = sum(math.log1p(math.exp(margin(r))) for r in unlabelled) / 6 - prior * sum(math.log1p(math.exp(margin(r))) for r in positive) / 4
            up, down = [0.0] * 5, [0.0] * 5
            for r in positive:
                for j in [*r, 4]:
                    up[j] += prior * (sigmoid(margin(r)) - 1) / 4
                    down[j] -= prior * sigmoid(margin(r)) / 4
            for r in unlabelled:
                for j in [*r, 4]:
                    down[j] += sigmoid(margin(r)) / 6
            grad = [x + y for x, y in zip(up, down)] if negative >= 0 else [-y for y in down]
            grad = [g + (1e-5 * w[j] if j < 4 else 0) for j, g in enumerate(grad)]
            m = [0.9 * x + 0.1 * g for x, g in zip(m, grad)]
            v = [0.999 * x + 0.001 * g * g for x, g in zip(v, grad)]
            move = [0.1 * (x / (1 - 0.9 ** step)) / (math.sqrt(y / (1 - 0.999 ** step)) + 1e-8) for x, y in zip(m, v)]
            w, b = [x - y for x, y in zip(w, move[:4])], b - move[4]
        got_w, got_b = toxicity.nn_pu(flat(positive), 4, flat(unlabelled), 6, 4, prior, steps=30)
        assert np.allclose(got_w, w, atol=1e-9) and abs(got_b - b) < 1e-9
