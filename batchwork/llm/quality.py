"""Document quality by hierarchical empirical Bayes.

A logistic classifier on text statistics gives each document its evidence (a log-likelihood
ratio).  Sites add what is known of their other documents: the share of good ones per host
and per path below it, from labels where there are any and the classifier's probability
elsewhere, counted by grouped aggregation over all documents.  Sparse paths are shrunk
towards their host and sparse hosts towards the global share, with strengths estimated from
the spread between sites (method of moments).  A document's own contribution is taken out
of its site's counts before the two are combined.

Labels are learned from training rows alone (held-out rows never count).  The classifier is
fitted on at most about ``max_train`` labelled rows, chosen by hash, each id and text once.

Defined results: a null or empty text has all statistics zero; null host and path are sites
of their own; repeated rows are separate documents of their site; without labels of both
kinds the evidence is 0 for all and the score is the share of good labels (1 if none);
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchwork.llm import words
from batchwork.llm.common import at_most, bounded_sample, held_out, text_hash, write_scratch

MAX_TRAIN = 20_000
_LINES = words.byte_values(b"\n", fold_case=False)
STATISTICS = ["log_words", "symbols", "punctuation", "upper", "digits", "word_length", "distinct_words", "distinct_lines", "commonest_word"]


def _class(test) -> np.ndarray:
    return np.array([b < 128 and test(chr(b)) for b in range(256)])


_UPPER, _DIGIT, _PUNCT = _class(str.isupper), _class(str.isdigit), _class(lambda c: c in ".,;:'\"-()!?")
_SYMBOL = _class(lambda c: not c.isalnum() and not c.isspace() and c not in ".,;:'\"-()!?")


def statistics(text: pa.Array, hasher: words.Hasher, lines: words.Hasher) -> np.ndarray:
    """A row of STATISTICS for each text."""
    data, offsets = words.text_bytes(text)
    n_bytes = np.maximum(np.diff(offsets), 1)

    def share(of: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(of[data], dtype=np.int64))
        return (total[offsets[1:]] - total[offsets[:-1]]) / n_bytes

    def spread(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.lexsort((h, row))
        h, row = h[order], row[order]
        new = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1]))) if len(h) else np.zeros(0, np.int64)
        most = np.zeros(len(text), np.int64)
        np.maximum.at(most, row[new], np.diff(np.append(new, len(h))))
        return np.bincount(row, minlength=len(text)), np.bincount(row[new], minlength=len(text)), most
    h, s, t, row = hasher.words(data, offsets)
    n, distinct, most = spread(h, row)
    lh, _, _, lrow = lines.words(data, offsets)
    n_lines, distinct_lines, _ = spread(lh, lrow)
    some = np.maximum(n, 1)
    return np.column_stack([np.log1p(n), share(_SYMBOL), share(_PUNCT), share(_UPPER), share(_DIGIT),
                            np.bincount(row, t - s, len(text)) / some / 10, np.where(n, distinct / some, 0),
                            np.where(n_lines, distinct_lines / np.maximum(n_lines, 1), 0), most / some])


def expand(x: np.ndarray) -> np.ndarray:
    """Statistics, their squares and square roots, and log length times each."""
    return np.hstack([x, x ** 2, np.sqrt(np.abs(x)), x[:, :1] * x[:, 1:]])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, keep = np.zeros(x.shape[1]), np.append(np.full(x.shape[1] - 1, ridge), 1e-6)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep), x.T @ (y - p) - keep * w)
        w = w + move
        if np.abs(move).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, known: DataFrame, id_col: str, text_col: str, max_train: int = MAX_TRAIN):
    """Mean, scale and weights of the classifier, and the share of good rows; None where one kind is missing."""
    n, good = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not n or good in (0, n):
        return None, (good / n if n else 1.0)
    take = known.where(F.pmod(F.xxhash64("__id", F.lit(3)), F.lit(1_000_000)) / 1e6 < max_train / n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, lines = words.Hasher(words.WHITESPACE), words.Hasher(_LINES)
        for batch in batches:
            for b in words.row_blocks(batch, "text"):
                x = statistics(b.column("text"), hasher, lines)
                yield pa.RecordBatch.from_arrays([b.column("key"), b.column("label"), pa.array(list(x), pa.list_(pa.float64()))], names=["key", "label", "x"])
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).join(bounded_sample(take, "__id", max_train), "__id")
    # an id may stand on any number of rows: one row per id and text, and a bounded number of them
    found = texts.select(F.xxhash64("__id", text_hash("text")).alias("key"), "label", "text").mapInArrow(run, "key long, label double, x array<double>")
    rows = at_most(write_scratch(found.dropDuplicates(["key"]), "quality-sample"), "key", 2 * max_train).select("label", "x").collect()
    if not rows:
        return None, good / n
    x, y = expand(np.array([r.x for r in rows])), np.array([r.label for r in rows])
    mean, scale = x.mean(0), x.std(0) + 1e-9
    return (mean, scale, logistic((x - mean) / scale, y)), good / n


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-4)), F.lit(1 - 1e-4))
    return F.log(p / (1 - p))


def _strength(sites: DataFrame, mean: Column, prior: float) -> float:
    """Pseudo-count of the shrinkage: how little the sites' shares differ beyond chance."""
    spread, rows, groups = sites.agg(F.sum(F.col("n") * (F.col("good") / F.col("n") - mean) ** 2), F.sum("n"), F.count(F.lit(1))).first()
    if not rows:
        return 1.0
    chance = prior * (1 - prior)
    between = max(spread / rows - chance * groups / rows, 1e-6)
    return float(min(max(chance / between - 1, 1.0), 1e4))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
            path_col: str = "lang", label_col: str = "quality", max_train: int = MAX_TRAIN) -> DataFrame:
    """One row per document: id, evidence, host and path posterior, score, keep (score >= 0.5)."""
    known = labels.where(~held_out(id_col) & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("__id")) \
        .agg(F.max(label_col).cast("double").alias("label"))
    model, prior = fit(docs, known, id_col, text_col, max_train)
    sent = docs.sparkSession.sparkContext.broadcast((model, float(np.log(min(max(prior, 1e-4), 1 - 1e-4) / (1 - min(max(prior, 1e-4), 1 - 1e-4))))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, offset = sent.value
        hasher, lines = words.Hasher(words.WHITESPACE), words.Hasher(_LINES)
        for batch in batches:
            for b in words.row_blocks(batch, "text"):
                if model is None:
                    f = np.zeros(b.num_rows)
                else:
                    x = (expand(statistics(b.column("text"), hasher, lines)) - model[0]) / model[1]
                    f = np.clip(np.hstack([x, np.ones((len(x), 1))]) @ model[2], -15, 15) - offset
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("host"), b.column("path"), pa.array(f)], names=["id", "host", "path", "evidence"])
    cols = docs.select(F.col(id_col).alias("id"), F.col(host_col).alias("host"), F.col(path_col).alias("path"), F.col(text_col).alias("text"))
    types = {f.name: f.dataType.simpleString() for f in cols.schema}
    evidence = write_scratch(cols.mapInArrow(run, f"id {types['id']}, host {types['host']}, path {types['path']}, evidence double"), "quality-evidence")
    believed = 1 / (1 + F.exp(-(F.col("evidence") + _logit(F.lit(prior)))))
    soft = evidence.join(known, evidence["id"] == known["__id"], "left").select(
        "id", "host", "path", "evidence", F.coalesce("label", believed).alias("own"))
    paths = write_scratch(soft.groupBy("host", "path").agg(F.sum("own").alias("good"), F.count(F.lit(1)).alias("n")), "quality-paths")
    hosts = paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    total = paths.agg(F.sum("good") / F.sum("n")).first()[0]
    total = float(total) if total is not None else prior
    k_host = _strength(hosts, F.lit(total), total)
    below = paths.alias("p").join(hosts.select(F.col("host").alias("h"), F.col("good").alias("host_good"), F.col("n").alias("host_n")),
                                  F.col("p.host").eqNullSafe(F.col("h"))).select("p.*", "host_good", "host_n")
    k_path = _strength(below, F.col("host_good") / F.col("host_n"), total)
    # without the document itself: counts less its own share
    sites = below.select(F.col("host").alias("s_host"), F.col("path").alias("s_path"), "good", "n", "host_good", "host_n")
    joined = soft.join(sites, soft["host"].eqNullSafe(F.col("s_host")) & soft["path"].eqNullSafe(F.col("s_path")))
    host_posterior = (F.col("host_good") - F.col("own") + k_host * total) / (F.col("host_n") - 1 + k_host)
    path_posterior = (F.col("good") - F.col("own") + k_path * F.col("host_posterior")) / (F.col("n") - 1 + k_path)
    out = joined.withColumn("host_posterior", host_posterior).withColumn("path_posterior", path_posterior)
    out = out.withColumn("score", 1 / (1 + F.exp(-(_logit(F.col("path_posterior")) + F.col("evidence")))))
    return out.select("id", "evidence", "host_posterior", "path_posterior", "score", (F.col("score") >= 0.5).alias("keep"))
