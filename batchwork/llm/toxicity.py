"""Toxicity scores from positive and unlabelled texts (non-negative PU learning).

Confirmed toxic rows are the positives; other rows count as unlabelled, whatever their
label says.  A logistic classifier on word presence is fitted with numpy by minimising the
class-prior-corrected risk

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))

with the non-negative rule: where the bracket turns negative, the step goes back up it, so
that the classifier can't over-fit the positives out of the unlabelled rows.

Words are runs of letters (ASCII case folded) of the whole text.  The fit takes at most
about ``max_positive`` and ``max_unlabelled`` labelled rows, chosen by hash, each id and text once; the class
prior is counted over all labelled training rows.

Defined results: a null or empty text has no words and scores the model's bias; with no
positive training row every score is 0; repeated rows and null ids are scored row by row;
rows without a label are scored too; other columns are ignored or kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchwork.llm import words
from batchwork.llm.common import at_most, bounded_sample, held_out, text_hash, write_scratch

MAX_POSITIVE = 4_000
MAX_UNLABELLED = 12_000
MAX_FEATURES = 2_000
MIN_ROWS = 5
MIN_Z = 3.5


def distinct_words(text: pa.Array, hasher: words.Hasher) -> list[np.ndarray]:
    data, offsets = words.text_bytes(text)
    h, _, _, row = hasher.words(data, offsets)
    cuts = np.searchsorted(row, np.arange(len(text) + 1))
    return [np.unique(h[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


def sample_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                max_positive: int, max_unlabelled: int) -> tuple[DataFrame, float, int]:
    """The training rows (positive, text) to fit on, the class prior and the count of positives."""
    known = labels.where(~held_out(id_col) & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(
        (F.max(label_col) == 1).alias("positive"))
    n, n_pos = known.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("positive").cast("long")), F.lit(0))).first()
    if not n:
        return known.select("positive").withColumn("text", F.lit("")), 0.0, 0
    share = F.pmod(F.xxhash64(F.col("__id"), F.lit(1)), F.lit(1_000_000)) / 1e6
    other = F.pmod(F.xxhash64(F.col("__id"), F.lit(2)), F.lit(1_000_000)) / 1e6
    take = known.select("__id", (F.col("positive") & (share < max_positive / max(n_pos, 1))).alias("as_positive"),
                        (other < max_unlabelled / n).alias("as_unlabelled")).where("as_positive or as_unlabelled")
    text = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
    return text.join(bounded_sample(take, "__id", max_positive + max_unlabelled), "__id").select(
        F.xxhash64("__id", text_hash("text")).alias("key"), "as_positive", "as_unlabelled", "text"), n_pos / n, n_pos


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> tuple[np.ndarray, np.ndarray, float]:
    """The model: sorted word hashes, their weights, and the bias."""
    rows, prior, n_pos = sample_rows(docs, labels, id_col, text_col, label_col, max_positive, max_unlabelled)
    if not n_pos:
        return np.zeros(0, np.uint64), np.zeros(0), -np.inf

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = words.Hasher(words.LETTERS)
        for batch in batches:
            for b in words.row_blocks(batch, "text"):
                sets = [x.view(np.int64) for x in distinct_words(b.column("text"), hasher)]
                yield pa.RecordBatch.from_arrays([b.column("key"), b.column("as_positive"), b.column("as_unlabelled"), pa.array(sets, pa.list_(pa.int64()))],
                                                 names=["key", "as_positive", "as_unlabelled", "h"])

    # In how many sampled rows of each kind does each word stand?  Counted by Spark; only
    # words that tell the kinds apart come to the driver, MAX_FEATURES of them at most.
    # An id may stand on any number of rows: one row per id and text, and a bounded number of them.
    sets = write_scratch(rows.mapInArrow(hashed, "key long, as_positive boolean, as_unlabelled boolean, h array<long>").dropDuplicates(["key"]), "toxic-sample")
    sets = at_most(sets, "key", 2 * (max_positive + max_unlabelled))
    p_rows, u_rows = sets.agg(F.count_if("as_positive"), F.count_if("as_unlabelled")).first()
    if not p_rows or not u_rows:
        return np.zeros(0, np.uint64), np.zeros(0), -np.inf
    pooled = (F.col("p") + F.col("u")) / F.lit(p_rows + u_rows)
    z = (F.col("p") / F.lit(p_rows) - F.col("u") / F.lit(u_rows)) / F.sqrt(pooled * (1 - pooled) * (1 / p_rows + 1 / u_rows) + 1e-12)
    picked = (sets.select("as_positive", "as_unlabelled", F.explode("h").alias("w")).groupBy("w")
              .agg(F.count_if("as_positive").alias("p"), F.count_if("as_unlabelled").alias("u"))
              .where(F.col("p") + F.col("u") >= MIN_ROWS).withColumn("z", z).where(F.abs("z") >= MIN_Z)
              .orderBy(F.desc(F.abs("z")), "w").limit(MAX_FEATURES).select("w").collect())
    chosen = np.sort(np.array([r.w for r in picked], np.int64).view(np.uint64)) if picked else np.zeros(0, np.uint64)
    keep = sorted(r.w for r in picked)
    small = sets.select("as_positive", "as_unlabelled", F.array_intersect("h", F.lit(keep) if keep else F.array().cast("array<long>")).alias("h")).collect()

    def matrix(some: list) -> tuple[np.ndarray, np.ndarray]:
        row = np.repeat(np.arange(len(some)), [len(r.h) for r in some])
        return row, np.searchsorted(chosen, np.array([w for r in some for w in r.h], np.int64).view(np.uint64))
    positive, unlabelled = [r for r in small if r.as_positive], [r for r in small if r.as_unlabelled]
    weights, bias = nn_pu(matrix(positive), len(positive), matrix(unlabelled), len(unlabelled), len(chosen), prior)
    return chosen, weights, bias


def nn_pu(p: tuple[np.ndarray, np.ndarray], n_p: int, u: tuple[np.ndarray, np.ndarray], n_u: int, width: int, prior: float,
          steps: int = 500, rate: float = 0.1, l2: float = 1e-5) -> tuple[np.ndarray, float]:
    """Minimise the non-negative PU risk with logistic loss (Adam, full batches)."""
    w, b = np.zeros(width), float(np.log(prior / (1 - prior))) if prior < 1 else 0.0
    m, v = np.zeros(width + 1), np.zeros(width + 1)

    def margin(x, n):
        return np.bincount(x[0], w[x[1]], n) + b if len(x[0]) else np.full(n, b)

    def back(x, d):
        return np.append(np.bincount(x[1], d[x[0]], width) if len(x[0]) else np.zeros(width), d.sum())

    def sigmoid(f):
        return 1 / (1 + np.exp(-np.clip(f, -30, 30)))
    for step in range(1, steps + 1):
        fp, fu = margin(p, n_p), margin(u, n_u)
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        grad_negative = back(u, sigmoid(fu) / n_u) - prior * back(p, sigmoid(fp) / n_p)
        grad = prior * back(p, (sigmoid(fp) - 1) / n_p) + grad_negative if negative >= 0 else -grad_negative
        grad[:-1] += l2 * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        move = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a column ``score_col``: the probability that the text is toxic."""
    chosen, weights, bias = model
    sent = docs.sparkSession.sparkContext.broadcast((chosen, weights, bias))  # MAX_FEATURES entries at most
    keep = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    row_type = keep.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, weights, bias = sent.value
        hasher = words.Hasher(words.LETTERS)
        maybe = np.zeros(1 << 16, bool)
        maybe[(chosen >> np.uint64(48)).astype(np.int64)] = True
        for batch in batches:
            row = batch.column("row")
            for b in words.row_blocks(pa.RecordBatch.from_arrays([row, row.field(text_col)], names=["row", "text"]), "text"):
                f = np.full(b.num_rows, bias)
                if len(chosen):
                    h, _, _, of = hasher.words(*words.text_bytes(b.column("text")))
                    near = np.flatnonzero(maybe[(h >> np.uint64(48)).astype(np.int64)])
                    h, of = h[near], of[near]
                    k = np.minimum(np.searchsorted(chosen, h), len(chosen) - 1)
                    hit = chosen[k] == h
                    pairs = np.unique(of[hit] * len(chosen) + k[hit])
                    f += np.bincount(pairs // len(chosen), weights[pairs % len(chosen)], b.num_rows)
                with np.errstate(over="ignore"):
                    s = 1 / (1 + np.exp(-f))
                yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(s)], names=["row", "score"])
    scored = keep.mapInArrow(run, f"row {row_type}, score double")
    return scored.select("row.*", F.col("score").alias(score_col))
