"""Language identification by segmentation-marginalised unigrams.

Every language has probabilities of the pieces of one fixed public vocabulary.  A word's
probability is the sum over all its segmentations into pieces, found by the forward algorithm;
bytes are pieces too, so every word has one.  A text's score adds its words' log probabilities
and the log share of the language.

The probabilities are learned by expectation maximisation: Spark counts the words of each
language over the training rows, tasks run forward and backward over the distinct words and
return expected piece counts, and Spark adds those up; vocabulary x languages numbers come to
the driver.  Training takes about ``MAX_ROWS`` distinct texts of a language at most, chosen by hash, and the
``MAX_LANGUAGES`` languages with most rows; everything else covers all rows.

Words are runs of ASCII letters and characters beyond ASCII of the whole text, in lower case,
each after a space mark.

Defined results: a text that is null or without a letter is ``und`` with score 0, as is any text
where nothing could be learned; rows without a language teach nothing but get one; equal scores
go to the language whose name sorts first; repeated rows and null ids are judged row by row;
columns of the results' names are replaced, all others kept.  Memory follows the block of texts,
or the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchwork.llm import words
from batchwork.llm.common import text_hash, write_scratch
from batchwork.llm.sentencepiece import MODEL, load_model, read_model

MAX_ROWS = 1_500
MAX_LANGUAGES = 256
ROUNDS = 3
UNKNOWN = "und"
MARK = "▁".encode()
SMOOTHING = 0.5  # pseudo-counts of a piece, shared out as all languages together use it
BYTES = 1e-3  # probability kept for the bytes alone
FIXED = 1 << 20  # expected counts are added up as whole multiples of 1 / FIXED, in any order
_CACHED = 4_000_000  # numbers of known words' scores that a task keeps
_LATTICE = 4_000_000  # numbers of a block of words' forward sums


class Vocabulary:
    """The pieces that can occur in a lower-case word, found by hash; the first 256 are the bytes."""

    def __init__(self, raw: bytes):
        model = read_model(raw)
        plain = sorted({p.encode() for p in model.ids} - {b""})
        plain = [p for p in plain if MARK not in p[1:] and p != MARK and (len(p) > 1)]
        self.size = 256 + len(plain)
        by_length: dict[int, list[tuple[bytes, int]]] = {}
        for i, p in enumerate(plain):
            by_length.setdefault(len(p), []).append((p, 256 + i))
        self.values = words.byte_values(b"", fold_case=False)
        self.tables = []
        for k, some in sorted(by_length.items()):
            data = np.frombuffer(b"".join(p for p, _ in some), np.uint8)
            h = self._hashes(data, np.arange(0, len(data), k), k)
            order = np.argsort(h)
            seen = np.zeros(1 << 20, bool)
            seen[(h >> np.uint64(44)).astype(np.int64)] = True
            self.tables.append((k, h[order], np.array([i for _, i in some])[order], seen))
        self.depth = max([1, *by_length])

    def _hashes(self, data: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
        h = np.zeros(len(starts), np.uint64)
        for i in range(k):
            h = h * np.uint64(0x9E3779B97F4A7C15) + self.values[data[starts + i]]
        return words.mix(h)

    def edges(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and piece of every occurrence in ``data``; ``ends`` is, for each byte, its word's end."""
        n, at = len(data), np.arange(len(data))
        found = [(at, np.ones(n, np.int64), data.astype(np.int64))]
        h, k = np.zeros(n, np.uint64), 0
        for size, table, pieces, seen in self.tables:
            at = at[at + size <= ends[at]]
            if not len(at):
                break
            while k < size:  # rolling on: h[i] covers data[i:i + k]
                h[:n - k] = h[:n - k] * np.uint64(0x9E3779B97F4A7C15) + self.values[data[k:]]
                k += 1
            mixed = words.mix(h[at])
            maybe = np.flatnonzero(seen[(mixed >> np.uint64(44)).astype(np.int64)])
            slot = np.minimum(np.searchsorted(table, mixed[maybe]), len(table) - 1)
            hit = table[slot] == mixed[maybe]
            found.append((at[maybe[hit]], np.full(int(hit.sum()), size), pieces[slot[hit]]))
        return tuple(np.concatenate(x) for x in zip(*found))


class Lattice:
    """All segmentations of some words at once, step by step over the byte positions."""

    def __init__(self, vocabulary: Vocabulary, data: np.ndarray, lengths: np.ndarray):
        self.depth, self.n = vocabulary.depth, len(lengths)
        self.order = np.argsort(-lengths, kind="stable")  # longest first: the words at work are the first ones
        rank = np.empty(self.n, np.int64)
        rank[self.order] = np.arange(self.n)
        first = np.cumsum(lengths) - lengths
        word = np.repeat(np.arange(self.n), lengths)
        start, size, piece = vocabulary.edges(data, (first + lengths)[word])
        self.word, self.end, self.size, self.piece = rank[word[start]], start - first[word[start]] + size, size, piece
        # by end and length: at one such step a word has one edge at most
        by = np.lexsort((self.word, self.size, self.end))
        self.word, self.end, self.size, self.piece = (x[by] for x in (self.word, self.end, self.size, self.piece))
        self.lengths = lengths[self.order]
        change = np.flatnonzero(np.diff(self.end) | np.diff(self.size)) + 1
        cuts = np.concatenate([[0], change, [len(self.end)]]) if len(self.end) else np.zeros(1, np.int64)
        self.steps = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))

    def scores(self, p: np.ndarray) -> np.ndarray:
        """Log probability of every word (rows) in every language (columns of ``p``)."""
        width, ring = p.shape[1], self.depth + 1
        sums = np.zeros((ring, self.n, width))
        sums[0] = 1
        log, out = np.zeros((self.n, width)), np.empty((self.n, width))
        done, at = self.n, 0
        for a, b in [*self.steps, (-1, -1)]:
            end = int(self.end[a]) if a >= 0 else at + 1
            if end > at:
                if at:
                    live = int(np.searchsorted(-self.lengths, -at, "left"))  # words longer than the position reached
                    out[live:done] = np.log(sums[at % ring, live:done]) + log[live:done]
                    done = live
                    if at % 8 == 0:  # bytes are pieces: no position falls below the last by more than BYTES / 256
                        here = sums[at % ring, :done].copy()
                        sums[:, :done] /= here
                        log[:done] += np.log(here)
                if a < 0:
                    break
                at = end
                sums[at % ring, :done] = 0
            w = self.word[a:b]
            sums[at % ring, w] += sums[(at - int(self.size[a])) % ring, w] * p[self.piece[a:b]]
        back = np.empty_like(out)
        back[self.order] = out
        return back

    def expected(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected occurrences of every piece in the words, each as often as ``counts`` says, in one language."""
        most = int(self.lengths[0])
        counts = counts[self.order].astype(np.float64)
        prob = p[self.piece]
        forward, scale = np.zeros((most + 1, self.n)), np.ones((most + 1, self.n))
        forward[0] = 1
        grown = np.ones((most + 1, self.n))  # product of the scales of the last positions
        by_end: dict[int, list] = {}
        for a, b in self.steps:
            by_end.setdefault(int(self.end[a]), []).append((a, b))
        for end in range(1, most + 1):
            f = np.zeros(self.n)
            for a, b in by_end.get(end, ()):
                w, size = self.word[a:b], int(self.size[a])
                f[w] += forward[end - size, w] * prob[a:b] / grown[end - size, w]
            s = np.where(f > 0, f, 1)
            scale[end] = s
            forward[end] = f / s
            lo = max(0, end - self.depth)
            grown[lo:end] *= s  # from position i on to here
        # backward: position i's sum over the rest, in the same scales
        backward = np.zeros((most + 1, self.n))
        backward[self.lengths, np.arange(self.n)] = 1
        out = np.zeros(len(p))
        for end in range(most, 0, -1):
            for a, b in by_end.get(end, ()):
                w, size = self.word[a:b], int(self.size[a])
                between = np.prod(scale[end - size + 1:end + 1, w], axis=0)
                share = prob[a:b] / between * backward[end, w]
                backward[end - size, w] += share
                np.add.at(out, self.piece[a:b], counts[w] * forward[end - size, w] * share)
        return out


def _blocks(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of words of at most ``most`` bytes together (one word at least)."""
    end = np.cumsum(lengths)
    at = 0
    while at < len(lengths):
        to = max(at + 1, int(np.searchsorted(end, (end[at - 1] if at else 0) + most, "right")))
        yield at, to
        at = to


def _gather(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some words, each after the mark, one after another, and their lengths."""
    size = end - start
    lengths = size + len(MARK)
    first = np.cumsum(lengths) - lengths
    out = np.empty(int(lengths.sum()), np.uint8)
    for k, c in enumerate(MARK):
        out[first + k] = c
    inner = np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
    out[np.repeat(first + len(MARK) - np.cumsum(size) + size, size) + np.arange(int(size.sum()))] = data[inner]
    return out, lengths


@dataclass
class LanguageModel:
    """Sorted language names, log shares and piece probabilities (pieces x languages)."""

    languages: list[str]
    log_share: np.ndarray
    pieces: np.ndarray
    vocabulary: bytes


class Scorer:
    """Scores of words in all languages; keeps those of words seen before."""

    def __init__(self, model: LanguageModel):
        self.model, self.vocabulary = model, Vocabulary(model.vocabulary)
        self.hasher = words.Hasher(words.LETTERS)
        self.known, self.scores = np.zeros(0, np.uint64), np.zeros((0, len(model.languages)))

    def _learn(self, data: np.ndarray, h: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        width = len(self.model.languages)
        if (len(self.known) + len(h)) * width > _CACHED:
            self.known, self.scores = np.zeros(0, np.uint64), np.zeros((0, width))
        got = np.empty((len(h), width))
        by = np.argsort(end - start, kind="stable")  # words of like length together
        size = (end - start)[by] + len(MARK)
        for a, b in _blocks(np.maximum(size, 8), max(1, _LATTICE // width // 4)):
            some = by[a:b]
            flat, lengths = _gather(data, start[some], end[some])
            got[some] = Lattice(self.vocabulary, flat, lengths).scores(self.model.pieces)
        self.known, self.scores = np.concatenate([self.known, h]), np.concatenate([self.scores, got])
        order = np.argsort(self.known)
        self.known, self.scores = self.known[order], self.scores[order]

    def __call__(self, text: pa.Array) -> np.ndarray:
        """Log probability, up to a constant, of every text in every language."""
        n, width = len(text), len(self.model.languages)
        out = np.tile(self.model.log_share, (n, 1))
        data, offsets = words.text_bytes(text)
        h, start, end, row = self.hasher.words(data, offsets)
        if not len(h):
            return out
        distinct, place, inverse = np.unique(h, return_index=True, return_inverse=True)
        slot = np.minimum(np.searchsorted(self.known, distinct), max(len(self.known) - 1, 0))
        new = self.known[slot] != distinct if len(self.known) else np.ones(len(distinct), bool)
        if new.any():
            self._learn(data, *((distinct, start[place], end[place]) if (len(self.known) + new.sum()) * width > _CACHED
                                else (distinct[new], start[place[new]], end[place[new]])))
            slot = np.searchsorted(self.known, distinct)
        mine = slot[inverse]
        for k in range(width):
            out[:, k] += np.bincount(row, self.scores[mine, k], n)
        return out


def training_rows(docs: DataFrame, known: Column, text_col: str, lang_col: str, max_rows: int, max_languages: int) -> tuple[DataFrame, list]:
    """The bounded sample (lang, text) and, for the languages taken, their training rows, sorted by name."""
    rows = docs.where(known & F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    # texts, not rows, are drawn: a text that fills half a language counts once
    texts = rows.groupBy("lang", text_hash("text").alias("h")).agg(F.count(F.lit(1)).alias("n"))
    counted = texts.groupBy("lang").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts")).orderBy(F.desc("n"), "lang").limit(max_languages).collect()
    counted = sorted(counted, key=lambda r: r.lang)
    share = F.create_map(*[x for r in counted for x in (F.lit(r.lang), F.lit(min(1.0, max_rows / r.texts)))]) if counted else None
    draw = F.pmod(text_hash("text"), F.lit(10 ** 15)) / 1e15
    take = rows.where(F.try_element_at(share, F.col("lang")) > draw) if counted else rows.limit(0)
    return take.dropDuplicates(["lang", "text"]), counted


def fit(docs: DataFrame, known: Column | None = None, text_col: str = "text", lang_col: str = "lang", vocabulary: str = MODEL,
        max_rows: int = MAX_ROWS, max_languages: int = MAX_LANGUAGES, rounds: int = ROUNDS) -> LanguageModel:
    """Learn from the rows for which ``known`` holds (all, where it is not given) and that have a language."""
    raw = load_model(vocabulary)
    size = Vocabulary(raw).size
    take, counted = training_rows(docs, F.lit(True) if known is None else known, text_col, lang_col, max_rows, max_languages)
    names = [r.lang for r in counted]
    total = sum(r.n for r in counted)
    log_share = np.log(np.array([r.n / total for r in counted])) if counted else np.zeros(0)
    if not counted:
        return LanguageModel([], log_share, np.zeros((size, 0)), raw)
    number = {name: k for k, name in enumerate(names)}
    of = F.element_at(F.create_map(*[x for k, v in number.items() for x in (F.lit(k), F.lit(v))]), F.col("lang"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = words.Hasher(words.LETTERS)
        for batch in batches:
            for b in words.row_blocks(batch, "text"):
                data, offsets = words.text_bytes(pc.utf8_lower(b.column("text")))
                h, start, end, row = hasher.words(data, offsets)
                if len(h):
                    lang = b.column("lang").to_numpy()[row]
                    order = np.lexsort((h, lang))
                    first = np.flatnonzero(np.append(True, (np.diff(h[order]) != 0) | (np.diff(lang[order]) != 0)))
                    n, at = np.diff(np.append(first, len(h))), order[first]
                    word = pa.array([data[s:e].tobytes() for s, e in zip(start[at].tolist(), end[at].tolist())], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(lang[at], pa.int32()), word, pa.array(n, pa.int64())], names=["lang", "word", "n"])
    counts = take.select(of.alias("lang"), "text").mapInArrow(count, "lang int, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counts = write_scratch(counts.repartition("word").sortWithinPartitions("lang", "word"), "language-words")

    p = np.full((size, len(names)), 1.0 / size)
    for _ in range(rounds):
        got = _expected(counts, p, raw)
        if not got.any():
            break  # no words at all
        pooled = (got.sum(1) + SMOOTHING) / (got.sum() + SMOOTHING * size)
        p = (1 - BYTES) * (got + size * SMOOTHING * pooled[:, None]) / (got.sum(0) + size * SMOOTHING)
        p[:256] += BYTES / 256
    return LanguageModel(names, log_share, p, raw)


def _expected(counts: DataFrame, p: np.ndarray, raw: bytes) -> np.ndarray:
    sent = counts.sparkSession.sparkContext.broadcast((p, raw))  # vocabulary x languages numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, raw = sent.value
        vocabulary = Vocabulary(raw)
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            langs, n = b.column("lang").to_numpy(), b.column("n").to_numpy()
            data, offsets = words.text_bytes(pa.array(b.column("word"), pa.binary()).cast(pa.large_binary()).view(pa.large_string()))
            for lang in np.unique(langs).tolist():
                at = np.flatnonzero(langs == lang)
                at = at[np.argsort(offsets[at + 1] - offsets[at], kind="stable")]
                size = offsets[at + 1] - offsets[at] + len(MARK)
                for a, z in _blocks(size, _LATTICE // 40):
                    flat, lengths = _gather(data, offsets[at[a:z]], offsets[at[a:z] + 1])
                    sums[lang] = sums.get(lang, 0) + Lattice(vocabulary, flat, lengths).expected(p[:, lang], n[at[a:z]])
        for lang, s in sums.items():
            some = np.flatnonzero(np.rint(s * FIXED) > 0)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), lang, np.int32)), pa.array(some.astype(np.int32)), pa.array(np.rint(s[some] * FIXED).astype(np.int64))],
                                             names=["lang", "piece", "n"])
    rows = counts.mapInArrow(run, "lang int, piece int, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toArrow()
    sent.unpersist()
    out = np.zeros_like(p)
    out[rows["piece"].to_numpy(), rows["lang"].to_numpy()] = rows["n"].to_numpy() / FIXED
    return out


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """``docs`` with the most probable language and its probability among those learned."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # vocabulary x MAX_LANGUAGES numbers at most
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in (lang_out, score_out)]).alias("row"), F.col(text_col).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        scorer = Scorer(model) if model.languages else None
        names = pa.array([*model.languages, UNKNOWN], pa.string())
        for batch in batches:
            for b in words.row_blocks(batch, "text"):
                text = pc.fill_null(b.column("text"), "")
                pick, score = np.full(b.num_rows, len(names) - 1), np.zeros(b.num_rows)
                if scorer:
                    f = scorer(pc.utf8_lower(text))
                    best = f.argmax(1)
                    sure = 1 / np.exp(f - f[np.arange(len(f)), best][:, None]).sum(1)
                    lettered = pc.match_substring_regex(text, r"\p{L}").to_numpy(zero_copy_only=False)
                    pick, score = np.where(lettered, best, pick), np.where(lettered, sure, 0.0)
                yield pa.RecordBatch.from_arrays([b.column("row"), names.take(pa.array(pick)), pa.array(score)], names=["row", "lang", "score"])
    out = rows.mapInArrow(run, f"row {kind}, lang string, score double")
    return out.select("row.*", F.col("lang").alias(lang_out), F.col("score").alias(score_out))
