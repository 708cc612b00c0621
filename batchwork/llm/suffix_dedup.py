"""Repeated passages by a sparse suffix array.

Words are taken from the whole text (ASCII case folded).  In every window of ``min_words``
words the position whose ``k`` words hash lowest is its minimiser; only suffixes that start
at such positions are kept (about one in twenty).  Equal windows have their minimiser at the
same place, so a passage that repeats puts equal suffixes into the array.

The suffixes are sorted over range partitions by their first words, then by the hash of all
the words that their windows span, then by place.  Neighbours are compared: a suffix whose
first words stand in one document alone is done; one whose whole span repeats in another
document is repeated to its full reach, left and right.  For the rest (passages that begin
or end within the reach) the match is extended window by window, left and right of the
position, over the text itself; equal windows are again found as sorted neighbours.  So a
word is reported exactly if it lies in a window that occurs in at least two documents.

A group of equal suffixes may be cut by partition borders, so one that holds a third of all
rows is spread; groups at a border go to the exact last step, where they are summed up.

Defined results: null and empty texts, and those with fewer than ``min_words`` words, have
no passages; rows with the same id are one document (their positions are told apart by
text); null ids form one document, returned as null; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchwork.llm import words
from batchwork.llm.common import text_hash, write_scratch

MIN_WORDS = 50
K = 10
NULL_ID = -(1 << 63)
_SALT = np.uint64(0x9FB21C651E98DF25)


class Sampler:
    """Word hashes, minimisers and window hashes of texts."""

    def __init__(self, min_words: int, k: int):
        if not 1 <= k <= min_words:
            raise ValueError("k must lie between 1 and min_words")
        self.min_words, self.k, self.width = min_words, k, min_words - k + 1
        self.hasher, self.up, self.down = words.Hasher(words.WHITESPACE), *words.powers(1 << 21)

    def read(self, text: pa.Array) -> None:
        h, _, _, row = self.hasher.words(*words.text_bytes(text))
        if len(h) >= len(self.up):
            self.up, self.down = words.powers(len(h) + 1)
        self.first = np.searchsorted(row, np.arange(len(text) + 1))  # each text's first word
        self.total = np.append(np.zeros(1, np.uint64), np.cumsum(words.mix(h + _SALT) * self.up[:len(h)], dtype=np.uint64))
        starts = np.arange(max(len(h) - self.min_words + 1, 0))
        self.starts = starts[row[starts] == row[starts + self.min_words - 1]] if len(starts) else starts
        self.row = row

    def spans(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hashes of the words from a up to b."""
        return words.mix((self.total[b] - self.total[a]) * self.down[a] + (b - a).astype(np.uint64) * _SALT)

    def minimisers(self) -> np.ndarray:
        """The minimiser of the window at each of ``starts``."""
        n = len(self.total) - 1 - self.k + 1
        if n <= 0 or not len(self.starts):
            return np.zeros(0, np.int64)
        at = np.arange(n)
        bits = np.uint64(max(int(n).bit_length(), 1))
        low = ((self.spans(at, at + self.k) >> bits) << bits) | at.astype(np.uint64)  # leftmost of equal hashes
        size = 1
        while size * 2 <= self.width:
            low = np.minimum(low[:len(low) - size], low[size:])
            size *= 2
        if size < self.width:
            low = np.minimum(low[:len(low) - (self.width - size)], low[self.width - size:])
        return (low[self.starts] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


ANCHORS = "key long, span long, doc long, text_hash long, at int, lo int, hi int"


def sparse_suffixes(texts: DataFrame, min_words: int, k: int) -> DataFrame:
    """The kept suffixes of ``texts`` (doc, text_hash, text): see ANCHORS; lo and hi bound the starts of its windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Sampler(min_words, k)
        for batch in batches:
            for b in words.row_blocks(batch, "text"):
                s.read(b.column("text"))
                m = s.minimisers()
                if not len(m):
                    continue
                new = np.flatnonzero(np.append(True, (m[1:] != m[:-1]) | (s.row[s.starts[1:]] != s.row[s.starts[:-1]])))
                at, lo, hi = m[new], s.starts[new], s.starts[np.append(new[1:], len(m)) - 1]
                row = s.row[at]
                first = s.first[row]
                yield pa.RecordBatch.from_arrays(
                    [_signed(s.spans(at, at + k)), _signed(words.mix(s.spans(lo, hi + min_words) + (at - lo).astype(np.uint64))),
                     b.column("doc").take(pa.array(row)), b.column("text_hash").take(pa.array(row)),
                     *(pa.array((x - first).astype(np.int32)) for x in (at, lo, hi))],
                    names=["key", "span", "doc", "text_hash", "at", "lo", "hi"])
    return texts.mapInArrow(run, ANCHORS)


def _in_two_documents(groups: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For rows sorted by group, then document: does the row's group hold two documents?"""
    begin = np.flatnonzero(groups)
    number = np.cumsum(groups) - 1
    end = np.append(begin[1:], len(doc)) - 1
    return (doc[begin] != doc[end])[number]


def _starts(*columns: np.ndarray) -> np.ndarray:
    change = np.zeros(len(columns[0]), bool)
    change[:1] = True
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return change


def _whole(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    parts = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(parts).combine_chunks() if parts else None


def compare_suffixes(anchors: DataFrame) -> DataFrame:
    """Sort the suffixes and compare neighbours.

    Adds ``same`` (the whole span repeats in another document) and ``check`` (the reach is
    to be extended window by window); suffixes without a partner are left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _whole(batches)  # one range partition
        if t is None:
            return
        key, span, doc = (t.column(c).to_numpy() for c in ("key", "span", "doc"))
        by_key, by_span = _starts(key), _starts(key, span)
        border = (key == key[0]) | (key == key[-1])
        same = _in_two_documents(by_span, doc) & ~border
        shared = _in_two_documents(by_key, doc) | border
        group = np.cumsum(by_key) - 1
        whole = np.bincount(group, ~same) == 0
        check = shared & ~whole[group]
        t = t.append_column("same", pa.array(same)).append_column("check", pa.array(check))
        yield from t.filter(pa.array(same | check)).to_batches(max_chunksize=50_000)
    order = ["key", "span", "doc", "text_hash", "at"]
    return anchors.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, f"{ANCHORS}, same boolean, check boolean")


WINDOWS = "place long, hash long, doc long, text_hash long, start int"


def extend(texts: DataFrame, checked: DataFrame, min_words: int, k: int) -> DataFrame:
    """The windows in reach of the suffixes to check: see WINDOWS; ``place`` names suffix and offset."""
    by_text = checked.groupBy("doc", "text_hash").agg(F.collect_list(F.struct("at", "lo", "hi")).alias("reach"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Sampler(min_words, k)
        for batch in batches:
            for b in words.row_blocks(batch, "text", 2 << 20):
                s.read(b.column("text"))
                reach = b.column("reach")
                flat = reach.flatten()
                row = np.repeat(np.arange(b.num_rows), reach.value_lengths().to_numpy(zero_copy_only=False))
                at, lo, hi = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) + s.first[row] for c in ("at", "lo", "hi"))
                n = hi - lo + 1
                start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
                a, r = np.repeat(at, n), np.repeat(row, n)
                place = words.mix(s.spans(a, a + k) + (a - start + 1).astype(np.uint64) * _SALT)
                yield pa.RecordBatch.from_arrays(
                    [_signed(place), _signed(s.spans(start, start + min_words)), b.column("doc").take(pa.array(r)), b.column("text_hash").take(pa.array(r)),
                     pa.array((start - s.first[r]).astype(np.int32))], names=["place", "hash", "doc", "text_hash", "start"])
    joined = texts.join(by_text, ["doc", "text_hash"]).select("doc", "text_hash", "text", "reach")
    return joined.mapInArrow(run, WINDOWS)


def repeated_windows(windows: DataFrame) -> DataFrame:
    """doc, text_hash, start of the windows that occur in two documents at least."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _whole(batches)
        if t is None:
            return
        place, h, doc = (t.column(c).to_numpy() for c in ("place", "hash", "doc"))
        border = ((place == place[0]) & (h == h[0])) | ((place == place[-1]) & (h == h[-1]))
        yes = _in_two_documents(_starts(place, h), doc)
        t = t.append_column("border", pa.array(border & ~yes))
        yield from t.filter(pa.array(yes | border)).to_batches(max_chunksize=50_000)
    order = ["place", "hash", "doc", "text_hash", "start"]
    found = write_scratch(windows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, f"{WINDOWS}, border boolean"), "suffix-windows-found")
    # groups that a border cuts are summed up; some of their rows may be certain already
    open_ = found.where("border")
    groups = found.join(open_.select("place", "hash").distinct(), ["place", "hash"], "left_semi") \
        .groupBy("place", "hash").agg((F.min("doc") != F.max("doc")).alias("yes")).where("yes").select("place", "hash")
    return found.where("not border").unionByName(open_.join(groups, ["place", "hash"], "left_semi")).select("doc", "text_hash", "start")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, k: int = K) -> DataFrame:
    """One row per maximal run of repeated words: id, start_word, n_words, and the document's n_repeated."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc"), text_hash(text_col).alias("text_hash"), text.alias("text"))
    anchors = write_scratch(sparse_suffixes(texts, min_words, k), "suffix-anchors")
    compared = write_scratch(compare_suffixes(anchors), "suffix-compared")
    windows = write_scratch(extend(texts, compared.where("check").distinct(), min_words, k), "suffix-windows")
    certain = compared.where("same").select("doc", "text_hash", F.col("lo").alias("start"), (F.col("hi") + min_words).alias("end"))
    ends = certain.union(repeated_windows(windows).select("doc", "text_hash", "start", (F.col("start") + min_words).alias("end")))
    ends = ends.groupBy("doc", "text_hash", "start").agg(F.max("end").alias("end"))
    place = "partition by doc, text_hash order by start rows between unbounded preceding"
    runs = ends.withColumn("before", F.expr(f"max(end) over ({place} and 1 preceding)")) \
        .withColumn("run", F.expr(f"sum(int(before is null or start > before)) over ({place} and current row)"))
    spans = runs.groupBy("doc", "text_hash", "run").agg(F.min("start").alias("start_word"), F.max("end").alias("end_word"))
    return spans.select(F.nullif("doc", F.lit(NULL_ID)).alias("id"), "text_hash", "start_word", (F.col("end_word") - F.col("start_word")).alias("n_words"),
                        F.expr("sum(end_word - start_word) over (partition by doc, text_hash)").alias("n_repeated"))
