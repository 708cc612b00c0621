"""Ranked lexical search: an inverted index in shards, searched by Block-Max MaxScore.

*Index.*  Every task turns its own documents into shards of ``SHARD_BYTES`` of text, without a
shuffle.  A shard holds a list of postings per term, cut into blocks of ``BLOCK`` postings: first
and last document, greatest impact, and the packed document gaps and frequencies.  An impact is
the part of a score that does not depend on the term's weight.

*Search.*  Queries are taken in blocks of bounded size; only the lists of a block's terms are
read, and dealt by shard.  A shard's documents are gone through in windows.  The bounds of whole
lists part them: lists whose bounds together stay below the worst kept score can't bring a
document in alone, the others are essential.  Documents of the essential lists are candidates;
the block maxima of the other lists reject most of them before a block of those is unpacked.
Each task keeps the best documents of a query over all of its shards, Spark merges these.

Scores follow the contract of the query: whole numbers, weight ``floor(1000 * ln((2N + 2) / (2df
+ 1)))``, impact ``10**9 * tf div (1000 * tf + 8 * m)``, ``m = 10 + 90 * n * N div L``.  Terms are
runs of ASCII letters and digits (A-Z lower-cased) and characters beyond ASCII.  They are told
apart by 64-bit hashes: a corpus of 10**10 different terms gives a query of 100 terms a chance of
about 5e-8 to meet a wrong one.

Defined results: null, empty and wordless texts are in no list, and such queries have no rows;
rows of equal query id (nulls are equal) make one query; repeated documents are found one by one;
of equal scores the smaller document id comes first, null ids last; other columns are ignored.  A
text may be longer than ``SHARD_BYTES``: memory follows that, or the longest text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from batchwork.llm import words
from batchwork.session import scratch_path

BLOCK = 128
SHARD_BYTES = 32 << 20
WINDOWS = (256, 1024, 4096)
QUERY_TERMS = 200_000  # query terms, over all queries of a block of queries
_DOCUMENTS = -1  # block number of the row that holds a shard's documents


@dataclass
class Index:
    """The shards' rows, the number of documents with a term and the number of their terms."""

    rows: DataFrame
    n_docs: int
    n_terms: int


# building

def _impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def corpus_size(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """The number of documents with a term, and of their terms with repeats."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs = n_terms = 0
        for batch in batches:
            for b in words.row_blocks(batch, "text"):
                data, offsets = words.text_bytes(b.column("text"))
                inside = words.ALNUM[data] != 0
                first = inside.copy()
                first[1:] &= ~inside[:-1]
                starts = offsets[:-1][offsets[:-1] < len(data)]
                first[starts] |= inside[starts]
                before = np.append(0, np.cumsum(first))[offsets]
                n_docs += int((np.diff(before) > 0).sum())
                n_terms += int(before[-1])
        yield pa.RecordBatch.from_arrays([pa.array([n_docs]), pa.array([n_terms])], names=["n_docs", "n_terms"])
    got = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "n_docs long, n_terms long").agg(
        F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    return got[0], got[1]


class _Shard:
    """Postings of some documents, gathered block of texts by block of texts."""

    def __init__(self, n_docs: int, n_terms: int):
        self.n_docs, self.n_terms = n_docs, n_terms
        self.hasher = words.Hasher(words.ALNUM)
        self.clear()

    def clear(self) -> None:
        self.parts, self.ids, self.m, self.count, self.size = [], [], [], 0, 0

    def add(self, ids: pa.Array, text: pa.Array) -> None:
        data, offsets = words.text_bytes(text)
        h, _, _, row = self.hasher.words(data, offsets)
        n = np.bincount(row, minlength=len(text)).astype(np.int64)
        keep = n > 0
        number = np.cumsum(keep) - 1 + self.count
        order = np.argsort(h, kind="stable")  # rows rise already
        h, row = h[order], row[order]
        first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1]))) if len(h) else np.zeros(0, np.int64)
        tf = np.diff(np.append(first, len(h)))
        self.parts.append((h[first], number[row[first]].astype(np.int32), tf.astype(np.int32)))
        self.ids.append(ids.filter(pa.array(keep)))
        self.m.append([10 + 90 * int(c) * self.n_docs // self.n_terms for c in n[keep]])
        self.count += int(keep.sum())
        self.size += len(data)

    def rows(self, shard: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        """The shard as rows of the index, in the order of terms and blocks; ends with the documents' row."""
        h, number, tf = (np.concatenate(x) for x in zip(*self.parts))
        m = np.array([x for part in self.m for x in part], np.int64)
        order = np.argsort(h, kind="stable")
        h, number, tf = h[order], number[order].astype(np.int64), tf[order].astype(np.int64)
        impact = _impact(tf, m[number])
        start = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
        place = np.arange(len(h)) - np.repeat(start, np.diff(np.append(start, len(h))))
        cut = np.flatnonzero(place % BLOCK == 0)
        n = np.diff(np.append(cut, len(h)))
        in_block = np.repeat(np.arange(len(cut)), n)
        gap = np.where(place % BLOCK == 0, 0, np.append(0, np.diff(number)))
        # bytes a gap and a frequency take: as many as the block's greatest needs, none where all are 0 and 1
        gap_bytes, tf_bytes = (_width(np.maximum.reduceat(x, cut)) if len(cut) else np.zeros(0, np.int64) for x in (gap, tf - 1))
        size = n * (gap_bytes + tf_bytes)
        offsets = np.append(0, np.cumsum(size))
        data = np.zeros(int(offsets[-1]), np.uint8)
        nth = place % BLOCK
        for values, width, base in ((gap, gap_bytes, offsets[:-1]), (tf - 1, tf_bytes, offsets[:-1] + n * gap_bytes)):
            for k in range(int(width.max()) if len(width) else 0):
                at = np.flatnonzero(width[in_block] > k)
                data[base[in_block[at]] + nth[at] * width[in_block[at]] + k] = (values[at] >> (8 * k)) & 255
        top = np.maximum.reduceat(impact, cut) if len(cut) else impact
        last = number[np.append(cut[1:], len(h)) - 1] if len(cut) else number
        for a in range(0, len(cut), 100_000):
            z = min(a + 100_000, len(cut))
            payload = pa.Array.from_buffers(pa.binary(), z - a, [None, pa.py_buffer((offsets[a:z + 1] - offsets[a]).astype(np.int32)), pa.py_buffer(data[offsets[a]:offsets[z]])])
            s = cut[a:z]
            yield _batch(shard, h[s].view(np.int64), place[s] // BLOCK, n[a:z], number[s], last[a:z], top[a:z], gap_bytes[a:z] * 16 + tf_bytes[a:z], payload,
                         pa.nulls(z - a, pa.list_(id_type)), pa.nulls(z - a, pa.list_(pa.int64())))
        ids = pa.concat_arrays(self.ids)
        one = np.zeros(1, np.int64)
        yield _batch(shard, one, one + _DOCUMENTS, one + self.count, one, one, one, one, pa.nulls(1, pa.binary()),
                     pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([m.tolist()], pa.list_(pa.int64())))


def _width(most: np.ndarray) -> np.ndarray:
    return (most > 0).astype(np.int64) + (most > 0xFF) + (most > 0xFFFF) + (most > 0xFFFFFF)


def _batch(shard: int, term, block, n, first, last, top, widths, payload: pa.Array, ids: pa.Array, m: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(term), shard, np.int64)), pa.array(term), *(pa.array(x.astype(np.int32)) for x in (block, n, first, last, top, widths)), payload, ids, m],
        names=["shard", "term", "block", "n", "first", "last", "top", "widths", "payload", "ids", "m"])


def build_index(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Index all documents; the index is written to ``path`` (a fresh scratch folder where none is given)."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "search-index")
    n_docs, n_terms = corpus_size(docs, text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, done, id_type = _Shard(n_docs, max(n_terms, 1)), TaskContext.get().partitionId() << 24, None
        for batch in batches:
            id_type = batch.column("id").type
            for b in words.row_blocks(batch, "text"):
                shard.add(b.column("id"), b.column("text"))
                if shard.size >= SHARD_BYTES:
                    yield from shard.rows(done, id_type) if shard.count else ()
                    shard.clear()
                    done += 1
        if shard.count:
            yield from shard.rows(done, id_type)
    built = rows.mapInArrow(run, "shard long, term long, block int, n int, first int, last int, top int, widths int, payload binary, "
                                 f"ids array<{kind}>, m array<bigint>")
    built.write.parquet(f"{path}/postings")
    spark.createDataFrame([(n_docs, n_terms)], "n_docs long, n_terms long").coalesce(1).write.parquet(f"{path}/size")
    return open_index(spark, path)


def open_index(spark: SparkSession, path: str) -> Index:
    size = spark.read.parquet(f"{path}/size").first()
    return Index(spark.read.parquet(f"{path}/postings"), size.n_docs, size.n_terms)


# searching

class _Lists:
    """One shard's lists of the terms asked for."""

    def __init__(self, rows: pa.Table):
        documents = np.flatnonzero(rows["block"].to_numpy() == _DOCUMENTS)
        ids, self.m = (rows[c].combine_chunks().take(pa.array(documents)).flatten() for c in ("ids", "m"))
        self.ids, self.m = ids, self.m.to_numpy()
        self.place = np.empty(len(ids), np.int64)  # order of the ids, nulls last
        self.place[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
        rows = rows.take(pa.array(np.flatnonzero(rows["block"].to_numpy() != _DOCUMENTS)))
        term, block = rows["term"].to_numpy(), rows["block"].to_numpy()
        order = np.lexsort((block, term))
        term = term[order]
        self.n, self.first, self.last, self.top, self.widths = (rows[c].to_numpy()[order].astype(np.int64) for c in ("n", "first", "last", "top", "widths"))
        self.payload = rows["payload"].combine_chunks().take(pa.array(order))
        start = np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(term) else np.zeros(0, np.int64)
        self.of = {int(t): (int(a), int(z)) for t, a, z in zip(term[start], start, np.append(start[1:], len(term)))}
        self.unpacked: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of a block; unpacked once per shard."""
        got = self.unpacked.get(b)
        if got is None:
            n, gap_bytes, tf_bytes = int(self.n[b]), int(self.widths[b]) // 16, int(self.widths[b]) % 16
            raw = np.frombuffer(self.payload[b].as_py(), np.uint8) if gap_bytes or tf_bytes else np.zeros(0, np.uint8)

            def values(part: np.ndarray, width: int) -> np.ndarray:
                out = np.zeros(n, np.int64)
                for k in range(width):
                    out |= part[k::width].astype(np.int64) << (8 * k)
                return out
            docs = self.first[b] + np.cumsum(values(raw[:n * gap_bytes], gap_bytes))
            got = self.unpacked[b] = docs, _impact(1 + values(raw[n * gap_bytes:], tf_bytes), self.m[docs])
        return got


def _search_shard(lists: _Lists, terms: list[tuple[int, int]], k: int, floor: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Documents (numbers in the shard) and scores that may be among the k best; the caller sends the worst kept score back."""
    have = [(w, *lists.of[t]) for t, w in terms if w > 0 and t in lists.of]
    have = sorted(((w * int(lists.top[a:z].max()), w, a, z) for w, a, z in have))
    if not have:
        return
    together = np.cumsum([x[0] for x in have])
    lo, turn = 0, 0
    while lo < len(lists.m):
        hi = lo + WINDOWS[min(turn, len(WINDOWS) - 1)]
        # lists that can't bring a document in, even all of them together
        rest = int(np.searchsorted(together, floor, "left"))
        if rest == len(have):
            return
        score = np.zeros(min(hi, len(lists.m)) - lo, np.int64)
        for _, w, a, z in have[rest:]:
            for b in range(a + int(np.searchsorted(lists.last[a:z], lo)), a + int(np.searchsorted(lists.first[a:z], hi))):
                docs, impact = lists.block(b)
                if docs[0] < lo or docs[-1] >= hi:
                    s, e = np.searchsorted(docs, (lo, hi))
                    docs, impact = docs[s:e], impact[s:e]
                score[docs - lo] += w * impact
        found = np.flatnonzero(score)
        score, found = score[found], found + lo
        # the block in which a document would stand, and so the most that the list can add
        places, most = [], np.zeros((rest, len(found)), np.int64)
        for j, (_, w, a, z) in enumerate(have[:rest]):
            b = a + np.searchsorted(lists.last[a:z], found)
            inside = b < z
            b = np.minimum(b, z - 1)
            inside &= lists.first[b] <= found
            most[j] = np.where(inside, w * lists.top[b], 0)
            places.append(b)
        bound = score + most.sum(0)
        live = np.flatnonzero(bound >= floor)
        for j in range(rest - 1, -1, -1):
            if not len(live):
                break
            w = have[j][1]
            asked = live[most[j, live] > 0]
            gain = np.zeros(len(found), np.int64)
            for b in np.unique(places[j][asked]).tolist():
                docs, impact = lists.block(b)
                some = asked[places[j][asked] == b]
                at = np.minimum(np.searchsorted(docs, found[some]), len(docs) - 1)
                gain[some] = np.where(docs[at] == found[some], w * impact[at], 0)
            score[asked] += gain[asked]
            bound[asked] += gain[asked] - most[j, asked]
            live = live[bound[live] >= floor]
        if len(live):
            best = live[np.lexsort((lists.place[found[live]], -score[live]))[:k]]
            floor = yield found[best], score[best]
        lo, turn = hi, turn + 1


def _query_terms(queries: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """Distinct (item, term) pairs."""
    rows = queries.select(F.col(item_col).alias("item"), F.col(text_col).alias("text"))
    kind = rows.schema["item"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = words.Hasher(words.ALNUM)
        for batch in batches:
            for b in words.row_blocks(batch, "text"):
                h, _, _, row = hasher.words(*words.text_bytes(b.column("text")))
                yield pa.RecordBatch.from_arrays([b.column("item").take(pa.array(row)), pa.array(h.view(np.int64))], names=["item", "term"])
    return rows.mapInArrow(run, f"item {kind}, term long").distinct()


def search(index: Index, queries: DataFrame, item_col: str = "item_id", text_col: str = "text", k: int = 10) -> DataFrame:
    """The k best documents of each query: item, rank, id, score."""
    from batchwork.llm.common import write_scratch
    pairs = write_scratch(_query_terms(queries, item_col, text_col), "search-terms")
    blocks = max(1, -(-pairs.count() // (QUERY_TERMS // 2)))
    out = None
    for b in range(blocks):
        part = _search_block(index, pairs.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b), k)
        out = part if out is None else out.unionByName(part)
    return out


def _search_block(index: Index, pairs: DataFrame, k: int) -> DataFrame:
    spark = pairs.sparkSession
    item_type, id_type = pairs.schema["item"].dataType.simpleString(), index.rows.schema["ids"].dataType.elementType.simpleString()
    # the frequencies come from the lists' lengths: one number per term of this block of queries
    asked = F.broadcast(pairs.select("term").distinct())  # of QUERY_TERMS rows or so
    df = dict(index.rows.where(F.col("block") >= 0).select("term", "n").join(asked, "term").groupBy("term").agg(F.sum("n")).collect())
    weight = {t: math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    by_item: dict = {}
    for item, term in pairs.collect():
        if weight.get(term, 0) > 0:
            by_item.setdefault(item, []).append((term, weight[term]))
    sent = spark.sparkContext.broadcast(list(by_item.items()))
    arrow_item, arrow_id = pairs.limit(0).toArrow().schema.field("item").type, index.rows.select("ids").limit(0).toArrow().schema.field("ids").type.value_type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = sent.value
        best: list[list] = [[] for _ in queries]  # (-score, id is null, id)
        for rows in _shards(batches):
            lists = _Lists(rows)
            for q, (_, terms) in enumerate(queries):
                mine = best[q]
                hits = _search_shard(lists, terms, k, -mine[-1][0] if len(mine) == k else 1)
                got = next(hits, None)
                while got is not None:
                    ids = lists.ids.take(pa.array(got[0])).to_pylist()
                    mine.extend((-s, i is None, i) for s, i in zip(got[1].tolist(), ids) if s > 0)
                    mine.sort(key=lambda x: x if x[2] is not None else x[:2])
                    del mine[k:]
                    try:
                        got = hits.send(-mine[-1][0] if len(mine) == k else 1)
                    except StopIteration:
                        got = None
        flat = [(item, i, -s) for (item, _), mine in zip(queries, best) for s, _, i in mine]
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in flat], arrow_item), pa.array([x[1] for x in flat], arrow_id), pa.array([x[2] for x in flat], pa.int64())],
                                         names=["item", "id", "score"])
    documents_too = F.broadcast(pairs.select("term").distinct().union(spark.sql("SELECT 0L")))  # their rows have term 0
    lists = index.rows.join(documents_too, "term", "left_semi")
    heaps = lists.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, f"item {item_type}, id {id_type}, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item", "rank", "id", "score")


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one shard after another (they come sorted by shard)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        cuts = np.append(np.flatnonzero(np.diff(shard)) + 1, len(shard))
        at = 0
        for z in cuts.tolist():
            if z > at:
                if held and held[-1].column("shard")[0].as_py() != shard[at]:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(at, z - at))
                at = z
    if held:
        yield pa.Table.from_batches(held)
