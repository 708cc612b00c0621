"""SentencePiece encoding and decoding by suffix-array matching.

The texts of a batch are normalised and cut where no piece can reach across (before a space
mark that follows other characters, and around characters that stand in no longer piece).
The distinct cuts are concatenated and indexed by a suffix array, sorted as deep as the
longest piece.  Every piece of the vocabulary is then looked up by binary search; its range
in the array gives all its occurrences as edges, which are sorted by position and relaxed:

* unigram models: the path of best total score (Viterbi), one position after another;
* BPE models: in each cut the applicable edge (its two halves are present symbols) with the
  best score, leftmost first, is contracted, until none applies.

Characters outside the vocabulary become byte pieces where the model has them, else the
unknown piece.  The result equals the reference implementation's own encoding.

Defined results: null and empty texts have no tokens and decode to the empty text; repeated
rows and null ids are encoded row by row; memory follows the block of texts and
``INDEX_CHARS``, or the longest single cut.  Models whose normaliser rewrites characters, or
with user-defined pieces, are refused.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchwork.llm import words

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
INDEX_CHARS = 1 << 18
MAX_CACHED = 250_000
BLOCK_BYTES = 4 << 20
LONG_CUT = 64
# wire numbers of the public model format
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = raw[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out
    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            n = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield key >> 3, raw[at:at + n]
            at += n


@dataclass
class Model:
    """The vocabulary and what the encoder needs to know of it."""

    pieces: list[str]
    scores: np.ndarray
    kinds: list[int]
    is_bpe: bool
    dummy_prefix: bool
    ids: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        if _USER in self.kinds or _UNUSED in self.kinds:
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == _NORMAL}
        self.bytes = {int(p[1:-1], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == _BYTE}
        self.unknown = self.kinds.index(_UNKNOWN)
        chars = sorted({c for p in self.ids for c in p})
        if len(chars) >= 0xFFFF:
            raise ValueError("the vocabulary has too many characters")
        self.codes = np.zeros(0x110000, np.uint16)
        self.codes[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        longer = [p for p in self.ids if len(p) > 1]
        self.depth = max([4, *map(len, longer)])
        alone = "".join(c for c in "\n\t\r" if not any(c in p for p in longer))
        inner = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in longer)
        a = re.escape(alone)
        self.cut = re.compile((f"[{a}]|" if a else "") + (f"[^{a}]+" if inner else f"{SPACE}*[^{SPACE}{a}]+|{SPACE}+"), re.S)
        self.single = np.full(len(chars) + 1, -1, np.int64)
        for c, i in self.ids.items():
            if len(c) == 1:
                self.single[self.codes[ord(c)]] = i
        # longer pieces, as code columns of four 16-bit codes, first code on top
        self.long_ids = np.array([self.ids[p] for p in longer], np.int64)
        self.long_size = np.array([len(p) for p in longer], np.int64)
        width = -(-self.depth // 4) * 4
        low, high = np.zeros((len(longer), width), np.uint64), np.full((len(longer), width), 0xFFFF, np.uint64)
        for r, p in enumerate(longer):
            low[r, :len(p)] = high[r, :len(p)] = self.codes[[ord(c) for c in p]]
        self.low, self.high = _pack(low), _pack(high)
        self.table = [self._decoded(i) for i in range(len(self.pieces))]

    def _decoded(self, i: int) -> bytes:
        kind = self.kinds[i]
        if kind == _BYTE:
            return bytes([int(self.pieces[i][1:-1], 16)])
        return b"" if kind == _CONTROL else b" \xe2\x81\x87 " if kind == _UNKNOWN else self.pieces[i].replace(SPACE, " ").encode()


def _pack(codes: np.ndarray) -> list[np.ndarray]:
    return [(codes[:, j] << np.uint64(48)) | (codes[:, j + 1] << np.uint64(32)) | (codes[:, j + 2] << np.uint64(16)) | codes[:, j + 3]
            for j in range(0, codes.shape[1], 4)]


def read_model(raw: bytes) -> Model:
    pieces, scores, kinds, is_bpe, dummy, charsmap, squeeze = [], [], [], False, True, b"", True
    for number, value in _fields(raw):
        if number == 1:
            got = dict(_fields(value))
            pieces.append(got.get(1, b"").decode())
            scores.append(float(np.frombuffer(got.get(2, bytes(4)), "<f4")[0]))
            kinds.append(got.get(3, _NORMAL))
        elif number == 2:
            is_bpe = dict(_fields(value)).get(3, 1) == 2
        elif number == 3:
            got = dict(_fields(value))
            charsmap, dummy, squeeze = got.get(2, b""), bool(got.get(3, 1)), bool(got.get(4, 1))
    if charsmap or squeeze:
        raise ValueError("models whose normaliser rewrites the text are not supported")
    return Model(pieces, np.array(scores), kinds, is_bpe, dummy)


def load_model(path: str = MODEL) -> bytes:
    """The model file; read on the driver and sent to the tasks (about half a megabyte)."""
    with open(path, "rb") as f:
        return f.read()


def suffix_array(codes: np.ndarray, depth: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix order by the first ``depth`` codes, and the packed code columns in that order.

    Ranks of the first four codes are doubled until they reach as deep as needed.
    """
    n = len(codes)
    wide = np.append(codes.astype(np.uint64), np.zeros(-(-depth // 4) * 4 + 4, np.uint64))
    grams = (wide[:-3] << np.uint64(48)) | (wide[1:-2] << np.uint64(32)) | (wide[2:-1] << np.uint64(16)) | wide[3:]
    rank, reach = np.unique(grams[:n], return_inverse=True)[1].astype(np.uint64) + np.uint64(1), 4
    while reach < depth:
        ahead = np.append(rank[reach:], np.zeros(min(reach, n), np.uint64))[:n]
        rank, reach = np.unique((rank << np.uint64(32)) | ahead, return_inverse=True)[1].astype(np.uint64) + np.uint64(1), reach * 2
    order = np.argsort(rank)
    return order, [grams[np.minimum(order + j, len(grams) - 1)] for j in range(0, -(-depth // 4) * 4, 4)]


def _bisect(columns: list[np.ndarray], keys: list[np.ndarray], right: bool) -> np.ndarray:
    """The place of each key in the sorted columns (a binary search over all keys at once)."""
    n = len(columns[0])
    lo, hi = np.zeros(len(keys[0]), np.int64), np.full(len(keys[0]), n, np.int64)
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = np.minimum((lo + hi) // 2, n - 1)
        less, same = np.zeros(len(lo), bool), np.ones(len(lo), bool)
        for c, k in zip(columns, keys):
            v = c[mid]
            less |= same & (v < k)
            same &= v == k
        go = open_ & (less | same if right else less)
        lo, hi = np.where(go, mid + 1, lo), np.where(open_ & ~go, mid, hi)


def edges(model: Model, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and piece of every occurrence of a longer piece, sorted by position."""
    order, columns = suffix_array(codes, model.depth)
    lo, hi = _bisect(columns, model.low, False), _bisect(columns, model.high, True)
    n = hi - lo
    which = np.repeat(np.arange(len(n)), n)
    at = order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
    by = np.argsort(at, kind="stable")
    at, which = at[by], which[by]
    return at, at + model.long_size[which], model.long_ids[which]


def _viterbi(model: Model, codes: np.ndarray, e: tuple, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Boundary flags of the best-scored path in each cut, and the piece that starts at each."""
    n = len(codes)
    single = model.single[codes]
    s, t, piece = (np.append(x, y) for x, y in zip(e, (np.arange(n), np.arange(n) + 1, single)))
    w = np.where(piece >= 0, model.scores[piece], model.scores.min() - 10.0)
    cut = np.searchsorted(starts, s, "right") - 1
    step = t - starts[cut]
    ok = t <= ends[cut]
    by = np.lexsort((s[ok], step[ok]))  # all cuts take their first place together, then the second, ...
    s, t, w, step, piece = (x[ok][by] for x in (s, t, w, step, piece))
    total, origin, via = np.full(n + 1, -np.inf), np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
    is_start = np.zeros(n + 1, bool)
    is_start[starts] = True
    turns = np.flatnonzero(np.append(True, step[1:] != step[:-1])) if len(step) else np.zeros(0, np.int64)
    for a, b in zip(turns, np.append(turns[1:], len(step))):
        reach = np.where(is_start[s[a:b]], 0.0, total[s[a:b]]) + w[a:b]
        order = np.lexsort((-reach, t[a:b]))
        head = order[np.append(True, t[a:b][order][1:] != t[a:b][order][:-1])]
        to = t[a:b][head]
        total[to], origin[to], via[to] = reach[head], s[a:b][head], piece[a:b][head]
    flags, first = np.zeros(n + 1, bool), np.full(n + 1, -1, np.int64)
    at, stop = ends[ends > starts], starts[ends > starts]
    while len(at):
        flags[at] = True
        first[origin[at]] = via[at]
        at = origin[at]
        at, stop = at[at > stop], stop[at > stop]
    return flags, first


def _contract(model: Model, codes: np.ndarray, e: tuple, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Boundary flags after all BPE contractions in each cut, and the piece that starts at each."""
    n = len(codes)
    flags, piece_at = np.ones(n + 1, bool), np.append(model.single[codes], -1)
    s, t, piece = e
    cut = np.searchsorted(starts, s, "right") - 1
    score = model.scores[piece]
    long_cut = (ends - starts > LONG_CUT)[cut]
    for c in np.unique(cut[long_cut]):
        of = cut == c
        _contract_long(flags, piece_at, s[of], t[of], score[of], piece[of], int(starts[c]), int(ends[c]))
    s, t, cut, score, piece = (x[~long_cut] for x in (s, t, cut, score, piece))
    by = np.lexsort((s, -score, cut))
    s, t, cut, piece = (x[by] for x in (s, t, cut, piece))
    live = np.zeros(len(starts), bool)
    while len(s):
        before = np.cumsum(flags, dtype=np.int32)  # flags up to and including each place
        ready = np.flatnonzero(before[t - 1] - before[s] == 1)
        if not len(ready):
            break
        first = ready[np.append(True, cut[ready][1:] != cut[ready][:-1])]
        inner = np.searchsorted(before, before[s[first]] + 1)  # the one boundary between
        flags[inner] = False
        piece_at[s[first]] = piece[first]
        live[:] = False
        live[cut[first]] = True
        keep = live[cut] & flags[s] & flags[t]
        keep[first] = False
        s, t, cut, piece = s[keep], t[keep], cut[keep], piece[keep]
    return flags, piece_at


def _contract_long(flags: np.ndarray, piece_at: np.ndarray, s: np.ndarray, t: np.ndarray, score: np.ndarray, piece: np.ndarray,
                   start: int, end: int) -> None:
    """The same for one long cut, with a heap over pairs of neighbouring symbols."""
    known = {(a, b): (-v, i) for a, b, v, i in zip(s.tolist(), t.tolist(), score.tolist(), piece.tolist())}
    following, previous = {i: i + 1 for i in range(start, end)}, {i: i - 1 for i in range(start + 1, end)}
    heap: list[tuple[float, int, int, int]] = []

    def push(left: int) -> None:
        middle = following[left]
        if middle < end and (left, following[middle]) in known:
            heapq.heappush(heap, (known[left, following[middle]][0], left, middle, following[middle]))
    for i in range(start, end):
        push(i)
    while heap:
        _, left, middle, right = heapq.heappop(heap)
        if following.get(left) != middle or following.get(middle) != right:
            continue
        flags[middle] = False
        piece_at[left] = known[left, right][1]
        following[left] = right
        del following[middle]
        if right < end:
            previous[right] = left
        push(left)
        if left > start:
            push(previous[left])


def encode_cuts(model: Model, cuts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The token ids of all cuts, one after another, and how many each has."""
    chars = np.frombuffer("\0".join(cuts).encode("utf-32-le"), np.uint32)
    codes = model.codes[chars]
    sizes = np.array([len(c) for c in cuts])
    starts = np.cumsum(sizes + 1) - sizes - 1
    ends = starts + sizes
    codes[ends[:-1]] = 0  # between cuts stands a code of no piece
    flags, piece_at = (_contract if model.is_bpe else _viterbi)(model, codes, edges(model, codes), starts, ends)
    flags[starts] = flags[ends] = True
    at = np.flatnonzero(flags)
    at = at[np.append(np.diff(at) > 0, False)]
    separator = np.zeros(len(codes) + 1, bool)
    separator[ends] = True
    at = at[~separator[at]]
    ids = piece_at[at]
    strange = np.flatnonzero(ids < 0)
    count = np.ones(len(at), np.int64)
    spelt = []
    for k in strange.tolist():
        raw = chr(chars[at[k]]).encode()
        spelt.append([model.bytes[x] for x in raw] if model.bytes else [model.unknown])
        count[k] = len(spelt[-1])
    out = np.repeat(ids, count)
    if spelt:
        first = (np.cumsum(count) - count)[strange]
        for f, part in zip(first.tolist(), spelt):
            out[f:f + len(part)] = part
    per_cut = np.bincount(np.searchsorted(starts, at, "right") - 1, count, len(cuts)).astype(np.int64)
    return out.astype(np.int32), per_cut


class Encoder:
    """Encodes blocks of texts; keeps the ids of known cuts between blocks, up to MAX_CACHED."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The token ids of all texts, one after another, and the offsets of the texts in them."""
        m = self.model
        if len(self.known) > MAX_CACHED:
            self.clear()
        prefix = SPACE if m.dummy_prefix else ""
        cut_up = [m.cut.findall((prefix + t).replace(" ", SPACE)) if t else [] for t in texts]
        known = self.known
        fresh = [c for c in dict.fromkeys(chain.from_iterable(cut_up)) if c not in known]
        for part in self._parts(fresh):
            known.update(zip(part, range(len(known), len(known) + len(part))))
            ids, sizes = encode_cuts(m, part)
            self.ids, self.sizes = np.append(self.ids, ids), np.append(self.sizes, sizes)
        which = np.fromiter(map(known.__getitem__, chain.from_iterable(cut_up)), np.int64)
        size = self.sizes[which]
        done = np.append(0, np.cumsum(size))
        begin = (np.cumsum(self.sizes) - self.sizes)[which]
        flat = self.ids[np.arange(done[-1]) + np.repeat(begin - done[:-1], size)]
        return flat, done[np.append(0, np.cumsum([len(c) for c in cut_up])).astype(np.int64)]

    @staticmethod
    def _parts(cuts: list[str]) -> Iterator[list[str]]:
        at = 0
        while at < len(cuts):
            end, size = at, 0
            while end < len(cuts) and (size == 0 or size + len(cuts[end]) < INDEX_CHARS):
                size += len(cuts[end]) + 1
                end += 1
            yield cuts[at:end]
            at = end


def decode_ids(model: Model, ids) -> str:
    raw = b"".join(map(model.table.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids))
    text = raw.decode("utf-8", "replace")
    return text[1:] if model.dummy_prefix and text[:1] == " " else text


def encode(docs: DataFrame, text_col: str = "text", ids_col: str = "ids", model: str = MODEL, decoded_col: str | None = None) -> DataFrame:
    """``docs`` with a column of token ids and, where named, one of the text decoded from them again."""
    sent = docs.sparkSession.sparkContext.broadcast(load_model(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(read_model(sent.value))
        for batch in batches:
            row = batch.column("row")
            both = pa.RecordBatch.from_arrays([row, row.field(text_col)], names=["row", "text"])
            for b in words.row_blocks(both, "text", BLOCK_BYTES):
                flat, offsets = encoder.encode([t or "" for t in b.column("text").to_pylist()])
                out = [b.column("row"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))]
                if decoded_col:
                    out.append(pa.array([decode_ids(encoder.model, flat[a:z]) for a, z in zip(offsets[:-1], offsets[1:])], pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=["row", "ids", "text"][:len(out)])
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    kind = rows.schema["row"].dataType.simpleString()
    encoded = rows.mapInArrow(run, f"row {kind}, ids array<int>" + (", text string" if decoded_col else ""))
    return encoded.select("row.*", F.col("ids").alias(ids_col), *([F.col("text").alias(decoded_col)] if decoded_col else []))


def decode(rows: DataFrame, ids_col: str = "ids", text_col: str = "decoded", model: str = MODEL) -> DataFrame:
    """``rows`` with a column of the text that the ids stand for (null ids: empty)."""
    sent = rows.sparkSession.sparkContext.broadcast(load_model(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = read_model(sent.value)
        for b in batches:
            lists = b.column("row").field(ids_col)
            for at in range(0, b.num_rows, 1000):
                part = lists.slice(at, 1000)
                texts = [decode_ids(m, x.values.to_numpy()) if x.is_valid else "" for x in part]
                yield pa.RecordBatch.from_arrays([b.column("row").slice(at, 1000), pa.array(texts, pa.string())], names=["row", "text"])
    cols = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"))
    kind = cols.schema["row"].dataType.simpleString()
    return cols.mapInArrow(run, f"row {kind}, text string").select("row.*", F.col("text").alias(text_col))
