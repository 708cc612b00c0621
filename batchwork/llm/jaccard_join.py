"""Exact Jaccard self-join of shingle sets in a metric space.

Points are the distinct shingle sets (equal sets are one point).  Jaccard distance is a
metric, and so is the distance of the sets' bucket counts (a point's *profile*), which is
never larger: it bounds the true distance from below at a small cost.

Regions.  In a text corpus nearly all points are at distance 1 from each other, so pivots
drawn blindly would leave everything in one region.  But two points within the radius share
one of the few rarest shingles of each; hence the first regions are those around the shared
rare shingles, each with the point of lowest rank as its pivot.  A point has a region for
each of its rare shingles that others share.  It is compared with its nearest pivot first
(that of most of its regions), then replicated to the other regions whose pivots it does not
already hang together with and where sizes, places and bounds leave a link possible.

Blocked comparison.  A region whose members (all but its pivot) do not all hang together takes new
pivots: in each of the first ``SINGLE`` rounds one, any of its members, which the open points meet,
so that labels spread; then, among the points still open, ``PIVOTS`` times as many in each round,
which all members meet.  A region whose members have become one, or whose open points have all
met the others, drops out.  A round compares the pivots with the members inside
the triangle-inequality window: |d(x, p) - d(q, p)| <= radius.  The members are not dealt out to
sub-regions, so a region whose members stay open is met pair by pair; pairs already known to hang
together, pairs whose places of the shared shingle leave too few common ones, and pairs whose
*sketches* (256 bits: is the bucket's count odd?) differ in more bits than linked sets can, go no further.  Every pair that could be within the radius is either
compared in full or already joined through a pivot, so the components are exact.

Rarity comes from a table of hashed counts of fixed size, filled from every shingle of every
document; it settles the order alone, and any common order gives exact results.

Defined results: a text with fewer words than a shingle is one shingle; null and empty texts
have empty sets, linked with nothing; repeated rows and ids are returned row by row and hang
together where their sets are equal; null ids rank after all others as component names;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from batchwork.llm import words
from batchwork.llm.common import one_null_row, text_hash, text_or_empty, without, write_pairs, write_scratch

SHINGLE = 5
PERCENT = 80
COUNT_BITS = 22
BUCKETS = 256
CHUNK = 1 << 16
SINGLE = 4  # rounds with one new pivot per region, in which labels spread
PIVOTS = 4  # after those, each round takes so many times the new pivots of the one before


def shingle_sets(text: pa.Array, hasher: words.Hasher, k: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    h, _, _, row = hasher.words(*words.text_bytes(text))
    odd = words.mix(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    cuts = np.searchsorted(row, np.arange(len(text) + 1))
    n = len(h) - k + 1
    rolled = np.zeros(max(n, 0), np.uint64)
    for j in range(k if n > 0 else 0):
        rolled += h[j:j + n] * odd[j]
    rolled = words.mix(rolled)
    out = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b - a >= k:
            out.append(np.unique(rolled[a:b - k + 1]))
        else:
            whole = h[a:b] * odd[:b - a]
            out.append(words.mix(whole.sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)) if b > a else np.zeros(0, np.uint64))
    return out


def prefix_size(n: int, percent: int) -> int:
    """So many tokens that two sets within the threshold share one of them, in any common order."""
    return n - -(-n * percent // 100) + 1


def profile(s: np.ndarray) -> bytes:
    """Counts of the hashes' top bits, 255 at most (the cap can only lower the distance)."""
    return np.minimum(np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=BUCKETS), 255).astype(np.uint8).tobytes()


def sketch(counts: bytes) -> list[int]:
    """Which of a profile's counts are odd, as four 64-bit numbers: two sets differ by a shingle at least per differing bit."""
    return np.packbits(np.frombuffer(counts, np.uint8) & 1).view(np.int64).tolist()


def digest_of(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def rank_of(digest: bytes) -> int:
    """A point's name in regions and links: a random 64-bit order."""
    return int.from_bytes(digest[:8], "little", signed=True)


def _smallest(counts: np.ndarray) -> np.ndarray:
    """The counts in the narrowest type that holds them."""
    most = int(counts.max(initial=0))
    return counts.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32)


def rarity_table(texts: DataFrame, bits: int = COUNT_BITS, shingle: int = SHINGLE) -> np.ndarray:
    """Hashed counts of all shingles (each once per text): 2**bits numbers.

    Every task counts its own texts; the tables meet chunk by chunk, and their sum, of a
    size that does not depend on the data, goes to all tasks.
    """
    chunk = min(CHUNK, 1 << bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, total = words.Hasher(words.WHITESPACE), np.zeros(1 << bits, np.uint32)
        for batch in batches:
            for b in words.row_blocks(batch, "text"):
                sets = shingle_sets(b.column("text"), hasher, shingle)
                slots, n = np.unique((np.concatenate(sets) >> np.uint64(64 - bits)).astype(np.int64), return_counts=True)
                total[slots] += n.astype(np.uint32)
        for at in range(0, 1 << bits, chunk):
            part = _smallest(total[at:at + chunk])
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([part.itemsize], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["at", "width", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}  # at most 2**bits / chunk entries
        for b in batches:
            for at, width, raw in zip(*(b.column(c).to_pylist() for c in ("at", "width", "counts"))):
                sums.setdefault(at, np.zeros(chunk, np.uint64))[:] += np.frombuffer(raw, f"u{width}")
        for at, total in sums.items():
            part = _smallest(np.minimum(total, (1 << 32) - 1))
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([part.itemsize], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["at", "width", "counts"])
    schema = "at long, width int, counts binary"
    table = np.zeros(1 << bits, np.uint32)
    for r in texts.mapInArrow(count, schema).repartition("at").mapInArrow(add, schema).toLocalIterator():
        table[r["at"]:r["at"] + chunk] += np.frombuffer(r.counts, f"u{r.width}")
    return _smallest(table)


def describe(docs: DataFrame, id_col: str, text_col: str, percent: int, bits: int, shingle: int) -> DataFrame:
    """id, text_hash, n (set size), digest, rank, prefix (rarest shingles), profile and sketch of every row."""
    texts = docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("text_hash"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = docs.sparkSession.sparkContext.broadcast(rarity_table(texts.select("text"), bits, shingle))  # 2**bits numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, hasher = order.value, words.Hasher(words.WHITESPACE)
        for batch in batches:
            for b in words.row_blocks(batch, "text"):
                sets = shingle_sets(b.column("text"), hasher, shingle)
                prefixes, profiles, digests = [], [profile(s) for s in sets], [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                for s in sets:
                    by = np.lexsort((s, counts[(s >> np.uint64(64 - bits)).astype(np.int64)]))
                    prefixes.append(s[by[:prefix_size(len(s), percent)]].view(np.int64) if len(s) else np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), b.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()),
                     pa.array([rank_of(d) for d in digests], pa.int64()),
                     pa.array(prefixes, pa.list_(pa.int64())), pa.array(profiles, pa.binary()),
                     pa.array([sketch(c) for c in profiles], pa.list_(pa.int64()))],
                    names=["id", "text_hash", "n", "digest", "rank", "prefix", "profile", "sketch"])
    id_type = texts.schema["id"].dataType.simpleString()
    out = write_scratch(texts.mapInArrow(run, f"id {id_type}, text_hash long, n long, digest binary, rank long, prefix array<long>, profile binary, sketch array<long>"), "jaccard-rows")
    order.destroy()  # the rows are written
    return out


def bounded(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """x, p with ``delta``, a lower bound of their distance that is a metric, and ``possible`` (may be linked)."""
    a = points.select(F.col("rank").alias("x"), F.col("n").alias("nx"), F.col("profile").alias("fx"))
    b = points.select(F.col("rank").alias("p"), F.col("n").alias("np"), F.col("profile").alias("fp"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            if t.num_rows:
                fx, fp = (np.frombuffer(b"".join(t.column(c).to_pylist()), np.uint8).reshape(-1, BUCKETS).astype(np.int16) for c in ("fx", "fp"))
                nx, n_p = t.column("nx").to_numpy(), t.column("np").to_numpy()
                apart = np.maximum(np.abs(fx - fp).sum(1, dtype=np.int64), np.abs(nx - n_p))
                common = (nx + n_p - apart) // 2
                union = nx + n_p - common
                yield pa.RecordBatch.from_arrays([t.column("x"), t.column("p"), pa.array(1 - common / union), pa.array(100 * common >= percent * union)],
                                                 names=["x", "p", "delta", "possible"])
    return pairs.join(a, "x").join(b, "p").select("x", "p", "nx", "np", "fx", "fp").mapInArrow(run, "x long, p long, delta double, possible boolean")


def linked(pairs: DataFrame, points: DataFrame, docs: DataFrame, id_col: str, text_col: str, percent: int, shingle: int, name: str) -> DataFrame:
    """Those of the pairs (x, p) whose sets are within the threshold, compared in full."""
    needed = pairs.select(F.explode(F.array("x", "p")).alias("rank")).distinct()
    ids = points.join(needed, "rank").select("id").distinct()
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.join(ids, texts["id"].eqNullSafe(ids["id"]), "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = words.Hasher(words.WHITESPACE)
        for batch in batches:
            for b in words.row_blocks(batch, "text", 1 << 20):
                sets = shingle_sets(b.column("text"), hasher, shingle)
                yield pa.RecordBatch.from_arrays([pa.array([rank_of(digest_of(s)) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["rank", "s"])
    sets = write_scratch(texts.mapInArrow(run, "rank long, s array<long>").join(needed, "rank", "left_semi").dropDuplicates(["rank"]), f"{name}-sets")
    both = pairs.join(sets.select(F.col("rank").alias("x"), F.col("s").alias("sx")), "x").join(sets.select(F.col("rank").alias("p"), F.col("s").alias("sp")), "p")
    common = F.size(F.array_intersect("sx", "sp"))
    return both.select("x", "p", common.alias("c"), (F.size("sx") + F.size("sp") - common).alias("u")).where(f"100 * c >= {percent} * u").select("x", "p")


def _stars(now: DataFrame) -> DataFrame:
    """One round of large and small stars over edges (a, b) with a > b: all still hang together, most nearer to their smallest node."""
    both = now.union(now.select("b", "a"))
    least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(least, both["a"] == least["u"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")  # the last distinct holds
    least = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    small = large.join(least, large["a"] == least["u"])
    return small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("u", "m")).where("a != b").distinct()


def _downwards(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()


def components(edges: DataFrame, name: str = "components", most_rounds: int = 99) -> DataFrame:
    """node, root for every node of the undirected edges (a, b); root is the smallest node.

    Alternating large and small stars; each round is written to the shared folder.  If the
    last of ``most_rounds`` rounds still changed something, the components would be split: an error.
    """
    now = write_pairs(_downwards(edges), f"{name}-0")
    seen = None
    for step in range(1, most_rounds + 1):
        now = write_pairs(_stars(now), f"{name}-{step}")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    else:
        raise RuntimeError(f"components are still changing after {most_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _gathered(links: DataFrame, name: str, before: DataFrame | None = None) -> DataFrame:
    """Links (x, p) that stand for ``links`` and those of ``before``: both together, drawn towards their smallest points by one round of stars."""
    edges = links if before is None else links.union(before)
    # written first: the round reads it four times, which else takes as many times all shuffle partitions in tasks
    now = write_pairs(_downwards(edges.select(F.col("x").alias("a"), F.col("p").alias("b"))), f"{name}-links")
    now = write_pairs(_stars(now), name)
    return now.select(F.col("a").alias("x"), F.col("b").alias("p"))


def _labels(links: DataFrame, name: str) -> DataFrame:
    """x, label: the smallest point that x is linked with."""
    return write_pairs(links.groupBy("x").agg(F.min("p").alias("label")), name)


def link_points(rows: DataFrame, docs: DataFrame, id_col: str, text_col: str, percent: int, shingle: int) -> DataFrame:
    """Links (x, p) between ranks that connect all points within the radius."""
    radius = 1 - percent / 100
    points = write_scratch(rows.where("n > 0").groupBy("rank").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("profile").alias("profile"), F.first("sketch").alias("sketch"), F.first("prefix").alias("prefix")), "jaccard-points")
    # one posting per set and token, dealt by token once: its pivot and the regions read the same exchange
    postings = points.select("rank", F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("pos", "token"))
    postings = postings.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "token")
    points = points.drop("prefix")
    pivots = postings.groupBy("token").agg(F.min(F.struct("rank", "n", "pos")).alias("v"), F.count(F.lit(1)).alias("m")).where("m > 1").select("token", "v")
    shared = write_scratch(postings.join(pivots, "token").where("rank != v.rank").select(
        "token", F.col("rank").alias("x"), "pos", "n", F.col("v.rank").alias("p"), F.col("v.pos").alias("pos_p"), F.col("v.n").alias("n_p")), "jaccard-regions")

    def enough(other: str):
        """Can a pair reach the threshold if this region's token is its first common one?  The
        tokens before it are then not common, and the region of its first common token is
        one of each linked pair's regions."""
        most = F.least(F.col("n") - F.col("pos"), F.col(f"n_{other}") - F.col(f"pos_{other}"))
        return 100 * most >= percent * (F.col("n") + F.col(f"n_{other}") - most)

    def compare(pairs: DataFrame, name: str) -> DataFrame:
        possible = write_pairs(bounded(pairs, points, percent).where("possible").select("x", "p"), f"{name}-possible")
        if possible.isEmpty():
            return possible
        return write_pairs(linked(possible, points, docs, id_col, text_col, percent, shingle, name), f"{name}-links")

    # each point with its nearest pivot: the one of most of its regions
    nearest = shared.groupBy("x", "p").agg(F.count(F.lit(1)).alias("k")).groupBy("x").agg(F.max_by("p", F.struct("k", "p")).alias("p"))
    nearest = write_pairs(nearest, "jaccard-nearest")
    links = _gathered(compare(nearest, "jaccard-0"), "jaccard-stars-0")
    labels = _labels(links, "jaccard-labels-0")

    def labelled(df: DataFrame, point: str, name: str) -> DataFrame:
        of = labels.select(F.col("x").alias(point), F.col("label").alias(name))
        return df.join(of, point, "left").withColumn(name, F.coalesce(name, point))

    # the boundary: pivots of other regions that it does not yet hang together with
    open_pairs = labelled(labelled(shared.where(enough("p")).select("x", "p").distinct(), "x", "lx"), "p", "lp").where("lx != lp").select("x", "p")
    links = _gathered(compare(open_pairs.join(nearest, ["x", "p"], "left_anti"), "jaccard-1"), "jaccard-stars-1", links)
    labels = _labels(links, "jaccard-labels-1")

    # every member has met its pivot; what is left is pairs of members that do not hang together
    def placed(members: DataFrame, name: str) -> DataFrame:
        """Members with their labels of now, of those regions whose members have several."""
        state = labelled(labelled(members, "x", "label"), "p", "lp").withColumn("open", F.col("label") != F.col("lp"))
        return apart(state.drop("lp"), name)

    def apart(state: DataFrame, name: str) -> DataFrame:
        busy = state.groupBy("token").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least != most")
        return write_scratch(state.join(busy.select("token"), "token", "left_semi"), name)

    def window(q: DataFrame, members: DataFrame) -> DataFrame:
        """Pairs of members and new pivots that the triangle inequality, the shared shingle's places and the sketches leave possible."""
        odd = sum((F.bit_count(F.get("sketch", F.lit(i)).bitwiseXOR(F.get("sketch_q", F.lit(i)))) for i in range(4)), F.lit(0))
        common = F.floor((F.col("n") + F.col("n_q") - odd) / 2)  # at most
        near = (F.col("label") != F.col("lq")) & (F.abs(F.col("delta") - F.col("dq")) <= radius + 1e-9) & enough("q")
        near = near & (100 * common >= percent * (F.col("n") + F.col("n_q") - common))
        return members.join(q, "token").where((F.col("x") != F.col("q")) & near).select(F.greatest("x", "q").alias("x"), F.least("x", "q").alias("p")).distinct()

    as_pivot = [F.col("x").alias("q"), F.col("pos").alias("pos_q"), F.col("n").alias("n_q"), F.col("label").alias("lq"), F.col("delta").alias("dq"), F.col("sketch").alias("sketch_q")]
    members = placed(shared.select("token", "x", "pos", "n", "p"), "jaccard-busy")
    if members.isEmpty():
        return links
    deltas = bounded(members.select("x", "p").distinct(), points, percent).select("x", "p", "delta")
    members = write_scratch(members.join(deltas, ["x", "p"]).join(points.select(F.col("rank").alias("x"), "sketch"), "x"), "jaccard-members-0")
    tried = None
    for level in range(1, SINGLE + 1):
        # one further pivot per region, any member: the open ones meet it, and labels spread
        q = members.groupBy("token").agg(F.min_by(F.struct(*as_pivot), F.xxhash64("x", F.lit(level))).alias("v")).select("token", "v.*")
        pairs = window(q, members.where("open"))
        fresh = write_pairs(pairs if tried is None else pairs.join(tried, ["x", "p"], "left_anti"), f"jaccard-pairs-{level}")
        tried = fresh if tried is None else tried.union(fresh)
        found = compare(fresh, f"jaccard-level-{level}")
        if found.isEmpty():
            continue
        links = _gathered(found, f"jaccard-stars-{level + 1}", links)
        labels = _labels(links, f"jaccard-labels-{level + 1}")
        members = placed(members.drop("label", "open"), f"jaccard-members-{level}")
        if members.isEmpty():
            return links
    # what is still open meets every member of its regions
    members, level = members.withColumn("left", F.col("open")), SINGLE + 1
    while True:
        new = PIVOTS ** (level - SINGLE)
        by = Window.partitionBy("token").orderBy(F.col("left").desc(), "x")
        members = members.withColumn("k", F.row_number().over(by)).withColumn("now", F.col("left") & (F.col("k") <= new)).drop("k")
        members = write_scratch(members.withColumn("left", F.col("left") & ~F.col("now")), f"jaccard-turn-{level}")
        fresh = write_pairs(window(members.where("now").select("token", *as_pivot), members).join(tried, ["x", "p"], "left_anti"), f"jaccard-pairs-{level}")
        tried = tried.union(fresh)
        found = compare(fresh, f"jaccard-level-{level}")
        if not found.isEmpty():
            links = _gathered(found, f"jaccard-stars-{level + 1}", links)
            labels = _labels(links, f"jaccard-labels-{level + 1}")
        goes_on = members.groupBy("token").agg(F.bool_or("left").alias("goes_on")).where("goes_on").select("token")
        members = apart(labelled(members.drop("label", "now").join(goes_on, "token", "left_semi"), "x", "label"), f"jaccard-members-{level}")
        if members.isEmpty():
            return links
        level += 1


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
                       shingle: int = SHINGLE, count_bits: int = COUNT_BITS) -> DataFrame:
    """One row per row of ``docs``: id, text_hash, n_shingles, component (the smallest id that links reach) and
    keep_hash (the smallest text_hash there; it names the row to keep where a whole component has null ids)."""
    rows = describe(docs, id_col, text_col, percent, count_bits, shingle)
    links = link_points(rows, docs, id_col, text_col, percent, shingle)
    roots = components(links.select(F.col("x").alias("a"), F.col("p").alias("b")), "jaccard-components")
    placed = rows.select("id", "text_hash", "n", "rank").join(roots, rows["rank"] == roots["node"], "left").select("id", "text_hash", "n", F.coalesce("root", "rank").alias("root"))
    placed = write_scratch(placed, "jaccard-placed")
    names = placed.where("n > 0").groupBy("root").agg(F.min("id").alias("component"), F.min("text_hash").alias("keep_hash"))
    out = placed.where("n > 0").join(names, "root").select("id", "text_hash", F.col("n").alias("n_shingles"), "component", "keep_hash")
    return out.union(placed.where("n = 0").select("id", "text_hash", F.col("n").alias("n_shingles"), F.col("id").alias("component"), F.col("text_hash").alias("keep_hash")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", null_ids_stay: bool = True, **options) -> DataFrame:
    """The rows of ``docs`` whose id names their component, with all their columns.

    Null ids always stay, or, without ``null_ids_stay``, only one row of a component that has no
    other ids; texts without words are linked with nothing and stay in either case.
    """
    found = jaccard_components(docs, id_col, text_col, **options)
    if null_ids_stay:
        return without(docs, found.where("id != component"), id_col, text_col)
    gone = found.where("not (id <=> component) or id is null and text_hash != keep_hash")
    return one_null_row(without(docs, gone, id_col, text_col), id_col, text_col, text_or_empty(text_col).rlike("[^\\x20\\x09-\\x0D]"))
