"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

Every benchmark item becomes windows of ``window`` consecutive words (an item of fewer words
is one window).  A window's tokens are its shingles of ``shingle`` words.  Shingles are
ordered by rarity, i.e. by their number of occurrences in the documents.  As a window must
occur whole, one necessary prefix token is enough: its rarest shingle; a window with a
shingle that no document holds is dropped at once.  Documents are joined on that one
shingle; its place in the window gives the only possible start, which must leave room for
the window (positional and length bounds); the words there are then compared one by one.

Defined results: null and empty texts have no words and no hits; null items give no
windows; items with equal text are separate items; documents are told apart by id and text,
so repeated rows are returned each with its own result, also where ids are null; other
columns are ignored; an empty benchmark contaminates nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchwork.llm.common import LOWER, UPPER, text_hash, text_or_empty, without, write_scratch

SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
MAX_BROADCAST_ROWS = 200_000


def words(text: str | Column) -> Column:
    """The words of a text, A-Z lower-cased, in order."""
    return F.array_remove(F.split(F.translate(text_or_empty(text), UPPER, LOWER), SEPARATORS), "")


def item_windows(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """item, win (its words) and size of every window of every item."""
    items = benchmark.select(F.col(item_col).alias("item"), words(text_col).alias("w")).where("size(w) > 0")
    start = F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))).alias("start")
    return items.select("item", "w", start).select("item", F.expr(f"slice(w, start, {window})").alias("win")) \
        .distinct().withColumns({"size": F.size("win"), "win_id": F.sha2(F.concat_ws(" ", "win"), 256)})


def _shingle_hash(array: str, at: Column, k: int) -> Column:
    return F.xxhash64(F.lit(k), *[F.get(F.col(array), at + i) for i in range(k)])


def _positions(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """A row for every shingle of every document: pos and hash, with the document's columns."""
    at = docs.select("*", F.posexplode("w").alias("pos", "_word"))
    hashes = [_shingle_hash("w", F.col("pos"), k) for k in lengths]
    return at.withColumn("hash", hashes[0] if len(hashes) == 1 else F.explode(F.array(*hashes))).drop("_word")


def find_windows(docs: DataFrame, windows: DataFrame, shingle: int = 3, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """id, text_hash, start, size, win_id for every occurrence of a window in ``docs`` (id, text_hash, w).

    The benchmark's side is broadcast only up to ``max_broadcast_rows`` rows; beyond that,
    narrow position rows are shuffled and the words are joined again for the comparison.
    """
    spark = docs.sparkSession
    distinct = windows.select("win_id", "win", "size").distinct()
    tokens = distinct.select("win_id", "win", "size", F.least(F.col("size"), F.lit(shingle)).alias("k")).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("size") - F.col("k"))).alias("offset"))
    by_length = F.coalesce(*[F.when(F.col("k") == k, _shingle_hash("win", F.col("offset"), k)) for k in range(1, shingle + 1)])
    tokens = write_scratch(tokens.withColumn("hash", by_length), "window-tokens")
    n, lengths = tokens.agg(F.count(F.lit(1)), F.sort_array(F.collect_set("k"))).first()  # at most ``shingle`` lengths
    if not n:
        return spark.createDataFrame([], docs.select("id", "text_hash").schema.add("start", "integer").add("size", "integer").add("win_id", "string"))
    small = n <= max_broadcast_rows
    side = F.broadcast if small else (lambda df: df)

    # rarity over all documents
    counts = _positions(docs, lengths).select("hash").join(side(tokens.select("hash").distinct()), "hash") \
        .groupBy("hash").agg(F.count(F.lit(1)).alias("rarity"))
    ranked = tokens.join(counts, "hash", "left").groupBy("win_id").agg(
        F.min(F.struct(F.coalesce("rarity", F.lit(0)).alias("rarity"), "hash", "offset", "size", "win")).alias("t"))
    anchors = write_scratch(ranked.where("t.rarity > 0").select("win_id", "t.hash", "t.offset", "t.size", "t.win"), "window-anchors")

    start, fits = F.col("pos") - F.col("offset"), (F.col("pos") >= F.col("offset")) & (F.col("pos") - F.col("offset") + F.col("size") <= F.col("n_words"))
    same = F.slice(F.col("w"), start + 1, F.col("size")) == F.col("win")
    positions = _positions(docs.withColumn("n_words", F.size("w")), lengths)
    if small:
        found = positions.join(F.broadcast(anchors), "hash").where(fits).where(same)
    else:
        candidates = positions.drop("w").join(anchors, "hash").where(fits).select("id", "text_hash", "pos", "offset", "size", "win", "win_id")
        d = docs.select(F.col("id").alias("d_id"), F.col("text_hash").alias("d_hash"), "w").dropDuplicates(["d_id", "d_hash"])
        found = candidates.join(d, F.col("id").eqNullSafe(F.col("d_id")) & (F.col("text_hash") == F.col("d_hash"))).where(same)
    return found.select("id", "text_hash", start.alias("start"), "size", "win_id")


def split_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text_hash and words (w) of each document, written once."""
    return write_scratch(docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("text_hash"), words(text_col).alias("w")), "document-words")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = 10, shingle: int = 3, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """One row per row of ``docs``: id, text_hash, n_words, n_hit, n_items, items (sorted), contaminated."""
    split = split_documents(docs, id_col, text_col)
    windows = write_scratch(item_windows(benchmark, item_col, item_text_col, window), "item-windows")
    # repeated rows have the same hits: distinct takes them once
    occurrences = write_scratch(find_windows(split, windows, shingle, max_broadcast_rows).distinct(), "window-hits")

    # words under any occurrence: what each one adds beyond the farthest end before it
    ends = occurrences.groupBy("id", "text_hash", "start").agg((F.col("start") + F.max("size")).alias("end"))
    before = "max(end) over (partition by id, text_hash order by start rows between unbounded preceding and 1 preceding)"
    hit = ends.withColumn("before", F.expr(before)).groupBy("id", "text_hash").agg(
        F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce("before", "start")))).cast("long").alias("n_hit"))
    items = occurrences.select("id", "text_hash", "win_id").distinct().join(windows.select("win_id", "item"), "win_id") \
        .groupBy("id", "text_hash").agg(F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items"))
    found = hit.join(items, hit["id"].eqNullSafe(items["id"]) & (hit["text_hash"] == items["text_hash"])).select(
        hit["id"].alias("h_id"), hit["text_hash"].alias("h_hash"), "n_hit", "items")
    rows = split.select("id", "text_hash", F.size("w").cast("long").alias("n_words"))
    out = rows.join(found, rows["id"].eqNullSafe(F.col("h_id")) & (rows["text_hash"] == F.col("h_hash")), "left")
    none = F.array().cast("array<string>")
    return out.select("id", "text_hash", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                      F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
                      F.coalesce("items", none).alias("items"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without a hit, with all their columns."""
    return without(docs, decontaminate(docs, benchmark, id_col, text_col, **options).where("contaminated"), id_col, text_col)
