"""Exact deduplication with a stateful stream.

The stream keeps one state row per content digest, for ever (no watermark, no expiry), in
RocksDB, i.e. on the executors' disks with checkpoints in the shared folder: the digest,
the smallest identifier seen so far, the locator of that row's content and the number of
rows.  A hit is not trusted on its digest alone: the texts of the hit and of the keeper are
fetched by locator and compared in full; digests under which different texts meet are
grouped again by the whole text.

Defined results: a null text counts as empty; null ids rank after all others, so a null id
stays only where its whole group has none, and such rows, which no locator finds again, rely
on the digest; repeated ids are separate rows (each is
returned; all rows that carry the keeper's id stay together as ``kept``); an empty table
gives an empty result; columns other than the id and the text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from batchwork.llm.common import one_null_row, text_hash, text_or_empty, without, write_scratch
from batchwork.session import scratch_path

SPACE_RUN = "[\\x20\\x09-\\x0D]+"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# state on disk; no file space reserved ahead, which would cost megabytes for each small store
STATE_CONF = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB,
              "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}


def normalise(text: str | Column) -> Column:
    """Every run of ASCII white space becomes one space; null is empty."""
    return F.regexp_replace(text_or_empty(text), SPACE_RUN, " ")


def sha256_digest(norm: Column) -> Column:
    return F.sha2(norm.cast("binary"), 256)


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256_digest) -> DataFrame:
    """One narrow row per document: digest, identifier, and the content's locator.

    The locator (identifier, hash of the raw text, length) fetches the text from the table
    by an equi-join, on any file system that Spark reads.
    """
    norm = normalise(text_col)
    return docs.select(digest(norm).alias("digest"), F.col(id_col).alias("id"),
                       F.struct(F.col(id_col).alias("id"), text_hash(text_col).alias("text_hash"), F.octet_length(norm).alias("bytes")).alias("locator"))


def stream_state(rows: DataFrame, name: str, max_wait_sec: int | None = None) -> DataFrame:
    """Run the stream of ``digest_rows`` over all available input; return its final state.

    ``rows`` is a streaming DataFrame.  Each micro-batch folds its rows into the keyed state
    (partial aggregation first, so a digest that holds a third of the rows sends one row per
    task) and appends the changed keys; the newest change of a key is its state.
    """
    spark = rows.sparkSession
    out, checkpoint = scratch_path(spark, f"{name}-changes"), scratch_path(spark, f"{name}-stream")
    keeper = F.min(F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("locator"))).alias("keeper")
    state = rows.groupBy("digest").agg(keeper, F.count(F.lit(1)).alias("n"))

    def append(batch: DataFrame, batch_id: int) -> None:
        # a batch that is run again after a failure replaces its own folder
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        query = (state.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).foreachBatch(append).start())
        query.awaitTermination(max_wait_sec)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    schema = state.schema.add("batch", "long")
    changes = spark.read.schema(schema).option("basePath", out).parquet(f"{out}/batch=*") \
        if query.lastProgress or _has_batches(spark, out) else spark.createDataFrame([], schema)
    last = F.max_by(F.struct("keeper", "n"), "batch").alias("s")
    return changes.groupBy("digest").agg(last).select("digest", "s.keeper.id", "s.keeper.locator", "s.n")


def _has_batches(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256_digest,
                name: str = "exact-dedup") -> DataFrame:
    """Return one row per row of ``docs``: id, keep_id, keep_hash, group_size, kept, digest, text_hash.

    ``keep_hash`` is the keeper's text_hash; it names the keeper where a whole group has null ids.

    The digests are written once as a narrow table, which the stream then reads; the texts
    themselves are moved only for hits (rows that are not their group's keeper).
    """
    spark = docs.sparkSession
    rows = write_scratch(digest_rows(docs, id_col, text_col, digest), f"{name}-digests")
    source = rows.inputFiles()
    if not source:
        stream_groups = rows.groupBy("digest").agg(F.first("id").alias("id"), F.first("locator").alias("locator"),
                                                   F.count(F.lit(1)).alias("n"))
    else:
        folder = source[0].rsplit("/", 1)[0]
        stream_groups = stream_state(spark.readStream.schema(rows.schema).parquet(folder), name)
    groups = write_scratch(stream_groups, f"{name}-groups")
    joined = rows.select("digest", "id", "locator.text_hash").join(groups.select(
        "digest", F.col("id").alias("keep_id"), F.col("locator.text_hash").alias("keep_hash"), F.col("n").alias("group_size")), "digest")

    # Full check of hits: the hit's text and its keeper's text, fetched by locator.  Both
    # fetches deal the texts out by locator, so Spark shuffles them once and reads that twice.
    texts = docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("text_hash"), text_or_empty(text_col).alias("t"))
    hits = joined.where((F.col("group_size") > 1) & (F.col("id") != F.col("keep_id")))
    hit_text = texts.join(hits, ["id", "text_hash"]).select("digest", "keep_id", "keep_hash", "t")
    keepers = hits.select(F.col("keep_id").alias("id"), F.col("keep_hash").alias("text_hash")).distinct()
    keeper_text = texts.join(keepers, ["id", "text_hash"]).select(F.col("id").alias("keep_id"), F.col("text_hash").alias("keep_hash"), F.col("t").alias("kt"))
    differ = (F.col("t") != F.col("kt")) & (normalise("t") != normalise("kt"))
    collided = hit_text.join(keeper_text, ["keep_id", "keep_hash"]).where(differ).select("digest").distinct()
    collided = write_scratch(collided, f"{name}-collided")

    columns = ["id", "keep_id", "keep_hash", "group_size", "digest", "text_hash"]
    result = joined.select(columns)
    if not collided.isEmpty():
        again = docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("text_hash"), normalise(text_col).alias("norm"),
                            digest(normalise(text_col)).alias("digest")).join(collided, "digest", "left_semi")
        keys = again.groupBy("norm").agg(F.min(F.struct(F.col("id").isNull().alias("x"), F.col("id"), F.col("text_hash"))).alias("k"),
                                         F.count(F.lit(1)).alias("group_size"))
        regrouped = again.join(keys, "norm").select("id", F.col("k.id").alias("keep_id"), F.col("k.text_hash").alias("keep_hash"), "group_size", "digest", "text_hash")
        result = result.join(collided, "digest", "left_anti").select(columns).unionByName(regrouped)
    return result.select("id", "keep_id", "keep_hash", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest", "text_hash")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "keep-first", null_ids_stay: bool = True) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Null ids always stay, or, without ``null_ids_stay``, only one row of a group that has no other ids.
    """
    found = exact_dedup(docs, id_col, text_col, name=name)
    if null_ids_stay:
        return without(docs, found.where("not kept and id is not null"), id_col, text_col)
    gone = found.where("not kept or id is null and text_hash != keep_hash")
    return one_null_row(without(docs, gone, id_col, text_col), id_col, text_col, F.lit(True))
