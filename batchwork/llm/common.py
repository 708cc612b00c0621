"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# else shuffle files stay until the driver happens to collect its garbage
DROP_SHUFFLED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def write_scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it again (cuts lineage).

    What the write itself has shuffled is dropped when it ends: nothing reads it again.
    """
    from batchwork.session import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(DROP_SHUFFLED, None)
    spark.conf.set(DROP_SHUFFLED, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(DROP_SHUFFLED) if before is None else spark.conf.set(DROP_SHUFFLED, before)
    return spark.read.schema(df.schema).parquet(path)


def bounded_sample(rows: DataFrame, order: str, most: int) -> DataFrame:
    """A sample already drawn to about ``most`` rows, held to twice that and broadcast."""
    return F.broadcast(rows.orderBy(order).limit(2 * most))


def at_most(rows: DataFrame, key: str, most: int) -> DataFrame:
    """``rows``, one per ``key``; of more than ``most`` about half of ``most``, chosen by hash."""
    n = rows.count()
    share = F.pmod(F.xxhash64(key, F.lit(4)), F.lit(10 ** 15)) / 1e15
    return rows if n <= most else rows.where(share < most / 2 / n)


def held_out(id_col: str) -> Column:
    """The held-out fold: crc32 of the id as text, mod 5, is 0 (null ids are never held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def write_pairs(df: DataFrame, name: str) -> DataFrame:
    """``write_scratch`` for narrow tables (pairs and labels of points): an eighth of the partitions hold them."""
    return write_scratch(df.coalesce(max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8)), name)


def text_hash(c: str | Column) -> Column:
    """Tells rows with the same id apart; rows with the same id and text are one to every operator."""
    text = text_or_empty(c)
    return F.xxhash64(text, F.length(text))


def without(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` that are not in ``gone`` (id, text_hash; null ids match null ids), with all their columns."""
    gone = gone.select(F.col("id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    return docs.join(gone, docs[id_col].eqNullSafe(gone["__id"]) & (text_hash(docs[text_col]) == gone["__hash"]), "left_anti")


def one_null_row(docs: DataFrame, id_col: str, text_col: str, among: Column) -> DataFrame:
    """``docs``, but of the rows with null id and equal text, for which ``among`` holds, one.

    The one of least hash over all columns stays; copies are combined before the shuffle.
    """
    folds = F.col(id_col).isNull() & among
    row, columns = F.struct(*[F.col(f"`{c}`") for c in docs.columns]), [F.col(f"`{c}`") for c in docs.columns]
    one = docs.where(folds).groupBy(text_hash(text_col).alias("__hash")).agg(F.min_by(row, F.xxhash64(*columns)).alias("__row"))
    return docs.where(~folds).unionByName(one.select("__row.*"))
