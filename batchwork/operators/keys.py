"""Ordered-group operators: first-of-key, ranks, duplicates, carries, numbering.

Rule R8: "first" depends on order, and Spark has no file order, so every operator here
takes an explicit order and appends a tie-break over all remaining columns to make it
total.  Filters on ``row_number``/``rank`` of the form ``= 1`` / ``<= k`` let Spark
insert a partial ``WindowGroupLimit`` before the shuffle, so a hot key is cut down to
k rows per map task before it reaches a single reducer.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _cols(x):
    if x is None:
        return []
    return [x] if isinstance(x, (str, Column)) else list(x)


def _name(c) -> str | None:
    return c if isinstance(c, str) else None


def total_order(df: DataFrame, keys, order) -> list[Column]:
    """``order`` followed by every other column ascending (nulls first) as tie-break."""
    given = _cols(order)
    order = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in given]
    used = {k for k in _cols(keys) if isinstance(k, str)} | {_name(c) for c in given}
    # columns already ordered by an expression may repeat here; that is harmless
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in used]
    return order + rest


def join_on(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Join on equal key columns, where a missing key matches a missing key.

    Columns come out as in a ``USING`` join: keys (coalesced), left rest, right rest.
    The null-safe equality is still an equi-join, so it is planned as a hash or
    sort-merge join and skewed partitions can be split.
    """
    keys = _cols(keys)

    def of(side: str, c: str) -> Column:
        return F.col(f"{side}.`{c}`")
    cond = reduce(lambda a, b: a & b, [of("__l", k).eqNullSafe(of("__r", k)) for k in keys])
    j = left.alias("__l").join(right.alias("__r"), cond, how)
    if how in ("left_semi", "left_anti"):
        return j.select(*[of("__l", c).alias(c) for c in left.columns])
    own = {"right": lambda k: of("__r", k), "full": lambda k: F.coalesce(of("__l", k), of("__r", k))}.get(how, lambda k: of("__l", k))
    return j.select(*[own(k).alias(k) for k in keys], *[of("__l", c).alias(c) for c in left.columns if c not in keys],
                    *[of("__r", c).alias(c) for c in right.columns if c not in keys])


def _win(keys, order_cols):
    w = Window.partitionBy(*_cols(keys)) if _cols(keys) else Window.partitionBy()
    return w.orderBy(*order_cols)


def row_number_in(df: DataFrame, keys, order, name: str = "seq", total: bool = True,
                  skew_safe: bool = False) -> DataFrame:
    """Running counter within each key group (1, 2, ...)."""
    oc = total_order(df, keys, order) if total else _cols(order)
    if skew_safe:
        return row_number_skew_safe(df, keys, oc, name)
    return df.withColumn(name, F.row_number().over(_win(keys, oc)))


_IDX_BITS = 33          # monotonically_increasing_id: partition id << 33 | row index


def _positions(df: DataFrame, keys, order_cols: list[Column], name: str, last: str | None = None, partitions: int | None = None) -> DataFrame:
    """Number the rows of each key, one range exchange and no key in one task.

    Range-partition on (keys, order), sort within partitions, and count along each
    partition from where its key begins (adjacent rows are compared by a hash of the key).
    Only a partition's *first* key can have begun in an earlier one, so one row per
    partition - first key, last key, rows of the last key - says all that is missing;
    that table is broadcast.  ``last`` names a flag: no later row has the row's key.

    Both branches read the exchange below the counting pass; its columns can't be pruned
    differently above, so it is one and the same exchange (checked in the plan tests).
    """
    keys = _cols(keys)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sort = [F.col(k).asc_nulls_first() for k in keys] + total_order(df, keys, list(order_cols))
    marked = [x for k in keys for x in (F.col(k).isNull(), F.col(k))] or [F.lit(0)]
    d = df.withColumn("__key", F.xxhash64(*marked)).repartitionByRange(n, *sort).sortWithinPartitions(*sort) \
          .withColumn("__mid", F.monotonically_increasing_id())

    def count_along(batches):
        import numpy as np
        import pyarrow as pa
        key, at, first, held = None, 0, None, None

        def done(batch, n, is_first, is_last):
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(n), pa.array(is_first), pa.array(is_last)], names=[*batch.schema.names, "__n", "__f", "__l"])
        for batch in batches:
            if not batch.num_rows:
                continue
            k = batch.column("__key").to_numpy()
            if held is not None:
                held[3][-1] = k[0] != key
                yield done(*held)
            first = k[0] if first is None else first
            begins = np.append(key is None or k[0] != key, k[1:] != k[:-1])
            start = np.maximum.accumulate(np.where(begins, np.arange(len(k)), -at))
            n = np.arange(len(k)) - start + 1
            held = [batch, n.astype(np.int64), k == first, np.append(k[1:] != k[:-1], True)]
            key, at = k[-1], int(n[-1])
        if held is not None:
            yield done(*held)
    schema = T.StructType([*d.schema.fields, T.StructField("__n", T.LongType()), T.StructField("__f", T.BooleanType()), T.StructField("__l", T.BooleanType())])
    d = d.mapInArrow(count_along, schema).withColumn("__pid", F.shiftright("__mid", _IDX_BITS))
    borders = d.groupBy("__pid").agg(F.min_by("__key", "__mid").alias("__first"), F.max_by("__key", "__mid").alias("__last"), F.max_by("__n", "__mid").alias("__tail"))
    # from here on one row per partition
    along = Window.orderBy("__pid")
    run = borders.withColumn("__run", F.sum("__tail").over(Window.partitionBy("__last").orderBy("__pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    offsets = run.select("__pid", F.when(F.lag("__last").over(along) == F.col("__first"), F.lag("__run").over(along)).otherwise(F.lit(0)).alias("__off"),
                         (F.lead("__first").over(along) == F.col("__last")).alias("__goes_on"), F.col("__last").alias("__border"))
    out = d.join(F.broadcast(offsets), "__pid").withColumn(name, (F.col("__n") + F.when(F.col("__f"), F.col("__off")).otherwise(F.lit(0))).cast("int"))
    if last:
        goes_on = F.coalesce(F.col("__goes_on"), F.lit(False)) & (F.col("__key") == F.col("__border"))
        out = out.withColumn(last, F.col("__l") & ~goes_on)
    return out.select(*df.columns, name, *([last] if last else []))


def row_number_skew_safe(df: DataFrame, keys, order_cols: list[Column], name: str,
                         partitions: int | None = None) -> DataFrame:
    """Per-key row numbers that do not put a hot key into one task (see ``_positions``):
    a key holding a third of the rows spreads over a third of the partitions."""
    return _positions(df, keys, list(order_cols), name, partitions=partitions)


def first_by(df: DataFrame, keys, order, k: int = 1) -> DataFrame:
    """The first ``k`` rows of each key under a total order (sort + NODUPKEY)."""
    oc = total_order(df, keys, order)
    rn = "__rn"
    return (df.withColumn(rn, F.row_number().over(_win(keys, oc)))
              .where(F.col(rn) <= k).drop(rn))


def rank_in(df: DataFrame, keys, order, name: str = "rank", dense: bool = False, descending: bool = False) -> DataFrame:
    """Rank with ties sharing the lowest rank (dense or with gaps), by column names.

    Rows are counted per (key, order values) first; the window then runs over one row
    per distinct value and the ranks are joined back, so a key that holds a third of
    the rows is not ranked row by row in one task.  Missing values rank lowest.
    """
    keys, order = _cols(keys), _cols(order)
    w = _win(keys, [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first() for c in order])
    counts = df.groupBy(*keys, *order).agg(F.count(F.lit(1)).alias("__n"))
    if dense:
        ranked = counts.withColumn(name, F.dense_rank().over(w))
    else:
        before = F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, -1))
        ranked = counts.withColumn(name, (F.coalesce(before, F.lit(0)) + 1).cast("int"))
    return join_on(df, ranked.drop("__n"), [*keys, *order]).select(*df.columns, name)


def best_with_ties(df: DataFrame, keys, order) -> DataFrame:
    """Every row tied for rank 1."""
    # rank = 1 is cut down before the shuffle (WindowGroupLimit)
    return df.withColumn("__rk", F.rank().over(_win(keys, _cols(order)))).where("__rk = 1").drop("__rk")


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys occurring more than once, as (keys, n).  Partial aggregation, skew-safe."""
    return df.groupBy(*_cols(keys)).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def rows_with_duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """W8 (DUPOUT by count): all rows whose key occurs more than once."""
    return join_on(df, duplicate_keys(df, keys).drop("n"), keys, "left_semi")


def surplus_rows(df: DataFrame, keys, order) -> DataFrame:
    """W8 (DUPOUT of NODUPKEY): every row but the first of its key."""
    return row_number_skew_safe(df, keys, total_order(df, keys, order), "__rn").where("__rn > 1").drop("__rn")


def first_last_flags(df: DataFrame, keys, order) -> DataFrame:
    """FIRST./LAST. flags of each row within its key group.

    From the row's position, whatever the order is given by: exactly one first and one
    last row per key, of equal rows too, and a hot key spreads over many tasks.
    """
    out = _positions(df, keys, total_order(df, keys, order), "__rn", last="is_last")
    return out.select(*df.columns, (F.col("__rn") == 1).alias("is_first"), "is_last")


def carry_last(df: DataFrame, keys, order, value: str, out: str, bucket: Column | None = None) -> DataFrame:
    """W10 / J13 per-row: carry the last non-missing ``value`` down each key group.

    Two-level scan so that one hot key does not land in one task: within
    (keys, bucket) a running ``last(ignorenulls)``; across buckets a carry computed on
    the per-bucket aggregates (one row per key and bucket) and joined back.  With no
    ``bucket`` this is the plain running window.
    """
    keys = _cols(keys)
    oc = _cols(order)
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*oc).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(out, F.last(value, ignorenulls=True).over(w))
    b = "__bucket"
    d = df.withColumn(b, bucket)
    w_in = Window.partitionBy(*keys, b).orderBy(*oc).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("__in", F.last(value, ignorenulls=True).over(w_in))
    ord_struct = F.struct(*[c if isinstance(c, Column) else F.col(c) for c in oc])
    # one row per (key, bucket): the bucket's last non-missing value (partial agg)
    per_bucket = d.groupBy(*keys, b).agg(
        F.max_by(F.col(value), F.when(F.col(value).isNotNull(), ord_struct)).alias("__bl"))
    w_b = Window.partitionBy(*keys).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.select(*keys, b, F.last("__bl", ignorenulls=True).over(w_b).alias("__carry"))
    return (join_on(d, carry, [*keys, b], "left")
             .withColumn(out, F.coalesce("__in", "__carry"))
             .drop(b, "__in", "__carry"))


def numbered_lines(df: DataFrame, order, amount: str | None = None, partitions: int | None = None) -> DataFrame:
    """Global line numbers (and a running amount) without a single-partition window.

    Range-partition on the (total) order, number rows within each range partition,
    then add the offsets of the preceding partitions (a table with one row per
    partition, broadcast).
    """
    oc = total_order(df, [], order)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = df.repartitionByRange(n, *oc).sortWithinPartitions(*oc).withColumn("__mid", F.monotonically_increasing_id())
    d = d.withColumn("__pid", F.shiftright("__mid", _IDX_BITS)) \
         .withColumn("__ln", F.col("__mid").bitwiseAND(F.lit((1 << _IDX_BITS) - 1)) + 1)
    aggs = [F.count(F.lit(1)).alias("__cnt")] + ([F.sum(amount).alias("__amt")] if amount else [])
    # both branches read one and the same range exchange
    parts = d.groupBy("__pid").agg(*aggs)
    pw = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = parts.select("__pid", F.coalesce(F.sum("__cnt").over(pw), F.lit(0)).alias("__off"),
                        *([F.coalesce(F.sum("__amt").over(pw), F.lit(0)).alias("__aoff")] if amount else []))
    # one row per partition: a proven, tiny bound → broadcast
    out = d.join(F.broadcast(offs), "__pid").withColumn("line_no", F.col("__off") + F.col("__ln"))
    if amount:
        run = Window.partitionBy("__pid").orderBy("__ln").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = out.withColumn("running_amount", F.col("__aoff") + F.sum(amount).over(run))
    return out.drop("__pid", "__mid", "__ln", "__off", "__aoff")


def pick_by_priority(df: DataFrame, keys, rules: list[tuple[Column, int]], order=None,
                     default: int = 99) -> DataFrame:
    """Compute a priority from ordered rules (first match wins), keep the best row."""
    pr = F.lit(default)
    for cond, p in reversed(rules):
        pr = F.when(cond, F.lit(p)).otherwise(pr)
    d = df.withColumn("priority", pr)
    return first_by(d, keys, [F.col("priority").asc(), *_cols(order)])


def first_row_amount(df: DataFrame, keys, order, value: str, out: str) -> DataFrame:
    """Keep an amount on the first row of each group only, 0 on the others."""
    d = first_last_flags(df, keys, order).drop("is_last")
    return d.withColumn(out, F.when(F.col("is_first"), F.col(value)).otherwise(F.lit(0))).drop("is_first")
