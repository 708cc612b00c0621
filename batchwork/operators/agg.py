"""Aggregation: group sums with SAS null-group rules, class levels, crosstabs, reports.

All of these are hash aggregates with a partial (map-side) phase, so a hot group is
combined before the shuffle.  Money is summed as decimal (order-independent).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import _cols


def group_sum(df: DataFrame, keys, measures, keep_null_groups: bool = True, count: str | None = None) -> DataFrame:
    """A1/A2: PROC SUMMARY NWAY.  With ``MISSING`` null keys form groups (A1); without it
    rows having any null class key are dropped first (A2, rule R5)."""
    keys = _cols(keys)
    d = df if keep_null_groups else df.dropna(subset=keys)
    aggs = [F.sum(m).alias(m) if isinstance(m, str) else m for m in _cols(measures)]
    if count:
        aggs.append(F.count(F.lit(1)).alias(count))
    return d.groupBy(*keys).agg(*aggs)


def class_levels(df: DataFrame, keys, aggs: list[Column], type_col: str = "_type_") -> DataFrame:
    """A3: all combinations of the class keys with the SAS ``_TYPE_`` level code.

    ``_TYPE_`` has bit i set when key i (counting from the right) is a grouping key,
    i.e. ``2^n - 1 - grouping_id()``.  Rows with a null class key are dropped first (R5).
    """
    keys = _cols(keys)
    n = len(keys)
    return (df.dropna(subset=keys).cube(*keys)
              .agg(*aggs, F.grouping_id().alias("__gid"))
              .withColumn(type_col, (F.lit(2 ** n - 1) - F.col("__gid")).cast("int")).drop("__gid"))


def grouping_sets(df: DataFrame, keys, aggs: list[Column], types: list[int], type_col: str = "_type_") -> DataFrame:
    """Only the listed ``_TYPE_`` levels of ``class_levels``."""
    return class_levels(df, keys, aggs, type_col).where(F.col(type_col).isin(types))


def crosstab_totals(df: DataFrame, row: str, col: str, value: str, col_values: list[str],
                    total_label: str = "TOTAL") -> DataFrame:
    """Row × column sums with row, column and grand totals (PROC TABULATE).

    ``cube`` yields every margin in one aggregation; totals are labelled and the column
    key pivoted over its known values (given → no extra job to discover them).
    """
    c = (df.cube(row, col).agg(F.sum(value).alias("__v"), F.grouping(row).alias("__gr"),
                               F.grouping(col).alias("__gc")))
    c = (c.withColumn(row, F.when(F.col("__gr") == 1, F.lit(total_label)).otherwise(F.col(row).cast("string")))
          .withColumn(col, F.when(F.col("__gc") == 1, F.lit(total_label)).otherwise(F.col(col).cast("string"))))
    return c.groupBy(row).pivot(col, list(col_values) + [total_label]).agg(F.first("__v"))


def break_report(df: DataFrame, groups, measures: list[str], detail_cols: list[str]) -> DataFrame:
    """Detail rows + subtotal per break level + grand total, ordered for printing.

    ``level`` = 0 detail, 1..n subtotals (deepest break first), n+1 grand total.
    """
    groups = _cols(groups)
    n = len(groups)
    det = df.select(*groups, *detail_cols, *measures).withColumn("level", F.lit(0))
    aggs = [F.sum(m).alias(m) for m in measures] + [F.grouping_id().alias("__gid")]
    roll = df.rollup(*groups).agg(*aggs)
    # grouping_id bit count = number of rolled-up keys
    roll = roll.withColumn("level", (F.bit_count(F.col("__gid")) + 1).cast("int")).drop("__gid")
    out = det.unionByName(roll, allowMissingColumns=True)
    return out.withColumn("row_kind", F.when(F.col("level") == 0, F.lit("detail"))
                          .when(F.col("level") == n + 1, F.lit("total")).otherwise(F.lit("subtotal")))


def mean_distinct_positive(df: DataFrame, keys, cols: list[str], suffix: str = "_avg") -> DataFrame:
    """Mean of the distinct positive values of each column, 0 when none — all
    columns in one aggregation (the reference loops one pass per column)."""
    aggs = []
    for c in cols:
        pos = F.when(F.col(c) > 0, F.col(c))
        aggs.append(F.coalesce(F.sum_distinct(pos) / F.count_distinct(pos), F.lit(0)).alias(c + suffix))
    return df.groupBy(*_cols(keys)).agg(*aggs)


def ordered_concat(df: DataFrame, keys, value: str, order: str, sep: str = "|", out: str = "joined",
                   partitions: int | None = None) -> DataFrame:
    """Values of a group joined in order (ties broken by the value).

    Two levels so a large group is not sorted in one task: rows are range-partitioned
    on (keys, order, value); each (key, range partition) joins its own slice, then the
    slices of a key — one per partition it spans — are joined in partition order.
    """
    keys = _cols(keys)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sort = [*[F.col(k).asc_nulls_first() for k in keys], F.col(order).asc_nulls_first(), F.col(value).asc_nulls_first()]
    d = df.select(*keys, F.col(order).alias("o"), F.col(value).alias("v")).repartitionByRange(n, *sort) \
          .withColumn("__p", F.spark_partition_id())
    # a slice holding only missing values contributes nothing (not an empty element)
    part = d.groupBy(*keys, "__p").agg(F.when(F.count("v") > 0, F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("o", "v"))), lambda s: s["v"]), sep)).alias("__s"))
    return part.groupBy(*keys).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("__p", "__s"))), lambda s: s["__s"]), sep).alias(out))


def rollup_child_to_parent(df: DataFrame, child: str, parent_of: Column, measures: list[str]) -> DataFrame:
    """Sum child rows onto their parent key, then add to the parent's own row."""
    from ..functions.clean import row_sum
    up = (df.withColumn("__parent", parent_of).where(F.col("__parent").isNotNull())
            .groupBy("__parent").agg(*[F.sum(m).alias("__c_" + m) for m in measures])
            .withColumnRenamed("__parent", child))
    j = df.join(up, on=child, how="full")
    return j.select(child, *[row_sum(m, "__c_" + m).alias(m) for m in measures])


def accumulate(current: DataFrame, prior: DataFrame, keys, measures: list[str],
               remap: Column | None = None, remap_key: str | None = None) -> DataFrame:
    """This period's sums + the prior accumulation, keys remapped, re-summed."""
    u = current.unionByName(prior, allowMissingColumns=True)
    if remap is not None:
        u = u.withColumn(remap_key, remap)
    return u.groupBy(*_cols(keys)).agg(*[F.sum(m).alias(m) for m in measures])


def unpivot_positive(df: DataFrame, ids, cols: list[str], name: str = "kind", value: str = "amount") -> DataFrame:
    """Several amount columns → one row per positive amount."""
    return df.unpivot(_cols(ids), cols, name, value).where(F.col(value) > 0)
