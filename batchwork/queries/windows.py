"""§2.6 ordered-group and §2.7 sort queries (W1-W16, O1-O4) on the supplied tables.

Tie-breaks: ``keys.total_order`` appends every remaining column ascending (nulls first)
in the table's column order; the SQL oracles spell the same order out.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import keys as K
from . import load, register

LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
           "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _rest(*skip):
    return ", ".join(c for c in LI_COLS if c not in skip)


@register("rank_ties_low", """
SELECT l_orderkey, l_linenumber, l_quantity,
       CAST(RANK() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC) AS INTEGER) AS qty_rank
FROM lineitem
""")
def rank_ties_low(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return K.rank_in(li, "l_orderkey", "l_quantity", "qty_rank", descending=True)


@register("dense_rank_group", """
SELECT l_orderkey, l_linenumber, l_discount,
       CAST(DENSE_RANK() OVER (PARTITION BY l_orderkey ORDER BY l_discount) AS INTEGER) AS disc_rank
FROM lineitem
""")
def dense_rank_group(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    return K.rank_in(li, "l_orderkey", "l_discount", "disc_rank", dense=True)


@register("best_with_ties", """
SELECT l_orderkey, l_linenumber, l_quantity FROM (
  SELECT l_orderkey, l_linenumber, l_quantity,
         RANK() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC) AS r FROM lineitem) WHERE r = 1
""")
def best_with_ties(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return K.best_with_ties(li, "l_orderkey", [F.col("l_quantity").desc()])


@register("first_by_key", f"""
SELECT {', '.join(LI_COLS)} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey
         ORDER BY l_shipdate DESC NULLS LAST, {_rest('l_orderkey')}) AS rn FROM lineitem) WHERE rn = 1
""")
def first_by_key(spark, sf):
    li = load(spark, sf, "lineitem")
    return K.first_by(li, "l_orderkey", [F.col("l_shipdate").desc_nulls_last()])


@register("newest_and_oldest", """
SELECT o_custkey,
       MAX_BY(o_orderkey, (o_orderdate, o_orderkey)) AS newest_order,
       MAX_BY(o_totalprice, (o_orderdate, o_orderkey)) AS newest_amount,
       CAST(MIN(o_orderdate) AS DATE) AS oldest_date,
       MIN_BY(o_orderkey, (o_orderdate, o_orderkey)) AS oldest_order
FROM orders GROUP BY o_custkey
""")
def newest_and_oldest(spark, sf):
    o = load(spark, sf, "orders")
    k = F.struct("o_orderdate", "o_orderkey")
    return o.groupBy("o_custkey").agg(
        F.max_by("o_orderkey", k).alias("newest_order"), F.max_by("o_totalprice", k).alias("newest_amount"),
        F.min(F.col("o_orderdate")).cast("date").alias("oldest_date"), F.min_by("o_orderkey", k).alias("oldest_order"))


@register("first_last_flags", """
SELECT o_custkey, o_orderkey,
       ROW_NUMBER() OVER w = 1 AS is_first,
       ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1 AS is_last
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
""")
def first_last_flags(spark, sf):
    o = load(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return K.first_last_flags(o, "o_custkey", ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@register("sequence_in_group", """
SELECT o_custkey, o_orderkey,
       CAST(ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS seq
FROM orders
""")
def sequence_in_group(spark, sf):
    o = load(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return K.row_number_in(o, "o_custkey", ["o_orderdate", "o_orderkey"], "seq", skew_safe=True).drop("o_orderdate")


@register("duplicate_rows", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem l
WHERE (l_orderkey, l_linenumber) IN (SELECT l_orderkey, l_linenumber FROM lineitem
                                     GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)
""")
def duplicate_rows(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return K.rows_with_duplicate_keys(li, ["l_orderkey", "l_linenumber"])


@register("duplicate_rule", """
WITH d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount,
                  COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount FROM d
WHERE n = 1 OR (l_quantity <> 0 AND l_discount <> 0)
""")
def duplicate_rule(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount")
    dup = K.duplicate_keys(li, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber",
                                                                        F.lit(True).alias("__dup"))
    j = K.join_on(li, dup, ["l_orderkey", "l_linenumber"], "left")
    keep = F.col("__dup").isNull() | ((F.col("l_quantity") != 0) & (F.col("l_discount") != 0))
    return j.where(keep).drop("__dup")


_PRIO = "CASE WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN NULL ELSE o_orderpriority END"


@register("carry_last_value", f"""
SELECT o_custkey, o_orderkey, {_PRIO} AS prio,
       LAST_VALUE({_PRIO} IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS prio_carried
FROM orders
""")
def carry_last_value(spark, sf):
    o = load(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate",
        F.when(F.col("o_orderpriority").isin("3-MEDIUM", "4-NOT SPECIFIED"), None)
         .otherwise(F.col("o_orderpriority")).alias("prio"))
    # bucket = order year: the running carry is split per (customer, year) and bridged
    out = K.carry_last(o, "o_custkey", ["o_orderdate", "o_orderkey"], "prio", "prio_carried",
                       bucket=F.year("o_orderdate"))
    return out.drop("o_orderdate")


@register("dedupe_rows", """
SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem
""")
def dedupe_rows(spark, sf):
    return load(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus").dropDuplicates()


@register("unique_subset", f"""
SELECT {', '.join(LI_COLS)} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_returnflag
         ORDER BY {_rest('l_orderkey', 'l_returnflag')}) AS rn FROM lineitem) WHERE rn = 1
""")
def unique_subset(spark, sf):
    return K.first_by(load(spark, sf, "lineitem"), ["l_orderkey", "l_returnflag"], [])


@register("pick_by_priority", f"""
SELECT {', '.join(LI_COLS)}, priority FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY priority, l_extendedprice DESC,
                               {_rest('l_orderkey')}) AS rn
  FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 WHEN l_returnflag = 'A' THEN 2
                       WHEN l_linestatus = 'O' THEN 3 ELSE 99 END AS priority FROM lineitem)) WHERE rn = 1
""")
def pick_by_priority(spark, sf):
    li = load(spark, sf, "lineitem")
    rules = [(F.col("l_returnflag") == "R", 1), (F.col("l_returnflag") == "A", 2), (F.col("l_linestatus") == "O", 3)]
    return K.pick_by_priority(li, "l_orderkey", rules, [F.col("l_extendedprice").desc()])


@register("first_row_amount", f"""
SELECT o.o_orderkey, l.l_linenumber, l.l_partkey,
       CASE WHEN ROW_NUMBER() OVER (PARTITION BY o.o_orderkey ORDER BY l.l_linenumber, l.l_partkey,
            l.l_suppkey, l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax, l.l_returnflag,
            l.l_linestatus, l.l_shipdate) = 1 THEN o.o_totalprice ELSE 0 END AS limit_amount
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
""")
def first_row_amount(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    li = load(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    j = li.join(o, "o_orderkey")
    cols = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus", "l_shipdate"]
    out = K.first_row_amount(j.select("o_orderkey", *cols, "o_totalprice"), "o_orderkey", cols,
                             "o_totalprice", "limit_amount")
    return out.select("o_orderkey", "l_linenumber", "l_partkey",
                      F.col("limit_amount").cast("double").alias("limit_amount"))


@register("numbered_lines", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice,
       ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) AS line_no,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER (ORDER BY o_orderdate, o_orderkey
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_amount
FROM orders
""")
def numbered_lines(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice",
                                         F.col("o_totalprice").cast("decimal(18,2)").alias("amt"))
    out = K.numbered_lines(o, ["o_orderdate", "o_orderkey"], amount="amt")
    return out.select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"), "o_totalprice",
                      F.col("line_no").cast("bigint").alias("line_no"),
                      F.col("running_amount").cast("double").alias("running_amount"))


@register("worst_representative", f"""
SELECT l_orderkey, l_linenumber, l_partkey, days_late FROM (
  SELECT l.*, CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS INTEGER) AS days_late,
         ROW_NUMBER() OVER (PARTITION BY l.l_orderkey ORDER BY
             date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) DESC,
             {', '.join('l.' + c for c in LI_COLS if c != 'l_orderkey')}) AS rn
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey) WHERE rn = 1
""")
def worst_representative(spark, sf):
    li = load(spark, sf, "lineitem")
    o = load(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    j = li.join(o, "l_orderkey").withColumn(
        "days_late", F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date")))
    j = j.select(*LI_COLS, "days_late")
    best = K.first_by(j, "l_orderkey", [F.col("days_late").desc()])
    return best.select("l_orderkey", "l_linenumber", "l_partkey", "days_late")


@register("sorted_output", """
SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders
ORDER BY o_orderpriority ASC NULLS FIRST, o_totalprice DESC NULLS LAST, o_orderkey
""")
def sorted_output(spark, sf):
    o = load(spark, sf, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return o.orderBy(F.col("o_orderpriority").asc_nulls_first(), F.col("o_totalprice").desc_nulls_last(),
                     F.col("o_orderkey"))


@register("first_record", """
SELECT MIN_BY(o_orderkey, (o_orderdate, o_orderkey)) AS first_order,
       CAST(MIN(o_orderdate) AS DATE) AS first_date FROM orders
""")
def first_record(spark, sf):
    o = load(spark, sf, "orders")
    return o.agg(F.min_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("first_order"),
                 F.min("o_orderdate").cast("date").alias("first_date"))


@register("order_by_count", """
SELECT o_custkey, COUNT(*) AS cnt FROM orders GROUP BY o_custkey ORDER BY cnt DESC, o_custkey
""")
def order_by_count(spark, sf):
    o = load(spark, sf, "orders")
    return o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.desc("cnt"), "o_custkey")


@register("top_k_per_group", f"""
SELECT l_orderkey, l_linenumber, l_extendedprice FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC,
                               {_rest('l_orderkey', 'l_extendedprice')}) AS rn FROM lineitem) WHERE rn <= 3
""")
def top_k_per_group(spark, sf):
    li = load(spark, sf, "lineitem")
    best = K.first_by(li, "l_orderkey", [F.col("l_extendedprice").desc()], k=3)
    return best.select("l_orderkey", "l_linenumber", "l_extendedprice")
