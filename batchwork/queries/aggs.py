"""§2.5 aggregation queries (A1-A21) on the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators import agg as A
from ..operators import keys as K
from . import load, register
from ._common import money_sum, msum

_NULLFLAG = "CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_returnflag END"


def _li_nullkey(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.withColumn("flag", F.when(F.col("l_returnflag") == "A", None).otherwise(F.col("l_returnflag")))


@register("group_sum", f"""
SELECT {_NULLFLAG} AS flag, l_linestatus, {msum('l_quantity', 'sum_qty')}, {msum('l_extendedprice', 'sum_price')},
       COUNT(*) AS n_rows
FROM lineitem GROUP BY 1, 2
""")
def group_sum(spark, sf):
    li = _li_nullkey(spark, sf)
    return A.group_sum(li, ["flag", "l_linestatus"],
                       [money_sum("l_quantity", "sum_qty"), money_sum("l_extendedprice", "sum_price")],
                       keep_null_groups=True, count="n_rows")


@register("group_sum_nonnull_keys", f"""
SELECT {_NULLFLAG} AS flag, l_linestatus, {msum('l_quantity', 'sum_qty')}, COUNT(*) AS n_rows
FROM lineitem WHERE l_returnflag <> 'A' GROUP BY 1, 2
""")
def group_sum_nonnull_keys(spark, sf):
    li = _li_nullkey(spark, sf)
    return A.group_sum(li, ["flag", "l_linestatus"], [money_sum("l_quantity", "sum_qty")],
                       keep_null_groups=False, count="n_rows")


@register("cube_levels", f"""
SELECT {_NULLFLAG} AS flag, l_linestatus, {msum('l_quantity', 'sum_qty')}, COUNT(*) AS n_rows,
       CAST(3 - GROUPING({_NULLFLAG}, l_linestatus) AS INTEGER) AS _type_
FROM lineitem WHERE l_returnflag <> 'A'
GROUP BY CUBE ({_NULLFLAG}, l_linestatus)
""")
def cube_levels(spark, sf):
    li = _li_nullkey(spark, sf)
    return A.class_levels(li, ["flag", "l_linestatus"],
                          [money_sum("l_quantity", "sum_qty"), F.count(F.lit(1)).alias("n_rows")])


@register("group_count", """
SELECT o_orderstatus, COUNT(*) AS _freq_ FROM orders GROUP BY o_orderstatus
""")
def group_count(spark, sf):
    return load(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("_freq_"))


@register("filtered_sum", f"""
SELECT l_returnflag,
       CAST(SUM(CASE WHEN year(l_shipdate) = 1998 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS sum_1998,
       COUNT(*) AS n_all
FROM lineitem GROUP BY l_returnflag
""")
def filtered_sum(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.groupBy("l_returnflag").agg(
        money_sum(F.when(F.year("l_shipdate") == 1998, F.col("l_extendedprice")), "sum_1998"),
        F.count(F.lit(1)).alias("n_all"))


@register("distinct_count", """
SELECT l_suppkey, COUNT(DISTINCT l_partkey) AS n_parts, COUNT(DISTINCT l_orderkey) AS n_orders
FROM lineitem GROUP BY l_suppkey
""")
def distinct_count(spark, sf):
    return load(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.count_distinct("l_partkey").alias("n_parts"), F.count_distinct("l_orderkey").alias("n_orders"))


def _mdp(c):
    return (f"COALESCE(SUM(DISTINCT CASE WHEN {c} > 0 THEN {c} END) / "
            f"COUNT(DISTINCT CASE WHEN {c} > 0 THEN {c} END), 0) AS {c}_avg")


@register("mean_distinct_positive", f"""
SELECT l_suppkey, {_mdp('l_quantity')}, {_mdp('l_discount')}, {_mdp('l_tax')}
FROM lineitem GROUP BY l_suppkey
""")
def mean_distinct_positive(spark, sf):
    return A.mean_distinct_positive(load(spark, sf, "lineitem"), "l_suppkey", ["l_quantity", "l_discount", "l_tax"])


@register("any_flag", """
SELECT l_orderkey, BOOL_OR(l_returnflag = 'R') AS any_returned, BOOL_OR(l_linestatus = 'O') AS any_open
FROM lineitem GROUP BY l_orderkey
""")
def any_flag(spark, sf):
    return load(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.bool_or(F.col("l_returnflag") == "R").alias("any_returned"),
        F.bool_or(F.col("l_linestatus") == "O").alias("any_open"))


@register("ordered_concat", """
SELECT l_orderkey,
       string_agg(CAST(l_linenumber AS VARCHAR) || ':' || l_returnflag, '|' ORDER BY l_linenumber,
                  CAST(l_linenumber AS VARCHAR) || ':' || l_returnflag) AS joined
FROM lineitem GROUP BY l_orderkey
""")
def ordered_concat(spark, sf):
    li = load(spark, sf, "lineitem").withColumn(
        "v", F.concat(F.col("l_linenumber").cast("string"), F.lit(":"), F.col("l_returnflag")))
    return A.ordered_concat(li, "l_orderkey", "v", "l_linenumber", "|", "joined")


@register("min_positive", """
SELECT l_orderkey, MIN(CASE WHEN l_discount > 0 THEN CAST(l_shipdate AS DATE) END) AS first_discounted
FROM lineitem GROUP BY l_orderkey
""")
def min_positive(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.groupBy("l_orderkey").agg(
        F.min(F.when(F.col("l_discount") > 0, F.col("l_shipdate").cast("date"))).alias("first_discounted"))


@register("pivot_sum", """
SELECT l_suppkey,
  CAST(SUM(CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS DECIMAL(18,2)) END) AS DOUBLE) AS A,
  CAST(SUM(CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS DECIMAL(18,2)) END) AS DOUBLE) AS N,
  CAST(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS DECIMAL(18,2)) END) AS DOUBLE) AS R
FROM lineitem GROUP BY l_suppkey
""")
def pivot_sum(spark, sf):
    li = load(spark, sf, "lineitem").withColumn("q", F.col("l_quantity").cast("decimal(18,2)"))
    p = li.groupBy("l_suppkey").pivot("l_returnflag", ["A", "N", "R"]).agg(F.sum("q"))
    return p.select("l_suppkey", *[F.col(c).cast("double").alias(c) for c in ["A", "N", "R"]])


@register("unpivot_positive", """
SELECT l_orderkey, l_linenumber, kind, amount FROM (
  SELECT l_orderkey, l_linenumber, 'l_discount' AS kind, l_discount AS amount FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem) WHERE amount > 0
""")
def unpivot_positive(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    return A.unpivot_positive(li, ["l_orderkey", "l_linenumber"], ["l_discount", "l_tax"], "kind", "amount")


@register("crosstab_totals", """
WITH c AS (
  SELECT CASE WHEN GROUPING(l_returnflag) = 1 THEN 'TOTAL' ELSE l_returnflag END AS l_returnflag,
         CASE WHEN GROUPING(l_linestatus) = 1 THEN 'TOTAL' ELSE l_linestatus END AS l_linestatus,
         SUM(CAST(l_quantity AS DECIMAL(18,2))) AS v
  FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus))
SELECT l_returnflag,
       CAST(MAX(CASE WHEN l_linestatus = 'F' THEN v END) AS DOUBLE) AS F,
       CAST(MAX(CASE WHEN l_linestatus = 'O' THEN v END) AS DOUBLE) AS O,
       CAST(MAX(CASE WHEN l_linestatus = 'TOTAL' THEN v END) AS DOUBLE) AS TOTAL
FROM c GROUP BY l_returnflag
""")
def crosstab_totals(spark, sf):
    li = load(spark, sf, "lineitem").withColumn("q", F.col("l_quantity").cast("decimal(18,2)"))
    x = A.crosstab_totals(li, "l_returnflag", "l_linestatus", "q", ["F", "O"])
    return x.select("l_returnflag", *[F.col(c).cast("double").alias(c) for c in ["F", "O", "TOTAL"]])


@register("break_report", """
WITH c AS (SELECT n.n_name, c.c_mktsegment, c.c_custkey, CAST(c.c_acctbal AS DECIMAL(18,2)) AS bal
           FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)
SELECT n_name, c_mktsegment, c_custkey, CAST(bal AS DOUBLE) AS bal, 0 AS level, 'detail' AS row_kind FROM c
UNION ALL
SELECT n_name, c_mktsegment, NULL, CAST(SUM(bal) AS DOUBLE),
       CAST(1 + GROUPING(n_name) + GROUPING(c_mktsegment) AS INTEGER),
       CASE WHEN GROUPING(n_name) = 1 THEN 'total' ELSE 'subtotal' END
FROM c GROUP BY ROLLUP (n_name, c_mktsegment)
""")
def break_report(spark, sf):
    c = load(spark, sf, "customer").withColumn("bal", F.col("c_acctbal").cast("decimal(18,2)"))
    n = load(spark, sf, "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey).select("n_name", "c_mktsegment", "c_custkey", "bal")
    r = A.break_report(j, ["n_name", "c_mktsegment"], ["bal"], ["c_custkey"])
    return r.withColumn("bal", F.col("bal").cast("double"))


@register("grouping_sets", f"""
SELECT l_returnflag, l_linestatus, {msum('l_quantity', 'sum_qty')},
       CAST(3 - GROUPING(l_returnflag, l_linestatus) AS INTEGER) AS _type_
FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())
""")
def grouping_sets(spark, sf):
    li = load(spark, sf, "lineitem")
    return A.grouping_sets(li, ["l_returnflag", "l_linestatus"], [money_sum("l_quantity", "sum_qty")], [3, 2, 0])


@register("total_back_to_detail", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) OVER (PARTITION BY l_orderkey) AS DOUBLE) AS order_total,
       ROUND(l_extendedprice / SUM(l_extendedprice) OVER (PARTITION BY l_orderkey), 6) AS share
FROM lineitem
""")
def total_back_to_detail(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    # group total computed once (partial aggregation) and joined back on the key, so a
    # large order is pre-aggregated instead of buffered in one window frame
    tot = li.groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("t"),
                                       F.sum("l_extendedprice").alias("td"))
    j = K.join_on(li, tot, "l_orderkey")
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
                    F.col("t").cast("double").alias("order_total"),
                    F.round(F.col("l_extendedprice") / F.col("td"), 6).alias("share"))


@register("exception_totals", f"""
SELECT COUNT(*) AS n_exceptions, {msum('o_totalprice', 'exception_amount')}
FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
""")
def exception_totals(spark, sf):
    o = load(spark, sf, "orders")
    ex = o.join(load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")
    return ex.agg(F.count(F.lit(1)).alias("n_exceptions"), money_sum("o_totalprice", "exception_amount"))


@register("group_sum_max", f"""
SELECT l_orderkey, {msum('l_extendedprice', 'sum_price')}, MAX(l_extendedprice) AS max_price,
       MAX(CAST(l_shipdate AS DATE)) AS last_ship
FROM lineitem GROUP BY l_orderkey
""")
def group_sum_max(spark, sf):
    return load(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        money_sum("l_extendedprice", "sum_price"), F.max("l_extendedprice").alias("max_price"),
        F.max(F.col("l_shipdate").cast("date")).alias("last_ship"))


_ACC_SQL = f"""
WITH o AS (SELECT c.c_nationkey AS nation, o.o_orderdate, CAST(o.o_totalprice AS DECIMAL(18,2)) AS amt
           FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
cur AS (SELECT nation, SUM(amt) AS amount FROM o WHERE date_trunc('month', o_orderdate) = DATE '1998-08-01' GROUP BY nation),
prior AS (SELECT nation, SUM(amt) AS amount FROM o WHERE o_orderdate >= DATE '1998-01-01' AND o_orderdate < DATE '1998-08-01' GROUP BY nation),
u AS (SELECT * FROM cur UNION ALL SELECT * FROM prior)
SELECT CASE WHEN nation = 24 THEN 23 ELSE nation END AS nation, CAST(SUM(amount) AS DOUBLE) AS amount
FROM u GROUP BY 1
"""


@register("accumulate_prior", _ACC_SQL)
def accumulate_prior(spark, sf):
    o = load(spark, sf, "orders")
    c = load(spark, sf, "customer")
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .select(F.col("c_nationkey").alias("nation"), "o_orderdate",
                  F.col("o_totalprice").cast("decimal(18,2)").alias("amt")))
    cur = (j.where(F.trunc(F.col("o_orderdate").cast("date"), "MM") == F.lit("1998-08-01").cast("date"))
            .groupBy("nation").agg(F.sum("amt").alias("amount")))
    prior = (j.where((F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
                     & (F.col("o_orderdate") < F.lit("1998-08-01").cast("timestamp_ntz")))
              .groupBy("nation").agg(F.sum("amt").alias("amount")))
    # retired nation 24 is merged into 23 after the union, then everything re-summed
    out = A.accumulate(cur, prior, ["nation"], ["amount"],
                       remap=F.when(F.col("nation") == 24, F.lit(23)).otherwise(F.col("nation")), remap_key="nation")
    return out.withColumn("amount", F.col("amount").cast("double"))


_PART_QTY = f"""
WITH q AS (SELECT l_partkey AS p, SUM(CAST(l_quantity AS DECIMAL(18,2))) AS qty FROM lineitem GROUP BY l_partkey),
up AS (SELECT p // 7 AS p, SUM(qty) AS cqty FROM q WHERE p > 0 GROUP BY p // 7)
SELECT COALESCE(q.p, up.p) AS p_partkey,
       CAST(CASE WHEN q.qty IS NULL AND up.cqty IS NULL THEN NULL
                 ELSE COALESCE(q.qty, 0) + COALESCE(up.cqty, 0) END AS DOUBLE) AS qty
FROM q FULL JOIN up ON q.p = up.p
"""


@register("rollup_child_to_parent", _PART_QTY)
def rollup_child_to_parent(spark, sf):
    q = (load(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey"))
         .agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("qty")))
    parent = F.when(F.col("p_partkey") > 0, F.floor(F.col("p_partkey") / 7).cast("bigint"))
    out = A.rollup_child_to_parent(q, "p_partkey", parent, ["qty"])
    return out.withColumn("qty", F.col("qty").cast("double"))


@register("balance_plus_interest", f"""
WITH i AS (SELECT l_orderkey, SUM(CASE WHEN l_returnflag = 'N'
                  THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) END) AS interest
           FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey, CAST(i.interest AS DOUBLE) AS interest,
       CAST(CASE WHEN o.o_totalprice IS NULL AND i.interest IS NULL THEN NULL
            ELSE COALESCE(CAST(o.o_totalprice AS DECIMAL(18,2)), 0) + COALESCE(i.interest, 0) END AS DOUBLE) AS balance
FROM orders o LEFT JOIN i ON o.o_orderkey = i.l_orderkey
""")
def balance_plus_interest(spark, sf):
    li = load(spark, sf, "lineitem")
    intr = (F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(18,2)")
    i = li.groupBy("l_orderkey").agg(F.sum(F.when(F.col("l_returnflag") == "N", intr)).alias("interest"))
    o = load(spark, sf, "orders")
    j = o.join(i, o.o_orderkey == i.l_orderkey, "left")
    return j.select("o_orderkey", F.col("interest").cast("double").alias("interest"),
                    C.row_sum(F.col("o_totalprice").cast("decimal(18,2)"), "interest").cast("double").alias("balance"))
