"""§2.8 set operation queries (U1-U6) on the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sets as S
from ..operators.keys import join_on
from . import load, register


@register("union_by_name", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, NULL::VARCHAR AS segment_or_null, c_nationkey AS nation FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL, s_nationkey FROM supplier
UNION ALL SELECT c_custkey, NULL, NULL, c_mktsegment, NULL FROM customer WHERE c_acctbal < 0
""")
def union_by_name(spark, sf):
    c = load(spark, sf, "customer")
    s = load(spark, sf, "supplier")
    a = c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
                 F.col("c_nationkey").alias("nation"))
    b = s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"),
                 F.col("s_nationkey").alias("nation"))
    d = c.where("c_acctbal < 0").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment_or_null"))
    return S.concat([a, b, d])


@register("union_relaxed", """
SELECT CAST(n_nationkey AS BIGINT) AS k, n_name AS v, CAST(n_regionkey AS DOUBLE) AS x FROM nation
UNION ALL SELECT r_regionkey, r_name, NULL FROM region
UNION ALL SELECT s_suppkey, CAST(s_nationkey AS VARCHAR), s_acctbal FROM supplier
""")
def union_relaxed(spark, sf):
    n = load(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("v"),
                                         F.col("n_regionkey").alias("x"))            # int, string, int
    r = load(spark, sf, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("v"))
    s = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("v"),
                                           F.col("s_acctbal").alias("x"))            # long, int, double
    return S.concat_relaxed([n, r, s])


@register("union_source_flag", """
SELECT o_orderkey, 'open' AS source FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT o_orderkey, 'urgent' FROM orders WHERE o_orderpriority = '1-URGENT'
""")
def union_source_flag(spark, sf):
    o = load(spark, sf, "orders")
    return S.concat_with_source({"open": o.where("o_orderstatus = 'O'").select("o_orderkey"),
                                 "urgent": o.where("o_orderpriority = '1-URGENT'").select("o_orderkey")})


@register("except_by_key", """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1998)
""")
def except_by_key(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_name")
    o = load(spark, sf, "orders").where(F.year("o_orderdate") == 1998).select(F.col("o_custkey").alias("c_custkey"))
    return S.except_by_key(c, o, "c_custkey")


@register("intersect_by_key", """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
""")
def intersect_by_key(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_name")
    o = load(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return S.intersect_by_key(c, o, "c_custkey")


@register("split_recombine", """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderstatus = 'P' THEN CAST(MAX(o_totalprice) OVER (PARTITION BY o_custkey) AS DOUBLE)
            ELSE o_totalprice END AS amount
FROM orders
""")
def split_recombine(spark, sf):
    """A subset ('P' orders) is processed differently — it takes the customer's largest
    order amount — and recombined; done in one pass (group max joined back) instead of
    filtering twice and unioning."""
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    mx = o.groupBy("o_custkey").agg(F.max("o_totalprice").alias("__mx"))
    j = join_on(o, mx, "o_custkey")
    return j.select("o_orderkey", "o_custkey", "o_orderstatus",
                    F.when(F.col("o_orderstatus") == "P", F.col("__mx")).otherwise(F.col("o_totalprice")).alias("amount"))
