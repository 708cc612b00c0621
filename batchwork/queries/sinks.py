"""§2.2 sink queries (K1-K9): write, read back, compare with the source."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sinks import writers as W
from . import load, register


@register("write_read_back", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, 'parquet' AS fmt FROM orders
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, 'csv' FROM orders
""")
def write_read_back(spark, sf):
    path = scratch_path(spark, "orders_out")
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    out = W.write_table(o, path, partition_by=["o_orderstatus"])
    p = spark.read.parquet(out["parquet"]).withColumn("fmt", F.lit("parquet"))
    c = (spark.read.option("header", True).schema("o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderstatus string")
         .csv(out["csv"]).withColumn("fmt", F.lit("csv")))
    return p.unionByName(c)


# Fixed output layout of the customer extract (name, start, length, kind)
CUST_EXTRACT = [W.Out("c_custkey", 1, 8, "zero"), W.Out("c_name", 9, 20, cut=True), W.Out("c_nationkey", 29, 4, "num"),
                W.Out("c_acctbal", 33, 10, "implied", decimals=2), W.Out("c_mktsegment", 43, 8, cut=True)]


def _sql_zero(x: str, width: int) -> str:
    return (f"CASE WHEN {x} IS NULL THEN repeat('0', {width}) WHEN {x} < 0 THEN '-' || lpad(CAST(abs({x}) AS VARCHAR), {width - 1}, '0') "
            f"ELSE lpad(CAST({x} AS VARCHAR), {width}, '0') END")


_CENTS = "CAST(ROUND(CAST(c_acctbal AS DECIMAL(38,10)) * 100) AS BIGINT)"


@register("fixed_layout_extract", f"""
SELECT c_custkey,
  {_sql_zero('c_custkey', 8)} || rpad(c_name, 20, ' ') || lpad(CAST(c_nationkey AS VARCHAR), 4, ' ')
  || substring({_sql_zero(_CENTS, 10)}, 1, 10) || rpad(c_mktsegment, 8, ' ') AS record,
  concat_ws(',', CASE WHEN length(CAST(abs({_CENTS}) AS VARCHAR)) + CASE WHEN {_CENTS} < 0 THEN 1 ELSE 0 END > 10 THEN 'c_acctbal' END) AS overflow
FROM customer
""")
def fixed_layout_extract(spark, sf):
    c = load(spark, sf, "customer")
    out = W.to_fixed(c, CUST_EXTRACT, on_overflow="flag")
    return out.select("c_custkey", "record", F.array_join("overflow", ",").alias("overflow"))


# Overlapping and out-of-order fields: the later listed field wins its positions
OVERLAP_LAYOUT = [W.Out("o_orderpriority", 11, 15), W.Out("o_orderkey", 1, 10, "zero"),
                  W.Out("o_orderstatus", 14, 1), W.Out("o_custkey", 20, 8, "zero")]


@register("layout_overlap", """
WITH f AS (SELECT o_orderkey, lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS k, rpad(o_orderpriority, 15, ' ') AS p,
                  o_orderstatus AS s, lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS c FROM orders)
SELECT o_orderkey, k || substring(p, 1, 3) || s || substring(p, 5, 5) || c AS record FROM f
""")
def layout_overlap(spark, sf):
    o = load(spark, sf, "orders")
    return W.to_fixed(o, OVERLAP_LAYOUT).select("o_orderkey", "record")


@register("delimited_report", """
SELECT 0 AS line_type, 'MATURITY LIST AS AT 15/08/1998' AS line
UNION ALL SELECT 1, 'O_ORDERKEY,O_ORDERDATE,O_TOTALPRICE'
UNION ALL SELECT 2, CAST(o_orderkey AS VARCHAR) || ',' || strftime(o_orderdate, '%Y-%m-%d') || ',' || CAST(o_totalprice AS VARCHAR)
FROM orders
""")
def delimited_report(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_totalprice")
    r = W.report_lines(o, "MATURITY LIST AS AT 15/08/1998", ["o_orderkey", "o_orderdate", "o_totalprice"])
    return r.select("line_type", "line")


@register("route_outputs", """
SELECT o_orderkey, 'urgent' AS route FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
UNION ALL SELECT o_orderkey, 'open' FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT o_orderkey, 'local_' || CASE WHEN o_custkey < 500 THEN 'a' ELSE 'b' END FROM orders
""")
def route_outputs(spark, sf):
    o = load(spark, sf, "orders")
    # non-exclusive: a row may go to both 'urgent' and 'open'
    both = W.route(o, {"urgent": F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"),
                       "open": F.col("o_orderstatus") == "O"}, exclusive=False)
    # exclusive: exactly one of two outputs by key range, written in one pass
    excl = W.route(o, {"local_a": F.col("o_custkey") < 500}, exclusive=True, default="local_b")
    path = W.write_routes(excl.select("o_orderkey", "route"), scratch_path(spark, "routes"))
    back = spark.read.parquet(path).select("o_orderkey", "route")
    return both.select("o_orderkey", "route").unionByName(back)


@register("conditional_extract", """
SELECT l_orderkey, lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || lpad(CAST(l_linenumber AS VARCHAR), 3, '0')
       || lpad(CAST(CAST(ROUND(CAST(l_extendedprice AS DECIMAL(38,10)) * 100) AS BIGINT) AS VARCHAR), 12, '0') AS record
FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'
""")
def conditional_extract(spark, sf):
    li = load(spark, sf, "lineitem").where((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"))
    lay = [W.Out("l_orderkey", 1, 10, "zero"), W.Out("l_linenumber", 11, 3, "zero"),
           W.Out("l_extendedprice", 14, 12, "implied", decimals=2)]
    return W.to_fixed(li, lay).select("l_orderkey", "record")


@register("publish_snapshot", """
SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1998 AND month(o_orderdate) = 8 THEN o_totalprice * 2 ELSE o_totalprice END AS amount,
       CAST(year(o_orderdate) AS INTEGER) AS period_year, CAST(month(o_orderdate) AS INTEGER) AS period_month
FROM orders
""")
def publish_snapshot(spark, sf):
    path = scratch_path(spark, "published")
    o = load(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("amount"),
                                         F.year("o_orderdate").alias("period_year"), F.month("o_orderdate").alias("period_month"))
    W.publish(o, path, ["period_year", "period_month"])
    # re-publish one period: only that partition is replaced
    redo = o.where("period_year = 1998 AND period_month = 8").withColumn("amount", F.col("amount") * 2)
    W.publish(redo, path, ["period_year", "period_month"])
    return spark.read.parquet(path).select("o_orderkey", "amount", F.col("period_year").cast("int"),
                                           F.col("period_month").cast("int"))


@register("exception_report_or_none", """
SELECT 'negative_balance' AS report, c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0
UNION ALL SELECT 'negative_balance', NULL, NULL WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_acctbal < 0)
UNION ALL SELECT 'over_limit', c_custkey, c_acctbal FROM customer WHERE c_acctbal > 100000
UNION ALL SELECT 'over_limit', NULL, NULL WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_acctbal > 100000)
""")
def exception_report_or_none(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_acctbal")
    neg = W.exception_report(c.where("c_acctbal < 0").withColumn("report", F.lit("negative_balance")),
                             {"report": "negative_balance"})
    over = W.exception_report(c.where("c_acctbal > 100000").withColumn("report", F.lit("over_limit")),
                              {"report": "over_limit"})
    return neg.unionByName(over).select("report", "c_custkey", "c_acctbal")
