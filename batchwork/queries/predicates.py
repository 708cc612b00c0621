"""§2.3 projection / filter / predicate queries (P1-P18) on the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators.joins import code_table
from . import load, register
from ._common import REPORT_DATE, money_sum, msum


@register("keep_drop_rename", """
SELECT o_orderkey AS order_no, o_custkey AS account, o_orderstatus AS status,
       CAST(o_orderdate AS DATE) AS order_date
FROM orders
""")
def keep_drop_rename(spark, sf):
    o = load(spark, sf, "orders").drop("o_totalprice", "o_orderpriority")
    o = o.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    return o.withColumnsRenamed({"o_orderkey": "order_no", "o_custkey": "account",
                                 "o_orderstatus": "status", "o_orderdate": "order_date"})


@register("prefix_select", """
SELECT l_linenumber, l_linestatus FROM lineitem
""")
def prefix_select(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.select(*[c for c in li.columns if c.startswith("l_line")])


@register("swap_columns", """
SELECT o_custkey AS o_orderkey, o_orderkey AS o_custkey, o_orderstatus FROM orders
""")
def swap_columns(spark, sf):
    o = load(spark, sf, "orders")
    return o.select(F.col("o_custkey").alias("o_orderkey"), F.col("o_orderkey").alias("o_custkey"), "o_orderstatus")


_CASE_RULES = [("l_quantity > 40", "BULK"), ("l_discount >= 0.08", "PROMO"), ("l_returnflag = 'R'", "RETURN")]


def _case_sql(last_wins: bool) -> str:
    rules = list(reversed(_CASE_RULES)) if last_wins else _CASE_RULES
    body = " ".join(f"WHEN {c} THEN '{v}'" for c, v in rules)
    return f"""
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_returnflag,
       CASE {body} ELSE 'OTHER' END AS line_class
FROM lineitem
"""


def _case(spark, sf, last_wins: bool):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag")
    out = F.lit("OTHER")
    # first-wins: build the chain from the last rule outward; last-wins: successive IFs
    rules = _CASE_RULES if last_wins else list(reversed(_CASE_RULES))
    for cond, v in rules:
        out = F.when(F.expr(cond), F.lit(v)).otherwise(out)
    return li.withColumn("line_class", out)


@register("case_first_wins", _case_sql(False))
def case_first_wins(spark, sf):
    return _case(spark, sf, last_wins=False)


@register("case_last_wins", _case_sql(True))
def case_last_wins(spark, sf):
    return _case(spark, sf, last_wins=True)


# Fixed code maps for the supplied flags (values of the test tables)
RETURN_FLAG_LABELS = [("A", "ACCEPTED"), ("N", "NONE"), ("R", "RETURNED")]
LINE_STATUS_LABELS = {"F": "FILLED", "O": "OPEN"}


@register("code_remap", """
SELECT l.l_orderkey, l.l_linenumber, m.label AS flag_label,
       CASE l.l_linestatus WHEN 'F' THEN 'FILLED' WHEN 'O' THEN 'OPEN' END AS status_label
FROM lineitem l LEFT JOIN (VALUES ('A','ACCEPTED'),('N','NONE'),('R','RETURNED')) m(code, label)
  ON l.l_returnflag = m.code
""")
def code_remap(spark, sf):
    li = load(spark, sf, "lineitem")
    codes = code_table(spark, RETURN_FLAG_LABELS, "code string, label string")
    smap = F.create_map(*[F.lit(x) for kv in LINE_STATUS_LABELS.items() for x in kv])
    return (li.join(codes, li.l_returnflag == codes.code, "left")
              .select("l_orderkey", "l_linenumber", F.col("label").alias("flag_label"),
                      smap[F.col("l_linestatus")].alias("status_label")))


@register("subset_filter", """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND NOT (o_orderstatus = 'P')
""")
def subset_filter(spark, sf):
    o = load(spark, sf, "orders").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    # DELETE rows: a second, negative condition
    return o.where(~(F.col("o_orderstatus") == "P")).select("o_orderkey", "o_custkey", "o_orderstatus")


@register("in_list_and_range", """
SELECT p_partkey, p_size, p_brand FROM part
WHERE (p_size IN (1, 5, 10) OR p_size BETWEEN 20 AND 29) AND p_brand NOT IN ('Brand#1', 'Brand#2')
""")
def in_list_and_range(spark, sf):
    p = load(spark, sf, "part")
    cond = (F.col("p_size").isin(1, 5, 10) | F.col("p_size").between(20, 29)) & \
        ~F.col("p_brand").isin("Brand#1", "Brand#2")
    return p.where(cond).select("p_partkey", "p_size", "p_brand")


# Fixed account-range classes (class, low, high)
KEY_RANGES = [("LOCAL", 0, 499), ("FOREIGN", 500, 999), ("STAFF", 1000, 1199)]


@register("range_classify", """
SELECT c_custkey, CASE WHEN c_custkey BETWEEN 0 AND 499 THEN 'LOCAL'
                       WHEN c_custkey BETWEEN 500 AND 999 THEN 'FOREIGN'
                       WHEN c_custkey BETWEEN 1000 AND 1199 THEN 'STAFF'
                       ELSE 'OTHER' END AS key_class
FROM customer
""")
def range_classify(spark, sf):
    out = F.lit("OTHER")
    for name, lo, hi in reversed(KEY_RANGES):
        out = F.when(F.col("c_custkey").between(lo, hi), F.lit(name)).otherwise(out)
    return load(spark, sf, "customer").select("c_custkey", out.alias("key_class"))


@register("period_between", f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-08-01' AND DATE '{REPORT_DATE}'
""")
def period_between(spark, sf):
    from ..functions.calendar import month_start
    rd = F.lit(REPORT_DATE).cast("date")
    o = load(spark, sf, "orders").withColumn("order_date", F.col("o_orderdate").cast("date"))
    return o.where(F.col("order_date").between(month_start(rd), rd)).select("o_orderkey", "order_date")


@register("missing_low_compare", """
WITH c AS (SELECT c_custkey, CASE WHEN c_acctbal > 9000 THEN NULL ELSE c_acctbal END AS bal FROM customer)
SELECT c_custkey, bal, (bal IS NULL OR bal < 0) AS below_zero_sas, COALESCE(bal < 0, FALSE) AS below_zero_plain
FROM c
""")
def missing_low_compare(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", F.when(F.col("c_acctbal") > 9000, None)
                                           .otherwise(F.col("c_acctbal")).alias("bal"))
    return c.select("c_custkey", "bal", C.lt_missing("bal", 0).alias("below_zero_sas"),
                    F.coalesce(F.col("bal") < 0, F.lit(False)).alias("below_zero_plain"))


@register("default_missing", f"""
SELECT o.o_orderkey, COALESCE(l.amt, 0) AS line_amount, COALESCE(l.n, 0) AS line_count
FROM orders o LEFT JOIN (SELECT l_orderkey, {msum('l_extendedprice', 'amt')}, COUNT(*) AS n
                         FROM lineitem GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey
""")
def default_missing(spark, sf):
    li = load(spark, sf, "lineitem").groupBy("l_orderkey").agg(money_sum("l_extendedprice", "amt"),
                                                               F.count(F.lit(1)).alias("n"))
    o = load(spark, sf, "orders").select("o_orderkey")
    j = o.join(li, o.o_orderkey == li.l_orderkey, "left")
    return j.select("o_orderkey", C.default_missing("amt", 0.0).alias("line_amount"),
                    C.default_missing("n", 0).alias("line_count"))


@register("first_non_blank", """
WITH c AS (
  SELECT c_custkey,
         CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN '  ' ELSE c_mktsegment END AS seg1,
         CASE WHEN c_nationkey < 5 THEN NULL ELSE 'N' || CAST(c_nationkey AS VARCHAR) END AS seg2,
         c_name AS seg3,
         CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS b1, c_acctbal AS b2 FROM customer)
SELECT c_custkey, COALESCE(NULLIF(TRIM(seg1), ''), NULLIF(TRIM(seg2), ''), NULLIF(TRIM(seg3), '')) AS label,
       COALESCE(NULLIF(b1, 0), NULLIF(b2, 0)) AS first_balance
FROM c
""")
def first_non_blank(spark, sf):
    c = load(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE"), F.lit("  ")).otherwise(F.col("c_mktsegment")).alias("seg1"),
        F.when(F.col("c_nationkey") < 5, None).otherwise(F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))).alias("seg2"),
        F.col("c_name").alias("seg3"),
        F.when(F.col("c_acctbal") < 0, F.lit(0.0)).otherwise(F.col("c_acctbal")).alias("b1"),
        F.col("c_acctbal").alias("b2"))
    return c.select("c_custkey", C.first_non_blank("seg1", "seg2", "seg3").alias("label"),
                    C.first_non_zero("b1", "b2").alias("first_balance"))


@register("clamp_values", """
SELECT l_orderkey, l_linenumber, l_discount,
       LEAST(GREATEST(l_discount, 0.02), 0.08) AS disc_bounded,
       GREATEST(l_extendedprice * (l_tax - 0.04), 0) AS floored
FROM lineitem
""")
def clamp_values(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_discount",
                     C.clamp("l_discount", 0.02, 0.08).alias("disc_bounded"),
                     C.clamp(F.col("l_extendedprice") * (F.col("l_tax") - 0.04), lo=0.0).alias("floored"))


@register("scale_minor_units", """
SELECT o_orderkey, CAST(ROUND(CAST(o_totalprice AS DECIMAL(18,2)) * 100) AS BIGINT) AS amount_cents,
       CAST(ROUND(CAST(o_totalprice AS DECIMAL(18,2)) / 3.7 * 100000) AS BIGINT) AS fx_scaled
FROM orders
""")
def scale_minor_units(spark, sf):
    o = load(spark, sf, "orders")
    tp = F.col("o_totalprice").cast("decimal(18,2)")
    return o.select("o_orderkey", C.scale_minor_units(tp, 100).cast("bigint").alias("amount_cents"),
                    C.scale_minor_units(tp, 100000, divisor=F.lit(3.7).cast("decimal(2,1)")).cast("bigint").alias("fx_scaled"))


@register("mask_measures", """
SELECT o_orderkey, o_orderstatus,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS o_custkey
FROM orders
""")
def mask_measures(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_custkey")
    flag = F.col("o_orderstatus") == "P"
    return o.withColumns({m: C.mask_when(flag, m) for m in ["o_totalprice", "o_custkey"]})


@register("presence_flags", """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'N'
       WHEN l_discount > 0.05 THEN 'Y'
       WHEN l_tax > 0 THEN 'Y' ELSE 'N' END AS f_priced,
  CASE WHEN l_quantity >= 45 THEN 'Y' ELSE 'N' END AS f_large,
  CASE WHEN l_returnflag = 'R' THEN 'R' WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS f_closed
FROM lineitem
""")
def presence_flags(spark, sf):
    li = load(spark, sf, "lineitem")
    # successive rules, the last applicable one wins: start from the default and let each
    # later rule overwrite
    f1 = F.lit("N")
    f1 = F.when(F.col("l_tax") > 0, F.lit("Y")).otherwise(f1)
    f1 = F.when(F.col("l_discount") > 0.05, F.lit("Y")).otherwise(f1)
    f1 = F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), F.lit("N")).otherwise(f1)
    f2 = F.when(F.col("l_quantity") >= 45, F.lit("Y")).otherwise(F.lit("N"))
    f3 = F.lit("N")
    f3 = F.when(F.col("l_linestatus") == "F", F.lit("Y")).otherwise(f3)
    f3 = F.when(F.col("l_returnflag") == "R", F.lit("R")).otherwise(f3)
    return li.select("l_orderkey", "l_linenumber", f1.alias("f_priced"), f2.alias("f_large"), f3.alias("f_closed"))


# Fixed exclusion list of account keys (control table)
EXCLUDED_CUSTOMERS = [(3,), (7,), (11,), (42,), (100,), (1001,)]


@register("exclude_keys", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey NOT IN (3, 7, 11, 42, 100, 1001)
""")
def exclude_keys(spark, sf):
    ex = code_table(spark, EXCLUDED_CUSTOMERS, "o_custkey bigint")
    return load(spark, sf, "orders").select("o_orderkey", "o_custkey").join(ex, "o_custkey", "left_anti")


@register("open_or_this_month", f"""
SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS order_date FROM orders
WHERE COALESCE(date_trunc('month', o_orderdate) = DATE '1998-08-01', FALSE)
   OR COALESCE(o_orderstatus = 'O', FALSE)
""")
def open_or_this_month(spark, sf):
    rd = F.lit(REPORT_DATE).cast("date")
    o = load(spark, sf, "orders").withColumn("order_date", F.col("o_orderdate").cast("date"))
    this_month = F.coalesce(C.same_month("order_date", rd), F.lit(False))
    is_open = F.coalesce(F.col("o_orderstatus") == "O", F.lit(False))
    return o.where(this_month | is_open).select("o_orderkey", "o_orderstatus", "order_date")
