"""End-to-end job shapes (L1-L18) re-aimed at the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.joins import reconcile
from . import load, register
from . import _trade_feeds as TF
from ._common import COLLATERAL_PAIRS, REPORT_DATE, money_sum, msum
from ._loan_book import LOAN_BOOK_SQL, loan_book
from ._records import record_sql
from .rules import FACILITY_SQL, INDUSTRY, SECTOR_STEPS, TIED_SQL


def _order_feeds(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    lines = (load(spark, sf, "lineitem").groupBy("l_orderkey")
             .agg(money_sum("l_extendedprice", "line_amount"), F.count(F.lit(1)).alias("line_count"))
             .withColumnRenamed("l_orderkey", "o_orderkey"))
    return orders, lines


@register("reconcile_break_totals", f"""
WITH lines AS (
  SELECT l_orderkey AS o_orderkey, {msum('l_extendedprice', 'line_amount')}, COUNT(*) AS line_count
  FROM lineitem GROUP BY l_orderkey),
r AS (
  SELECT COALESCE(o.o_orderkey, l.o_orderkey) AS o_orderkey, o.o_custkey, o.o_totalprice,
         l.line_amount, l.line_count,
         CASE WHEN o.o_orderkey IS NOT NULL AND l.o_orderkey IS NOT NULL THEN 'matched'
              WHEN o.o_orderkey IS NOT NULL THEN 'master_only' ELSE 'detail_only' END AS status
  FROM (SELECT o_orderkey, o_custkey, o_totalprice FROM orders) o
  FULL JOIN lines l ON o.o_orderkey = l.o_orderkey)
SELECT n.n_name, r.status, CAST(GROUPING(n.n_name, r.status) AS BIGINT) AS grouping_level,
       COUNT(*) AS n_orders, {msum('r.o_totalprice', 'order_amount')},
       CAST(SUM(CAST(r.line_amount AS DECIMAL(18,2))) AS DOUBLE) AS line_amount,
       CAST(SUM(r.line_count) AS BIGINT) AS line_count
FROM r LEFT JOIN customer c ON r.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY ROLLUP (n.n_name, r.status)
""")
def reconcile_break_totals(spark, sf):
    """Flagship: two-feed reconcile (orders vs summed lines) + break totals by nation."""
    orders, lines = _order_feeds(spark, sf)
    r = reconcile(orders, lines, "o_orderkey", labels=("matched", "master_only", "detail_only"))
    cust = load(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nation = load(spark, sf, "nation").select("n_nationkey", "n_name")
    j = (r.join(cust, r.o_custkey == cust.c_custkey, "left")
          .join(nation, F.col("c_nationkey") == nation.n_nationkey, "left"))
    return (j.rollup("n_name", "status")
             .agg(F.grouping_id().cast("bigint").alias("grouping_level"),
                  F.count(F.lit(1)).alias("n_orders"),
                  money_sum("o_totalprice", "order_amount"),
                  money_sum("line_amount", "line_amount"),
                  F.sum("line_count").cast("bigint").alias("line_count")))


# ---------------------------------------------------------------------------- L1-L18
from ..functions import calendar as CAL  # noqa: E402
from ..functions import clean as C  # noqa: E402
from ..operators import joins as J  # noqa: E402
from ..plans import jobs as P  # noqa: E402
from ..session import scratch_path  # noqa: E402
from ..sinks import writers as W  # noqa: E402
from ..sources import readers as R  # noqa: E402
from ._common import REPORT_DATE  # noqa: E402


@register("pl_payment_recon", """
WITH c AS (SELECT l_orderkey AS k, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS coll_amount FROM lineitem
           WHERE l_returnflag <> 'R' GROUP BY 1),
fee AS (SELECT k, fee FROM (SELECT l_orderkey AS k, l_extendedprice AS fee,
           ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_extendedprice) AS rn
           FROM lineitem WHERE l_returnflag = 'R') WHERE rn = 1),
f AS (SELECT o_orderkey AS k, CAST(o_totalprice AS DECIMAL(18,2)) AS feed_amount FROM orders),
r AS (SELECT COALESCE(f.k, c.k) AS k, f.feed_amount, c.coll_amount,
             CASE WHEN f.k IS NOT NULL AND c.k IS NOT NULL THEN 'matched' WHEN f.k IS NOT NULL THEN 'feed_only'
                  ELSE 'collection_only' END AS status FROM f FULL JOIN c ON f.k = c.k),
e AS (SELECT r.*, fee.fee FROM r LEFT JOIN fee ON r.k = fee.k WHERE status <> 'matched' OR feed_amount < coll_amount)
SELECT k AS o_orderkey, status, CAST(feed_amount AS DOUBLE) AS feed_amount, CAST(coll_amount AS DOUBLE) AS coll_amount,
       fee, 'detail' AS line_type FROM e
UNION ALL SELECT NULL, NULL, CAST(COUNT(*) AS DOUBLE), CAST(SUM(COALESCE(feed_amount, coll_amount)) AS DOUBLE), NULL, 'total' FROM e
""")
def pl_payment_recon(spark, sf):
    feed = load(spark, sf, "orders")
    txn = load(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    out = P.payment_recon(feed, txn, "o_orderkey", "o_totalprice", "l_extendedprice",
                          F.col("l_returnflag") == "R", ["l_linenumber", "l_extendedprice"])
    rep = out["report"]
    return rep.select("o_orderkey", "status", F.col("feed_amount").cast("double").alias("feed_amount"),
                      F.col("coll_amount").cast("double").alias("coll_amount"), "fee", "line_type")


@register("pl_freshness", """
WITH f AS (SELECT 'orders' AS feed, CAST(MAX(o_orderdate) AS DATE) AS latest_date FROM orders
           UNION ALL SELECT 'lineitem', CAST(MAX(l_shipdate) AS DATE) FROM lineitem),
d AS (SELECT max(latest_date) AS rd FROM f WHERE feed = 'lineitem')
SELECT feed, latest_date, latest_date = rd AS fresh, (SELECT bool_and(latest_date = rd) FROM f, d) AS may_run FROM f, d
""")
def pl_freshness(spark, sf):
    """Each feed is written with a header line carrying its newest date; the gate
    reads only the headers back (one line per feed) and compares with the report date."""
    feeds = {"orders": "o_orderdate", "lineitem": "l_shipdate"}
    headers = {}
    for name, dcol in feeds.items():
        df = load(spark, sf, name)
        path = scratch_path(spark, f"feed_{name}")
        # the header line is the feed's date; the newest date is one aggregate row
        hdr = df.agg(F.date_format(F.max(dcol), "yyyyMMdd").alias("value"))
        hdr.write.text(path + "/h")
        first = R.read_header(spark, path + "/h")
        headers[name] = first.select(F.try_to_date(F.col("value"), "yyyyMMdd").alias("feed_date"))
    asof = load(spark, sf, "lineitem").agg(F.max("l_shipdate").cast("date")).first()[0]  # the run date: that of the newest line
    return P.freshness_from_headers(headers, asof).select("feed", "latest_date", "fresh", "may_run")


@register("pl_daily_detail", f"""
WITH s AS (SELECT l_orderkey AS ref, l_linenumber AS sub, CASE WHEN l_linenumber > 1 THEN l_linenumber // 2 END AS parent, l_partkey AS account,
                  l_orderkey % 1000 AS ref2, CAST(l_shipdate AS DATE) AS maturity FROM lineitem),
c AS (SELECT a.*, a1.sub AS s1, a2.sub AS s2, a3.sub AS s3 FROM s a LEFT JOIN s a1 ON a.ref = a1.ref AND a.parent = a1.sub
      LEFT JOIN s a2 ON a.ref = a2.ref AND a1.parent = a2.sub LEFT JOIN s a3 ON a.ref = a3.ref AND a2.parent = a3.sub),
d AS (SELECT *, (s1 IS NOT NULL)::INT + (s2 IS NOT NULL)::INT + (s3 IS NOT NULL)::INT AS depth FROM c),
u AS (SELECT ref, ref2, sub, account, maturity, depth FROM (SELECT *, RANK() OVER (PARTITION BY ref ORDER BY depth DESC) AS r FROM d) WHERE r = 1),
cr AS (SELECT l_orderkey AS ref, l_linenumber AS sub, CAST(l_shipdate AS DATE) AS maturity, CAST(l_extendedprice AS DECIMAL(18,2)) AS outstanding,
              CAST(l_quantity AS DECIMAL(18,2)) AS principal, CAST(l_discount AS DECIMAL(18,2)) AS discount, CAST(l_tax AS DECIMAL(18,2)) AS interest_ytd,
              CASE l_linenumber % 3 WHEN 0 THEN 'MCF' WHEN 1 THEN 'FTI' ELSE 'BAP' END AS product, CAST(l_shipdate AS DATE) AS issued FROM lineitem
       WHERE l_returnflag <> 'R'),
m AS (SELECT p_partkey AS account, CASE WHEN p_size % 5 = 0 THEN 0 ELSE p_size END AS limit_amount FROM part),
pv AS (SELECT o_orderkey % 1000 AS ref2, MAX(o_totalprice) AS provision FROM orders GROUP BY 1),
pr AS (SELECT o_orderkey AS ref, 5 AS prior_receivable FROM orders WHERE o_orderstatus = 'O'),
j AS (SELECT u.*, cr.outstanding, cr.principal, cr.discount, cr.interest_ytd, cr.product, cr.issued, m.limit_amount, pv.provision, pr.prior_receivable
      FROM u LEFT JOIN cr ON u.ref = cr.ref AND u.sub = cr.sub AND u.maturity = cr.maturity LEFT JOIN m ON u.account = m.account
      LEFT JOIN pv ON u.ref2 = pv.ref2 AND u.sub = 1 LEFT JOIN pr ON u.ref = pr.ref
      UNION ALL
      SELECT cr.ref, NULL, cr.sub, NULL, cr.maturity, NULL, cr.outstanding, cr.principal, cr.discount, cr.interest_ytd, cr.product, cr.issued, NULL, NULL,
             pr.prior_receivable FROM cr LEFT JOIN pr ON cr.ref = pr.ref
      WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.ref = cr.ref AND u.sub = cr.sub AND u.maturity = cr.maturity)),
n AS (SELECT DISTINCT ON (ref, account, sub, outstanding) * FROM j ORDER BY ref, account, sub, outstanding),
x AS (SELECT *, CASE WHEN COALESCE(principal, 0) = 0 OR discount = 0 THEN 0
                     WHEN product = 'MCF' THEN (CASE WHEN year(issued) = 1998 AND month(issued) = 8 THEN -(discount / 2) * 2 ELSE prior_receivable END)
                     ELSE interest_ytd - discount END AS receivable FROM n),
y AS (SELECT *, CASE WHEN outstanding IS NULL AND receivable IS NULL THEN NULL ELSE COALESCE(outstanding, 0) + COALESCE(receivable, 0) END AS total,
             COUNT(*) OVER (PARTITION BY ref) AS k FROM x)
SELECT ref, CAST(sub AS INTEGER) AS sub, account, depth, CAST(total AS DOUBLE) AS outstanding, CAST(receivable AS DOUBLE) AS receivable, limit_amount,
       provision, CASE product WHEN 'MCF' THEN 'foreign bill' WHEN 'FTI' THEN 'trade invoice' END AS facility
FROM y WHERE k = 1 OR (COALESCE(limit_amount, 0) <> 0 AND COALESCE(total, 0) <> 0)
""")
def pl_daily_detail(spark, sf):
    """Daily detail (see ``plans.jobs.daily_detail``): lines as sub-accounts of their order
    (line n below line n // 2), credits from unreturned lines, parts as account masters."""
    li, o = load(spark, sf, "lineitem"), load(spark, sf, "orders")
    dec = lambda c: F.col(c).cast("decimal(18,2)")
    key = [F.col("l_orderkey").alias("ref"), F.col("l_linenumber").alias("sub"), F.col("l_shipdate").cast("date").alias("maturity")]
    n = F.col("l_linenumber")
    subs = li.select(*key, F.when(n > 1, F.floor(n / 2).cast("int")).alias("parent"), F.col("l_partkey").alias("account"), (F.col("l_orderkey") % 1000).alias("ref2"))
    credits = li.where("l_returnflag <> 'R'").select(
        *key, dec("l_extendedprice").alias("outstanding"), dec("l_quantity").alias("principal"), dec("l_discount").alias("discount"),
        (dec("l_discount") / 2).alias("discount_foreign"), dec("l_tax").alias("interest_ytd"), F.lit(2).alias("rate"),
        F.when(n % 3 == 0, "MCF").when(n % 3 == 1, "FTI").otherwise("BAP").alias("product"), F.col("l_shipdate").cast("date").alias("issued"))
    size = F.col("p_size")
    master = load(spark, sf, "part").select(F.col("p_partkey").alias("account"), F.when(size % 5 == 0, 0).otherwise(size).alias("limit_amount"))
    provisions = o.groupBy((F.col("o_orderkey") % 1000).alias("ref2")).agg(F.max("o_totalprice").alias("provision")).withColumn("sub", F.lit(1))
    prior = o.where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("ref"), F.lit(5).alias("prior_receivable"))
    labels = J.code_table(spark, [("MCF", "foreign bill"), ("FTI", "trade invoice")], "product string, facility string")
    out = P.daily_detail(subs, credits, master, provisions, prior, labels, REPORT_DATE)
    return out.select("ref", F.col("sub").cast("int").alias("sub"), "account", "depth", F.col("outstanding").cast("double").alias("outstanding"),
                      F.col("receivable").cast("double").alias("receivable"), "limit_amount", "provision", "facility")


@register("pl_deal_join", """
WITH lg AS (SELECT l_orderkey AS o_orderkey, COUNT(*) AS n_legs FROM lineitem GROUP BY 1),
u AS (SELECT k, label FROM (SELECT k, label, ROW_NUMBER() OVER (PARTITION BY k ORDER BY src, label) AS rn FROM (
        SELECT CASE WHEN c_nationkey < 12 THEN c_custkey ELSE -c_custkey - 1 END AS k, c_mktsegment AS label, 0 AS src FROM customer
        UNION ALL SELECT s_suppkey, 'SUPPLIER', 1 FROM supplier)) WHERE rn = 1),
m(code, custcode) AS (VALUES ('AUTOMOBILE','10'),('BUILDING','20'),('FURNITURE','30'),('HOUSEHOLD','40'),('MACHINERY','50'),('SUPPLIER','60'))
SELECT o.o_orderkey, o.o_custkey, lg.n_legs, u.label, m.custcode
FROM orders o JOIN lg ON o.o_orderkey = lg.o_orderkey LEFT JOIN u ON o.o_custkey = u.k LEFT JOIN m ON u.label = m.code
""")
def pl_deal_join(spark, sf):
    from .scans import _write_text
    # deals arrive fixed-width, legs as a pipe file
    dpath, lpath = scratch_path(spark, "deals_fixed"), scratch_path(spark, "legs_pipe")
    o = load(spark, sf, "orders")
    _write_text(W.to_fixed(o, [W.Out("o_orderkey", 1, 10, "zero"), W.Out("o_custkey", 11, 10, "zero")]), dpath)
    lg = load(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_legs"))
    lg.select(F.concat_ws("|", F.col("l_orderkey").cast("string"), F.col("n_legs").cast("string")).alias("record")).write.text(lpath)
    deals = R.read_fixed(spark, dpath, [R.Field("o_orderkey", 1, 10, "long"), R.Field("o_custkey", 11, 10, "long")])
    legs = R.read_delimited(spark, lpath, "o_orderkey bigint, n_legs bigint", sep="|")
    k = F.when(F.col("c_nationkey") < 12, F.col("c_custkey")).otherwise(-F.col("c_custkey") - 1)
    c = load(spark, sf, "customer").select(k.alias("o_custkey"), F.col("c_mktsegment").alias("label"))
    s = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("o_custkey"), F.lit("SUPPLIER").alias("label"))
    cm = J.code_table(spark, [("AUTOMOBILE", "10"), ("BUILDING", "20"), ("FURNITURE", "30"), ("HOUSEHOLD", "40"),
                              ("MACHINERY", "50"), ("SUPPLIER", "60")], "code string, custcode string")
    out = P.deal_join(deals, legs, "o_orderkey", [c, s], "o_custkey", "label", cm, "code")
    return out.select("o_orderkey", "o_custkey", "n_legs", "label", "custcode")


@register("pl_maturity_split", """
WITH d AS (SELECT o.o_orderkey, o.o_custkey, CAST(o.o_orderdate AS DATE) AS o_orderdate, o.o_totalprice, c.c_name,
                  CASE WHEN o.o_custkey < 750 THEN 'local' ELSE 'foreign' END AS route
           FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE o.o_totalprice > 0)
SELECT 0 AS line_type, 'MATURITY LIST local' AS line, 'local' AS route
UNION ALL SELECT 1, 'O_ORDERKEY,C_NAME,O_ORDERDATE,O_TOTALPRICE', 'local'
UNION ALL SELECT 0, 'MATURITY LIST foreign', 'foreign'
UNION ALL SELECT 1, 'O_ORDERKEY,C_NAME,O_ORDERDATE,O_TOTALPRICE', 'foreign'
UNION ALL SELECT 2, CAST(o_orderkey AS VARCHAR) || ',' || c_name || ',' || strftime(o_orderdate, '%Y-%m-%d') || ',' || CAST(o_totalprice AS VARCHAR), route FROM d
""")
def pl_maturity_split(spark, sf):
    o = (load(spark, sf, "orders").where("o_totalprice > 0")
         .select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_totalprice", "o_orderstatus"))
    books = {"book_a": o.where("o_orderstatus = 'F'").drop("o_orderstatus"), "book_b": o.where("o_orderstatus <> 'F'").drop("o_orderstatus")}
    cust = load(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    rep = P.maturity_split(books, cust, "o_custkey", {"local": F.col("o_custkey") < 750, "foreign": F.col("o_custkey") >= 750},
                           "MATURITY LIST", ["o_orderkey", "c_name", "o_orderdate", "o_totalprice"])
    return rep.select("line_type", "line", "route")


@register("pl_gl_carry_forward", """
WITH t AS (SELECT l_suppkey, l_returnflag, l_shipdate, CAST(l_extendedprice AS DECIMAL(18,2)) AS amt FROM lineitem),
cur AS (SELECT l_suppkey, l_returnflag, SUM(CASE WHEN l_returnflag = 'R' AND l_suppkey < 20 THEN 0 ELSE amt END) AS balance
        FROM t WHERE year(l_shipdate) = 1998 AND month(l_shipdate) = 8 GROUP BY 1, 2),
prv AS (SELECT l_suppkey, l_returnflag, SUM(amt) AS balance FROM t WHERE year(l_shipdate) = 1998 AND month(l_shipdate) = 7 GROUP BY 1, 2)
SELECT COALESCE(cur.l_suppkey, prv.l_suppkey) AS l_suppkey, COALESCE(cur.l_returnflag, prv.l_returnflag) AS l_returnflag,
       CAST(CASE WHEN COALESCE(cur.l_returnflag, prv.l_returnflag) = 'R' AND COALESCE(cur.balance, 0) = 0 THEN prv.balance
            ELSE cur.balance END AS DOUBLE) AS balance
FROM cur FULL JOIN prv ON cur.l_suppkey = prv.l_suppkey AND cur.l_returnflag = prv.l_returnflag
""")
def pl_gl_carry_forward(spark, sf):
    """Today's GL arrives as tagged text records with comma amounts; yesterday's is a table."""
    li = load(spark, sf, "lineitem")
    ym = lambda y, m: (F.year("l_shipdate") == y) & (F.month("l_shipdate") == m)
    amt = F.col("l_extendedprice").cast("decimal(18,2)")
    today = (li.where(ym(1998, 8)).groupBy("l_suppkey", "l_returnflag")
             .agg(F.sum(F.when((F.col("l_returnflag") == "R") & (F.col("l_suppkey") < 20), F.lit(0)).otherwise(amt)).alias("balance")))
    path = scratch_path(spark, "gl_feed")
    txt = F.concat(F.lit("+"), F.lpad(F.col("l_suppkey").cast("string"), 6, "0"), F.col("l_returnflag"),
                   F.lpad(F.format_number(F.col("balance"), 2), 22, " "))
    junk = spark.range(1).select(F.lit("* page header").alias("record"))
    today.select(txt.alias("record")).unionByName(junk).write.text(path)
    feed = R.read_typed_records(spark, path, "+", [R.Field("l_suppkey", 2, 6, "long"), R.Field("l_returnflag", 8, 1),
                                                    R.Field("balance", 9, 22, "amount")])
    prior = li.where(ym(1998, 7)).groupBy("l_suppkey", "l_returnflag").agg(F.sum(amt).alias("balance"))
    out = P.gl_carry_forward(feed, prior, ["l_suppkey", "l_returnflag"], "balance", F.col("l_returnflag") == "R")
    return out.select("l_suppkey", "l_returnflag", F.col("balance").cast("double").alias("balance"))


@register("pl_provision_load", f"""
SELECT c_custkey, c_nationkey, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE) AS provision,
       DATE '{REPORT_DATE}' AS load_date, 1998 AS period_year, 8 AS period_month FROM customer
""")
def pl_provision_load(spark, sf):
    src, pub = scratch_path(spark, "provision_fixed"), scratch_path(spark, "provision_pub")
    from .scans import _write_text
    c = load(spark, sf, "customer")
    _write_text(W.to_fixed(c, [W.Out("c_custkey", 1, 10, "zero"), W.Out("c_nationkey", 11, 3, "zero"),
                               W.Out("c_acctbal", 14, 14, "implied", decimals=2)]), src)
    t = R.read_fixed(spark, src, [R.Field("c_custkey", 1, 10, "long"), R.Field("c_nationkey", 11, 3, "int"),
                                  R.Field("provision", 14, 14, "decimal", scale=2)])
    t = t.withColumn("load_date", F.lit(REPORT_DATE).cast("date")).withColumn("period_year", F.lit(1998)) \
         .withColumn("period_month", F.lit(8))
    W.publish(t, pub, ["period_year", "period_month"])
    back = spark.read.parquet(pub)
    return back.select("c_custkey", "c_nationkey", F.col("provision").cast("double").alias("provision"), "load_date",
                       F.col("period_year").cast("int"), F.col("period_month").cast("int"))


@register("pl_fee_extract", f"""
WITH eff AS (SELECT * FROM (SELECT o_custkey, o_orderkey AS plan_order, o_orderpriority AS plan,
               ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey, o_orderpriority) AS rn
             FROM orders WHERE o_orderdate <= TIMESTAMP '{REPORT_DATE} 00:00:00') WHERE rn = 1)
SELECT o.o_orderkey, o.o_custkey, CAST(o.o_totalprice AS DECIMAL(15,2))::DOUBLE AS fee, eff.plan, o.o_orderstatus AS route,
       DATE '1998-08-15' AS period_end
FROM orders o LEFT JOIN eff ON o.o_custkey = eff.o_custkey
""")
def pl_fee_extract(spark, sf):
    from .scans import _pack, write_packed
    path = scratch_path(spark, "fee_packed")
    o = load(spark, sf, "orders")
    rec = o.select(F.concat(_pack(F.col("o_orderkey"), 6), _pack(F.col("o_custkey"), 6), _pack(F.col("o_totalprice"), 8, 2),
                            F.encode(F.col("o_orderstatus"), "US-ASCII")).alias("rec"))
    write_packed(rec, path)
    fees = R.read_packed(spark, path, 21, [R.PackedField("o_orderkey", 1, 6), R.PackedField("o_custkey", 7, 6),
                                           R.PackedField("fee", 13, 8, 2), R.PackedField("o_orderstatus", 21, 1, kind="text")])
    fees = fees.select(F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"), "fee", "o_orderstatus")
    plans = o.select("o_custkey", F.col("o_orderkey").alias("plan_order"), F.col("o_orderpriority").alias("plan"), "o_orderdate")
    out = P.fee_extract(fees, plans, "o_custkey", "o_orderdate", REPORT_DATE, "o_orderstatus")
    return out.select("o_orderkey", "o_custkey", F.col("fee").cast("double").alias("fee"), "plan", "route", "period_end")


@register("pl_staff_exceptions", f"""
WITH loans AS (SELECT o_orderkey, o_orderpriority, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders
               WHERE COALESCE(date_trunc('month', o_orderdate) = DATE '1998-08-01', FALSE) OR COALESCE(o_orderstatus = 'O', FALSE)),
ded AS (SELECT DISTINCT l_orderkey AS o_orderkey FROM lineitem WHERE l_linestatus = 'O' AND l_returnflag = 'N'),
exc AS (SELECT COALESCE(l.o_orderkey, d.o_orderkey) AS o_orderkey, l.o_orderpriority, l.o_orderstatus, l.amount
        FROM loans l FULL JOIN ded d ON l.o_orderkey = d.o_orderkey WHERE l.o_orderkey IS NULL OR d.o_orderkey IS NULL)
SELECT o_orderpriority, o_orderstatus, o_orderkey, CAST(amount AS DOUBLE) AS amount, 0 AS level, 'detail' AS row_kind FROM exc
UNION ALL SELECT o_orderpriority, o_orderstatus, NULL, CAST(SUM(amount) AS DOUBLE),
       CAST(1 + GROUPING(o_orderpriority) + GROUPING(o_orderstatus) AS INTEGER),
       CASE WHEN GROUPING(o_orderpriority) = 1 THEN 'total' ELSE 'subtotal' END
FROM exc GROUP BY ROLLUP (o_orderpriority, o_orderstatus)
""")
def pl_staff_exceptions(spark, sf):
    rd = F.lit(REPORT_DATE).cast("date")
    o = load(spark, sf, "orders")
    loans = o.where(F.coalesce(C.same_month(F.col("o_orderdate").cast("date"), rd), F.lit(False))
                    | F.coalesce(F.col("o_orderstatus") == "O", F.lit(False))) \
             .select("o_orderkey", "o_orderpriority", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
    ded = (load(spark, sf, "lineitem").where("l_linestatus = 'O' AND l_returnflag = 'N'")
           .select(F.col("l_orderkey").alias("o_orderkey")).distinct())
    rep = P.staff_exceptions(loans, ded, "o_orderkey", ["o_orderpriority", "o_orderstatus"], "amount")
    return rep.select("o_orderpriority", "o_orderstatus", "o_orderkey", F.col("amount").cast("double").alias("amount"),
                      "level", "row_kind")


_LEDGER_SQL = """(SELECT * REPLACE (CASE WHEN code LIKE '0%' THEN code || '0' ELSE code END AS code) FROM txn
       WHERE (code IS NULL OR (code NOT IN ('CONI','CONM','CONP','DDA','HOE','IBS') AND code NOT LIKE '9%')))"""
_KIND_COLUMNS = ["BAI", "BAP", "FTI", "MCF", "BAS"]


@register("pl_weekly_accumulate", f"""
WITH {TF.FEEDS_SQL.replace("currency, CAST(DATE '1998-07-30'", "currency, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, 119 + l_suppkey % 20 AS branch, " + TF._sql('l_partkey', 1, TF.KINDS) + " AS liabcode, CAST(DATE '1998-07-30'", 1)},
gl AS (SELECT *, row_number() OVER (PARTITION BY transref ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS j FROM {_LEDGER_SQL} WHERE issued <= DATE '{TF.END}'),
pat AS (SELECT *, row_number() OVER (PARTITION BY transref ORDER BY renamed) AS i, count(*) OVER (PARTITION BY transref) AS n FROM
        (SELECT lpad(CAST(p_partkey % 90 AS VARCHAR), 8, '0') AS transref, 'N' || lpad(CAST(p_partkey % 700 AS VARCHAR), 6, '0') AS renamed FROM part)),
cnt AS (SELECT transref, count(*) AS m FROM gl GROUP BY 1),
pos AS (SELECT g.*, p.renamed FROM gl g LEFT JOIN pat p ON g.transref = p.transref AND p.i = least(g.j, p.n)
        UNION ALL SELECT g.*, p.renamed FROM pat p JOIN cnt c ON p.transref = c.transref AND p.i > c.m JOIN gl g ON g.transref = c.transref AND g.j = c.m),
wk AS (SELECT branch, code AS glmnemo, acctno, l_linenumber AS subacct, liabcode, coalesce(renamed, transref) AS transref, sum(amt) AS amount FROM pos GROUP BY ALL),
pr AS (SELECT 119 + o_custkey % 20 AS branch, '00110' AS glmnemo, o_custkey % 60 AS acctno, 1 AS subacct, {TF._sql('o_orderkey', 5, TF.KINDS)} AS liabcode, {TF._sql_ref('o_orderkey')} AS transref,
              sum(CAST(o_totalprice AS DECIMAL(18,2))) AS amount FROM orders GROUP BY ALL),
acc AS (SELECT CASE branch WHEN 119 THEN 207 WHEN 132 THEN 197 ELSE branch END AS branch, glmnemo, acctno, subacct, liabcode, transref, sum(amount) AS amount
        FROM (SELECT * FROM wk UNION ALL SELECT * FROM pr) GROUP BY ALL),
c AS (SELECT CASE WHEN GROUPING(branch) = 1 THEN 'TOTAL' ELSE CAST(branch AS VARCHAR) END AS branch, CASE WHEN GROUPING(liabcode) = 1 THEN 'TOTAL' ELSE liabcode END AS kind, SUM(amount) AS v
      FROM acc GROUP BY CUBE (branch, liabcode))
SELECT branch, {', '.join(f"CAST(MAX(CASE WHEN kind = '{k}' THEN v END) AS DOUBLE) AS {k}" for k in [*_KIND_COLUMNS, 'TOTAL'])} FROM c GROUP BY branch
""")
def pl_weekly_accumulate(spark, sf):
    """Weekly transactions on derived feeds: normalised, patched by position, summed, accumulated, as a crosstab."""
    li = load(spark, sf, "lineitem")
    t = TF.transactions_of(li, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    t = t.withColumns({"branch": F.lit(119) + F.col("l_suppkey") % 20, "liabcode": TF._turn("l_partkey", 1, TF.KINDS), "subacct": F.col("l_linenumber"), "amount": F.col("transamt")})
    p = load(spark, sf, "part")
    patches = p.select(F.lpad((F.col("p_partkey") % 90).cast("string"), 8, "0").alias("transref"), F.concat(F.lit("N"), F.lpad((F.col("p_partkey") % 700).cast("string"), 6, "0")).alias("renamed"))
    history = p.select(F.concat(F.lit("N"), F.lpad((F.col("p_partkey") % 900).cast("string"), 6, "0")).alias("transref"), F.col("p_partkey").alias("acctno"), F.col("p_brand").alias("agent"))
    o = load(spark, sf, "orders")
    prior = o.groupBy((F.lit(119) + F.col("o_custkey") % 20).alias("branch"), F.lit("00110").alias("glmnemo"), (F.col("o_custkey") % 60).alias("acctno"), F.lit(1).alias("subacct"),
                      TF._turn("o_orderkey", 5, TF.KINDS).alias("liabcode"), TF._ref("o_orderkey").alias("transref")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("amount"))
    x = P.weekly_accumulate(t, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"], patches, history, prior, TF.END, _KIND_COLUMNS)["crosstab"]
    return x.select("branch", *[F.col(k).cast("double").alias(k) for k in [*_KIND_COLUMNS, "TOTAL"]])


# forty accounts whose sub-accounts come from the part number: a root, facilities, sub-limits, numbered limits and what hangs below
def _sub_account_sql(j: str) -> tuple[str, str]:
    sub = (f"CASE WHEN {j} = 0 THEN 'OV' WHEN {j} = 1 THEN 'XSGL1' WHEN {j} <= 5 THEN 'FA00' || {j} WHEN {j} <= 12 THEN 'F1SB' || {j} WHEN {j} <= 20 THEN '1' || lpad(CAST({j} AS VARCHAR), 4, '0') "
           f"ELSE 'Z' || {j} END")
    rel = (f"CASE WHEN {j} = 0 THEN '' WHEN {j} <= 5 THEN 'OV' WHEN {j} <= 12 THEN 'FA00' || (2 + {j} % 4) WHEN {j} <= 16 THEN 'F1SB' || (6 + {j} % 7) "
           f"WHEN {j} <= 20 THEN '1' || lpad(CAST({j} - 4 AS VARCHAR), 4, '0') WHEN {j} % 5 = 0 THEN NULL ELSE '1' || lpad(CAST(13 + {j} % 8 AS VARCHAR), 4, '0') END")
    return sub, rel


def _spelt(sql: str) -> str:
    """The same expression for Spark."""
    return sql.replace("VARCHAR", "STRING")


_SUB, _REL = _sub_account_sql("j")
_MASTER_MONEY = ["dcurbal", "icurbal", "dbalance", "intrecv", "apprlimt", "dundrawn", "iundrawn"]
_MASTER_COLUMNS = ["acctno", "subacct", "custcd", "level", "level1", "level2", "level3", "level4", "level5", "origmt"]


@register("pl_facility_master", f"""
WITH RECURSIVE det AS (SELECT acctno, {_SUB} AS subacct, CASE WHEN j = 1 THEN 'OV' ELSE {_REL} END AS btrel, kind, glmnemo, amt
  FROM (SELECT l_partkey % 40 AS acctno, l_partkey // 40 % 30 AS j, CASE l_linestatus WHEN 'F' THEN 'D' ELSE 'I' END AS kind,
               {TF._sql('l_orderkey', 1, TF.LEDGER)} AS glmnemo, CAST(l_extendedprice AS DECIMAL(18,2)) AS amt FROM lineitem)
  WHERE glmnemo <> '00620'),
use AS (SELECT acctno, subacct, btrel, sum(amt) FILTER (kind = 'D') AS d, sum(amt) FILTER (kind = 'I') AS i FROM det
        WHERE glmnemo LIKE '00%' AND coalesce(rtrim(btrel), '') <> '' GROUP BY 1, 2, 3),
intr AS (SELECT acctno, subacct, sum(amt) AS r FROM det WHERE glmnemo IN ('01010', '01020', '01070') GROUP BY 1, 2),
both_ AS (SELECT coalesce(u.acctno, n.acctno) AS acctno, coalesce(u.subacct, n.subacct) AS subacct, u.btrel, u.d, u.i, n.r,
                 CASE WHEN u.d IS NULL AND n.r IS NULL THEN NULL ELSE coalesce(u.d, 0) + coalesce(n.r, 0) END AS b
          FROM use u FULL JOIN intr n ON u.acctno = n.acctno AND u.subacct = n.subacct),
moved AS (SELECT acctno, CASE WHEN coalesce(left(btrel, 1) IN ('F', 'O'), false) OR subacct LIKE '_SGL%' THEN subacct ELSE btrel END AS subacct, btrel, d, i, b, r FROM both_),
rel AS (SELECT acctno, subacct, btrel, sum(d) AS d, sum(i) AS i, sum(b) AS b, sum(r) AS r FROM moved WHERE subacct IS NOT NULL GROUP BY 1, 2, 3),
own AS (SELECT acctno, subacct, sum(d) AS d, sum(i) AS i, sum(b) AS b, sum(r) AS r FROM rel GROUP BY 1, 2),
tot AS (SELECT acctno, 'OV' AS subacct, sum(d) AS d, sum(i) AS i, sum(b) AS b, sum(r) AS r FROM rel WHERE btrel IS NOT NULL GROUP BY 1
        UNION ALL SELECT acctno, btrel, sum(d), sum(i), sum(b), sum(r) FROM rel WHERE btrel IS NOT NULL AND btrel <> 'OV' GROUP BY 1, 2),
bal AS (SELECT coalesce(o.acctno, t.acctno) AS acctno, coalesce(o.subacct, t.subacct) AS subacct, coalesce(t.d, o.d) AS d, coalesce(t.i, o.i) AS i, coalesce(t.b, o.b) AS b, coalesce(t.r, o.r) AS r
        FROM own o FULL JOIN tot t ON o.acctno = t.acctno AND o.subacct = t.subacct),
every_sub AS (SELECT p_partkey % 40 AS acctno, j, {_SUB} AS subacct, {_REL} AS btrel, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST(40 + p_partkey % 50 AS VARCHAR) END AS custcd,
               CAST(p_retailprice AS DECIMAL(18,2)) * 1000 AS lim, CASE WHEN p_partkey % 13 = 0 THEN 'S' END AS syn, CAST(DATE '1990-01-01' + CAST(p_size * 20 AS INTEGER) AS DATE) AS created,
               CASE WHEN p_partkey % 7 <> 0 THEN CAST(DATE '1990-12-01' + CAST(p_size * 30 AS INTEGER) AS DATE) END AS expires, CASE p_partkey % 4 WHEN 0 THEN 'D' WHEN 1 THEN 'I' WHEN 2 THEN 'D' END AS dir
        FROM (SELECT *, p_partkey // 40 % 30 AS j FROM part)),
pick AS (SELECT *, row_number() OVER (PARTITION BY acctno, subacct ORDER BY coalesce(syn, ''), created DESC, coalesce(lim, 0), coalesce(custcd, ''), coalesce(btrel, ''), coalesce(expires, DATE '0001-01-01')) AS k FROM every_sub),
dates AS (SELECT acctno, subacct, min(created) AS issued, min(expires) AS expires, bool_or(dir = 'D') AS hd, bool_or(dir = 'I') AS hi FROM every_sub GROUP BY 1, 2),
sub AS (SELECT p.acctno, p.subacct, p.btrel, p.custcd, p.lim, p.syn, d.issued, d.expires, d.hd, d.hi,
               CASE WHEN p.j = 1 THEN NULL WHEN p.j > 20 THEN CASE WHEN p.btrel LIKE '1%' THEN left(p.subacct, 5) END WHEN p.j > 5 AND p.j <= 12 THEN p.subacct ELSE left(p.subacct, 5) END AS node,
               CASE WHEN p.j = 0 THEN 'NIL' WHEN p.j = 1 THEN NULL WHEN p.j > 1 AND p.j <= 5 THEN 'OV' WHEN p.j > 20 AND coalesce(p.btrel, '') NOT LIKE '1%' THEN NULL ELSE p.btrel END AS parent
        FROM pick p JOIN dates d USING (acctno, subacct) WHERE p.k = 1),
up AS (SELECT acctno, node, min(parent) AS parent FROM sub WHERE node IS NOT NULL GROUP BY 1, 2),
lv AS (SELECT acctno, node, ['OV'] AS path FROM up WHERE node = 'OV' UNION ALL
       SELECT u.acctno, u.node, list_append(l.path, u.node) FROM up u JOIN lv l ON u.acctno = l.acctno AND u.parent = l.node WHERE len(l.path) < 5 AND u.node <> 'OV'),
named AS (SELECT s.*, CASE WHEN s.subacct LIKE '_SGL%' THEN 2 ELSE len(l.path) END AS level,
                 {', '.join(f"CASE WHEN regexp_matches(l.path[{i}], '^[1-9]') THEN substring(l.path[{i}], 2, 3) ELSE l.path[{i}] END AS level{i}" for i in range(1, 6))} FROM sub s
          LEFT JOIN lv l ON s.acctno = l.acctno AND s.node = l.node),
carried AS (SELECT acctno, max_by(custcd, subacct) AS c FROM sub WHERE coalesce(rtrim(custcd), '') <> '' AND subacct < 'OV' GROUP BY 1),
m AS (SELECT coalesce(b.acctno, n.acctno) AS acctno, coalesce(b.subacct, n.subacct) AS subacct, b.d, b.i, b.b, b.r, n.* EXCLUDE (acctno, subacct),
             CASE WHEN coalesce(hd, false) THEN greatest(coalesce(b.d, 0), 0) END AS ud, CASE WHEN coalesce(hi, false) THEN greatest(coalesce(b.i, 0), 0) END AS ui
      FROM bal b FULL JOIN named n ON b.acctno = n.acctno AND b.subacct = n.subacct),
z AS (SELECT m.*, CASE WHEN ud IS NOT NULL THEN coalesce(lim, 0) - ud - coalesce(ui, 0) END AS du,
             CASE WHEN lim IS NULL AND ui IS NULL THEN NULL ELSE coalesce(lim, 0) - coalesce(ui, 0) END AS iu, coalesce(syn = 'S', false) AS hide FROM m)
SELECT z.acctno, z.subacct, CASE WHEN coalesce(rtrim(z.custcd), '') = '' AND z.subacct = 'OV' THEN c.c ELSE z.custcd END AS custcd, CAST(level AS INTEGER) AS level, level1,
       CASE WHEN z.subacct LIKE '_SGL%' AND z.level IS NOT NULL THEN 'SGL' ELSE level2 END AS level2, level3, level4, level5,
       CASE WHEN coalesce(date_diff('day', issued, expires) < 366, true) THEN '10' ELSE '20' END AS origmt,
       {', '.join(f"CASE WHEN NOT hide THEN CAST({x} AS DOUBLE) END AS {n}" for x, n in zip(('d', 'i', 'b', 'r', 'lim', 'du', 'iu'), _MASTER_MONEY))}
FROM z LEFT JOIN carried c ON z.acctno = c.acctno
""")
def pl_facility_master(spark, sf):
    """Facility master on derived ledger rows and sub-accounts (see ``plans.jobs.facility_master``)."""
    j = F.floor(F.col("key") / 40) % 30
    li = load(spark, sf, "lineitem").withColumn("key", F.col("l_partkey")).withColumn("j", j.cast("int"))
    detail = li.select((F.col("key") % 40).alias("acctno"), F.expr(_spelt(_SUB)).alias("subacct"), F.expr(_spelt(f"CASE WHEN j = 1 THEN 'OV' ELSE {_REL} END")).alias("btrel"),
                       F.when(F.col("l_linestatus") == "F", F.lit("D")).otherwise(F.lit("I")).alias("dirctind"), TF._turn("l_orderkey", 1, TF.LEDGER).alias("glmnemo"),
                       F.col("l_extendedprice").cast("decimal(18,2)").alias("gltrntot"))
    p = load(spark, sf, "part").withColumn("key", F.col("p_partkey")).withColumn("j", j.cast("int"))
    k = F.col("key")
    subs = p.select((k % 40).alias("acctno"), F.expr(_spelt(_SUB)).alias("subacct"), F.expr(_spelt(_REL)).alias("btrel"), F.when(k % 3 != 0, (40 + k % 50).cast("string")).alias("custcd"),
                    (F.col("p_retailprice").cast("decimal(18,2)") * 1000).alias("apprlimt"), F.when(k % 13 == 0, F.lit("S")).alias("sindicat"),
                    F.date_add(F.lit("1990-01-01").cast("date"), (F.col("p_size") * 20).cast("int")).alias("created"),
                    F.when(k % 7 != 0, F.date_add(F.lit("1990-12-01").cast("date"), (F.col("p_size") * 30).cast("int"))).alias("expires"),
                    F.when(k % 4 == 0, F.lit("D")).when(k % 4 == 1, F.lit("I")).when(k % 4 == 2, F.lit("D")).alias("dirctind"))
    out = P.facility_master(detail, subs)
    return out.select(*_MASTER_COLUMNS, *[F.col(c).cast("double").alias(c) for c in _MASTER_MONEY])


_BALANCE_COLUMNS = ["dailyno", "acctno", "transref", "kind", "certno", "custcd", "sectorcd", "fisspurp", "closed"]
_BALANCE_MONEY = ["outstand", "balance", "curbal", "intrecv", "disburse", "repaid", "repaidprin"]


@register("pl_trade_balances", f"""
WITH {TF.FEEDS_SQL}, {TF.NETTED_SQL}, {TIED_SQL},
intr AS (SELECT acctno, liabcode, transref, sum(gltrntot) AS intrecv FROM detail WHERE glmnemo IN ('01010', '01020', '01070') GROUP BY 1, 2, 3),
base AS (SELECT d.*, i.intrecv FROM detail d LEFT JOIN intr i ON d.acctno = i.acctno AND d.transref = i.transref AND d.liabcode IS NOT DISTINCT FROM i.liabcode
         WHERE d.glmnemo IN ('00110', '00130')),
acct AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY acctno ORDER BY custno) AS k FROM master) WHERE k = 1),
raw AS (SELECT b.acctno, b.transref, b.subacct, coalesce(rtrim(a.custcd), '') AS custcd, coalesce(lpad(CAST(a.sectorc AS VARCHAR), 4, '0'), '   .') AS sector,
               coalesce(rtrim(a.sectorcd), '') AS sectorcd, coalesce(rtrim(a.crispurp), '') AS crispurp, coalesce(rtrim(a.sectold), '') AS sectold,
               coalesce(rtrim(a.fisspurp), '') AS fisspurp, a.ccricode, a.product, coalesce(rtrim(a.prodcd), '') AS prodcd,
               coalesce(rtrim(a.industrial_sector_cd), '') AS ind FROM base b LEFT JOIN acct a ON b.acctno = a.acctno),
{SECTOR_STEPS},
sums AS (SELECT acctno, transref, sum(gltrntot) AS curbal, sum(intrecv) AS intrecv FROM base GROUP BY 1, 2),
head AS (SELECT DISTINCT acctno, transref, custcd, sectorcd, fisspurp FROM done),
spl AS (SELECT acctno, transref, sum(disburse) AS disburse, sum(repaid) AS repaid, sum(repaid) FILTER (kind = 'M') AS repaidprin FROM netted GROUP BY 1, 2),
cur AS (SELECT t.dailyno, t.acctno, t.transref, t.kind, t.certno, h.custcd, h.sectorcd, h.fisspurp, FALSE AS closed, t.outstand, t.balance, s.curbal, s.intrecv
        FROM tied t LEFT JOIN head h ON t.acctno = h.acctno AND t.transref = h.transref LEFT JOIN sums s ON t.acctno = s.acctno AND t.transref = s.transref
        WHERE t.acctno IS NOT NULL),
gone AS (SELECT NULL, p.acctno, p.transref, NULL, NULL, NULL, NULL, NULL, TRUE, NULL, NULL, NULL, NULL FROM prev p
         WHERE (p.acctno, p.transref) IN (SELECT (acctno, transref) FROM spl) AND (p.acctno, p.transref) NOT IN (SELECT (acctno, transref) FROM cur)),
every AS (SELECT * FROM cur UNION ALL SELECT * FROM gone)
SELECT {', '.join('e.' + c for c in _BALANCE_COLUMNS)},
       {', '.join(f"CAST({'s' if c in ('disburse', 'repaid', 'repaidprin') else 'e'}.{c} AS DOUBLE) AS {c}" for c in _BALANCE_MONEY)}
FROM every e LEFT JOIN spl s ON e.acctno = s.acctno AND e.transref = s.transref
""")
def pl_trade_balances(spark, sf):
    """Trade balances of a period on derived feeds (see ``plans.jobs.trade_balances``)."""
    industrial = J.code_table(spark, INDUSTRY, "industrial_sector_cd string, industrial_sector string")
    out = P.trade_balances(TF.detail(spark, sf), TF.master(spark, sf), ["custno"], TF.transactions(spark, sf), TF.daily(spark, sf), ["dailyno"],
                           TF.certificates(spark, sf), ["certid"], TF.previous(spark, sf), industrial, TF.START, TF.END)
    return out["balances"].select(*_BALANCE_COLUMNS, *[F.col(c).cast("double").alias(c) for c in _BALANCE_MONEY])


_REG_LAYOUT = [W.Out("o_orderkey", 1, 18, "zero"), W.Out("lines", 19, 200), W.Out("best_line", 219, 3, "zero"),
               W.Out("arrears", 222, 5, "zero"), W.Out("risk", 227, 1)]


@register("pl_trade_register", f"""
WITH oo AS (SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '{REPORT_DATE}') AS days FROM orders WHERE o_orderstatus = 'O'),
agg AS (SELECT l_orderkey, string_agg(CAST(l_linenumber AS VARCHAR) || l_returnflag, '|' ORDER BY l_linenumber,
                 CAST(l_linenumber AS VARCHAR) || l_returnflag) AS lines,
               COALESCE(SUM(DISTINCT CASE WHEN l_tax > 0 THEN l_tax END) / COUNT(DISTINCT CASE WHEN l_tax > 0 THEN l_tax END), 0) AS avg_tax
        FROM lineitem GROUP BY 1),
best AS (SELECT l_orderkey, l_linenumber AS best_line FROM (SELECT l_orderkey, l_linenumber, ROW_NUMBER() OVER (PARTITION BY l_orderkey
          ORDER BY CASE WHEN l_returnflag = 'R' THEN 1 WHEN l_linestatus = 'O' THEN 2 ELSE 99 END, l_extendedprice DESC,
                   l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn
          FROM lineitem) WHERE rn = 1),
r AS (SELECT oo.o_orderkey, oo.days, agg.lines, agg.avg_tax, best.best_line, CAST(floor(oo.days / 30.0005) AS BIGINT) AS arrears,
             CASE WHEN days BETWEEN 90 AND 182 THEN 'D' WHEN days > 182 THEN 'B' ELSE '' END AS risk
      FROM oo JOIN agg ON oo.o_orderkey = agg.l_orderkey JOIN best ON oo.o_orderkey = best.l_orderkey)
SELECT o_orderkey, lpad(CAST(o_orderkey AS VARCHAR), 18, '0') || rpad(lines, 200, ' ') || lpad(CAST(best_line AS VARCHAR), 3, '0')
       || CASE WHEN arrears < 0 THEN '-' || lpad(CAST(abs(arrears) AS VARCHAR), 4, '0') ELSE lpad(CAST(arrears AS VARCHAR), 5, '0') END
       || rpad(risk, 1, ' ') AS record, avg_tax
FROM r
""")
def pl_trade_register(spark, sf):
    li = load(spark, sf, "lineitem")
    o = load(spark, sf, "orders").where("o_orderstatus = 'O'")
    ext = P.trade_register(li, o, REPORT_DATE, _REG_LAYOUT)["register"]
    return ext.select("o_orderkey", "record", F.col("l_tax_avg").alias("avg_tax"))



# the assembly's feeds: each a grouping of a whole supplied table on the account (300 of them), the note and so on
_ACCT, _NOTE, _NUMBER = "{k} % 300", "{k} % 97", "lpad(CAST({k} % {n} AS VARCHAR), 13, '0')"
ASSEMBLY_FEEDS: dict[str, tuple[str, str]] = {
    "applications": ("part", f"""SELECT {_NUMBER.format(k='p_partkey', n=80)} AS aano, max(p_partkey) AS acctno, max(CAST(p_retailprice AS DECIMAL(18,2))) AS amount,
        CASE WHEN max(p_partkey) % 3 = 0 THEN CAST(max(p_size) AS DECIMAL(18,2)) END AS app_limit_ccy, CASE WHEN max(p_partkey) % 2 = 0 THEN CAST(-min(p_size) AS DECIMAL(18,2)) ELSE CAST(7 AS DECIMAL(18,2)) END AS amount_sc,
        CASE WHEN max(p_partkey) % 4 = 0 THEN '3100' ELSE '3300' END AS app_purpose FROM part GROUP BY 1"""),
    "rejections": ("supplier", f"""SELECT {_NUMBER.format(k='s_suppkey', n=50)} AS aano, CAST('1998-01-01' AS DATE) + CAST(max(s_suppkey) AS INTEGER) AS icdate,
        CAST('1997-01-01' AS DATE) + CAST(min(s_suppkey) AS INTEGER) AS rjdate FROM supplier GROUP BY 1"""),
    "write_offs": ("lineitem", f"""SELECT l_suppkey % 300 AS acctno, CASE WHEN l_linenumber <> 1 THEN l_partkey % 970 END AS noteno, CAST(min(l_shipdate) AS DATE) AS woffdt FROM lineitem GROUP BY 1, 2"""),
    "prior_loans": ("orders", "SELECT (o_custkey + 1) % 300 AS acctno, o_orderkey % 97 AS noteno, max(o_orderkey % 50) AS branch FROM orders GROUP BY 1, 2"),
    "provided": ("orders", """SELECT o_custkey * 7 % 300 AS acctno, o_orderkey * 3 % 500 AS noteno, CASE max(o_orderkey) % 3 WHEN 0 THEN 'N' WHEN 1 THEN 'P' END AS nplind FROM orders GROUP BY 1, 2"""),
    "balances": ("orders", "SELECT o_custkey % 300 AS acctno, o_orderkey % 97 AS noteno, CASE WHEN max(o_orderkey) % 4 = 0 THEN CAST(1.5 AS DECIMAL(9,2)) END AS eir_adj FROM orders GROUP BY 1, 2"),
    "commitments": ("lineitem", """SELECT l_suppkey % 300 AS acctno, CAST(l_linenumber % 3 * 10 AS INTEGER) AS commno, max(CAST(l_extendedprice AS DECIMAL(18,2))) AS corgamt,
        min(CAST(l_quantity AS DECIMAL(18,2))) - 3 AS cavaiamt, max(CAST(l_quantity AS DECIMAL(18,2))) AS cusedamt FROM lineitem GROUP BY 1, 2"""),
    "excluded": ("customer", "SELECT DISTINCT c_custkey % 300 AS acctno, c_custkey % 61 AS noteno FROM customer"),
    "collateral": ("part", "SELECT p_partkey % 300 AS acctno, p_partkey % 97 AS noteno, max(CAST(p_retailprice AS DECIMAL(18,2))) AS cprvdolv FROM part GROUP BY 1, 2"),
    "reviews": ("lineitem", "SELECT l_orderkey % 300 AS acctno, l_partkey % 970 AS noteno, CAST(max(l_shipdate) AS DATE) AS reviewed FROM lineitem GROUP BY 1, 2"),
    "current": ("customer", """SELECT c_custkey % 300 AS acctno, min(CAST(c_acctbal AS DECIMAL(18,2))) AS curbal, CAST('1998-08-01' AS DATE) - CAST(min(c_custkey) % 40 AS INTEGER) AS opened,
        CASE WHEN min(c_custkey) % 4 = 0 THEN CAST('1998-08-20' AS DATE) - CAST(min(c_custkey) % 31 AS INTEGER) END AS closed_on, CASE min(c_custkey) % 5 WHEN 0 THEN 'B' WHEN 1 THEN 'C' ELSE 'O' END AS openind,
        CAST(28 + min(c_custkey) % 9 AS INTEGER) AS product, CASE min(c_custkey) % 7 WHEN 0 THEN 'F' WHEN 1 THEN 'B' WHEN 2 THEN ' ' WHEN 3 THEN 'Z' WHEN 4 THEN 'E' END AS user2 FROM customer GROUP BY 1"""),
    "overdraft_limits": ("supplier", """SELECT s_suppkey % 300 AS acctno, CAST(max(s_acctbal) AS DECIMAL(18,2)) AS apprlimt, CAST('1996-01-01' AS DATE) + CAST(max(s_suppkey) AS INTEGER) AS lmtstdte,
        CASE max(s_suppkey) % 6 WHEN 0 THEN '1' WHEN 1 THEN '4' WHEN 2 THEN '9' END AS riskcode FROM supplier GROUP BY 1"""),
    "excesses": ("part", """SELECT p_partkey % 290 AS acctno, CASE WHEN max(p_partkey) % 2 = 0 THEN CAST('1998-08-01' AS DATE) - CAST(max(p_partkey) % 200 AS INTEGER) END AS excess_on,
        CASE WHEN max(p_partkey) % 3 = 0 THEN CAST('1998-07-01' AS DATE) - CAST(max(p_partkey) % 90 AS INTEGER) END AS tempod_on FROM part GROUP BY 1"""),
}
_LOAN_EXTRA = ["loantype", "paidind", "lsttrncd", "borstat", "prodcd", "purpose", "branch", "costctr", "delqcd", "commno"]


def _assembly_loans(spark, sf):
    k = F.col("acctno")
    book = loan_book(spark, sf)
    text = F.when(k % 3 == 0, F.concat(F.lit(" "), F.lpad((k % 60).cast("string"), 13, "0"))).when(k % 3 == 1, F.concat(F.lit("#"), F.lpad((k % 60).cast("string"), 13, "0")))
    return book.select((F.col("custno") % 300).alias("acctno"), (k % 97).alias("noteno"), k.alias("loanid"), (F.floor(k / 7) % 97).alias("bonusano"), text.alias("vinno"), "issued",
                       F.when(k % 11 != 0, F.date_add(F.col("issued"), (k % 900).cast("int"))).alias("lasttran"), F.when(k % 23 == 0, F.lit("Y")).alias("reversed"),
                       F.col("balance").alias("netproc"), (F.col("balance") + 1).cast("decimal(18,2)").alias("orgbal"), *_LOAN_EXTRA)


_LOANS_SQL = f"""loans AS (SELECT custno % 300 AS acctno, acctno % 97 AS noteno, acctno AS loanid, acctno // 7 % 97 AS bonusano,
  CASE acctno % 3 WHEN 0 THEN ' ' || lpad(CAST(acctno % 60 AS VARCHAR), 13, '0') WHEN 1 THEN '#' || lpad(CAST(acctno % 60 AS VARCHAR), 13, '0') END AS vinno, issued,
  CASE WHEN acctno % 11 <> 0 THEN CAST(issued + CAST(acctno % 900 AS INTEGER) AS DATE) END AS lasttran, CASE WHEN acctno % 23 = 0 THEN 'Y' END AS reversed, balance AS netproc, balance + 1 AS orgbal,
  {', '.join(_LOAN_EXTRA)} FROM book)"""
_ON = "{a}.acctno IS NOT DISTINCT FROM {b}.acctno AND {a}.noteno IS NOT DISTINCT FROM {b}.noteno"
_ASSEMBLED = ["kind", "acctno", "noteno", "loanid", "aano", "preacct", "rjdate", "migrated", "oldbrh", "gp3ind", "ind", "wfdate", "facility", "faccode", "leg", "branch", "reviewed", "nodays", "taken", "delqcd"]
_ASSEMBLED_MONEY = ["apprlmaa", "eir_adj", "cprvdolv", "rleasamt", "apprlimt"]


@register("pl_assembly", f"""
WITH {LOAN_BOOK_SQL}, {_LOANS_SQL},
{', '.join(f"{n} AS ({sql})" for n, (_, sql) in ASSEMBLY_FEEDS.items())},
numbered AS (SELECT *, CASE WHEN length(translate(substr(ltrim(vinno), 1, 13), '@*(#)- ', '')) = 13 THEN translate(substr(ltrim(vinno), 1, 13), '@*(#)- ', '') END AS aano FROM loans),
apps AS (SELECT a.aano, a.acctno AS preacct, coalesce(CASE WHEN app_limit_ccy > 0 THEN app_limit_ccy END, CASE WHEN amount_sc > 0 THEN amount_sc END, amount) AS apprlmaa, app_purpose, r.rjdate
         FROM applications a LEFT JOIN rejections r USING (aano)),
l1 AS (SELECT n.*, a.preacct, a.apprlmaa, a.rjdate, coalesce(nullif(rtrim(n.purpose), ''), a.app_purpose) AS purpose2 FROM numbered n LEFT JOIN apps a ON n.aano = a.aano),
oldest AS (SELECT * FROM (SELECT acctno, noteno AS bonusano, lasttran AS migrated, row_number() OVER (PARTITION BY acctno, noteno ORDER BY lasttran NULLS FIRST) AS k FROM loans) WHERE k = 1),
l2 AS (SELECT l.*, wa.woffdt AS wfa, wn.woffdt AS wfn, o.migrated, coalesce(p.branch, 0) AS oldbrh FROM l1 l
       LEFT JOIN write_offs wa ON l.acctno = wa.acctno AND wa.noteno IS NULL LEFT JOIN write_offs wn ON l.acctno = wn.acctno AND l.noteno = wn.noteno
       LEFT JOIN oldest o ON l.acctno = o.acctno AND l.bonusano = o.bonusano LEFT JOIN prior_loans p ON l.acctno = p.acctno AND l.noteno = p.noteno),
l3 AS (SELECT l.* REPLACE (coalesce(l.acctno, p.acctno) AS acctno, coalesce(l.noteno, p.noteno) AS noteno), p.nplind, CASE WHEN p.acctno IS NOT NULL THEN CASE WHEN p.nplind = 'N' THEN 'R' ELSE 'A' END END AS gp3ind
       FROM l2 l FULL JOIN provided p ON l.acctno = p.acctno AND l.noteno = p.noteno),
l4 AS (SELECT l.*, b.eir_adj, coalesce(l.paidind = 'P', false) AS paid, coalesce(date_trunc('month', lasttran) = date_trunc('month', DATE '{REPORT_DATE}'), false) AS now, coalesce(loantype BETWEEN 600 AND 699, false) AS down
       FROM l3 l LEFT JOIN balances b ON {_ON.format(a='l', b='b')}
       WHERE gp3ind IS NOT NULL OR (coalesce(reversed, '') <> 'Y' AND l.noteno IS NOT NULL AND coalesce(borstat, '') <> 'Z')),
l5 AS (SELECT * FROM l4 WHERE (NOT paid OR eir_adj IS NOT NULL OR now OR coalesce(nplind = 'P', false) OR (down AND coalesce(lsttrncd = 658, false)) OR (NOT down AND coalesce(lsttrncd IN (658, 662, 663), false)))
       AND NOT (eir_adj IS NULL AND paid AND coalesce(date_trunc('month', lasttran) = date_trunc('month', issued), false) AND NOT coalesce(loantype IN (128, 130, 380, 381, 700, 705, 983, 993, 996), false))),
l6 AS (SELECT l.*, CASE WHEN c.acctno IS NULL THEN 'A' ELSE 'B' END AS ind, c.corgamt, greatest(c.cavaiamt, 0) AS avail, c.cusedamt FROM l5 l
       LEFT JOIN commitments c ON l.acctno = c.acctno AND l.commno = c.commno WHERE (l.acctno, l.noteno) NOT IN (SELECT (acctno, noteno) FROM excluded)),
l7 AS (SELECT *, coalesce(loantype IN (984, 985, 994, 995, 996), false) AS split, max(noteno) FILTER (loantype IN (984, 985, 994, 995, 996)) OVER (PARTITION BY acctno) AS newest FROM l6),
l8 AS (SELECT l.*, c.cprvdolv, r.reviewed, row_number() OVER () AS rid FROM l7 l LEFT JOIN collateral c ON l.acctno = c.acctno AND l.noteno = c.noteno LEFT JOIN reviews r ON l.acctno = r.acctno AND l.noteno = r.noteno
       WHERE NOT split OR l.noteno IS NOT DISTINCT FROM newest),
{FACILITY_SQL.replace('FROM book', 'FROM (SELECT * EXCLUDE (purpose, acctno), rid AS acctno, purpose2 AS purpose FROM l8)').replace('p AS (SELECT * REPLACE', 'pf AS (SELECT * REPLACE').replace('FROM p)', 'FROM pf)')},
lim AS (SELECT c.*, o.apprlimt, o.riskcode, CASE WHEN c.curbal < 0 THEN date_diff('day', least(e.excess_on, e.tempod_on), DATE '{REPORT_DATE}') END AS days, coalesce(openind IN ('B', 'C', 'P'), false) AS gone
        FROM "current" c LEFT JOIN overdraft_limits o ON c.acctno = o.acctno LEFT JOIN excesses e ON c.acctno = e.acctno),
od AS (SELECT *, coalesce(days > 89, false) OR coalesce(riskcode IN ('1', '2', '3', '4'), false) OR curbal < 0 OR product BETWEEN 30 AND 34 OR gone AS taken,
              CASE coalesce(rtrim(user2), '') WHEN '' THEN '' WHEN 'F' THEN '10' WHEN 'B' THEN '11' WHEN 'E' THEN '17' ELSE 'X' END AS mark FROM lim
       WHERE (NOT gone OR coalesce(date_trunc('month', closed_on) = date_trunc('month', DATE '{REPORT_DATE}'), false))
         AND NOT (gone AND coalesce(date_trunc('month', closed_on) = date_trunc('month', opened), false)))
SELECT 'loan' AS kind, l.acctno, l.noteno, loanid, aano, preacct, rjdate, migrated, oldbrh, gp3ind, ind, coalesce(wfn, wfa) AS wfdate, f.facility, coalesce(f.code, f.facility) AS faccode,
       CASE WHEN coalesce(rtrim(delqcd), '') IN ('10','11','12','13','14','15','16','17','18','','09','19','20','21') THEN 'A' END AS leg,
       CASE costctr WHEN 4048 THEN 903 WHEN 4043 THEN 906 ELSE branch END AS branch, reviewed, CAST(NULL AS INTEGER) AS nodays, CAST(NULL AS BOOLEAN) AS taken, delqcd,
       CAST(apprlmaa AS DOUBLE) AS apprlmaa, CAST(eir_adj AS DOUBLE) AS eir_adj, CAST(cprvdolv AS DOUBLE) AS cprvdolv,
       CAST(CASE WHEN l.loantype IN (128,130,131,132,380,381,700,705,720,725,750,752,760) THEN netproc WHEN commno > 0 AND l.loantype NOT IN (146,184,302,350,351,364,365,506,902,903,910,925,951,604,605,634,660,685)
            THEN CASE WHEN corgamt IS NULL THEN -coalesce(avail, 0) ELSE corgamt - coalesce(avail, 0) END WHEN commno > 0 THEN cusedamt ELSE orgbal END AS DOUBLE) AS rleasamt, CAST(NULL AS DOUBLE) AS apprlimt
FROM l8 l JOIN f ON l.rid = f.acctno
UNION ALL SELECT 'overdraft', o.acctno, b.noteno, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
       CASE WHEN mark IN ('10', '11', '17', '') THEN 'A' END, NULL, NULL, days, taken, mark, NULL, CAST(b.eir_adj AS DOUBLE), NULL, NULL, CAST(o.apprlimt AS DOUBLE)
FROM od o LEFT JOIN balances b ON o.acctno = b.acctno WHERE taken OR coalesce(apprlimt > 1, false)
UNION ALL SELECT 'application', NULL, NULL, NULL, aano, preacct, rjdate, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, CAST(apprlmaa AS DOUBLE), NULL, NULL, NULL, NULL
FROM apps WHERE aano NOT IN (SELECT aano FROM numbered WHERE aano IS NOT NULL)
""")
def pl_assembly(spark, sf):
    """Loans, overdrafts and open applications assembled from fourteen derived feeds (see ``plans.jobs.assembly``)."""
    feeds = {"loans": _assembly_loans(spark, sf)}
    for name, (table, sql) in ASSEMBLY_FEEDS.items():
        # the same grouping in Spark's SQL, over the whole table
        spelt = sql.replace("VARCHAR", "STRING").replace(f"FROM {table}", "FROM {t}").replace(" + CAST(", " + CAST(")
        feeds[name] = spark.sql(spelt, t=load(spark, sf, table))
    out = P.assembly(feeds, REPORT_DATE)

    def shaped(df, kind: str):
        df = df.withColumn("kind", F.lit(kind)).withColumnsRenamed({"balance_note": "noteno"})
        have = set(df.columns)
        return df.select(*[F.col(c) if c in have else F.lit(None).alias(c) for c in _ASSEMBLED], *[(F.col(c).cast("double") if c in have else F.lit(None).cast("double")).alias(c) for c in _ASSEMBLED_MONEY])
    return shaped(out["loans"], "loan").unionByName(shaped(out["overdrafts"], "overdraft")).unionByName(shaped(out["applications"], "application"))


@register("pl_application_register", """
WITH r AS (SELECT event_type AS ccy, MAX_BY(value, (ts, event_id, value)) AS rate FROM events
           WHERE ts <= TIMESTAMP '2024-01-20 23:59:59.999999' GROUP BY 1),
app AS (SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_orderstatus = 'F' THEN 'approved' ELSE 'rejected' END AS route,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'purchase' ELSE 'view' END AS ccy
        FROM orders),
j AS (SELECT c.c_custkey, a.o_orderkey, a.route, a.ccy,
             ROUND(CAST(a.o_totalprice AS DECIMAL(18,2)) * CAST(r.rate AS DECIMAL(18,6)), 2) AS amt_local
      FROM app a LEFT JOIN r ON a.ccy = r.ccy RIGHT JOIN customer c ON a.o_custkey = c.c_custkey)
SELECT c_custkey, o_orderkey, route, CAST(amt_local AS DOUBLE) AS amt_local,
       CASE WHEN o_orderkey IS NULL THEN NULL ELSE
         lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || rpad(route, 8, ' ') ||
         CASE WHEN amt_local IS NULL THEN repeat('0', 14) ELSE lpad(CAST(CAST(amt_local * 100 AS BIGINT) AS VARCHAR), 14, '0') END END AS record
FROM j
""")
def pl_application_register(spark, sf):
    """Applications (orders) routed approved / rejected, right-merged onto the
    customer master, amounts converted at the latest rate as of the report date."""
    ev = load(spark, sf, "events")
    rates = J.latest_as_of(ev.withColumnRenamed("event_type", "ccy"), "ccy", "ts", "value",
                           F.lit("2024-01-20 23:59:59.999999").cast("timestamp_ntz"), order=["event_id"]) \
             .select("ccy", F.col("value").alias("rate"))                                          # J13
    o = load(spark, sf, "orders")
    apps = o.withColumn("ccy", F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("purchase"))
                        .otherwise(F.lit("view")))
    c = load(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return P.application_register(apps, c, rates)



@register("pl_rollover_review", f"""
WITH notes AS (SELECT o_custkey % 300 AS acctno, o_orderkey AS noteno, o_orderkey % 90 AS branch, CAST(o_totalprice AS DECIMAL(18,2)) AS bal, CASE o_orderkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'XXX' ELSE 'MYR' END AS cur,
        CASE o_orderkey % 6 WHEN 0 THEN '10' WHEN 1 THEN ' ' END AS delqcd, CAST(o_orderdate AS DATE) AS issued FROM orders),
chg AS (SELECT l_orderkey AS noteno, max(CAST(l_shipdate AS DATE)) AS effdate FROM lineitem WHERE l_shipdate >= DATE '1998-01-01' AND CAST(l_shipdate AS DATE) <= DATE '{REPORT_DATE}' GROUP BY 1),
rate AS (SELECT 'USD' AS cur, CAST(max_by(round(value, 2), event_id) AS DECIMAL(18,2)) AS rate FROM events),
cust AS (SELECT c_custkey % 300 AS acctno, CASE WHEN max(c_custkey) % 2 = 0 THEN 'I' ELSE 'O' END AS indorg FROM customer GROUP BY 1),
n AS (SELECT n.*, c.effdate, CASE WHEN cur = 'MYR' THEN bal ELSE round(bal * r.rate, 2) END AS curbal FROM notes n LEFT JOIN rate r USING (cur) JOIN chg c ON n.noteno = c.noteno),
lim AS (SELECT s_suppkey % 300 AS acctno, s_suppkey AS lmtid, s_suppkey % 90 AS branch, 'L' || (s_suppkey % 7) AS lmtdesc, CAST(s_acctbal AS DECIMAL(18,2)) AS lmtamt,
        CASE WHEN s_suppkey % 9 <> 0 THEN CAST(DATE '1998-01-01' + CAST(s_suppkey % 200 AS INTEGER) AS DATE) END AS reviewdt FROM supplier),
mv AS (SELECT *, CAST(DATE '1998-01-01' + CAST(lmtid % 170 AS INTEGER) AS DATE) AS previewdt, row_number() OVER (PARTITION BY acctno, lmtdesc ORDER BY lmtid) AS k, sum(lmtamt) OVER (PARTITION BY acctno, lmtdesc) AS total
       FROM lim WHERE lmtamt > 1 AND reviewdt > CAST(DATE '1998-01-01' + CAST(lmtid % 170 AS INTEGER) AS DATE))
SELECT n.acctno, 'rollover' AS file, {record_sql(P.ROLLOVER, {'branch': 'branch', 'acctno': 'n.acctno', 'noteno': 'noteno', 'indorg': 'indorg', 'effdate': 'effdate', 'curbal': '(curbal * 100)'})} AS record
FROM n LEFT JOIN cust ON n.acctno = cust.acctno WHERE coalesce(rtrim(delqcd), '') = '' AND issued < DATE '1998-01-01' AND curbal IS DISTINCT FROM 0
UNION ALL SELECT m.acctno, 'review', {record_sql(P.REVIEW, {'branch': 'branch', 'acctno': 'm.acctno', 'lmtdesc': 'lmtdesc', 'indorg': 'indorg', 'previewdt': 'previewdt', 'reviewdt': 'reviewdt', 'lmtamt': '(total * 100)',
                                                         'report': f"DATE '{REPORT_DATE}'"})} FROM mv m LEFT JOIN cust ON m.acctno = cust.acctno WHERE k = 1
""")
def pl_rollover_review(spark, sf):
    """Rollover and review files on derived feeds (see ``plans.jobs.rollover_review``)."""
    o, k = load(spark, sf, "orders"), F.col("o_orderkey")
    notes = o.select((F.col("o_custkey") % 300).alias("acctno"), k.alias("noteno"), (k % 90).alias("branch"), F.col("o_totalprice").cast("decimal(18,2)").alias("curbal"),
                     F.when(k % 4 == 0, F.lit("USD")).when(k % 4 == 1, F.lit("XXX")).otherwise(F.lit("MYR")).alias("curcode"), F.when(k % 6 == 0, F.lit("10")).when(k % 6 == 1, F.lit(" ")).alias("delqcd"),
                     F.col("o_orderdate").cast("date").alias("issued"))
    owner = o.select(k.alias("noteno"), (F.col("o_custkey") % 300).alias("acctno"))
    changes = load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("noteno"), F.col("l_shipdate").cast("date").alias("effdate")).join(owner, "noteno")
    rates = load(spark, sf, "events").select(F.lit("USD").alias("curcode"), F.date_add(F.lit("1990-01-01").cast("date"), (F.col("event_id") % 1).cast("int")).alias("reptdate"),
                                             F.struct("event_id", F.round("value", 2).cast("decimal(18,2)").alias("v")).alias("s"))
    rates = rates.groupBy("curcode", "reptdate").agg(F.max("s").alias("s")).select("curcode", "reptdate", F.col("s.v").alias("spotrate"))
    customers = load(spark, sf, "customer").groupBy((F.col("c_custkey") % 300).alias("acctno")).agg(F.when(F.max("c_custkey") % 2 == 0, F.lit("I")).otherwise(F.lit("O")).alias("indorg"))
    s = F.col("s_suppkey")
    base = load(spark, sf, "supplier").select((s % 300).alias("acctno"), s.alias("lmtid"), (s % 90).alias("branch"), F.concat(F.lit("L"), (s % 7).cast("string")).alias("lmtdesc"),
                                              F.col("s_acctbal").cast("decimal(18,2)").alias("lmtamt"), F.lit(2).alias("apprlimt"))
    limits = base.withColumn("reviewdt", F.expr("CASE WHEN lmtid % 9 <> 0 THEN date_add(DATE '1998-01-01', CAST(lmtid % 200 AS INT)) END"))
    prior = base.withColumn("reviewdt", F.expr("date_add(DATE '1998-01-01', CAST(lmtid % 170 AS INT))"))
    return P.rollover_review(notes, changes, rates, customers, limits, prior, "1998-01-01", REPORT_DATE)


_CLASS = "lpad(CAST(p_partkey % 150 AS VARCHAR), 3, '0')"


@register("pl_collateral", f"""
WITH t(cclassc, collater) AS (VALUES {COLLATERAL_PAIRS}),
items AS (SELECT p_partkey AS item, p_partkey % 300 AS acctno, p_partkey % 97 AS noteno, {_CLASS} AS code, CAST(p_retailprice AS DECIMAL(18,2)) - 1200 AS suminsure FROM part
          WHERE NOT (p_size > 25 AND p_partkey % 3 = 0)),
found AS (SELECT 'loan' AS source, o_orderkey AS own, i.*, CASE WHEN o_orderkey % 2 = 0 THEN 'A' || (o_orderkey % 40) END AS aano FROM orders JOIN items i ON o_custkey % 300 = i.acctno AND o_orderkey % 97 = i.noteno
          UNION ALL SELECT 'overdraft', c_custkey, i.* REPLACE (0 AS noteno), NULL FROM customer JOIN items i ON c_custkey = i.acctno
          UNION ALL SELECT 'trade', s_suppkey, i.* REPLACE (0 AS noteno), NULL FROM supplier JOIN items i ON s_suppkey = i.acctno WHERE s_suppkey % 5 <> 0 AND s_suppkey > 0
          UNION ALL SELECT 'application', n_nationkey, i.* REPLACE (0 AS noteno), 'A' || n_nationkey FROM nation JOIN items i ON n_nationkey = i.acctno),
cat AS (SELECT f.*, t.collater, CASE WHEN f.aano IN (SELECT 'A' || r_regionkey FROM region) THEN 'town ' || f.aano END AS town,
        CASE WHEN t.collater = '10' THEN (CASE WHEN f.code IN ('032','033','034') THEN 'LAND' WHEN f.code IN ('035','036','037') THEN 'BUILDING' WHEN f.code IN ('038','039','040') THEN 'HOUSE' ELSE 'OTHER' END)
             WHEN t.collater = '30' THEN (CASE WHEN f.code IN ('004','005') THEN 'MOTOR' ELSE 'OTHER' END)
             WHEN t.collater = '40' THEN (CASE WHEN f.code IN ('065','066') THEN 'HEAVY' ELSE 'OTHER' END) END AS subtype FROM found f JOIN t ON f.code = t.cclassc),
tab("table", collater) AS (VALUES ('property', '10'), ('motor_vehicle', '30'), ('other_vehicle', '40'), ('plant_machinery', '60'), ('concession', '50'), ('financial_asset', '29'), ('other_asset', '90'),
                                  ('guarantee', '70'), ('cms', '10'), ('insured_financial', '29'), ('insured_other', '90'))
SELECT tab."table", source, own, item, acctno, noteno, code, aano, town, c.collater, subtype, CAST(greatest(suminsure, 0) AS DOUBLE) AS suminsure FROM cat c JOIN tab ON c.collater = tab.collater
""")
def pl_collateral(spark, sf):
    """The eleven collateral tables on derived items and accounts (see ``plans.jobs.collateral``)."""
    p = F.col("p_partkey")
    items = load(spark, sf, "part").select(p.alias("item"), (p % 300).alias("acctno"), (p % 97).alias("noteno"), F.lpad((p % 150).cast("string"), 3, "0").alias("code"),
                                           (F.col("p_retailprice").cast("decimal(18,2)") - 1200).alias("suminsure"), F.when(F.col("p_size") > 25, F.lit("2019-01-01")).otherwise(F.lit("2010-01-01")).cast("date").alias("effective"),
                                           F.when(p % 3 != 0, F.lit("2011-01-01").cast("date")).alias("started"))
    k = F.col("o_orderkey")
    loans = load(spark, sf, "orders").select((F.col("o_custkey") % 300).alias("acctno"), (k % 97).alias("noteno"), k.alias("own"), F.when(k % 2 == 0, F.concat(F.lit("A"), (k % 40).cast("string"))).alias("aano"))
    overdrafts = load(spark, sf, "customer").select(F.col("c_custkey").alias("acctno"), F.col("c_custkey").alias("own"))
    trade = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("acctno"), F.col("s_suppkey").alias("own"), F.when(F.col("s_suppkey") % 5 == 0, F.lit("S")).alias("settled"))
    n = F.col("n_nationkey").cast("long")
    applications = load(spark, sf, "nation").select(n.alias("acctno"), n.alias("own"), F.concat(F.lit("A"), F.col("n_nationkey").cast("string")).alias("aano"))
    summaries = load(spark, sf, "region").select(F.concat(F.lit("A"), F.col("r_regionkey").cast("string")).alias("aano"), F.concat(F.lit("town A"), F.col("r_regionkey").cast("string")).alias("town"))
    out = P.collateral(items, loans, overdrafts, trade, applications, summaries)
    return out.select("table", "source", "own", "item", "acctno", "noteno", "code", "aano", "town", "collater", "subtype", F.col("suminsure").cast("double").alias("suminsure"))
