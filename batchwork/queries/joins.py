"""§2.4 join queries (J1-J23) on the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators.keys import join_on
from ..operators import keys as K
from ..rules import trade as TR
from . import _trade_feeds as TF
from . import load, register
from ._common import REPORT_DATE, money_sum, msum


@register("left_enrich", """
SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_mktsegment FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
""")
def left_enrich(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", F.col("o_custkey"))
    c = load(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    # the customer side is meant to be unique: checked, not assumed
    return J.merge_checked(o, c, "o_custkey", how="left", on_duplicate="raise")


@register("inner_match", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_name, p.p_size FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
WHERE p.p_size > 40
""")
def inner_match(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    p = load(spark, sf, "part").where("p_size > 40").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_size")
    return li.join(p, "l_partkey", "inner")


@register("full_join_coalesce", f"""
WITH a AS (SELECT CASE WHEN c_acctbal > 5000 THEN c_custkey WHEN c_acctbal > 0 THEN -c_custkey - 1 END AS k, c_custkey, c_acctbal FROM customer),
b AS (SELECT CASE WHEN o_custkey % 9 <> 4 THEN o_custkey END AS k, {msum('o_totalprice', 'amount')} FROM orders GROUP BY 1)
SELECT COALESCE(a.k, b.k) AS custkey, a.c_custkey, a.c_acctbal, b.amount FROM a FULL JOIN b ON a.k IS NOT DISTINCT FROM b.k
""")
def full_join_coalesce(spark, sf):
    # every customer and every order; derived keys leave some unmatched and some missing on both sides
    bal = F.col("c_acctbal")
    a = load(spark, sf, "customer").select(F.when(bal > 5000, F.col("c_custkey")).when(bal > 0, -F.col("c_custkey") - 1).alias("custkey"),
                                           "c_custkey", "c_acctbal")
    b = load(spark, sf, "orders").groupBy(F.when(F.col("o_custkey") % 9 != 4, F.col("o_custkey")).alias("custkey")).agg(money_sum("o_totalprice", "amount"))
    return join_on(a, b, "custkey", "full")


@register("full_merge_sum", f"""
WITH o AS (SELECT *, CASE WHEN o_custkey % 11 <> 3 THEN o_custkey END AS k FROM orders),
a AS (SELECT k, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM o WHERE year(o_orderdate) = 1997 GROUP BY 1),
b AS (SELECT k, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM o WHERE year(o_orderdate) = 1998 GROUP BY 1)
SELECT COALESCE(a.k, b.k) AS custkey, CAST(a.v AS DOUBLE) AS amt_1997, CAST(b.v AS DOUBLE) AS amt_1998,
       CAST(CASE WHEN a.v IS NULL AND b.v IS NULL THEN NULL ELSE COALESCE(a.v, 0) + COALESCE(b.v, 0) END AS DOUBLE) AS total
FROM a FULL JOIN b ON a.k IS NOT DISTINCT FROM b.k
""")
def full_merge_sum(spark, sf):
    from ..functions.clean import row_sum
    o = load(spark, sf, "orders").withColumn("amt", F.col("o_totalprice").cast("decimal(18,2)")) \
        .withColumn("custkey", F.when(F.col("o_custkey") % 11 != 3, F.col("o_custkey")))
    a = o.where(F.year("o_orderdate") == 1997).groupBy("custkey").agg(F.sum("amt").alias("a"))
    b = o.where(F.year("o_orderdate") == 1998).groupBy("custkey").agg(F.sum("amt").alias("b"))
    j = join_on(a, b, "custkey", "full")
    return j.select("custkey", F.col("a").cast("double").alias("amt_1997"), F.col("b").cast("double").alias("amt_1998"),
                    row_sum("a", "b").cast("double").alias("total"))


@register("right_merge", """
SELECT c.c_custkey, c.c_name, s.s_name FROM supplier s RIGHT JOIN customer c ON s.s_suppkey = c.c_custkey
""")
def right_merge(spark, sf):
    s = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("c_custkey"), "s_name")
    c = load(spark, sf, "customer").select("c_custkey", "c_name")
    return s.join(c, "c_custkey", "right")


@register("anti_missing_detail", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
""")
def anti_missing_detail(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    li = load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return o.join(li, "o_orderkey", "left_anti")


@register("anti_missing_master", """
SELECT p_partkey, p_name FROM part p WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_partkey = p.p_partkey)
""")
def anti_missing_master(spark, sf):
    # in B (parts), not in A (lines): the anti join with the sides swapped
    li = load(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    p = load(spark, sf, "part").select("p_partkey", "p_name")
    return p.join(li, "p_partkey", "left_anti")


@register("semi_filter", """
SELECT c_custkey, c_name FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 400000)
""")
def semi_filter(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_name")
    big = load(spark, sf, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return c.join(big, "c_custkey", "left_semi")


@register("match_indicator", """
WITH o AS (SELECT *, CASE WHEN o_custkey % 11 <> 3 THEN o_custkey END AS k FROM orders),
a AS (SELECT DISTINCT k, TRUE AS h FROM o WHERE o_orderpriority = '1-URGENT'),
b AS (SELECT DISTINCT k, TRUE AS h FROM o WHERE o_orderstatus = 'P')
SELECT COALESCE(a.k, b.k) AS custkey, a.h IS NOT NULL AS in_a, b.h IS NOT NULL AS in_b FROM a FULL JOIN b ON a.k IS NOT DISTINCT FROM b.k
""")
def match_indicator(spark, sf):
    o = load(spark, sf, "orders").withColumn("custkey", F.when(F.col("o_custkey") % 11 != 3, F.col("o_custkey")))
    a = o.where("o_orderpriority = '1-URGENT'").select("custkey").distinct()
    b = o.where("o_orderstatus = 'P'").select("custkey").distinct()
    return J.with_indicators(a, b, "custkey", "full", "in_a", "in_b")


@register("positional_merge", """
WITH L AS (SELECT l_partkey, l_orderkey, l_linenumber, l_quantity, l_shipdate,
                  ROW_NUMBER() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_quantity) AS i
           FROM lineitem WHERE l_returnflag = 'N'),
R AS (SELECT l_partkey, l_orderkey AS r_orderkey, l_quantity, l_discount,
             ROW_NUMBER() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_quantity, l_discount) AS j
      FROM lineitem WHERE l_returnflag = 'R'),
N AS (SELECT COALESCE(a.k, b.k) AS l_partkey, COALESCE(a.nl, 0) AS nl, COALESCE(b.nr, 0) AS nr
      FROM (SELECT l_partkey AS k, COUNT(*) AS nl FROM L GROUP BY 1) a
      FULL JOIN (SELECT l_partkey AS k, COUNT(*) AS nr FROM R GROUP BY 1) b ON a.k = b.k),
P AS (SELECT l_partkey, nl, nr, unnest(generate_series(1, GREATEST(nl, nr))) AS pos FROM N)
SELECT P.l_partkey, CAST(P.pos AS INTEGER) AS merge_pos, L.l_orderkey, L.l_linenumber, CAST(L.l_shipdate AS DATE) AS l_shipdate,
       R.r_orderkey, R.l_discount, CASE WHEN P.nr >= P.pos THEN R.l_quantity ELSE L.l_quantity END AS l_quantity
FROM P LEFT JOIN L ON L.l_partkey = P.l_partkey AND L.i = LEAST(P.pos, P.nl)
LEFT JOIN R ON R.l_partkey = P.l_partkey AND R.j = LEAST(P.pos, P.nr)
""")
def positional_merge(spark, sf):
    li = load(spark, sf, "lineitem")
    left = li.where("l_returnflag = 'N'").select("l_partkey", "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    right = li.where("l_returnflag = 'R'").select("l_partkey", F.col("l_orderkey").alias("r_orderkey"), "l_quantity", "l_discount")
    m = J.merge_by(left, right, "l_partkey", ["l_shipdate", "l_orderkey"], ["r_orderkey"])
    return m.select("l_partkey", F.col("merge_pos").cast("int").alias("merge_pos"), "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("l_shipdate"),
                    "r_orderkey", "l_discount", "l_quantity")


@register("n_way_merge", f"""
WITH o AS (SELECT o_custkey AS custkey, COUNT(*) AS n_orders, {msum('o_totalprice', 'order_amount')} FROM orders GROUP BY 1),
l AS (SELECT o.o_custkey AS custkey, {msum('l.l_extendedprice', 'line_amount')} FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1),
c AS (SELECT c_custkey AS custkey, c_name FROM customer)
SELECT COALESCE(c.custkey, o.custkey, l.custkey) AS custkey, c.c_name, o.n_orders, o.order_amount, l.line_amount
FROM c FULL JOIN o ON c.custkey = o.custkey FULL JOIN l ON COALESCE(c.custkey, o.custkey) = l.custkey
""")
def n_way_merge(spark, sf):
    orders = load(spark, sf, "orders")
    o = orders.groupBy(F.col("o_custkey").alias("custkey")).agg(F.count(F.lit(1)).alias("n_orders"),
                                                                money_sum("o_totalprice", "order_amount"))
    li = load(spark, sf, "lineitem").join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    l = li.groupBy(F.col("o_custkey").alias("custkey")).agg(money_sum("l_extendedprice", "line_amount"))
    c = load(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    return J.n_way_merge([c, o, l], "custkey", "full")


@register("lookup_label", """
SELECT c.c_custkey, COALESCE(n.n_name, CAST(c.c_nationkey AS VARCHAR)) AS nation_label
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey + CASE WHEN n_regionkey = 0 THEN 1000 ELSE 0 END
""")
def lookup_label(spark, sf):
    # value → label table built from data; a miss returns the input value
    shifted = F.col("n_nationkey") + F.when(F.col("n_regionkey") == 0, 1000).otherwise(0)
    n = load(spark, sf, "nation").select(shifted.alias("c_nationkey"), "n_name")
    c = load(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return c.join(n, "c_nationkey", "left").select(
        "c_custkey", F.coalesce(F.col("n_name"), F.col("c_nationkey").cast("string")).alias("nation_label"))


@register("asof_latest_value", """
SELECT event_type, MAX_BY(value, (ts, event_id, value)) AS value, MAX(ts) AS ts
FROM events WHERE ts <= TIMESTAMP '2024-01-20 23:59:59.999999' GROUP BY event_type
""")
def asof_latest_value(spark, sf):
    ev = load(spark, sf, "events")
    return J.latest_as_of(ev, "event_type", "ts", "value", F.lit("2024-01-20 23:59:59.999999").cast("timestamp_ntz"),
                          order=["event_id"])


_PURCH = "CASE WHEN event_type = 'purchase' THEN value END"


@register("asof_per_row", f"""
SELECT event_id, user_id, event_type, value,
       LAST_VALUE({_PURCH} IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_purchase
FROM events
""")
def asof_per_row(spark, sf):
    ev = load(spark, sf, "events")
    facts = ev.select("event_id", "user_id", "event_type", "value", "ts")
    # rate series: each user's purchase values, effective from the purchase onwards
    rates = ev.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("rate_ts"),
                                                      F.col("event_id").alias("rate_id"), F.col("value").alias("rate"))
    # a purchase is both a fact and a rate at the same instant: the rate row sorts first
    out = J.asof_join(facts, rates, "user_id", "ts", "rate_ts", "rate", "last_purchase", tie_break=["event_id"])
    return out.select("event_id", "user_id", "event_type", "value", "last_purchase")


@register("latest_effective_dim", f"""
WITH v AS (SELECT * FROM (SELECT o_custkey, o_orderkey, o_orderpriority, o_orderdate,
                  ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey,
                                     o_orderpriority) AS rn
           FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '{REPORT_DATE}') WHERE rn = 1)
SELECT c.c_custkey, c.c_name, v.o_orderkey AS eff_order, v.o_orderpriority AS eff_priority
FROM customer c LEFT JOIN v ON c.c_custkey = v.o_custkey
""")
def latest_effective_dim(spark, sf):
    o = load(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate")
    eff = J.latest_effective(o, "o_custkey", "o_orderdate", F.lit(REPORT_DATE).cast("date").cast("timestamp_ntz")
                             + F.expr("INTERVAL 1 DAY") - F.expr("INTERVAL 1 MICROSECOND"))
    c = load(spark, sf, "customer").select("c_custkey", "c_name")
    return c.join(eff.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("eff_order"),
                             F.col("o_orderpriority").alias("eff_priority")), "c_custkey", "left")


_PARENT = "CASE WHEN p_partkey = 0 THEN NULL ELSE p_partkey // 7 END"


@register("parent_self_join", f"""
WITH p AS (SELECT p_partkey, {_PARENT} AS parent, p_size FROM part)
SELECT c.p_partkey, c.parent, a1.p_partkey AS anc1_id, a1.p_size AS anc1_p_size, a2.p_partkey AS anc2_id
FROM p c LEFT JOIN p a1 ON c.parent = a1.p_partkey LEFT JOIN p a2 ON a1.parent = a2.p_partkey
""")
def parent_self_join(spark, sf):
    p = load(spark, sf, "part").select("p_partkey", F.when(F.col("p_partkey") == 0, None)
                                       .otherwise(F.floor(F.col("p_partkey") / 7).cast("bigint")).alias("parent"), "p_size")
    out = J.parent_join(p, None, "p_partkey", "parent", 2, keep=["p_size"])
    return out.select("p_partkey", "parent", "anc1_id", "anc1_p_size", "anc2_id")


@register("fallback_match", """
WITH p1 AS (SELECT c.c_custkey, c.c_nationkey, s.s_suppkey, s.s_name, 1 AS match_pass
            FROM customer c JOIN supplier s ON c.c_custkey = s.s_suppkey),
rest AS (SELECT c_custkey, c_nationkey FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)),
s2 AS (SELECT * FROM (SELECT s_nationkey, s_suppkey, s_name, ROW_NUMBER() OVER (PARTITION BY s_nationkey
        ORDER BY s_acctbal DESC, s_suppkey, s_name) AS rn FROM supplier) WHERE rn = 1)
SELECT c_custkey, c_nationkey, s_suppkey, s_name, match_pass FROM p1
UNION ALL
SELECT r.c_custkey, r.c_nationkey, s2.s_suppkey, s2.s_name, CASE WHEN s2.s_suppkey IS NULL THEN NULL ELSE 2 END
FROM rest r LEFT JOIN s2 ON r.c_nationkey = s2.s_nationkey
""")
def fallback_match(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_nationkey")
    s = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_nationkey").alias("c_nationkey"),
                                           F.col("s_suppkey"), "s_name", "s_acctbal")
    m = J.match_with_fallback(c, s, ["c_custkey"], ["c_nationkey"], [F.col("s_acctbal").desc(), "s_suppkey", "s_name"])
    return m.select("c_custkey", "c_nationkey", "s_suppkey", "s_name", F.col("match_pass").cast("integer").alias("match_pass"))


@register("reconcile_feeds", f"""
WITH l AS (SELECT CASE WHEN l_orderkey % 50 <> 9 THEN l_orderkey END AS k, {msum('l_extendedprice', 'line_amount')}, 1 AS h FROM lineitem GROUP BY 1),
o AS (SELECT CASE WHEN o_orderkey % 50 = 7 THEN NULL WHEN o_orderkey % 17 = 0 THEN -o_orderkey - 1 ELSE o_orderkey END AS k, o_totalprice, 1 AS h FROM orders)
SELECT COALESCE(o.k, l.k) AS o_orderkey, o.o_totalprice, l.line_amount,
       CASE WHEN o.h = 1 AND l.h = 1 THEN 'matched' WHEN o.h = 1 THEN 'only_a' ELSE 'only_b' END AS status
FROM o FULL JOIN l ON o.k IS NOT DISTINCT FROM l.k
""")
def reconcile_feeds(spark, sf):
    # every line and every order; derived keys leave some unmatched on each side and some missing on both
    k = F.col("o_orderkey")
    li = load(spark, sf, "lineitem").groupBy(F.when(F.col("l_orderkey") % 50 != 9, F.col("l_orderkey")).alias("o_orderkey")) \
        .agg(money_sum("l_extendedprice", "line_amount"))
    o = load(spark, sf, "orders").select(F.when(k % 50 == 7, None).when(k % 17 == 0, -k - 1).otherwise(k).alias("o_orderkey"), "o_totalprice")
    return J.reconcile(o, li, "o_orderkey")


_NET_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
             "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("net_reversals", f"""
WITH t AS (SELECT *, CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS amount,
                  CAST(date_trunc('month', l_shipdate) AS DATE) AS period FROM lineitem),
k AS (SELECT *, abs(amount) AS aa, amount < 0 AS neg,
             ROW_NUMBER() OVER (PARTITION BY l_suppkey, abs(amount), period, amount < 0
                                ORDER BY {', '.join(c for c in _NET_COLS if c != 'l_suppkey')}) AS kk FROM t),
c AS (SELECT l_suppkey, aa, period, COUNT(*) FILTER (WHERE neg) AS nd, COUNT(*) FILTER (WHERE NOT neg) AS nc
      FROM k GROUP BY 1, 2, 3)
SELECT k.l_orderkey, k.l_linenumber, k.l_suppkey, k.amount, k.period
FROM k JOIN c ON k.l_suppkey = c.l_suppkey AND k.aa = c.aa AND k.period = c.period
WHERE k.kk > LEAST(c.nd, c.nc) OR k.amount = 0
""")
def net_reversals(spark, sf):
    li = load(spark, sf, "lineitem")
    t = li.withColumn("amount", F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity"))) \
          .withColumn("period", F.trunc(F.col("l_shipdate").cast("date"), "MM"))
    out = J.net_reversals(t.select(*_NET_COLS, "amount", "period"), "l_suppkey", "amount", "period", [])
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", "amount", "period")


def _cust_month(o, y, m):
    return (o.where((F.year("o_orderdate") == y) & (F.month("o_orderdate") == m))
             .groupBy(F.col("o_custkey").alias("custkey"))
             .agg(F.count(F.lit(1)).alias("n_orders"), money_sum("o_totalprice", "amount")))


@register("closed_since_prior", f"""
WITH cur AS (SELECT o_custkey AS custkey, COUNT(*) AS n_orders, {msum('o_totalprice', 'amount')} FROM orders
             WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = 8 GROUP BY 1),
prev AS (SELECT o_custkey AS custkey, COUNT(*) AS n_orders, {msum('o_totalprice', 'amount')} FROM orders
         WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = 7 GROUP BY 1),
act AS (SELECT DISTINCT o.o_custkey AS custkey FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        WHERE year(l.l_shipdate) = 1998 AND month(l.l_shipdate) = 8)
SELECT custkey, n_orders, amount, FALSE AS closed FROM cur
UNION ALL
SELECT p.custkey, p.n_orders, p.amount, TRUE FROM prev p JOIN act a ON p.custkey = a.custkey
WHERE p.custkey NOT IN (SELECT custkey FROM cur)
""")
def closed_since_prior(spark, sf):
    o = load(spark, sf, "orders")
    cur, prev = _cust_month(o, 1998, 8), _cust_month(o, 1998, 7)
    li = load(spark, sf, "lineitem").where((F.year("l_shipdate") == 1998) & (F.month("l_shipdate") == 8))
    act = li.join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")) \
            .select(F.col("o_custkey").alias("custkey")).distinct()
    return J.closed_items(cur, prev, act, "custkey")


@register("snapshot_compare", """
WITH cur AS (SELECT o_custkey AS custkey, CAST(MAX(o_orderdate) AS DATE) AS last_order FROM orders
             WHERE o_orderdate < DATE '1998-09-01' GROUP BY 1),
prev AS (SELECT o_custkey AS custkey, CAST(MAX(o_orderdate) AS DATE) AS last_order FROM orders
         WHERE o_orderdate < DATE '1998-08-01' GROUP BY 1)
SELECT cur.custkey, cur.last_order, prev.last_order AS prev_last_order FROM cur JOIN prev ON cur.custkey = prev.custkey
WHERE cur.last_order > prev.last_order
""")
def snapshot_compare(spark, sf):
    o = load(spark, sf, "orders")

    def gen(before):
        return (o.where(F.col("o_orderdate") < F.lit(before).cast("timestamp_ntz"))
                 .groupBy(F.col("o_custkey").alias("custkey")).agg(F.max("o_orderdate").cast("date").alias("last_order")))
    return J.snapshot_compare(gen("1998-09-01"), gen("1998-08-01"), "custkey", "last_order")


@register("carry_forward_prior", """
WITH t AS (SELECT c.c_nationkey AS nation, o.o_orderstatus AS status, o.o_orderdate, CAST(o.o_totalprice AS DECIMAL(18,2)) AS amt
           FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
cur AS (SELECT nation, status, SUM(CASE WHEN status = 'F' AND nation < 5 THEN 0 ELSE amt END) AS balance FROM t
        WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = 8 GROUP BY 1, 2),
prev AS (SELECT nation, status, SUM(amt) AS balance FROM t WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = 7 GROUP BY 1, 2)
SELECT COALESCE(cur.nation, prev.nation) AS nation, COALESCE(cur.status, prev.status) AS status,
       CAST(CASE WHEN COALESCE(cur.status, prev.status) = 'F' AND COALESCE(cur.balance, 0) = 0 THEN prev.balance
            ELSE cur.balance END AS DOUBLE) AS balance,
       CAST(prev.balance AS DOUBLE) AS prior_balance
FROM cur FULL JOIN prev ON cur.nation = prev.nation AND cur.status = prev.status
""")
def carry_forward_prior(spark, sf):
    o = load(spark, sf, "orders")
    c = load(spark, sf, "customer")
    t = o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("c_nationkey").alias("nation"), F.col("o_orderstatus").alias("status"), "o_orderdate",
        F.col("o_totalprice").cast("decimal(18,2)").alias("amt"))
    ym = lambda y, m: (F.year("o_orderdate") == y) & (F.month("o_orderdate") == m)
    zeroed = F.when((F.col("status") == "F") & (F.col("nation") < 5), F.lit(0)).otherwise(F.col("amt"))
    cur = t.where(ym(1998, 8)).groupBy("nation", "status").agg(F.sum(zeroed).alias("balance"))
    prev = t.where(ym(1998, 7)).groupBy("nation", "status").agg(F.sum("amt").alias("balance"))
    out = J.carry_forward_prior(cur, prev, ["nation", "status"], "balance", F.col("status") == "F")
    return out.select("nation", "status", F.col("balance").cast("double").alias("balance"),
                      F.col("prior_balance").cast("double").alias("prior_balance"))


@register("union_lookup", """
WITH u AS (SELECT CASE WHEN c_acctbal > 0 THEN c_custkey ELSE -c_custkey - 1 END AS k, c_mktsegment AS label, 0 AS src FROM customer
           UNION ALL SELECT s_suppkey, s_name, 1 FROM supplier
           UNION ALL SELECT n_nationkey, n_name, 2 FROM nation),
m AS (SELECT * FROM (SELECT k, label, ROW_NUMBER() OVER (PARTITION BY k ORDER BY src, label) AS rn FROM u) WHERE rn = 1)
SELECT o.o_orderkey, o.o_custkey, COALESCE(m.label, 'UNKNOWN') AS label
FROM orders o LEFT JOIN m ON o.o_custkey = m.k
""")
def union_lookup(spark, sf):
    k = F.when(F.col("c_acctbal") > 0, F.col("c_custkey")).otherwise(-F.col("c_custkey") - 1)
    c = load(spark, sf, "customer").select(k.alias("k"), F.col("c_mktsegment").alias("label"))
    s = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("label"))
    n = load(spark, sf, "nation").select(F.col("n_nationkey").cast("bigint").alias("k"), F.col("n_name").alias("label"))
    m = J.union_lookup([c, s, n], "k", "label")
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return o.join(m, o.o_custkey == m.k, "left").select("o_orderkey", "o_custkey",
                                                        F.coalesce("label", F.lit("UNKNOWN")).alias("label"))


@register("pair_opposite_leg", """
WITH v AS (SELECT * FROM (SELECT user_id, value AS view_value,
             ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events WHERE event_type = 'view') WHERE rn = 1)
SELECT e.event_id, e.user_id, e.value, v.view_value FROM events e LEFT JOIN v ON e.user_id = v.user_id
WHERE e.event_type = 'purchase'
""")
def pair_opposite_leg(spark, sf):
    ev = load(spark, sf, "events")
    first_view = K.first_by(ev.where("event_type = 'view'").select("user_id", "ts", "event_id", "value"),
                            "user_id", ["ts", "event_id"]).select("user_id", F.col("value").alias("view_value"))
    return ev.where("event_type = 'purchase'").select("event_id", "user_id", "value").join(first_view, "user_id", "left")


@register("net_reversals_by_rule", f"""
WITH {TF.FEEDS_SQL}, {TF.NETTED_SQL}
SELECT kind, acctno, transref, issued, glmnemo, CAST(disburse AS DOUBLE) AS disburse, CAST(repaid AS DOUBLE) AS repaid,
       CAST(disbursefx AS DOUBLE) AS disbursefx, CAST(repaidfx AS DOUBLE) AS repaidfx FROM netted
""")
def net_reversals_by_rule(spark, sf):
    """The period's movements after the netting passes (see ``rules.trade.netted_movements``)."""
    ledger = TR.ledger_transactions(TF.transactions(spark, sf), TF.END)
    out = TR.netted_movements(ledger, TF.START, TF.END)
    money = ["disburse", "repaid", "disbursefx", "repaidfx"]
    return out.select("kind", "acctno", "transref", "issued", "glmnemo", *[F.col(c).cast("double").alias(c) for c in money])
