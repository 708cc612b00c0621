"""§2.10 hierarchy (H1-H5) and §2.11 quality (Q1-Q5) queries.

The supplied ``part`` table gets a generated parent: ``p_partkey // 7`` (root 0), so a
part's depth is 1 + its number of base-7 digits.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import hierarchy as H
from ..operators import quality as Q
from . import load, register
from ._common import money_sum, msum

_PARENT_SQL = "CASE WHEN p_partkey = 0 THEN NULL ELSE p_partkey // 7 END"


def _parts(spark, sf):
    p = load(spark, sf, "part")
    return p.withColumn("parent", F.when(F.col("p_partkey") == 0, None)
                        .otherwise(F.floor(F.col("p_partkey") / 7).cast("bigint")))


@register("parent_chain_depth", f"""
WITH p AS (SELECT p_partkey, {_PARENT_SQL} AS parent, p_brand FROM part),
c AS (SELECT c.p_partkey, c.p_brand, a1.p_partkey AS a1, a2.p_partkey AS a2, a3.p_partkey AS a3
      FROM p c LEFT JOIN p a1 ON c.parent = a1.p_partkey LEFT JOIN p a2 ON a1.parent = a2.p_partkey
      LEFT JOIN p a3 ON a2.parent = a3.p_partkey),
d AS (SELECT p_partkey, p_brand, CAST((a1 IS NOT NULL)::INT + (a2 IS NOT NULL)::INT + (a3 IS NOT NULL)::INT AS INTEGER) AS depth FROM c)
SELECT p_partkey, p_brand, depth FROM (
  SELECT *, RANK() OVER (PARTITION BY p_brand ORDER BY depth DESC) AS r FROM d) WHERE r = 1
""")
def parent_chain_depth(spark, sf):
    p = _parts(spark, sf).select("p_partkey", "parent", "p_brand")
    out = H.parent_chain_depth(p, None, "p_partkey", "parent", levels=3, rank_by="p_brand")
    return out.select("p_partkey", "p_brand", F.col("depth").cast("int").alias("depth"))


# three accounts hold the same node ids; in each some nodes are missing, which orphans their children
_ACCOUNT_NODES_SQL = f"""p AS (SELECT * FROM (SELECT a.acct, p_partkey, {_PARENT_SQL} AS parent FROM part, (VALUES (0), (1), (2)) a(acct))
  WHERE p_partkey = 0 OR (p_partkey + acct) % 11 <> 5)"""


@register("level_hierarchy", f"""
WITH RECURSIVE {_ACCOUNT_NODES_SQL},
lv(acct, node, path) AS (
  SELECT acct, p_partkey, [p_partkey] FROM p WHERE p_partkey = 0
  UNION ALL
  SELECT p.acct, p.p_partkey, list_append(lv.path, p.p_partkey) FROM p JOIN lv ON p.acct = lv.acct AND p.parent = lv.node
  WHERE len(lv.path) < 5)
SELECT CAST(p.acct AS BIGINT) AS acct, p.p_partkey, p.parent, CAST(len(lv.path) AS INTEGER) AS level,
       lv.path[1] AS level1, lv.path[2] AS level2, lv.path[3] AS level3, lv.path[4] AS level4, lv.path[5] AS level5
FROM p LEFT JOIN lv ON p.p_partkey = lv.node AND p.acct = lv.acct
""")
def level_hierarchy(spark, sf):
    p = _parts(spark, sf).select(F.explode(F.array(*[F.lit(a).cast("long") for a in range(3)])).alias("acct"), "p_partkey", "parent") \
        .where("p_partkey = 0 or (p_partkey + acct) % 11 <> 5")
    out = H.level_columns(H.assign_levels(p, "p_partkey", "parent", 0, max_level=5, account="acct"))
    return out.select("acct", "p_partkey", "parent", "level", *[f"level{i}" for i in range(1, 6)])


@register("append_runs", f"""
SELECT o_orderkey, 1 AS run FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, 2 FROM orders WHERE o_orderstatus <> 'F'
""")
def append_runs(spark, sf):
    """K7: two runs append to one growing table."""
    from ..session import scratch_path
    from ..sinks import writers as W
    path = scratch_path(spark, "grown")
    o = load(spark, sf, "orders")
    for run, which in ((1, "o_orderstatus = 'F'"), (2, "o_orderstatus <> 'F'")):
        W.append(o.where(which).select("o_orderkey", F.lit(run).alias("run")), path)
    return spark.read.parquet(path)


# Fixed node-role rules (pattern, role); applied in order, the later match wins
NODE_ROLE_RULES = [("^[A-Z]", "BRANCH"), ("SMALL", "LEAF"), ("^ECO", "TOP")]


@register("node_role", """
SELECT p_partkey, p_type, CASE WHEN regexp_matches(p_type, '^ECO') THEN 'TOP'
                               WHEN regexp_matches(p_type, 'SMALL') THEN 'LEAF'
                               WHEN regexp_matches(p_type, '^[A-Z]') THEN 'BRANCH' ELSE 'OTHER' END AS role
FROM part
""")
def node_role(spark, sf):
    p = load(spark, sf, "part")
    return p.select("p_partkey", "p_type", H.node_role("p_type", NODE_ROLE_RULES).alias("role"))


@register("facility_node", """
WITH s AS (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'OV' WHEN 1 THEN CAST(p_partkey AS VARCHAR) || 'X' WHEN 2 THEN 'FA' || CAST(p_partkey AS VARCHAR)
                  WHEN 3 THEN 'F1SB' || CAST(p_partkey AS VARCHAR) WHEN 4 THEN 'B' || CAST(p_partkey AS VARCHAR) ELSE 'ZZ9' END AS sub,
                  CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN '7' || CAST(p_partkey AS VARCHAR) WHEN 2 THEN NULL ELSE 'FA1' END AS rel FROM part),
r AS (SELECT *, COALESCE(rel, '') AS rr, substring(sub, 1, 5) AS five FROM s)
SELECT p_partkey,
  CASE WHEN sub LIKE 'F_SB%' THEN sub WHEN sub LIKE 'FA%' OR regexp_matches(rr, '^[1-9]') OR regexp_matches(sub, '^[1-9A-H]') THEN five
       WHEN sub = 'OV' AND rr = '' THEN 'OV' END AS facility,
  CASE WHEN sub LIKE 'F_SB%' THEN rr WHEN sub LIKE 'FA%' THEN 'OV' WHEN regexp_matches(rr, '^[1-9]') OR regexp_matches(sub, '^[1-9A-H]') THEN rr
       WHEN sub = 'OV' AND rr = '' THEN 'NIL' END AS parent,
  CASE WHEN sub LIKE 'F_SB%' THEN 'C' WHEN sub LIKE 'FA%' THEN 'B' WHEN regexp_matches(rr, '^[1-9]') THEN 'X'
       WHEN sub = 'OV' AND rr = '' THEN 'A' ELSE 'E' END AS kind
FROM r
""")
def facility_node(spark, sf):
    k, t = F.col("p_partkey"), F.col("p_partkey").cast("string")
    sub = F.when(k % 6 == 0, F.lit("OV")).when(k % 6 == 1, F.concat(t, F.lit("X"))).when(k % 6 == 2, F.concat(F.lit("FA"), t)) \
        .when(k % 6 == 3, F.concat(F.lit("F1SB"), t)).when(k % 6 == 4, F.concat(F.lit("B"), t)).otherwise(F.lit("ZZ9"))
    rel = F.when(k % 5 == 0, F.lit("")).when(k % 5 == 1, F.concat(F.lit("7"), t)).when(k % 5 == 2, F.lit(None)).otherwise(F.lit("FA1"))
    p = load(spark, sf, "part").select("p_partkey", sub.alias("sub"), rel.alias("rel"))
    facility, parent, kind = H.facility_node("sub", "rel")
    return p.select("p_partkey", facility.alias("facility"), parent.alias("parent"), kind.alias("kind"))


@register("label_strip_prefix", """
WITH l AS (SELECT p_partkey, CASE WHEN p_size < 10 THEN CAST(p_size AS VARCHAR) || p_name ELSE p_name END AS label FROM part)
SELECT p_partkey, label, CASE WHEN regexp_matches(label, '^[1-9]') THEN substring(label, 2, 3) ELSE label END AS stripped FROM l
""")
def label_strip_prefix(spark, sf):
    p = load(spark, sf, "part")
    l = p.select("p_partkey", F.when(F.col("p_size") < 10, F.concat(F.col("p_size").cast("string"), "p_name"))
                 .otherwise(F.col("p_name")).alias("label"))
    return l.select("p_partkey", "label", H.strip_level_prefix("label").alias("stripped"))


@register("undrawn_limit", """
WITH u AS (SELECT o_custkey, COUNT(*) FILTER (o_orderstatus = 'F') AS nd, COUNT(*) FILTER (o_orderstatus <> 'F') AS ni,
                  COALESCE(SUM(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'F'), 0) - 500000 AS direct,
                  COALESCE(SUM(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus <> 'F'), 0) AS indirect FROM orders GROUP BY 1),
c AS (SELECT c_custkey, CAST(c_acctbal AS DECIMAL(18,2)) * 1000 AS lim,
             CASE WHEN nd > 0 THEN GREATEST(direct, 0) END AS d, CASE WHEN ni > 0 THEN GREATEST(indirect, 0) END AS i
      FROM customer LEFT JOIN u ON c_custkey = o_custkey)
SELECT c_custkey, CAST(CASE WHEN d IS NOT NULL THEN COALESCE(lim, 0) - d - COALESCE(i, 0) END AS DOUBLE) AS undrawn_direct,
       CAST(CASE WHEN lim IS NOT NULL OR i IS NOT NULL THEN COALESCE(lim, 0) - COALESCE(i, 0) END AS DOUBLE) AS undrawn_indirect
FROM c
""")
def undrawn_limit(spark, sf):
    from ..rules.credit import undrawn_by_use
    direct, amt = F.col("o_orderstatus") == "F", F.col("o_totalprice").cast("decimal(18,2)")
    u = load(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count_if(direct).alias("nd"), F.count_if(~direct).alias("ni"),
        (F.coalesce(F.sum(F.when(direct, amt)), F.lit(0)) - 500000).alias("direct"),
        F.coalesce(F.sum(F.when(~direct, amt)), F.lit(0)).alias("indirect"))
    c = load(spark, sf, "customer")
    j = c.join(u, c.c_custkey == u.o_custkey, "left").withColumn("lim", F.col("c_acctbal").cast("decimal(18,2)") * 1000)
    d, i = undrawn_by_use(F.col("lim"), F.col("direct"), F.col("indirect"), F.col("nd") > 0, F.col("ni") > 0)
    return j.select("c_custkey", d.cast("double").alias("undrawn_direct"), i.cast("double").alias("undrawn_indirect"))


@register("freshness_gate", """
SELECT 'orders' AS feed, CAST(MAX(o_orderdate) AS DATE) AS latest_date, DATE '2001-08-01' AS asof,
       COALESCE(CAST(MAX(o_orderdate) AS DATE) = DATE '2001-08-01', FALSE) AS fresh FROM orders
UNION ALL SELECT 'lineitem', CAST(MAX(l_shipdate) AS DATE), DATE '2001-08-01',
       COALESCE(CAST(MAX(l_shipdate) AS DATE) = DATE '2001-08-01', FALSE) FROM lineitem
UNION ALL SELECT 'events', CAST(MAX(ts) AS DATE), DATE '2001-08-01',
       COALESCE(CAST(MAX(ts) AS DATE) = DATE '2001-08-01', FALSE) FROM events
""")
def freshness_gate(spark, sf):
    feeds = {"orders": load(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("d")),
             "lineitem": load(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("d")),
             "events": load(spark, sf, "events").select(F.col("ts").cast("date").alias("d"))}
    return Q.freshness(feeds, "d", "2001-08-01").select("feed", "latest_date", "asof", "fresh")


@register("exception_lists", f"""
WITH l AS (SELECT l_orderkey AS k, {msum('l_extendedprice', 'line_amount')} FROM lineitem GROUP BY 1),
o AS (SELECT CASE WHEN o_orderkey % 17 = 0 THEN -o_orderkey - 1 ELSE o_orderkey END AS k, o_totalprice FROM orders)
SELECT COALESCE(o.k, l.k) AS o_orderkey, o.o_totalprice, l.line_amount,
       CASE WHEN o.k IS NOT NULL THEN 'missing_detail' ELSE 'missing_master' END AS status
FROM o FULL JOIN l ON o.k = l.k WHERE o.k IS NULL OR l.k IS NULL
""")
def exception_lists(spark, sf):
    k = F.col("o_orderkey")
    li = load(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(money_sum("l_extendedprice", "line_amount"))
    o = load(spark, sf, "orders").select(F.when(k % 17 == 0, -k - 1).otherwise(k).alias("o_orderkey"), "o_totalprice")
    return Q.exception_lists(o, li, "o_orderkey")


@register("id_cleanse_validate", """
SELECT c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') AS clean_id,
       length(regexp_replace(c_name, '[^0-9]', '', 'g')) = 9 AS valid FROM customer
""")
def id_cleanse_validate(spark, sf):
    cleaned, valid = Q.id_cleanse_validate("c_name", 9)
    return load(spark, sf, "customer").select("c_custkey", cleaned.alias("clean_id"), valid.alias("valid"))


@register("control_totals", """
SELECT l_returnflag, l_linestatus, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS l_quantity,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS l_extendedprice, COUNT(*) AS n_rows
FROM lineitem GROUP BY 1, 2
""")
def control_totals(spark, sf):
    li = load(spark, sf, "lineitem").select("l_returnflag", "l_linestatus",
                                            F.col("l_quantity").cast("decimal(18,2)").alias("l_quantity"),
                                            F.col("l_extendedprice").cast("decimal(18,2)").alias("l_extendedprice"))
    t = Q.control_totals(li, ["l_returnflag", "l_linestatus"], ["l_quantity", "l_extendedprice"])
    return t.select("l_returnflag", "l_linestatus", F.col("l_quantity").cast("double").alias("l_quantity"),
                    F.col("l_extendedprice").cast("double").alias("l_extendedprice"), "n_rows")
