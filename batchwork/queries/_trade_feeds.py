"""Trade feeds derived from the supplied tables: ledger detail, account master, transactions, daily rows, certificates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import load
from ._loan_book import DEALT, _dealt_sql

LEDGER = ["00110", "01010", "00620", "01020", "00130", "04550", "01070"]
CODES = ["0060", "0060", "0011", "0013", "0080", "0083", "0029", "0021", "0028", "0101", "0114", "0800", "0900", "9100", "CONI", "0017", "0051", None]
KINDS = ["BAI", "BAP", "FTI", "MCF", "BAS", None]
MASTER = ["custcd", "sectorc", "sectorcd", "crispurp", "sectold", "fisspurp", "ccricode", "product", "prodcd", "industrial_sector_cd"]
START, END = "1998-08-01", "1998-08-15"


def _turn(key: str, step: int, values: list, kind: str = "string") -> Column:
    return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), (F.floor(F.col(key) / step) % len(values) + 1).cast("int"))


def _ref(key: str) -> Column:
    return F.lpad((F.col(key) % 400).cast("string"), 8, "0")


def _sql(key: str, step: int, values: list, kind: str = "string") -> str:
    return _dealt_sql(step, values, kind).replace("o_orderkey", key)


def _sql_ref(key: str) -> str:
    return f"lpad(CAST({key} % 400 AS VARCHAR), 8, '0')"


def detail(spark, sf) -> DataFrame:
    li = load(spark, sf, "lineitem")
    return li.select((F.col("l_suppkey") % 60).alias("acctno"), _ref("l_orderkey").alias("transref"), _turn("l_partkey", 1, KINDS).alias("liabcode"),
                     F.col("l_linenumber").alias("subacct"), _turn("l_partkey", 3, LEDGER).alias("glmnemo"), F.col("l_extendedprice").cast("decimal(18,2)").alias("gltrntot"))


def master(spark, sf) -> DataFrame:
    c = load(spark, sf, "customer")
    return c.select((F.col("c_custkey") % 60).alias("acctno"), F.col("c_custkey").alias("custno"),
                    *[_turn("c_custkey", DEALT[m][0], DEALT[m][2], DEALT[m][1]).alias(m) for m in MASTER])


def transactions(spark, sf) -> DataFrame:
    return transactions_of(load(spark, sf, "lineitem"))


def transactions_of(li: DataFrame, *keep: str) -> DataFrame:
    amount = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("decimal(18,2)")
    group = F.when(F.col("l_orderkey") % 9 == 0, F.concat(F.lit("PG"), F.lpad((F.col("l_partkey") % 40).cast("string"), 5, "0"), F.lit("xx")))
    return li.select((F.col("l_suppkey") % 60).alias("acctno"), _ref("l_orderkey").alias("transref"), group.alias("paygrno"), _turn("l_orderkey", 1, CODES).alias("glmnemo"),
                     amount.alias("transamt"), (amount * 2).cast("decimal(18,2)").alias("tranamt_ccy"), _turn("l_linenumber", 1, ["MYR", "USD", "MYR", None]).alias("currency"),
                     F.date_add(F.lit("1998-07-30").cast("date"), (F.col("l_partkey") % 20).cast("int")).alias("issued"), *keep)


def daily(spark, sf) -> DataFrame:
    k = F.col("o_orderkey")
    return load(spark, sf, "orders").select(
        k.alias("dailyno"), F.when(k % 97 != 0, F.col("o_custkey") % 60).alias("acctno"), _ref("o_orderkey").alias("transref"), _turn("o_orderkey", 5, KINDS).alias("liabcode"),
        _turn("o_orderkey", 2, ["D", "I", None]).alias("dirctind"), ((k % 7) * 100).cast("decimal(18,2)").alias("outstand"), (k % 4).alias("branch"),
        F.date_add(F.lit(END).cast("date"), (k % 3).cast("int")).alias("matdate"))


def certificates(spark, sf) -> DataFrame:
    k = F.col("p_partkey")
    return load(spark, sf, "part").select(
        k.alias("certid"), F.concat(F.lit("P"), F.lpad((k * 3 % 700).cast("string"), 8, "0")).alias("transref"), F.when(k % 5 != 0, k).alias("certno"),
        ((k % 6 + 1) * 100).cast("decimal(18,2)").alias("fcvalue"), F.when(k % 3 != 0, (k % 11).cast("decimal(18,2)")).alias("unearned"), _turn("p_partkey", 2, ["U", " ", None]).alias("utrdf"),
        (k % 4).alias("branch"), F.date_add(F.lit(END).cast("date"), (k % 3).cast("int")).alias("matdate"))


def previous(spark, sf) -> DataFrame:
    s = load(spark, sf, "lineitem")
    return s.where("l_linenumber = 1").groupBy((F.col("l_suppkey") % 60).alias("acctno"), _ref("l_orderkey").alias("transref")).agg(F.max("l_partkey").alias("branch"))


FEEDS_SQL = f"""
detail AS (SELECT l_suppkey % 60 AS acctno, {_sql_ref('l_orderkey')} AS transref, {_sql('l_partkey', 1, KINDS)} AS liabcode, l_linenumber AS subacct,
           {_sql('l_partkey', 3, LEDGER)} AS glmnemo, CAST(l_extendedprice AS DECIMAL(18,2)) AS gltrntot FROM lineitem),
master AS (SELECT c_custkey % 60 AS acctno, c_custkey AS custno, {', '.join(f"{_sql('c_custkey', DEALT[m][0], DEALT[m][2], DEALT[m][1])} AS {m}" for m in MASTER)} FROM customer),
txn AS (SELECT l_suppkey % 60 AS acctno, CASE WHEN l_orderkey % 9 = 0 THEN 'PG' || lpad(CAST(l_partkey % 40 AS VARCHAR), 5, '0') ELSE {_sql_ref('l_orderkey')} END AS transref,
        {_sql('l_orderkey', 1, CODES)} AS code, CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS DECIMAL(18,2)) AS amt,
        {_sql('l_linenumber', 1, ['MYR', 'USD', 'MYR', None])} AS currency, CAST(DATE '1998-07-30' + CAST(l_partkey % 20 AS INTEGER) AS DATE) AS issued FROM lineitem),
daily AS (SELECT o_orderkey AS dailyno, CASE WHEN o_orderkey % 97 <> 0 THEN o_custkey % 60 END AS acctno, {_sql_ref('o_orderkey')} AS transref, {_sql('o_orderkey', 5, KINDS)} AS liabcode,
          {_sql('o_orderkey', 2, ['D', 'I', None])} AS dirctind, CAST(o_orderkey % 7 * 100 AS DECIMAL(18,2)) AS outstand, o_orderkey % 4 AS branch,
          CAST(DATE '{END}' + CAST(o_orderkey % 3 AS INTEGER) AS DATE) AS matdate FROM orders),
cert AS (SELECT p_partkey AS certid, lpad(CAST(p_partkey * 3 % 700 AS VARCHAR), 8, '0') AS transref, CASE WHEN p_partkey % 5 <> 0 THEN p_partkey END AS certno,
         CAST((p_partkey % 6 + 1) * 100 AS DECIMAL(18,2)) AS fcvalue, CASE WHEN p_partkey % 3 <> 0 THEN CAST(p_partkey % 11 AS DECIMAL(18,2)) ELSE 0 END AS unearned,
         {_sql('p_partkey', 2, ['U', ' ', None])} AS utrdf, p_partkey % 4 AS branch, CAST(DATE '{END}' + CAST(p_partkey % 3 AS INTEGER) AS DATE) AS matdate FROM part),
prev AS (SELECT l_suppkey % 60 AS acctno, {_sql_ref('l_orderkey')} AS transref, max(l_partkey) AS branch FROM lineitem WHERE l_linenumber = 1 GROUP BY 1, 2)"""

_UNDO = "('00110','00130','00150','00800','00810','00820','00830','00290','00300','00310','00210','00230','00240','00250','00260','00270','00280')"
_MOVE = ("('00110','00130','00150','00170','00210','00230','00240','00250','00260','00270','00280','00510','00540','00600','00800',"
         "'00810','00820','00830','00290','00300','00310')")
NETTED_SQL = f"""
gl AS (SELECT *, row_number() OVER () AS r FROM (SELECT * REPLACE (CASE WHEN code LIKE '0%' THEN code || '0' ELSE code END AS code) FROM txn
       WHERE (code IS NULL OR (code NOT IN ('CONI','CONM','CONP','DDA','HOE','IBS') AND code NOT LIKE '9%'))) WHERE issued BETWEEN DATE '{START}' AND DATE '{END}'),
n AS (SELECT * FROM gl WHERE code IN ('08000', '09000')),
m AS (SELECT *, CASE WHEN amt > 0 THEN amt END AS disburse, CASE WHEN amt <= 0 THEN -amt END AS repaid, currency IS DISTINCT FROM 'MYR' AS fx FROM gl WHERE code IN {_MOVE}),
a1 AS (SELECT acctno, issued, disburse AS amount FROM m WHERE code = '00600' AND disburse IS NOT NULL INTERSECT SELECT acctno, issued, repaid FROM m WHERE code IN {_UNDO} AND repaid > 0),
m2 AS (SELECT * FROM m WHERE NOT (((code = '00600' AND disburse IS NOT NULL) OR (code IN {_UNDO} AND coalesce(repaid > 0, false)))
       AND (acctno, issued, coalesce(disburse, repaid)) IN (SELECT (acctno, issued, amount) FROM a1))),
m3 AS (SELECT * FROM m2 WHERE repaid IS NULL OR (transref, issued, repaid) NOT IN (SELECT (transref, issued, amt) FROM n)),
p AS (SELECT acctno, transref, -sum(amt) AS repaid, abs(sum(CASE WHEN currency IS DISTINCT FROM 'MYR' THEN amt * 2 END)) AS repaidfx FROM gl
      WHERE code IN ('01010', '01140') AND amt < 0 AND (acctno, transref) NOT IN (SELECT (acctno, transref) FROM n) GROUP BY 1, 2),
netted AS (SELECT 'M' AS kind, acctno, transref, issued, code AS glmnemo, disburse, repaid, CASE WHEN fx AND amt > 0 THEN amt * 2 END AS disbursefx,
                  CASE WHEN fx AND amt <= 0 THEN -amt * 2 END AS repaidfx FROM m3
           UNION ALL SELECT 'P', acctno, transref, NULL, NULL, NULL, repaid, NULL, repaidfx FROM p)"""
