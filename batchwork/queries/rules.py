"""§2.14 domain rule sets (D1-D15), re-aimed at the supplied tables.

Code maps are data (broadcast code tables); ordered rules are staged columns where a
later rule sees the results of the earlier ones.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators.joins import code_table
from ..rules import account as AC
from ..rules import codes as RC
from ..rules import credit as RK
from ..rules import facility as FC
from ..rules import sector as SR
from ..rules import trade as TR
from ..rules.compiler import compile_rules
from . import _trade_feeds as TF
from . import load, register
from ._common import COLLATERAL_PAIRS, REPORT_DATE
from ._loan_book import LOAN_BOOK_SQL, loan_book, steps

# industry code -> sector label of the re-aimed rule
INDUSTRY = [("01111", "0111"), ("64191", "8110")]
_P4, _FIN = "custcd IN ('77', '78', '95', '96')", "('8110', '8120', '8130')"
_FINANCIAL = "('02','03','04','05','06','11','12','13','17','30','31','32','33','34','35','37','38','39','45')"


SECTOR_STEPS = steps('raw',
  "CASE WHEN custcd = '77' AND sector BETWEEN '1111' AND '9999' THEN '41' WHEN custcd = '78' AND sector BETWEEN '1111' AND '9999' THEN '44' ELSE custcd END AS custcd",
  f"CASE WHEN {_P4} AND sectorcd BETWEEN '0111' AND '0430' THEN '0410' ELSE sectorcd END AS sectorcd",
  "CASE WHEN custcd NOT IN ('01','02','03','11','12','20','13','17','30','31','32','33','34','35','36','37','38','39','40','45','04','05','06','80','81','82',"
  "'83','84','85','86','87','88','90') AND sector IN ('8110', '8120', '8130') THEN '9999' ELSE sectorcd END AS sectorcd",
  f"CASE WHEN {_P4} AND sector BETWEEN '0111' AND '0430' THEN '0410' ELSE sectorcd END AS sectorcd",
  f"CASE WHEN {_P4} OR sectorcd >= '1111' THEN sectorcd WHEN custcd IN {_FINANCIAL} THEN '8110' WHEN custcd = '40' THEN '8130' WHEN custcd = '79' THEN '9203' "
  "WHEN custcd IN ('71', '72', '73', '74') THEN '9101' ELSE '9999' END AS sectorcd",
  f"CASE WHEN custcd IN ('79','61','62','63','75','57','59','41','42','43','44','46','47','48','49','51','52','53','54') AND sectorcd IN {_FIN} THEN '9999' ELSE sectorcd END AS sectorcd",
  f"CASE WHEN (custcd IN {_FINANCIAL} OR custcd = '40') AND sectorcd NOT IN {_FIN} THEN '8110' ELSE sectorcd END AS sectorcd",
  "CASE WHEN custcd IN ('71', '72', '73', '74') AND left(sectorcd, 2) NOT IN ('91','92','93','94','95','96','97','98','99') THEN '9101' ELSE sectorcd END AS sectorcd",
  "CASE WHEN custcd = '77' AND sectorcd BETWEEN '1111' AND '9999' THEN '41' WHEN custcd = '78' AND sectorcd BETWEEN '1111' AND '9999' THEN '44' ELSE custcd END AS custcd",
  "CASE WHEN sectold = '' AND ((custcd = '79' AND crispurp IN ('5300', '0440', '0460', '5200', '5100')) OR (crispurp IN ('4300', '4100') AND custcd IN "
  "('01','02','03','11','12','20','13','17','30','31','32','33','34','35','36','37','38','39','40','45','04','05','06','61','41','42','43','62','44','46','47',"
  "'63','48','49','51','57','75','59','52','53','54','66','67','68','69'))) THEN '0990' ELSE fisspurp END AS fisspurp, "
  "CASE WHEN custcd = '79' AND sectorcd NOT IN ('9203', '9420', '9440') THEN '9203' ELSE sectorcd END AS sectorcd",
  "CASE WHEN custcd IN ('82','83','84','86','90','91','95','96','98','99') AND sector BETWEEN '1000' AND '9999' THEN '86' ELSE custcd END AS custcd",
  f"CASE WHEN {_P4} AND ((crispurp = '' AND ccricode IS NULL AND sectold = '') OR fisspurp IN ('0390', '0440', '0470')) THEN "
  "  CASE WHEN NOT (acctno > 3000000000 AND acctno < 4000000000) AND product IN (128,130,380,381,700,705,983,993,996) THEN '0212' ELSE '0410' END ELSE fisspurp END AS fisspurp",
  f"CASE WHEN {_P4} AND fisspurp IN ('0110','0120','0131','0132','0139','0210','0220','0230','0200','0211','0212','0311','0312','0313','0314','0315','0316','0321',"
  "'0322','0323','0324','0325','0326','0327','0328','0329','0410','0420','0430','0990') THEN '9700' ELSE sectorcd END AS sectorcd",
  "CASE WHEN prodcd = '34111' AND fisspurp NOT IN ('0211', '0212', '0200', '0210', '0390', '0430') THEN '0212' ELSE fisspurp END AS fisspurp",
  "CASE WHEN length(ind) = 5 AND TRY_CAST(ind AS INTEGER) > 0 THEN CASE ind WHEN '01111' THEN '0111' WHEN '64191' THEN '8110' ELSE left(ind, 4) END ELSE sectorcd END AS sectorcd",
  f"CASE WHEN {_P4} THEN '9700' ELSE sectorcd END AS sectorcd")


@register("sector_code_repair", f"""
WITH {LOAN_BOOK_SQL},
raw AS (SELECT acctno + 2999990000 AS acctno, coalesce(rtrim(custcd), '') AS custcd, coalesce(lpad(CAST(sectorc AS VARCHAR), 4, '0'), '   .') AS sector,
               coalesce(rtrim(sectorcd), '') AS sectorcd, coalesce(rtrim(crispurp), '') AS crispurp, coalesce(rtrim(sectold), '') AS sectold,
               coalesce(rtrim(fisspurp), '') AS fisspurp, ccricode, loantype AS product, coalesce(rtrim(prodcd), '') AS prodcd,
               coalesce(rtrim(industrial_sector_cd), '') AS ind FROM book),
{SECTOR_STEPS}
SELECT acctno, custcd, sectorcd, fisspurp FROM done
""")
def sector_code_repair(spark, sf):
    book = loan_book(spark, sf).withColumn("acctno", F.col("acctno") + F.lit(2999990000)).drop("product").withColumnRenamed("loantype", "product")
    industrial = code_table(spark, INDUSTRY, "industrial_sector_cd string, industrial_sector string")
    return SR.sector_repair(book, industrial).select("acctno", "custcd", "sectorcd", "fisspurp")


FACILITY_SQL = """p AS (SELECT * REPLACE (CASE WHEN loantype = 698 THEN '34111' ELSE prodcd END AS prodcd) FROM book),
f AS (SELECT acctno, loantype, prodcd, purpose,
  CASE WHEN loantype IN (412,413,414,911,415,466) THEN 34322 WHEN loantype IN (912,575,416,467,461,307,422,464,465) THEN 34391
       WHEN loantype IN (103,104) THEN 34371 WHEN loantype IN (191,417) THEN 34351
       WHEN loantype IN (110,141,200,201,225,227,230,232,237,239,244,246,249,409,479,484,433,445) THEN 34321
       WHEN loantype IN (981,984,991,994,410,486,489,494,472,473,474) THEN 34322 WHEN loantype IN (993,996,983) THEN 34331
       WHEN loantype IN (130,132,381,705,725,699) THEN 34332 WHEN loantype IN (500,520,982,985,992,995) THEN 34391
       WHEN loantype IN (800,801,804,851,852,853,854,855,805,807,809,811,813) THEN 34391
       WHEN loantype IN (802,803,856,857,858,859,860,806,808,810,812,814) THEN 34210 WHEN loantype BETWEEN 102 AND 105 THEN 34371
       ELSE CASE WHEN prodcd = '34190' THEN 34210 WHEN prodcd IN ('34120', '54120') THEN 34322 WHEN prodcd IN ('34111', '54124') THEN 34331 WHEN prodcd = '34112' THEN 34341
                 WHEN prodcd = '34114' THEN 34351 WHEN prodcd = '34113' THEN 34361 WHEN prodcd = '34230' THEN 34371 WHEN prodcd IN ('34149', '34117', '34115') THEN 34391 END
  END AS facility,
  CASE WHEN loantype IN (412,413,414,911,415,466) THEN 34320 WHEN loantype IN (912,575,416,467,461) THEN 34391 WHEN loantype IN (307,422,464,465) THEN 34392
       WHEN loantype IN (103,104) THEN 34371 WHEN loantype IN (191,417) THEN 34364
       WHEN loantype IN (128,130,131,132,380,381,700,705,709,710,720,725,750,752,760,983,993,996,698,699) AND purpose IN ('3100','3101','3110','3120') THEN 34333
       WHEN loantype IN (128,130,131,132,380,381,700,705,709,710,720,725,750,752,760,983,993,996,698,699)
            AND purpose IN ('3300','3900','3901','4100','5100','5200','3200','3201') THEN 34334
       WHEN loantype IN (698,699) THEN 34333 END AS code FROM p)"""


@register("facility_from_product", f"""
WITH {LOAN_BOOK_SQL},
{FACILITY_SQL}
SELECT acctno, loantype, facility, coalesce(code, facility) AS faccode FROM f
""")
def facility_from_product(spark, sf):
    return FC.facility_codes(loan_book(spark, sf).drop("facility", "faccode")).select("acctno", "loantype", "facility", "faccode")


LOAN_PRICING_SQL = f"""CASE WHEN loantype IN (983, 993, 128, 130, 380, 381, 700, 705) THEN '80'
       WHEN loantype IN (678, 679, 698, 699, 131, 132, 720, 725) THEN
         CASE WHEN base_rate AND (spread IS NULL OR spread < 0) THEN '42' WHEN base_rate THEN '41' WHEN base_fin THEN '43' ELSE '80' END
       WHEN cfindex = 997 THEN '68' WHEN base_rate AND (spread IS NULL OR spread < 0) THEN '42' WHEN base_rate THEN '41' WHEN base_fin THEN '43'
       WHEN ntindex = 52 THEN '44'
       WHEN cfindex BETWEEN 900 AND 923 THEN ['53', '57', '54', '55', '56', '58'][(cfindex - 900) // 4 + 1]
       WHEN cfindex = 925 THEN '79' WHEN cfindex BETWEEN 926 AND 932 THEN CAST(cfindex - 865 AS VARCHAR) WHEN cfindex = 933 THEN '51'
       WHEN cfindex = 924 OR costfund > 0 THEN '68' ELSE '59' END"""
OVERDRAFT_PRICING_SQL = f"""CASE WHEN lmtindex IN (18, 19) THEN '59'
       WHEN lmtindex IN (1, 30) THEN CASE WHEN lmtbaser IS NULL OR lmtrate >= lmtbaser THEN '41' ELSE '42' END
       WHEN lmtindex IN (38, 39) THEN '43'
       WHEN lmtindex IS NULL OR lmtindex = 0 THEN
         CASE WHEN fdrcno > 0 THEN '68' WHEN lmtamt > 0 THEN '59'
              WHEN odplan IN (110, 111, 114) THEN '43' WHEN odplan IN (100, 101, 103, 104, 105, 107) THEN '41'
              WHEN odplan IN (106, 998) THEN '00' WHEN odplan IN (120, 121) THEN '44' ELSE '79' END
       WHEN lmtindex = 52 THEN '44' ELSE '79' END"""
@register("pricing_type", f"""
WITH {LOAN_BOOK_SQL},
base AS (SELECT *, ntindex IN (1, 30) AS base_rate, ntindex IN (38, 39) AS base_fin FROM book)
SELECT acctno, loantype, product,
  {LOAN_PRICING_SQL} AS loan_pricing,
  {OVERDRAFT_PRICING_SQL} AS overdraft_pricing
FROM base
""")
def pricing_type(spark, sf):
    book = loan_book(spark, sf)
    loans = compile_rules(book, [AC.loan_pricing()], types={"typeprc": "string"}).withColumnRenamed("typeprc", "loan_pricing")
    both = compile_rules(loans, [AC.overdraft_pricing()], types={"typeprc": "string"})
    return both.select("acctno", "loantype", "product", "loan_pricing", F.col("typeprc").alias("overdraft_pricing"))


def _order_lines(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"), F.bool_or(F.col("l_returnflag") == "R").alias("any_r"),
        F.sum((F.col("l_extendedprice").cast("decimal(18,2)") * (1 - F.col("l_discount").cast("decimal(4,2)")))).alias("drawn"),
        F.min(F.when(F.col("l_linestatus") == "O", F.col("l_shipdate").cast("date"))).alias("first_unpaid"))


_OL_SQL = """ol AS (SELECT l_orderkey, COUNT(*) AS n_lines, BOOL_OR(l_returnflag = 'R') AS any_r,
       SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS drawn,
       MIN(CASE WHEN l_linestatus = 'O' THEN CAST(l_shipdate AS DATE) END) AS first_unpaid
       FROM lineitem GROUP BY l_orderkey)"""


_HP = "loantype IN (128, 130, 380, 381, 700, 705, 983, 993, 996)"
_WD, _PAID, _WOFF = "coalesce(loantype BETWEEN 600 AND 699, false)", "paidind = 'P'", "coalesce(lsttrncd IN (658, 662, 663), false)"


def _zeroed(cond: str, *extra: str) -> str:
    cols = ["arrears", "instalm", "nodays", "undrawn", *extra]
    return ", ".join(f"CASE WHEN {cond} THEN 0 ELSE {c} END AS {c}" for c in cols)


_REPT = f"DATE '{REPORT_DATE}'"
_SHADOW, _AGENCY = "loantype IN (983, 993, 698, 699)", "loantype IN (128,130,131,132,380,381,700,705,720,725,678,679,698,699,983,993)"
_MODEL = "coalesce(loantype IN (128,130,131,132,720,725,380,381,700,705,709,710,983,993,996), false)"
_SIX = "regexp_matches(modeldes, '^[CTRSWM][0-9][0-9][0-9][UD](K| |$)')"
_DATED = "loantype IN (128,130,380,381,700,705,720,725) AND noteno >= 98000"
_KEEP = "acctstat NOT IN ('S', 'W')"
# one step after another, in the order of the rules
def status_steps(book: str) -> str:
    """CTEs from a book to ``done``: what each account comes to."""
    return f"""blank AS (SELECT * REPLACE ({', '.join(f"coalesce(rtrim({c}), '') AS {c}" for c in AC.TEXTS)}),
                 'O' AS acctstat, CAST(NULL AS VARCHAR) AS impaired, 0 AS arrears, billcnt AS instalm, CASE WHEN facility IN (34331, 34332) THEN 0 ELSE coalesce(cavaiamt, 0) END AS undrawn,
                 0 AS xnodays, '' AS restruct, '' AS rrtag, 0 AS cyc, CAST(NULL AS VARCHAR) AS classifi,
                 CAST(NULL AS DATE) AS completed_on, CAST(NULL AS DATE) AS ends_on, CAST(NULL AS VARCHAR) AS complyind, CAST(NULL AS VARCHAR) AS oldrracc,
                 CAST(NULL AS DATE) AS assessed_on, '' AS was,
                 coalesce(loantype IN (128,130,700,705,380,381,709,710,131,132,720,725), false) AS lnty FROM {book}),
{steps('blank',
  "0 AS nodays",
  ', '.join(f"CASE WHEN {_PAID} THEN 0 ELSE {c} END AS {c}" for c in ('outstand', 'curbal', 'interdue', 'feeamt')),
  f"""CASE WHEN {_HP} AND {_PAID} THEN 'hp' WHEN {_WD} AND {_PAID} THEN CASE WHEN coalesce(write_down_bal, 0) <> 0 THEN '' WHEN {_WOFF} THEN 'off' ELSE 'set' END
      WHEN {_WD} THEN CASE WHEN write_down_bal IS NULL OR write_down_bal <= 0 THEN 'off' ELSE 'part' END
      WHEN {_PAID} AND coalesce(outstand, 0) = 0 THEN CASE WHEN {_WOFF} THEN 'off' ELSE 'set' END ELSE '' END AS was""",
  "CASE was WHEN 'hp' THEN 'S' WHEN 'set' THEN 'S' WHEN 'off' THEN 'W' WHEN 'part' THEN 'P' ELSE acctstat END AS acctstat, "
  "CASE was WHEN 'set' THEN 'N' WHEN 'off' THEN 'Y' WHEN 'part' THEN 'Y' ELSE impaired END AS impaired, " + _zeroed("was IN ('hp', 'set')"),
  "CASE WHEN was = 'hp' THEN 0 ELSE outstand END AS outstand, CASE WHEN (lnty AND (noteno >= 98000 OR borstat = 'S')) OR (NOT lnty AND borstat = 'S') THEN 'T' ELSE acctstat END AS acctstat",
  f"""CASE WHEN {_MODEL} THEN CASE WHEN modeldes LIKE 'RAM%' OR modeldes LIKE 'RARM%' THEN 'Y' WHEN borstat = 'S' THEN 'T' WHEN noteno >= 98000 THEN 'C' ELSE '' END
      WHEN modeldes IN ('C', 'T', 'Y') THEN modeldes WHEN borstat = 'S' THEN 'T' WHEN borstat = 'Q' THEN 'C' ELSE '' END AS restruct,
      CASE WHEN {_MODEL} THEN coupon_start END AS completed_on, CASE WHEN {_MODEL} AND rrcycle LIKE 'HP%' THEN TRY_CAST(substring(rrcycle, 3, 1) AS INTEGER) ELSE 0 END AS cyc""",
  f"CASE WHEN {_MODEL} AND (cyc IS NULL OR cyc <= 0) AND foreclosed_on IS NOT NULL THEN 6 ELSE cyc END AS cyc, "
  f"CASE WHEN {_HP} AND borstat = 'W' THEN 'P' WHEN {_HP} AND borstat = 'X' THEN 'W' ELSE acctstat END AS acctstat",
  f"CASE WHEN bldate IS NOT NULL THEN greatest(date_diff('day', bldate, {_REPT}), 0) ELSE nodays END AS nodays",
  "CASE WHEN mordayarr IS NOT NULL THEN mordayarr WHEN oldnotedayarr > 0 AND noteno BETWEEN 98000 AND 98999 THEN nodays + oldnotedayarr ELSE nodays END AS nodays, "
  "CASE WHEN oldnotedayarr > 0 AND noteno BETWEEN 98000 AND 98999 THEN oldnotedayarr ELSE 0 END AS xnodays",
  f"CASE WHEN {_SIX} THEN modeldes ELSE rrtag END AS rrtag, CASE WHEN {_SIX} THEN substring(modeldes, 1, 1) ELSE restruct END AS restruct, "
  f"CASE WHEN {_SIX} THEN TRY_CAST(substring(modeldes, 3, 2) AS INTEGER) ELSE cyc END AS cyc",
  f"CASE WHEN {_SIX} AND NOT {_WD} THEN CASE WHEN {_PAID} AND NOT {_WOFF} THEN 'S' WHEN restruct IN ('C', 'R', 'W') THEN 'C' ELSE 'T' END ELSE acctstat END AS acctstat, "
  f"CASE WHEN {_SIX} AND (coalesce({_REPT} < delivered_on, false) OR (foreclosed_on IS NOT NULL AND assessed IS NOT NULL)) THEN 'u' ELSE '' END AS was",
  f"CASE WHEN was = 'u' THEN '' ELSE restruct END AS restruct, CASE WHEN was = 'u' AND {_KEEP} THEN 'O' ELSE acctstat END AS acctstat, "
  f"CASE WHEN {_SIX} AND assessed IS NOT NULL THEN assessed ELSE completed_on END AS completed_on",
  f"CASE WHEN {_SIX} AND restruct = 'W' THEN 'R' WHEN {_SIX} AND restruct = 'M' THEN 'S' ELSE restruct END AS restruct, "
  "CASE WHEN foreclosed_on IS NOT NULL AND cyc > 0 THEN last_day(foreclosed_on + to_months(cyc - 1)) END AS ends_on",
  f"CASE WHEN foreclosed_on IS NOT NULL AND (ends_on IS NULL OR {_REPT} >= ends_on) AND (assessed IS NOT NULL OR coupon_start IS NOT NULL) THEN 'c' ELSE '' END AS was",
  f"CASE WHEN was = 'c' AND (NOT lnty OR (user5 <> 'N' AND coalesce(issued >= DATE '2015-04-06', false))) THEN '' ELSE restruct END AS restruct, "
  f"CASE WHEN was = 'c' AND {_KEEP} THEN 'O' ELSE acctstat END AS acctstat, CASE WHEN was = 'c' THEN 'Y' END AS complyind, "
  "CASE WHEN nplind = 'P' OR coalesce(rtrim(riskrate), '') = '' THEN 'P' ELSE [NULL, 'C', 'S', 'D', 'B'][1 + coalesce(TRY_CAST(riskrate AS INTEGER) * CAST(riskrate IN ('1','2','3','4') AS INTEGER), 0)] END AS classifi",
  "CAST(floor(nodays / 30.0005) AS INTEGER) AS arrears, coalesce(mo_instl_arr, billcnt) AS instalm, CASE WHEN loanstat = 3 OR (faccode = 34371 AND (nodays >= 90 OR "
  "borstat IN ('F', 'I', 'R') OR user5 = 'N')) THEN 'Y' ELSE 'N' END AS impaired, CASE WHEN flag1 = 'F' THEN 0 WHEN flag1 IN ('P', 'I') THEN coalesce(cavaiamt, 0) ELSE undrawn END AS undrawn",
  f"""CASE WHEN day(bldate + 1) = 1 AND instalm > 0 AND NOT (CASE WHEN coalesce({_HP}, false) THEN modeldes IN ('A1AM','A1BM','A1CM','A1DM','A1EM','A1FM') OR modeldes LIKE 'RAM%'
      ELSE left(lmo_tag, 1) IN ('R','F','V','A','B') END AND coalesce({_REPT} BETWEEN relief_from AND relief_to, false)) THEN instalm - 1 ELSE instalm END AS instalm,
      CASE WHEN balance IS NULL OR balance < 0 THEN apprlim2 ELSE undrawn END AS undrawn""",
  "CASE WHEN loantype IN (984, 985, 994, 995) AND noteno = 10010 THEN 's' ELSE '' END AS was",
  "CASE WHEN was = 's' THEN 'S' ELSE acctstat END AS acctstat, "
  + ", ".join(f"CASE WHEN was = 's' THEN 0 ELSE {c} END AS {c}" for c in ("outstand", "balance", "arrears", "instalm", "undrawn")),
  "CASE WHEN loantype IN (981, 982, 983, 991, 992, 993, 698, 699) THEN 'W' ELSE acctstat END AS acctstat, "
  + ", ".join(f"CASE WHEN loantype IN (981, 982, 983, 991, 992, 993, 698, 699) THEN 0 ELSE {c} END AS {c}" for c in ("outstand", "balance", "undrawn", "curbal", "interdue", "feeamt")),
  f"CASE WHEN {_SHADOW} AND ({_PAID} OR user5 = 'F') THEN 'S' ELSE acctstat END AS acctstat, CASE WHEN {_SHADOW} AND ({_PAID} OR user5 = 'F') THEN 'P' ELSE classifi END AS classifi, "
  f"CASE WHEN {_SHADOW} AND ({_PAID} OR user5 = 'F') THEN 'N' ELSE impaired END AS impaired, " + _zeroed(f"{_SHADOW} AND ({_PAID} OR user5 = 'F')"),
  f"CASE WHEN borstat = 'F' THEN 999 ELSE instalm END AS instalm, CASE WHEN borstat = 'F' AND {_SHADOW} THEN 'B' ELSE classifi END AS classifi, "
  f"CASE WHEN borstat = 'F' AND {_SHADOW} THEN 'Y' ELSE impaired END AS impaired",
  f"CASE WHEN {_WD} AND NOT {_PAID} AND loanstat = 3 AND impaired = 'Y' THEN CASE WHEN write_down_bal > 0 THEN 'P' ELSE 'W' END "
  f"WHEN {_WD} AND {_PAID} THEN CASE WHEN {_WOFF} THEN 'W' ELSE 'S' END ELSE acctstat END AS acctstat, "
  f"CASE WHEN {_WD} AND {_PAID} THEN CASE WHEN {_WOFF} THEN 'Y' ELSE 'N' END ELSE impaired END AS impaired",
  f"CASE WHEN {_SHADOW} AND NOT {_PAID} THEN 'B' ELSE classifi END AS classifi, CASE WHEN {_SHADOW} AND NOT {_PAID} THEN 'Y' ELSE impaired END AS impaired, "
  f"CASE WHEN {_DATED} THEN CASE WHEN issued IS NULL OR issued <= DATE '2005-09-30' OR issued BETWEEN DATE '2007-12-19' AND DATE '2008-08-31' THEN 'T' ELSE 'C' END ELSE restruct END AS restruct",
  f"CASE WHEN {_DATED} THEN CASE WHEN {_PAID} THEN 'S' ELSE restruct END ELSE acctstat END AS acctstat, " + _zeroed(f"{_DATED} AND {_PAID}", "outstand"),
  "CASE WHEN loantype IN (128,130,380,381,700,705,720,725,131,132) AND coalesce(noteno, 0) < 98000 "
  "AND modeldes IN ('A1A','A1B','A1C','A1D','A1E','A1F','AK1A','AK1B','AK1C','AK1D','AK1E','AK1F') THEN 'x' ELSE '' END AS was",
  "CASE WHEN was = 'x' THEN 'C' ELSE restruct END AS restruct, CASE WHEN was = 'x' THEN 'C' ELSE acctstat END AS acctstat, CASE WHEN was = 'x' THEN modeldes ELSE rrtag END AS rrtag",
  "CASE WHEN restruct_feed = '' THEN restruct WHEN restruct_feed = 'R' THEN 'C' WHEN restruct_feed = 'S' THEN 'T' ELSE restruct_feed END AS restruct",
  f"CASE WHEN restruct_feed <> '' AND (loantype IS NULL OR loantype NOT IN (983, 993)) AND NOT {_PAID} AND restruct IN ('C', 'T') THEN restruct ELSE acctstat END AS acctstat",
  "CASE WHEN user5 = 'R' OR (oldrr = 'R' AND (delivered_on IS NULL OR delivered_on < DATE '2016-03-01')) THEN '' ELSE restruct END AS restruct, "
  "CASE WHEN (user5 = 'R' OR (oldrr = 'R' AND (delivered_on IS NULL OR delivered_on < DATE '2016-03-01'))) AND acctstat NOT IN ('S', 'W', 'P') THEN 'O' ELSE acctstat END AS acctstat, "
  "CASE WHEN user5 = 'R' OR oldrr = 'R' THEN 'R' END AS oldrracc",
  f"CASE WHEN {_AGENCY} AND akpk_status IN ('AKPK', 'RAKPK') AND acctstat NOT IN ('S', 'F') THEN 'K' ELSE acctstat END AS acctstat, "
  f"CASE WHEN {_AGENCY} AND akpk_status = 'RAKPK' AND noteno >= 98000 THEN '' ELSE restruct END AS restruct, "
  f"CASE WHEN {_AGENCY} AND akpk_status = 'RAKPK' AND noteno >= 98000 THEN akpk_status ELSE rrtag END AS rrtag",
  f"CASE WHEN NOT coalesce({_HP}, false) AND acctstat <> 'S' AND nurs_tag = 'K' THEN 'K' ELSE acctstat END AS acctstat, "
  f"CASE WHEN NOT coalesce({_HP}, false) AND acctstat <> 'S' AND nurs_tag = 'K' THEN nurs_tagdt ELSE assessed END AS assessed_on",
  f"CASE WHEN acctstat = 'S' THEN 'S' WHEN facility IN (34331, 34332) THEN "
  f"  CASE WHEN manual_rr_dt <= {_REPT} AND ((manual_rr_tag IN ('UAJ', 'MAJ') AND {_REPT} <= last_day(manual_rr_dt + to_months(5))) "
  f"       OR (manual_rr_tag IN ('UBJ', 'MBJ', 'FJ', 'MJ') AND {_REPT} <= last_day(manual_rr_dt + to_months(23)))) THEN 'J' ELSE acctstat END "
  f"WHEN akpk_ra_start <= {_REPT} AND regexp_matches(akpk_ra_tag, '^..[1-9]') AND ((left(akpk_ra_tag, 2) IN ('AU', 'CU') AND {_REPT} <= last_day(akpk_ra_start + to_months(5))) "
  f"       OR (left(akpk_ra_tag, 2) IN ('BU', 'DU', 'AF') AND {_REPT} <= last_day(akpk_ra_end))) THEN 'J' ELSE acctstat END AS acctstat")}"""


STATUS_SQL = f"""{LOAN_BOOK_SQL},
{status_steps('book')}"""
STATUS_COLUMNS = ["acctno", "acctstat", "impaired", "classifi", "complyind", "oldrracc", "arrears", "instalm", "nodays", "xnodays"]
STATUS_MONEY = ["undrawn", "outstand", "balance", "curbal", "interdue", "feeamt"]


@register("account_status", f"""
WITH {STATUS_SQL}
SELECT {', '.join(STATUS_COLUMNS)}, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in STATUS_MONEY)} FROM done
""")
def account_status(spark, sf):
    out = AC.loan_status(loan_book(spark, sf), REPORT_DATE)
    return out.select(*STATUS_COLUMNS, *[F.col(c).cast("double").alias(c) for c in STATUS_MONEY])


@register("overdraft_status", f"""
WITH {LOAN_BOOK_SQL}
SELECT acctno, CASE WHEN s THEN 'S' WHEN off AND wostat = 'W' AND NOT coalesce(write_down_bal > 0, false) THEN 'W' WHEN off AND wostat IN ('W', 'P') THEN 'P'
                    WHEN off AND wostat = 'C' THEN 'X' ELSE 'O' END AS acctstat,
       CASE WHEN s THEN 0 ELSE arrears END AS arrears, CASE WHEN s THEN 0 ELSE instalm END AS instalm, CASE WHEN s THEN 0 ELSE nodays END AS nodays
FROM (SELECT *, 3 AS arrears, billcnt AS instalm, coalesce(product BETWEEN 30 AND 34, false) AS off, coalesce((
        (coalesce(apprlimt, 0) = 0 AND coalesce(round(outstand) <= 0, false) AND (coalesce(round(previous_outstand) > 0, false) OR coalesce(previous_limit > 0, false)))
        OR (closed_on IS NOT NULL AND coalesce(openind IN ('B', 'C', 'P'), false)))
        AND (NOT (coalesce(riskcode IN ('1', '2', '3', '4'), false) OR coalesce(product BETWEEN 30 AND 34, false)) OR coalesce(openind IN ('B', 'C', 'P'), false)), false) AS s FROM book)
""")
def overdraft_status(spark, sf):
    book = loan_book(spark, sf).withColumns({"arrears": F.lit(3), "instalm": F.col("billcnt")})
    out = compile_rules(book, AC.overdraft_status_rules(), types={"acctstat": "string"})
    return out.select("acctno", "acctstat", "arrears", "instalm", "nodays")


@register("risk_class", f"""
WITH d AS (SELECT o_orderkey, o_totalprice, date_diff('day', CAST(o_orderdate AS DATE), DATE '{REPORT_DATE}') AS days,
                  CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'P' WHEN '2' THEN 'F' END AS npl,
                  CASE WHEN o_custkey % 7 = 6 THEN NULL WHEN o_custkey % 7 = 5 THEN ' ' ELSE CAST(o_custkey % 7 AS VARCHAR) END AS rating,
                  CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS stat, CASE WHEN o_custkey % 2 = 0 THEN 34371 ELSE 34111 END AS fac FROM orders)
SELECT o_orderkey, CAST(days AS INTEGER) AS days,
  CASE WHEN npl = 'P' OR rating IS NULL OR rating = ' ' THEN 'P'
       ELSE CASE rating WHEN '1' THEN 'C' WHEN '2' THEN 'S' WHEN '3' THEN 'D' WHEN '4' THEN 'B' END END AS risk,
  CASE WHEN o_totalprice < 1 OR npl = 'P' THEN 'P' WHEN days BETWEEN 90 AND 182 OR npl = 'F' THEN 'D' WHEN days > 182 THEN 'B' END AS provision,
  days >= 90 OR COALESCE(npl = 'F', FALSE) AS provision_impaired,
  stat = 3 OR (fac = 34371 AND (days >= 90 OR stat = 5)) AS impaired
FROM d
""")
def risk_class(spark, sf):
    o = load(spark, sf, "orders")
    digit = F.substring("o_orderpriority", 1, 1)
    o = o.withColumns({"days": F.datediff(F.lit(REPORT_DATE).cast("date"), F.col("o_orderdate").cast("date")),
                       "npl": F.when(digit == "1", F.lit("P")).when(digit == "2", F.lit("F")),
                       "rating": F.when(F.col("o_custkey") % 7 == 6, F.lit(None)).when(F.col("o_custkey") % 7 == 5, F.lit(" "))
                                  .otherwise((F.col("o_custkey") % 7).cast("string"))})
    provision, provision_impaired = RK.provision_class(F.col("days"), F.col("npl"), F.col("o_totalprice"))
    facility = F.when(F.col("o_custkey") % 2 == 0, F.lit(34371)).otherwise(F.lit(34111))
    hit = RK.impaired(digit.cast("int"), facility, F.col("days"), F.when(digit == "5", F.lit("I")), F.lit(None).cast("string"))
    return o.select("o_orderkey", "days", RK.risk_class(F.col("rating"), F.col("npl")).alias("risk"), provision.alias("provision"),
                    provision_impaired.alias("provision_impaired"), hit.alias("impaired"))


@register("overdue_days", f"""
WITH {_OL_SQL},
d AS (SELECT o.o_orderkey, o.o_custkey, CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE -1 END AS balance, ol.first_unpaid,
             CASE WHEN o.o_orderstatus <> 'F' THEN CAST(o.o_orderdate AS DATE) + 30 END AS temp FROM orders o
      LEFT JOIN ol ON o.o_orderkey = ol.l_orderkey),
e AS (SELECT *, LEAST(first_unpaid, temp) AS since FROM d),
f AS (SELECT *, CASE WHEN balance <= 0 THEN date_diff('day', since, DATE '{REPORT_DATE}') + 1 END AS od,
             GREATEST(date_diff('day', first_unpaid, DATE '{REPORT_DATE}'), 0) AS base FROM e)
SELECT o_orderkey, CAST(od AS INTEGER) AS overdraft_days,
  CASE WHEN od > 0 THEN CAST(floor(od / 30.0005) AS BIGINT) END AS arrears, CASE WHEN od > 0 THEN CAST(ceil(od / 30.0005) AS BIGINT) END AS instalments,
  CAST(CASE WHEN o_custkey % 50 = 0 THEN 12 WHEN first_unpaid IS NULL THEN (CASE WHEN o_custkey % 10 = 1 THEN 40 ELSE 0 END)
       WHEN o_custkey % 10 = 1 THEN base + 40 ELSE base END AS INTEGER) AS loan_days
FROM f
""")
def overdue_days(spark, sf):
    o = load(spark, sf, "orders").join(_order_lines(spark, sf), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    temp = F.when(F.col("o_orderstatus") != "F", F.date_add(F.col("o_orderdate").cast("date"), 30))
    rd = F.lit(REPORT_DATE).cast("date")
    days, arrears, instalments = RK.overdue_overdraft(F.col("first_unpaid"), temp, F.when(F.col("o_orderstatus") == "F", 1).otherwise(-1), rd)
    loan = RK.overdue_loan(F.col("first_unpaid"), rd, F.when(F.col("o_custkey") % 10 == 1, F.lit(40)), F.lit(98001),
                           F.when(F.col("o_custkey") % 50 == 0, F.lit(12)))
    return o.select("o_orderkey", days.alias("overdraft_days"), arrears.cast("bigint").alias("arrears"),
                    instalments.cast("bigint").alias("instalments"), loan.alias("loan_days"))


_PRODUCT_SQL = "CASE l_linenumber % 4 WHEN 0 THEN 'MCF' WHEN 1 THEN 'FTI' WHEN 2 THEN 'MOF' ELSE NULL END"


@register("accrued_interest", f"""
WITH d AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity = 1 THEN NULL ELSE CAST(l_quantity AS DECIMAL(10,2)) END AS prin,
                  CAST(l_discount AS DECIMAL(10,2)) AS disc, CAST(l_discount AS DECIMAL(10,2)) / 2 AS discf, CAST(l_tax AS DECIMAL(10,2)) AS ytd,
                  {_PRODUCT_SQL} AS product, day(l_shipdate) = 1 AS first_day, month(l_shipdate) = 8 AS issued FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(CASE
    WHEN COALESCE(prin, 0) = 0 OR disc = 0 THEN 0
    WHEN product IN ('MCF', 'MOF') THEN (CASE WHEN issued THEN -discf * 3 WHEN first_day THEN ytd * 3 - disc ELSE 7 END)
    ELSE ytd - disc END AS DOUBLE) AS receivable
FROM d
""")
def accrued_interest(spark, sf):
    li = load(spark, sf, "lineitem")
    dec = lambda c: F.col(c).cast("decimal(10,2)")
    n = F.col("l_linenumber") % 4
    product = F.when(n == 0, F.lit("MCF")).when(n == 1, F.lit("FTI")).when(n == 2, F.lit("MOF"))
    a = RK.interest_receivable(F.when(F.col("l_quantity") != 1, dec("l_quantity")), dec("l_discount"), dec("l_discount") / 2, dec("l_tax"),
                               F.lit(3), product, F.dayofmonth("l_shipdate") == 1, F.month("l_shipdate") == 8, F.lit(7))
    return li.select("l_orderkey", "l_linenumber", a.cast("double").alias("receivable"))


@register("undrawn_amount", f"""
WITH {_OL_SQL}, {LOAN_BOOK_SQL},
t AS (SELECT k.acctno, CASE WHEN k.lmtamt = 0 THEN NULL ELSE CAST(k.balance - 250000 AS DECIMAL(18,2)) END AS lim, ol.drawn, k.apprlimt * 50 AS od_limit, CAST(k.outstand AS DECIMAL(18,2)) AS od_balance,
             k.cavaiamt, k.facility, coalesce(rtrim(k.flag1), '') AS flag1, k.apprlim2 FROM book k LEFT JOIN ol ON k.acctno = ol.l_orderkey),
r AS (SELECT *, CASE WHEN lim IS NULL OR lim < 0 THEN CASE WHEN drawn > 0 THEN drawn ELSE 0 END ELSE lim END AS repaired FROM t)
SELECT acctno, CAST(greatest(repaired - coalesce(drawn, 0), 0) AS DOUBLE) AS undrawn,
  CAST(CASE WHEN od_balance > od_limit OR (od_limit IS NULL AND od_balance IS NOT NULL) THEN 0 WHEN od_balance IS NULL OR od_balance < 0 THEN od_limit ELSE od_limit - od_balance END AS DOUBLE) AS overdraft,
  CAST(greatest(coalesce(CASE WHEN od_balance IS NULL OR od_balance < 0 THEN apprlim2 WHEN flag1 = 'F' THEN 0 WHEN flag1 IN ('P', 'I') THEN cavaiamt
       WHEN facility IN (34331, 34332) THEN 0 ELSE cavaiamt END, 0), 0) AS DOUBLE) AS loan
FROM r
""")
def undrawn_amount(spark, sf):
    """The formulas side by side on the loan book: trade limits (repaired), overdrafts, loans."""
    lines = _order_lines(spark, sf).select(F.col("l_orderkey").alias("acctno"), "drawn")
    book, c = loan_book(spark, sf).join(lines, "acctno", "left"), F.col
    limit = F.when(~F.coalesce(c("lmtamt") == 0, F.lit(False)), (c("balance") - 250000).cast("decimal(18,2)"))
    od = c("outstand").cast("decimal(18,2)")
    return book.select("acctno", RK.undrawn(limit, c("drawn"))[1].cast("double").alias("undrawn"), RK.undrawn_overdraft(c("apprlimt") * 50, od).cast("double").alias("overdraft"),
                       RK.undrawn_loan(c("cavaiamt"), c("facility"), F.coalesce(F.rtrim("flag1"), F.lit("")), od, c("apprlim2")).cast("double").alias("loan"))


@register("collateral_category", f"""
WITH t(cclassc, collater) AS (VALUES {COLLATERAL_PAIRS}),
p AS (SELECT p_partkey, lpad(CAST(p_partkey % 150 AS VARCHAR), 3, '0') AS code FROM part)
SELECT p.p_partkey, p.code, t.collater,
  CASE WHEN t.collater = '10' THEN (CASE WHEN code IN ('032','033','034') THEN 'LAND' WHEN code IN ('035','036','037') THEN 'BUILDING'
                                         WHEN code IN ('038','039','040') THEN 'HOUSE' ELSE 'OTHER' END)
       WHEN t.collater = '30' THEN (CASE WHEN code IN ('004','005') THEN 'MOTOR' ELSE 'OTHER' END)
       WHEN t.collater = '40' THEN (CASE WHEN code IN ('065','066') THEN 'HEAVY' ELSE 'OTHER' END) END AS subtype
FROM p LEFT JOIN t ON p.code = t.cclassc
""")
def collateral_category(spark, sf):
    p = load(spark, sf, "part").select("p_partkey", F.lpad((F.col("p_partkey") % 150).cast("string"), 3, "0").alias("code"))
    return RC.collateral_category(p, "code").select("p_partkey", "code", "collater", "subtype")


_F10 = "(110,111,112,113,114,115,116,117,118,119,120,122,126,141,142,143,127,129,139,140,170,172,181,194,195,196)"
_F51 = """(6,7,61,200,201,204,205,209,210,211,212,214,215,219,220,225,226,300,301,302,304,305,309,310,315,320,325,330,335,340,345,350,355,356,357,358,
 362,363,364,365,391,504,505,506,509,510,515,516,900,901,902,903,904,905,909,914,915,919,920,950,951)"""
_F99 = "(500,517,518,519,520,521,522,523,524,525,526,527,528,529,532,530,555,556,559,560,561,564,565,566,567,568,569,570,573)"
_FX = "loantype IN (991, 994)"


FUND_SQL = f"""CASE WHEN loantype IN (521,522,523,528) OR ({_FX} AND pzipcode IN (521,522,523,528)) THEN '99'
       WHEN loantype IN (555,556) OR ({_FX} AND pzipcode IN (555,556)) THEN '18' WHEN loantype = 561 OR ({_FX} AND pzipcode = 561) THEN '16'
       WHEN loantype IN (568,570,532,533,573,574) OR ({_FX} AND pzipcode IN (568,570,573)) THEN '14'
       WHEN loantype IN (559,560,567) OR ({_FX} AND pzipcode IN (559,560,567)) THEN '12'
       WHEN loantype IN (170,564,565) OR ({_FX} AND pzipcode IN (170,564,565)) THEN '11' WHEN loantype = 566 OR ({_FX} AND pzipcode = 566) THEN '10'
       ELSE '00' END"""
CONCEPT_SQL = f"""CASE WHEN loantype IN {_F99} OR (loantype IN (991,992,994,995) AND pzipcode IN {_F99}) THEN 99
       WHEN loantype IN (227,228,230,231,232,233,234,235,236,237,238,239,240,241,242,243,359,361,531,906,907) THEN 60
       WHEN loantype IN (4,5,15,20,25,26,27,28,29,30,31,32,33,34,60,62,63,70,71,72,73,74,75,76,77,78,360,380,381,390,700,705,993,996) THEN 59
       WHEN loantype IN (910,925) OR (loantype IN (992,995) AND pzipcode IN (910,925)) THEN 52
       WHEN loantype IN {_F51} OR (loantype IN (981,982,994,995) AND pzipcode IN {_F51}) THEN 51
       WHEN loantype IN (135,136,138,182) OR (loantype IN (982,985) AND pzipcode IN (135,136)) THEN 26
       WHEN loantype = 193 THEN 18 WHEN loantype IN (128,130,131,132,983) THEN 16
       WHEN loantype = 180 OR (loantype IN (981,982,984,985) AND pzipcode = 180) THEN 13
       WHEN loantype IN {_F10} OR (loantype IN (981,982,984,985) AND pzipcode IN {_F10}) OR loantype IN (124,145,461) THEN 10 ELSE 99 END"""
SYNDICATE_SQL = f"""CASE WHEN loantype IN (180,914,915,919,920,925,950,951,953) THEN 'Y' ELSE 'N' END"""
@register("scheme_codes", f"""
WITH {LOAN_BOOK_SQL}
SELECT acctno, loantype,
  {FUND_SQL} AS specialf,
  {CONCEPT_SQL} AS fconcept,
  {SYNDICATE_SQL} AS syndicat
FROM book
""")
def scheme_codes(spark, sf):
    out = compile_rules(loan_book(spark, sf), AC.scheme_rules(), types={"specialf": "string", "fconcept": "int", "syndicat": "string"})
    return out.select("acctno", "loantype", "specialf", "fconcept", "syndicat")


@register("disburse_repay_split", f"""
WITH {TF.FEEDS_SQL}, {TF.NETTED_SQL}
SELECT acctno, transref, CAST(sum(disburse) AS DOUBLE) AS disburse, CAST(sum(disbursefx) AS DOUBLE) AS disbursefx, CAST(sum(repaid) AS DOUBLE) AS repaid,
       CAST(sum(repaid) FILTER (kind = 'M') AS DOUBLE) AS repaidprin, CAST(sum(repaidfx) FILTER (kind = 'M') AS DOUBLE) AS repaidprinfx
FROM netted GROUP BY 1, 2
""")
def disburse_repay_split(spark, sf):
    moves = TR.netted_movements(TR.ledger_transactions(TF.transactions(spark, sf), TF.END), TF.START, TF.END)
    money = ["disburse", "disbursefx", "repaid", "repaidprin", "repaidprinfx"]
    return TR.disburse_repay(moves).select("acctno", "transref", *[F.col(c).cast("double").alias(c) for c in money])


TIED_SQL = """
ba AS (SELECT *, row_number() OVER (PARTITION BY transref ORDER BY dailyno) AS k FROM daily WHERE outstand > 0 AND liabcode IN ('BAI', 'BAP', 'BAS', 'BAE')),
ce AS (SELECT *, row_number() OVER (PARTITION BY transref ORDER BY certid) AS k FROM cert),
one AS (SELECT ba.*, ce.certid FROM ba JOIN ce USING (transref, k)),
ba2 AS (SELECT * EXCLUDE (k), row_number() OVER (PARTITION BY branch, outstand, matdate ORDER BY dailyno) AS k FROM ba WHERE dailyno NOT IN (SELECT dailyno FROM one)),
ce2 AS (SELECT *, row_number() OVER (PARTITION BY branch, fcvalue, matdate ORDER BY certid) AS k2 FROM ce WHERE certno IS NOT NULL AND certid NOT IN (SELECT certid FROM one)),
picked AS (SELECT dailyno, certid, 1 AS match_pass FROM one UNION ALL
           SELECT ba2.dailyno, ce2.certid, CASE WHEN ce2.certid IS NOT NULL THEN 2 END FROM ba2 LEFT JOIN ce2
           ON ba2.branch = ce2.branch AND ba2.outstand = ce2.fcvalue AND ba2.matdate = ce2.matdate AND ba2.k = ce2.k2),
tied AS (SELECT d.* REPLACE (CASE WHEN p.dailyno IS NULL THEN d.outstand WHEN c.certno IS NULL THEN 0 ELSE c.fcvalue - c.unearned END AS outstand),
                CASE WHEN d.outstand > 0 THEN CASE WHEN p.dailyno IS NOT NULL THEN 'BA' ELSE 'TB' END ELSE 'NB' END AS kind, c.certno, p.match_pass,
                CASE WHEN p.dailyno IS NOT NULL THEN CASE WHEN c.certno IS NULL THEN 0 ELSE c.fcvalue - c.unearned END
                     WHEN d.outstand > 0 THEN CASE WHEN d.dirctind = 'D' THEN d.outstand ELSE 0 END END AS balance,
                CASE WHEN p.dailyno IS NOT NULL THEN CASE WHEN coalesce(rtrim(c.utrdf), '') = '' THEN 'D' ELSE c.utrdf END END AS utrdf
         FROM daily d LEFT JOIN picked p USING (dailyno) LEFT JOIN cert c ON p.certid = c.certid)"""


@register("balance_kind_split", f"""
WITH {TF.FEEDS_SQL}, {TIED_SQL}
SELECT dailyno, kind, certno, match_pass, utrdf, CAST(outstand AS DOUBLE) AS outstand, CAST(balance AS DOUBLE) AS balance FROM tied
""")
def balance_kind_split(spark, sf):
    out = TR.tied_balances(TF.daily(spark, sf), TF.certificates(spark, sf), ["dailyno"], ["certid"])
    return out.select("dailyno", "kind", "certno", "match_pass", "utrdf", F.col("outstand").cast("double").alias("outstand"), F.col("balance").cast("double").alias("balance"))


@register("restructure_tag", f"""
WITH {STATUS_SQL}
SELECT acctno, restruct, rrtag, cyc, completed_on, ends_on, assessed_on FROM done
""")
def restructure_tag(spark, sf):
    return AC.loan_status(loan_book(spark, sf), REPORT_DATE).select("acctno", "restruct", "rrtag", "cyc", "completed_on", "ends_on", "assessed_on")


_LOAN_TYPE = "CASE o_custkey % 4 WHEN 0 THEN 700 WHEN 1 THEN 146 ELSE 200 END"


@register("release_amount", f"""
WITH {_OL_SQL},
j AS (SELECT o.o_orderkey, {_LOAN_TYPE} AS kind, CASE WHEN o_orderstatus = 'O' THEN 1 WHEN o_orderstatus = 'P' THEN 0 END AS commitment,
             CAST(o.o_totalprice AS DECIMAL(18,2)) AS price, ol.drawn FROM orders o LEFT JOIN ol ON o.o_orderkey = ol.l_orderkey)
SELECT o_orderkey, CAST(CASE WHEN kind = 700 THEN price - 100 WHEN commitment > 0 AND kind <> 146 THEN price - GREATEST(COALESCE(drawn, 0) - 50000, 0)
       WHEN commitment > 0 THEN drawn ELSE price END AS DOUBLE) AS released
FROM j
""")
def release_amount(spark, sf):
    o = load(spark, sf, "orders").join(_order_lines(spark, sf), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    kind = F.when(F.col("o_custkey") % 4 == 0, 700).when(F.col("o_custkey") % 4 == 1, 146).otherwise(200)
    commitment = F.when(F.col("o_orderstatus") == "O", 1).when(F.col("o_orderstatus") == "P", 0)
    price = F.col("o_totalprice").cast("decimal(18,2)")
    rel = RK.release_amount(kind, commitment, price - 100, price, F.col("drawn") - 50000, F.col("drawn"), price)
    return o.select("o_orderkey", rel.cast("double").alias("released"))


_OWN = ("('D','X','L','D1','D2','D3','D4','D5','D6','D7','D8','D9','X1','X2','X3','X4','X5','X6','X7','X8','X9','L1','L2','L3','L4','L5','L6','L7','L8','L9',"
        "'O','P','R1','R2','R3','E','T','W','E1','E2','E3','T1','T2','T3')")


TAG_STEPS = f"""tf AS (SELECT *, coalesce(rtrim(nurs_tag) IN {_OWN}, false) AS own, coalesce(regexp_full_match(rtrim(tfa_nurs_tag), '[CGMNQK][1-9]'), false) AS further FROM {{src}}),
tagged AS (SELECT *, CASE WHEN own AND further THEN CASE WHEN nurs_tagdt IS NOT NULL AND (tfa_nurs_tag_dt IS NULL OR nurs_tagdt > tfa_nurs_tag_dt) THEN 1 ELSE 2 END
                     WHEN own THEN 1 WHEN further THEN 2 END AS pick FROM tf)"""


@register("latest_tag", f"""
WITH {LOAN_BOOK_SQL},
{TAG_STEPS.format(src='book')}
SELECT acctno, CASE WHEN facility IN (34331, 34332) THEN akpk_status WHEN pick = 1 THEN rtrim(nurs_tag) WHEN pick = 2 THEN rtrim(tfa_nurs_tag) END AS tag,
       CASE WHEN facility IN (34331, 34332) THEN issued WHEN pick = 1 THEN nurs_tagdt WHEN pick = 2 THEN tfa_nurs_tag_dt END AS tag_date
FROM tagged
""")
def latest_tag(spark, sf):
    book, c = loan_book(spark, sf), F.col
    tag, day = AC.latest_tag(c("facility"), c("akpk_status"), c("issued"), c("nurs_tag"), c("nurs_tagdt"), c("tfa_nurs_tag"), c("tfa_nurs_tag_dt"))
    return book.select("acctno", tag.alias("tag"), day.alias("tag_date"))
