"""Register files on derived feeds (L13, L15-L18): every file's records, compared character by character."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import registers as PR
from ..rules import registers as RG
from . import load, register
from ._common import REPORT_DATE
from ._loan_book import DATED, DEALT, LOAN_BOOK_SQL, book_of, dealt
from ._records import record_sql
from .rules import CONCEPT_SQL, FACILITY_SQL, FUND_SQL, LOAN_PRICING_SQL, OVERDRAFT_PRICING_SQL, SYNDICATE_SQL, TAG_STEPS, status_steps

OD_BASE = 3_000_000_000
_REPT = f"DATE '{REPORT_DATE}'"


def register_book(spark, sf):
    """The loan book with overdrafts in their own range of accounts, dealt by account as the assembly job (L14) leaves it.

    The orders are dealt, and the accounts derived from them where they arrive: a table of few
    row groups is read in few tasks.  The count is given, since the few bytes of an order say
    nothing of the work on its account (adaptive coalescing goes by them).
    """
    acctno = F.col("o_orderkey") + F.when(dealt(*DEALT["acty"]) == "OD", F.lit(OD_BASE)).otherwise(F.lit(0))
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", acctno.alias("acctno"))
    return book_of(orders.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "acctno"), F.col("acctno"))


def prior_overdrafts(book):
    """Last period's overdrafts: every third of them is gone today."""
    moved = F.col("acctno") + F.when(F.col("acctno") % 3 == 0, F.lit(1_000_000)).otherwise(F.lit(0))
    return book.where("acty = 'OD'").select(moved.alias("acctno"), "branch", "noteno", "balance", F.col("balance").alias("outstand"), "repaid", "costctr", "aano")


_MONEY = ["outstand", "undrawn", "curbal", "interdue", "feeamt", "repaid", "lmtamt", "totiis", "limtcurr"]
_SHARED = ["acctno", "acty", "branch", "loantype", "noteno", "commno", "aano", "ind", "curcode", "forate", "facility", "faccode", "acctstat", "impaired", "classifi", "restruct",
           "rrtag", "cyc", "completed_on", "assessed_on", "foreclosed_on", "oldrracc", "arrears", "instalm", "nodays", "xnodays", "outstand", "curbal", "interdue", "feeamt",
           "undrawn", "typeprc", "totiis", "specialf", "fconcept", "syndicat", *["paidind", "modeldes", "user5", "oldrr", "borstat", "pzipcode", "flag1", "lmo_tag", "akpk_status",
           "nurs_tag", "nurs_tagdt", "tfa_nurs_tag", "tfa_nurs_tag_dt", "issued", "lsttrncd", "loanstat", "wostat", "gp3ind", "nplind", "leg", "delqcd", "costctr", "repaid",
           "mtd_repay_type10_amt", "mtd_repay_type20_amt", "mtd_repay_type30_amt", "lmtamt", "cavaiamt", "lmtindex", "odplan", "riskcode", "industrial_sector_cd", "exoddt",
           "apprlimt", "balance"]]
# the fields of the layouts that the derived accounts have
_OWN = {c: c for c in _SHARED if c not in ("acty", "ind", "forate", "tfa_nurs_tag", "tfa_nurs_tag_dt", "exoddt", "apprlimt", "balance")}
_FIELDS = {**_OWN, "ficode": "branch", "apcode": "loantype", "report": _REPT, "acctind": "CASE WHEN acty = 'OD' THEN 'D' ELSE 'L' END", "exceeded": "exoddt",
           "mtd_repaid_amt": "coalesce(repaid_raw, 0)", "ratag": "ratag", "ratag_date": "ratag_date", "limtcurr": "limtcurr"}
_OD_SINCE = "least(exoddt, tempoddt)"
_INACTIVE = "coalesce(product BETWEEN 30 AND 34, false)"

LOAN_REGISTER_SQL = f"""{LOAN_BOOK_SQL}, {FACILITY_SQL},
b2 AS (SELECT b.* REPLACE (CASE WHEN acty = 'OD' THEN b.acctno + {OD_BASE} ELSE b.acctno END AS acctno, f.facility AS facility, coalesce(f.code, f.facility) AS faccode,
              CASE WHEN coalesce(curcode, '') IN ('MYR', '') THEN curbal ELSE round(curbal * CAST(forate AS DECIMAL(18,6)), 2) END AS curbal,
              CASE WHEN coalesce(curcode, '') IN ('MYR', '') THEN feeamt ELSE round(feeamt * CAST(forate AS DECIMAL(18,6)), 2) END AS feeamt),
              CAST(totiis AS DECIMAL(18,2)) AS totiis_d FROM book b JOIN f ON b.acctno = f.acctno),
loans AS (SELECT * REPLACE (balance AS outstand) FROM b2 WHERE acty <> 'OD'),
{status_steps('loans')},
ln AS (SELECT *, {LOAN_PRICING_SQL.replace('base_rate', 'ntindex IN (1, 30)').replace('base_fin', 'ntindex IN (38, 39)')} AS typeprc,
              {FUND_SQL} AS specialf, {CONCEPT_SQL} AS fconcept, {SYNDICATE_SQL} AS syndicat FROM done),
o1 AS (SELECT * REPLACE (product AS loantype, 0 AS noteno, -curbal AS curbal, {', '.join(f"coalesce(rtrim({c}), '') AS {c}" for c in ('flag1', 'lmo_tag', 'paidind', 'borstat', 'modeldes', 'user5', 'oldrr', 'restruct_feed', 'akpk_status', 'nurs_tag', 'manual_rr_tag', 'akpk_ra_tag'))}),
              CASE WHEN coalesce(curbal, -1) <= 0 AND {_OD_SINCE} IS NOT NULL THEN date_diff('day', {_OD_SINCE}, {_REPT}) + 1 ELSE 0 END AS days FROM b2 WHERE acty = 'OD'),
o2 AS (SELECT * REPLACE (curbal AS outstand, CASE WHEN coalesce(curbal, -1) <= 0 THEN 0 ELSE interdue END AS interdue, CASE WHEN coalesce(curbal, -1) <= 0 THEN 0 ELSE feeamt END AS feeamt),
              {_INACTIVE} AND coalesce(write_down_bal, 0) <> 0 AS down FROM o1),
o3 AS (SELECT * REPLACE (CASE WHEN down THEN write_down_bal ELSE outstand - coalesce(interdue, 0) - coalesce(feeamt, 0) END AS curbal, CASE WHEN down THEN write_down_bal ELSE outstand END AS outstand,
                         CASE WHEN down THEN 0 ELSE interdue END AS interdue, CASE WHEN down THEN 0 ELSE feeamt END AS feeamt, CASE WHEN down THEN 0 ELSE totiis_d END AS totiis_d) FROM o2),
o4 AS (SELECT *, coalesce(((coalesce(apprlimt, 0) = 0 AND coalesce(round(outstand) <= 0, false) AND (coalesce(round(previous_outstand) > 0, false) OR coalesce(previous_limit > 0, false)))
                  OR (closed_on IS NOT NULL AND coalesce(openind IN ('B', 'C', 'P'), false)))
                  AND (NOT (coalesce(riskcode IN ('1', '2', '3', '4'), false) OR {_INACTIVE}) OR coalesce(openind IN ('B', 'C', 'P'), false)), false) AS gone FROM o3),
od AS (SELECT * EXCLUDE (nodays) REPLACE (CASE WHEN balance < 0 THEN apprlimt WHEN apprlimt IS NULL OR balance > apprlimt THEN 0 ELSE apprlimt - balance END AS cavaiamt),
              CASE WHEN gone THEN 'S' WHEN {_INACTIVE} AND wostat = 'W' AND NOT coalesce(write_down_bal > 0, false) THEN 'W' WHEN {_INACTIVE} AND wostat IN ('W', 'P') THEN 'P'
                   WHEN {_INACTIVE} AND wostat = 'C' THEN 'X' ELSE 'O' END AS acctstat,
              CASE WHEN TRY_CAST(riskcode AS INTEGER) > 0 OR {_INACTIVE} THEN 'Y' ELSE 'N' END AS impaired,
              CASE WHEN riskcode IN ('1', '2', '3', '4') THEN ['C', 'S', 'D', 'B'][CAST(riskcode AS INTEGER)] WHEN {_OD_SINCE} IS NULL THEN 'P' END AS classifi,
              '' AS restruct, '' AS rrtag, 0 AS cyc, CAST(NULL AS DATE) AS completed_on, CAST(NULL AS DATE) AS assessed_on, CAST(NULL AS VARCHAR) AS oldrracc,
              CASE WHEN gone OR days <= 0 THEN 0 ELSE CAST(floor(days / 30.0005) AS INTEGER) END AS arrears, CASE WHEN gone OR days <= 0 THEN 0 ELSE CAST(ceil(days / 30.0005) AS INTEGER) END AS instalm,
              CASE WHEN gone THEN 0 ELSE days END AS nodays, 0 AS xnodays, {OVERDRAFT_PRICING_SQL} AS typeprc,
              CAST(NULL AS VARCHAR) AS specialf, CAST(NULL AS INTEGER) AS fconcept, CAST(NULL AS VARCHAR) AS syndicat FROM o4),
both_kinds AS (SELECT {', '.join(c for c in dict.fromkeys(_SHARED) if c not in ('totiis', 'cavaiamt'))}, cavaiamt, totiis_d AS totiis FROM ln
         UNION ALL SELECT {', '.join('cavaiamt AS undrawn' if c == 'undrawn' else c for c in dict.fromkeys(_SHARED) if c not in ('totiis', 'cavaiamt'))}, NULL, totiis_d FROM od),
{TAG_STEPS.format(src='both_kinds')},
every AS (SELECT t.* REPLACE ({', '.join(f"round(t.{c} * 100) AS {c}" for c in ('outstand', 'curbal', 'interdue', 'feeamt', 'totiis', 'lmtamt'))}, round(greatest(coalesce(t.undrawn, 0), 0) * 100) AS undrawn,
                 t.repaid * 100 AS repaid), t.repaid AS repaid_raw, CASE WHEN coalesce(t.apprlimt, 0) <> 0 THEN t.apprlimt * 100 END AS limtcurr, b.cavaiamt AS avail,
                 CASE WHEN t.facility IN (34331, 34332) THEN t.akpk_status WHEN pick = 1 THEN rtrim(t.nurs_tag) WHEN pick = 2 THEN rtrim(t.tfa_nurs_tag) END AS ratag,
                 CASE WHEN t.facility IN (34331, 34332) THEN t.issued WHEN pick = 1 THEN t.nurs_tagdt WHEN pick = 2 THEN t.tfa_nurs_tag_dt END AS ratag_date
          FROM tagged t JOIN b2 b ON t.acctno = b.acctno),
gone_od AS (SELECT p.acctno + CASE WHEN p.acctno % 3 = 0 THEN 1000000 ELSE 0 END AS acctno, p.branch, p.noteno, p.balance AS outstand, p.repaid * 100 AS repaid, p.costctr, p.aano
            FROM b2 p WHERE p.acty = 'OD' AND p.acctno + CASE WHEN p.acctno % 3 = 0 THEN 1000000 ELSE 0 END NOT IN (SELECT acctno FROM every WHERE acctno BETWEEN 3000000000 AND 3999999999)),
acc AS (SELECT * FROM every WHERE acty = 'OD' OR (commno = 0 AND ind = 'A') OR (commno > 0 AND ind = 'B') OR coalesce(rtrim(aano), '') <> '')"""
_RECORDS = {**_FIELDS, "cavaiamt": "avail"}


@register("pl_loan_register", f"""
WITH {LOAN_REGISTER_SQL}
SELECT acctno, 'sub_account' AS file, {record_sql(RG.SUB_ACCOUNT, _RECORDS)} AS record FROM every
UNION ALL SELECT acctno, 'credit_position', {record_sql(RG.CREDIT_POSITION, _RECORDS)} FROM every
UNION ALL SELECT acctno, 'provision', {record_sql(RG.PROVISION, _RECORDS)} FROM every
          WHERE (impaired = 'Y' OR coalesce(rtrim(gp3ind), '') <> '') AND NOT coalesce(loantype IN (128, 130, 380, 381, 700, 705, 983, 993, 996), false)
UNION ALL SELECT acctno, 'legal_action', {record_sql(RG.LEGAL_ACTION, _RECORDS)} FROM every WHERE leg = 'A'
{' '.join(f"UNION ALL SELECT acctno, 'repayment', {record_sql(RG.repayment(k), {**_RECORDS, 'branch': 'branch'})} FROM every WHERE acctno BETWEEN 3000000000 AND 3999999999 AND repaid > 0 AND mtd_repay_type{k}_amt > 0" for k in RG.REPAYMENT_KINDS)}
UNION ALL SELECT acctno, 'settled_overdraft', {record_sql(RG.SETTLED_OVERDRAFT, {'acctno': 'acctno', 'noteno': 'noteno', 'report': _REPT, 'outstand': 'outstand', 'arrears': '0', 'instalm': '0',
                                                                            'acctstat': "'S'", 'nodays': '0', 'costctr': 'costctr', 'aano': 'aano', 'repaid': 'repaid'})} FROM gone_od
UNION ALL SELECT acctno, 'account', {record_sql(RG.ACCOUNT, {**_RECORDS, 'fxrate': 'round(forate * 100000)'})} FROM acc
""")
def pl_loan_register(spark, sf):
    """All seven register files (see ``plans.registers.loan_register``)."""
    book = register_book(spark, sf)
    return PR.loan_register(book, prior_overdrafts(book), REPORT_DATE)
