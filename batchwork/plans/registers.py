"""Register jobs: rules on assembled tables, then several fixed-layout files in one pass.

Every job takes tables with the feeds' own column names (missing columns count as missing
values) and returns rows (keys, file, record) for ``sinks.writers.write_files``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import keys as K
from ..rules import account as AC
from ..rules import credit as RK
from ..rules import facility as FC
from ..rules import registers as RG
from ..rules.compiler import ASIDE, compile_rules, ladder, listed, rule, set_aside, within
from ..sinks import writers as W
from ..sources.readers import conform

# The register's minor units: amounts that are multiplied by 100
MINOR = ["outstand", "undrawn", "curbal", "interdue", "feeamt", "biltot", "odxsamt", "repaid", "disburse", "rebate", "lmtamt", "eir_adj", "totiis", "totiisr", "totwof",
         "iisopbal", "spwbamt", "spwof", "spopbal", "spdanah", "sptrans", "spaamt", "ledgbal", "cumrc", "bdr", "cumsc", "woamt", "bdr_mth", "sc_mth", "rc_mth",
         "nai_mth", "cumwosp", "cumwois", "cumnai", "netproc", "totamt", "realisab", "limtcurr", "authorise_limit", "operlimt", "corgamt", "unuseamt"]
HOME_CURRENCY = "MYR"
OVERDRAFT_ACCOUNTS = (3000000000, 3999999999)


# what the rules read of an account, beside the columns of the layouts
ACCOUNT_COLUMNS = """acctno long, acty string, loantype int, product int, noteno int, branch int, commno int, aano string, ind string, curcode string, forate double,
paidind string, write_down_bal decimal(24,2), lsttrncd int, borstat string, modeldes string, user5 string, oldrr string, restruct_feed string, akpk_status string,
nurs_tag string, tfa_nurs_tag string, manual_rr_tag string, akpk_ra_tag string, loanstat int, riskrate string, nplind string, rrcycle string, pzipcode int, ntindex int,
spread double, cfindex int, costfund double, wostat string, openind string, riskcode string, odstatus string, previous_outstand double, previous_limit double, lmtindex int,
lmtrate double, lmtbaser double, fdrcno int, odplan int, billcnt int, mo_instl_arr int, oldnotedayarr int, mordayarr int, flag1 string, lmo_tag string,
cavaiamt decimal(24,2), apprlim2 decimal(24,2), gp3ind string, leg string, delqcd string, costctr int, prodcd string, purpose string, issued date, delivered_on date,
coupon_start date, foreclosed_on date, assessed date, nurs_tagdt date, tfa_nurs_tag_dt date, manual_rr_dt date, akpk_ra_start date, akpk_ra_end date, closed_on date,
bldate date, relief_from date, relief_to date, exoddt date, tempoddt date"""


def with_missing(df: DataFrame, ddl: str) -> DataFrame:
    """``df`` with the columns of ``ddl`` that it lacks, as missing values."""
    from pyspark.sql import types as T
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in T.StructType.fromDDL(ddl).fields if f.name not in df.columns})


def _numbers(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({n: (F.col(n) if n in df.columns else F.lit(None)).cast("decimal(24,2)") for n in names})


def account_rules(rept: str) -> list:
    """Loans and overdrafts in one list: the rules of each kind run in its block."""
    day = f"DATE '{rept}'"
    inactive = listed("product", AC.INACTIVE_PRODUCTS)
    return [
        *within("acty = 'OD'", "_od",
                rule("true", loantype="product", noteno=0, billcnt=0, nodays=0, arrears=0, instalm=0, xnodays=0, restruct="''", rrtag="''", cyc=0,
                     since="least(exoddt, tempoddt)"),
                rule("coalesce(curbal, -1) <= 0 AND since IS NOT NULL", nodays=f"datediff({day}, since) + 1"),
                rule("nodays > 0", arrears="floor(nodays / 30.0005)", instalm="ceil(nodays / 30.0005)"),
                ladder(("riskcode = '1'", {"classifi": "'C'"}), ("riskcode = '2'", {"classifi": "'S'"}), ("riskcode = '3'", {"classifi": "'D'"}),
                       ("riskcode = '4'", {"classifi": "'B'"}), ("odstatus = 'AC' OR since IS NULL", {"classifi": "'P'"})),
                rule("true", impaired=f"CASE WHEN try_cast(riskcode AS int) > 0 OR {inactive} THEN 'Y' ELSE 'N' END", curbal="-curbal"),
                rule("true", outstand="curbal"),
                rule("odintacc > 0", outstand="outstand + odintacc", interdue="coalesce(interdue, 0) + odintacc"),
                rule("coalesce(round(outstand, 2), -1) <= 0", interdue=0, feeamt=0),
                rule("true", curbal="outstand - coalesce(interdue, 0) - coalesce(feeamt, 0)"),
                rule(f"{inactive} AND coalesce(write_down_bal, 0) <> 0", curbal="write_down_bal", outstand="write_down_bal", feeamt=0, interdue=0, totiis=0),
                *AC.overdraft_status_rules(), AC.overdraft_pricing()),
        *within("acty <> 'OD'", "_ln", rule("true", outstand="balance"), *AC.loan_status_rules(rept), AC.loan_pricing(), *AC.scheme_rules()),
    ]


_TYPES = {**AC.STATUS_TYPES, "typeprc": "string", "specialf": "string", "fconcept": "int", "syndicat": "string", "since": "date",
          "outstand": "decimal(24,2)", "curbal": "decimal(24,2)", "interdue": "decimal(24,2)", "feeamt": "decimal(24,2)", "undrawn": "decimal(24,2)",
          "totiis": "decimal(24,2)", "balance": "decimal(24,2)"}


# what ``rated_accounts`` adds after the rules
DERIVED = ["ratag", "ratag_date", "undrawn", "apcode", "ficode", "report", "acctind", "exceeded", "mtd_repaid_amt", "limtcurr", "facility", "faccode"]


def rated_accounts(loans: DataFrame, rept: str) -> DataFrame:
    """L15, first half: amounts in home currency, facility codes, status, pricing, schemes, tags, undrawn amounts, minor units."""
    d = _numbers(with_missing(loans, ACCOUNT_COLUMNS), [*MINOR, "balance", "odintacc", "ccris_instlamt", "apprlimt"]).drop("facility", "faccode")
    columns = [*d.columns, "facility", "faccode"]
    # the wide row passes the lookups and the levels of the rules as one value
    converted = ["curbal", "feeamt", "ccris_instlamt"]
    d = set_aside(d, keep=["loantype", "prodcd", "purpose", *converted], blank=AC.TEXTS)
    home = F.coalesce(F.col(f"{ASIDE}.curcode"), F.lit("")).isin(HOME_CURRENCY, "")
    d = d.withColumns({c: F.when(home, F.col(c)).otherwise(F.round(F.col(c) * F.col(f"{ASIDE}.forate").cast("decimal(18,6)"), 2)) for c in converted})
    d = FC.facility_codes(d)
    d = compile_rules(d, account_rules(rept), types=_TYPES, columns=columns)
    tag, day = AC.latest_tag(F.col("facility"), F.col("akpk_status"), F.col("issued"), F.col("nurs_tag"), F.col("nurs_tagdt"), F.col("tfa_nurs_tag"), F.col("tfa_nurs_tag_dt"))
    overdraft = F.col("acty") == "OD"
    left = F.when(overdraft, RK.undrawn_overdraft(F.col("apprlimt"), F.col("balance"))).otherwise(F.col("undrawn"))
    # a limit counts once per commitment, on its first account
    d = d.withColumns({"ratag": tag, "ratag_date": day, "undrawn": F.greatest(F.coalesce(left, F.lit(0)), F.lit(0)).cast("decimal(24,2)"),
                       "apcode": F.col("loantype"), "ficode": F.when(F.col("loantype").between(800, 899) & (
                           F.col("acctno").between(2000000000, 2999999999) | F.col("acctno").between(8000000000, 8999999999)), F.lit(904)).otherwise(F.col("branch")),
                       "report": F.lit(rept).cast("date"), "acctind": F.when(overdraft, F.lit("D")).otherwise(F.lit("L")), "exceeded": F.col("exoddt"),
                       "mtd_repaid_amt": F.coalesce(F.col("repaid"), F.lit(0)), "limtcurr": F.coalesce(F.nullif("apprlimt", F.lit(0)), F.col("netproc"))})
    # two decimals at most: nothing is left to round
    return d.withColumns({c: (F.col(c) * 100).cast("decimal(24,0)") for c in MINOR})


def loan_register(loans: DataFrame, prior_overdrafts: DataFrame, rept: str) -> DataFrame:
    """The seven register files of a report date; rows (acctno, file, record).

    * every account: sub-account and credit position; impaired or specially provided ones
      that are not hire purchase: provision; those under legal action: legal action;
      overdrafts with repayments: one repayment record per kind with an amount -
      all of them from one array per account, in one pass;
    * overdrafts of the prior period that are gone: settled (J7);
    * per branch, account and application: the account file, with the sum of limits.
    """
    rated = rated_accounts(loans, rept)
    group = ["branch", "acctno", "aano"]
    by_account = {*group, "commno", "noteno", "acty", "ind", "forate", "limtcurr"}
    by_row = {"acty", "loantype", "leg", "gp3ind", "impaired", "repaid"}
    in_files = {f.name for f in RG.layout_schema(*RG.ROW_FILES, RG.ACCOUNT).fields}
    filled = {*loans.columns, *DERIVED, *(c for r in account_rules(rept) for c in r.writes)}
    # the rated accounts are written once: three grains of files read them; what no file reads is left out,
    # and so are layout columns that neither the feed nor a rule fills (the layouts add them again)
    d = W.scratch_table(rated.select(*[c for c in rated.columns if c in by_account | by_row or c in in_files & filled]), "rated-accounts")
    rows = _with(d, RG.layout_schema(*RG.ROW_FILES), ["acty", "loantype"])
    provided = (F.coalesce(F.col("impaired") == "Y", F.lit(False)) | (F.coalesce(F.rtrim("gp3ind"), F.lit("")) != "")) & F.expr(f"NOT {listed('loantype', AC.HIRE_PURCHASE)}")
    files = [("sub_account", None, RG.SUB_ACCOUNT), ("credit_position", None, RG.CREDIT_POSITION), ("provision", provided, RG.PROVISION),
             ("legal_action", F.col("leg") == "A", RG.LEGAL_ACTION)]
    for kind in RG.REPAYMENT_KINDS:
        paid = F.col("acctno").between(*OVERDRAFT_ACCOUNTS) & (F.col("repaid") > 0) & (F.col(f"mtd_repay_type{kind}_amt") > 0)
        files.append(("repayment", paid, RG.repayment(kind)))
    out = W.file_records(rows.withColumn("leg", F.col("leg")), files, ["acctno"])

    gone = K.join_on(K.first_by(prior_overdrafts, "acctno", []), d.where(F.col("acctno").between(*OVERDRAFT_ACCOUNTS)).select("acctno"), "acctno", "left_anti")
    gone = _numbers(gone, ["outstand", "undrawn", "biltot", "odxsamt", "repaid", "disburse"])
    gone = gone.withColumns({"acctstat": F.lit("S"), "arrears": F.lit(0), "instalm": F.lit(0), "nodays": F.lit(0), "report": F.lit(rept).cast("date"),
                             "repaid": F.col("repaid") * 100, "disburse": F.col("disburse") * 100})
    settled = W.file_records(_with(gone, RG.layout_schema(RG.SETTLED_OVERDRAFT)), [("settled_overdraft", None, RG.SETTLED_OVERDRAFT)], ["acctno"])

    whole = (F.col("acty") == "OD") | ((F.col("commno") == 0) & (F.col("ind") == "A")) | ((F.col("commno") > 0) & (F.col("ind") == "B")) | (F.coalesce(F.rtrim("aano"), F.lit("")) != "")
    by_account |= {f.name for f in RG.layout_schema(RG.ACCOUNT).fields}
    counted = _first_of_key(d, loans, rept, [*group, "commno", "noteno"], [c for c in d.columns if c in by_account]).where(F.coalesce(whole, F.lit(False)))
    limits = counted.groupBy(*group).agg(F.sum("limtcurr").alias("limtcurr"))
    first = K.join_on(K.first_by(counted.drop("limtcurr"), group, ["commno", "noteno"]), limits, group)
    first = first.withColumn("fxrate", F.round(F.col("forate") * 100000).cast("decimal(24,0)"))
    accounts = W.file_records(_with(first, RG.layout_schema(RG.ACCOUNT)), [("account", None, RG.ACCOUNT)], ["acctno"])
    return out.unionByName(settled).unionByName(accounts)


def _first_of_key(d: DataFrame, loans: DataFrame, rept: str, keys: list[str], columns: list[str]) -> DataFrame:
    """``columns`` of the first rated account of each key: ``K.first_by(rated_accounts(loans, rept), keys, [])``.

    The order is over all columns of the rated accounts, but only rows of a repeated key need it:
    accounts with such a key (few or none in a register) are rated once more and sorted whole, and
    the others come from ``d``, the written columns.  The repeated keys are written, so that the
    joins on them are planned by their size.
    """
    repeated = W.scratch_table(K.duplicate_keys(d, keys).drop("n"), "repeated-keys")
    if repeated.isEmpty():
        return d.select(*columns)
    again = rated_accounts(K.join_on(loans, repeated.select("acctno").distinct(), "acctno", "left_semi"), rept)
    first = K.first_by(K.join_on(again, repeated, keys, "left_semi"), keys, [])
    return K.join_on(d.select(*columns), repeated, keys, "left_anti").unionByName(first.select(*columns))


def _with(df: DataFrame, schema, extra: list[str] | None = None) -> DataFrame:
    """The layout's columns (missing ones added), and others that conditions read."""
    have = {f.name for f in schema.fields}
    keep = [c for c in (extra or []) if c not in have]
    others = [c for c in ("leg", "gp3ind", "impaired", "repaid") if c in df.columns and c not in have and c not in keep]
    shaped = conform(df.withColumns({f"__keep_{c}": F.col(c) for c in [*keep, *others]}), _extended(schema, df, [*keep, *others]))
    return shaped.withColumnsRenamed({f"__keep_{c}": c for c in [*keep, *others]})


def _extended(schema, df: DataFrame, names: list[str]):
    from pyspark.sql import types as T
    return T.StructType([*schema.fields, *[T.StructField(f"__keep_{n}", df.schema[n].dataType) for n in names]])
