"""Trade bills: balances tied to the ledger, disbursements and repayments netted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import row_sum
from ..operators import joins as J
from ..operators import keys as K
from .compiler import listed

# Ledger codes of interest receivable, codes that carry no balance
INTEREST_CODES = ["01010", "01020", "01070"]
NO_BALANCE_CODES = ["00620", "00560", "00530", "00640", "00660", "00120", "00140", "00160", "00590", "00470", "00490", "00440", "00420", "00340"]
# Codes left out of the transactions; of money paid out; of principal repaid; of movements;
# of movements that undo others; the code that they undo
DROPPED_CODES = ["CONI", "CONM", "CONP", "DDA", "HOE", "IBS"]
PAID_OUT, PRINCIPAL = ["08000", "09000"], ["01010", "01140"]
MOVEMENTS = ["00110", "00130", "00150", "00170", "00210", "00230", "00240", "00250", "00260", "00270", "00280", "00510", "00540", "00600", "00800",
             "00810", "00820", "00830", "00290", "00300", "00310"]
UNDOING = ["00110", "00130", "00150", "00800", "00810", "00820", "00830", "00290", "00300", "00310", "00210", "00230", "00240", "00250", "00260", "00270", "00280"]
UNDONE, HOME_CURRENCY = "00600", "MYR"
# Liability codes of accepted bills
BILL_CODES = ["BAI", "BAP", "BAS", "BAE"]


def balance_with_interest(detail: DataFrame) -> DataFrame:
    """Ledger rows that carry a balance, each with the interest receivable of its
    (acctno, liabcode, transref) added; interest that does not occur leaves the balance."""
    keys = ["acctno", "liabcode", "transref"]
    interest = detail.where(F.col("glmnemo").isin(INTEREST_CODES)).groupBy(*keys).agg(F.sum("gltrntot").alias("intrecv"))
    rows = detail.where(F.col("glmnemo").startswith("00") & ~F.col("glmnemo").isin(NO_BALANCE_CODES))
    j = K.join_on(rows, interest, keys, "left")
    return j.withColumn("balance", F.when(F.col("intrecv").isNotNull(), row_sum("gltrntot", "intrecv")).otherwise(F.col("gltrntot"))) \
            .withColumn("curbal", F.col("gltrntot"))


def ledger_transactions(txn: DataFrame, asof: str) -> DataFrame:
    """Transactions up to a day with their ledger code written out (F10) and, where the payment
    group names one, its reference."""
    code = F.col("glmnemo")
    kept = txn.where(F.expr(f"NOT {listed('glmnemo', DROPPED_CODES)}") & ~F.coalesce(code.startswith("9"), F.lit(False)) & (F.col("issued") <= F.lit(asof).cast("date")))
    group = F.rtrim(F.coalesce("paygrno", F.lit("")))
    return kept.withColumn("glmnemo", F.when(code.startswith("0"), F.concat(code, F.lit("0"))).otherwise(code)).withColumn("transref", F.when(group != "", F.substring("paygrno", 1, 7)).otherwise(F.col("transref")))


def netted_movements(ledger: DataFrame, start: str, end: str) -> DataFrame:
    """J18 by rule: the period's movements, each as ``disburse`` or ``repaid``, after three passes.

    * A disbursement under the undone code goes with the undoing repayments of its account, amount and day.
    * A repayment goes where its reference, amount and day were paid out; the paying row stays aside.
    * Repaid principal (summed per account and reference) counts only where nothing was paid out on the reference.

    ``kind``: M movement, P repaid principal.
    """
    t = ledger.where(F.col("issued").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    foreign, up = ~F.col("currency").eqNullSafe(F.lit(HOME_CURRENCY)), F.col("transamt") > 0
    paid_out = t.where(F.col("glmnemo").isin(PAID_OUT)).select(F.lit("N").alias("kind"), "acctno", "transref", "issued", "glmnemo", F.col("transamt").alias("amount"),
                                                              F.lit(None).cast("decimal(18,2)").alias("disburse"), F.lit(None).cast("decimal(18,2)").alias("repaid"),
                                                              F.lit(None).cast("decimal(18,2)").alias("disbursefx"), F.lit(None).cast("decimal(18,2)").alias("repaidfx"))
    fx = F.when(foreign, F.col("tranamt_ccy"))
    out, back = F.when(up, F.col("transamt")), F.when(~up | F.col("transamt").isNull(), -F.col("transamt"))
    moves = t.where(F.col("glmnemo").isin(MOVEMENTS)).select(
        F.lit("M").alias("kind"), "acctno", "transref", "issued", "glmnemo", F.coalesce(out, back).alias("amount"), out.alias("disburse"), back.alias("repaid"),
        F.when(fx > 0, fx).alias("disbursefx"), F.when(F.coalesce(fx <= 0, F.lit(False)), -fx).alias("repaidfx"))
    principal = t.where(F.col("glmnemo").isin(PRINCIPAL) & (F.col("transamt") < 0)).groupBy("acctno", "transref").agg(
        F.sum("transamt").alias("__s"), F.sum(fx).alias("__fx"))
    principal = principal.select(F.lit("P").alias("kind"), "acctno", "transref", F.lit(None).cast("date").alias("issued"), F.lit(None).cast("string").alias("glmnemo"),
                                 (-F.col("__s")).cast("decimal(18,2)").alias("amount"), F.lit(None).cast("decimal(18,2)").alias("disburse"), (-F.col("__s")).cast("decimal(18,2)").alias("repaid"),
                                 F.lit(None).cast("decimal(18,2)").alias("disbursefx"), F.abs("__fx").cast("decimal(18,2)").alias("repaidfx"))
    kind = F.col("kind")
    undone = (kind == "M") & (F.col("glmnemo") == UNDONE) & F.col("disburse").isNotNull()
    undoing = (kind == "M") & F.col("glmnemo").isin(UNDOING) & (F.col("repaid") > 0)
    left = J.net_reversals_by_rule(paid_out.unionByName(moves).unionByName(principal), [
        (["acctno", "amount", "issued"], undone, undoing),
        (["transref", "amount", "issued"], (kind == "M") & F.col("repaid").isNotNull(), kind == "N", False),
        (["acctno", "transref"], kind == "P", kind == "N", False)])
    return left.where(kind != "N").drop("amount")


def disburse_repay(moves: DataFrame) -> DataFrame:
    """Per account and reference what was disbursed and repaid, and the part of it that movements repaid."""
    m = F.col("kind") == "M"
    return moves.groupBy("acctno", "transref").agg(
        F.sum("disburse").alias("disburse"), F.sum("disbursefx").alias("disbursefx"), F.sum("repaid").alias("repaid"),
        F.sum(F.when(m, F.col("repaid"))).alias("repaidprin"), F.sum(F.when(m, F.col("repaidfx"))).alias("repaidprinfx"))


def tied_balances(daily: DataFrame, certificates: DataFrame, daily_order, certificate_order) -> DataFrame:
    """Daily rows split by kind, accepted bills balanced again by their certificates.

    Kinds: ``TB`` other bills (the balance is what is outstanding, direct ones only), ``BA``
    accepted bills, ``NB`` nothing outstanding.  An accepted bill takes the certificate of
    its reference (the certificate's, without the first letter); what is left on both
    sides is matched on (branch, amount, maturity), k-th with k-th, so a certificate is
    used once.  Without a certificate number nothing stays outstanding; else the face
    value less what is unearned.
    """
    bill = F.coalesce(F.col("liabcode").isin(BILL_CODES), F.lit(False))
    d = daily.withColumn("kind", F.when(~F.coalesce(F.col("outstand") > 0, F.lit(False)), "NB").when(bill, "BA").otherwise("TB"))
    bills = d.where("kind = 'BA'")
    certificates_used = ["transref", "certno", "fcvalue", "unearned", "utrdf", "branch", "matdate"]
    given = certificates.select(F.substring("transref", 2, 8).alias("transref"), F.col("transref").alias("transref_pba"), "certno", "fcvalue",
                                F.coalesce("unearned", F.lit(0)).cast("decimal(18,2)").alias("unearned"), "utrdf", "branch", "matdate", F.col("fcvalue").alias("outstand"),
                                *[c for c in certificate_order if c not in certificates_used])
    matched = J.match_consuming(bills, given, ["transref"], ["branch", "outstand", "matdate"], daily_order, certificate_order, weak_right=F.col("certno").isNotNull())
    due = row_sum("fcvalue", -F.col("unearned"))
    bills = matched.withColumn("balance", F.when(F.col("certno").isNull(), F.lit(0).cast("decimal(18,2)")).otherwise(due)) \
                   .withColumn("outstand", F.col("balance")) \
                   .withColumn("utrdf", F.when(F.coalesce(F.rtrim("utrdf"), F.lit("")) == "", F.lit("D")).otherwise(F.col("utrdf")))
    tb = d.where("kind = 'TB'").withColumn("balance", F.when(F.col("dirctind") == "D", F.col("outstand")).otherwise(F.lit(0)).cast("decimal(18,2)"))
    return tb.unionByName(bills, allowMissingColumns=True).unionByName(d.where("kind = 'NB'"), allowMissingColumns=True)
