"""End-to-end batch jobs composed from the operators.

Each job takes its input DataFrames and returns a dict of named output DataFrames;
nothing is collected.  The shapes follow the reference's periodic jobs; the inputs are
whatever tables play the roles (see the queries for the supplied test tables).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as CAL
from ..functions import clean as C
from ..operators import agg as A
from ..operators import hierarchy as H
from ..operators import joins as J
from ..operators import keys as K
from ..operators import quality as Q
from ..operators import sets as S
from ..rules import account as AC
from ..rules import codes as RC
from ..rules import credit as RK
from ..rules import facility as FC
from ..rules import sector as SR
from ..rules import trade as TR
from ..sinks import writers as W


def payment_recon(feed: DataFrame, txn: DataFrame, key: str, amount: str, txn_amount: str,
                  is_fee: F.Column, fee_order) -> dict[str, DataFrame]:
    """L1: match collection credits to a payment feed; exceptions + footer totals."""
    credits = txn.where(~is_fee).groupBy(key).agg(F.sum(F.col(txn_amount).cast("decimal(18,2)")).alias("coll_amount"))
    fees = K.first_by(txn.where(is_fee).select(key, *fee_order, F.col(txn_amount).alias("fee")), key, fee_order) \
            .select(key, "fee")                                                # J23
    f = feed.select(key, F.col(amount).cast("decimal(18,2)").alias("feed_amount"))
    r = J.merge_left(J.reconcile(f, credits, key, labels=("matched", "feed_only", "collection_only")), fees, key)
    exc = r.where((F.col("status") != "matched") | (F.col("feed_amount") < F.col("coll_amount")))
    exc = exc.withColumn("line_type", F.lit("detail"))
    totals = exc.agg(F.count(F.lit(1)).cast("double").alias("feed_amount"),
                     F.sum(F.coalesce("feed_amount", "coll_amount")).alias("coll_amount")) \
                .withColumn("line_type", F.lit("total"))                       # A17
    report = W.exception_report(exc, {"line_type": "none"}).unionByName(totals, allowMissingColumns=True)
    return {"reconciled": r, "report": report}


def freshness_from_headers(headers: dict[str, DataFrame], asof) -> DataFrame:
    """L2: each feed's header carries its date; the verdict says which feeds carry exactly the
    report date (an older or a newer one is stale), and whether the run may go on."""
    v = Q.freshness(headers, "feed_date", asof)
    return v.withColumn("may_run", F.bool_and("fresh").over(Window.partitionBy("asof")))   # one row per feed


def deal_join(deals: DataFrame, legs: DataFrame, key: str, masters: list[DataFrame], master_key: str,
              label: str, code_map: DataFrame, code_col: str) -> DataFrame:
    """L4: two feeds inner-joined, customer code looked up over several masters, remapped."""
    j = K.join_on(deals, legs, key)                                            # J2
    j = J.merge_left(j, J.union_lookup(masters, master_key, label), master_key)    # J22
    return J.merge_left(j, code_map.withColumnRenamed(code_col, label), label)     # P5


def maturity_split(books: dict[str, DataFrame], master: DataFrame, key: str, ranges: dict[str, F.Column],
                   title: str, columns: list[str]) -> DataFrame:
    """Two books stacked, joined to their master, split by key range, listed."""
    from ..sources.readers import scan_books
    d = K.join_on(scan_books(books), master, key)
    routed = W.route(d, ranges, exclusive=True)
    lines = []
    for name in ranges:
        lines.append(W.report_lines(routed.where(F.col("route") == name), f"{title} {name}", columns)
                     .withColumn("route", F.lit(name)))
    return S.concat(lines)


def gl_carry_forward(today: DataFrame, prior: DataFrame, keys, value: str, carry_when: F.Column) -> DataFrame:
    """today's GL balances, zero balances of the flagged type carried from yesterday."""
    return J.carry_forward_prior(today, prior, keys, value, carry_when)


def fee_extract(fees: DataFrame, plans: DataFrame, key: str, date_col: str, asof, route_col: str) -> DataFrame:
    """The latest effective plan per key joined to each fee row, split by a code,
    stamped with the period end of the run date."""
    eff = J.latest_effective(plans, key, date_col, asof)
    j = J.merge_left(fees, eff, key)
    return j.withColumn("period_end", CAL.period_end_of(F.lit(asof).cast("date"))) \
            .withColumn("route", F.col(route_col))


def staff_exceptions(loans: DataFrame, deductions: DataFrame, key: str, groups: list[str], measure: str) -> DataFrame:
    """Loans missing from the deduction list and deductions with no loan, as a
    break report with subtotals, or a 'no exceptions' line."""
    r = J.reconcile(loans, deductions, key, labels=("matched", "loan_only", "deduction_only"))
    exc = r.where(F.col("status") != "matched")
    rep = A.break_report(exc, groups, [measure], [key])
    return W.exception_report(rep, {"row_kind": "none"})


# Branches that have moved, old to new
MOVED_BRANCHES = {119: 207, 132: 197, 182: 58, 212: 165, 213: 57, 227: 81, 229: 151, 255: 68, 223: 24, 236: 69, 246: 146, 250: 92, 200: 122}


def weekly_accumulate(transactions: DataFrame, order, patches: DataFrame, history: DataFrame, prior: DataFrame, asof: str, col_values: list[str]) -> dict[str, DataFrame]:
    """The week's transactions summed, the month so far, and its crosstab.

    Ledger codes are written out and payment groups give the reference (F10); patches merge
    by position on the reference and rename it (J10); the reference's own history adds the
    agents; sums per branch, code, account, sub-account, liability and reference (A1) join
    last period's, moved branches take their new number and all is summed again (A19).
    """
    group = ["branch", "glmnemo", "acctno", "subacct", "liabcode", "transref"]
    ledger = TR.ledger_transactions(transactions, asof).withColumn("__in", F.lit(True))
    patched = J.merge_by(patches.select("transref", "renamed"), ledger, "transref", ["renamed"], order).where("__in").drop("__in")
    patched = patched.withColumn("transref", F.coalesce("renamed", "transref"))
    detail = J.merge_left(patched, K.first_by(history, "transref", ["acctno"]).select("transref", "agent"), "transref")
    week = detail.groupBy(*group).agg(F.sum("amount").alias("amount"))                                        # A1
    moved = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in MOVED_BRANCHES.items() for x in kv]), F.col("branch").cast("int")), F.col("branch"))
    total = A.accumulate(week, prior, group, ["amount"], moved, "branch")
    return {"detail": detail, "accumulated": total, "crosstab": A.crosstab_totals(total, "branch", "liabcode", "amount", col_values)}


def daily_detail(subs: DataFrame, credits: DataFrame, master: DataFrame, provisions: DataFrame, prior: DataFrame,
                 labels: DataFrame, rept_date: str) -> DataFrame:
    """L3: one row per reference, sub-account and amount, with its parent chain.

    ``subs`` (ref, sub, parent, account, ref2) keeps the deepest rows of each reference (H1);
    credits join on (ref, sub, maturity), then the account master and provisions, each as a
    full join of which rows with a reference stay (J3); the prior snapshot gives the last
    interest receivable, recomputed by product and day (D7) and added to what is
    outstanding; repeated rows go, and of references that still repeat only rows with a
    limit and an amount outstanding stay (W9); products get their label (J12).
    """
    named = F.trim(F.col("ref").cast("string")) != ""
    chain = H.parent_chain_depth(subs.where(named), "ref", "sub", "parent", levels=3, rank_by="ref")
    rows = chain.select("ref", "ref2", "sub", "account", "maturity", "depth")
    rows = K.join_on(rows, credits, ["ref", "sub", "maturity"], "full").where(named)
    rows = K.join_on(rows, master, "account", "full").where(named)
    rows = K.join_on(rows, provisions, ["ref2", "sub"], "full").where(named)
    # the reference is never missing here: by plain equality the rows are dealt by reference once, for this join and both windows
    rows = rows.join(prior, "ref", "left")
    rows = K.first_by(rows, ["ref", "account", "sub", "outstanding"], [])
    rd = F.lit(rept_date).cast("date")
    receivable = RK.interest_receivable(F.col("principal"), F.col("discount"), F.col("discount_foreign"), F.col("interest_ytd"), F.col("rate"),
                                        F.col("product"), F.lit(rept_date[8:] == "01"), C.same_month("issued", rd), F.col("prior_receivable"))
    rows = rows.withColumn("receivable", receivable).withColumn("outstanding", C.row_sum("outstanding", "receivable"))
    repeated = rows.withColumn("repeats", F.count(F.lit(1)).over(Window.partitionBy("ref")))
    kept = repeated.where((F.col("repeats") == 1) | ((F.coalesce("limit_amount", F.lit(0)) != 0) & (F.coalesce("outstanding", F.lit(0)) != 0)))
    return J.merge_left(kept.drop("repeats"), labels, "product")


def facility_master(detail: DataFrame, sub_accounts: DataFrame, root: str = "OV") -> DataFrame:
    """One row per account and sub-account: balances, level and path, undrawn limits.

    ``detail``: ledger rows (acctno, subacct, btrel, dirctind, glmnemo, gltrntot);
    ``sub_accounts``: acctno, subacct, btrel, custcd, apprlimt, sindicat, created, expires, dirctind.

    Balances are pivoted by direct and indirect use (A11) with the interest receivable;
    sub-accounts below a facility move onto it (A20); totals per relation and per account,
    kept levels of one cube (A3, A15), replace the rows they total, the account's own on the
    root.  The newest row of a sub-account with its oldest dates and the any-flags of its use
    come from one shuffle (W5, A8); levels and paths per account (H2, H3); the root row
    without a customer code takes the last one listed before it (W10); what is left of the
    limit beside each use (H5); a term below 366 days is short; syndicated rows show no
    measures (P15).
    """
    keys = ["acctno", "subacct"]
    group_ledger = F.coalesce(F.substring("subacct", 2, 3) == "SGL", F.lit(False))
    d = detail.where(~F.col("glmnemo").isin(TR.NO_BALANCE_CODES)).withColumn("btrel", F.when(group_ledger, F.lit(root)).otherwise(F.col("btrel")))
    use = d.where(F.col("glmnemo").startswith("00") & (F.coalesce(F.rtrim("btrel"), F.lit("")) != "")).groupBy(*keys, "btrel").pivot("dirctind", ["D", "I"]).agg(F.sum("gltrntot"))
    use = use.withColumnsRenamed({"D": "dcurbal", "I": "icurbal"})
    interest = d.where(F.col("glmnemo").isin(TR.INTEREST_CODES)).groupBy(*keys).agg(F.sum("gltrntot").alias("intrecv"))
    rows = K.join_on(use, interest, keys, "full").withColumn("dbalance", C.row_sum("dcurbal", "intrecv"))
    # rows of a sub-account below a facility go to the facility; a row without a relation goes nowhere
    below = ~F.coalesce(F.substring("btrel", 1, 1).isin("F", "O"), F.lit(False)) & ~F.coalesce(F.substring("subacct", 2, 3) == "SGL", F.lit(False))
    measures = ["dcurbal", "icurbal", "dbalance", "intrecv"]
    rows = rows.withColumn("subacct", F.when(below, F.col("btrel")).otherwise(F.col("subacct"))).where("subacct IS NOT NULL")
    rows = rows.groupBy(*keys, "btrel").agg(*[F.sum(m).alias(m) for m in measures])
    cube = rows.where("acctno IS NOT NULL AND btrel IS NOT NULL").groupingSets([["acctno", "btrel"], ["acctno"]], "acctno", "btrel").agg(
        F.grouping("btrel").alias("of_account"), *[F.sum(m).alias(m) for m in measures])
    totals = cube.select("acctno", F.when(F.col("of_account") == 1, F.lit(root)).otherwise(F.col("btrel")).alias("subacct"), "of_account", *measures)
    totals = totals.groupBy(*keys).agg(F.max_by(F.struct(*measures), "of_account").alias("t"))   # the account's total beats a relation named like the root
    rows = K.join_on(rows.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures]), totals, keys, "full")
    rows = rows.select(*keys, *[F.coalesce(F.col("t")[m], F.col(m)).alias(m) for m in measures])

    facility, parent, _ = H.facility_node("subacct", "btrel")
    newest = F.struct(F.coalesce(F.rtrim("sindicat"), F.lit("")).alias("s"), (-F.datediff(F.coalesce("created", F.lit("0001-01-01").cast("date")), F.lit("0001-01-01").cast("date"))).alias("age"),
                      F.coalesce("apprlimt", F.lit(0)).alias("a"), F.coalesce("custcd", F.lit("")).alias("c"), F.coalesce("btrel", F.lit("")).alias("b"),
                      F.coalesce("expires", F.lit("0001-01-01").cast("date")).alias("e"))
    subs = sub_accounts.groupBy(*keys).agg(
        F.min_by(F.struct("btrel", "custcd", "apprlimt", "sindicat"), newest).alias("n"), F.min("created").alias("issued"), F.min("expires").alias("expires"),
        F.bool_or(F.col("dirctind") == "D").alias("has_d"), F.bool_or(F.col("dirctind") == "I").alias("has_i"))
    subs = subs.select(*keys, "n.*", "issued", "expires", "has_d", "has_i").withColumns({"node": facility, "parent": parent})
    leveled = H.assign_levels(subs.select("acctno", "node", "parent").where("node IS NOT NULL"), "node", "parent", root, 5, account="acctno")
    paths = leveled.groupBy("acctno", "node").agg(F.max("level").alias("level"), F.max("path").alias("path"))
    subs = K.join_on(subs, paths, ["acctno", "node"], "left")
    labels = {f"level{i}": F.get("path", F.lit(i - 1)) for i in range(1, 6)}
    labels = {n: F.when(c.rlike("^[1-9]"), F.substring(c, 2, 3)).otherwise(c) for n, c in labels.items()}              # H4
    ledger = F.substring("subacct", 2, 3) == "SGL"
    subs = subs.withColumns(labels).withColumns({"level": F.when(ledger, F.lit(2)).otherwise(F.col("level")), "level2": F.when(ledger, F.lit("SGL")).otherwise(F.col("level2"))})

    known = F.coalesce(F.rtrim("custcd"), F.lit("")) != ""
    last = subs.where(known & (F.col("subacct") < root)).groupBy("acctno").agg(F.max_by("custcd", "subacct").alias("carried"))
    out = K.join_on(K.join_on(rows, subs, keys, "full"), last, "acctno", "left")
    out = out.withColumn("custcd", F.when(~known & (F.col("subacct") == root), F.col("carried")).otherwise(F.col("custcd"))).drop("carried")
    direct, indirect = RK.undrawn_by_use(F.col("apprlimt"), F.col("dcurbal"), F.col("icurbal"), F.col("has_d"), F.col("has_i"))
    short = F.when(F.coalesce(F.datediff("expires", "issued") < 366, F.lit(True)), F.lit("10")).otherwise(F.lit("20"))
    out = out.withColumns({"dundrawn": direct, "iundrawn": indirect, "origmt": short})
    return out.withColumns({m: C.mask_when(F.coalesce(F.col("sindicat") == "S", F.lit(False)), m) for m in [*measures, "apprlimt", "dundrawn", "iundrawn"]})


def trade_balances(detail: DataFrame, master: DataFrame, master_order, transactions: DataFrame, daily: DataFrame, daily_order,
                   certificates: DataFrame, certificate_order, previous: DataFrame, industrial: DataFrame, start: str, end: str) -> dict[str, DataFrame]:
    """Trade balances of a period.

    Ledger rows with their interest (A21) and customer codes repaired (D1), summed per
    account and reference, hang on the daily rows whose balances are tied to the bills'
    certificates (D12, J16); movements are netted by rule (J18), split (D11) and merged on;
    references active now, gone today and known in the prior period come in as closed (J19).
    """
    keys = ["acctno", "transref"]
    base = J.merge_left(TR.balance_with_interest(detail), K.first_by(master, "acctno", master_order), "acctno")
    base = SR.sector_repair(base, industrial)
    sums = base.groupBy(*keys).agg(F.sum("curbal").alias("curbal"), F.sum("intrecv").alias("intrecv"))
    one = K.first_by(base.select(*keys, "subacct", "custcd", "sectorcd", "fisspurp"), keys, [F.col("subacct").desc_nulls_last()]).drop("subacct")
    tied = TR.tied_balances(daily, certificates, daily_order, certificate_order).where("acctno IS NOT NULL")
    current = J.merge_left(J.merge_left(tied, one, keys), sums, keys)
    moves = TR.netted_movements(TR.ledger_transactions(transactions, end), start, end)
    split = TR.disburse_repay(moves)
    closed = J.closed_items(current, previous, split, keys)
    return {"netted": moves, "split": split, "balances": J.merge_left(closed, split, keys)}


def trade_register(lines: DataFrame, accounts: DataFrame, rept_date: str, layout: list) -> dict[str, DataFrame]:
    """Per account: its lines' codes in order, mean distinct positive tax, the
    representative line by priority, arrears bucket and risk class, as a fixed-layout
    register record.  ``accounts`` carries (o_orderkey, o_orderdate)."""
    o = accounts.select("o_orderkey", F.datediff(F.lit(rept_date).cast("date"),
                                                 F.col("o_orderdate").cast("date")).alias("days"))
    cat = A.ordered_concat(lines.withColumn("v", F.concat(F.col("l_linenumber").cast("string"), "l_returnflag")),
                           "l_orderkey", "v", "l_linenumber", "|", "lines")                      # A9
    mdp = A.mean_distinct_positive(lines, "l_orderkey", ["l_tax"])                               # A7
    best = K.pick_by_priority(lines, "l_orderkey",
                              [(F.col("l_returnflag") == "R", 1), (F.col("l_linestatus") == "O", 2)],
                              [F.col("l_extendedprice").desc()]) \
            .select("l_orderkey", F.col("l_linenumber").alias("best_line"))                     # W13
    cls, _ = RK.provision_class(F.col("days"), F.lit(None).cast("string"), F.lit(1))             # D5
    j = (o.join(cat.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey")
          .join(mdp.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey")
          .join(best.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey")
          .withColumn("arrears", C.arrears_months("days").cast("bigint")).withColumn("risk", cls))  # F23
    return {"register": W.to_fixed(j, layout)}                            # K2


def assembly(feeds: dict[str, DataFrame], rept: str) -> dict[str, DataFrame]:
    """Loans, overdrafts and open applications assembled for the registers.

    ``feeds``: loans (acctno, noteno, bonusano, commno, loantype, vinno, ...), prior_loans,
    provided, balances, commitments, excluded, applications, rejections, reviews, collateral,
    write_offs, current, overdraft_limits, excesses; see the fixtures for their columns.

    The merge on the application number comes first (it has its own key); everything after
    it hangs on the account, alone or with a note or commitment, so the first merge's
    exchange on the account serves the whole chain and every other input is exchanged
    once (``spark.sql.requireAllClusterKeysForCoPartition`` off, as in ``get_spark``).
    Right sides are made unique first where the source is not, or merged by position where it
    is many-to-many (overdrafts with their balances).
    """
    f, note = feeds, ["acctno", "noteno"]
    number = F.translate(F.substring(F.ltrim("vinno"), 1, 13), "@*(#)- ", "")                                # Q4
    loans = f["loans"].withColumn("aano", F.when(F.length(number) == 13, number))
    apps = K.first_by(f["applications"], "aano", [])                                                         # W4
    apps = J.merge_left(apps, K.first_by(f["rejections"], "aano", [F.col("icdate").desc_nulls_last()]).select("aano", "rjdate"), "aano")
    apps = apps.withColumnRenamed("acctno", "preacct").withColumn("apprlmaa", F.coalesce(F.when(F.col("app_limit_ccy") > 0, F.col("app_limit_ccy")),
                                                                                           F.when(F.col("amount_sc") > 0, F.col("amount_sc")), "amount")).drop("app_limit_ccy", "amount_sc", "amount")
    known = loans.where("aano IS NOT NULL").select("aano").distinct()
    open_apps = K.join_on(apps, known, "aano", "left_anti")
    loans = J.merge_left(loans, apps, "aano")
    loans = loans.withColumn("purpose", F.coalesce(F.nullif(F.rtrim("purpose"), F.lit("")), F.col("app_purpose")))

    # from here on the account
    written = K.first_by(f["write_offs"], note, [])
    by_account = K.first_by(written.where("noteno IS NULL").select("acctno", F.col("woffdt").alias("wfdate_account")), "acctno", [])
    loans = J.merge_left(loans, by_account, "acctno")
    loans = J.merge_left(loans, written.where("noteno IS NOT NULL").select(*note, F.col("woffdt").alias("wfdate_note")), note)
    old = f["loans"].select("acctno", F.col("noteno").alias("bonusano"), F.col("lasttran").alias("migrated")).where("bonusano IS NOT NULL")
    loans = J.merge_left(loans, K.first_by(old, ["acctno", "bonusano"], []), ["acctno", "bonusano"])
    loans = J.merge_left(loans, K.first_by(f["prior_loans"].select(*note, F.col("branch").alias("oldbrh")), note, []), note).withColumn("oldbrh", F.coalesce("oldbrh", F.lit(0)))
    provided = K.first_by(f["provided"], note, []).withColumn("gp3ind", F.when(F.col("nplind") == "N", F.lit("R")).otherwise(F.lit("A")))
    loans = K.join_on(loans.withColumn("in_a", F.lit(True)), provided, note, "full")                           # both sides stay where provided
    loans = loans.where((F.col("gp3ind").isNotNull()) | (~F.coalesce(F.col("reversed") == "Y", F.lit(False)) & F.col("noteno").isNotNull()
                                                        & ~F.coalesce(F.col("borstat") == "Z", F.lit(False))))
    loans = J.merge_left(loans, K.first_by(f["balances"], note, []), note)
    paid, this_month = F.coalesce(F.col("paidind") == "P", F.lit(False)), F.coalesce(C.same_month("lasttran", F.lit(rept).cast("date")), F.lit(False))
    down, off = F.coalesce(F.col("loantype").between(600, 699), F.lit(False)), F.coalesce(F.col("lsttrncd").isin(658, 662, 663), F.lit(False))
    stays = (paid & this_month) | F.coalesce(F.col("nplind") == "P", F.lit(False)) | (paid & down & F.coalesce(F.col("lsttrncd") == 658, F.lit(False))) | (paid & ~down & off)
    loans = loans.where(stays | ~paid | F.col("eir_adj").isNotNull())                                       # P18
    opened_and_closed = F.col("eir_adj").isNull() & paid & F.coalesce(C.same_month("lasttran", "issued"), F.lit(False)) & ~F.coalesce(F.col("loantype").isin(AC.HIRE_PURCHASE), F.lit(False))
    loans = loans.where(~opened_and_closed)
    loans = J.merge_left(loans, K.first_by(f["commitments"], ["acctno", "commno"], []).withColumn("ind", F.lit("B")), ["acctno", "commno"]).withColumn("ind", F.coalesce("ind", F.lit("A")))
    loans = K.join_on(loans, f["excluded"].select(*note), note, "left_anti")                                  # J6
    split = F.coalesce(F.col("loantype").isin(984, 985, 994, 995, 996), F.lit(False))                         # U6: of split accounts the newest note
    newest = loans.where(split).groupBy("acctno").agg(F.max("noteno").alias("__newest"))
    loans = J.merge_left(loans, newest, "acctno").where(~split | F.col("noteno").eqNullSafe(F.col("__newest"))).drop("__newest")
    loans = J.merge_left(loans, K.first_by(f["collateral"], note, []), note)
    loans = J.merge_left(loans, K.first_by(f["reviews"], note, [F.col("reviewed").desc_nulls_last()]), note)
    loans = FC.facility_codes(loans)                                                                         # D2
    loans = loans.withColumns({"acty": F.lit("LN"), "wfdate": F.coalesce("wfdate_note", "wfdate_account"), "oribrh": F.col("branch"),
                               "branch": F.when(F.col("costctr") == 4048, F.lit(903)).when(F.col("costctr") == 4043, F.lit(906)).otherwise(F.col("branch")),
                               "leg": F.when(F.coalesce(F.rtrim("delqcd"), F.lit("")).isin(LEGAL_CODES), F.lit("A")),
                               "cavaiamt": F.when(F.col("cavaiamt") < 0, F.lit(0)).otherwise(F.col("cavaiamt"))})
    loans = loans.withColumn("rleasamt", RK.release_amount(F.col("loantype"), F.col("commno"), F.col("netproc"), F.col("corgamt"), F.col("cavaiamt"), F.col("cusedamt"), F.col("orgbal")))

    # overdrafts: the account with its limit, excesses and balances, the last by position
    limit = K.first_by(f["overdraft_limits"], "acctno", [F.col("lmtstdte").desc_nulls_last()])
    od = J.merge_left(J.merge_left(K.first_by(f["current"], "acctno", []), limit, "acctno"), K.first_by(f["excesses"], "acctno", []), "acctno")
    gone, month = F.coalesce(F.col("openind").isin("B", "C", "P"), F.lit(False)), F.coalesce(C.same_month("closed_on", F.lit(rept).cast("date")), F.lit(False))
    od = od.where((~gone | month) & ~(gone & F.coalesce(C.same_month("closed_on", "opened"), F.lit(False))))
    since = F.when(F.col("curbal") < 0, F.least("excess_on", "tempod_on"))
    days = F.datediff(F.lit(rept).cast("date"), since)
    taken = F.coalesce(days > 89, F.lit(False)) | F.coalesce(F.col("riskcode").isin("1", "2", "3", "4"), F.lit(False)) | F.coalesce(F.col("curbal") < 0, F.lit(False)) \
        | F.coalesce(F.col("product").between(30, 34), F.lit(False)) | gone
    od = od.withColumns({"nodays": days, "taken": taken, "delqcd": _remapped(F.col("user2"), LEGAL_BY_MARK)})
    od = od.where(F.col("taken") | F.coalesce(F.col("apprlimt") > 1, F.lit(False))).withColumn("leg", F.when(F.coalesce(F.rtrim("delqcd"), F.lit("X")).isin(LEGAL_CODES), F.lit("A")))
    paired = J.merge_by(f["balances"].select("acctno", "noteno", "eir_adj").withColumnRenamed("noteno", "balance_note"), od.withColumn("in_od", F.lit(True)), "acctno", ["balance_note"], [])
    od = paired.where("in_od").withColumn("acty", F.lit("OD")).drop("in_od")
    return {"loans": loans.drop("in_a", "wfdate_note", "wfdate_account"), "overdrafts": od, "applications": open_apps}


# Delinquency codes under legal action, and those that a mark on an overdraft stands for
LEGAL_CODES = ["10", "11", "12", "13", "14", "15", "16", "17", "18", "", "09", "19", "20", "21"]
LEGAL_BY_MARK = {"": "", "A": "", "F": "10", "B": "11", "C": "12", "G": "13", "H": "14", "I": "15", "J": "16", "E": "17", "K": "18", "L": "19", "D": "20", "M": "21"}


def _remapped(c, table: dict[str, str], default: str = "X"):
    mark = F.coalesce(F.rtrim(c), F.lit(""))
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), mark), F.lit(default))


def application_register(apps: DataFrame, customers: DataFrame, rates: DataFrame) -> DataFrame:
    """Applications routed approved / rejected, right-merged onto the customer
    master, amounts converted at their currency's rate, one fixed record each."""
    app = W.route(apps, {"approved": F.col("o_orderstatus") == "F"}, exclusive=True, default="rejected")  # K5
    app = app.join(rates, "ccy", "left").withColumn(
        "amt_local", F.round(F.col("o_totalprice").cast("decimal(18,2)") * F.col("rate").cast("decimal(18,6)"), 2))
    j = app.join(customers, "o_custkey", "right")                                               # J5
    lay = [W.Out("o_orderkey", 1, 10, "zero"), W.Out("route", 11, 8), W.Out("amt_local", 19, 14, "implied", decimals=2)]
    ext = W.to_fixed(j, lay)                                               # K2
    return ext.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "route",
                      F.col("amt_local").cast("double").alias("amt_local"),
                      F.when(F.col("o_orderkey").isNotNull(), F.col("record")).alias("record"))


ROLLOVER = W.parse_layout("branch z3 | @5 acctno 10 | @16 noteno 10 | @27 indorg $1 | @29 effdate yyyyMMdd | @38 curbal z16")
REVIEW = W.parse_layout("branch z3 | @5 acctno 10 | @16 lmtdesc $20 | @37 indorg $1 | @39 previewdt yyyyMMdd | @48 reviewdt yyyyMMdd | @57 lmtamt z17 | @75 report yyyyMMdd | @84 'R'")


def rollover_review(notes: DataFrame, rate_changes: DataFrame, rates: DataFrame, customers: DataFrame, limits: DataFrame, prior_limits: DataFrame,
                    start: str, rept: str) -> DataFrame:
    """The two files of a period, as rows (acctno, file, record).

    * rollover: notes with a balance and no delinquency, issued before the period, whose rate
      changed in it (newest change, W4), balances in home currency at the latest rate (J13);
    * review: limits whose review date moved forward since the prior generation (J20), once
      per account and application, with the sum of their amounts (A16).
    Customers add their kind where known (left, so none is lost).
    """
    day = F.lit(rept).cast("date")
    changed = rate_changes.where(F.col("effdate").between(F.lit(start).cast("date"), day))
    changed = changed.groupBy("acctno", "noteno").agg(F.max("effdate").alias("effdate"))
    at = rates.where(F.col("reptdate") <= day).groupBy("curcode").agg(F.max_by("spotrate", "reptdate").alias("spotrate"))   # code table of currencies
    n = K.join_on(J.merge_left(notes, at, "curcode"), changed, ["acctno", "noteno"])
    n = n.withColumn("curbal", F.when(F.coalesce(F.col("curcode") == "MYR", F.lit(False)), F.col("curbal")).otherwise(F.round(F.col("curbal") * F.col("spotrate"), 2)))
    n = n.where((F.coalesce(F.rtrim("delqcd"), F.lit("")) == "") & F.coalesce(F.col("issued") < F.lit(start).cast("date"), F.lit(True)) & ~F.col("curbal").eqNullSafe(F.lit(0)))
    n = J.merge_left(n, customers, "acctno").withColumn("curbal", F.round(F.col("curbal") * 100).cast("decimal(24,0)"))
    moved = J.snapshot_compare(limits.where("apprlimt > 1 AND lmtamt > 1"), prior_limits.where("apprlimt > 1 AND reviewdt IS NOT NULL").select("acctno", "lmtid", "reviewdt"), ["acctno", "lmtid"], "reviewdt")
    moved = moved.withColumnRenamed("prev_reviewdt", "previewdt")
    total = moved.groupBy("acctno", "lmtdesc").agg(F.sum("lmtamt").alias("total"))
    once = J.merge_left(K.first_by(moved, ["acctno", "lmtdesc"], ["lmtid"]), total, ["acctno", "lmtdesc"])
    once = J.merge_left(once, customers, "acctno").withColumns({"lmtamt": F.round(F.col("total") * 100).cast("decimal(24,0)"), "report": day})
    return W.file_records(n, [("rollover", None, ROLLOVER)], ["acctno"]).unionByName(W.file_records(once, [("review", None, REVIEW)], ["acctno"]))


# The collateral tables and their categories; two tables may take the same rows
COLLATERAL_TABLES = {"property": "10", "motor_vehicle": "30", "other_vehicle": "40", "plant_machinery": "60", "concession": "50", "financial_asset": "29", "other_asset": "90",
                     "guarantee": "70", "cms": "10", "insured_financial": "29", "insured_other": "90"}
DATED_SINCE = "2018-07-01"


def collateral(items: DataFrame, loans: DataFrame, overdrafts: DataFrame, trade: DataFrame, applications: DataFrame, summaries: DataFrame) -> DataFrame:
    """The eleven collateral tables in one pass, as rows with the ``table`` they belong to.

    Items that must be dated and are not go; loans find theirs by account and note, the
    other accounts by account; what is found is stacked with a note of 0 where it has
    none (U2), takes the application's location summary where there is one (no item is
    lost) and its class's category and subtype (D9).  An insured sum is not below 0.
    """
    undated = F.coalesce(F.col("effective") >= F.lit(DATED_SINCE).cast("date"), F.lit(False)) & F.col("started").isNull()
    # what depends on the item alone is settled before items meet accounts: the pairs are by far the most rows
    items = items.where(~undated).withColumn("suminsure", F.greatest(F.col("suminsure"), F.lit(0)))
    items = RC.collateral_category(items, "code")
    items = W.route(items, {t: F.col("collater") == c for t, c in COLLATERAL_TABLES.items()}, exclusive=False, col="table")
    open_trade = trade.where(~F.coalesce(F.col("settled") == "S", F.lit(False)) & (F.col("acctno") > 0))
    found = [K.join_on(loans, items, ["acctno", "noteno"]).withColumn("source", F.lit("loan")),
             K.join_on(overdrafts, items.drop("noteno"), "acctno").withColumn("source", F.lit("overdraft")),
             K.join_on(open_trade.drop("settled"), items.drop("noteno"), "acctno").withColumn("source", F.lit("trade")),
             K.join_on(applications, items.drop("noteno"), "acctno").withColumn("source", F.lit("application"))]
    every = S.concat(found).withColumn("noteno", F.coalesce("noteno", F.lit(0)))
    return J.merge_left(every, summaries, "aano")
