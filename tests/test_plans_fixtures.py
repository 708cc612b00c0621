"""End-to-end jobs on tiny hand-made fixtures (cases the supplied tables cannot show)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from batchwork.plans import jobs as P


def test_payment_recon_no_exceptions_gives_marker_and_zero_total(spark):
    feed = spark.createDataFrame([(1, 100.0), (2, 50.0)], "k long, amt double")
    txn = spark.createDataFrame([(1, 1, 100.0, "C"), (2, 1, 50.0, "C"), (2, 2, 3.0, "D")],
                                "k long, line int, v double, side string")
    out = P.payment_recon(feed, txn, "k", "amt", "v", F.col("side") == "D", ["line"])
    rep = {r["line_type"]: r for r in out["report"].collect()}
    assert set(rep) == {"none", "total"}
    assert rep["total"]["feed_amount"] == 0.0
    st = {r["k"]: (r["status"], r["fee"]) for r in out["reconciled"].collect()}
    assert st == {1: ("matched", None), 2: ("matched", 3.0)}


def test_staff_exceptions_both_sides_and_subtotals(spark):
    loans = spark.createDataFrame([(1, "A", 10.0), (2, "A", 20.0), (3, "B", 5.0)], "k long, grp string, amt double")
    ded = spark.createDataFrame([(2,), (9,)], "k long")
    rep = P.staff_exceptions(loans, ded, "k", ["grp"], "amt")
    kinds = [(r["row_kind"], r["grp"], r["k"], r["amt"]) for r in rep.collect() if r["row_kind"] != "total"]
    # loan 1 and 3 have no deduction; deduction 9 has no loan (no group, no amount)
    assert ("detail", "A", 1, 10.0) in kinds and ("detail", "B", 3, 5.0) in kinds
    assert ("detail", None, 9, None) in kinds
    assert ("subtotal", "A", None, 10.0) in kinds
    total = [r for r in rep.collect() if r["row_kind"] == "total"][0]
    assert total["amt"] == 15.0


def day(text):
    return dt.date.fromisoformat(text) if text else None


def test_facility_master_levels_rollup_and_masking(spark):
    """Two accounts with equal sub-accounts; a chain six deep, roll-up, account total, carry, masking."""
    chain = [("OV", ""), ("FA001", "OV"), ("F1SB1", "FA001"), ("10003", "F1SB1"), ("10004", "10003"), ("10005", "10004")]
    subs = [(a, s, r, None if s == "OV" else f"4{i}", 100.0 + a, "S" if (a, s) == (2, "FA001") else None, day("2020-01-01"), day("2020-06-01" if i else "2022-01-01"), "D")
            for a in (1, 2) for i, (s, r) in enumerate(chain)] + [(1, "FA001", "OV", "99", 7.0, None, day("2021-01-01"), None, "I")]
    detail = [(1, "Z1", "FA001", "D", "00110", 10.0), (1, "FA001", "OV", "I", "00110", 5.0), (1, "FA001", "OV", "D", "01010", 2.0), (1, "FA001", "OV", "D", "00620", 99.0),
              (2, "FA001", "OV", "D", "00110", 8.0), (1, "Z2", None, "D", "00110", 77.0)]
    money = lambda df, *cols: df.withColumns({c: F.col(c).cast("decimal(18,2)") for c in cols})
    d = money(spark.createDataFrame(detail, "acctno int, subacct string, btrel string, dirctind string, glmnemo string, gltrntot double"), "gltrntot")
    s = money(spark.createDataFrame(subs, "acctno int, subacct string, btrel string, custcd string, apprlimt double, sindicat string, created date, expires date, dirctind string"), "apprlimt")
    out = {(r.acctno, r.subacct): r for r in P.facility_master(d, s).collect()}
    assert [out[1, n].level for n, _ in chain] == [1, 2, 3, 4, 5, None] and (out[1, "10004"].level3, out[1, "10004"].level4) == ("F1SB1", "000")
    own = out[1, "FA001"]  # the newest row's limit; the total of its relation (Z1)
    assert (float(own.dcurbal), float(own.icurbal), float(own.intrecv), float(own.apprlimt)) == (10, 5, 2, 7)
    assert (own.has_d, own.has_i, float(own.dundrawn), float(own.iundrawn)) == (True, True, 7 - 10 - 5, 7 - 5)
    root = out[1, "OV"]
    assert (float(root.dcurbal), float(root.icurbal), root.custcd) == (10, 5, "99")  # the account's total; the last code listed before it
    assert (out[2, "OV"].origmt, out[1, "F1SB1"].origmt) == ("20", "10")
    assert [out[2, "FA001"][c] for c in ("dcurbal", "apprlimt", "dundrawn", "iundrawn")] == [None] * 4 and (1, "Z1") in out and (1, "Z2") not in out


def test_trade_balances_closed_item_carried(spark):
    """Netting, a certificate used once, interest, codes repaired, and a reference that closed."""
    dec = lambda df, *cols: df.withColumns({c: F.col(c).cast("decimal(18,2)") for c in cols})
    detail = dec(spark.createDataFrame([(1, "T1", "FTI", 1, "00110", 100.0), (1, "T1", "FTI", 1, "01010", 7.0)], "acctno int, transref string, liabcode string, subacct int, glmnemo string, gltrntot double"), "gltrntot")
    master = spark.createDataFrame([(1, 1, "77", 2000, "2000", "", "", "0470", 1, 1, "", "")], "acctno int, custno int, custcd string, sectorc int, sectorcd string, crispurp string, sectold string, "
                                   "fisspurp string, ccricode int, product int, prodcd string, industrial_sector_cd string")
    txn = [(1, "T1", None, "0060", 50.0, None, "MYR", "2024-01-05"), (1, "T1", None, "0011", -50.0, None, "MYR", "2024-01-05"), (1, "T1", None, "0011", -20.0, None, "USD", "2024-01-06"),
           (2, "T2", "T9abcdefgh", "0011", -40.0, None, "MYR", "2024-01-06"), (1, "T1", None, "0017", 5.0, None, "MYR", "2024-02-06"), (1, "T1", None, "CONI", 5.0, None, "MYR", "2024-01-06"),
           (3, "T3", None, "0101", -9.0, None, "MYR", "2024-01-06"), (4, "T4", None, "0101", -9.0, None, "MYR", "2024-01-06"), (4, "T4", None, "0800", 3.0, None, "MYR", "2024-01-07")]
    t = dec(spark.createDataFrame([(*r[:-1], day(r[-1])) for r in txn], "acctno int, transref string, paygrno string, glmnemo string, transamt double, tranamt_ccy double, currency string, issued date"), "transamt", "tranamt_ccy")
    daily = dec(spark.createDataFrame([(1, 1, "T1", "FTI", "D", 30.0, 5, None), (2, 1, "00000001", "BAI", "D", 60.0, 5, None), (3, 1, "none", "BAI", "I", 60.0, 5, None), (4, 1, "T0", "FTI", "I", 0.0, 5, None)],
                                      "dailyno int, acctno int, transref string, liabcode string, dirctind string, outstand double, branch int, matdate date"), "outstand")
    certs = dec(spark.createDataFrame([(1, "P00000001", 11, 60.0, 4.0, None, 5, None)], "certid int, transref string, certno int, fcvalue double, unearned double, utrdf string, branch int, matdate date"), "fcvalue", "unearned")
    previous = spark.createDataFrame([(2, "T9abcde", 7), (9, "T8", 7)], "acctno int, transref string, branch int")
    industrial = spark.createDataFrame([], "industrial_sector_cd string, industrial_sector string")
    out = P.trade_balances(detail, master, ["custno"], t, daily, ["dailyno"], certs, ["certid"], previous, industrial, "2024-01-01", "2024-01-31")
    assert sorted((r.kind, r.acctno, float(r.repaid)) for r in out["netted"].collect()) == [("M", 1, 20.0), ("M", 2, 40.0), ("P", 3, 9.0)]
    b = {(r.dailyno, r.transref): r for r in out["balances"].collect()}
    assert {k: r.closed for k, r in b.items()} == {(1, "T1"): False, (2, "00000001"): False, (3, "none"): False, (4, "T0"): False, (None, "T9abcde"): True}
    first = b[1, "T1"]
    assert (float(first.balance), float(first.curbal), float(first.intrecv), first.custcd, float(first.repaid), float(first.repaidprin)) == (30, 100, 7, "41", 20, 20)
    assert (b[2, "00000001"].certno, float(b[2, "00000001"].balance), b[2, "00000001"].match_pass) == (11, 56, 1)
    assert (b[3, "none"].certno, float(b[3, "none"].outstand), b[3, "none"].utrdf, b[4, "T0"].balance) == (None, 0, "D", None)
    assert float(b[None, "T9abcde"].repaid) == 40


def test_jobs_keep_rows_with_missing_keys(spark):
    deals = spark.createDataFrame([(1, "a"), (None, "b")], "k int, cust string")
    legs = spark.createDataFrame([(1, 5), (None, 6)], "k int, amt int")
    masters = [spark.createDataFrame([("a", "x")], "cust string, label string"), spark.createDataFrame([("b", None)], "cust string, label string")]
    codes = spark.createDataFrame([("x", "X1"), (None, "X0")], "code string, name string")
    out = P.deal_join(deals, legs, "k", masters, "cust", "label", codes, "code")
    assert sorted((r.amt, r.name) for r in out.collect()) == [(5, "X1"), (6, "X0")]


def test_freshness_is_equality(spark):
    heads = {n: spark.createDataFrame([(day(d),)], "feed_date date") for n, d in (("old", "2024-01-01"), ("now", "2024-01-02"), ("new", "2024-01-03"))}
    out = {r.feed: (r.fresh, r.may_run) for r in P.freshness_from_headers(heads, "2024-01-02").collect()}
    assert out == {"old": (False, False), "now": (True, False), "new": (False, False)}
    assert [r.may_run for r in P.freshness_from_headers({"now": heads["now"]}, "2024-01-02").collect()] == [True]


def test_rollover_and_review_keep_customers_unknown(spark):
    dec = lambda df, *cols: df.withColumns({c: F.col(c).cast("decimal(18,2)") for c in cols})
    notes = dec(spark.createDataFrame([(1, 10, 7, 5.0, "USD", None, day("2023-01-01")), (2, 11, 7, 5.0, "MYR", "10", day("2023-01-01")), (3, 12, 7, 0.0, "MYR", " ", None), (4, 13, 7, 6.0, "MYR", "", None)],
                                      "acctno int, noteno int, branch int, curbal double, curcode string, delqcd string, issued date"), "curbal")
    changes = spark.createDataFrame([(1, 10, day("2024-01-02")), (1, 10, day("2024-01-05")), (2, 11, day("2024-01-02")), (3, 12, day("2024-01-02")), (4, 13, day("2024-02-02"))], "acctno int, noteno int, effdate date")
    rates = dec(spark.createDataFrame([("USD", day("2024-01-01"), 2.0), ("USD", day("2024-01-20"), 3.0), ("USD", day("2024-03-01"), 9.0)], "curcode string, reptdate date, spotrate double"), "spotrate")
    customers = spark.createDataFrame([(2, "I")], "acctno int, indorg string")
    lim = "acctno int, lmtid int, branch int, lmtdesc string, lmtamt double, apprlimt int, reviewdt date"
    limits = spark.createDataFrame([(2, 1, 3, "AA", 5.0, 9, day("2024-02-01")), (2, 2, 3, "AA", 6.0, 9, day("2024-02-01")), (2, 3, 3, "BB", 6.0, 9, day("2024-01-01")), (2, 4, 3, "CC", 6.0, 1, day("2024-02-01"))], lim)
    prior = spark.createDataFrame([(2, i, 3, "x", 5.0, 9, day("2024-01-01")) for i in (1, 2, 3, 4)], lim)
    out = P.rollover_review(notes, changes, rates, customers, limits, prior, "2024-01-01", "2024-01-31")
    got = {(r.acctno, r.file): r.record for r in out.collect()}
    assert got == {(1, "rollover"): "007          1         10   20240105 0000000000001500",
                   (2, "review"): "003          2 AA                   I 20240101 20240201 00000000000001100 20240131 R"}


def test_collateral_rows_go_to_every_table_of_their_class(spark):
    items = spark.createDataFrame([(1, 1, 5, "032", -4.0, day("2010-01-01"), None), (2, 1, 6, "001", 3.0, day("2020-01-01"), None), (3, 1, 6, "001", 3.0, day("2020-01-01"), day("2020-01-01"))],
                                  "item int, acctno int, noteno int, code string, suminsure double, effective date, started date")
    loans = spark.createDataFrame([(1, 5, "A1"), (1, 6, None)], "acctno int, noteno int, aano string")
    none = spark.createDataFrame([], "acctno int, own int")
    trade = spark.createDataFrame([(1, "S"), (1, None)], "acctno int, settled string")
    out = P.collateral(items, loans, none, trade, spark.createDataFrame([], "acctno int, aano string"), spark.createDataFrame([("A9", "t")], "aano string, town string"))
    rows = sorted((r.table, r.source, r.item, r.noteno, r.suminsure, r.subtype or "") for r in out.collect())
    assert rows == sorted([(t, "loan", 1, 5, 0.0, "LAND") for t in ("property", "cms")] + [(t, "loan", 3, 6, 3.0, "") for t in ("financial_asset", "insured_financial")]
                          + [(t, "trade", 1, 0, 0.0, "LAND") for t in ("property", "cms")] + [(t, "trade", 3, 0, 3.0, "") for t in ("financial_asset", "insured_financial")])


def test_collateral_locates_accounts_without_an_application_too(spark):
    # a summary without a number belongs to the accounts without one (R3), whatever their source
    items = spark.createDataFrame([(1, 1, 5, "001", 3.0, None, None)], "item int, acctno int, noteno int, code string, suminsure double, effective date, started date")
    loans = spark.createDataFrame([(1, 5, "A1"), (1, 5, None), (1, 5, "A7")], "acctno int, noteno int, aano string")
    trade = spark.createDataFrame([(1, None)], "acctno int, settled string")
    summaries = spark.createDataFrame([("A1", "t1"), ("A1", "t2"), (None, "t0")], "aano string, town string")
    out = P.collateral(items, loans, spark.createDataFrame([], "acctno int, own int"), trade, spark.createDataFrame([], "acctno int, aano string"), summaries)
    rows = sorted((r.source, r.aano or "", r.town or "") for r in out.where("table = 'financial_asset'").collect())
    assert rows == [("loan", "", "t0"), ("loan", "A1", "t1"), ("loan", "A1", "t2"), ("loan", "A7", ""), ("trade", "", "t0")]


def test_layout_text_and_files_in_one_pass(spark):
    from batchwork.sinks import writers as W
    layout = W.parse_layout("id 4 | name $3 | @10 'xx' | amount z5 | @20 rate 6.2 | on ddMMyyyy | @40 on yyyy")
    assert [(f.name, f.start, f.length, f.kind) for f in layout] == [("id", 1, 4, "num"), ("name", 5, 3, "text"), ("constant", 10, 2, "constant"), ("amount", 12, 5, "zero"),
                                                                       ("rate", 20, 6, "dec"), ("on", 26, 8, "day"), ("on", 40, 4, "day")]
    df = spark.createDataFrame([(1, "abcdef", -7, 2.5, day("2024-03-09")), (22, None, None, None, None)], "id int, name string, amount int, rate double, on date")
    out = W.file_records(df, [("all", None, layout), ("some", F.col("id") > 1, W.parse_layout("id z3")), ("some", F.col("amount") < 0, W.parse_layout("id z4"))], ["id"])
    assert sorted((r.id, r.file, r.record) for r in out.collect()) == [
        (1, "all", "   1abc  xx-0007" + "   " + "  2.50" + "09032024" + " " * 6 + "2024"), (1, "some", "0001"),
        (22, "all", "  22     xx00000" + " " * 9 + "00000000" + " " * 6 + "0000"), (22, "some", "022")]
    path = W.write_files(out, W.scratch_table(df, "t").inputFiles()[0].rsplit("/", 1)[0] + "-files")
    assert {r.file: r.n for r in spark.read.text(path).groupBy("file").agg(F.count(F.lit(1)).alias("n")).collect()} == {"all": 2, "some": 2}


def test_fields_by_their_type_equal_those_without(spark):
    from batchwork.sinks import writers as W
    layout = W.parse_layout("n z7 | m 9 | whole z12 | cents 12.2 | half 12.2 | name $3 | on ddMMyyyy | on yyyyMMdd | on yyyy | on MM | on dd | fine 12.7")
    rows = [(0, 0, 0.0, 0.0, 0.0, ""), (-123, -123, -99.0, -1.5, 0.005, "ab"), (999999, 2**29, 1e11, 12345.67, -2.675, "abcdef"), (None, None, None, None, None, None)]
    dates = ["0001-01-01", "0999-12-31", "2024-02-29", None]
    df = spark.createDataFrame([(*r, d) for r in rows for d in [*dates, "9999-12-31"]], "n int, m long, whole double, cents double, half double, name string, on string")
    df = df.select("n", "m", F.col("whole").cast("decimal(24,0)").alias("whole"), F.col("cents").cast("decimal(24,2)").alias("cents"), F.col("half").cast("decimal(20,3)").alias("half"),
                   "name", F.col("on").cast("date").alias("on"), F.col("half").cast("decimal(20,7)").alias("fine"))
    both = df.select(W.record_column(layout).alias("plain"), W.record_column(layout, types={f.name: f.dataType for f in df.schema.fields}).alias("typed")).collect()
    assert len(both) == 20 and all(r.plain == r.typed for r in both)
    # too wide a number still fails the job, with and without its type
    for types in ({}, {"n": df.schema["n"].dataType}):
        with pytest.raises(Exception, match="value of field n is wider than 2"):
            df.select(W.record_column(W.parse_layout("n z2"), types=types)).collect()


def test_account_file_takes_the_first_of_repeated_keys_in_the_order_of_all_columns(spark):
    from batchwork.operators import keys as K
    from batchwork.plans import registers as PR
    rows = [(1, "LN", 5, 10, 0, "A", 9, 300.0, 7), (1, "LN", 5, 10, 0, "A", 8, 200.0, 9), (1, "LN", 5, 20, 0, "A", 1, 50.0, 1), (2, "LN", 5, 10, 0, "A", 1, 70.0, 2),
            (2, "LN", 5, 10, 0, "A", 1, 70.0, 2), (None, "LN", None, None, 0, "A", 4, 20.0, 3), (None, "LN", None, None, 0, "A", 3, 10.0, 4), (3, "OD", 5, 1, None, "B", 1, 5.0, 5),
            (3, "OD", 5, 2, None, "B", 0, 6.0, 6), (4, "LN", 5, 1, 1, "A", 1, 9.0, 1)]
    # ``custno`` is in no layout, but comes first in the order; ``costctr`` shows which row was taken
    loans = spark.createDataFrame(rows, "acctno long, acty string, branch int, noteno int, commno int, ind string, custno int, apprlimt double, costctr int").withColumn("aano", F.lit(None).cast("string"))
    prior = loans.where("acctno < 0").select("acctno", "branch", "noteno", F.lit(0).alias("balance"), F.lit(0).alias("outstand"), F.lit(0).alias("repaid"), "costctr", "aano")
    out = PR.loan_register(loans, prior, "2024-06-30").where("file = 'account'").collect()
    at = {f.name: (f.start - 1, f.start - 1 + f.length) for f in reversed(PR.RG.ACCOUNT)}
    got = sorted((r.acctno or 0, int(r.record[slice(*at["costctr"])]), int(r.record[45:69])) for r in out)
    first = K.first_by(PR.rated_accounts(loans, "2024-06-30"), ["branch", "acctno", "aano", "commno", "noteno"], []).where("acty = 'OD' OR (commno = 0 AND ind = 'A')").collect()
    want = {}
    for r in sorted(first, key=lambda r: (r.commno or 0, r.noteno or 0)):
        seen = want.setdefault(r.acctno or 0, [r.costctr, 0])
        seen[1] += int(r.limtcurr)
    assert got == sorted((a, c, total) for a, (c, total) in want.items())
    assert got == [(0, 4, 1000), (1, 9, 25000), (2, 2, 7000), (3, 6, 600)]
