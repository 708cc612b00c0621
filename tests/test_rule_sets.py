"""The rule compiler, the class index and the wildcard lookup; rule sets against one-by-one application."""

import random

import pytest
from pyspark.sql import functions as F

from batchwork.operators.joins import wildcard_lookup
from batchwork.queries._loan_book import loan_book
from batchwork.rules import account as AC
from batchwork.rules import compiler as CP
from batchwork.rules import facility as FC
from batchwork.rules import intervals as IV
from batchwork.rules import sector as SR

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("seed", range(4))
def test_compiled_rules_equal_one_by_one(spark, seed):
    rnd = random.Random(seed)
    cols = ["a", "b", "c", "d"]
    df = spark.createDataFrame([tuple(rnd.choice([None, 0, 1, 2, 3]) for _ in cols) for _ in range(200)], "a int, b int, c int, d int")

    def case():
        x, y = rnd.choice(cols), rnd.choice(cols)
        sets = {z: rnd.choice([str(rnd.randint(0, 3)), rnd.choice(cols), f"{rnd.choice(cols)} + 1"]) for z in rnd.sample(cols, rnd.randint(0, 2))}
        return rnd.choice([f"{x} = {rnd.randint(0, 3)}", f"{x} < {y}", f"{x} IS NULL OR {y} > 1"]), sets
    rules = [CP.Rule(tuple(case() for _ in range(rnd.randint(1, 4)))) for _ in range(12)]
    rules += CP.within("a < b", "_in", *[CP.Rule((case(),)) for _ in range(3)])
    assert rows_of(CP.compile_rules(df, rules)) == rows_of(CP.sequentially(df, rules))


def test_levels_follow_reads_and_writes():
    r = [CP.rule("x = 1", y="1"), CP.rule("x = 2", y="2"), CP.rule("y = 1", z="1"), CP.rule("true", x="5"), CP.rule("x = 5", y="3")]
    assert [len(level) for level in CP.levels(r, {"x"})] == [3, 2]
    assert CP.rule("note = 'x and y'", w="1").reads({"x", "y", "note"}) == {"note"}


def test_ladder_cases_that_set_nothing_keep_their_claim(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    out = CP.compile_rules(df, [CP.rule("true", v="'start'"), CP.ladder(("k = 1", {}), ("k < 3", {"v": "'low'"}), ("true", {"v": "'rest'"}))])
    assert [(r.k, r.v) for r in out.collect()] == [(1, "start"), (2, "low"), (3, "rest"), (None, "rest")]


def test_loan_rules_compiled_equal_one_by_one(spark):
    book = loan_book(spark, SF).where("acctno < 1500")
    rules = AC.loan_status_rules("1998-08-15")
    columns = {c.lower() for c in book.columns}
    assert len(rules) > 50 and len(CP.levels(rules, columns)) <= 14
    kept = ["acctno", "acctstat", "impaired", "classifi", "restruct", "rrtag", "cyc", "ends_on", "outstand", "nodays"]
    assert rows_of(AC.loan_status(book, "1998-08-15").select(*kept)) == rows_of(apply_one_by_one(spark, book, rules).select(*kept))


def apply_one_by_one(spark, df, rules):
    """Rule after rule; every tenth result is taken to rows, which keeps the plan short."""
    df = df.withColumns({c: F.coalesce(F.rtrim(F.col(c)), F.lit("")) for c in AC.TEXTS})
    for i, r in enumerate(rules):
        df = CP.compile_rules_keeping(df, [r], AC.STATUS_TYPES)
        if i % 10 == 9:
            df = spark.createDataFrame(df.collect(), df.schema)
    return df


STATUS = {  # one account for each way to a status: changes to an open, unpaid loan of type 200
    "O": {}, "S paid": {"paidind": "P"}, "W paid": {"paidind": "P", "lsttrncd": 658}, "T": {"borstat": "S"}, "S hire": {"loantype": 128, "paidind": "P"},
    "W lost": {"loantype": 650, "write_down_bal": 0}, "P": {"loantype": 650, "write_down_bal": 5}, "P bad": {"loantype": 128, "borstat": "W"},
    "C pattern": {"modeldes": "C103UK"}, "T pattern": {"modeldes": "T103UK"}, "O undone": {"modeldes": "C103UK", "delivered_on": "2030-01-01"},
    "W shadow": {"loantype": 983}, "S shadow": {"loantype": 983, "user5": "F"}, "T dated": {"loantype": 128, "noteno": 98000, "issued": "2005-01-01"},
    "C dated": {"loantype": 128, "noteno": 98000, "issued": "2006-01-01"}, "C model": {"loantype": 128, "modeldes": "A1A"}, "C fed": {"restruct_feed": "R"},
    "O old": {"restruct_feed": "R", "user5": "R"}, "K": {"loantype": 128, "akpk_status": "AKPK"}, "K relief": {"nurs_tag": "K"},
    "J": {"facility": 34331, "manual_rr_tag": "UAJ", "manual_rr_dt": "1998-04-01"}, "O ended": {"facility": 34331, "manual_rr_tag": "UAJ", "manual_rr_dt": "1997-04-01"},
    "J prefix": {"akpk_ra_tag": "BU2", "akpk_ra_start": "1990-01-01", "akpk_ra_end": "1998-08-01"}}


def test_every_way_to_a_status(spark):
    book = loan_book(spark, SF)
    plain = {f.name: None for f in book.schema} | {"loantype": 200, "noteno": 10, "paidind": "N", "facility": 34210, "faccode": 34210}
    rows, names = [], []
    for name, change in STATUS.items():
        names.append(name)
        rows.append(tuple(len(rows) if f.name == "acctno" else (plain | change)[f.name] for f in book.schema))
    text = ", ".join(f"{f.name} {'string' if f.dataType.simpleString() == 'date' else f.dataType.simpleString()}" for f in book.schema)
    df = spark.createDataFrame(rows, text)
    df = df.withColumns({f.name: F.col(f.name).cast("date") for f in book.schema if f.dataType.simpleString() == "date"})
    got = {names[r.acctno]: r.acctstat for r in AC.loan_status(df, "1998-08-15").collect()}
    assert got == {n: n.split()[0] for n in names}


def test_class_index_equals_lists(spark):
    rnd = random.Random(2)
    classes = {n: [rnd.choice([f"{rnd.randint(0, 99):02d}", tuple(sorted((f"{rnd.randint(0, 99):02d}", f"{rnd.randint(0, 99):02d}")))]) for _ in range(6)] for n in "pqrs"}
    index = IV.ClassIndex(**classes)
    codes = [f"{i:02d}" for i in range(100)] + ["", None, "1", "500", "zz"]
    df = spark.createDataFrame([(c,) for c in codes], "code string").withColumn("m", IV.class_mask(index, "code"))

    def want(c):
        return 0 if c is None else sum(index.bits[n] for n, x in classes.items() if any((y[0] <= c <= y[1]) if isinstance(y, tuple) else y == c for y in x))
    assert {r.code: r.m for r in df.collect()} == {c: want(c) for c in codes}
    joined = IV.join_classes(df.where("length(code) = 2 and code < 'a'"), "code", index.table(spark, 1), 1, "joined")
    assert joined.where("m <> joined").count() == 0 and joined.count() == 100


def test_sector_repair_branches(spark):
    schema = "custcd string, sectorc int, sectorcd string, crispurp string, sectold string, fisspurp string, ccricode int, product int, prodcd string, industrial_sector_cd string, acctno long"
    ind = spark.createDataFrame([("64191", "8110")], "industrial_sector_cd string, industrial_sector string")
    cases = {("77", 2000, "2000", "x", "x", "0470", 1, 1, "", None, 1): ("41", "2000", "0470"), ("77", 300, "0300", "x", "x", "0470", 1, 1, "", None, 1): ("77", "9700", "0410"),
             ("95", 300, "0300", "x", "x", "0470", 1, 128, "", None, 1): ("95", "9700", "0212"), ("95", 300, "0300", "x", "x", "0470", 1, 128, "", None, 3500000000): ("95", "9700", "0410"),
             ("02", 1, "0001", "x", "x", "0470", 1, 1, "", None, 1): ("02", "8110", "0470"), ("40", 1, "0001", "x", "x", "0470", 1, 1, "", None, 1): ("40", "8130", "0470"),
             ("71", 1, "5000", "x", "x", "0470", 1, 1, "", None, 1): ("71", "9101", "0470"), ("79", 1, "8110", "5300", "", "0470", 1, 1, "", None, 1): ("79", "9203", "0990"),
             ("82", 5000, "5000", "x", "x", "0470", 1, 1, "34111", None, 1): ("86", "5000", "0212"), ("61", 1, "5000", "x", "x", "0470", 1, 1, "", "64191", 1): ("61", "8110", "0470"),
             (None, None, None, None, None, None, None, None, None, None, None): ("", "9999", "")}
    out = SR.sector_repair(spark.createDataFrame([(*k[:-1], k[-1]) for k in cases], schema), ind)
    got = {(r.custcd, r.sectorcd, r.fisspurp) for r in out.collect()}
    assert got == set(cases.values()) and out.count() == len(cases)


def test_wildcards_most_specific_row_wins(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "z"), (None, "a"), (1, None)], "k int, p string")
    rows = [(None, "a", 1, "by p", None), (1, None, 1, "by k", 10), (1, "a", 1, "both", None), (2, None, 2, "later", None), (1, None, 1, "listed second", 11)]
    out = wildcard_lookup(df, rows, ["k", "p"], ["int", "string"], {"v": "string", "w": "int"})
    assert {(r.k, r.p): (r.v, r.w) for r in out.collect()} == {
        (1, "a"): ("both", 10), (1, "b"): ("by k", 10), (2, "a"): ("later", None), (3, "z"): (None, None), (None, "a"): ("by p", None), (1, None): ("by k", 10)}


def test_facility_codes(spark):
    rows = [(698, "34190", "9999"), (698, "34190", "3100"), (110, "34111", "x"), (466, "34111", "x"), (7, "34230", "x"), (7, "x", "x"), (None, None, None), (128, "34999", "5200")]
    out = FC.facility_codes(spark.createDataFrame(rows, "loantype int, prodcd string, purpose string")).collect()
    assert sorted(map(str, [(r.loantype, r.facility, r.faccode) for r in out])) == sorted(map(str, [
        (698, 34331, 34333), (698, 34331, 34333), (110, 34321, 34321), (466, 34322, 34320), (7, 34371, 34371), (7, None, None), (None, None, None), (128, None, 34334)]))


def test_latest_tag_branches(spark):
    rows = [(34331, "AKPK", "D", "2020-01-02", "C1", "2020-01-01"), (1, None, "D", "2020-01-02", "C1", "2020-01-01"), (1, None, "D", "2020-01-01", "C1", "2020-01-01"),
            (1, None, "D", None, "C1", "2020-01-01"), (1, None, "D", None, "C1", None), (1, None, "D", "2020-01-01", "ZZ", "2021-01-01"), (1, None, "K", "2020-01-01", "K5", None), (None, None, None, None, None, None)]
    c = F.col
    df = spark.createDataFrame(rows, "f int, a string, n string, nd string, t string, td string")
    tag, day = AC.latest_tag(c("f"), c("a"), F.lit("2019-01-01").cast("date"), c("n"), c("nd").cast("date"), c("t"), c("td").cast("date"))
    assert [(r.tag, str(r.day)) for r in df.select(tag.alias("tag"), day.alias("day")).collect()] == [
        ("AKPK", "2019-01-01"), ("D", "2020-01-02"), ("C1", "2020-01-01"), ("C1", "2020-01-01"), ("C1", "None"), ("D", "2020-01-01"), ("K5", "None"), (None, "None")]


def test_pricing_and_scheme_examples(spark):
    df = spark.createDataFrame([(128, 1, 0.5, 0, 0.0), (131, 1, -0.5, 0, 0.0), (200, 38, 0.0, 0, 0.0), (200, 52, 0.0, 0, 0.0), (200, 0, 0.0, 921, 0.0), (200, 0, 0.0, 932, 0.0),
                                (200, 0, 0.0, 0, 1.0), (200, 0, 0.0, 0, None), (200, 1, None, 0, None)], "loantype int, ntindex int, spread double, cfindex int, costfund double")
    out = CP.compile_rules(df, [AC.loan_pricing()], types={"typeprc": "string"})
    assert [r.typeprc for r in out.collect()] == ["80", "42", "43", "44", "58", "67", "68", "59", "42"]
    df = spark.createDataFrame([(991, 566), (991, 1), (567, None), (910, None), (995, 910), (180, 0), (None, None)], "loantype int, pzipcode int")
    out = CP.compile_rules(df, AC.scheme_rules(), types={"specialf": "string", "fconcept": "int", "syndicat": "string"})
    assert [(r.specialf, r.fconcept, r.syndicat) for r in out.collect()] == [("10", 99, "N"), ("00", 99, "N"), ("12", 99, "N"), ("00", 52, "N"), ("00", 52, "N"), ("00", 13, "Y"), ("00", 99, "N")]


@pytest.mark.parametrize("seed", range(4))
def test_rules_on_a_table_set_aside_equal_one_by_one(spark, seed):
    rnd = random.Random(seed)
    cols = ["a", "b", "c", "d", "e", "f", "g"]
    df = spark.createDataFrame([(*(rnd.choice([None, 0, 1, 2, 3]) for _ in cols), rnd.choice([None, " ", "x "])) for _ in range(100)], ", ".join(f"{c} int" for c in cols) + ", t string")

    def case():
        x, y = rnd.choice(cols), rnd.choice(cols)
        sets = {z: rnd.choice([str(rnd.randint(0, 3)), rnd.choice(cols), f"{rnd.choice(cols)} + 1"]) for z in rnd.sample(cols[:6], rnd.randint(0, 2))}
        return rnd.choice([f"{x} = {rnd.randint(0, 3)} AND t <> 'a'", f"{x} < {y}", f"{x} IS NULL OR t = 'x'"]), sets
    rules = [CP.Rule(tuple(case() for _ in range(rnd.randint(1, 4)))) for _ in range(12)]
    rules += [CP.rule("t = ''", h="a"), *CP.within("a < b", "_in", *[CP.Rule((case(),)) for _ in range(3)]), CP.rule("h > 0", a="h")]
    types = {c: "int" for c in [*cols, "h"]}
    out = CP.compile_rules(CP.set_aside(df, keep=["b", "g"], blank=["t"]), rules, types=types, columns=df.columns)
    want = CP.sequentially(df, rules, blank=["t"], types=types)
    assert out.columns == [*df.columns, "h"] and rows_of(out.select(*want.columns)) == rows_of(want)
