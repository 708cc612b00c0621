"""One fixture row for each branch of the credit and hierarchy rules."""

import pytest
from pyspark.sql import functions as F

from batchwork.operators import hierarchy as H
from batchwork.rules import credit as RK
from batchwork.sinks import writers as W
from batchwork.sources import readers as R


def column(spark, rows, schema, *cols):
    df = spark.createDataFrame(rows, schema)
    out = df.select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).collect()
    return [r[0] if len(cols) == 1 else tuple(r) for r in out]


def test_interest_receivable(spark):
    rows = [(None, 1.0, 2.0, 9.0, "FTI", False, False), (5.0, 0.0, 2.0, 9.0, "FTI", False, False), (5.0, 1.0, 2.0, 9.0, "FTI", False, False),
            (5.0, 1.0, 2.0, None, "FTI", False, False), (5.0, 1.0, 2.0, 9.0, "MCF", True, False), (5.0, 1.0, 2.0, 9.0, "MFL", True, True),
            (5.0, 1.0, 2.0, 9.0, "MOF", False, True), (5.0, 1.0, 2.0, 9.0, "MCF", False, False), (-5.0, 1.0, 2.0, 9.0, "FTI", False, False)]
    c = F.col
    got = column(spark, rows, "p double, d double, f double, y double, product string, first boolean, issued boolean",
                 RK.interest_receivable(c("p"), c("d"), c("f"), c("y"), F.lit(3.0), c("product"), c("first"), c("issued"), F.lit(77.0)))
    assert got == [0, 0, 8, -1, 26, -6, -6, 77, 77]


def test_risk_and_provision_classes(spark):
    rows = [(" ", None), (None, None), ("1", None), ("2", None), ("3", None), ("4", None), ("9", None), ("4", "P")]
    assert column(spark, rows, "r string, n string", RK.risk_class(F.col("r"), F.col("n"))) == ["P", "P", "C", "S", "D", "B", None, "P"]
    rows = [(89, None, 5.0), (90, None, 5.0), (182, None, 5.0), (183, None, 5.0), (10, "F", 5.0), (200, "P", 5.0), (200, None, 0.5), (None, None, 5.0), (200, None, None)]
    got = column(spark, rows, "d int, n string, o double", *RK.provision_class(F.col("d"), F.col("n"), F.col("o")))
    assert got == [(None, False), ("D", True), ("D", True), ("B", True), ("D", True), ("P", True), ("P", True), (None, False), ("P", True)]
    rows = [(3, 1, 0, None, None), (1, 34371, 90, None, None), (1, 34371, 5, "F", None), (1, 34371, 5, None, "N"), (1, 34371, 5, None, None), (1, 1, 500, "F", "N")]
    c = F.col
    assert column(spark, rows, "s int, f int, d int, b string, u string", RK.impaired(c("s"), c("f"), c("d"), c("b"), c("u"))) == [True, True, True, True, False, False]


def test_overdue_days(spark):
    rows = [("2024-03-01", "2024-03-05", -1), ("2024-03-01", None, 0), (None, "2024-03-05", -1), (None, None, -1), ("2024-03-01", None, 4), ("2024-04-30", None, -1)]
    d = lambda c: F.col(c).cast("date")
    got = column(spark, rows, "e string, t string, b int", *RK.overdue_overdraft(d("e"), d("t"), F.col("b"), F.lit("2024-03-31").cast("date")))
    assert got == [(31, 1, 2), (31, 1, 2), (27, 0, 1), (None, None, None), (None, None, None), (-29, None, None)]
    rows = [("2024-03-01", None, 5, None), ("2024-04-02", None, 5, None), ("2024-03-01", 9, 98500, None), ("2024-03-01", 9, 5, None), ("2024-03-01", 9, 98500, 3)]
    got = column(spark, rows, "b string, o int, n int, g int", RK.overdue_loan(d("b"), F.lit("2024-03-31").cast("date"), F.col("o"), F.col("n"), F.col("g")))
    assert got == [30, 0, 39, 30, 3]


def test_release_amount(spark):
    rows = [(700, None, 5, 9), (200, 1, 5, 9), (200, 1, -5, 9), (200, 1, None, 9), (146, 1, 5, 9), (200, 0, 5, 9), (200, None, 5, 9)]
    c = F.col
    got = column(spark, rows, "t int, c int, a int, g int", RK.release_amount(c("t"), c("c"), F.lit(1), c("g"), c("a"), F.lit(2), F.lit(3)))
    assert got == [1, 4, 9, 9, 2, 3, 3]


def test_undrawn_by_use(spark):
    rows = [(100, 30, 20, True, True), (100, -30, 20, True, True), (100, 30, 20, True, False), (100, 30, 20, False, True), (None, 30, None, True, True)]
    c = F.col
    got = column(spark, rows, "l int, d int, i int, hd boolean, hi boolean", *RK.undrawn_by_use(c("l"), c("d"), c("i"), c("hd"), c("hi")))
    assert got == [(50, 80), (80, 80), (70, 100), (None, 80), (-30, 0)]


def test_levels_stay_inside_their_account(spark):
    rows = [("a", "OV", None), ("a", "F1", "OV"), ("a", "F2", "F1"), ("a", "F3", "F2"), ("a", "F4", "F3"), ("a", "F5", "F4"), ("a", "lost", "nowhere"),
            ("b", "OV", None), ("b", "F2", "F1"), ("b", "X", "OV"), (None, "OV", None), (None, "F1", "OV"), ("c", "F1", "OV"), ("d", "p", "q"), ("d", "q", "p")]
    out = H.level_columns(H.assign_levels(spark.createDataFrame(rows, "acct string, node string, parent string"), "node", "parent", "OV", account="acct"))
    got = {(r.acct, r.node): (r.level, r.path) for r in out.collect()}
    assert out.count() == len(rows)
    assert got["a", "F4"] == (5, ["OV", "F1", "F2", "F3", "F4"]) and got["a", "F5"] == (None, None)  # sixth level
    assert got["a", "lost"] == got["b", "F2"] == got["c", "F1"] == got["d", "p"] == (None, None)
    assert got["b", "X"] == (2, ["OV", "X"]) and got[None, "F1"] == (2, ["OV", "F1"])
    row = out.where("acct = 'b' and node = 'X'").first()
    assert (row.level1, row.level2, row.level3) == ("OV", "X", None)


def test_facility_nodes_and_labels(spark):
    rows = [("OV", ""), ("OV", "7x"), ("FA123456", "zz"), ("F1SB9", "FA1"), ("B1234567", None), ("zz", "7abc"), ("zz", "A1")]
    got = column(spark, rows, "s string, r string", *H.facility_node("s", "r"))
    assert got == [("OV", "NIL", "A"), ("OV", "7x", "X"), ("FA123", "OV", "B"), ("F1SB9", "FA1", "C"), ("B1234", "", "E"), ("zz", "7abc", "X"), (None, None, "E")]
    assert column(spark, [("1ABCDEF",), ("FA1",), ("9AB",), ("0AB",), (None,)], "l string", H.strip_level_prefix("l")) == ["ABC", "FA1", "AB", "0AB", None]


def test_fixed_layout_never_cuts_a_value(spark):
    df = spark.createDataFrame([(1, "abc"), (123456, "abc"), (-1234, "abc"), (2, "abcdef")], "n int, t string")
    lay = [W.Out("n", 1, 4, "zero"), W.Out("t", 5, 4)]
    flagged = {r.n: (r.record, r.overflow) for r in W.to_fixed(df, lay, on_overflow="flag").collect()}
    assert flagged == {1: ("0001abc ", []), 123456: ("****abc ", ["n"]), -1234: ("****abc ", ["n"]), 2: ("0002****", ["t"])}
    sides = W.fixed_and_rejects(df, lay)
    assert (sides["records"].count(), sides["rejects"].count()) == (1, 3)
    for bad in (123456, 2):
        with pytest.raises(Exception, match="wider than"):
            W.to_fixed(df.where(F.col("n") == bad), lay).collect()
    assert W.to_fixed(df.where("n = 2"), [lay[0], W.Out("t", 5, 4, cut=True)]).first().record == "0002abcd"


def test_packed_ranges_spread_over_tasks(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(bytes([0x12, 0x3C]) * 2000)
    out = R.read_packed(spark, f"file://{tmp_path}/x.bin", 2, [R.PackedField("v", 1, 2)], split_bytes=20)
    tasks = out.withColumn("p", F.spark_partition_id()).select("p").distinct().count()
    assert out.count() == 2000 and tasks == 200


def test_partitioned_writes_gather_each_period(spark, tmp_path):
    df = spark.range(0, 4000, 1, 8).select("id", (F.col("id") % 3).alias("period"))
    W.publish(df, f"file://{tmp_path}/t", ["period"])
    assert len(list((tmp_path / "t").rglob("*.parquet"))) == 3


def test_exception_marker_only_when_empty(spark):
    df = spark.createDataFrame([(1, "x")], "id int, report string")
    assert W.exception_report(df, {"report": "r"}).count() == 1
    assert [tuple(r) for r in W.exception_report(df.where("id > 5"), {"report": "r"}).collect()] == [(None, "r")]
