"""Golden micro-fixtures for rules the supplied tables cannot show (no nulls, no bad
digits, no packed files), plus property checks of the custom operators."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from batchwork.functions import calendar as CAL
from batchwork.functions import clean as C
from batchwork.operators import joins as J
from batchwork.operators import keys as K
from batchwork.operators import hierarchy as H
from batchwork.session import scratch_path, write_local_text, local_path
from batchwork.sinks import writers as W
from batchwork.sources import readers as R


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_missing_low_and_row_sum(spark):
    df = spark.createDataFrame([(None, None), (None, 2.0), (-1.0, None), (3.0, 4.0)], "a double, b double")
    out = df.select(C.lt_missing("a", 0).alias("lt"), C.row_sum("a", "b").alias("s"),
                    C.clamp("a", 0.0, 2.0).alias("c")).collect()
    assert [r["lt"] for r in out] == [True, True, True, False]
    assert [r["s"] for r in out] == [None, 2.0, -1.0, 7.0]
    assert [r["c"] for r in out] == [None, None, 0.0, 2.0]


def test_century_pivot_and_bad_dates(spark):
    df = spark.createDataFrame([(490101,), (500101,), (510101,), (990230,)], "x int")
    got = [r[0] for r in df.select(C.date_from_yymmdd("x", 1950)).collect()]
    assert got == [dt.date(2049, 1, 1), dt.date(1950, 1, 1), dt.date(1951, 1, 1), None]
    df = spark.createDataFrame([(0,), (2302024000,), (1152024000,), (12312023999,)], "x bigint")
    got = [r[0] for r in df.select(C.date_from_mmddyyyy("x")).collect()]
    # 00000000 and 02/30 are invalid; a lost leading zero is restored
    assert got == [None, None, dt.date(2024, 1, 15), dt.date(2023, 12, 31)]


def test_parse_amount_forms(spark):
    df = spark.createDataFrame([("1,234.56",), ("-5.00",), ("5.00-",), ("   ",), ("x",)], "s string")
    got = [r[0] for r in df.select(C.parse_amount("s")).collect()]
    assert got == [Decimal("1234.56"), Decimal("-5.00"), Decimal("-5.00"), None, None]


def _loop_months(r, e):
    if e < r:
        return None
    n, fol = 0, r
    while True:
        n += 1
        m, y = fol.month + 1, fol.year
        if m > 12:
            m, y = 1, y + 1
        d = r.day
        if d in (29, 30, 31) and m == 2:
            fol = dt.date(y, 3, 1) - dt.timedelta(days=1)
        elif d == 31 and m in (4, 6, 9, 11):
            fol = dt.date(y, m, 30)
        elif d == 30 and m in (1, 3, 5, 7, 8, 10, 12):
            fol = dt.date(y, m, 31)
        else:
            fol = dt.date(y, m, d)
        if e <= fol:
            return n


def test_remaining_months_equals_loop(spark):
    rnd = random.Random(7)
    base = dt.date(2019, 1, 1)
    pairs = []
    for _ in range(3000):
        r = base + dt.timedelta(days=rnd.randrange(0, 1500))
        e = r + dt.timedelta(days=rnd.randrange(-40, 900))
        pairs.append((r, e))
    # month-end edge cases
    pairs += [(dt.date(2024, 1, 31), dt.date(2024, 2, 29)), (dt.date(2024, 1, 30), dt.date(2024, 3, 1)),
              (dt.date(2023, 8, 31), dt.date(2023, 9, 30)), (dt.date(2023, 8, 31), dt.date(2023, 10, 1)),
              (dt.date(2024, 2, 29), dt.date(2024, 2, 29))]
    df = spark.createDataFrame(pairs, "r date, e date")
    got = df.select("r", "e", C.remaining_months("e", "r").alias("n")).collect()
    bad = [(x["r"], x["e"], x["n"], _loop_months(x["r"], x["e"])) for x in got if x["n"] != _loop_months(x["r"], x["e"])]
    assert bad == []


def test_report_calendar(spark):
    ds = [dt.date(2024, 1, 8), dt.date(2024, 1, 15), dt.date(2024, 1, 22), dt.date(2024, 1, 31), dt.date(2024, 12, 29)]
    df = spark.createDataFrame([(d,) for d in ds], "d date")
    p = CAL.report_period("d")
    out = df.select(p["rept_week"], p["rept_prev_month"], p["rept_week_month"], p["week_start"],
                    CAL.period_end_of("d").alias("pe")).collect()
    assert [r[0] for r in out] == ["1", "2", "3", "4", "4"]
    assert out[0][1] == "12" and out[0][2] == "12" and out[1][2] == "01"
    assert out[3][3] == dt.date(2024, 1, 23)
    assert [r["pe"] for r in out] == [dt.date(2024, 1, 8), dt.date(2024, 1, 15), dt.date(2024, 1, 22),
                                      dt.date(2024, 1, 22), dt.date(2024, 12, 22)]


def test_positional_merge_2x3(spark):
    left = spark.createDataFrame([(1, 1, "a1", 10), (1, 2, "a2", 20)], "k int, o int, la string, v int")
    right = spark.createDataFrame([(1, 1, "b1", 100), (1, 2, "b2", 200), (1, 3, "b3", 300), (2, 1, "c1", 9)],
                                  "k int, o int, rb string, v int")
    m = J.merge_by(left.withColumnRenamed("o", "lo"), right.withColumnRenamed("o", "ro"), "k", ["lo"], ["ro"])
    got = sorted(rows(m, "k", "merge_pos", "la", "rb", "v"))
    # the shorter side repeats its last row; the shared column comes from the right
    assert got == [(1, 1, "a1", "b1", 100), (1, 2, "a2", "b2", 200), (1, 3, "a2", "b3", 300), (2, 1, None, "c1", 9)]


def test_net_reversals_pairs(spark):
    t = spark.createDataFrame([
        ("A", 1, 100.0, 1), ("A", 2, -100.0, 1),                      # 1:1 pair → both go
        ("B", 3, 50.0, 1), ("B", 4, 50.0, 1), ("B", 5, -50.0, 1),     # 2:1 → one debit survives
        ("C", 6, 70.0, 1), ("C", 7, -70.0, 2),                        # different date → none
    ], "k string, id int, amt double, d int")
    out = J.net_reversals(t, "k", "amt", "d", ["id"])
    assert sorted(r["id"] for r in out.collect()) == [4, 6, 7]
    # netting removes equal and opposite amounts only: signed sums are unchanged
    assert out.agg(F.sum("amt")).first()[0] == t.agg(F.sum("amt")).first()[0]


def test_reconcile_statuses_partition(spark):
    a = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    b = spark.createDataFrame([(2,), (3,), (4,)], "k int")
    got = dict(rows(J.reconcile(a, b, "k"), "k", "status"))
    assert got == {1: "only_a", 2: "matched", 3: "matched", 4: "only_b"}


def test_first_by_one_row_per_key_and_stable(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, 5, "a"), (2, 1, "z"), (2, 3, "y")], "k int, v int, p string")
    out = K.first_by(df, "k", [F.col("v").desc()])
    assert sorted(rows(out, "k", "v", "p")) == [(1, 5, "a"), (2, 3, "y")]
    out2 = K.first_by(df.repartition(3), "k", [F.col("v").desc()])
    assert sorted(rows(out2, "k", "v", "p")) == sorted(rows(out, "k", "v", "p"))


def test_carry_last_bucketed_equals_plain(spark):
    rnd = random.Random(3)
    data = [(rnd.randrange(3), i, rnd.choice([None, float(i)]), i // 7) for i in range(300)]
    df = spark.createDataFrame(data, "k int, t int, v double, b int")
    plain = K.carry_last(df, "k", ["t"], "v", "c")
    bucketed = K.carry_last(df, "k", ["t"], "v", "c", bucket=F.col("b"))
    assert sorted(rows(plain, "t", "c"), key=lambda x: x[0]) == sorted(rows(bucketed, "t", "c"), key=lambda x: x[0])


def test_numbered_lines_global(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("x"), F.lit(1).alias("a")).repartition(5)
    out = K.numbered_lines(df, ["x"], amount="a", partitions=4)
    got = sorted(rows(out, "x", "line_no", "running_amount"))
    assert got == [(i, i + 1, i + 1) for i in range(1000)]


def test_level_cap(spark):
    nodes = spark.createDataFrame([(0, None), (1, 0), (2, 1), (3, 2), (4, 3), (5, 4), (9, 99)], "n int, p int")
    got = dict(rows(H.assign_levels(nodes, "n", "p", 0, max_level=5), "n", "level"))
    assert got == {0: 1, 1: 2, 2: 3, 3: 4, 4: 5, 5: None, 9: None}


def test_fixed_layout_overlap_overflow_and_roundtrip(spark):
    df = spark.createDataFrame([(7, "ABCDEF", -1.5), (12345, "AB", 2.25)], "k int, t string, x double")
    lay = [W.Out("k", 1, 4, "zero"), W.Out("t", 5, 4, cut=True), W.Out("x", 9, 6, "implied", decimals=2), W.Out("t", 7, 1, cut=True)]
    out = W.to_fixed(df, lay, on_overflow="flag").collect()
    # field t written twice: the later single character at position 7 wins there
    assert out[0]["record"] == "0007ABAD-00150"
    # a number too wide for its field is marked, never cut; the texts may be cut here
    assert out[1]["record"] == "****ABA 000225"
    assert out[0]["overflow"] == [] and out[1]["overflow"] == ["k"]
    path = scratch_path(spark, "t_fixed")
    good = spark.createDataFrame([(7, "ABC", 1.5), (42, "XY", -20.25)], "k int, t string, x double")
    W.to_fixed(good, [W.Out("k", 1, 4, "zero"), W.Out("t", 5, 4), W.Out("x", 9, 8, "implied", decimals=2)]) \
        .select("record").write.text(path)
    back = R.read_fixed(spark, path, [R.Field("k", 1, 4, "int"), R.Field("t", 5, 4),
                                      R.Field("x", 9, 8, "decimal", scale=2)])
    assert sorted(rows(back, "k", "t", "x")) == [(7, "ABC", Decimal("1.50")), (42, "XY", Decimal("-20.25"))]


def test_packed_sign_nibbles(spark):
    recs = [bytes.fromhex("12345C"), bytes.fromhex("12345D"), bytes.fromhex("12345F"), bytes.fromhex("12345A"),
            bytes.fromhex("1234AC"), bytes.fromhex("12345 ".replace(" ", "7"))]
    df = spark.createDataFrame([(bytearray(b),) for b in recs], "rec binary")
    got = [r[0] for r in R.parse_packed(df, [R.PackedField("v", 1, 3, 2)]).collect()]
    assert got == [Decimal("123.45"), Decimal("-123.45"), Decimal("123.45"), Decimal("123.45"), None, None]
    # the file reader: fixed-length records split across tasks
    path = scratch_path(spark, "packed")
    write_local_text(local_path(path) + "/f.bin", data=b"".join(recs[:3]) * 1000)
    back = R.read_packed(spark, path, 3, [R.PackedField("v", 1, 3, 2)], split_bytes=300)
    assert back.count() == 3000 and back.where(F.col("v") < 0).count() == 1000
    hadoop = R.read_packed(spark, path, 3, [R.PackedField("v", 1, 3, 2)], reader="hadoop")
    assert sorted(rows(hadoop, "v")) == sorted(rows(back, "v"))


def test_header_body_split(spark):
    path = scratch_path(spark, "feed")
    write_local_text(local_path(path) + "/f.txt", ["HDR20240115", "row1", "row2"])
    assert R.read_header(spark, path).first()["value"] == "HDR20240115"
    assert sorted(r["value"] for r in R.read_body(spark, path).collect()) == ["row1", "row2"]


def test_exception_report_marker(spark):
    empty = spark.createDataFrame([], "k int, msg string")
    out = W.exception_report(empty, {"msg": "NO EXCEPTIONS"}).collect()
    assert [(r["k"], r["msg"]) for r in out] == [(None, "NO EXCEPTIONS")]
    some = spark.createDataFrame([(1, "x")], "k int, msg string")
    assert W.exception_report(some, {"msg": "NO EXCEPTIONS"}).count() == 1


def test_optional_and_required_sources(spark):
    import pytest
    from pyspark.sql import types as T
    sch = T.StructType([T.StructField("a", T.IntegerType())])
    assert R.read_or_empty(spark, scratch_path(spark, "absent"), sch, optional=True).count() == 0
    with pytest.raises(FileNotFoundError):
        R.read_or_empty(spark, scratch_path(spark, "absent"), sch, optional=False)


def test_freshness_gate_raises(spark):
    import pytest
    from batchwork.operators.quality import StaleFeedError, check_fresh
    a = spark.createDataFrame([(dt.date(2024, 1, 15),)], "d date")
    b = spark.createDataFrame([(dt.date(2024, 1, 14),)], "d date")
    assert check_fresh({"a": a}, "d", "2024-01-15").count() == 1
    with pytest.raises(StaleFeedError, match="b"):
        check_fresh({"a": a, "b": b}, "d", "2024-01-15")


def test_skew_safe_row_numbers_equal_window(spark):
    rnd = random.Random(11)
    # one hot key holds about a third of the rows
    data = [(0 if rnd.random() < 0.35 else rnd.randrange(1, 40), i, rnd.randrange(100)) for i in range(3000)]
    df = spark.createDataFrame(data, "k int, id int, v int")
    order = [F.col("v").asc(), F.col("id").asc()]
    a = K.row_number_in(df, "k", order, "rn", total=False)
    b = K.row_number_skew_safe(df, "k", order, "rn", partitions=7)
    # a partial order is completed by the operator (all columns as tie-break)
    c = K.row_number_skew_safe(df.withColumn("pad", F.lit("x")), "k", [F.col("v").asc()], "rn", partitions=5)
    assert sorted(r["rn"] for r in c.where("k = 0").collect()) == list(range(1, c.where("k = 0").count() + 1))
    assert sorted(rows(a, "id", "rn")) == sorted(rows(b, "id", "rn"))


def test_merge_checked(spark):
    import pytest
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, x string")
    right_ok = spark.createDataFrame([(1, 10), (2, 20)], "k int, y int")
    right_dup = spark.createDataFrame([(1, 10), (1, 11), (2, 20)], "k int, y int")
    assert J.merge_checked(left, right_ok, "k").count() == 2
    with pytest.raises(J.DuplicateKeyError):
        J.merge_checked(left, right_dup, "k")
    got = sorted(rows(J.merge_checked(left, right_dup, "k", on_duplicate="first", right_order=[F.col("y").desc()]), "k", "y"))
    assert got == [(1, 11), (2, 20)]


def test_crosstab_margins_equal_sums(spark):
    from batchwork.operators import agg as A
    rnd = random.Random(5)
    data = [(rnd.choice("xyz"), rnd.choice("pq"), rnd.randrange(100)) for _ in range(500)]
    df = spark.createDataFrame(data, "r string, c string, v long")
    x = {r["r"]: r for r in A.crosstab_totals(df, "r", "c", "v", ["p", "q"]).collect()}
    for r in "xyz":
        assert x[r]["TOTAL"] == sum(v for a, _, v in data if a == r)
        assert x[r]["TOTAL"] == (x[r]["p"] or 0) + (x[r]["q"] or 0)
    assert x["TOTAL"]["TOTAL"] == sum(v for *_, v in data)
    assert x["TOTAL"]["p"] == sum(v for _, c, v in data if c == "p")


def test_asof_join_rate_on_day_before_and_after(spark):
    facts = spark.createDataFrame([("USD", 1, dt.date(2024, 1, 10)), ("USD", 2, dt.date(2024, 1, 5)),
                                   ("USD", 3, dt.date(2024, 1, 1)), ("EUR", 4, dt.date(2024, 1, 10))],
                                  "ccy string, id int, d date")
    rates = spark.createDataFrame([("USD", dt.date(2024, 1, 10), 4.7), ("USD", dt.date(2024, 1, 3), 4.6),
                                   ("EUR", dt.date(2024, 1, 11), 5.1)], "ccy string, rd date, rate double")
    got = dict(rows(J.asof_join(facts, rates, "ccy", "d", "rd", "rate", "r", tie_break=["id"]), "id", "r"))
    # rate on the day, the one before it, none before (only after)
    assert got == {1: 4.7, 2: 4.6, 3: None, 4: None}


def test_positional_merge_lopsided(spark):
    left = spark.createDataFrame([(1, 1, "a")] + [(2, i, f"l{i}") for i in range(1, 6)], "k int, o int, la string")
    right = spark.createDataFrame([(1, i, f"r{i}") for i in range(1, 501)] + [(3, 1, "z")], "k int, o int, rb string")
    m = J.merge_by(left.withColumnRenamed("o", "lo"), right.withColumnRenamed("o", "ro"), "k", ["lo"], ["ro"])
    got = rows(m, "k", "merge_pos", "la", "rb")
    assert len(got) == 500 + 5 + 1
    assert all(la == "a" for k, _, la, _ in got if k == 1)             # the single left row repeats
    assert sorted((p, la, rb) for k, p, la, rb in got if k == 2) == [(i, f"l{i}", None) for i in range(1, 6)]
    assert [(la, rb) for k, _, la, rb in got if k == 3] == [(None, "z")]


def test_ordered_concat_split_matches_single_pass(spark):
    from batchwork.operators import agg as A
    rnd = random.Random(9)
    data = [(0 if rnd.random() < 0.4 else rnd.randrange(1, 6), rnd.randrange(50), rnd.choice([None, "a", "b", "c"]))
            for _ in range(2000)]
    df = spark.createDataFrame(data, "k int, o int, v string")
    got = dict(rows(A.ordered_concat(df, "k", "v", "o", "|", "j", partitions=9), "k", "j"))
    exp = {}
    for k in {d[0] for d in data}:
        vals = sorted(((o, v) for kk, o, v in data if kk == k), key=lambda x: (x[0], x[1] is not None, x[1] or ""))
        exp[k] = "|".join(v for _, v in vals if v is not None)
    assert got == exp


def test_positions_of_repeated_rows_and_hot_keys(spark):
    """One first and one last row per key, equal rows included; keys that span partitions count on."""
    rows = [(1, 5, 100)] * 3 + [(1, 6, 100), (None, 1, 7), (None, 1, 7)] + [(2, i % 10, i % 3) for i in range(5000)] + [(9, 1, 1)]
    df = spark.createDataFrame(rows, "k int, t int, amount int").repartition(3)
    out = K.first_last_flags(df, "k", ["t"]).groupBy("k").agg(F.count_if("is_first").alias("f"), F.count_if("is_last").alias("l"), F.count(F.lit(1)).alias("n")).collect()
    assert {(r.k, r.f, r.l, r.n) for r in out} == {(1, 1, 1, 4), (None, 1, 1, 2), (2, 1, 1, 5000), (9, 1, 1, 1)}
    once = K.first_row_amount(df.where("k = 1"), "k", ["t"], "amount", "shown").select("t", "shown").collect()
    assert sorted((r.t, r.shown) for r in once) == [(5, 0), (5, 0), (5, 100), (6, 0)]
    last = K.first_last_flags(df, "k", [F.col("t").desc()]).where("is_first or is_last")
    assert {(r.k, r.t) for r in last.where("is_first and k = 2").collect()} == {(2, 9)}
    for n in (1, 2, 16):
        seq = K.row_number_skew_safe(df, "k", [F.col("t").asc()], "rn", partitions=n).groupBy("k").agg(F.min("rn"), F.max("rn"), F.count_distinct("rn")).collect()
        assert {tuple(r) for r in seq} == {(1, 1, 4, 4), (None, 1, 2, 2), (2, 1, 5000, 5000), (9, 1, 1, 1)}
    assert K.row_number_skew_safe(df.limit(0), "k", [F.col("t").asc()], "rn").count() == 0
    mixed = spark.createDataFrame([(None, 1), (1, None), (None, None), (1, 1), (None, 1)], "a int, b int").withColumn("x", F.lit(float("nan")))
    seq = K.row_number_skew_safe(mixed, ["a", "b", "x"], [], "rn", partitions=2).collect()
    assert sorted(map(str, [(r.a, r.b, r.rn) for r in seq])) == sorted(map(str, [(None, 1, 1), (None, 1, 2), (1, None, 1), (None, None, 1), (1, 1, 1)]))
