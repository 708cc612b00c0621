"""Missing keys match missing keys, and no operator loses or invents rows because of them."""

import pytest
from pyspark.sql import functions as F

from batchwork.operators import joins as J
from batchwork.operators import keys as K

ROWS = [(None, 1, "a"), (None, 2, "b"), (1, 3, "c"), (1, 4, None), (2, 5, "e")]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(ROWS, "k int, t int, v string")


def got(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


def test_group_operators_keep_rows_with_missing_keys(df):
    assert got(K.first_last_flags(df, "k", ["t"]), "k", "t", "is_first", "is_last") == sorted(
        [(None, 1, True, False), (None, 2, False, True), (1, 3, True, False), (1, 4, False, True), (2, 5, True, True)], key=str)
    assert got(K.first_row_amount(df, "k", ["t"], "t", "x"), "t", "x") == [(1, 1), (2, 0), (3, 3), (4, 0), (5, 5)]
    for safe in (True, False):
        assert got(K.row_number_in(df, "k", ["t"], skew_safe=safe), "t", "seq") == [(1, 1), (2, 2), (3, 1), (4, 2), (5, 1)]
    assert got(K.rows_with_duplicate_keys(df, "k"), "t") == [(1,), (2,), (3,), (4,)]
    assert got(K.surplus_rows(df, "k", ["t"]), "t") == [(2,), (4,)]
    for bucket in (None, F.col("t") % 2):
        assert got(K.carry_last(df.where("t <> 4 or t = 4"), "k", ["t"], "v", "c", bucket=F.lit(0) if bucket is None else None), "t", "c") == \
            [(1, "a"), (2, "b"), (3, "c"), (4, "c"), (5, "e")]
    carried = K.carry_last(df.withColumn("v", F.when(F.col("t") != 2, F.col("v"))), "k", ["t"], "v", "c", bucket=F.col("t"))
    assert got(carried, "t", "c") == [(1, "a"), (2, "a"), (3, "c"), (4, "c"), (5, "e")]


def test_ranks_by_counted_values(spark):
    df = spark.createDataFrame([(None, 5), (None, 5), (None, 3), (None, None), (1, 2), (1, 2), (1, 9)], "k int, x int")
    assert got(K.rank_in(df, "k", "x", "r"), "k", "x", "r") == sorted(
        [(None, 5, 3), (None, 5, 3), (None, 3, 2), (None, None, 1), (1, 2, 1), (1, 2, 1), (1, 9, 3)], key=str)
    assert got(K.rank_in(df, "k", "x", "r", dense=True, descending=True), "k", "x", "r") == sorted(
        [(None, 5, 1), (None, 5, 1), (None, 3, 2), (None, None, 3), (1, 2, 2), (1, 2, 2), (1, 9, 1)], key=str)


def test_joins_match_missing_with_missing(spark, df):
    right = spark.createDataFrame([(None, "n"), (1, "one"), (7, "seven")], "k int, w string")
    assert got(J.merge_left(df, right, "k"), "t", "w") == sorted([(1, "n"), (2, "n"), (3, "one"), (4, "one"), (5, None)], key=str)
    flags = J.with_indicators(df, right, "k")
    assert got(flags.where("in_a and in_b"), "t") == [(1,), (2,), (3,), (4,)] and flags.columns == ["k", "t", "v", "in_a", "w", "in_b"]
    assert {r.status for r in J.reconcile(df, right, "k").where("k is null").collect()} == {"matched"}
    assert J.n_way_merge([df, right, right.withColumnRenamed("w", "z")], "k").where("k is null and w = 'n' and z = 'n'").count() == 2
    assert got(K.join_on(df, right, "k", "left_anti"), "t") == [(5,)]
    assert got(K.join_on(df, right, "k", "right"), "k", "w") == sorted([(None, "n"), (None, "n"), (1, "one"), (1, "one"), (7, "seven")], key=str)


def test_positional_merge_with_missing_keys(spark, df):
    right = spark.createDataFrame([(None, 10), (None, 11), (None, 12), (1, 20)], "k int, r int")
    for safe in (True, False):
        out = J.merge_by(df.drop("v"), right, "k", ["t"], ["r"], skew_safe=safe)
        assert got(out, "k", "merge_pos", "t", "r") == sorted(
            [(None, 1, 1, 10), (None, 2, 2, 11), (None, 3, 2, 12), (1, 1, 3, 20), (1, 2, 4, 20), (2, 1, 5, None)], key=str)


def test_reversals_keep_the_surplus_and_missing_keys(spark):
    df = spark.createDataFrame([(None, 5.0, 1, 1), (None, -5.0, 1, 2), (None, 5.0, 1, 3), (1, 7.0, 1, 4), (1, -7.0, 2, 5), (1, 0.0, 1, 6), (None, 9.0, None, 7)],
                               "k int, amount double, d int, id int")
    assert got(J.net_reversals(df, "k", "amount", "d", ["id"]), "id") == [(3,), (4,), (5,), (6,), (7,)]


def test_reversals_by_rule_remove_every_match(spark):
    rows = [("a", None, "00600", 10, 0, 1), ("a", None, "00110", 0, 10, 1), ("a", None, "00110", 0, 10, 1), ("b", "t", "00600", 10, 0, 1),
            ("c", "t", "00700", 30, 0, 1), ("d", "t", "00800", 0, 30, 1), ("e", "u", "00800", 0, 30, 1)]
    df = spark.createDataFrame(rows, "account string, ref string, gl string, out int, back int, day int") \
        .withColumn("amount", F.greatest("out", "back"))
    repaid = F.col("gl").isin("00110", "00800") & (F.col("back") > 0)
    left = J.net_reversals_by_rule(df, [(["account", "amount", "day"], F.col("gl") == "00600", repaid),
                                        (["ref", "amount", "day"], F.col("gl") == "00700", repaid)])
    assert got(left, "account", "gl") == [("b", "00600"), ("e", "00800")]


def test_closed_items_come_once(spark):
    cur = spark.createDataFrame([(1, 10)], "k int, b int")
    prev = spark.createDataFrame([(1, 9), (2, 20), (None, 30), (3, 40)], "k int, b int")
    act = spark.createDataFrame([(2,), (2,), (None,), (1,)], "k int")
    assert got(J.closed_items(cur, prev, act, "k"), "k", "b", "closed") == sorted([(1, 10, False), (2, 20, True), (None, 30, True)], key=str)


def test_line_numbers_by_position(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("x"), F.lit(1).alias("amount"))
    out = K.numbered_lines(df, ["x"], "amount", partitions=7)
    assert out.where("line_no <> x + 1 or running_amount <> x + 1").count() == 0 and out.count() == 1000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") <= 2 and "hashpartitioning(__pid" not in plan.split("Window")[0]


def test_matching_uses_a_row_once(spark):
    left = spark.createDataFrame([(1, "a", 5), (2, "a", 5), (3, "a", 6), (4, None, 7), (5, "z", 6), (6, "z", 6), (7, "y", None)], "id int, ref string, amount int")
    right = spark.createDataFrame([(10, "a", 9), (11, "a", 5), (12, None, 1), (13, "q", 6), (14, "q", 6), (15, "p", 6), (16, "q", None)], "cert int, ref string, amount int")
    out = J.match_consuming(left, right, "ref", "amount", ["id"], ["cert"], weak_right=F.col("cert") != 14)
    assert got(out, "id", "cert", "match_pass") == sorted(
        [(1, 10, 1), (2, 11, 1), (3, 13, 2), (4, 12, 1), (5, 15, 2), (6, None, None), (7, 16, 2)], key=str)
    assert J.match_consuming(left, right.limit(0), "ref", "amount", ["id"], ["cert"]).where("cert is null").count() == 7
    assert J.match_consuming(left.limit(0), right, "ref", "amount", ["id"], ["cert"]).count() == 0


def test_netting_plans_do_not_grow(spark):
    df = spark.createDataFrame([(1, 5, "u", 1)] * 3 + [(1, 5, "v", 2), (2, 6, "u", 3), (None, 1, "u", 4), (None, 1, "v", 5)], "k int, amount int, kind string, id int")
    one = (["k", "amount"], F.col("kind") == "u", F.col("kind") == "v")
    out = J.net_reversals_by_rule(df, [one] * 4)
    assert got(out, "id") == [(3,)] and out._jdf.queryExecution().optimizedPlan().toString().count("Relation") <= 2
    kept = J.net_reversals_by_rule(df, [(*one, False)])
    assert got(kept, "id") == [(2,), (3,), (5,)]


def test_ancestors_of_missing_and_repeated_keys(spark, monkeypatch):
    """The same trees under a named and a missing reference; rows of equal ids are followed one by one."""
    tree = [(1, None), (2, 1), (3, 2), (3, 2), (4, 3), (9, 8)]
    rows = [(r, i, p) for r in ("a", None) for i, p in tree]
    df = spark.createDataFrame(rows, "ref string, id int, parent int")

    def brute(levels):
        out = []
        for r, i, p in rows:
            paths = [((r, i, p), [])]
            for _ in range(levels):
                paths = [x for (last, anc) in paths for x in
                         ([(n, anc + [n]) for n in rows if len(anc) == len(anc) and last and n[0] == r and n[1] == last[2] and n[1] is not None] or [(None, anc + [None])])]
            out += [(r, i, *[a and a[1] for a in anc]) for _, anc in paths]
        return sorted(map(str, out))
    for levels in (1, 2, 3, 5):
        cols = [F.col(f"anc{v}_id") for v in range(1, levels + 1)]
        for small in (64, 3):
            monkeypatch.setattr(J, "SMALL_GROUP", small)
            got_rows = J.parent_join(df, "ref", "id", "parent", levels, []).select("ref", "id", *cols).collect()
            assert sorted(str(tuple(r)) for r in got_rows) == brute(levels)
    a = df.where("ref = 'a'").drop("ref")
    alone = J.parent_join(a, None, "id", "parent", 3, []).select("id", "anc1_id", "anc2_id", "anc3_id").collect()
    assert sorted(str((r.id, r.anc1_id, r.anc2_id, r.anc3_id)) for r in alone) == [x.replace("('a', ", "(") for x in brute(3) if x.startswith("('a'")]
