"""Plan checks: pushdown, pruning, group limits before the shuffle, broadcast only
for bounded tables, no single-partition exchange on data-sized inputs."""

import re

from pyspark.sql import functions as F

from batchwork.queries import all_queries

SF = "/root/testdata/sf0.001"
Q = all_queries()


def plan(spark, key):
    df = Q[key](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_scan(spark):
    p = plan(spark, "scan_filter_pushdown")
    assert "PushedFilters: [IsNotNull(l_quantity), IsNotNull(l_returnflag), GreaterThan(l_quantity,45.0)" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_returnflag:string>" in p


def test_first_by_limits_groups_before_shuffle(spark):
    p = plan(spark, "first_by_key")
    # a partial WindowGroupLimit sits below the exchange: a hot key is cut map-side
    below = p.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in below


def test_code_tables_broadcast(spark):
    assert "BroadcastHashJoin" in plan(spark, "code_remap")


def test_numbered_lines_single_partition_only_for_offsets(spark):
    p = plan(spark, "numbered_lines")
    assert "rangepartitioning" in p
    # the only SinglePartition exchange feeds the per-partition offsets window
    for chunk in p.split("Exchange SinglePartition")[1:]:
        assert "__cnt" in p and "rangepartitioning" in chunk


def test_no_cartesian_products(spark):
    for k in Q:
        p = plan(spark, k)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, k


def test_ranks_window_over_counted_values(spark):
    p = plan(spark, "rank_ties_low")
    # rows are counted per value before the window, and the window sees the counts alone
    window = p[p.index("Window"):]
    assert "functions=[partial_count(1)" in window


def test_positional_merge_sorts_each_side_once(spark):
    p = plan(spark, "positional_merge")
    assert "rangepartitioning" in p and "Cartesian" not in p


def test_numbering_shuffles_the_rows_once(spark):
    """One range exchange, read by both branches; what is joined back is one row per partition."""
    from batchwork.operators import keys as K
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    out = K.row_number_skew_safe(li, "l_orderkey", [F.col("l_linenumber").asc()], "rn")
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len(re.findall(r"\+- Exchange rangepartitioning", final)) == 1 and "ReusedExchange" in final
    assert "SortMergeJoin" not in final


def test_rates_are_looked_up_by_flag_and_no_line_is_dealt_by_currency(spark):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # rates whose size Spark can't see, as on a large events table
    try:
        p = plan(spark, "fx_convert")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    above = p.split("FileScan parquet [l_orderkey")[0]
    assert "BroadcastHashJoin [l_returnflag" in above and "Exchange" not in above


def test_collateral_classes_and_tables_are_settled_before_items_meet_accounts(spark):
    p = plan(spark, "pl_collateral")
    # one Generate per source below the union, none on the pairs above it
    assert p.count("Generate explode") == 4 and p.index("Union") < p.index("Generate explode")


def test_file_records_are_projected_not_interpreted_in_the_generator(spark):
    from batchwork.sinks import writers as W
    df = spark.range(3).select(F.col("id"), (F.col("id") * 2).alias("amount"))
    out = W.file_records(df, [("all", None, W.parse_layout("id z4 | amount z5")), ("some", F.col("id") > 1, W.parse_layout("id z3")), ("none", F.col("id") > 9, W.parse_layout("id z3"))], ["id"])
    lines = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    # the generator reads a finished array; the records are computed once, below it
    generators = [line for line in lines if "Generate " in line]
    assert len(generators) == 1 and "concat(" not in generators[0] and "array_compact" not in generators[0] and "filter(" not in generators[0]
    assert sum("array(" in line for line in lines) == 1
    assert sorted((r.id, r.file, r.record) for r in out.collect()) == [(0, "all", "000000000"), (1, "all", "000100002"), (2, "all", "000200004"), (2, "some", "002")]


def test_rows_of_a_reference_are_dealt_once_for_their_parent_arrays(spark):
    from batchwork.operators.joins import parent_join
    rows = spark.createDataFrame([("a", 1, None), ("a", 2, 1), ("b", 2, 1), (None, 1, None), (None, 2, 1)], "ref string, id int, parent int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = parent_join(rows, "ref", "id", "parent", 2, [])
        assert sorted(map(str, out.select("ref", "id", "anc1_id").collect())) == sorted(map(str, spark.createDataFrame(
            [("a", 1, None), ("a", 2, 1), ("b", 2, None), (None, 1, None), (None, 2, 1)], "ref string, id int, anc1_id int").collect()))
        p = parent_join(rows, "ref", "id", "parent", 2, [])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    arrays = p.split("collect_list")
    assert len(arrays) > 2
    # no exchange between the partial and the final gathering
    assert "Exchange" not in arrays[1].split("functions=[partial_")[0]


def _widths(node, kind):
    """How many columns come out of each node of a kind, in a logical plan."""
    own = [node.output().size()] if node.nodeName().startswith(kind) else []
    return own + [w for i in range(node.children().size()) for w in _widths(node.children().apply(i), kind)]


def test_rule_levels_of_the_loan_register_carry_the_wide_row_as_one_value(spark):
    from batchwork.plans import registers as P
    from batchwork.queries import registers as QR
    book = QR.register_book(spark, SF)
    rated = P.rated_accounts(book, QR.REPORT_DATE)
    widths = _widths(rated._jdf.queryExecution().optimizedPlan(), "Project")
    # the rated accounts themselves, and the feed that is put into the struct; no level between them
    assert sum(w > 60 for w in widths) <= 2 and len(widths) > 15


def test_loan_register_moves_no_wide_rows_between_tasks(spark):
    from batchwork.queries import registers as QR
    windows = _widths(Q["pl_loan_register"](spark, SF)._jdf.queryExecution().optimizedPlan(), "Window")
    assert windows and max(windows) < 60
    # the orders are dealt by account, not the accounts derived from them
    dealt = _widths(QR.register_book(spark, SF)._jdf.queryExecution().optimizedPlan(), "Repartition")
    assert len(dealt) == 1 and dealt[0] < 10
