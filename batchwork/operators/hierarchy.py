"""Parent/child hierarchies: ancestor chains, level assignment, node roles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import ancestor_paths, parent_join
from .keys import best_with_ties, join_on


def parent_chain_depth(df: DataFrame, ref: str | None, child_id: str, parent_id: str, levels: int = 3,
                       rank_by: str | None = None) -> DataFrame:
    """H1: walk up to ``levels`` ancestors, count how many were found (depth), and keep
    per ``rank_by`` (default ``ref``) only the deepest rows (rank 1, ties kept)."""
    chain = parent_join(df, ref, child_id, parent_id, levels, keep=[])
    depth = sum((F.col(f"anc{i}_id").isNotNull().cast("int") for i in range(1, levels + 1)), F.lit(0))
    chain = chain.withColumn("depth", depth)
    return best_with_ties(chain, rank_by or ref, [F.col("depth").desc()])


def assign_levels(nodes: DataFrame, node: str, parent: str, root_value, max_level: int = 5,
                  account: str | None = None) -> DataFrame:
    """H2: level of each node below its account's root, and the path to it.

    Level 1 = the root ``root_value``; level i = a child of a level i-1 node of the same
    account.  ``path`` lists the nodes from the root down to the node itself (LEVEL1 ...
    LEVEL5).  Nodes not reached within ``max_level`` levels (too deep, orphans, cycles, an
    account without a root row) have a null level and path.

    Paths come by pointer jumping over the narrow parent table (``joins.ancestor_paths``):
    three joins for five levels.  A node listed under several parents takes the smallest.
    """
    acc = [account] if account else []
    up = nodes.groupBy(*acc, node).agg(F.min(parent).alias("__up"))
    paths = ancestor_paths(up, acc, node, "__up", max_level, [], "__path")
    ids = F.transform("__path", lambda p: p["node"])
    found = paths.select(*acc, node, F.array_position(ids, F.lit(root_value).cast(nodes.schema[node].dataType)).cast("int").alias("level"), ids.alias("__ids")).where("level > 0")
    found = found.select(*acc, node, F.reverse(F.slice("__ids", 1, F.col("level"))).alias("path"), "level")
    return join_on(nodes, found, [*acc, node], "left")


def level_columns(df: DataFrame, max_level: int = 5, prefix: str = "level") -> DataFrame:
    """LEVEL1 ... LEVELn from the path (null where the node lies higher)."""
    return df.withColumns({f"{prefix}{i}": F.get("path", F.lit(i - 1)) for i in range(1, max_level + 1)})


# facility numbers start with one of these (fixed values)
FACILITY_FIRST = list("123456789ABCDEFGH")


def facility_node(sub_account, relation) -> tuple[Column, Column, Column]:
    """H3: facility, parent and kind of a sub-account row; successive rules, the last match wins.

    Kinds: A root (``OV`` without a relation), B facility group (``FA``), C sub-limit (``F?SB``),
    X row that relates to a numbered facility, E any other.
    """
    sub, rel = F.rtrim(F.col(sub_account)), F.coalesce(F.rtrim(F.col(relation)), F.lit(""))
    first5 = F.rtrim(F.substring(sub, 1, 5))
    rules = [((rel == "") & (sub == "OV"), "OV", F.lit("NIL"), "A"),
             (F.substring(sub, 1, 1).isin(FACILITY_FIRST), first5, rel, None),
             (F.substring(rel, 1, 1).isin(FACILITY_FIRST[:9]), first5, rel, "X"),
             (sub.startswith("FA"), first5, F.lit("OV"), "B"),
             (sub.startswith("F") & (F.substring(sub, 3, 2) == "SB"), sub, rel, "C")]
    facility, parent, kind = F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit("E")
    for when, f, p, k in rules:
        facility, parent = F.when(when, f).otherwise(facility), F.when(when, p).otherwise(parent)
        kind = F.when(when, F.lit(k)).otherwise(kind) if k else kind
    return facility, parent, kind


def node_role(id_col, rules: list[tuple[str, str]], default: str = "OTHER"):
    """Role from id patterns, successive rules with the last match winning."""
    out = F.lit(default)
    for pattern, role in rules:           # applied in order: later rules overwrite
        out = F.when(F.col(id_col).rlike(pattern), F.lit(role)).otherwise(out)
    return out


def strip_level_prefix(label):
    """H4: a label that starts with a level digit becomes its next three characters."""
    c = F.col(label)
    return F.when(c.rlike("^[1-9]"), F.substring(c, 2, 3)).otherwise(c)
