"""Keyed joins, merges and reconciliation patterns.

Physical strategy is Spark's: sort-merge for two large sides, broadcast where the
optimizer (or AQE at run time, from real shuffle sizes) sees a small side.  An explicit
``broadcast`` hint is only put on tables whose size has a proven bound (code tables
built in code, one-row calendars, per-partition offsets).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .keys import _cols, first_by, join_on, row_number_skew_safe, total_order

# an in-code lookup table up to so many rows is broadcast; a larger one is left to Spark
BROADCAST_CODE_ROWS = 100_000


def code_table(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A lookup table defined in code; its row count is the proven size bound."""
    table = spark.createDataFrame(rows, schema)
    return F.broadcast(table) if len(rows) <= BROADCAST_CODE_ROWS else table


def merge_left(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Keep every left row, add the right columns (SAS ``MERGE ... IF A``)."""
    return join_on(left, right, keys, "left")


class DuplicateKeyError(ValueError):
    pass


def merge_checked(left: DataFrame, right: DataFrame, keys, how: str = "left", on_duplicate: str = "raise",
                  right_order=None) -> DataFrame:
    """Many-to-one merge with the "one" side checked (the default for a MERGE that is
    meant to be 1:n).  ``on_duplicate='raise'`` fails when a key repeats on the right
    (this runs one aggregation job at once, while the plan is still being built; at
    most one offending key reaches the driver);
    ``'first'`` keeps the first right row per key under ``right_order``."""
    keys = _cols(keys)
    if on_duplicate == "first":
        right = first_by(right, keys, right_order or [])
    elif on_duplicate == "raise":
        dup = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").limit(1).collect()
        if dup:
            raise DuplicateKeyError(f"key repeats on the one side: {dup[0].asDict()}")
    else:
        raise ValueError(on_duplicate)
    return join_on(left, right, keys, how)


def with_indicators(left: DataFrame, right: DataFrame, keys, how: str = "full",
                    in_left: str = "in_a", in_right: str = "in_b") -> DataFrame:
    """``IN=`` flags as columns; keys coalesced (USING join)."""
    l = left.withColumn(in_left, F.lit(True))
    r = right.withColumn(in_right, F.lit(True))
    j = join_on(l, r, keys, how)
    return j.withColumn(in_left, F.coalesce(in_left, F.lit(False))) \
            .withColumn(in_right, F.coalesce(in_right, F.lit(False)))


def reconcile(a: DataFrame, b: DataFrame, keys, status: str = "status",
              labels=("matched", "only_a", "only_b")) -> DataFrame:
    """Full join of two feeds with a status per key: matched / only in a / only in b."""
    j = with_indicators(a, b, keys, "full", "__a", "__b")
    st = (F.when(F.col("__a") & F.col("__b"), F.lit(labels[0]))
           .when(F.col("__a"), F.lit(labels[1])).otherwise(F.lit(labels[2])))
    return j.withColumn(status, st).drop("__a", "__b")


def latest_as_of(rates: DataFrame, keys, date_col: str, value_cols, asof, order=None) -> DataFrame:
    """Newest value per key on or before ``asof`` (partial aggregation, skew-safe).

    Equal dates are resolved by ``order`` (extra tie-break columns), then the values."""
    vcols = _cols(value_cols)
    d = rates.where(F.col(date_col) <= asof)
    ordk = F.struct(F.col(date_col), *[F.col(o) for o in _cols(order)], *[F.col(v) for v in vcols])
    agg = [F.max_by(F.col(v), ordk).alias(v) for v in vcols] + [F.max(date_col).alias(date_col)]
    return d.groupBy(*_cols(keys)).agg(*agg)


def asof_join(facts: DataFrame, rates: DataFrame, keys, fact_time, rate_time, value: str, out: str,
              tie_break=None, bucket=None) -> DataFrame:
    """J13 per row: each fact gets the latest ``value`` of its key at or before its time.

    Facts and rates are stacked (a rate sorts before a fact at the same instant), the
    last non-missing rate is carried forward in time order and only fact rows are
    kept.  The carry is the two-level scan of ``keys.carry_last``: within (key, bucket)
    and then across buckets on one-row-per-(key, bucket) aggregates, so a hot key is
    spread over its buckets and no pairs of facts and rates are ever formed.
    ``fact_time`` / ``rate_time`` name the time columns; ``tie_break`` lists extra
    ordering columns present on the facts (e.g. a sequence id).
    """
    from .keys import carry_last
    keys = _cols(keys)
    tb = _cols(tie_break)
    f = facts.withColumn("__t", F.col(fact_time)).withColumn("__src", F.lit(1)).withColumn("__v", F.lit(None).cast(
        rates.schema[value].dataType))
    r = rates.select(*keys, F.col(rate_time).alias("__t"), F.lit(0).alias("__src"), F.col(value).alias("__v"))
    u = f.unionByName(r, allowMissingColumns=True)
    # rates at the same instant resolve deterministically (largest value last)
    order = ["__t", "__src", *tb, "__v"]
    b = bucket if bucket is not None else F.col("__t").cast("date")
    c = carry_last(u, keys, order, "__v", out, bucket=b)
    return c.where(F.col("__src") == 1).drop("__t", "__src", "__v")


def latest_effective(dim: DataFrame, keys, date_col: str, asof=None) -> DataFrame:
    """The newest version of each key (effective on or before ``asof``)."""
    d = dim if asof is None else dim.where(F.col(date_col) <= asof)
    return first_by(d, keys, [F.col(date_col).desc_nulls_last()])


def merge_by(left: DataFrame, right: DataFrame, keys, left_order, right_order,
             shared: list[str] | None = None, skew_safe: bool = True) -> DataFrame:
    """Positional BY-merge (many-to-many MERGE of sorted files).

    Within a key group the i-th left row pairs with the i-th right row; the shorter
    side repeats its last row; a column on both sides takes the right (read last)
    value whenever the right side still has a row at position i.

    Plan: number the rows of each side per key; per key, the longer side's rows are
    the output positions and each looks up the shorter side's row
    ``min(position, n_short)`` by an equi-join on (key, row number).  Nothing is
    exploded and no pairs beyond the result are formed; when the short side is tiny
    the lookup key is hot, which AQE's skew-join split handles on the long side.  With
    ``skew_safe`` the row numbers come from ``keys.row_number_skew_safe``.
    """
    from .keys import row_number_in
    keys = _cols(keys)
    shared = shared if shared is not None else [c for c in left.columns if c in right.columns and c not in keys]
    l = row_number_in(left, keys, left_order, "__i", skew_safe=skew_safe)
    r = row_number_in(right, keys, right_order, "__j", skew_safe=skew_safe)
    # the last number of a key is its count
    nl = l.groupBy(*keys).agg(F.max("__i").alias("__nl"))
    nr = r.groupBy(*keys).agg(F.max("__j").alias("__nr"))
    n = join_on(nl, nr, keys, "full").fillna(0, ["__nl", "__nr"])
    for c in shared:
        l = l.withColumnRenamed(c, f"__l_{c}")
        r = r.withColumnRenamed(c, f"__r_{c}")
    # right side drives where it is at least as long: position = j, left row min(j, nl)
    ra = (join_on(r, n.where(F.col("__nr") >= F.col("__nl")), keys)
           .withColumn("__i", F.when(F.col("__nl") > 0, F.least(F.col("__j"), F.col("__nl"))))
           .withColumn("__pos", F.col("__j")))
    a = join_on(ra, l, [*keys, "__i"], "left")
    # left side drives where it is longer: position = i, right row min(i, nr)
    lb = (join_on(l, n.where(F.col("__nl") > F.col("__nr")), keys)
           .withColumn("__j", F.when(F.col("__nr") > 0, F.least(F.col("__i"), F.col("__nr"))))
           .withColumn("__pos", F.col("__i")))
    b = join_on(lb, r, [*keys, "__j"], "left")
    j = a.unionByName(b)
    for c in shared:
        j = j.withColumn(c, F.when(F.col("__nr") >= F.col("__pos"), F.col(f"__r_{c}")).otherwise(F.col(f"__l_{c}")))
    return j.drop(*[f"__l_{c}" for c in shared], *[f"__r_{c}" for c in shared],
                  "__i", "__j", "__nl", "__nr").withColumnRenamed("__pos", "merge_pos")


def n_way_merge(frames: list[DataFrame], keys, how: str = "full") -> DataFrame:
    """Merge several tables on one key.  Each input is shuffled once on the key;
    consecutive joins on the same key reuse that partitioning (no re-shuffle)."""
    return reduce(lambda a, b: join_on(a, b, keys, how), frames)


# groups of up to so many rows are walked in one array; larger ones by joins
SMALL_GROUP = 64


def ancestor_paths(nodes: DataFrame, within: list[str], node: str, parent: str, length: int, keep: list[str], path: str = "path") -> DataFrame:
    """Paths of up to ``length`` rows from each row upwards, by pointer jumping.

    A path of 2k rows is a path of k rows joined with the path of k rows that starts at
    the parent of its last one, so the joins are as many as the binary digits of
    ``length`` need, not one per step.  Rows that share their (within, node) are
    followed one by one; a missing key matches a missing key (R3).
    """
    entry = F.struct(F.col(node).alias("node"), F.col(parent).alias("parent"), *[F.col(k).alias(k) for k in keep])
    one = nodes.select(*[F.col(w).alias(f"__w{i}") for i, w in enumerate(within)], F.col(node).alias("__node"), F.array(entry).alias("__path"))
    keys = [f"__w{i}" for i in range(len(within))]

    def joined(low: DataFrame, size: int, high: DataFrame) -> DataFrame:
        # a path that is not full has ended: it asks for nothing (and must not ask for the missing node)
        asks = low.withColumn("__full", F.size("__path") == size).withColumn("__next", F.element_at("__path", -1)["parent"])
        up = high.select(*[F.col(k).alias(f"{k}r") for k in keys], F.col("__node").alias("__up"), F.col("__path").alias("__more"))
        cond = F.col("__full") & F.col("__next").eqNullSafe(F.col("__up"))
        for k in keys:
            cond = cond & F.col(k).eqNullSafe(F.col(f"{k}r"))
        return asks.join(up, cond, "left").select(*keys, "__node", F.concat("__path", F.coalesce("__more", F.array().cast(low.schema["__path"].dataType))).alias("__path"))
    powers, size = {1: one}, 1
    while 2 * size <= length:
        powers[2 * size] = joined(powers[size], size, powers[size])
        size *= 2
    out, have = powers[size], size
    while have < length:
        size = max(p for p in powers if p <= length - have)
        out, have = joined(out, have, powers[size]), have + size
    return out.select(*[F.col(k).alias(w) for k, w in zip(keys, within)], F.col("__node").alias(node), F.col("__path").alias(path))


def parent_join(df: DataFrame, ref: str | None, child_id: str, parent_id: str, levels: int,
                keep: list[str]) -> DataFrame:
    """Up to ``levels`` ancestors of each row within its ``ref`` (``None``: anywhere),
    as a left join per level would give them; missing keys match missing keys (R3).

    References of up to ``SMALL_GROUP`` rows are gathered and walked in one array: one
    exchange on the reference serves all levels.  Larger ones, missing ones, and a walk
    without a reference, go by pointer jumping (``ancestor_paths``).
    """
    names = [n for lv in range(1, levels + 1) for n in (f"anc{lv}_id", f"anc{lv}_parent", *[f"anc{lv}_{k}" for k in keep])]

    def columns(step) -> list[Column]:
        out = []
        for lv in range(1, levels + 1):
            a = step(lv)
            out += [a["node"].alias(f"anc{lv}_id"), a["parent"].alias(f"anc{lv}_parent"), *[a[k].alias(f"anc{lv}_{k}") for k in keep]]
        return out

    def by_jumps(rows: DataFrame) -> DataFrame:
        within = [ref] if ref else []
        up = ancestor_paths(df, within, child_id, parent_id, levels, keep, "__up").withColumnsRenamed({child_id: "__id", **({ref: "__ref"} if ref else {})})
        cond = F.col(parent_id).eqNullSafe(F.col("__id"))
        if ref:
            cond = cond & F.col(ref).eqNullSafe(F.col("__ref"))
        return rows.join(up, cond, "left").select(*[F.col(c) for c in rows.columns], *columns(lambda lv: F.get("__up", F.lit(lv - 1))))
    if not ref:
        return by_jumps(df)
    # plain equality, so that the rows dealt by reference for this join are dealt for the arrays too; a missing reference counts as large
    known = df.where(F.col(ref).isNotNull())
    small = known.groupBy(F.col(ref).alias("__of")).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") <= SMALL_GROUP).select("__of")
    few = known.join(small, F.col(ref) == F.col("__of")).drop("__of")
    entry = F.struct(F.col(child_id).alias("node"), F.col(parent_id).alias("parent"), *[F.col(k).alias(k) for k in keep])
    groups = few.groupBy(ref).agg(F.collect_list(F.struct(F.struct(*[F.col(c) for c in df.columns]).alias("row"), entry.alias("self"))).alias("__rows"))
    nothing = F.lit(None).cast(df.select(entry.alias("e")).schema["e"].dataType)

    def climb(paths: Column, lv: int) -> Column:
        def step(p: Column) -> Column:
            last = p["self"] if lv == 1 else p[f"a{lv - 1}"]
            above = F.filter(F.transform("__rows", lambda r: r["self"]), lambda n: last.isNotNull() & n["node"].eqNullSafe(last["parent"]))
            above = F.when(F.size(above) == 0, F.array(nothing)).otherwise(above)
            kept = ["row", "self", *[f"a{i}" for i in range(1, lv)]]
            return F.transform(above, lambda a: F.struct(*[p[k].alias(k) for k in kept], a.alias(f"a{lv}")))
        return F.flatten(F.transform(paths, step))
    paths = F.col("__rows")
    for lv in range(1, levels + 1):
        paths = climb(paths, lv)
    walked = groups.select(F.explode(paths).alias("__p")).select("__p.row.*", *columns(lambda lv: F.col(f"__p.a{lv}")))
    rest = by_jumps(known.join(small, F.col(ref) == F.col("__of"), "left_anti").unionByName(df.where(F.col(ref).isNull())))
    return walked.select(*df.columns, *names).unionByName(rest.select(*df.columns, *names))


def match_with_fallback(left: DataFrame, right: DataFrame, strong, weak, right_order) -> DataFrame:
    """Two-pass match.  Pass 1 on the strong key; unmatched left rows try the weak
    key against right rows made unique on it.  ``match_pass`` says which pass hit."""
    strong, weak = _cols(strong), _cols(weak)
    dup = [c for c in right.columns if c in left.columns and c not in strong]
    p1 = join_on(left, right.drop(*dup).withColumn("__hit", F.lit(1)), strong)
    rest = join_on(left, right.select(*strong).distinct(), strong, "left_anti")
    r2 = first_by(right, weak, right_order)
    rcols = [c for c in right.columns if c not in weak and c not in left.columns]
    p2 = join_on(rest, r2.select(*weak, *rcols).withColumn("__hit", F.lit(2)), weak, "left")
    return p1.unionByName(p2, allowMissingColumns=True).withColumnRenamed("__hit", "match_pass")


def match_consuming(left: DataFrame, right: DataFrame, strong, weak, left_order, right_order, weak_right: Column | None = None) -> DataFrame:
    """J16 with consumption: every right row is used once.

    Rows of equal strong keys pair k-th with k-th; what is left on either side pairs k-th
    with k-th over the weak keys (right rows only where ``weak_right`` holds).  Left rows
    all come back, with the right columns that they do not have themselves and
    ``match_pass`` (missing where no pass hit).  The first pairing is written once; the second
    reads its left and right remainders from there.
    """
    from ..sinks.writers import scratch_table
    strong, weak = _cols(strong), _cols(weak)
    own = [c for c in right.columns if c not in left.columns]
    r = right.withColumnsRenamed({c: f"__r_{c}" for c in right.columns if c not in strong})
    l = row_number_skew_safe(left, strong, total_order(left, strong, left_order), "__k").withColumn("__in_l", F.lit(True))
    renamed = [f"__r_{c}" if c not in strong else c for c in _cols(right_order)]
    r = row_number_skew_safe(r, strong, total_order(r, strong, renamed), "__k").withColumn("__in_r", F.lit(True))
    first = scratch_table(join_on(l, r, [*strong, "__k"], "full").drop("__k"), "match-first")

    def result(df: DataFrame, which: Column) -> DataFrame:
        return df.select(*left.columns, *[F.col(f"__r_{c}").alias(c) for c in own], which.cast("int").alias("match_pass"))
    hit = result(first.where("__in_l AND __in_r"), F.lit(1))
    rest = first.where("__in_l AND __in_r IS NULL").select(*left.columns)
    free = first.where("__in_r AND __in_l IS NULL").select(*[(F.col(f"__r_{c}") if c not in strong else F.col(c)).alias(c) for c in right.columns])
    free = free.where(weak_right) if weak_right is not None else free
    free = free.select(*weak, *[F.col(c).alias(f"__r_{c}") for c in own])
    l2 = row_number_skew_safe(rest, weak, total_order(rest, weak, left_order), "__k")
    r2 = row_number_skew_safe(free, weak, total_order(free, weak, [f"__r_{c}" if c in own else c for c in _cols(right_order)]), "__k").withColumn("__hit", F.lit(2))
    return hit.unionByName(result(join_on(l2, r2, [*weak, "__k"], "left"), F.col("__hit")))


def net_reversals(txn: DataFrame, keys, amount: str, date: str, order) -> DataFrame:
    """Drop debit/credit pairs of equal (key, |amount|, date), k-th with k-th.

    Debits and credits are counted per group first; only rows of groups that hold both
    signs are numbered, by position over range partitions, so that neither a large
    group nor the rest of the table passes through a window.  The unmatched surplus of
    the larger side survives in ``order``; rows with an amount of zero always do.
    """
    keys = _cols(keys)
    grp = [*keys, "__abs", date]
    d = txn.withColumn("__abs", F.abs(F.col(amount))).withColumn("__neg", F.col(amount) < 0)
    both = (d.groupBy(*grp).agg(F.count_if(F.col("__neg")).alias("__nd"), F.count_if(~F.col("__neg")).alias("__nc"))
             .where((F.col("__nd") > 0) & (F.col("__nc") > 0)).withColumn("__pairs", F.least("__nd", "__nc")).drop("__nd", "__nc"))
    single = join_on(d, both, grp, "left_anti")
    paired = row_number_skew_safe(join_on(d, both, grp), [*grp, "__neg"], total_order(txn, keys, order), "__k")
    kept = paired.where((F.col("__k") > F.col("__pairs")) | (F.col(amount) == 0))
    return single.select(*txn.columns).unionByName(kept.select(*txn.columns))


def net_reversals_by_rule(txn: DataFrame, passes: list[tuple]) -> DataFrame:
    """J18 by rule: successive passes, each with its key, the rows that may be reversed
    and the rows that reverse them.

    In a pass, a row that may be reversed is dropped when its key occurs among the
    reversing rows left over from earlier passes, and those go with it: *every* match of
    a key is removed, on both sides, not the k-th with the k-th.  A pass with a fourth
    entry ``False`` leaves the reversing rows where they are.

    A pass reads its input twice: one aggregation gives each key the flags "has a row
    that may be reversed" and "has a reversing row", and only keys with both are joined
    back.  Each pass's residue is written and read again (two reads per pass, whatever
    came before), so the plan does not grow with the passes.
    """
    from ..sinks.writers import scratch_table
    left = txn
    for i, (keys, reversed_, reversing, *both) in enumerate(passes):
        a, b = F.coalesce(reversed_, F.lit(False)), F.coalesce(reversing, F.lit(False))
        hit = left.where(a | b).groupBy(*keys).agg(F.bool_or(a).alias("__a"), F.bool_or(b).alias("__b")).where("__a AND __b").select(*keys, F.lit(True).alias("__hit"))
        goes = a | b if not both or both[0] else a
        kept = join_on(left, hit, keys, "left").where(~(F.col("__hit").isNotNull() & goes)).select(*txn.columns)
        left = scratch_table(kept, f"netting-{i}") if i + 1 < len(passes) else kept
    return left


def closed_items(current: DataFrame, previous: DataFrame, activity: DataFrame, keys) -> DataFrame:
    """Keys with activity this period that were in the prior period but are gone
    from the current one, carrying the prior row (once, however often the key is
    active); unioned to the current table."""
    keys = _cols(keys)
    gone = join_on(activity.select(*keys), current.select(*keys), keys, "left_anti")
    closed = join_on(previous, gone, keys, "left_semi").withColumn("closed", F.lit(True))
    return current.withColumn("closed", F.lit(False)).unionByName(closed, allowMissingColumns=True)


def snapshot_compare(cur: DataFrame, prev: DataFrame, keys, date_col: str) -> DataFrame:
    """Keys whose date moved forward between two generations."""
    keys = _cols(keys)
    p = prev.select(*keys, F.col(date_col).alias("prev_" + date_col))
    return join_on(cur, p, keys).where(F.col(date_col) > F.col("prev_" + date_col))


def carry_forward_prior(cur: DataFrame, prior: DataFrame, keys, value: str, apply_when: Column) -> DataFrame:
    """Full merge with the previous snapshot; where ``apply_when`` holds and today's
    value is zero, yesterday's value is used."""
    keys = _cols(keys)
    p = prior.select(*keys, F.col(value).alias("prior_" + value))
    j = join_on(cur, p, keys, "full")
    return j.withColumn(value, F.when(apply_when & (F.coalesce(F.col(value), F.lit(0)) == 0),
                                      F.col("prior_" + value)).otherwise(F.col(value)))


def wildcard_lookup(df: DataFrame, rows: list[tuple], keys: list[str], key_types: list[str], values: dict[str, str]) -> DataFrame:
    """The most specific row of a code table whose rows may leave keys open.

    ``rows`` holds (key values, layer, values): a missing key matches anything.  Rows are grouped
    by layer and by which keys they name, one broadcast equi-join per group; of the groups
    that hit, the highest layer and in it the most named keys gives each value (a missing
    value passes on to the next).  Of rows with equal keys in one group, the first listed wins.
    """
    n, out, found = len(keys), df, {v: [] for v in values}
    groups = sorted({(r[n], sum(k is not None for k in r[:n]), tuple(k is not None for k in r[:n])) for r in rows}, reverse=True)
    for g, (layer, _, named) in enumerate(groups):
        mine, seen = [], set()
        for r in rows:
            key = tuple(k for k, yes in zip(r[:n], named) if yes)
            if r[n] == layer and tuple(k is not None for k in r[:n]) == named:
                for v, value in enumerate(r[n + 1:]):
                    if value is not None and (key, v) not in seen:
                        seen.add((key, v))
                        mine.append((key, v, value))
        asked = [k for k, yes in zip(keys, named) if yes]
        kinds = [t for t, yes in zip(key_types, named) if yes]
        table = {}
        for key, v, value in mine:
            table.setdefault(key, [None] * len(values))[v] = value
        schema = ", ".join([f"__k{g}_{i} {t}" for i, t in enumerate(kinds)] + [f"__v{g}_{v} {t}" for v, t in values.items()])
        t = code_table(df.sparkSession, [(*k, *v) for k, v in table.items()], schema)
        cond = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__k{g}_{i}") for i, k in enumerate(asked)])
        out = out.join(t, cond, "left")
        for v in values:
            found[v].append(F.col(f"__v{g}_{v}"))
    picked = {v: F.coalesce(*found[v]) for v in values}
    return out.select(*[F.col(c) for c in df.columns if c not in values], *[c.alias(v) for v, c in picked.items()])


def union_lookup(masters: list[DataFrame], key: str, value: str) -> DataFrame:
    """One lookup table from several masters (first listed wins on a repeated key)."""
    tagged = [m.select(F.col(key), F.col(value), F.lit(i).alias("__src")) for i, m in enumerate(masters)]
    u = reduce(lambda a, b: a.unionByName(b), tagged)
    return first_by(u, key, ["__src"]).drop("__src")
