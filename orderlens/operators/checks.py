"""A16 row counts, A17 key uniqueness, J9 old-vs-new reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

#: Children of a node of the checksum tree, its levels, and the unequal nodes that are told apart further.
FANOUT, LEVELS, MAX_NODES = 64, 3, 4096


def duplicate_keys(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """Keys occurring more than once, with their count (empty = unique)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)


def with_counts(df: DataFrame, step: str, **more: Column) -> tuple[DataFrame, Observation]:
    """Count rows of a step as a side effect of the action that runs it
    (no extra job).  ``obs.get['rows']``, and ``more`` aggregates by name, are
    available after that action."""
    obs = Observation(step)
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in more.items()]), obs


def reconcile(old: DataFrame, new: DataFrame, key: str, compare: list[str]) -> DataFrame:
    """One row - total keys, keys only in new, only in old, and per
    compared column the number of common keys whose values differ
    (NULL-safe)."""
    o = old.select(F.col(key).alias("__ok"), *[F.col(c).alias(f"__o_{c}") for c in compare])
    n = new.select(F.col(key).alias("__nk"), *[F.col(c).alias(f"__n_{c}") for c in compare])
    j = o.join(n, o["__ok"] == n["__nk"], "full_outer")
    both = F.col("__ok").isNotNull() & F.col("__nk").isNotNull()
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("__ok").isNull(), 1)).alias("only_new"),
        F.count(F.when(F.col("__nk").isNull(), 1)).alias("only_old"),
    ] + [F.count(F.when(both & ~F.col(f"__o_{c}").eqNullSafe(F.col(f"__n_{c}")), 1)).alias(f"{c}_diff")
         for c in compare]
    return j.agg(*aggs)


def _checksums(old: DataFrame, new: DataFrame, key: str, compare: list[str], node: Column) -> DataFrame:
    """Per node: rows of either table (``old``, ``new``), whether the node is ``unequal``,
    and in ``differ`` a 0 or 1 per compared column.  Both tables go through one aggregate:
    for the keys and every compared column it sums the halves of a 64-bit hash over key and
    value, those of ``new`` negated, so equal nodes give zeros.  Sums do not depend on the
    order of rows and are exact in a long up to 2**31 rows a node."""
    terms = [F.xxhash64(key)] + [F.xxhash64(F.col(key), F.col(c), F.col(c).isNull()) for c in compare]
    hashes = [f"h{i}" for i in range(len(terms))]
    both = old.select(node.alias("node"), F.lit(1).alias("sign"), *[h.alias(n) for h, n in zip(terms, hashes)]).unionByName(
        new.select(node.alias("node"), F.lit(-1).alias("sign"), *[h.alias(n) for h, n in zip(terms, hashes)]))
    sums = [F.sum(half * F.col("sign")).alias(f"{n}_{k}") for n in hashes
            for k, half in enumerate((F.shiftrightunsigned(n, 32), F.col(n).bitwiseAND(F.lit(0xFFFFFFFF))))]
    apart = [(F.col(f"{n}_0") != 0) | (F.col(f"{n}_1") != 0) for n in hashes]
    keys_apart = (F.col("old") != F.col("new")) | apart[0]
    return (both.groupBy("node")
            .agg(F.count(F.when(F.col("sign") > 0, 1)).alias("old"), F.count(F.when(F.col("sign") < 0, 1)).alias("new"), *sums)
            .select("node", "old", "new", reduce(lambda x, y: x | y, apart[1:], keys_apart).alias("unequal"),
                    F.concat(F.lit(""), *[F.when(keys_apart | x, "1").otherwise("0") for x in apart[1:]]).alias("differ")))


def reconcile_tree(old: DataFrame, new: DataFrame, key: str, compare: list[str],
                   fanout: int = FANOUT, levels: int = LEVELS, max_nodes: int = MAX_NODES) -> DataFrame:
    """J9 by a checksum tree: the row of :func:`reconcile`, for unique keys.

    Keys fall into ``fanout`` nodes by hash, each node into as many on the next level.
    A level is one aggregate over both tables, over the rows of the nodes that were
    unequal one level up and the columns that differ somewhere.  Equal nodes only add
    their rows.  The rows of the unequal nodes of the last level are joined and
    compared, and only in columns whose sums differ.  Equal tables therefore cost one
    aggregate and no join, few changes a join of few rows.  The aggregates combine
    map-side, and the driver sees at most ``max_nodes * fanout`` nodes a level: where more
    nodes differ, the descent ends and their rows are joined.  The rows of unequal nodes
    are met by a semi-join with a broadcast of the nodes' numbers, never by a list in the
    plan; where all nodes of a level are unequal there is nothing to pick.

    Unequal cells go unseen when both 32-bit sums of their node collide, about one in
    2**64 comparisons.  NULL keys match nothing and are counted as :func:`reconcile`
    does.  Keys of different types hash differently: those tables are joined whole.
    """
    if old.schema[key].dataType != new.schema[key].dataType:
        return reconcile(old, new, key, compare)
    hashed, known = F.xxhash64(key), F.col(key).isNotNull()
    old, new = old.select(key, *compare), new.select(key, *compare)
    sides, same, nulls, within, columns = [old, new], 0, 0, 0, list(compare)
    unequal: list[int] = []
    for level in range(1, levels + 1):
        node = F.when(known, F.pmod(hashed, F.lit(fanout ** level)))
        if level > 1:
            sides = _in_nodes([old, new], hashed, fanout ** (level - 1), unequal)
        found = _checksums(*sides, key, columns, node)
        rows = (found if level == 1 else found.where("unequal")).collect()
        if level == 1:
            nulls = sum(r["old"] + r["new"] for r in rows if r["node"] is None)
            within = sum(r["old"] for r in rows if r["node"] is not None)
        rows = [r for r in rows if r["node"] is not None and r["unequal"]]
        left = sum(r["old"] for r in rows)
        same, within, unequal = same + within - left, left, [r["node"] for r in rows]
        differ = {r["differ"] for r in rows}
        columns = [c for i, c in enumerate(columns) if any(d[i] == "1" for d in differ)]
        if not unequal or len(unequal) > max_nodes:
            break
    counts = {"n": same + nulls, "only_new": nulls, "only_old": nulls}
    if not unequal:
        return old.sparkSession.range(1).select(
            *[F.lit(v).cast("long").alias(c) for c, v in counts.items()],
            *[F.lit(0).cast("long").alias(f"{c}_diff") for c in compare])
    part = reconcile(*_in_nodes([old, new], hashed, fanout ** level, unequal), key, columns)
    return part.select(
        *[(F.col(c) + F.lit(v).cast("long")).alias(c) for c, v in counts.items()],
        *[(F.col(f"{c}_diff") if c in columns else F.lit(0).cast("long")).alias(f"{c}_diff") for c in compare])


def _in_nodes(sides: list[DataFrame], hashed: Column, n: int, nodes: list[int]) -> list[DataFrame]:
    """The rows whose key falls into one of ``nodes`` of a level of ``n`` nodes.  A list of
    literals costs the driver and every task time and memory per node; the broadcast holds
    at most ``max_nodes * fanout`` numbers."""
    known = [df.where(F.col(df.columns[0]).isNotNull()) for df in sides]
    if len(nodes) == n:
        return known
    listed = sides[0].sparkSession.createDataFrame([(x,) for x in nodes], "__node long")
    return [df.join(F.broadcast(listed), F.pmod(hashed, F.lit(n)) == F.col("__node"), "left_semi") for df in known]


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    """Raise if ``keys`` are not unique (a run-time primary-key check)."""
    dup = duplicate_keys(df, keys).limit(1).collect()
    if dup:
        raise ValueError(f"duplicate key {dict(dup[0].asDict())} for {keys}")


__all__ = ["duplicate_keys", "with_counts", "reconcile", "reconcile_tree", "assert_unique"]
