"""Hot keys: split them out of shuffled joins.

Aggregations here never need this: they combine map-side, so a hot key
reaches the shuffle pre-aggregated.  A join cannot pre-aggregate.  In a
many-to-one join (big side, at most one small-side row per key - a join back
of per-key aggregates, a lookup, a latest record), a key holding a third of
the big side would put a third of the rows through one sort-merge task.
AQE splits a skewed partition of such a join, but only when both join inputs
are plain shuffle stages: an aggregate between the exchange and the join keeps
it from splitting.  ``plain_stage`` puts the reduced side behind one more, small
shuffle, so the joins here are split by default (tests/test_skew.py looks for
``skew=true`` in the final plans).

``join_to_one`` with known hot keys does not depend on AQE: rows of the hot keys
join a broadcast of their (at most ``len(hot_keys)``) small-side rows where they
are, without any shuffle; all other rows take the ordinary shuffled join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def plain_stage(reduced: DataFrame) -> DataFrame:
    """``reduced`` (an aggregate, joined next by its key) as a shuffle stage of its
    own, so that AQE may split a skewed partition of the other side."""
    return reduced.hint("rebalance")


def find_hot_keys(df: DataFrame, keys: list[str], min_rows: int) -> list[tuple]:
    """Keys with at least ``min_rows`` rows: one partial aggregate over the key
    columns and a collect of at most rows/min_rows keys.  NULL keys are ignored."""
    not_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    rows = (df.where(not_null).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
              .where(F.col("__n") >= min_rows).select(*keys).collect())
    return [tuple(r) for r in rows]


def _in_keys(cols: list[Column], hot_keys: list[tuple]) -> Column:
    if len(cols) == 1:
        return cols[0].isin([k[0] for k in hot_keys])
    return reduce(lambda a, b: a | b, [
        reduce(lambda x, y: x & y, [c == F.lit(v) for c, v in zip(cols, k)]) for k in hot_keys])


def join_to_one(big: DataFrame, small: DataFrame, on: list[tuple[str, str]], how: str,
                hot_keys: list[tuple] | None) -> DataFrame:
    """``big JOIN small ON big.k = small.k`` for a small side with at most one
    row per key; ``how`` is 'inner' or 'left' (big preserved).  Same rows as
    the plain join; rows of ``hot_keys`` never pass through a shuffle.  The
    result has big's columns and small's non-key columns (small's key columns
    equal big's where matched)."""
    if how not in ("inner", "left"):
        raise ValueError("join_to_one supports how='inner' or 'left'")

    def cond(b: DataFrame, s: DataFrame) -> Column:
        return reduce(lambda a, c: a & c, [b[bc] == s[sc] for bc, sc in on])

    small_keys = {sc for _, sc in on}
    extra = [c for c in small.columns if c not in small_keys]
    clash = [c for c in extra if c in big.columns]
    if clash:
        raise ValueError(f"join_to_one: columns on both sides: {clash}")

    def joined(b: DataFrame, s: DataFrame, broadcast: bool) -> DataFrame:
        s2 = F.broadcast(s) if broadcast else s
        return b.join(s2, cond(b, s), how).select(*[b[c] for c in b.columns], *[s[c] for c in extra])

    if not hot_keys:
        return joined(big, plain_stage(small), False)
    big_hot_pred = F.coalesce(_in_keys([F.col(bc) for bc, _ in on], hot_keys), F.lit(False))
    small_hot = small.where(_in_keys([F.col(sc) for _, sc in on], hot_keys))
    # small_hot has at most len(hot_keys) rows (one per key): a proven bound
    part_hot = joined(big.where(big_hot_pred), small_hot, True)
    part_rest = joined(big.where(~big_hot_pred), small, False)
    return part_rest.unionByName(part_hot)
