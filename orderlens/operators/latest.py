"""Per-key maxima and latest records, written as aggregations.

A window ``partitionBy(key)`` sends every row of a key to one task and sorts
it there; with one key holding a third of the rows that task is the job.
These operators use ``groupBy`` instead: the map side pre-aggregates, so a hot
key reaches the shuffle as one partial row per input partition, and the
per-row result is joined back by key: from a shuffle stage of its own, which
lets AQE split the hot partition (``plain_stage``), or, for keys found by
``find_hot_keys``, without any shuffle (``join_to_one``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.operators.skew import join_to_one, plain_stage


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _join_back(df: DataFrame, agg: DataFrame, keys: list[str], null_safe: bool = True) -> DataFrame:
    """Join ``agg`` (keys renamed ``__g<i>``) back to ``df`` on keys.

    ``null_safe`` keeps the window meaning for NULL keys (one NULL group); it
    partitions on ``(coalesce(k), isnull(k))``.  Otherwise the join is a plain
    inner key join and rows with a NULL key are dropped: callers whose NULL-key
    rows can never be reported use it to keep a plain key partitioning (reused
    by the next join on the key) and to let Catalyst infer filters across it.
    """
    cond = None
    for i, k in enumerate(keys):
        c = df[k].eqNullSafe(agg[f"__g{i}"]) if null_safe else (df[k] == agg[f"__g{i}"])
        cond = c if cond is None else cond & c
    out = df.join(agg, cond, "left" if null_safe else "inner")
    return out.drop(*[f"__g{i}" for i in range(len(keys))])


def group_max(df: DataFrame, value: Column | str, keys, name: str,
              null_keys: str = "group", hot_keys: list[tuple] | None = None) -> DataFrame:
    """add ``max(value) over (partition by keys)`` as column ``name``.

    Same rows and values as the window form; NULL keys form one group.  With
    ``null_keys="drop"`` rows with a NULL key are dropped instead (for callers
    that inner-join on the key afterwards anyway).  ``hot_keys`` (see
    :func:`orderlens.operators.skew.find_hot_keys`) are joined back without a
    shuffle; it needs ``null_keys="drop"``.
    """
    if null_keys not in ("group", "drop"):
        raise ValueError("null_keys must be 'group' or 'drop'")
    keys = _keys(keys)
    value = F.col(value) if isinstance(value, str) else value
    agg = df.groupBy(*[F.col(k).alias(f"__g{i}") for i, k in enumerate(keys)]).agg(
        F.max(value).alias(name))
    if hot_keys:
        if null_keys != "drop":
            raise ValueError("hot_keys needs null_keys='drop'")
        return join_to_one(df, agg, [(k, f"__g{i}") for i, k in enumerate(keys)], "inner", hot_keys)
    return _join_back(df, plain_stage(agg), keys, null_safe=(null_keys == "group"))


def distinct_with_group_max(df: DataFrame, keys, maxed: list[str], kept: list[str]) -> DataFrame:
    """F2 + E1: ``select distinct keys, max(m) over (partition by keys), kept``.

    First a partial aggregate to distinct (keys, kept) rows with their
    maxima; the per-key maxima are then a window over those reduced rows,
    which hold one row per distinct ``kept`` combination of a key (e.g. the
    categories of a hospital), never the raw rows of a hot key.  One pass:
    the reduced frame is not joined back to itself, so its input plan runs
    once.
    """
    keys = _keys(keys)
    per_group = df.groupBy(*keys, *kept).agg(*[F.max(m).alias(m) for m in maxed])
    w = Window.partitionBy(*keys)
    return per_group.select(*keys, *[F.max(m).over(w).alias(m) for m in maxed], *kept)


def latest_per_key(df: DataFrame, keys, order_by: list[str], cols: list[str] | None = None,
                   descending: bool = True) -> DataFrame:
    """the row ranked first per key (``row_number() = 1``).

    ``order_by`` must be a total order within a key (add a unique id as the
    last column).  Computed as ``max(struct(order..., payload...))`` per key,
    so no key's rows meet whole in one task.  Descending order puts
    NULLs last, like ``ORDER BY ... DESC``.
    """
    keys = _keys(keys)
    cols = [c for c in (cols if cols is not None else df.columns) if c not in keys]
    packed = F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order_by)],
                      *[F.col(c).alias(f"__p{i}") for i, c in enumerate(cols)])
    pick = F.max(packed) if descending else F.min(packed)
    agg = df.groupBy(*keys).agg(pick.alias("__m"))
    return agg.select(*keys, *[F.col(f"__m.__p{i}").alias(c) for i, c in enumerate(cols)])


def strict_latest(df: DataFrame, key, revision: Column | str, status: Column | str,
                  name: str = "status", upper: bool = True) -> DataFrame:
    """Status at the maximum revision per key, or NULL when that
    revision has no row or several rows (the reference's single-row lookup
    fails and returns NULL).  Upper-cased like the reference.

    Two partial aggregations (per key and revision, then per key) instead of
    a per-row lookup or a max-then-join-back.
    """
    keys = _keys(key)
    rev = F.col(revision) if isinstance(revision, str) else revision
    st = F.col(status) if isinstance(status, str) else status
    if upper:
        st = F.upper(st)
    per_rev = (df.select(*keys, rev.alias("__rev"), st.alias("__st"))
                 .where(F.col("__rev").isNotNull())
                 .groupBy(*keys, "__rev")
                 .agg(F.count(F.lit(1)).alias("__n"), F.max("__st").alias("__st")))
    top = per_rev.groupBy(*keys).agg(F.max(F.struct("__rev", "__n", "__st")).alias("__m"))
    return top.select(*keys, F.when(F.col("__m.__n") == 1, F.col("__m.__st")).alias(name))
