"""Join operators.  All are equi-joins so the planner can pick a
broadcast (when AQE sees a small side at run time) or a sort-merge join; none
is planned as a nested loop; the cross join D9 is an explode of a bounded list."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.operators.latest import latest_per_key
from orderlens.operators.skew import join_to_one, plain_stage


def _pairs(on) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    return [(p, p) if isinstance(p, str) else tuple(p) for p in on]


def _cond(left: DataFrame, right: DataFrame, on) -> Column:
    return reduce(lambda a, b: a & b, [left[lc] == right[rc] for lc, rc in _pairs(on)])


def left_join_filtered(left: DataFrame, right: DataFrame, on, right_cond: Column | None,
                       how: str = "left") -> DataFrame:
    """Constant conditions on the right side belong to the ON clause of an
    outer join: filter the right side first (pushed into its scan), then join,
    so unmatched left rows survive."""
    r = right.where(right_cond) if right_cond is not None else right
    return left.join(r, _cond(left, r, on), how)


def join_latest(left: DataFrame, right: DataFrame, on, order_by: list[str],
                cols: list[str], how: str = "left", hot_keys: list[tuple] | None = None
                ) -> DataFrame:
    """Join each left row to the latest right record of its key.
    ``hot_keys`` of the left side skip the shuffle (``join_to_one``)."""
    pairs = _pairs(on)
    rkeys = [rc for _, rc in pairs]
    latest = latest_per_key(right, rkeys, order_by, cols)
    if hot_keys:
        return join_to_one(left, latest, pairs, how, hot_keys)
    latest = plain_stage(latest)
    return left.join(latest, _cond(left, latest, pairs), how).drop(
        *[latest[rc] for lc, rc in pairs])


def join_on_expr(left: DataFrame, right: DataFrame, left_key: Column, right_key: str,
                 how: str = "left") -> DataFrame:
    """A computed (e.g. CASE) expression as the join key; Catalyst extracts
    it as a hash key, so this stays an equi-join."""
    return left.join(right, left_key == right[right_key], how)


def prefix_lookup(df: DataFrame, key: Column, lookup: DataFrame, code: str, value: str,
                  out: str, default: str | None = None) -> DataFrame:
    """Left-join a code lookup on a computed prefix key; default when missing."""
    lk = lookup.select(F.col(code).alias("__code"), F.col(value).alias("__val"))
    j = df.join(lk, key == lk["__code"], "left")
    v = F.col("__val") if default is None else F.coalesce(F.col("__val"), F.lit(default))
    return j.withColumn(out, v).drop("__code", "__val")


def or_join(left: DataFrame, right: DataFrame, conds: list[tuple[str, str]],
            how: str = "left") -> DataFrame:
    """``left JOIN right ON (l1 = r1 OR l2 = r2 ...)`` without a nested loop.

    Tag expansion: each row of both sides emits one record per condition, its number and
    that condition's key, and ONE equi-join on both meets them.  A pair is kept at its
    lowest matching condition.  For ``how='left'`` the records first meet the distinct
    right keys and are folded back to their row (at most one record per condition, so no
    group is large); a row without any hit goes on as one record that matches nothing.
    The left side is read once; no window, no anti join.  Left and right column names
    must be disjoint.
    """
    if how not in ("left", "inner"):
        raise ValueError("or_join supports how='left' or 'inner'")
    n = len(conds)

    def records(df: DataFrame, side: int, mark: str) -> list[Column]:
        # one key column per condition, NULL but for the record's own: keys keep their types
        return [F.struct(F.lit(i).alias(f"{mark}t"), *[
            (F.col(c[side]) if j == i else F.lit(None).cast(df.schema[c[side]].dataType)).alias(f"{mark}{j}")
            for j, c in enumerate(conds)]) for i in range(n)]

    def exploded(df: DataFrame, items: Column, columns: list[str]) -> DataFrame:
        return df.select(*columns, F.explode(items).alias("__e")).select(*columns, "__e.*")

    def met(a: DataFrame, b: DataFrame, join: str) -> DataFrame:
        on = [F.col(f"__l{i}").eqNullSafe(F.col(f"__r{i}")) for i in range(n)]
        return a.join(b, reduce(lambda x, y: x & y, on, F.col("__lt") == F.col("__rt")), join)

    own = F.coalesce(*[F.when(F.col("__rt") == i, F.col(f"__r{i}").isNotNull()) for i in range(n)])
    rx = exploded(right, F.array(*records(right, 1, "__r")), right.columns).where(own)
    earlier = [(F.col("__lt") > i) & F.coalesce(F.col(lc) == F.col(rc), F.lit(False)) for i, (lc, rc) in enumerate(conds)]
    lowest = ~reduce(lambda x, y: x | y, earlier)
    if how == "inner":
        lx = exploded(left, F.array(*records(left, 0, "__l")), left.columns)
        return met(lx, rx, "inner").where(lowest).select(*left.columns, *right.columns)
    rows = left.withColumn("__row", F.monotonically_increasing_id())
    keys = rx.select("__rt", *[f"__r{i}" for i in range(n)]).distinct().withColumn("__hit", F.lit(True))
    seen = met(exploded(rows, F.array(*records(rows, 0, "__l")), rows.columns), keys, "left").groupBy(*rows.columns).agg(
        *[F.max(F.when(F.col("__lt") == i, F.col("__hit"))).alias(f"__h{i}") for i in range(n)])
    mine = records(seen, 0, "__l")
    hits = F.filter(F.array(*[F.when(F.col(f"__h{i}"), r) for i, r in enumerate(mine)]), lambda r: r.isNotNull())
    none = F.array(F.struct(F.lit(-1).alias("__lt"), *[
        F.lit(None).cast(left.schema[c[0]].dataType).alias(f"__l{j}") for j, c in enumerate(conds)]))
    lx = exploded(seen, F.when(F.size(hits) > 0, hits).otherwise(none), left.columns)
    return met(lx, rx, "left").where((F.col("__lt") < 0) | lowest).select(*left.columns, *right.columns)


def bounded_rows(small: DataFrame, max_rows: int, what: str = "list") -> list:
    """Collect a list proven to hold at most ``max_rows`` rows (the proof is
    the ``limit(max_rows + 1)`` itself: a bigger input raises instead of being
    truncated)."""
    got = small.limit(max_rows + 1).collect()
    if len(got) > max_rows:
        raise ValueError(f"{what}: more than {max_rows} rows")
    return got


def expand_by_list(left: DataFrame, small: DataFrame, block_rows: int = 10_000) -> DataFrame:
    """``JOIN small ON 1=1`` (e.g. the all-items categories), without a nested loop.

    A list of at most ``block_rows`` rows becomes an array literal that every left row
    explodes: a narrow step inside the scan's stage, no shuffle, no broadcast.  A longer
    one is never collected: it is cut into blocks of about ``block_rows`` rows (arrays),
    every left row names all block numbers, an equi-join on the number brings each block,
    and one explode per block gives its rows.  An empty list gives no rows, as the cross
    join does."""
    fields = small.schema.fields
    got = small.limit(block_rows + 1).collect()
    if len(got) > block_rows:
        blocks = -(-small.count() // block_rows)
        # row ids of a partition are consecutive, so each block takes its share of every partition
        cut = small.select(F.pmod(F.monotonically_increasing_id(), F.lit(blocks)).alias("__b"), F.struct("*").alias("__s"))
        arrays = cut.groupBy("__b").agg(F.collect_list("__s").alias("__list"))
        named = left.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("__n"))
        return (named.join(arrays, F.col("__n") == F.col("__b")).select(*left.columns, F.explode("__list").alias("__x"))
                .select(*left.columns, *[F.col("__x")[f.name].alias(f.name) for f in fields]))
    items = [F.struct(*[F.lit(r[i]).cast(f.dataType).alias(f.name) for i, f in enumerate(fields)])
             for r in got]
    if not items:
        return left.where(F.lit(False)).select(
            *left.columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    return (left.select("*", F.explode(F.array(*items)).alias("__x"))
                .select(*left.columns, *[F.col("__x")[f.name].alias(f.name) for f in fields]))


def exclude_existing(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Correlated ``NOT EXISTS`` -> left anti join."""
    return left.join(right, _cond(left, right, on), "left_anti")


def exclude_keys(left: DataFrame, keys: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """``NOT EXISTS (join chain ... where chain.key = left.key)``: reduce the
    chain to distinct keys (partial aggregation, output already partitioned by
    key) and anti-join."""
    k = plain_stage(keys.select(F.col(right_key).alias("__k")).distinct())
    return left.join(k, left[left_key] == k["__k"], "left_anti")


def keep_keys(left: DataFrame, keys: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """``EXISTS (...)`` counterpart of :func:`exclude_keys` (left semi join)."""
    k = plain_stage(keys.select(F.col(right_key).alias("__k")).distinct())
    return left.join(k, left[left_key] == k["__k"], "left_semi")


def exists_flag(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                name: str, hot_keys: list[tuple] | None = None) -> DataFrame:
    """0/1 column telling whether ``left_key`` occurs in ``right``.

    The right side is reduced to distinct non-NULL keys first, so the left row
    count never changes (the reference outer-joins the raw list and relies on
    a later DISTINCT).  ``hot_keys`` of the left side skip the shuffle."""
    k = (right.select(F.col(right_key).alias(f"__k_{name}"))
              .where(F.col(f"__k_{name}").isNotNull()).distinct()
              .withColumn(f"__hit_{name}", F.lit(1)))
    if hot_keys:
        j = join_to_one(left, k, [(left_key, f"__k_{name}")], "left", hot_keys)
    else:
        k = plain_stage(k)
        j = left.join(k, left[left_key] == k[f"__k_{name}"], "left").drop(f"__k_{name}")
    return j.withColumn(name, F.coalesce(F.col(f"__hit_{name}"), F.lit(0))).drop(f"__hit_{name}")


def exists_flags(left: DataFrame, flags: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """D13 for several lists: ``flags`` is name -> (list, left column, list column).

    Lists that are looked up by one left column become one tagged union, aggregated to a
    mask per key with ``bit_or``, so that all their flags cost one join; a left column
    more, one join more.  Rows never multiply; NULL keys give 0."""
    by_column: dict[str, list[str]] = {}
    for name, (_, column, _) in flags.items():
        by_column.setdefault(column, []).append(name)
    out = left
    for column, names in by_column.items():
        lists = [flags[n][0].select(F.col(flags[n][2]).alias("__key"), F.lit(1 << i).cast("long").alias("__bit"))
                 for i, n in enumerate(names)]
        masks = (reduce(lambda a, b: a.unionByName(b), lists).where(F.col("__key").isNotNull())
                 .groupBy("__key").agg(F.bit_or("__bit").alias("__mask")))
        masks = plain_stage(masks)
        out = out.join(masks, out[column] == masks["__key"], "left").drop("__key")
        for i, n in enumerate(names):
            out = out.withColumn(n, F.shiftright(F.coalesce("__mask", F.lit(0).cast("long")), i).bitwiseAND(F.lit(1).cast("long")).cast("int"))
        out = out.drop("__mask")
    return out.select(*left.columns, *flags)


def left_join_many(left: DataFrame, right: DataFrame, on, right_cond: Column | None = None
                   ) -> DataFrame:
    """D2/D4 left outer join for a right side where one key may hold a large
    share of the rows (lines per order, events per user).

    AQE can split a skewed partition only on the preserved side of an outer
    join, so ``left LEFT JOIN right`` with a hot key on the right runs that
    key in one task.  Written as ``inner join`` (skew-splittable on both
    sides) plus the unmatched left rows (anti join against the distinct right
    keys, padded with NULLs) - the same rows as the outer join.
    """
    r = right.where(right_cond) if right_cond is not None else right
    pairs = _pairs(on)
    matched = left.join(r, _cond(left, r, pairs), "inner").select(*left.columns, *r.columns)
    keys = r.select(*[F.col(rc).alias(f"__k{i}") for i, (_, rc) in enumerate(pairs)])
    keys = keys.where(reduce(lambda a, b: a & b, [F.col(f"__k{i}").isNotNull()
                                                  for i in range(len(pairs))])).distinct()
    kc = reduce(lambda a, b: a & b, [left[lc] == keys[f"__k{i}"] for i, (lc, _) in enumerate(pairs)])
    unmatched = left.join(keys, kc, "left_anti").select(
        *left.columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in r.schema.fields])
    return matched.unionByName(unmatched)
