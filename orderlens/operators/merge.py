"""Table maintenance as DataFrame algebra.

Plain Parquet has no MERGE or DELETE, so each operator returns the new
table contents; :mod:`orderlens.sources.store` publishes it atomically.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions.dates import as_ts


def append_by_name(*frames: DataFrame) -> DataFrame:
    """A5: ``insert (col list) select ...`` - by name; columns a branch lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def recent(col: str | Column, as_of, lookback: _dt.timedelta, *, inclusive: bool = False,
           bounded: bool = False) -> Column:
    """``col > as_of - lookback`` (``>=`` if inclusive); ``bounded`` adds ``col <= as_of``."""
    c = F.col(col) if isinstance(col, str) else col
    start = as_ts(as_of) - F.lit(lookback)
    cond = (c >= start) if inclusive else (c > start)
    return cond & (c <= as_ts(as_of)) if bounded else cond


def changed_since(df: DataFrame, conditions: Iterable[Column]) -> DataFrame:
    """The change window - rows meeting any of the recency conditions
    (updated in the last hour OR scanned in 14 days OR submitted in 7 days)."""
    return df.where(reduce(lambda a, b: a | b, list(conditions)))


def _unique_by(df: DataFrame, keys: list[str], what: str, null_safe: bool = False) -> DataFrame:
    """Fail the job if a key occurs twice (an unstable MERGE source).

    The count is a window on the keys: its exchange and sort are exactly what
    the following sort-merge join on the same keys needs, so the check adds no
    shuffle.  Keys are unique in valid input, so no partition is hot.  A row
    with a NULL key component matches nothing and is simply inserted, so
    several of them are not duplicates.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    has_key = (F.lit(True) if null_safe
               else reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    msg = F.lit(f"{what}: duplicate key in source for {keys}")
    return (df.withColumn("__dup", n)
              .where(F.when((F.col("__dup") > 1) & has_key, F.raise_error(msg)).otherwise(F.lit(True)))
              .drop("__dup"))


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str],
                 guard: Callable[[Callable[[str], Column], Callable[[str], Column]], Column],
                 update_cols: list[str] | None = None, check_unique: bool = True,
                 null_safe: bool = False, action: str | None = None, changed_only: bool = False) -> DataFrame:
    """MERGE as a full outer join.

    matched and ``guard(src, tgt)`` true -> the source values of
    ``update_cols`` (default: every non-key column); matched and guard false
    or unknown -> the target row unchanged; not matched -> the source row
    inserted (target-only columns NULL); target rows without a source row are
    kept.  The result has the target's columns.  NULL keys never match (SQL
    MERGE), unless ``null_safe``: then NULL is a key value like any other
    (for keys produced by a grouping, as in the streaming upsert).  ``action``
    names an extra column that says what became of the row: insert, update, keep.
    ``changed_only`` leaves out the kept rows, so only the source is preserved by the join.
    """
    keys = list(keys)
    tcols = target.columns
    scols = set(source.columns)
    if update_cols is None:
        update_cols = [c for c in tcols if c not in keys and c in scols]
    src = _unique_by(source, keys, "merge_upsert", null_safe) if check_unique else source
    t = target.select(*[F.col(c).alias(f"__t_{c}") for c in tcols], F.lit(True).alias("__t_hit"))
    s = src.select(*[F.col(c).alias(f"__s_{c}") for c in source.columns], F.lit(True).alias("__s_hit"))
    eq = (lambda a, b: a.eqNullSafe(b)) if null_safe else (lambda a, b: a == b)
    cond = reduce(lambda a, b: a & b, [eq(t[f"__t_{k}"], s[f"__s_{k}"]) for k in keys])
    j = t.join(s, cond, "right_outer" if changed_only else "full_outer")

    def sv(c: str) -> Column:
        return F.col(f"__s_{c}")

    def tv(c: str) -> Column:
        return F.col(f"__t_{c}")

    s_hit = F.col("__s_hit").isNotNull()
    t_hit = F.col("__t_hit").isNotNull()
    insert = s_hit & ~t_hit
    update = s_hit & t_hit & F.coalesce(guard(sv, tv), F.lit(False))
    if changed_only:
        j = j.where(insert | update)
    out = []
    for c in tcols:
        if c in keys:
            out.append(F.when(insert, sv(c)).otherwise(tv(c)).alias(c))
        elif c in update_cols:
            out.append(F.when(insert | update, sv(c)).otherwise(tv(c)).alias(c))
        elif c in scols:
            out.append(F.when(insert, sv(c)).otherwise(tv(c)).alias(c))
        else:
            out.append(F.when(insert, F.lit(None)).otherwise(tv(c)).alias(c))
    if action:
        out.append(F.when(insert, "insert").when(update, "update").otherwise("keep").alias(action))
    return j.select(*out)


def delete_missing(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """``DELETE FROM target WHERE key NOT IN (SELECT key FROM source)``
    with SQL's three-valued logic, returning the rows that remain.

    A row is deleted only when the predicate is TRUE: its key is non-NULL,
    absent from the source, and the source has no NULL key.  So one NULL
    source key blocks every delete, NULL target keys survive unless the source
    is empty, and an empty source deletes everything (H6).

    Plan: distinct source keys (partial aggregate) left-joined on the key; the
    two source facts are LIMIT 1 scalar subqueries.  No broadcast of the key
    set and no nested-loop null-aware anti join.
    """
    k = (source.select(F.col(key).alias("__k")).where(F.col("__k").isNotNull())
               .distinct().withColumn("__hit", F.lit(True)))
    keep = F.col("__hit").isNotNull()
    if source.schema[key].nullable:
        keep = keep | source.where(F.col(key).isNull()).exists()
    if target.schema[key].nullable:
        keep = keep | (target[key].isNull() & source.exists())
    j = target.join(k, target[key] == k["__k"], "left")
    return j.where(keep).select(*target.columns)


def incremental_refresh(target: DataFrame, view: DataFrame, key: str,
                        change_window: Iterable[Column], guard, update_cols=None) -> DataFrame:
    """Delete target rows whose key left the view (against the WHOLE
    view), then merge the change window of the view into what is left."""
    kept = delete_missing(target, view, key)
    changes = changed_since(view, change_window)
    return merge_upsert(kept, changes, [key], guard, update_cols=update_cols)
