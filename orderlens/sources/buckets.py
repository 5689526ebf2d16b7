"""Tables laid out by an extendible hash of their key, refreshed by delta files.

Rows are Parquet files of their bucket; a bucket holds the keys whose hash ends in
its ``slot`` (``depth`` bits).  A refresh writes changed rows and tombstones of
deleted keys as a delta of the buckets they fall in, so it writes in proportion to
the change; readers take the newest version of a key.  A bucket whose deltas have
grown to a share of its rows is written anew, and one that outgrew
``ROWS_PER_BUCKET`` is split in two by one more bit: the number of buckets follows
the table, other buckets stay untouched.

The layout (one row per bucket: slot, files, counts, fingerprint) is itself a
published table (A14): files are written under new names and become part of the
table only with the next layout, so a run that dies before leaves the old table.

A bucket's fingerprint is its number of keys and three order-free sums over two
hashes of them.  Sums are added to and taken from as rows come and go; a view whose
keys give the same fingerprints has lost no key, and only buckets that differ are
anti-joined.  One job writes a table at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructType

from orderlens.operators.merge import merge_upsert
from orderlens.session import scratch_path
from orderlens.sources.store import _fs, current_version, discard, materialize, prune_versions, publish

BUCKET, SEQ, GONE, NEW = "__bucket", "__seq", "__gone", "__new"
#: A bucket with more rows is split when it is written next.
ROWS_PER_BUCKET = 1_000_000
#: Deltas of a bucket: its rows are written anew beyond this share, or this many.
DELTA_SHARE, DELTA_FILES = 0.25, 12
PRINT = ["n", "high", "low", "second"]
_LAYOUT = ("id long, depth int, slot long, rows long, delta_rows long, print array<long>, base string, "
           "deltas array<string>, seq long, null_safe boolean, keys array<string>, schema string")


@dataclass
class Bucket:
    id: int
    depth: int
    slot: int
    rows: int = 0
    delta_rows: int = 0
    print: list = field(default_factory=lambda: [0] * len(PRINT))
    base: str | None = None
    deltas: list = field(default_factory=list)


@dataclass
class Layout:
    buckets: dict
    keys: list
    schema: StructType
    seq: int = 0
    null_safe: bool = False

    def depth(self) -> int:
        return max(b.depth for b in self.buckets.values())


def key_hashes(keys: list[str]) -> tuple[Column, Column]:
    return F.xxhash64(*keys), F.xxhash64(F.lit(7), *keys)


def _prints(keys: list[str], sign: int = 1) -> list[Column]:
    """Aggregates of a fingerprint; sums of 32-bit halves, exact in a long."""
    one, two = key_hashes(keys)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    terms = [F.lit(1), F.shiftrightunsigned(one, 32), one.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(two, 32)]
    return [F.coalesce(F.sum(F.when(known, sign * t)), F.lit(0)).cast("long").alias(n) for t, n in zip(terms, PRINT)]


def _with_bucket(spark: SparkSession, rows: DataFrame, layout: Layout) -> DataFrame:
    """``rows`` with the id of the bucket of their key: a look-up in the hash directory,
    which has at most twice as many entries as the deepest level has buckets."""
    depth = layout.depth()
    entries = [(b.slot + (k << b.depth), b.id) for b in layout.buckets.values() for k in range(1 << (depth - b.depth))]
    directory = spark.createDataFrame(entries, f"__slot long, {BUCKET} long")
    slot = F.xxhash64(*layout.keys).bitwiseAND(F.lit((1 << depth) - 1))
    return rows.join(F.broadcast(directory), slot == F.col("__slot")).drop("__slot")


def _written(spark: SparkSession, path: str, kind: str, rows: DataFrame) -> str:
    """``rows`` (with their bucket) as a new folder below ``path``; several tasks may write a bucket."""
    name = f"{kind}-{uuid.uuid4().hex[:12]}"
    rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).mode("errorifexists").parquet(f"{path}/{name}")
    return name


def _folder_stats(spark: SparkSession, path: str, name: str, keys: list[str], schema: StructType) -> dict[int, dict]:
    """Per bucket of a written folder: rows, new keys, and the change of the fingerprint."""
    typed = StructType(list(schema.fields)).add(BUCKET, LongType())
    rows = spark.read.schema(typed).parquet(f"{path}/{name}")
    gone = F.col(GONE) if GONE in rows.columns else F.lit(False)
    new = F.col(NEW) if NEW in rows.columns else F.lit(True)
    counts = F.when(gone, F.lit(-1)).when(new, F.lit(1)).otherwise(F.lit(0))
    aggs = [F.count(F.lit(1)).alias("rows"), F.sum(counts).alias("net"), *_prints(keys, counts)]
    return {r[BUCKET]: r.asDict() for r in rows.groupBy(BUCKET).agg(*aggs).collect()}


def _load(spark: SparkSession, path: str) -> Layout | None:
    """The newest layout; one row per bucket is collected."""
    version = current_version(spark, f"{path}/_layout")
    if version is None:
        return None
    rows = spark.read.parquet(version).collect()
    buckets = {r.id: Bucket(r.id, r.depth, r.slot, r.rows, r.delta_rows, list(r.print), r.base, list(r.deltas)) for r in rows}
    first = rows[0]
    return Layout(buckets, list(first["keys"]), StructType.fromJson(json.loads(first.schema)), first.seq, first.null_safe)


def _save(spark: SparkSession, path: str, layout: Layout) -> None:
    rows = [tuple(asdict(b).values()) + (layout.seq, layout.null_safe, layout.keys, layout.schema.json())
            for b in layout.buckets.values()]
    publish(spark.createDataFrame(rows, _LAYOUT).coalesce(1), f"{path}/_layout")


def prune_buckets(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove files that none of the newest ``keep`` layouts uses (older ones stay
    readable that long), and older layouts; returns the removed folders."""
    prune_versions(spark, f"{path}/_layout", keep)
    fs, root = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    used = set()
    for st in fs.listStatus(jvm.org.apache.hadoop.fs.Path(root, "_layout")):
        for r in spark.read.parquet(st.getPath().toString()).select("base", "deltas").distinct().collect():
            used |= {r.base, *r.deltas}
    gone = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if name.startswith(("base-", "delta-")) and name not in used:
            fs.delete(st.getPath(), True)
            gone.append(name)
    return gone


def _live(spark: SparkSession, path: str, layout: Layout, ids=None, columns: list[str] | None = None) -> DataFrame:
    """The rows of the buckets ``ids`` (all by default): base rows without a newer version,
    and the newest versions.  Buckets without deltas are plain scans."""
    chosen = [b for b in layout.buckets.values() if ids is None or b.id in ids]
    columns = columns or layout.schema.names
    keys = layout.keys

    def files(which, names, schema):
        paths = [f"{path}/{n}/{BUCKET}={b.id}" for b in which for n in names(b)]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    base = lambda b: [b.base] if b.base else []
    plain = files([b for b in chosen if not b.deltas], base, layout.schema).select(*columns)
    mixed = [b for b in chosen if b.deltas]
    if not mixed:
        return plain
    wide = StructType(list(layout.schema.fields)).add(SEQ, LongType()).add(GONE, BooleanType())
    delta = files(mixed, lambda b: b.deltas, wide)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    # A row with a NULL key replaces nothing, unless NULL is a key value like any other.
    loose = delta.limit(0) if layout.null_safe else delta.where(~known)
    newest = (delta if layout.null_safe else delta.where(known)).groupBy(*keys).agg(
        F.max_by(F.struct(GONE, *columns), SEQ).alias("__row"))
    marks = newest.select(*[F.col(k).alias(f"__k_{k}") for k in keys])
    match = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) if layout.null_safe else F.col(k) == F.col(f"__k_{k}") for k in keys]
    old = files(mixed, base, layout.schema).join(marks, reduce(lambda a, b: a & b, match), "left_anti").select(*columns)
    fresh = newest.where(f"not __row.{GONE}").select(*[F.col("__row")[c].alias(c) for c in columns])
    return plain.unionByName(old).unionByName(fresh).unionByName(loose.select(*columns))


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    return _live(spark, path, _load(spark, path))


def _replace(spark: SparkSession, path: str, layout: Layout, ids: list[int], rows: DataFrame, bucket_rows: int) -> list[Bucket]:
    """Write ``rows``, all of the buckets ``ids``, as these buckets anew; those too large as two."""
    nxt, parts = max(layout.buckets) + 1, []
    for i in ids:
        b = layout.buckets.pop(i)
        deeper = [b.slot, b.slot + (1 << b.depth)] if b.rows > bucket_rows else [b.slot]
        for slot in deeper:
            parts.append(Bucket(nxt, b.depth + len(deeper) - 1, slot))
            nxt += 1
    layout.buckets.update({p.id: p for p in parts})
    name = _written(spark, path, "base", _with_bucket(spark, rows, layout))
    stats = _folder_stats(spark, path, name, layout.keys, layout.schema)
    for p in parts:
        if p.id in stats:
            p.rows, p.base, p.print = stats[p.id]["rows"], name, [stats[p.id][k] for k in PRINT]
    return parts


def _rewrite(spark: SparkSession, path: str, layout: Layout, ids: list[int], bucket_rows: int) -> int:
    """Write the buckets ``ids`` anew without deltas, those too large as two; until none is."""
    done = 0
    while ids:
        done += len(ids)
        parts = _replace(spark, path, layout, ids, _live(spark, path, layout, set(ids)), bucket_rows)
        ids = [p.id for p in parts if p.rows > bucket_rows]
    return done


def write_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int, bucket_rows: int = ROWS_PER_BUCKET,
                   null_safe: bool = False) -> None:
    """A4: the whole table, in at least ``buckets`` buckets (rounded up to a power of two)."""
    spark = df.sparkSession
    depth = max(0, buckets - 1).bit_length()
    layout = Layout({i: Bucket(i, depth, i) for i in range(1 << depth)}, list(keys), df.schema, null_safe=null_safe)
    name = _written(spark, path, "base", _with_bucket(spark, df, layout))
    stats = _folder_stats(spark, path, name, layout.keys, layout.schema)
    for i, s in stats.items():
        b = layout.buckets[i]
        b.rows, b.base, b.print = s["rows"], name, [s[k] for k in PRINT]
    _rewrite(spark, path, layout, [b.id for b in layout.buckets.values() if b.rows > bucket_rows], bucket_rows)
    _save(spark, path, layout)


def _add_delta(spark: SparkSession, path: str, layout: Layout, rows: DataFrame) -> dict[str, int]:
    """Write ``rows`` (with NEW and GONE) as the next delta; counts of its rows by kind."""
    layout.seq += 1
    name = _written(spark, path, "delta", _with_bucket(spark, rows, layout).withColumn(SEQ, F.lit(layout.seq).cast("long")))
    wide = StructType(list(layout.schema.fields)).add(NEW, BooleanType()).add(GONE, BooleanType())
    total = {"rows": 0, "net": 0, "buckets": []}
    for i, s in _folder_stats(spark, path, name, layout.keys, wide).items():
        b = layout.buckets[i]
        b.rows += s["net"]
        b.delta_rows += s["rows"]
        b.print = [x + s[k] for x, k in zip(b.print, PRINT)]
        b.deltas.append(name)
        total["rows"] += s["rows"]
        total["net"] += s["net"]
        total["buckets"].append(i)
    return total


def _merge(spark: SparkSession, path: str, layout: Layout, changes: DataFrame, stage: str, guard,
           bucket_rows: int) -> dict[str, int]:
    """Merge ``changes`` (staged once): a delta of the rows that are inserted or updated."""
    changes = materialize(_with_bucket(spark, changes, layout), path=stage)
    found = {r[BUCKET]: r["count"] for r in changes.groupBy(BUCKET).count().collect()}
    if not found:
        return {"rows": 0, "net": 0, "buckets": [], "changes": 0}
    total = {"rows": 0, "net": 0, "buckets": [], "changes": sum(found.values())}
    # A bucket that changes by more than a delta may hold is merged whole and written once.
    heavy = [i for i, n in found.items() if n + layout.buckets[i].delta_rows > DELTA_SHARE * layout.buckets[i].rows]
    light = [i for i in found if i not in heavy]
    if heavy:
        merged = merge_upsert(_live(spark, path, layout, set(heavy)), changes.where(F.col(BUCKET).isin(heavy)).drop(BUCKET),
                              layout.keys, guard, check_unique=not layout.null_safe, null_safe=layout.null_safe)
        old = sum(layout.buckets[i].rows for i in heavy)
        parts = _replace(spark, path, layout, heavy, merged, bucket_rows)
        total = {**total, "rows": sum(found[i] for i in heavy), "net": sum(p.rows for p in parts) - old,
                 "buckets": [p.id for p in parts]}
    if light:
        changes = changes.where(F.col(BUCKET).isin(light)).drop(BUCKET)
        # The stored rows of the changed keys, first: a small change is broadcast, and no stored row shuffled.
        marks = changes.select(*[F.col(k).alias(f"__k_{k}") for k in layout.keys])
        match = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) if layout.null_safe else F.col(k) == F.col(f"__k_{k}") for k in layout.keys]
        target = _live(spark, path, layout, set(light)).join(marks, reduce(lambda a, b: a & b, match), "left_semi")
        merged = merge_upsert(target, changes, layout.keys, guard, check_unique=not layout.null_safe,
                              null_safe=layout.null_safe, action="__action", changed_only=True)
        delta = _add_delta(spark, path, layout, merged.select(
            *layout.schema.names, (F.col("__action") == "insert").alias(NEW), F.lit(False).alias(GONE)))
        total = {**total, **{k: total[k] + delta[k] for k in ("rows", "net", "buckets")}}
    return total


def _no_key(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _key_prints(spark: SparkSession, layout: Layout, view_keys: DataFrame) -> dict[int, list] | None:
    """Fingerprint per bucket of distinct view keys; None if one of the keys is NULL."""
    nulls = F.count(F.when(_no_key(layout.keys), 1)).alias("nulls")
    prints = _with_bucket(spark, view_keys, layout).groupBy(BUCKET).agg(*_prints(layout.keys), nulls).collect()
    return None if any(r.nulls for r in prints) else {r[BUCKET]: [r[k] for k in PRINT] for r in prints}


def _delete(spark: SparkSession, path: str, layout: Layout, view_keys: DataFrame, seen: dict[int, list] | None) -> dict[str, int]:
    """Tombstones of the stored keys that the staged, distinct view keys no longer hold.
    ``seen`` holds the view's fingerprints by bucket, or is None if a NULL blocks deletes."""
    none = {"rows": 0, "net": 0, "buckets": [], "compared": 0}
    if seen is None:
        return none
    differ = [b.id for b in layout.buckets.values() if b.print != seen.get(b.id, [0] * len(PRINT))]
    if not differ:
        return none
    known = _with_bucket(spark, view_keys, layout)
    stored = _live(spark, path, layout, set(differ), layout.keys).where(~_no_key(layout.keys))
    marks = known.where(F.col(BUCKET).isin(differ)).select(*[F.col(k).alias(f"__k_{k}") for k in layout.keys])
    match = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__k_{k}") for k in layout.keys])
    gone = stored.join(marks, match, "left_anti")
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in layout.schema if f.name not in layout.keys]
    tombs = gone.select(*layout.keys, *rest).select(*layout.schema.names, F.lit(False).alias(NEW), F.lit(True).alias(GONE))
    return _add_delta(spark, path, layout, tombs) | {"compared": len(differ)}


def _finish(spark: SparkSession, path: str, layout: Layout, bucket_rows: int, anew: bool) -> int:
    """Rewrite what is due, then publish the layout."""
    due = [b.id for b in layout.buckets.values() if len(b.deltas) > DELTA_FILES
           or b.delta_rows > max(1, DELTA_SHARE * b.rows) or b.rows > bucket_rows]
    rewritten = _rewrite(spark, path, layout, due, bucket_rows)
    _save(spark, path, layout)
    if rewritten or anew:
        prune_buckets(spark, path)
    else:
        prune_versions(spark, f"{path}/_layout", 2)
    return rewritten


def merge_buckets(spark: SparkSession, path: str, keys: list[str], buckets: int, changes: DataFrame, guard,
                  null_safe: bool = False, bucket_rows: int = ROWS_PER_BUCKET) -> int:
    """A7/K2 in proportion to the change: a delta of the inserted and updated rows.

    The first call creates the table.  ``null_safe`` as in ``merge_upsert``.
    Returns the number of buckets that got a delta.
    """
    layout = _load(spark, path)
    if layout is None:
        write_bucketed(changes, path, keys, buckets, bucket_rows, null_safe)
        return buckets
    stage = scratch_path(spark, "changes")
    known = set(layout.buckets)
    done = _merge(spark, path, layout, changes, stage, guard, bucket_rows)
    if done["rows"]:
        _finish(spark, path, layout, bucket_rows, len(set(layout.buckets) - known) > 0)
    discard(spark, stage)
    return len(done["buckets"])


def refresh_buckets(spark: SparkSession, path: str, changes: DataFrame | Callable[[], DataFrame],
                    view_keys: DataFrame | Callable[[], DataFrame], guard,
                    bucket_rows: int = ROWS_PER_BUCKET) -> dict[str, int]:
    """A11 in proportion to the change: merge ``changes`` (guarded, A7), delete the rows
    whose key left the view.

    ``view_keys`` holds the keys of the whole view and nothing else; a NULL in them
    blocks every delete (H6), as does a NULL in a stored key for its row.  The merge
    comes first: changes are rows of the view, so neither step affects the other, and
    after it a bucket without deletes has the view's fingerprint.  Returns the counts of
    deleted rows, inserted rows, changes, buckets that got a delta, buckets whose keys
    were compared, and buckets written anew.

    Either frame may be given as a function that returns it: then the two plans, of the
    whole view's keys and of the changes, are built side by side as they are run.
    """
    layout = _load(spark, path)
    before = set(layout.buckets)
    stages = [scratch_path(spark, n) for n in ("changes", "view-keys")]
    old = replace(layout, buckets=dict(layout.buckets))     # the merge may put others in place of its buckets

    def staged_keys():
        rows = view_keys() if callable(view_keys) else view_keys
        known = materialize(rows.select(*old.keys).distinct(), path=stages[1])
        return known, _key_prints(spark, old, known)

    with ThreadPoolExecutor(1) as pool:                     # neither needs the other
        known = pool.submit(staged_keys)
        merged = _merge(spark, path, layout, changes() if callable(changes) else changes, stages[0], guard, bucket_rows)
        known, seen = known.result()
    if seen is not None and set(layout.buckets) != before:
        seen = _key_prints(spark, layout, known)
    deleted = _delete(spark, path, layout, known, seen)
    counts = {"deleted": deleted["rows"], "inserted": merged["net"], "changes": merged["changes"],
              "buckets": len({*merged["buckets"], *deleted["buckets"]}), "compared": deleted["compared"], "rewritten": 0}
    if counts["buckets"]:
        counts["rewritten"] = len(set(layout.buckets) - before)
        counts["rewritten"] += _finish(spark, path, layout, bucket_rows, counts["rewritten"] > 0)
    for stage in stages:
        discard(spark, stage)
    return counts
