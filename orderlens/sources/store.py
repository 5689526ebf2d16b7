"""Stored results (A3), full reload (A4) and build-aside-then-swap publish.

A published table is a folder of versions ``<base>/v<millis>-<id>``.  Spark's
committer writes ``_SUCCESS`` only after every task has committed, so a
version without it is invisible: readers pick the newest complete version.
A failed or half-written run therefore never replaces the visible table
(the reference's delete/insert/commit-or-rollback), and no path is ever
overwritten while something may be reading it.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderlens.operators.checks import assert_unique
from orderlens.session import scratch_path


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


_stages: dict[int, list[str]] = {}


def materialize(df: DataFrame, path: str | None = None, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back.

    Cuts lineage (a re-used stage is computed once, and a lost executor
    re-reads files instead of replaying the whole plan).  Folders created here
    (no ``path`` given) are registered for :func:`discard_stages`.
    """
    spark = df.sparkSession
    target = path or scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(target)
    if path is None:
        _stages.setdefault(id(spark), []).append(target)
    return spark.read.parquet(target)


def discard(spark: SparkSession, path: str) -> None:
    """Delete one stage folder once nothing reads it any more."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)
    if path in _stages.get(id(spark), []):
        _stages[id(spark)].remove(path)


def discard_stages(spark: SparkSession) -> list[str]:
    """Delete every stage folder this session created.  Only for the end of a
    job that owns its session (e.g. the job CLI): frames of other work in a
    shared session may still read them."""
    done = list(_stages.pop(id(spark), []))
    for path in done:
        discard(spark, path)
    return done


def _versions(spark: SparkSession, base: str) -> list[str]:
    """Complete versions of ``base``; empty only when the folder does not exist.

    A failing listing is an error, never an empty table."""
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return []
    jvm = spark.sparkContext._jvm
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v") and fs.exists(
                jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            out.append(name)
    return sorted(out)


def current_version(spark: SparkSession, base: str) -> str | None:
    versions = _versions(spark, base)
    return f"{base.rstrip('/')}/{versions[-1]}" if versions else None


def read_current(spark: SparkSession, base: str, schema: StructType | None = None) -> DataFrame:
    """The newest complete version; an empty frame of ``schema`` if none."""
    path = current_version(spark, base)
    if path is None:
        if schema is None:
            raise FileNotFoundError(f"no published version below {base}")
        return spark.createDataFrame([], schema)
    return spark.read.parquet(path)


_last_stamp = 0


def _next_stamp(spark: SparkSession, base: str) -> int:
    """Strictly increasing version number: wall-clock milliseconds, but above
    every version already in ``base`` and every one this process issued."""
    global _last_stamp
    existing = [int(v[1:16]) for v in _versions(spark, base) if v[1:16].isdigit()]
    stamp = max(int(time.time() * 1000), _last_stamp + 1, max(existing, default=0) + 1)
    _last_stamp = stamp
    return stamp


def publish(df: DataFrame, base: str, check: Callable[[DataFrame], None] | None = None) -> str:
    """Write ``df`` as a new version of ``base``; it becomes visible atomically.

    ``check`` gets the written rows before readers can see them: they are
    written to a folder that is no version, checked, and then renamed.  When it
    raises, the older version stays current and the written folder is removed.
    """
    spark = df.sparkSession
    stamp = _next_stamp(spark, base)
    name = f"v{stamp:015d}-{uuid.uuid4().hex[:8]}"
    version = f"{base.rstrip('/')}/{name}"
    if check is None:
        df.write.mode("errorifexists").parquet(version)
        return version
    aside = f"{base.rstrip('/')}/_unchecked-{name}"
    df.write.mode("errorifexists").parquet(aside)
    fs, hidden = _fs(spark, aside)
    try:
        check(spark.read.parquet(aside))
    except Exception:
        fs.delete(hidden, True)
        raise
    if not fs.rename(hidden, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(version)):
        raise OSError(f"cannot rename {aside} to {version}")
    return version


def prune_versions(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """A14 "drop old": remove superseded versions of ``base``.

    Keeps the newest ``keep`` complete versions (a grace period for readers
    still on an older one); removes older complete versions and any
    incomplete version (a crashed writer) older than the newest complete one.
    A version being written now is newer and is never touched.  Returns the
    removed folder names.
    """
    if keep < 1:
        raise ValueError("keep must be >= 1")
    complete = _versions(spark, base)
    if not complete:
        return []
    newest = complete[-1]
    fs, p = _fs(spark, base)
    doomed = set(complete[:-keep])
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v") and name < newest and name not in complete:
            doomed.add(name)
    for name in sorted(doomed):
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, name), True)
    return sorted(doomed)


def full_refresh(src: DataFrame, base: str, schema: StructType | None = None,
                 key: str | None = None) -> DataFrame:
    """A4: replace the whole table with ``src`` (columns taken by name).

    With ``key`` the new version becomes visible only if the key is unique (A17).
    """
    if schema is not None:
        src = src.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    path = publish(src, base, check=(lambda df: assert_unique(df, [key])) if key else None)
    return src.sparkSession.read.parquet(path)
