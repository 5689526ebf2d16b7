"""Refresh jobs - full reload or incremental, published atomically."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.operators.checks import assert_unique, with_counts
from orderlens.operators.merge import changed_since, delete_missing, merge_upsert
from orderlens.session import scratch_path
from orderlens.sources.store import discard, materialize, publish, read_current

log = logging.getLogger("orderlens.refresh")


def _unique(key: str | None):
    return (lambda df: assert_unique(df, [key])) if key else None


def run_full_refresh(view: DataFrame, base: str, key: str | None = None) -> str:
    """A4: the whole view becomes the new version of ``base``; with ``key`` only
    if that key is unique (A17)."""
    counted, obs = with_counts(view, "full_refresh")
    path = publish(counted, base, check=_unique(key))
    log.info("full refresh: %s rows -> %s", obs.get.get("rows"), path)
    return path


def run_incremental_refresh(spark: SparkSession, view: DataFrame, base: str, key: str,
                            change_window: list[Column], guard, stage_view: bool = True) -> str:
    """Delete keys that left the view, merge the change window, publish.

    The view is staged once (``materialize``) because both the delete (whole
    view) and the merge (its window) read it; the current version is read,
    never overwritten.
    """
    target = read_current(spark, base)
    stage = scratch_path(spark, "view-stage") if stage_view else None
    if stage:
        view = materialize(view, path=stage)
    merged = merge_upsert(delete_missing(target, view, key), changed_since(view, change_window),
                          [key], guard, action="__action")
    counted, obs = with_counts(merged, "incremental_refresh",
                               inserted=F.count(F.when(F.col("__action") == "insert", 1)),
                               updated=F.count(F.when(F.col("__action") == "update", 1)))
    path = publish(counted.drop("__action"), base)
    if stage:
        discard(spark, stage)               # the staged view is no longer read
    n = obs.get
    log.info("incremental refresh: deleted %d, updated %d, inserted %d, %d rows -> %s",
             target.count() - (n["rows"] - n["inserted"]), n["updated"], n["inserted"], n["rows"], path)
    return path


def run_matrix_refresh(matrix: DataFrame, base: str, key: str = "hospital_id") -> str:
    """Matrix rebuild (J6d job): written aside, primary key asserted on the
    written files (A17), then made visible as the new version (A14)."""
    path = publish(matrix, base, check=_unique(key))
    log.info("matrix refresh -> %s", path)
    return path


def run_refresh(spark: SparkSession, mode: str, view: DataFrame, base: str, **kw) -> str:
    """Job entry: ``mode`` picks the full reload or the incremental refresh."""
    if mode == "full":
        return run_full_refresh(view, base, kw.get("key"))
    if mode == "incremental":
        return run_incremental_refresh(spark, view, base, **kw)
    raise ValueError(f"unknown refresh mode {mode!r}")
