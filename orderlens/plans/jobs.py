"""The scheduled jobs, as a command line.

  python -m orderlens.plans.jobs order-refresh  --tables DIR --target PATH [--mode full|incremental]
  python -m orderlens.plans.jobs matrix-refresh --tables DIR --target PATH

``DIR`` holds one Parquet dataset per ERP input (``order_headers``,
``order_lines``, ... as named in :mod:`orderlens.plans.erp`).  ``--as-of``
defaults to the time the job starts; the clock is read once, here, and
passed down (no operator reads it).  Every run publishes a new version of
``PATH`` (build aside, then visible atomically).
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging

from pyspark.sql import SparkSession

from orderlens.plans.erp import (
    REFRESH_KEY, erp_change_guard, erp_change_window, erp_hospital_product, erp_order_view,
)
from orderlens.plans.refresh import run_full_refresh, run_incremental_refresh, run_matrix_refresh
from orderlens.session import get_spark, scratch_path
from orderlens.sources.store import discard_stages, materialize, prune_versions
from orderlens.streaming.refresh import refresh_on_trigger

log = logging.getLogger("orderlens.jobs")

ORDER_INPUTS = ("order_headers", "order_lines", "items", "transaction_types", "contacts",
                "site_use_view", "salesreps", "scans", "reviews", "item_category_view")
MATRIX_INPUTS = ("list_headers", "list_lines", "pricing_attributes", "system_items",
                 "item_categories", "categories", "parties", "cust_accounts", "relationships",
                 "group_precedence", "party_sites", "locations", "acct_sites", "site_uses")


def _read(spark: SparkSession, tables: str, names) -> dict:
    return {n: spark.read.parquet(f"{tables.rstrip('/')}/{n}") for n in names}


def order_refresh(spark: SparkSession, tables: str, target: str, as_of, mode: str,
                  excluded_order_types: list[str], hot_key_rows: int = 0) -> str:
    """Full reload or incremental refresh of the 52-column order table.
    ``hot_key_rows`` > 0: orders with at least that many lines are joined
    without a shuffle (see :mod:`orderlens.operators.skew`)."""
    t = _read(spark, tables, ORDER_INPUTS)
    extra = {}
    if hot_key_rows > 0:
        from orderlens.operators.skew import find_hot_keys
        extra["hot_order_keys"] = tuple(find_hot_keys(t["order_lines"], ["header_id"], hot_key_rows))
    view = erp_order_view(t, as_of, excluded_order_types, **extra)
    if mode == "full":
        return run_full_refresh(view, target, key=REFRESH_KEY)
    if mode == "incremental":
        return run_incremental_refresh(spark, view, target, REFRESH_KEY, erp_change_window(as_of),
                                       erp_change_guard)
    raise ValueError(f"unknown mode {mode!r}")


def matrix_refresh(spark: SparkSession, tables: str, target: str, as_of) -> str:
    """Rebuild the hospital x product-category matrix (key checked, then published)."""
    matrix = erp_hospital_product(_read(spark, tables, MATRIX_INPUTS), as_of,
                                  stage=lambda df: materialize(df, name="group-hospitals"))
    return run_matrix_refresh(matrix, target, key="HOSPITAL_ID")


def main(argv=None, spark: SparkSession | None = None) -> str:
    p = argparse.ArgumentParser(prog="orderlens.plans.jobs")
    p.add_argument("job", choices=["order-refresh", "matrix-refresh"])
    p.add_argument("--tables", required=True)
    p.add_argument("--target", required=True)
    p.add_argument("--mode", default="full", choices=["full", "incremental"])
    p.add_argument("--as-of", default=None, help="timestamp; default: job start")
    p.add_argument("--excluded-order-types", default=None,
                   help="comma-separated order-type names never reported (required for "
                        "order-refresh; pass '' to report every type)")
    p.add_argument("--every", default=None, help="run again at this interval, e.g. '3 minutes' (K1)")
    p.add_argument("--runs", type=int, default=None, help="with --every: stop after so many runs")
    p.add_argument("--hot-key-rows", type=int, default=0,
                   help="orders with at least this many lines bypass the shuffle (0: off)")
    p.add_argument("--keep-versions", type=int, default=2,
                   help="complete versions kept after publishing (older ones are dropped)")
    a = p.parse_args(argv)
    if a.job == "order-refresh" and a.excluded_order_types is None:
        p.error("--excluded-order-types is required for order-refresh")
    spark = spark or get_spark(app=f"orderlens-{a.job}")
    return _scheduled(spark, a) if a.every else _run_once(spark, a)


def _scheduled(spark: SparkSession, a) -> str:
    """K1: one run per trigger of a rate stream; each run reads the clock anew."""
    paths: list[str] = []

    def job() -> str:
        if a.runs is None or len(paths) < a.runs:
            paths.append(_run_once(spark, a))
        return paths[-1]

    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    query = refresh_on_trigger(ticks, job, checkpoint=scratch_path(spark, "job-ticks"),
                               trigger={"processingTime": a.every})
    while a.runs is None or len(paths) < a.runs:
        if query.awaitTermination(1):
            break
    query.stop()
    if not paths:
        raise RuntimeError("the scheduled job ended before its first run")
    return paths[-1]


def _run_once(spark: SparkSession, a) -> str:
    as_of = a.as_of or dt.datetime.now().replace(microsecond=0).isoformat(sep=" ")
    if a.job == "order-refresh":
        types = [x for x in a.excluded_order_types.split(",") if x]
        path = order_refresh(spark, a.tables, a.target, as_of, a.mode, types, a.hot_key_rows)
    else:
        path = matrix_refresh(spark, a.tables, a.target, as_of)
    dropped = prune_versions(spark, a.target, keep=a.keep_versions)
    staged = discard_stages(spark)          # every frame reading them has been written
    log.info("%s published %s; dropped %d old versions, %d stages", a.job, path, len(dropped),
             len(staged))
    return path


def cli() -> int:
    """Console entry point: run the job, print the published version, exit 0."""
    logging.basicConfig(level=logging.INFO)
    print(main())
    return 0


if __name__ == "__main__":
    raise SystemExit(cli())
