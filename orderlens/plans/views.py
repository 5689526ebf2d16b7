"""Register the data products as temp views, so SQL written against the
reference's views keeps working (``spark.sql("select ... from portal_view")``).

Views are lazy: each SQL query plans the product afresh over the current
inputs; the stored order table is read at its newest complete version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderlens.plans.erp import erp_directory, erp_order_view, erp_portal_view
from orderlens.sources.store import read_current


def register_order_views(spark: SparkSession, t: dict[str, DataFrame], as_of,
                         excluded_order_types: list[str], *, order_table: str | None = None,
                         doc_lists: dict[str, tuple[DataFrame, str, str]] | None = None,
                         override_patterns: list[str] | None = None) -> list[str]:
    """``order_view`` (J1, computed from the ERP inputs); with ``order_table``
    (a published base path) also ``order_table`` and, given ``doc_lists``,
    ``portal_view`` (J4) over it."""
    names = []
    erp_order_view(t, as_of, excluded_order_types).createOrReplaceTempView("order_view")
    names.append("order_view")
    if doc_lists is not None and not override_patterns:
        raise ValueError("portal_view needs the override patterns (B7)")
    if order_table is not None:
        stored = read_current(spark, order_table)
        stored.createOrReplaceTempView("order_table")
        names.append("order_table")
        if doc_lists is not None:
            erp_portal_view(stored, doc_lists, override_patterns).createOrReplaceTempView(
                "portal_view")
            names.append("portal_view")
    return names


def register_directory_view(t: dict[str, DataFrame]) -> str:
    """``surgeon_hospital``."""
    erp_directory(t).createOrReplaceTempView("surgeon_hospital")
    return "surgeon_hospital"


def register_status_function(spark: SparkSession, name: str, view: str, key: str, revision: str, status: str,
                             key_type: str = "string") -> str:
    """The status function as something SQL users can call, ``name(key)``.

    The status at the greatest revision of the key in ``view``, upper-cased; NULL when no
    row or several rows have it (E6).  A SQL function: the analyzer inlines its query, so
    a call per row is planned as one join with the aggregated view."""
    spark.sql(f"""
        create or replace temporary function {name}(wanted {key_type}) returns string
        return select any_value(if(top.m.n = 1, top.m.st, null)) from (
          select k, max(struct(rev, n, st)) as m from (
            select {key} as k, {revision} as rev, count(*) as n, max(upper({status})) as st
            from {view} where {revision} is not null group by {key}, {revision}) group by k) top
        where top.k = wanted""")
    return name
