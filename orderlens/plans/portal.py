"""The portal view - stored order table + document-existence flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from orderlens.operators.joins import exists_flags


def portal_view(orders: DataFrame, columns: list[Column],
                doc_flags: dict[str, tuple[DataFrame, str, str]], distinct: bool = True) -> DataFrame:
    """Project ``columns`` of the stored order table and add one 0/1 flag per
    document list (D13, lists on one column in one join, rows never
    multiply); then SELECT DISTINCT as the reference does (E1)."""
    out = exists_flags(orders, doc_flags).select(*columns, *doc_flags.keys())
    return out.distinct() if distinct else out
