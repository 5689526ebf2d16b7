"""Surgeon-hospital directory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from orderlens.operators.joins import left_join_filtered


def directory(roles: DataFrame, rel: DataFrame, hospitals: DataFrame, *,
              rel_on: tuple[str, str], hosp_on: tuple[Column, str], role_cond: Column,
              contact_points: list[tuple[DataFrame, tuple[str, str], Column | None]],
              columns: list[Column]) -> DataFrame:
    """Roles LEFT JOIN relationship, then an INNER join to the hospital on the
    relationship's column (which collapses that outer join, D15) restricted
    by the role condition (C6 case-insensitive title), then each contact
    point as an outer join with its type/status/primary conditions in ON
    (D4; one table in several roles, D14)."""
    x = roles.join(rel, roles[rel_on[0]] == rel[rel_on[1]], "left")
    hosp_expr, hosp_key = hosp_on
    x = x.join(hospitals, (hosp_expr == hospitals[hosp_key]) & role_cond, "inner")
    for cp, (row_col, cp_col), cond in contact_points:
        x = left_join_filtered(x, cp, [(row_col, cp_col)], cond)
    return x.select(*columns)
