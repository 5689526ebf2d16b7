"""The legacy two-branch load, set-based.

The reference fetched 1000 rows at a time, ran a status query per row and
inserted general and special (G3) orders from two cursors with different
column lists.  Here the per-row lookup is one strict-latest aggregate (E6)
joined once, and the two cursors become ONE pass over the joined orders: each
output column takes its general or special expression per row, by the
special-order flag (D11 NOT EXISTS / EXISTS).  The rows equal the two branches
appended by name (A5), without scanning and joining the orders twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.operators.joins import exists_flag


def _named(cols: list[Column], df: DataFrame) -> dict[str, Column]:
    """Output name -> expression, names taken from the projection schema."""
    names = df.select(*cols).columns
    return dict(zip(names, cols))


def branch_load(rows: DataFrame, is_special: Column, review_status: DataFrame, *, review_on: str,
                review_key: str, general_cols: list[Column], special_cols: list[Column]) -> DataFrame:
    """A6 over rows that know their branch: the review status (one row per
    ``review_key``) is joined once, then each output column takes its general
    or its special expression; a column only one branch defines is NULL in the
    other (insert with explicit column lists)."""
    x = rows.withColumn("__special", is_special)
    x = x.join(review_status, x[review_on] == review_status[review_key], "left")
    special = F.col("__special")
    gen, spe = _named(general_cols, x), _named(special_cols, x)
    out = []
    for name in list(gen) + [n for n in spe if n not in gen]:
        g, s = gen.get(name), spe.get(name)
        if g is not None and s is not None:
            expr = F.when(special, s).otherwise(g)
        elif s is not None:
            expr = F.when(special, s)
        else:
            expr = F.when(~special, g)
        out.append(expr.alias(name))
    return x.select(*out)


def two_branch_load(headers: DataFrame, special_keys: DataFrame, review_status: DataFrame, *,
                    header_key: str, special_key: str, review_on: str, review_key: str,
                    general_cols: list[Column], special_cols: list[Column]) -> DataFrame:
    """One input: orders with a line of the special item class take the special
    branch, all others the general one (D11 as an existence flag)."""
    x = exists_flag(headers, special_keys, header_key, special_key, "__in_class")
    return branch_load(x, F.col("__in_class") == 1, review_status, review_on=review_on,
                       review_key=review_key, general_cols=general_cols, special_cols=special_cols)
