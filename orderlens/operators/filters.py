"""C3/C7 row filters whose NULL behaviour matters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exclude_values(df: DataFrame, col: Column | str, values) -> DataFrame:
    """``col NOT IN (values)``; a NULL ``col`` is dropped too (H4)."""
    c = F.col(col) if isinstance(col, str) else col
    return df.where(~c.isin(list(values)))


def keep_flagged_or_unflagged(df: DataFrame, flag: str, order_flag: str) -> DataFrame:
    """Keep flagged lines, or every line of an order without flags.
    Both NULL -> dropped."""
    return df.where((F.col(flag) == 1) | (F.col(order_flag) == 0))
