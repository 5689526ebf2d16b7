"""A12 widen a table with new nullable columns; A18 enforce a declared layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def widen(df: DataFrame, schema: StructType) -> DataFrame:
    """Add every field of ``schema`` missing from ``df`` as a typed NULL column."""
    have = set(df.columns)
    extra = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in have]
    return df.select("*", *extra)


def enforce_schema(df: DataFrame, schema: StructType, strict: bool = True) -> DataFrame:
    """Project ``df`` to exactly ``schema`` (by name, in schema order, cast).

    ``strict`` raises on a missing column (a declared layout must be met);
    otherwise missing columns become typed NULLs.
    """
    have = set(df.columns)
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing and strict:
        raise ValueError(f"columns missing for declared schema: {missing}")
    cols = [
        (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*cols)
