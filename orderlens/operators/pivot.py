"""E2-E5 category lists and the 0/1 pivot, A15 zero fill."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_ ]*$")


def category_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-NULL values of a category column (a partial aggregate)."""
    return df.select(col).where(F.col(col).isNotNull()).distinct()


def joined_list(df: DataFrame, col: str, sep: str = ",", name: str = "l") -> DataFrame:
    """One row with the distinct values joined in ascending order.

    Distinct runs distributed first; only the distinct values (a category
    list) meet in the final single-row aggregate.
    """
    vals = category_values(df, col)
    return vals.agg(F.array_join(F.sort_array(F.collect_list(col)), sep).alias(name))


def fill_zero(df: DataFrame, cols: list[str]) -> DataFrame:
    """NULL -> 0 in the listed (data-dependent) columns only."""
    return df.na.fill(0, subset=list(cols)) if cols else df


def pivot_values(df: DataFrame, col: str) -> list[str]:
    """E5: the data-dependent column list.  It becomes the output schema, so it is
    collected as a whole: its length is the number of columns asked for."""
    return sorted(r[0] for r in category_values(df, col).collect())


def category_bitmaps(df: DataFrame, keys: list[str], col: str, values: list[str]) -> DataFrame:
    """One row per key group with ``bitmaps``, a map from bitmap bucket to the bits of the
    group's listed categories (numbered as in ``values``).

    The list is joined to the rows as a frame of its own length (number, value); bits are
    combined on the map side, so a group costs its bitmaps and not a cell per category."""
    spark = df.sparkSession
    numbered = spark.createDataFrame(list(enumerate(values)), "__no long, __value string")
    rows = df.select(*keys, F.col(col).alias("__value")).join(F.broadcast(numbered), "__value", "left")
    bits = rows.groupBy(*keys, F.bitmap_bucket_number("__no").alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("__no")).alias("__bits"))
    entry = F.when(F.col("__bucket").isNotNull(), F.struct("__bucket", "__bits"))
    return bits.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias("bitmaps"))


def _cells(bitmaps, values: list[str]):
    """0/1 per category as one array, in the order of ``values``."""
    def cell(no):
        at = F.bitmap_bit_position(no)
        byte = F.call_function("substring", F.try_element_at(bitmaps, F.bitmap_bucket_number(no)),
                               F.floor(at / 8).cast("int") + 1, F.lit(1))
        bit = F.call_function("shiftrightunsigned", F.conv(F.hex(byte), 16, 10).cast("int"), (at % 8).cast("int"))
        return F.coalesce(bit.bitwiseAND(F.lit(1)), F.lit(0))
    return F.transform(F.sequence(F.lit(0).cast("long"), F.lit(len(values) - 1).cast("long")), cell)


def pivot_flags(df: DataFrame, keys: list[str], col: str, values: list[str] | None = None,
                fill: bool = True, upper: bool = True) -> DataFrame:
    """E4/E5 (+A15): one row per key group, one 0/1 column per category.

    Bitmap aggregation over numbered categories (``category_bitmaps``); the wide columns
    appear in the last projection only, so their number is bounded by the schema, not by
    the aggregate.  A group without any listed category keeps its row; its cells are 0
    with ``fill`` (H13), else NULL, as are all cells of categories it lacks.  Column names
    are the values, upper-cased; non-identifiers are rejected.
    """
    if values is None:
        values = pivot_values(df, col)
    values = list(values)
    names = [v.upper() if upper else v for v in values]
    bad = [n for n in names if not _IDENT.match(n)]
    if bad or len(set(names)) != len(names):
        raise ValueError(f"pivot values are not distinct identifiers: {bad or names}")
    if not values:
        return df.select(*keys).distinct()
    cells = category_bitmaps(df, keys, col, values).withColumn("__cells", _cells(F.col("bitmaps"), values))
    # a cell is read many times: the array is computed once, by a step that is not merged with the next
    cells = cells.select(*keys, F.explode(F.array("__cells")).alias("__cells"))
    cell = [F.get("__cells", F.lit(i)) for i in range(len(values))]
    return cells.select(*keys, *[(c if fill else F.nullif(c, F.lit(0))).alias(n) for c, n in zip(cell, names)])
