"""A derived key column kept correct on write.

The reference fills the normalised serial with a virtual column or a row
trigger.  Here the one writer (batch ``publish`` or a stream) applies the same
function, so stored rows always carry it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame

from orderlens.functions.text import serial_suffix


def with_serial_key(df: DataFrame, source: str, out: str = "serial_number_ori",
                    normalize: Callable[[str], Column] = serial_suffix) -> DataFrame:
    return df.withColumn(out, normalize(source))
