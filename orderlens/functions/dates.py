"""Dates: explicit ``as_of`` instead of the clock (H3), text dates, guards."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlens.functions.text import ColumnOrName, _c, blank_to_null


def as_ts(value) -> Column:
    """A timestamp literal (no time zone, like the driver tables) or a Column."""
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp_ntz")


def days_before(as_of, days: float = 0, hours: float = 0, minutes: float = 0) -> Column:
    """``as_of - n days`` (the reference writes ``sysdate - 1/24`` for an hour)."""
    return as_ts(as_of) - F.lit(_dt.timedelta(days=days, hours=hours, minutes=minutes))


def text_to_date(x: ColumnOrName, fmt: str = "yyyy/M/d", length: int = 10,
                 strict: bool = False) -> Column:
    """First ``length`` chars parsed as a date, months and days of one digit or two.

    Default is lenient: unparsable or blank text gives NULL.  ``strict=True``
    raises on bad text like the reference does (H16, documented deviation).
    """
    text = blank_to_null(F.substring(_c(x), 1, length))
    if strict:
        return F.to_date(text, fmt)
    return F.try_to_timestamp(text, F.lit(fmt)).cast("date")


def date_text(x: ColumnOrName) -> Column:
    """Date as ``DD-MON-YYYY`` upper case (``01-MAR-2020``)."""
    return F.upper(F.date_format(_c(x), "dd-MMM-yyyy"))


def text_to_number(x: ColumnOrName, to: str = "decimal(38,10)", strict: bool = False) -> Column:
    """Text to number, fractions kept; NULL on bad text unless ``strict``."""
    return _c(x).cast(to) if strict else _c(x).try_cast(to)


def valid_at(start: ColumnOrName, end: ColumnOrName, as_of, end_days: float = 1) -> Column:
    """``as_of between nvl(start, as_of) and nvl(end, as_of + end_days)``.

    An open start or end never excludes a row.
    """
    t = as_ts(as_of)
    return t.between(F.coalesce(_c(start), t),
                     F.coalesce(_c(end), t + F.lit(_dt.timedelta(days=end_days))))


def change_guard(src_ts: ColumnOrName, tgt_ts: ColumnOrName,
                 compared: list[tuple[ColumnOrName, ColumnOrName]] = (),
                 sentinel=_dt.date(2000, 1, 1)) -> Column:
    """A10: update when the source is newer or a sentinel-guarded value differs.

    ``src_ts > tgt_ts`` is unknown when either side is NULL, so a NULL target
    timestamp alone does not update (H7).  Compared values are NULL-defaulted
    to ``sentinel`` - deliberately not ``eqNullSafe``: a real sentinel value
    equals NULL, as in the reference.
    """
    lit = sentinel if isinstance(sentinel, Column) else F.lit(sentinel)
    guard = _c(src_ts) > _c(tgt_ts)
    for s, t in compared:
        guard = guard | (F.coalesce(_c(s), lit) != F.coalesce(_c(t), lit))
    return guard
