"""Text builders with the reference's NULL rules.

In the reference's SQL dialect an empty string is NULL and concatenating NULL
contributes nothing.  Spark keeps ``''`` distinct from NULL and its ``concat``
returns NULL if any part is NULL, so every builder here maps blanks to NULL
first and wraps each part in ``coalesce(part, '')``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def blank_to_null(x: ColumnOrName) -> Column:
    """I1/H1: '' becomes NULL."""
    return F.nullif(_c(x), F.lit(""))


def nvl(x: ColumnOrName, default) -> Column:
    """First non-NULL of ``x`` and ``default``; blank text counts as NULL (H1)."""
    c = _c(x)
    missing = c.isNull() | (c.cast("string") == "")
    return F.when(missing, default if isinstance(default, Column) else F.lit(default)).otherwise(c)


def nvl2(x: ColumnOrName, if_set: Column, if_null: Column) -> Column:
    """``if_set`` when ``x`` is not NULL (blank counts as NULL), else ``if_null``."""
    return F.when(blank_to_null(x).isNotNull(), if_set).otherwise(if_null)


def concat_text(*parts: ColumnOrName) -> Column:
    """I4: ``a || b || ...`` where a NULL part contributes nothing."""
    return F.concat(*[F.coalesce(_c(p).cast("string"), F.lit("")) for p in parts])


def strip_chars(x: ColumnOrName, chars: str) -> Column:
    """Remove every occurrence of ``chars``; a text of nothing else becomes NULL (H1)."""
    return blank_to_null(F.replace(_c(x), F.lit(chars), F.lit("")))


def upper_eq(x: ColumnOrName, value: str) -> Column:
    """Case-insensitive equality against an upper-case literal."""
    return F.upper(_c(x)) == F.lit(value.upper())


def serial_prefix(x: ColumnOrName, chars: str = "AB", to: str = "0") -> Column:
    """I8: a leading character from ``chars`` becomes ``to`` (``A123`` -> ``0123``)."""
    return F.regexp_replace(_c(x), F.lit(f"^[{chars}]"), F.lit(to))


def serial_suffix(x: ColumnOrName) -> Column:
    """Cut at the LAST of A, B, backslash or hyphen (greedy, needs >= 1 char before).

    ``12345A`` -> ``12345``, ``12345-B2`` -> ``12345-``, ``12A34B`` -> ``12A34``;
    no match leaves the text unchanged.  The bracket is the reference's POSIX
    class, in which a backslash is literal (H9).
    """
    return F.regexp_replace(_c(x), F.lit(r"^(.+)[AB\\\-].*"), F.lit("$1"))


def address_line(parts: list[ColumnOrName], state: ColumnOrName | None,
                 province: ColumnOrName | None, country: ColumnOrName | None) -> Column:
    """``p1, p2, ..., nvl(state, province), country, `` (H19: the separator
    after state/province is always present; all-NULL input gives ``, ``)."""
    pieces = [F.coalesce(F.concat(blank_to_null(p), F.lit(", ")), F.lit("")) for p in parts]
    region = [blank_to_null(c) for c in (state, province) if c is not None]
    pieces.append(F.coalesce(*region, F.lit("")) if region else F.lit(""))
    pieces.append(F.lit(", "))
    if country is not None:
        pieces.append(F.coalesce(F.concat(blank_to_null(country), F.lit(", ")), F.lit("")))
    return F.concat(*pieces)


def phone_line(area: ColumnOrName | None, number: ColumnOrName | None = None,
               extension: ColumnOrName | None = None) -> Column:
    """``(area)number extension``; NULL parts are empty, so all NULL gives
    ``() ``.  A part not passed at all (``None``) is left out together with its
    separator."""
    def part(x):
        return F.coalesce(blank_to_null(_c(x).cast("string")), F.lit(""))
    pieces = [F.lit("("), F.lit("") if area is None else part(area), F.lit(")")]
    if number is not None:
        pieces.append(part(number))
    if extension is not None:
        pieces += [F.lit(" "), part(extension)]
    return F.concat(*pieces)
