"""Derived labels and predicates of the order view, parameterised.

Defaults are the reference's own codes; the driver-table queries pass their
role mapping instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlens.functions.dates import as_ts, days_before
from orderlens.functions.text import ColumnOrName, _c, blank_to_null

# --- fixed values (must equal the reference's for the same results) ---------
CLOSED = "CLOSED"
CANCELLED = "CANCELLED"
PENDING_DESIGN = "PENDING_DESIGN_APPROVAL"
RETURN_LABEL = "RETURN"
REVIEW_LABELS = {
    "PENDING": "Pending Surgeon Review",
    "DECLINED": "Re-Design",
    "APPROVED": "Design Approved by Surgeon",
}
CATEGORY_NONE = "NONE"
CATEGORY_PARTIAL = "Partial"
NO_CATEGORY = "NOCAT"
GROUP_PRICE_COUNTRIES = ("US", "VI", "VG")
# -----------------------------------------------------------------------------


def status_label(code: ColumnOrName, qty: ColumnOrName, review: ColumnOrName, *,
                 return_code: ColumnOrName | None = None, closed: str | None = CLOSED,
                 pending: str = PENDING_DESIGN, review_labels: dict[str, str] = REVIEW_LABELS,
                 qty_limit: float = 0, return_label: str = RETURN_LABEL) -> Column:
    """I16: closed with quantity <= limit -> RETURN; pending -> label of the
    latest review (upper-cased lookup, own code when unknown); else own code.
    ``closed=None`` drops the RETURN branch (the legacy loader's form)."""
    code = _c(code)
    ret = code if return_code is None else _c(return_code)
    reviewed = F.upper(_c(review))
    decoded = None
    for key, label in review_labels.items():
        decoded = (F.when(reviewed == F.lit(key), F.lit(label)) if decoded is None
                   else decoded.when(reviewed == F.lit(key), F.lit(label)))
    decoded = code if decoded is None else decoded.otherwise(code)
    if closed is None:  # legacy form: review label only (no RETURN branch)
        return F.when(code == F.lit(pending), decoded).otherwise(code)
    return (F.when((ret == F.lit(closed)) & (_c(qty) <= F.lit(qty_limit)), F.lit(return_label))
             .when(code == F.lit(pending), decoded)
             .otherwise(code))


def category_label(seg_a: ColumnOrName, seg_b: ColumnOrName, *, none: str = CATEGORY_NONE,
                   partial: str = CATEGORY_PARTIAL, nocat: str = NO_CATEGORY) -> Column:
    """Category from two segments, six ordered branches (first match wins)."""
    a, b = blank_to_null(seg_a), blank_to_null(seg_b)
    return (F.when((a == none) & (b == none), F.lit(none))
             .when((a == partial) & b.isNotNull(), b)
             .when((a == none) & b.isNotNull(), b)
             .when((b == none) & a.isNotNull(), a)
             .when(a.isNull() & b.isNull(), F.lit(nocat))
             .otherwise(F.concat(F.coalesce(a, F.lit("")), F.lit(" "), F.coalesce(b, F.lit("")))))


def country_choice(country: ColumnOrName, group_value: ColumnOrName, site_value: ColumnOrName,
                   group_countries=GROUP_PRICE_COUNTRIES) -> Column:
    """Listed countries take the group price list, others the site's."""
    return F.when(_c(country).isin(list(group_countries)), _c(group_value)).otherwise(_c(site_value))


def conditional_price(price: ColumnOrName, item: ColumnOrName, item_id,
                      positive: ColumnOrName | None = None) -> Column:
    """The price only for one item id and a positive amount, else NULL."""
    pos = _c(price) if positive is None else _c(positive)
    return F.when((_c(item) == F.lit(item_id)) & (pos > 0), _c(price))


def yes_flag(x: ColumnOrName, yes: str = "Yes") -> Column:
    """1 when the text equals ``yes``, else 0 (NULL gives 0)."""
    return F.when(_c(x) == F.lit(yes), F.lit(1)).otherwise(F.lit(0))


def gate(x: ColumnOrName, flag: ColumnOrName) -> Column:
    """Show the value only when the (order) flag is 1."""
    return F.when(_c(flag) == 1, _c(x))


def override_description(category: ColumnOrName, patterns: list[str], detail: ColumnOrName,
                         default: ColumnOrName) -> Column:
    """For categories matching any LIKE pattern use the detail text when present."""
    match = None
    for p in patterns:
        m = _c(category).like(p)
        match = m if match is None else (match | m)
    return F.when(match & blank_to_null(detail).isNotNull(), _c(detail)).otherwise(_c(default))


def pattern_flag(x: ColumnOrName, pattern: str) -> Column:
    """B8: 'True' when LIKE matches, else 'False' (NULL gives 'False')."""
    return F.when(_c(x).like(pattern), F.lit("True")).otherwise(F.lit("False"))


def retained(status: ColumnOrName, qty: ColumnOrName, ship_date: ColumnOrName, as_of, *,
             closed: str = CLOSED, cancelled: str = CANCELLED, days: float = 30,
             qty_limit: float = 0, shipped_days: float | None = None,
             shipped_date: ColumnOrName | None = None) -> Column:
    """Which lines stay on the report.

    open lines; closed and not returned (NULL quantity counts as not returned);
    returned or cancelled lines whose ship date is within ``days`` of
    ``as_of``.  ``shipped_days`` also limits closed-not-returned lines (C9),
    on ``shipped_date`` (default: ``ship_date``).
    A NULL status matches no branch and is dropped (H4).
    """
    st, q, ship = _c(status), _c(qty), _c(ship_date)
    recent = ship >= days_before(as_of, days)
    not_returned = (st == closed) & (F.coalesce(q, F.lit(qty_limit + 1)) > qty_limit)
    if shipped_days is not None:
        shipped = ship if shipped_date is None else _c(shipped_date)
        not_returned = not_returned & (shipped >= days_before(as_of, shipped_days))
    return (~st.isin(closed, cancelled)
            | not_returned
            | ((st == closed) & (q <= qty_limit) & recent)
            | ((st == cancelled) & recent))


__all__ = [
    "status_label", "category_label", "country_choice", "conditional_price", "yes_flag",
    "gate", "override_description", "pattern_flag", "retained", "as_ts",
]
