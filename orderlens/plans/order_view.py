"""The order view - one row per reportable order line.

One builder serves the three generations; they differ only by
:class:`OrderViewConfig`.  Inputs are role frames with canonical column
names (see ``ROLE_COLUMNS``); a role mapping (e.g. the driver tables in
:mod:`orderlens.plans.driver`) produces them.

Plan shape (each join keyed, no nested loops):

  lines x items            (item key)     item attributes + line flag
  group max per order      (order key)    F1, partial aggregate + join back
  header x lines           (order key)    reuses the order-key partitioning
  x contacts, reviews, scans, document flags (contact/serial key)
  x sites                  (site key)
  filters                  Catalyst pushes each to its side and turns the
                           outer joins they null-reject into inner joins (H5)
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.labels import (
    CANCELLED, CLOSED, NO_CATEGORY, PENDING_DESIGN, REVIEW_LABELS, category_label, gate,
    pattern_flag, retained, status_label,
)
from orderlens.functions.text import address_line, nvl, serial_prefix, strip_chars
from orderlens.operators.filters import exclude_values, keep_flagged_or_unflagged
from orderlens.operators.joins import (
    exclude_existing, exists_flags, join_latest, left_join_filtered, prefix_lookup,
)
from orderlens.operators.latest import group_max

# --- fixed values (must equal the reference's for the same results) ---------
# Line types never reported (the list of the current view, V6.0).
EXCLUDED_LINE_TYPES = (
    "HIP Procedure", "HIP Alt Kit to Sales Rep", "HIP RMA Alt Kit SRep Rec Only",
    "HIP RMA Proc Cust Rec & Credit", "HIP Alt Kit Item to Customer",
    "HIP Alt Kit to Sales Rep", "HIP Patient Specific", "HIP Loaner Kit Item to Cust",
    "HIP RMA Loaner Kit Rec Only", "HIP Loaner Kit to Sales Rep",
    "Plat Serv - Identity Bill Only", "Plat Serv PatPay - Identity BO",
)
# Line types excluded by the two older generations (materialised view, draft);
# note the trailing blank of the fourth name.
EXCLUDED_LINE_TYPES_V1 = (
    "HIP Procedure", "HIP Alt Kit to Sales Rep", "HIP RMA Alt Kit SRep Rec Only",
    "HIP RMA Proc Cust Rec ", "HIP Alt Kit Item to Customer", "HIP Alt Kit to Sales Rep",
    "HIP Patient Specific",
)
ORDER_NUMBER_BOUND = 700001
CATEGORY_EXCLUDE = "Patella%"
# -----------------------------------------------------------------------------

ROLE_COLUMNS = {
    "header": ["header_id", "order_number", "contact_id"],
    "lines": ["header_id", "line_no", "item_id", "site_id", "line_type", "line_status",
              "qty", "commit_date"],
    "items": ["item_id", "flag", "catalog", "description"],
    "contacts": ["contact_ref", "contact_party_id", "contact_name"],
    "sites": ["site_ref", "site_name"],
    "reviews": ["review_key", "review_status"],
    "scans": ["scan_key", "scan_date"],
}


@dataclass(frozen=True)
class OrderViewConfig:
    as_of: str
    order_bound: int | None = ORDER_NUMBER_BOUND
    excluded_line_types: tuple[str, ...] = EXCLUDED_LINE_TYPES
    exclude_like: str | None = CATEGORY_EXCLUDE
    exclude_like_col: str = "category"
    exclude_like_default: str | None = None      # nvl guard of the older view (J2)
    require_contact: bool = True                 # J3 (draft) keeps lines without contact
    status_col: str = "status_code"              # pending test and own code
    return_status_col: str = "line_status"       # CLOSED/CANCELLED test
    closed: str = CLOSED
    cancelled: str = CANCELLED
    pending: str = PENDING_DESIGN
    review_labels: dict = field(default_factory=lambda: dict(REVIEW_LABELS))
    qty_limit: float = 0
    retention_days: float = 30
    shipped_days: float | None = None            # J3 also ages out shipped lines
    shipped_date_col: str | None = None          # J3: on the actual shipment date
    catalog_strip: str = "-"
    category_mode: str | None = "segments"       # "segments", "lookup" or None
    category_key_len: int = 5                    # lookup mode: prefix length
    lookup_flag_pattern: str | None = None       # J2: 'True'/'False' flag on the lookup meaning
    lookup_flag_name: str = "patella_flag"
    gate_description: bool = False               # J2: description only for flagged orders
    review_on: str = "serial"                    # row column matched to reviews
    scan_on: str = "serial"
    review_order: tuple[str, ...] = ("review_rank",)
    scan_order: tuple[str, ...] = ("scan_rank",)
    review_cols: tuple[str, ...] = ("review_status",)
    scan_cols: tuple[str, ...] = ("scan_date",)
    address_parts: tuple[str, ...] = ("address1", "address2", "address3", "address4", "city")
    state_col: str | None = "state"
    province_col: str | None = "province"
    country_col: str | None = "country"
    extra_cols: tuple[str, ...] = ()
    hot_order_keys: tuple | None = None          # find_hot_keys(lines, ["header_id"], n)
    bound_is_key: bool = False                   # order_number equals header_id: the bound
                                                 # also filters lines before the flag aggregate


def order_view_rows(header: DataFrame, lines: DataFrame, items: DataFrame, contacts: DataFrame,
                    sites: DataFrame | None, reviews: DataFrame | None, scans: DataFrame | None,
                    cfg: OrderViewConfig, *,
                    category_lookup: DataFrame | None = None,
                    excluded_groups: tuple[DataFrame, str, str] | None = None,
                    doc_flags: dict[str, tuple[DataFrame, str, str]] | None = None,
                    lookups: list[tuple[DataFrame, list[tuple[str, str]], object]] = ()
                    ) -> DataFrame:
    """The joined and filtered rows of the order view, every input column kept.

    ``category_lookup``: (code, meaning) frame for ``category_mode='lookup'``.
    ``excluded_groups``: (frame, row column, frame column) - rows whose column
    value occurs in the frame are removed (NOT EXISTS, D10).
    ``doc_flags``: name -> (frame, row column, frame column) existence flags (D13).
    ``lookups``: extra outer joins (frame, [(row column, frame column), ...],
    constant ON condition on the frame or None) - multi-column keys (D3) and
    ON-clause filters (D4) of line-level lookups such as the sales rep or the
    item category.
    ``sites``, ``reviews`` and ``scans`` only add columns; one that is None is left out.
    """
    h = header
    if cfg.order_bound is not None:
        h = h.where(F.col("order_number") < cfg.order_bound)          # C1

    # item view: lines x items, then the order-level flag over ALL lines (F1).
    # When the order number is the header key, every line of a reportable
    # order is below the bound too, so the bound can filter the lines first:
    # exact, and pushed into the scan of the flag aggregate as well (Catalyst
    # infers it into only one of the two line scans through the join-back).
    if cfg.order_bound is not None and cfg.bound_is_key:
        lines = lines.where(F.col("header_id") < cfg.order_bound)
    li = lines.join(items, "item_id", "left")
    if cfg.category_mode == "lookup":
        if category_lookup is None:
            raise ValueError("category_mode='lookup' needs category_lookup")
        key = F.substring(F.col("category_key"), 1, cfg.category_key_len)
        li = prefix_lookup(li, key, category_lookup, "code", "meaning", "category_meaning")
    # Lines without an order key never meet a header, so the flag is joined
    # back with a plain inner key join: it keeps the order-key partitioning
    # for the header join, and lets Catalyst infer the header filters (the
    # order-number bound, when it is on the key) into BOTH line scans.
    li = group_max(li, "flag", "header_id", "order_flag", null_keys="drop",
                   hot_keys=list(cfg.hot_order_keys) if cfg.hot_order_keys else None)
    if cfg.hot_order_keys:
        # The retention filter below drops every row without a line, so this
        # join is effectively inner; written from the lines' side (many to
        # one), the hot orders' lines meet their header without a shuffle.
        from orderlens.operators.skew import join_to_one
        x = join_to_one(li, h, [("header_id", "header_id")], "inner", list(cfg.hot_order_keys))
    else:
        x = h.join(li, "header_id", "left")

    x = x.join(contacts, x["contact_id"] == contacts["contact_ref"], "left")
    if cfg.require_contact:
        x = x.where(F.col("contact_party_id").isNotNull())             # C2, outer -> inner
    if excluded_groups is not None:
        gdf, row_col, gcol = excluded_groups
        x = exclude_existing(x, gdf.select(gcol), [(row_col, gcol)])    # D10
    if doc_flags:
        x = exists_flags(x, doc_flags)                                   # D13
    if reviews is not None:
        x = join_latest(x, reviews, [(cfg.review_on, "review_key")], list(cfg.review_order),
                        list(cfg.review_cols))                           # D5
    if scans is not None:
        x = join_latest(x, scans, [(cfg.scan_on, "scan_key")], list(cfg.scan_order),
                        list(cfg.scan_cols))
    if sites is not None:
        x = x.join(sites, x["site_id"] == sites["site_ref"], "left")
    for frame, on, cond in lookups:
        x = left_join_filtered(x, frame, on, cond)                      # D3/D4

    # category (I17 from segments, or D7 lookup) before it is filtered on
    if cfg.category_mode == "segments":
        x = x.withColumn("category", category_label("category_a", "category_b"))
    elif cfg.category_mode == "lookup":
        x = x.withColumn("category", nvl("category_meaning", NO_CATEGORY))

    # filters (C3, C7, C5, C8/C9)
    x = exclude_values(x, "line_type", cfg.excluded_line_types)
    x = keep_flagged_or_unflagged(x, "flag", "order_flag")
    if cfg.exclude_like is not None:
        c = F.col(cfg.exclude_like_col)
        if cfg.exclude_like_default is not None:
            c = F.coalesce(c, F.lit(cfg.exclude_like_default))
        x = x.where(~c.like(cfg.exclude_like))
    return x.where(retained(cfg.return_status_col, "qty", "commit_date", cfg.as_of,
                            closed=cfg.closed, cancelled=cfg.cancelled, days=cfg.retention_days,
                            qty_limit=cfg.qty_limit, shipped_days=cfg.shipped_days,
                            shipped_date=cfg.shipped_date_col))


def order_view(header: DataFrame, lines: DataFrame, items: DataFrame, contacts: DataFrame,
               sites: DataFrame, reviews: DataFrame, scans: DataFrame, cfg: OrderViewConfig, *,
               category_lookup: DataFrame | None = None,
               excluded_groups: tuple[DataFrame, str, str] | None = None,
               doc_flags: dict[str, tuple[DataFrame, str, str]] | None = None) -> DataFrame:
    """Build the order view with the canonical output columns (see
    :func:`order_view_rows` for the arguments)."""
    x = order_view_rows(header, lines, items, contacts, sites, reviews, scans, cfg,
                        category_lookup=category_lookup, excluded_groups=excluded_groups,
                        doc_flags=doc_flags)
    description = F.col("description")
    if cfg.gate_description:
        description = gate(description, "order_flag")                  # B6
    cols = [
        F.col("order_number").alias("order_id"),
        F.col("line_no"),
        F.col("contact_party_id").alias("contact_id"),
        F.col("contact_name"),
        strip_chars("catalog", cfg.catalog_strip).alias("catalog_number"),   # I5
        description.alias("description"),
    ]
    if cfg.category_mode is not None:
        cols.append(F.col("category"))
    if cfg.category_mode == "lookup" and cfg.lookup_flag_pattern is not None:
        cols.append(pattern_flag("category_meaning", cfg.lookup_flag_pattern)
                    .alias(cfg.lookup_flag_name))                        # B8
    cols += [
        F.col("site_name"),
        location(cfg).alias("location"),                                  # I18
        order_status(cfg).alias("status"),                                # I16
        F.col("commit_date"),
        F.col("scan_date"),
        nvl("rep_number", "X").alias("rep"),                             # I1
        serial_prefix("serial").alias("serial_ori"),                     # I8
        F.col("flag"),
        F.col("order_flag"),
    ]
    cols += [F.col(n) for n in (doc_flags or {})]
    cols += [F.col(c) for c in cfg.extra_cols]
    return x.select(*cols)


def order_view_keys(header: DataFrame, lines: DataFrame, items: DataFrame, contacts: DataFrame,
                    cfg: OrderViewConfig, keys: list[str], *,
                    category_lookup: DataFrame | None = None,
                    excluded_groups: tuple[DataFrame, str, str] | None = None) -> DataFrame:
    """The distinct ``keys`` of :func:`order_view`, for the delete check (A8): its filters,
    without the joins that only add columns (reviews, scans, sites).  ``keys`` are
    ``order_id`` or columns of headers, lines, items and contacts."""
    x = order_view_rows(header, lines, items, contacts, None, None, None, cfg,
                        category_lookup=category_lookup, excluded_groups=excluded_groups)
    return x.select(*[F.col("order_number").alias(k) if k == "order_id" else F.col(k) for k in keys]).distinct()


def location(cfg: OrderViewConfig):
    return address_line(list(cfg.address_parts), cfg.state_col, cfg.province_col, cfg.country_col)


def order_status(cfg: OrderViewConfig):
    return status_label(cfg.status_col, "qty", "review_status", return_code=cfg.return_status_col,
                        closed=cfg.closed, pending=cfg.pending, review_labels=cfg.review_labels,
                        qty_limit=cfg.qty_limit)
