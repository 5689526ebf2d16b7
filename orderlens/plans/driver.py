"""The SURVEY section 2 queries over the driver tables (role mapping of FIXTURES.md 3).

Each ``q_<key>(spark, sf_dir)`` builds its result through the library
operators; the matching DuckDB SQL lives in :mod:`orderlens.plans.oracles`.
The role mapping plays order header = orders, order line = lineitem, item =
part, contact/hospital = customer, site = supplier, lookups = nation/region,
reviews/scans/documents = events.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType,
)

from orderlens import functions as X
from orderlens.operators import (
    append_by_name, category_values, delete_missing, duplicate_keys, expand_by_list,
    exclude_existing, exclude_keys, exclude_values, exists_flags, fill_zero, group_max,
    incremental_refresh, join_latest, join_on_expr, joined_list, keep_flagged_or_unflagged,
    keep_keys, latest_per_key, left_join_filtered, left_join_many, merge_upsert, or_join, pivot_flags,
    pivot_values, prefix_lookup, reconcile_tree, recent, strict_latest, with_serial_key,
)
from orderlens.operators.merge import changed_since
from orderlens.plans.directory import directory
from orderlens.plans.legacy import two_branch_load
from orderlens.plans.order_view import ORDER_NUMBER_BOUND, OrderViewConfig, order_view, order_view_keys
from orderlens.plans.portal import portal_view
from orderlens.plans.pricing import (
    hospital_product, party_category, party_pricelist, pricelist_item,
)
from orderlens.session import scratch_path
from orderlens.sources.buckets import read_bucketed, refresh_buckets, write_bucketed
from orderlens.sources.schema import enforce_schema, widen
from orderlens.sources.store import full_refresh, publish, read_current
from orderlens.sources.tables import Tables

# --- role-mapping parameters of the driver fixtures --------------------------
REPORT_AS_OF = "2001-10-05"
GROUP_NATIONS = ("NATION_1", "NATION_2", "NATION_3")
DRIVER_REVIEW_LABELS = {"VIEW": "Pending Review", "ERROR": "Re-Design", "PURCHASE": "Approved"}
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
EVENT_ORDER = ["ts", "event_id"]          # total order for "latest" (ts desc, event_id desc)


def _t(spark: SparkSession, d: str) -> Tables:
    return Tables(spark, d)


# --- shared role frames ---------------------------------------------------------

def _merge_source(t: Tables) -> DataFrame:
    """The "view" of the merge fixtures: orders of one priority have left it."""
    o = t.orders
    return o.where(F.col("o_orderpriority") != "4-NOT SPECIFIED").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("st"),
        F.col("o_orderdate").alias("upd"), (F.floor("o_totalprice") % 3).alias("sub"))


def _merge_target(t: Tables) -> DataFrame:
    """The stored table of the merge fixtures: older values, some NULLs, and
    orders of one priority not loaded yet."""
    o = t.orders
    k = F.col("o_orderkey")
    return o.where(F.col("o_orderpriority") != "1-URGENT").select(
        k.alias("id"), F.lit("old").alias("st"),
        F.when(k % 4 == 0, F.col("o_orderdate") - F.expr("INTERVAL 5 DAYS"))
         .when(k % 4 == 1, F.lit(None)).otherwise(F.col("o_orderdate")).alias("upd"),
        F.when(k % 6 == 0, F.lit(None)).otherwise(F.floor("o_totalprice") % 3).alias("sub"))


def _merge_guard(s, t):
    return X.change_guard(s("upd"), t("upd"), [(s("sub"), t("sub"))], sentinel=-1)


def _lines_with_flags(t: Tables) -> DataFrame:
    """lineitem x part (item view) + line flag + order flag (F1)."""
    li = t.lineitem.join(t.part.select("p_partkey", "p_size"),
                         F.col("l_partkey") == F.col("p_partkey"), "left")
    li = li.withColumn("flag", F.when(F.col("p_size") >= 40, 1).otherwise(0))
    return group_max(li, "flag", "l_orderkey", "order_flag")


def _order_view_roles(t: Tables, events: DataFrame | None = None) -> dict:
    ev = t.events if events is None else events
    header = t.orders.select(
        F.col("o_orderkey").alias("header_id"), F.col("o_orderkey").alias("order_number"),
        F.col("o_custkey").alias("contact_id"), F.col("o_orderstatus").alias("status_code"))
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("header_id"), F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("item_id"), F.col("l_suppkey").alias("site_id"),
        F.concat("l_returnflag", "l_linestatus").alias("line_type"),
        F.col("l_returnflag").alias("line_status"), F.col("l_quantity").alias("qty"),
        F.col("l_shipdate").alias("commit_date"))
    items = t.part.select(
        F.col("p_partkey").alias("item_id"),
        F.when(F.col("p_size") >= 40, 1).otherwise(0).alias("flag"),
        F.col("p_brand").alias("catalog"), F.col("p_name").alias("description"),
        F.col("p_brand").alias("serial"), F.col("p_type").alias("category_key"))
    contacts = t.customer.select(
        F.col("c_custkey").alias("contact_ref"), F.col("c_custkey").alias("contact_party_id"),
        F.col("c_name").alias("contact_name"), F.col("c_nationkey").alias("contact_group"))
    nat = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    sites = (t.supplier.join(nat, F.col("s_nationkey") == F.col("n_nationkey"), "left")
             .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
             .select(F.col("s_suppkey").alias("site_ref"), F.col("s_name").alias("site_name"),
                     F.col("n_name").alias("state"), F.col("r_name").alias("country"),
                     F.nullif(F.col("n_name"), F.lit("NATION_0")).alias("rep_number")))
    reviews = ev.select(F.col("user_id").alias("review_key"),
                        F.col("event_type").alias("review_status"),
                        F.col("ts").alias("review_ts"), F.col("event_id").alias("review_id"))
    scans = ev.where(F.col("event_type") == "view").select(
        F.col("user_id").alias("scan_key"), F.col("ts").alias("scan_date"),
        F.col("ts").alias("scan_ts"), F.col("event_id").alias("scan_id"))
    return dict(header=header, lines=lines, items=items, contacts=contacts, sites=sites,
                reviews=reviews, scans=scans)


def _order_view_config(**kw) -> OrderViewConfig:
    base = dict(
        as_of=REPORT_AS_OF, order_bound=None, excluded_line_types=("NF",),
        exclude_like="blue%", exclude_like_col="description", closed="R", cancelled="A",
        pending="P", review_labels=DRIVER_REVIEW_LABELS, qty_limit=10, catalog_strip="#",
        category_mode=None, review_on="contact_id", scan_on="contact_id",
        review_order=("review_ts", "review_id"), scan_order=("scan_ts", "scan_id"),
        address_parts=("site_name",), state_col="state", province_col=None,
        country_col="country")
    base.update(kw)
    return OrderViewConfig(**base)


# --- J: data products -----------------------------------------------------------

def q_order_view(spark, d):
    t = _t(spark, d)
    excluded = t.nation.where(F.col("n_name") == "NATION_9").select(
        F.col("n_nationkey").alias("grp"))
    return order_view(**_order_view_roles(t), cfg=_order_view_config(),
                      excluded_groups=(excluded, "contact_group", "grp"))


def q_order_view_lookup(spark, d):
    t = _t(spark, d)
    lookup = t.region.where(F.col("r_regionkey") < 4).select(
        F.substring("r_name", 1, 1).alias("code"), F.col("r_name").alias("meaning"))
    cfg = _order_view_config(category_mode="lookup", category_key_len=1,
                             lookup_flag_pattern="A%", lookup_flag_name="a_flag",
                             gate_description=True, exclude_like_default="NOCAT")
    return order_view(**_order_view_roles(t), cfg=cfg, category_lookup=lookup)


def q_order_view_draft(spark, d):
    t = _t(spark, d)
    errors = t.events.where(F.col("event_type") == "error").select(F.col("user_id").alias("k"))
    cfg = _order_view_config(require_contact=False, shipped_days=60)
    return order_view(**_order_view_roles(t), cfg=cfg,
                      doc_flags={"iview": (errors, "contact_id", "k")})


def q_portal_view(spark, d):
    t = _t(spark, d)
    ev = t.events
    cols = [
        F.col("o_orderkey"),
        X.nvl(F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")), "X").alias("rep"),
        X.override_description("o_orderpriority", ["1-U%", "2-H%"],
                               F.nullif(F.col("o_orderstatus"), F.lit("F")),
                               "o_orderpriority").alias("description"),
        F.col("o_orderdate").alias("actual_date"),
        F.col("o_orderdate").alias("rescheduled_date"),
    ]
    flags = {
        "iview": (ev.where(F.col("event_type") == "error"), "o_custkey", "user_id"),
        "dof": (ev.where(F.col("value") > 90), "o_custkey", "user_id"),
        "iview2": (ev.where(F.col("event_type") == "signup"), "o_custkey", "user_id"),
    }
    return portal_view(t.orders, cols, flags)


def _review_status(t: Tables) -> DataFrame:
    """E6 over events: status at the latest review day, NULL if ambiguous."""
    return strict_latest(t.events, "user_id", F.to_date("ts"), "event_type", name="st")


def q_two_branch_load(spark, d):
    t = _t(spark, d)
    special = (t.lineitem.where(~F.col("l_returnflag").isin("R", "A"))
               .join(t.part.where(F.col("p_type") == "PROMO"),
                     F.col("l_partkey") == F.col("p_partkey"), "left_semi"))
    status = X.status_label("o_orderstatus", F.lit(None), "st", closed=None, pending="P",
                            review_labels=DRIVER_REVIEW_LABELS).alias("status")
    return two_branch_load(
        t.orders, special, _review_status(t), header_key="o_orderkey",
        special_key="l_orderkey", review_on="o_custkey", review_key="user_id",
        general_cols=[F.col("o_orderkey"), status],
        special_cols=[F.col("o_orderkey"), status, F.col("o_orderpriority").alias("detail")])


def _pricelist_item(t: Tables, as_of: str) -> DataFrame:
    o = t.orders
    headers = o.select(
        F.col("o_orderkey").alias("header_id"),
        F.nullif(F.col("o_orderdate"), X.as_ts("1998-10-03")).alias("start_date"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate") + F.expr("INTERVAL 900 DAYS"))
         .alias("end_date"))
    ln = F.col("l_linenumber")
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("header_id"), F.col("l_suppkey").alias("price_list_id"),
        F.when(ln <= 3, "A1").when(ln <= 6, "A2").otherwise("A3").alias("attr"),
        F.when(ln <= 3, F.col("l_partkey")).when(ln <= 6, F.col("l_partkey") + 1).alias("item_ref"),
        F.col("l_extendedprice").alias("amount"))
    items = t.part.select(F.col("p_partkey").alias("item_id"), "p_size", "p_retailprice")
    price = X.conditional_price("p_retailprice", "p_size", 7, positive="amount")
    return pricelist_item(lines, headers, items, as_of, item_ref=F.col("item_ref"),
                          price=price, all_attr="A3")


def q_pricelist_item(spark, d):
    return _pricelist_item(_t(spark, d), "2000-06-01")


def _party_pricelist(t: Tables) -> DataFrame:
    hospitals = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "inner").select(
        F.col("c_custkey").alias("hospital_id"), F.col("c_name").alias("hospital"),
        (F.col("c_nationkey") % 2).alias("req"), (F.col("c_nationkey") + 1).alias("group_id"),
        F.col("n_name").alias("country"), F.col("n_nationkey").alias("site_price_list"))
    precedence = t.supplier.where(F.col("s_acctbal") > 0).select(
        F.col("s_suppkey").alias("grp_key"), F.col("s_suppkey").alias("party_key"),
        F.col("s_suppkey").alias("grp_price_list_id"))
    return party_pricelist(hospitals, precedence, GROUP_NATIONS)


def q_party_pricelist(spark, d):
    return _party_pricelist(_t(spark, d))


def q_union_window(spark, d):
    t = _t(spark, d)
    s = t.supplier
    req = (F.col("s_nationkey") % 2)
    rows = (s.join(t.lineitem, F.col("l_suppkey") == F.col("s_suppkey"), "inner")
             .join(t.part, F.col("p_partkey") == F.col("l_partkey"), "inner")
             .select(F.col("s_suppkey").alias("hid"), req.alias("req"),
                     F.when(req == 1, F.col("p_retailprice")).alias("price"),
                     F.col("p_type").alias("cat")))
    all_items = s.where(F.col("s_acctbal") > 5000).select(F.col("s_suppkey").alias("hid"),
                                                          req.alias("req"))
    cats = t.region.select(F.col("r_name").alias("cat"))
    return party_category(rows, all_items, cats).select("hid", "req", "price", "cat")


def q_hospital_product(spark, d):
    t = _t(spark, d)
    pi = _pricelist_item(t, "2000-06-01")
    pp = _party_pricelist(t)
    # parts of one type have a category without text: their hospitals exist, with zeros
    items = t.part.select(F.col("p_partkey").alias("item_id"),
                          F.nullif(F.col("p_type"), F.lit("LARGE")).alias("cat"))
    cats = t.region.select(F.col("r_name").alias("cat"))
    return hospital_product(pp, pi, items, cats, pivot_values(t.part, "p_type"))


def q_directory(spark, d):
    t = _t(spark, d)
    ev = t.events
    phones = ev.select(F.col("event_id").alias("ph_id"), F.col("event_type").alias("ph_type"))
    emails = ev.select(F.col("event_id").alias("em_id"), F.col("event_type").alias("em_type"))
    hosp = t.supplier.select(F.col("s_suppkey").alias("hosp_id"), F.col("s_name").alias("hosp_name"))
    roles = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment",
                              (F.col("c_custkey") + 1).alias("c_email_ref"))
    return directory(
        roles, t.nation.select("n_nationkey", "n_name"), hosp,
        rel_on=("c_nationkey", "n_nationkey"),
        hosp_on=(F.col("n_nationkey") + 1, "hosp_id"),
        role_cond=X.upper_eq("c_mktsegment", "BUILDING"),
        contact_points=[(phones, ("c_custkey", "ph_id"), F.col("ph_type") == "error"),
                        (emails, ("c_email_ref", "em_id"), F.col("em_type") == "view")],
        columns=[F.col("c_custkey"), F.col("c_name"), F.col("n_name"),
                 F.col("hosp_name").alias("hospital"), X.phone_line("ph_id").alias("phone"),
                 F.col("em_id").alias("email")])


def q_reconcile(spark, d):
    t = _t(spark, d)
    return reconcile_tree(_merge_target(t), _merge_source(t), "id", ["upd"])


# --- A: sources, sinks, maintenance -------------------------------------------

def q_full_refresh(spark, d):
    """A4 over an older version: the reload replaces every row of it."""
    o = _t(spark, d).orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    base = scratch_path(spark, "full_refresh")
    full_refresh(o.withColumn("o_orderstatus", F.lit("old")), base)
    full_refresh(o, base, key="o_orderkey")
    return read_current(spark, base)


def q_append_by_name(spark, d):
    o = _t(spark, d).orders
    general = o.where(F.col("o_orderstatus") != "O").select("o_orderkey", "o_orderstatus")
    special = o.where(F.col("o_orderstatus") == "O").select(
        "o_orderkey", "o_orderstatus", F.col("o_orderpriority").alias("detail"))
    return append_by_name(general, special)


def q_merge_upsert(spark, d):
    t = _t(spark, d)
    src = _merge_source(t)
    changes = changed_since(src, [recent("upd", "2000-01-01", dt.timedelta(0)), F.col("sub") == 2])
    return merge_upsert(_merge_target(t), changes, ["id"], _merge_guard).select("id", "st", "upd")


def q_delete_missing(spark, d):
    t = _t(spark, d)
    return delete_missing(_merge_target(t), _merge_source(t), "id").select("id", "st", "upd")


def q_change_window(spark, d):
    src = _merge_source(_t(spark, d))
    return changed_since(src, [
        recent("upd", "2001-06-01", dt.timedelta(hours=1)),
        F.col("sub") == 2,
        recent("upd", "1999-01-01", dt.timedelta(days=14), inclusive=True, bounded=True)])


def q_change_guard(spark, d):
    t = _t(spark, d)
    s = _merge_source(t).alias("s")
    g = _merge_target(t).alias("g")
    j = s.join(g, F.col("s.id") == F.col("g.id"), "inner")
    guard = X.change_guard(F.col("s.upd"), F.col("g.upd"), [(F.col("s.sub"), F.col("g.sub"))],
                           sentinel=-1)
    return j.select(F.col("s.id").alias("id"),
                    F.when(guard, F.lit(1)).otherwise(F.lit(0)).alias("changed"))


def q_incremental_refresh(spark, d):
    t = _t(spark, d)
    window = [recent("upd", "2000-01-01", dt.timedelta(0)), F.col("sub") == 2]
    return incremental_refresh(_merge_target(t), _merge_source(t), "id", window,
                               _merge_guard).select("id", "st", "upd")


# the driver's lines have no id of their own: these columns tell them apart
ORDER_TABLE_KEYS = ["order_id", "line_no", "item_id", "site_id", "commit_date"]
ORDER_TABLE_EXTRA = {"extra_cols": ("item_id", "site_id")}
ORDER_TABLE_BUCKETS = 4                     # to begin with: buckets split as the table grows
CHANGED_SINCE = "2024-01-30 22:45:00"      # events after it are new (scans, reviews): about 1 % of the rows
ORDERED_SINCE = "2001-07-30 00:00:00"      # orders after it are new


def load_stale_order_table(spark, d, path: str) -> None:
    """The order table before the refresh: no new events, no new orders, and the
    excluded group's lines still in it."""
    t = _t(spark, d)
    roles = _order_view_roles(t, t.events.where(F.col("ts") < X.as_ts(CHANGED_SINCE)))
    old = t.orders.where(F.col("o_orderdate") < X.as_ts(ORDERED_SINCE)).select(F.col("o_orderkey").alias("header_id"))
    roles["header"] = roles["header"].join(old, "header_id", "left_semi")
    write_bucketed(order_view(**roles, cfg=_order_view_config(**ORDER_TABLE_EXTRA)), path, ORDER_TABLE_KEYS,
                   ORDER_TABLE_BUCKETS)


def refresh_order_table(spark, d, path: str) -> dict[str, int]:
    """J8 on the order table itself: the headers that changed are found in the
    inputs (new orders, contacts with new events), the view is built for them
    alone, and the delete check reads the view's keys only."""
    t = _t(spark, d)
    excluded = t.nation.where(F.col("n_name") == "NATION_9").select(F.col("n_nationkey").alias("grp"))
    roles = _order_view_roles(t)
    cfg, groups = _order_view_config(**ORDER_TABLE_EXTRA), (excluded, "contact_group", "grp")

    def keys():
        return order_view_keys(**{k: roles[k] for k in ("header", "lines", "items", "contacts")}, cfg=cfg,
                               keys=ORDER_TABLE_KEYS, excluded_groups=groups)
    contacts = t.events.where(F.col("ts") >= X.as_ts(CHANGED_SINCE)).select(
        F.col("user_id").alias("o_custkey")).distinct()
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    new = F.col("o_orderdate") >= X.as_ts(ORDERED_SINCE)
    changed = (orders.where(new).select(F.col("o_orderkey").alias("header_id"))
               .unionByName(orders.where(~new).join(contacts, "o_custkey", "left_semi")
                            .select(F.col("o_orderkey").alias("header_id"))))
    part = {**roles, "header": roles["header"].join(changed, "header_id", "left_semi"),
            "lines": roles["lines"].join(changed, "header_id", "left_semi")}
    return refresh_buckets(spark, path, lambda: order_view(**part, cfg=cfg, excluded_groups=groups), keys,
                           lambda s, g: F.lit(True))


def q_incremental_order_table(spark, d):
    path = scratch_path(spark, "order-table")
    load_stale_order_table(spark, d, path)
    refresh_order_table(spark, d, path)
    return read_bucketed(spark, path).drop(*ORDER_TABLE_EXTRA["extra_cols"])


def q_widen_schema(spark, d):
    s = _t(spark, d).supplier.select("s_suppkey", "s_name")
    return widen(s, StructType([StructField("header_id", LongType()),
                                StructField("last_update", TimestampNTZType())]))


def q_derive_on_write(spark, d):
    """The writer derives the key column; read back what was written."""
    o = _t(spark, d).orders.select("o_orderkey", "o_orderpriority")
    written = publish(with_serial_key(o, "o_orderpriority", "s"),
                      scratch_path(spark, "derive_on_write"))
    return spark.read.parquet(written).select("o_orderkey", "s")


def q_duplicate_keys(spark, d):
    return duplicate_keys(_t(spark, d).lineitem, ["l_orderkey", "l_linenumber"])


def q_enforce_schema(spark, d):
    s = _t(spark, d).supplier.select(F.col("s_suppkey").alias("hospital_id"),
                                     F.col("s_name").alias("hospital"),
                                     (F.col("s_nationkey") % 2).alias("iuni"))
    return enforce_schema(s, StructType([StructField("hospital_id", LongType()),
                                         StructField("hospital", StringType()),
                                         StructField("iuni", IntegerType())]))


# --- B/C: projections and filters ---------------------------------------------

def q_project_rename(spark, d):
    o = _t(spark, d).orders
    return o.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("contact"),
                    F.col("o_orderdate").alias("actual_date"),
                    F.col("o_orderdate").alias("rescheduled_date"))


def q_const_null_cols(spark, d):
    return _t(spark, d).part.select("p_partkey", F.lit("False").alias("patella_flag"),
                                    F.lit(None).cast("double").alias("price"))


def _part_segments(t: Tables) -> DataFrame:
    sz = F.col("p_size")
    return t.part.select(
        "p_partkey",
        F.when(sz % 5 == 0, "NONE").when(sz % 7 == 0, F.lit(None)).otherwise(F.col("p_type")).alias("a"),
        F.when(sz % 3 == 0, "NONE").when(sz % 11 == 0, F.lit(None)).otherwise(F.col("p_brand")).alias("b"))


def q_category_label(spark, d):
    seg = _part_segments(_t(spark, d))
    return seg.select("p_partkey", X.category_label("a", "b", partial="PROMO").alias("cat"))


def q_flag_gate(spark, d):
    li = _lines_with_flags(_t(spark, d))
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     X.gate("l_returnflag", "order_flag").alias("detail"))


def q_description_override(spark, d):
    p = _t(spark, d).part
    return p.select("p_partkey", X.override_description(
        "p_name", ["blue%", "red%"], F.nullif(F.col("p_type"), F.lit("PROMO")), "p_name"
    ).alias("description"))


def q_pattern_flag(spark, d):
    return _t(spark, d).part.select("p_partkey", X.pattern_flag("p_type", "S%").alias("f"))


def q_order_bound(spark, d):
    """Twice the price plays the order number, so the bound cuts at every scale factor."""
    o = _t(spark, d).orders
    return o.where((F.col("o_totalprice") * 2 < ORDER_NUMBER_BOUND)
                   & (F.col("o_orderstatus") == "F")).select("o_orderkey")


def q_null_filters(spark, d):
    p = _t(spark, d).part
    return p.where(F.nullif(F.col("p_type"), F.lit("PROMO")).isNotNull()
                   & F.nullif(F.col("p_brand"), F.lit("Brand#1")).isNotNull()).select("p_partkey")


def q_not_in_list(spark, d):
    o = _t(spark, d).orders.select(F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("p"))
    return exclude_values(o, "p", ["1-URGENT", "2-HIGH"]).agg(F.count(F.lit(1)).alias("n"))


def q_in_list(spark, d):
    n = _t(spark, d).nation
    return n.where(F.col("n_name").isin(list(GROUP_NATIONS))).select("n_nationkey")


def q_like_filters(spark, d):
    p = _t(spark, d).part
    name = F.nullif(F.col("p_name"), F.lit("blue ring"))
    kept = F.when(~F.coalesce(name, F.lit("NOCAT")).like("blue%"), 1).otherwise(0)
    return p.where(~name.like("red%")).select("p_partkey", kept.alias("kept_default"))


def q_upper_eq(spark, d):
    e = _t(spark, d).events
    return e.where(X.upper_eq("event_type", "VIEW")).select("event_id")


def q_order_flag(spark, d):
    li = keep_flagged_or_unflagged(_lines_with_flags(_t(spark, d)), "flag", "order_flag")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "flag", "order_flag")


def _retention(spark, d, **kw):
    li = _t(spark, d).lineitem
    qty = F.nullif(F.col("l_quantity"), F.lit(7.0))
    keep = X.retained("l_returnflag", qty, "l_shipdate", REPORT_AS_OF, closed="R",
                      cancelled="A", qty_limit=10, **kw)
    return li.where(keep).select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate")


def q_retention(spark, d):
    return _retention(spark, d)


def q_retention_shipped(spark, d):
    return _retention(spark, d, shipped_days=30)


def q_validity(spark, d):
    o = _t(spark, d).orders
    start = F.nullif(F.col("o_orderdate"), X.as_ts("1998-10-03"))
    end = F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate") + F.expr("INTERVAL 900 DAYS"))
    return o.where(X.valid_at(start, end, "2000-01-01")).select("o_orderkey")


def q_not_expired(spark, d):
    o = _t(spark, d).orders
    end = F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate"))
    return o.where(end >= X.as_ts("2000-01-01")).select("o_orderkey")


def q_kind_or_lookup(spark, d):
    t = _t(spark, d)
    key = F.when(F.col("p_type") == "LARGE", F.col("p_size"))
    j = join_on_expr(t.part, t.nation, key, "n_nationkey", "left")
    return j.where((F.col("p_type") == "PROMO") | F.col("n_name").isNotNull()).select(
        "p_partkey", "p_type", "n_name")


# --- D: joins -------------------------------------------------------------------

def q_inner_join(spark, d):
    t = _t(spark, d)
    return (t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"), "inner")
            .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "inner")
            .select("s_suppkey", "n_name", "r_name"))


def q_left_join(spark, d):
    t = _t(spark, d)
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return left_join_many(t.orders.select("o_orderkey"), lines, [("o_orderkey", "l_orderkey")]).select(
        "o_orderkey", "l_linenumber", "l_partkey")


def q_two_key_join(spark, d):
    t = _t(spark, d)
    oc = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "inner").select(
        "o_orderkey", "c_nationkey", "c_name")
    j = t.lineitem.join(oc, (F.col("l_orderkey") == F.col("o_orderkey"))
                        & (F.col("l_linenumber") == F.col("c_nationkey")), "left")
    return j.select("l_orderkey", "l_linenumber", "c_name")


def q_left_join_filtered(spark, d):
    t = _t(spark, d)
    j = left_join_many(t.customer.select("c_custkey"),
                       t.events.select("user_id", "event_id", "event_type", "value"),
                       [("c_custkey", "user_id")],
                       (F.col("event_type") == "error") & (F.col("value") > 50))
    return j.select("c_custkey", "event_id")


def q_join_latest(spark, d):
    t = _t(spark, d)
    j = join_latest(t.customer, t.events, [("c_custkey", "user_id")], EVENT_ORDER,
                    ["event_type", "ts"])
    return j.select("c_custkey", "event_type", "ts")


def q_case_key_join(spark, d):
    t = _t(spark, d)
    key = (F.when(F.col("p_type") == "PROMO",
                  F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("")).cast("int"))
            .when(F.col("p_type") == "LARGE", F.col("p_size")))
    return join_on_expr(t.part, t.nation, key, "n_nationkey", "left").select("p_partkey", "n_name")


def q_prefix_lookup(spark, d):
    t = _t(spark, d)
    lookup = t.nation.where(F.col("n_regionkey") == 1).select(
        F.substring(F.concat("n_name", F.lit("xxxx")), 8, 1).alias("code"),
        F.col("n_name").alias("meaning"))
    out = prefix_lookup(t.part, F.substring("p_brand", 7, 1), lookup, "code", "meaning", "cat",
                        default="NOCAT")
    return out.select("p_partkey", "cat")


def q_or_join(spark, d):
    t = _t(spark, d)
    s = t.supplier.select("s_suppkey", (F.col("s_nationkey") + 1).alias("s_group_part"))
    p = t.part.where(F.col("p_type") == "PROMO").select("p_partkey")
    return or_join(s, p, [("s_group_part", "p_partkey"), ("s_suppkey", "p_partkey")], "left").select(
        "s_suppkey", "p_partkey")


def q_cross_categories(spark, d):
    t = _t(spark, d)
    return expand_by_list(t.supplier.select("s_suppkey"), t.region.select("r_name"))


def q_not_exists(spark, d):
    t = _t(spark, d)
    return exclude_existing(t.orders, t.customer.where(F.col("c_mktsegment") == "BUILDING"),
                            [("o_custkey", "c_custkey")]).select("o_orderkey")


def q_not_exists_chain(spark, d):
    t = _t(spark, d)
    chain = (t.lineitem.where(~F.col("l_returnflag").isin("R", "A"))
             .join(t.part.where(F.col("p_type") == "PROMO"), F.col("l_partkey") == F.col("p_partkey"), "inner")
             .join(t.supplier.where(F.col("s_acctbal") > 0), F.col("l_suppkey") == F.col("s_suppkey"), "inner"))
    return exclude_keys(t.orders, chain, "o_orderkey", "l_orderkey").select("o_orderkey")


def q_exists_flags(spark, d):
    t = _t(spark, d)
    ev = t.events
    x = exists_flags(t.orders, {"iview": (ev.where(F.col("event_type") == "error"), "o_custkey", "user_id"),
                                "dof": (ev.where(F.col("value") > 90), "o_custkey", "user_id")})
    return x.select("o_custkey", "iview", "dof").distinct()      # E1: several orders per customer


def q_role_playing(spark, d):
    t = _t(spark, d)
    own = t.nation.select(F.col("n_nationkey").alias("own_key"), F.col("n_name").alias("own"))
    other = t.nation.select(F.col("n_nationkey").alias("other_key"), F.col("n_name").alias("other"))
    c = t.customer
    j = (c.join(own, F.col("own_key") == F.col("c_nationkey"), "left")
          .join(other, F.col("other_key") == F.col("c_nationkey") + 1, "left"))
    return j.select("c_custkey", "own", "other")


def q_outer_to_inner(spark, d):
    t = _t(spark, d)
    j = left_join_filtered(t.orders, t.customer, [("o_custkey", "c_custkey")],
                           F.col("c_acctbal") > 0)
    return exclude_values(j, "c_mktsegment", ["BUILDING"]).select("o_orderkey", "c_name")


# --- E/F/G: aggregation, pivot, windows ---------------------------------------

def q_category_values(spark, d):
    t = _t(spark, d)
    parts = keep_keys(t.part, t.lineitem, "p_partkey", "l_partkey")
    return category_values(parts, "p_type")


def q_listagg(spark, d):
    return joined_list(_t(spark, d).part, "p_type", ",", "l")


def _supplier_types(t: Tables) -> DataFrame:
    s = t.supplier.select("s_suppkey", "s_name")
    li = left_join_many(s, t.lineitem.select("l_suppkey", "l_partkey"), [("s_suppkey", "l_suppkey")])
    return li.join(t.part.select("p_partkey", "p_type"),
                   F.col("p_partkey") == F.col("l_partkey"), "left")


def q_pivot_flags(spark, d):
    return pivot_flags(_supplier_types(_t(spark, d)), ["s_suppkey", "s_name"], "p_type", PART_TYPES)


def q_pivot_fill(spark, d):
    raw = pivot_flags(_supplier_types(_t(spark, d)), ["s_suppkey", "s_name"], "p_type",
                      PART_TYPES, fill=False)
    return fill_zero(raw, PART_TYPES)


def q_pivot_dynamic(spark, d):
    t = _t(spark, d)
    values = pivot_values(t.part, "p_type")
    return pivot_flags(_supplier_types(t), ["s_suppkey", "s_name"], "p_type", values)


def q_strict_latest(spark, d):
    return strict_latest(_t(spark, d).events, "user_id", F.to_date("ts"), "event_type")


def q_latest_per_key(spark, d):
    return latest_per_key(_t(spark, d).events, "user_id", EVENT_ORDER, ["event_type", "ts"])


# --- I: scalar functions ----------------------------------------------------------

def q_null_defaults(spark, d):
    """One priority is NULL, one blank; both take the default."""
    o = _t(spark, d).orders
    p = F.when(F.col("o_orderpriority") == "2-HIGH", "").otherwise(F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")))
    return o.select("o_orderkey", X.nvl(p, "X").alias("rep"))


def q_address(spark, d):
    t = _t(spark, d)
    j = (t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
         .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left"))
    loc = X.address_line([F.nullif(F.col("s_name"), F.lit("Supplier#000000001"))],
                         F.nullif(F.col("n_name"), F.lit("NATION_3")), "r_name", "r_name")
    return j.select("s_suppkey", loc.alias("loc"))


def q_status_label(spark, d):
    t = _t(spark, d)
    rev = latest_per_key(t.events, "user_id", EVENT_ORDER, ["event_type"])
    j = t.orders.join(rev, F.col("user_id") == F.col("o_custkey"), "left")
    status = X.status_label("o_orderstatus", "o_totalprice", "event_type", closed="F",
                            pending="P", review_labels=DRIVER_REVIEW_LABELS, qty_limit=50000)
    return j.select("o_orderkey", status.alias("status"))


def q_strip_hyphen(spark, d):
    """A text of hyphens only becomes NULL."""
    p = F.when(F.col("o_orderpriority") == "2-HIGH", "--").otherwise(F.col("o_orderpriority"))
    return _t(spark, d).orders.select("o_orderkey", X.strip_chars(p, "-").alias("cat"))


def q_serial_prefix(spark, d):
    return _t(spark, d).part.select("p_partkey", X.serial_prefix("p_brand").alias("s"))


def q_serial_suffix(spark, d):
    return _t(spark, d).orders.select("o_orderkey", X.serial_suffix("o_orderpriority").alias("s"))


def _order_date_text(t: Tables):
    return F.substring(F.col("o_orderdate").cast("string"), 1, 10)


def q_date_prefix(spark, d):
    """Months and days of one digit or two."""
    t = _t(spark, d)
    text = F.replace(F.replace(_order_date_text(t), F.lit("-"), F.lit("/")), F.lit("/0"), F.lit("/"))
    return t.orders.select("o_orderkey", X.text_to_date(text).alias("d"))


def q_date_text(spark, d):
    t = _t(spark, d)
    day = X.text_to_date(_order_date_text(t), fmt="yyyy-MM-dd")
    return t.orders.select("o_orderkey", X.date_text(day).alias("d"))


def q_to_number(spark, d):
    p = _t(spark, d).part
    return p.select("p_partkey",
                    X.text_to_number(F.concat(F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("")), F.lit(".5")))
                     .cast("double").alias("n"),
                    X.text_to_number("p_type").cast("double").alias("bad"))


def q_phone(spark, d):
    s = _t(spark, d).supplier
    ph = X.phone_line(F.nullif(F.col("s_nationkey").cast("string"), F.lit("3")),
                      F.nullif(F.col("s_name"), F.lit("Supplier#000000005")),
                      F.lit(None).cast("string"))
    return s.select("s_suppkey", ph.alias("phone"))


def q_country_choice(spark, d):
    t = _t(spark, d)
    j = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"), "inner")
    return j.select("s_suppkey", X.country_choice("n_name", "n_regionkey", "n_nationkey",
                                                  GROUP_NATIONS).alias("price_list"))


def q_conditional_price(spark, d):
    p = _t(spark, d).part
    return p.select("p_partkey", X.conditional_price("p_retailprice", "p_size", 7).alias("price"))


def q_yes_flag(spark, d):
    o = _t(spark, d).orders
    return o.select("o_orderkey", X.yes_flag(F.nullif(F.col("o_orderstatus"), F.lit("P")), "F").alias("f"))


# --- K: streaming -------------------------------------------------------------------

def q_stream_upsert(spark, d):
    from orderlens.plans.streams import run_stream_upsert
    return run_stream_upsert(spark, d)


def q_stream_late_scans(spark, d):
    from orderlens.plans.streams import run_late_scans
    return run_late_scans(spark, d)


def q_status_function(spark, d):
    """U1 in SQL: the status look-up called as a function per row."""
    from orderlens.plans.views import register_status_function
    t = _t(spark, d)
    t.events.select("user_id", F.to_date("ts").alias("rev"), "event_type").createOrReplaceTempView("status_rows")
    t.customer.select("c_custkey").createOrReplaceTempView("status_customers")
    register_status_function(spark, "latest_status", "status_rows", "user_id", "rev", "event_type", "bigint")
    return spark.sql("select c_custkey, latest_status(c_custkey) as status from status_customers")


def q_stream_derive(spark, d):
    from orderlens.plans.streams import run_stream_derive
    return run_stream_derive(spark, d)


QUERIES = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
