"""ERP preset: the reference's own output shape from ERP-shaped inputs.

``erp_order_view`` reproduces the 52-column order view from order headers and
lines, the item view, transaction types, the contact, site-use, sales-rep,
scan and review views and item categories.  Inputs are DataFrames with the
column names of FIXTURES.md section 1 (lower case).  It runs the same builder
as the driver queries (:func:`orderlens.plans.order_view.order_view_rows`);
only the role mapping and the projection differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens import functions as X
from orderlens.plans.order_view import (
    EXCLUDED_LINE_TYPES, ORDER_NUMBER_BOUND, OrderViewConfig, location, order_status,
    order_view_rows,
)
from orderlens.plans.pricing import hospital_product, party_pricelist

# --- fixed values (must equal the reference's for the same results) ---------
PRODUCT_CATEGORY_SET = 1100000063
# -----------------------------------------------------------------------------

ORDER_VIEW_COLUMNS = (
    "ORDER_ID", "SURGEON_ID", "SURGEON_TITLE", "SURGEON_LAST_NAME", "SURGEON_FIRST_NAME",
    "PATIENT_FIRST_NAME", "PATIENT_LAST_NAME", "PATIENT_GENDER", "PATIENT_DOB", "CATALOG_NUMBER",
    "UNIT_SELLING_PRICE", "SERIAL_NUMBER", "LINE_ID", "PRODUCT_CATEGORY", "UDI_CATALOG",
    "PRODUCT_DESCRIPTION", "PATELLA_FLAG", "SCHED_SURGERY_DATE", "COMMITMENT_DATE",
    "SURGERY_LOCATION", "STATUS", "IMPLANT_REQUEST_DATE", "SCAN_RECEIVED_DATE", "SCAN_CP_FLAG",
    "SHIPPED_DATE", "REGION_CODE", "SALES_REP_NAME", "TERRITORY_CODE", "COUNTRY_CODE",
    "RESCHEDULED_SURGERY_DATE", "CURRENCY", "HOSPITAL_NAME", "SALESREP_NUMBER", "LINE_TYPE",
    "IRF_ID", "PRODUCT_DESC_ORDCNF", "ORDER_DETAILS_ORDCNF", "ORDER_DETAILS2",
    "ACTUAL_SURGERY_DATE", "SERIAL_NUMBER_ORI", "ORDER_LINE_ROWID", "HEADER_ID",
    "INVENTORY_ITEM_ID", "ORDERED_ITEM", "ITEM_NUMBER", "ORDCNF_FLAG", "ORDER_ORDCNF_FLAG",
    "LAST_UPDATE_DATE", "SOLD_TO_CONTACT_ID", "SHIP_TO_ORG_ID", "SALESREP_ID", "DATE_SUBMITTED",
)

_HEADER_ATTRS = ("attribute1", "attribute2", "attribute3", "attribute4", "attribute9",
                 "attribute10", "attribute11", "attribute17")


def erp_roles(t: dict[str, DataFrame], category_set_id: int = PRODUCT_CATEGORY_SET,
              with_categories: bool = True):
    """Map ERP inputs to the builder's roles (canonical names, no clashes)."""
    h = t["order_headers"]
    header = h.select(
        "header_id", "order_number", F.col("sold_to_contact_id").alias("contact_id"),
        "order_type_id", F.col("transactional_curr_code").alias("h_currency"),
        *[F.col(a).alias(f"h_{a}") for a in _HEADER_ATTRS])
    ln = t["order_lines"]
    types = t["transaction_types"].select(
        F.col("transaction_type_id").alias("__tt_id"), F.col("name").alias("line_type"))
    rowid = (F.col("line_rowid").cast("string") if "line_rowid" in ln.columns
             else F.lit(None).cast("string"))
    lines = ln.join(types, ln["line_type_id"] == types["__tt_id"], "left").select(
        "header_id", F.col("line_id").alias("line_no"), F.col("inventory_item_id").alias("item_id"),
        F.col("ship_to_org_id").alias("site_id"), "line_type",
        F.col("flow_status_code").alias("line_status"),
        F.col("flow_status_code").alias("status_code"),
        F.col("invoiced_quantity").alias("qty"), F.col("schedule_ship_date").alias("commit_date"),
        F.col("attribute1").alias("serial"), F.col("attribute4").alias("l_attribute4"),
        F.col("attribute7").alias("l_attribute7"), F.col("ship_from_org_id").alias("l_ship_from_org_id"),
        F.col("salesrep_id").alias("l_salesrep_id"), F.col("org_id").alias("l_org_id"),
        F.col("unit_selling_price").alias("l_unit_selling_price"),
        F.col("request_date").alias("l_request_date"), F.col("promise_date").alias("l_promise_date"),
        F.col("actual_shipment_date").alias("l_actual_shipment_date"),
        F.col("last_update_date").alias("l_last_update_date"),
        F.col("ordered_item").alias("l_ordered_item"), F.col("ship_to_org_id").alias("l_ship_to_org_id"),
        rowid.alias("l_rowid"))
    items = t["items"].select(
        F.col("inventory_item_id").alias("item_id"), F.col("ordcnf_flag").alias("flag"), "catalog",
        F.col("item_description").alias("description"), F.col("item_number").alias("i_item_number"),
        F.col("item_number").alias("category_key"))
    contacts = t["contacts"].select(
        F.col("cust_account_role_id").alias("contact_ref"),
        F.col("person_party_id").alias("contact_party_id"),
        F.col("person_pre_name_adjunct").alias("c_title"),
        F.col("person_last_name").alias("c_last_name"),
        F.col("person_first_name").alias("c_first_name"))
    sites = t["site_use_view"].select(
        F.col("site_use_id").alias("site_ref"), "ps_address1", "ps_address2", "ps_address3",
        "ps_address4", "ps_city", "ps_state", "ps_province", "ps_country",
        F.col("region").alias("s_region"), F.col("territory").alias("s_territory"),
        F.col("country").alias("s_country"), F.col("party_name").alias("s_party_name"))
    reviews = t["reviews"].select(
        F.col("serial_number").alias("review_key"), F.col("status").alias("review_status"),
        F.col("revision").alias("review_rank"), F.col("date_submitted").alias("review_submitted"))
    scans = t["scans"].select(
        F.col("user2").alias("scan_key"), F.col("received_date").alias("scan_date"),
        F.col("received_date").alias("scan_rank"), F.col("user5").alias("scan_cp_flag"))
    reps = t["salesreps"].select(
        F.col("salesrep_id").alias("__rep_id"), F.col("salesrep_org_id").alias("__rep_org"),
        F.col("salesrep_name").alias("r_name"), F.col("salesrep_number").alias("rep_number"))
    lookups = [(reps, [("l_salesrep_id", "__rep_id"), ("l_org_id", "__rep_org")], None)]  # D3
    if with_categories:
        cats = t["item_category_view"].select(
            F.col("inventory_item_id").alias("__cat_item"), F.col("organization_id").alias("__cat_org"),
            F.col("category_set_id").alias("__cat_set"), F.col("segment4").alias("category_a"),
            F.col("segment5").alias("category_b"))
        lookups.append((cats, [("item_id", "__cat_item"), ("l_ship_from_org_id", "__cat_org")],
                        F.col("__cat_set") == F.lit(category_set_id)))                      # D3+D4
    return dict(header=header, lines=lines, items=items, contacts=contacts, sites=sites,
                reviews=reviews, scans=scans), lookups


def erp_order_config(as_of, **kw) -> OrderViewConfig:
    base = dict(
        as_of=as_of, order_bound=ORDER_NUMBER_BOUND, excluded_line_types=EXCLUDED_LINE_TYPES,
        exclude_like="Patella%", exclude_like_col="category_b", category_mode="segments",
        review_on="serial", scan_on="serial", review_order=("review_rank",),
        scan_order=("scan_rank",), review_cols=("review_status", "review_submitted"),
        scan_cols=("scan_date", "scan_cp_flag"),
        address_parts=("ps_address1", "ps_address2", "ps_address3", "ps_address4", "ps_city"),
        state_col="ps_state", province_col="ps_province", country_col="ps_country")
    base.update(kw)
    return OrderViewConfig(**base)


def erp_order_view(t: dict[str, DataFrame], as_of, excluded_order_types: list[str], *,
                   category_set_id: int = PRODUCT_CATEGORY_SET, **cfg_overrides) -> DataFrame:
    """J1 in the reference's 52-column shape.

    ``excluded_order_types``: transaction-type names whose orders are never
    reported (the NOT EXISTS on the order type).
    """
    roles, lookups = erp_roles(t, category_set_id)
    cfg = erp_order_config(as_of, **cfg_overrides)
    excluded = (t["transaction_types"].where(F.col("name").isin(list(excluded_order_types)))
                .select(F.col("transaction_type_id").alias("__ot")))
    x = order_view_rows(**roles, cfg=cfg, excluded_groups=(excluded, "order_type_id", "__ot"),
                        lookups=lookups)
    cols = _common_columns(cfg)
    return x.select(*[cols[n].alias(n) for n in ORDER_VIEW_COLUMNS])


# --- J4: portal view (42 columns) ----------------------------------------------

PORTAL_LEADING = (
    "ORDER_ID", "IRF_ID", "STATUS", "SURGEON_ID", "SURGEON_TITLE", "SURGEON_LAST_NAME",
    "SURGEON_FIRST_NAME", "PATIENT_FIRST_NAME", "PATIENT_LAST_NAME", "PATIENT_DOB",
    "HOSPITAL_NAME", "SURGERY_LOCATION", "SALESREP_NUMBER", "SALES_REP_NAME", "CATALOG_NUMBER",
    "UNIT_SELLING_PRICE", "SERIAL_NUMBER", "PRODUCT_CATEGORY", "UDI_CATALOG",
    "PRODUCT_DESCRIPTION", "PRODUCT_DESC_ORDCNF", "ORDER_DETAILS_ORDCNF", "ORDER_DETAILS2",
)
PORTAL_TRAILING = (
    "IMPLANT_REQUEST_DATE", "SCHED_SURGERY_DATE", "SCAN_RECEIVED_DATE", "COMMITMENT_DATE",
    "SHIPPED_DATE", "ACTUAL_SURGERY_DATE", "RESCHEDULED_SURGERY_DATE", "LINE_ID", "LINE_TYPE",
    "CURRENCY", "PATIENT_GENDER", "SCAN_CP_FLAG", "REGION_CODE", "TERRITORY_CODE",
    "COUNTRY_CODE", "PATELLA_FLAG",
)


def erp_portal_view(order_table: DataFrame, doc_lists: dict[str, tuple[DataFrame, str, str]],
                    override_patterns: list[str]) -> DataFrame:
    """J4 on the stored 52-column order table.

    ``doc_lists``: flag name -> (document serial list, order-table column,
    list column), in output order (three lists in the reference: the first
    joined on the normalised serial, the others on the raw serial).  A list
    whose join column is ``serial_number_ori`` and is missing gets it derived
    the way its writer would (A13).  ``override_patterns``: LIKE patterns of
    the product categories whose description is the order detail text (B7).
    """
    from orderlens.operators.derive import with_serial_key
    from orderlens.plans.portal import portal_view

    flags = {}
    for name, (docs, row_col, list_col) in doc_lists.items():
        if list_col == "serial_number_ori" and list_col not in docs.columns:
            docs = with_serial_key(docs, "serial_number", list_col)
        flags[name] = (docs, row_col, list_col)
    lead = [F.col(c) for c in PORTAL_LEADING]
    lead[PORTAL_LEADING.index("SALESREP_NUMBER")] = X.nvl("SALESREP_NUMBER", "X").alias("SALESREP_NUMBER")
    lead[PORTAL_LEADING.index("PRODUCT_DESCRIPTION")] = X.override_description(
        "PRODUCT_CATEGORY", override_patterns, "ORDER_DETAILS_ORDCNF", "PRODUCT_DESCRIPTION"
    ).alias("PRODUCT_DESCRIPTION")
    trail = [F.col(c) for c in PORTAL_TRAILING]
    trail[PORTAL_TRAILING.index("ACTUAL_SURGERY_DATE")] = F.col("RESCHEDULED_SURGERY_DATE").alias(
        "ACTUAL_SURGERY_DATE")                                                        # B4
    # flags sit between the leading and trailing columns
    out = portal_view(order_table, lead + trail, flags, distinct=True)
    return out.select(*PORTAL_LEADING, *flags, *PORTAL_TRAILING)


# --- J7: surgeon-hospital directory (24 columns) -------------------------------

# fixed values (must equal the reference's for the same results)
PARTY_TABLE = "HZ_PARTIES"
DIRECTORY_COLUMNS = (
    "CUST_ACCOUNT_ROLE_ID", "SURGEON_ID", "FIRSTNAME", "MIDDLENAME", "LASTNAME", "PHONE", "EMAIL",
    "ADDRESS1", "ADDRESS2", "ADDRESS3", "CITY", "STATE", "POSTALCODE", "COUNTRY", "HOSPITAL",
    "HOSPITAL_ID", "ACTIVE", "PHYS_STATUS", "REL_START_DATE", "REL_END_DATE", "REL_STATUS",
    "ORG_CONTACT_STATUS", "ACCOUNT_SITE_STATUS", "PARTY_SITE_STATUS",
)


def erp_directory(t: dict[str, DataFrame]) -> DataFrame:
    """Contact roles -> relationship (LEFT, type in ON) -> org contact
    (INNER, job title compared case-insensitively: collapses the outer join,
    D15) -> person and organisation parties (one table, two roles, D14) ->
    account site -> party site -> location -> primary active phone and email
    contact points (D4).  Every join is on keys."""
    roles = t["account_roles"].select(
        "cust_account_role_id", F.col("party_id").alias("role_party_id"),
        F.col("cust_account_id").alias("role_account_id"),
        F.col("cust_acct_site_id").alias("role_site_id"),
        F.col("current_role_state").alias("phys_status"))
    rel = t["relationships"].where(F.col("relationship_code") == "CONTACT").select(
        F.col("party_id").alias("rel_party_id"), "relationship_id", "object_id", "subject_id",
        "object_table_name", "object_type", "subject_table_name", "subject_type",
        F.col("start_date").alias("rel_start"), F.col("end_date").alias("rel_end"),
        F.col("status").alias("rel_status"))
    org = t["org_contacts"].where(X.upper_eq("job_title", "PHYSICIAN")).select(
        F.col("party_relationship_id").alias("org_rel_id"), F.col("status").alias("org_status"))
    parties = t["parties"]
    phys = parties.select(F.col("party_id").alias("phys_id"), F.col("person_first_name").alias("p_first"),
                          F.col("person_middle_name").alias("p_middle"),
                          F.col("person_last_name").alias("p_last"))
    hosp = parties.select(F.col("party_id").alias("hosp_id"), F.col("party_name").alias("hosp_name"))
    sites = t["acct_sites"].select(F.col("cust_account_id").alias("as_account_id"),
                                   F.col("cust_acct_site_id").alias("as_site_id"),
                                   F.col("party_site_id").alias("as_party_site_id"),
                                   F.col("status").alias("as_status"))
    psites = t["party_sites"].select(F.col("party_site_id").alias("ps_id"),
                                     F.col("location_id").alias("ps_location_id"),
                                     F.col("status").alias("ps_status"))
    loc = t["locations"].select(F.col("location_id").alias("loc_id"), "address1", "address2",
                                "address3", "city", "state", "postal_code", "country")
    cp = t["contact_points"].where(
        (F.col("owner_table_name") == PARTY_TABLE) & (F.col("status") == "A")
        & (F.col("primary_flag") == "Y"))
    phone = cp.where(F.col("contact_point_type") == "PHONE").select(
        F.col("owner_table_id").alias("ph_owner"), "phone_area_code", "phone_number", "phone_extension")
    email = cp.where(F.col("contact_point_type") == "EMAIL").select(
        F.col("owner_table_id").alias("em_owner"), "email_address")

    x = roles.join(rel, F.col("role_party_id") == F.col("rel_party_id"), "left")
    x = x.join(org, F.col("org_rel_id") == F.col("relationship_id"), "inner")
    x = x.join(phys, (F.col("phys_id") == F.col("object_id"))
               & (F.col("object_table_name") == PARTY_TABLE) & (F.col("object_type") == "PERSON"), "left")
    x = x.join(hosp, (F.col("hosp_id") == F.col("subject_id"))
               & (F.col("subject_table_name") == PARTY_TABLE)
               & (F.col("subject_type") == "ORGANIZATION"), "left")
    x = x.join(sites, (F.col("role_account_id") == F.col("as_account_id"))
               & (F.col("role_site_id") == F.col("as_site_id")), "left")
    x = x.join(psites, F.col("ps_id") == F.col("as_party_site_id"), "left")
    x = x.join(loc, F.col("loc_id") == F.col("ps_location_id"), "left")
    x = x.join(phone, F.col("ph_owner") == F.col("rel_party_id"), "left")
    x = x.join(email, F.col("em_owner") == F.col("rel_party_id"), "left")
    cols = {
        "CUST_ACCOUNT_ROLE_ID": F.col("cust_account_role_id"),
        "SURGEON_ID": F.col("phys_id"),
        "FIRSTNAME": F.col("p_first"), "MIDDLENAME": F.col("p_middle"), "LASTNAME": F.col("p_last"),
        "PHONE": X.phone_line("phone_area_code", "phone_number", "phone_extension"),
        "EMAIL": F.col("email_address"),
        "ADDRESS1": F.col("address1"), "ADDRESS2": F.col("address2"), "ADDRESS3": F.col("address3"),
        "CITY": F.col("city"), "STATE": F.col("state"), "POSTALCODE": F.col("postal_code"),
        "COUNTRY": F.col("country"), "HOSPITAL": F.col("hosp_name"), "HOSPITAL_ID": F.col("hosp_id"),
        "ACTIVE": F.col("rel_status"), "PHYS_STATUS": F.col("phys_status"),
        "REL_START_DATE": F.col("rel_start"), "REL_END_DATE": F.col("rel_end"),
        "REL_STATUS": F.col("rel_status"), "ORG_CONTACT_STATUS": F.col("org_status"),
        "ACCOUNT_SITE_STATUS": F.col("as_status"), "PARTY_SITE_STATUS": F.col("ps_status"),
    }
    assert tuple(cols) == DIRECTORY_COLUMNS
    return x.select(*[c.alias(n) for n, c in cols.items()])


# --- J2 / J3: the two older generations of the order view ----------------------

# fixed values (must equal the reference's for the same results)
LOOKUP_APPLICATION_ID = 401
LOOKUP_SECURITY_GROUP = 0
PATELLA_MEANING = "PATELLA%"

MV_COLUMNS = ORDER_VIEW_COLUMNS[:47]
DRAFT_COLUMNS = (
    "ORDER_ID", "IRF_ID", "STATUS", "SURGEON_ID", "SURGEON_TITLE", "SURGEON_LAST_NAME",
    "SURGEON_FIRST_NAME", "PATIENT_FIRST_NAME", "PATIENT_LAST_NAME", "PATIENT_DOB",
    "HOSPITAL_NAME", "SURGERY_LOCATION", "SALESREP_NUMBER", "SALES_REP_NAME", "CATALOG_NUMBER",
    "UNIT_SELLING_PRICE", "SERIAL_NUMBER", "PRODUCT_CATEGORY", "UDI_CATALOG",
    "PRODUCT_DESCRIPTION", "PRODUCT_DESC_ORDCNF", "ORDER_DETAILS_ORDCNF", "ORDER_DETAILS2",
    "IVIEW_EXISTS", "DOF_EXISTS", "IMPLANT_REQUEST_DATE", "SCHED_SURGERY_DATE",
    "SCAN_RECEIVED_DATE", "COMMITMENT_DATE", "SHIPPED_DATE", "ACTUAL_SURGERY_DATE",
    "RESCHEDULED_SURGERY_DATE", "LINE_ID", "LINE_TYPE", "CURRENCY", "PATIENT_GENDER",
    "SCAN_CP_FLAG", "REGION_CODE", "TERRITORY_CODE", "COUNTRY_CODE", "PATELLA_FLAG",
    "ORDER_LINE_ROWID", "HEADER_ID", "INVENTORY_ITEM_ID", "ORDERED_ITEM", "ITEM_NUMBER",
    "ORDCNF_FLAG", "ORDER_ORDCNF_FLAG",
)


def category_lookup(lookup_values: DataFrame, lookup_type: str, lang: str) -> DataFrame:
    """The category lookup restricted by its constant ON conditions,
    the session language being a parameter."""
    return lookup_values.where(
        (F.col("language") == lang) & (F.col("lookup_type") == lookup_type)
        & (F.col("view_application_id") == LOOKUP_APPLICATION_ID)
        & (F.col("security_group_id") == LOOKUP_SECURITY_GROUP)
    ).select(F.col("lookup_code").alias("code"), "meaning")


def erp_order_view_mv(t: dict[str, DataFrame], as_of, *, lookup_type: str, lang: str = "US"
                      ) -> DataFrame:
    """J2 (materialised-view generation), 47 columns: category from the
    item-number prefix lookup (D7), PATELLA_FLAG from its meaning (B8), the
    order-detail attributes shown only for flagged orders (B6)."""
    from orderlens.plans.order_view import EXCLUDED_LINE_TYPES_V1

    roles, lookups = erp_roles(t, with_categories=False)
    cfg = erp_order_config(as_of, category_mode="lookup", category_key_len=5,
                           excluded_line_types=EXCLUDED_LINE_TYPES_V1,
                           exclude_like=PATELLA_MEANING, exclude_like_col="category")
    x = order_view_rows(**roles, cfg=cfg, lookups=lookups,
                        category_lookup=category_lookup(t["lookup_values"], lookup_type, lang))
    cols = _common_columns(cfg)
    cols["PATELLA_FLAG"] = X.pattern_flag("category_meaning", PATELLA_MEANING)
    for name, attr in (("PRODUCT_DESC_ORDCNF", "h_attribute10"),
                       ("ORDER_DETAILS_ORDCNF", "h_attribute11"), ("ORDER_DETAILS2", "h_attribute17")):
        cols[name] = X.gate(attr, "order_flag")
    return x.select(*[cols[n].alias(n) for n in MV_COLUMNS])


def erp_order_view_draft(t: dict[str, DataFrame], as_of, *, lookup_type: str,
                         description_pattern: str, doc_lists: dict[str, DataFrame],
                         lang: str = "US", shipped_days: float = 30) -> DataFrame:
    """J3 (draft generation), 48 columns: surgeon optional, document flags
    joined on the raw serial inline (``doc_lists``: IVIEW_EXISTS/DOF_EXISTS ->
    serial list), description replaced by the order detail text for one
    category pattern (B7), shipped lines aged out on the actual shipment date
    (C9), birth date as a date."""
    from orderlens.plans.order_view import EXCLUDED_LINE_TYPES_V1

    roles, lookups = erp_roles(t, with_categories=False)
    cfg = erp_order_config(as_of, category_mode="lookup", category_key_len=5,
                           excluded_line_types=EXCLUDED_LINE_TYPES_V1,
                           exclude_like=PATELLA_MEANING, exclude_like_col="category",
                           require_contact=False, shipped_days=shipped_days,
                           shipped_date_col="l_actual_shipment_date")
    flags = {name: (docs, "serial", "serial_number") for name, docs in doc_lists.items()}
    x = order_view_rows(**roles, cfg=cfg, lookups=lookups, doc_flags=flags,
                        category_lookup=category_lookup(t["lookup_values"], lookup_type, lang))
    cols = _common_columns(cfg)
    cols["PATELLA_FLAG"] = X.pattern_flag("category_meaning", PATELLA_MEANING)
    cols["PATIENT_DOB"] = X.text_to_date("h_attribute4")
    cols["ACTUAL_SURGERY_DATE"] = X.text_to_date("l_attribute4")
    cols["PRODUCT_DESCRIPTION"] = X.override_description(
        "category_meaning", [description_pattern], "h_attribute11", "description")
    for name in doc_lists:
        cols[name] = F.col(name)
    return x.select(*[cols[n].alias(n) for n in DRAFT_COLUMNS])


def _common_columns(cfg: OrderViewConfig) -> dict:
    catalog = X.strip_chars("catalog", cfg.catalog_strip)
    return {
        "ORDER_ID": F.col("order_number"), "SURGEON_ID": F.col("contact_party_id"),
        "SURGEON_TITLE": F.col("c_title"), "SURGEON_LAST_NAME": F.col("c_last_name"),
        "SURGEON_FIRST_NAME": F.col("c_first_name"), "PATIENT_FIRST_NAME": F.col("h_attribute2"),
        "PATIENT_LAST_NAME": F.col("h_attribute1"), "PATIENT_GENDER": F.col("h_attribute3"),
        "PATIENT_DOB": X.date_text(X.text_to_date("h_attribute4")), "CATALOG_NUMBER": catalog,
        "UNIT_SELLING_PRICE": F.col("l_unit_selling_price"), "SERIAL_NUMBER": F.col("serial"),
        "LINE_ID": F.col("line_no"), "PRODUCT_CATEGORY": F.col("category"),
        "UDI_CATALOG": catalog, "PRODUCT_DESCRIPTION": F.col("description"),
        "SCHED_SURGERY_DATE": F.col("l_promise_date"), "COMMITMENT_DATE": F.col("commit_date"),
        "SURGERY_LOCATION": location(cfg), "STATUS": order_status(cfg),
        "IMPLANT_REQUEST_DATE": F.col("l_request_date"), "SCAN_RECEIVED_DATE": F.col("scan_date"),
        "SCAN_CP_FLAG": F.col("scan_cp_flag"), "SHIPPED_DATE": F.col("l_actual_shipment_date"),
        "REGION_CODE": F.col("s_region"), "SALES_REP_NAME": F.col("r_name"),
        "TERRITORY_CODE": F.col("s_territory"), "COUNTRY_CODE": F.col("s_country"),
        "RESCHEDULED_SURGERY_DATE": X.text_to_date("l_attribute4"), "CURRENCY": F.col("h_currency"),
        "HOSPITAL_NAME": F.col("s_party_name"), "SALESREP_NUMBER": X.nvl("rep_number", "X"),
        "LINE_TYPE": F.col("line_type"), "IRF_ID": X.text_to_number("h_attribute9"),
        "PRODUCT_DESC_ORDCNF": F.col("h_attribute10"), "ORDER_DETAILS_ORDCNF": F.col("h_attribute11"),
        "ORDER_DETAILS2": F.col("h_attribute17"), "ACTUAL_SURGERY_DATE": X.text_to_date("l_attribute7"),
        "SERIAL_NUMBER_ORI": X.serial_prefix("serial"), "ORDER_LINE_ROWID": F.col("l_rowid"),
        "HEADER_ID": F.col("header_id"), "INVENTORY_ITEM_ID": F.col("item_id"),
        "ORDERED_ITEM": F.col("l_ordered_item"), "ITEM_NUMBER": F.col("i_item_number"),
        "ORDCNF_FLAG": F.col("flag"), "ORDER_ORDCNF_FLAG": F.col("order_flag"),
        "LAST_UPDATE_DATE": F.col("l_last_update_date"), "SOLD_TO_CONTACT_ID": F.col("contact_id"),
        "SHIP_TO_ORG_ID": F.col("l_ship_to_org_id"), "SALESREP_ID": F.col("l_salesrep_id"),
        "DATE_SUBMITTED": F.col("review_submitted"), "PATELLA_FLAG": F.lit("False"),
    }


# --- J6a-J6d: price-list items, hospital price lists, matrix --------------------

# fixed values (must equal the reference's for the same results)
ITEM_ORG_ID = 84
MATRIX_CATEGORY_SET = 1100000202
IDENTITY_ITEM_ID = 447191
ATTR_ITEM = "PRICING_ATTRIBUTE1"
ATTR_CATEGORY = "PRICING_ATTRIBUTE2"
ATTR_ALL = "PRICING_ATTRIBUTE3"


def erp_pricelist_item(t: dict[str, DataFrame], as_of, *, org_id: int = ITEM_ORG_ID,
                       identity_item_id: int = IDENTITY_ITEM_ID) -> DataFrame:
    """Price-list lines valid at ``as_of`` (line AND header dates, C10)
    with their item: by item id, via the item category (one category line
    stands for each of its items), or none for the all-items kind (D6, C12);
    the identity price only for one item with a positive operand (I21)."""
    from orderlens.functions.dates import valid_at

    qll = t["list_lines"].where(valid_at("start_date_active", "end_date_active", as_of)).select(
        "list_line_id", "list_header_id", "operand")
    qlh = t["list_headers"].where(valid_at("start_date_active", "end_date_active", as_of)).select(
        F.col("list_header_id").alias("__h"))
    qpa = t["pricing_attributes"].select(F.col("list_line_id").alias("__l"), "product_attribute",
                                         "product_attr_value")
    x = qll.join(qlh, F.col("list_header_id") == F.col("__h")).join(qpa, F.col("list_line_id") == F.col("__l"))
    mic = t["item_categories"].where(F.col("organization_id") == org_id).select(
        F.col("category_id").alias("__cat"), F.col("inventory_item_id").alias("__cat_item"))
    attr = F.col("product_attribute")
    value = X.text_to_number("product_attr_value")
    x = x.join(mic, F.when(attr == ATTR_CATEGORY, value) == F.col("__cat"), "left")
    msib = t["system_items"].where(F.col("organization_id") == org_id).select(
        F.col("inventory_item_id").alias("__item"), F.col("segment1").alias("__item_seg"))
    item_key = F.when(attr == ATTR_ITEM, value).when(attr == ATTR_CATEGORY, F.col("__cat_item"))
    x = x.join(msib, item_key == F.col("__item"), "left")
    x = x.where((attr == ATTR_ALL) | F.col("__item_seg").isNotNull())
    return x.select(
        F.col("list_header_id").alias("PRICE_LIST_ID"), F.col("product_attribute").alias("PRODUCT_ATTRIBUTE"),
        X.conditional_price("operand", "__item", identity_item_id).alias("PATIENTPAYIDENTITYPRICE"),
        F.col("__item").alias("INVENTORY_ITEM_ID"))


def erp_party_pricelist(t: dict[str, DataFrame], as_of, *, group_countries=None,
                        stage=lambda df: df) -> DataFrame:
    """Distinct (group, hospital, patient-pay flag, price list, country).

    Hospital grouping: active parties, their account's patient-pay flag
    (I22), the active participating relationship still open at ``as_of``
    (D4, C11) to an active group party (D14: parties twice).  The reference
    also outer-joins the group's account without using any of its columns;
    before the DISTINCT that join can only repeat rows, so it is left out.
    Price list: group precedence (active, valid at ``as_of``) matched by group
    OR hospital (D8) for the group-price countries (I20), else the site list.
    """
    from orderlens.functions.dates import as_ts, valid_at
    from orderlens.functions.labels import GROUP_PRICE_COUNTRIES

    hp = t["parties"].where(F.col("status") == "A").select(
        F.col("party_id").alias("hospital_id"), F.col("party_name").alias("hospital"))
    hca = t["cust_accounts"].select(F.col("party_id").alias("__acct_party"), "attribute7")
    hr = t["relationships"].where(
        (F.col("relationship_code") == "PARTICIPATING") & (F.col("end_date") >= as_ts(as_of))
        & (F.col("status") == "A")).select(F.col("subject_id").alias("__subj"),
                                          F.col("object_id").alias("__obj"))
    grp = t["parties"].where(F.col("status") == "A").select(F.col("party_id").alias("group_id"))
    pg = (hp.join(hca, F.col("hospital_id") == F.col("__acct_party"), "left")
            .join(hr, F.col("__subj") == F.col("hospital_id"), "left")
            .join(grp, F.col("group_id") == F.col("__obj"), "left")
            .select("group_id", "hospital_id", "hospital", X.yes_flag("attribute7").alias("req")))
    ps = t["party_sites"].where(F.col("status") == "A").select(
        F.col("party_id").alias("__ps_party"), F.col("party_site_id").alias("__ps"),
        F.col("location_id").alias("__loc"))
    loc = t["locations"].select(F.col("location_id").alias("__loc_id"), F.col("country"))
    cas = t["acct_sites"].where(F.col("status") == "A").select(
        F.col("party_site_id").alias("__cas_ps"), F.col("cust_acct_site_id").alias("__cas"))
    su = t["site_uses"].where(F.col("status") == "A").select(
        F.col("cust_acct_site_id").alias("__su_cas"), F.col("price_list_id").alias("site_price_list"))
    hospitals = (pg.join(ps, F.col("__ps_party") == F.col("hospital_id"))
                   .join(loc, F.col("__loc") == F.col("__loc_id"))
                   .join(cas, F.col("__cas_ps") == F.col("__ps"))
                   .join(su, F.col("__su_cas") == F.col("__cas"))
                   .select("group_id", "hospital_id", "hospital", "req", "country", "site_price_list"))
    prec = t["group_precedence"].where(
        (F.col("active") == "YES") & valid_at("start_date", "end_date", as_of)).select(
        F.col("grp_party_id").alias("grp_key"), F.col("cust_party_id").alias("party_key"),
        "grp_price_list_id")
    out = party_pricelist(hospitals, prec, group_countries or GROUP_PRICE_COUNTRIES,
                          extra_cols=("group_id",), stage=stage)
    return out.select(F.col("group_id").alias("GROUP_PARTY_ID"), F.col("hospital_id").alias("HOSPITAL_ID"),
                      F.col("hospital").alias("HOSPITAL"), F.col("req").alias("PATIENTPAYREQUIRED"),
                      F.col("price_list_id").alias("PRICE_LIST_ID"), F.col("country").alias("COUNTRY"))


def erp_hospital_product(t: dict[str, DataFrame], as_of, *, org_id: int = ITEM_ORG_ID,
                         category_set_id: int = MATRIX_CATEGORY_SET, group_countries=None,
                         stage=lambda df: df) -> DataFrame:
    """J6c/J6d: the hospital x product-category matrix: HOSPITAL_ID, HOSPITAL,
    PATIENTPAYREQUIRED, PATIENTPAYIDENTITYPRICE and one 0/1 column per
    category of the category set (data-dependent list, E5)."""
    from orderlens.operators.pivot import pivot_values

    pi = erp_pricelist_item(t, as_of, org_id=org_id).select(
        F.col("PRICE_LIST_ID").alias("price_list_id"), F.col("PRODUCT_ATTRIBUTE").alias("attr"),
        F.col("INVENTORY_ITEM_ID").alias("item"), F.col("PATIENTPAYIDENTITYPRICE").alias("price"))
    pp = erp_party_pricelist(t, as_of, group_countries=group_countries, stage=stage).select(
        F.col("HOSPITAL_ID").alias("hospital_id"), F.col("HOSPITAL").alias("hospital"),
        F.col("PATIENTPAYREQUIRED").alias("req"), F.col("PRICE_LIST_ID").alias("price_list_id"))
    cats_b = t["categories"].select(F.col("category_id").alias("__cid"), F.col("segment1").alias("cat"))
    set_items = (t["item_categories"].where((F.col("category_set_id") == category_set_id)
                                            & (F.col("organization_id") == org_id))
                 .join(cats_b, F.col("category_id") == F.col("__cid"))
                 .select(F.col("inventory_item_id").alias("item_id"), "cat"))
    values = pivot_values(set_items, "cat")
    m = hospital_product(pp, pi, set_items, cats_b.select("cat"), values,
                         item_attrs=(ATTR_ITEM, ATTR_CATEGORY), all_attr=ATTR_ALL)
    return m.select(F.col("hospital_id").alias("HOSPITAL_ID"), F.col("hospital").alias("HOSPITAL"),
                    F.col("req").alias("PATIENTPAYREQUIRED"), F.col("price").alias("PATIENTPAYIDENTITYPRICE"),
                    *[F.col(v.upper()) for v in values])


# --- J8: incremental refresh of the 52-column order table ------------------------

# fixed values (must equal the reference's for the same results)
REFRESH_KEY = "LINE_ID"
REFRESH_SENTINEL = "2000-01-01"


def erp_change_window(as_of):
    """Updated in the last hour, OR scan received in 14 days, OR
    submitted in 7 days (strictly after ``as_of`` minus the lookback)."""
    import datetime as _dt

    from orderlens.operators.merge import recent
    return [recent("LAST_UPDATE_DATE", as_of, _dt.timedelta(hours=1)),
            recent("SCAN_RECEIVED_DATE", as_of, _dt.timedelta(days=14)),
            recent("DATE_SUBMITTED", as_of, _dt.timedelta(days=7))]


def erp_change_guard(s, t):
    """A10: newer LAST_UPDATE_DATE, or scan/submit date differs with NULL
    read as the 2000-01-01 sentinel."""
    from orderlens.functions.dates import as_ts, change_guard
    return change_guard(s("LAST_UPDATE_DATE"), t("LAST_UPDATE_DATE"),
                        [(s("SCAN_RECEIVED_DATE"), t("SCAN_RECEIVED_DATE")),
                         (s("DATE_SUBMITTED"), t("DATE_SUBMITTED"))],
                        sentinel=as_ts(REFRESH_SENTINEL))


def erp_incremental_refresh(target: DataFrame, view: DataFrame, as_of) -> DataFrame:
    """Delete order lines that left the view (against the whole view,
    NOT IN semantics), then merge the change window: guarded update of the 51
    non-key columns, insert of new lines.  Both frames have the 52 columns."""
    from orderlens.operators.merge import incremental_refresh
    return incremental_refresh(target, view, REFRESH_KEY, erp_change_window(as_of),
                               erp_change_guard)


# --- J5: legacy two-branch load ---------------------------------------------------

# fixed values (must equal the reference's for the same results)
INVENTORY_SET = "Inventory"
WIP_CLASS = "WIP CLASSIFICATION"
LEGACY_GENERAL_COLUMNS = (
    "ORDER_ID", "SURGEON_ID", "SURGEON_TITLE", "SURGEON_LAST_NAME", "SURGEON_FIRST_NAME",
    "PATIENT_FIRST_NAME", "PATIENT_LAST_NAME", "PATIENT_GENDER", "PATIENT_DOB", "CATALOG_NUMBER",
    "UNIT_SELLING_PRICE", "SERIAL_NUMBER", "LINE_ID", "PRODUCT_CATEGORY", "UDI_CATALOG",
    "PRODUCT_DESCRIPTION", "PATELLA_FLAG", "SCHED_SURGERY_DATE", "COMMITMENT_DATE",
    "SURGERY_LOCATION", "STATUS", "IMPLANT_REQUEST_DATE", "SCAN_RECEIVED_DATE", "SCAN_CP_FLAG",
    "SHIPPED_DATE", "REGION_CODE", "SALES_REP_NAME", "TERRITORY_CODE", "COUNTRY_CODE",
    "RESCHEDULED_SURGERY_DATE", "CURRENCY", "HOSPITAL_NAME", "SALESREP_NUMBER", "LINE_TYPE",
    "IRF_ID", "ACTUAL_SURGERY_DATE",
)
LEGACY_SPECIAL_EXTRA = {"PRODUCT_DESC_ORDCNF": "PRODUCT_DESC_ORDCNF",
                        "ORDER_DETAILS_ORDCNF": "ORDER_DETAILS_ORDCNF",
                        "ORDER_DETAILS2": "ORDER_DETAILS_2_ORDCNF"}


def class_item_headers(t: dict[str, DataFrame], *, class_segment2: str, include_set: str,
                       excluded_statuses=("RETURN", "CANCELLED")) -> DataFrame:
    """Headers with a live line whose item is in the WIP class
    ``class_segment2`` of the inventory set AND flagged 'Yes' in the set
    ``include_set`` (the reference's 8-table NOT EXISTS).  The item side is
    reduced to distinct qualifying items first, so the line table meets a
    small key set once (semi join), then to distinct headers."""
    mst = t["system_items"].select("inventory_item_id", "organization_id")
    mic = t["item_categories"].select("inventory_item_id", "organization_id", "category_set_id",
                                      "category_id")
    sets = t["category_sets"].select("category_set_id", "category_set_name")
    cats = t["categories"].select("category_id", "segment1", "segment2")
    member = mic.join(sets, "category_set_id").join(cats, "category_id")
    wip = member.where((F.col("category_set_name") == INVENTORY_SET) & (F.col("segment1") == WIP_CLASS)
                       & (F.col("segment2") == class_segment2)).select("inventory_item_id", "organization_id")
    inc = member.where((F.col("category_set_name") == include_set) & (F.col("segment1") == "Yes")
                       ).select("inventory_item_id", "organization_id")
    items = (mst.join(wip, ["inventory_item_id", "organization_id"], "left_semi")
                .join(inc, ["inventory_item_id", "organization_id"], "left_semi")
                .select("inventory_item_id").distinct())
    lines = t["order_lines"].where(~F.col("flow_status_code").isin(list(excluded_statuses)))
    return (lines.join(items, "inventory_item_id", "left_semi")
                 .select("header_id").distinct())


def erp_legacy_load(t: dict[str, DataFrame], *, class_segment2: str, include_set: str) -> DataFrame:
    """General orders from the old order view (older line-type list,
    C3; orders with a class item excluded, D11) and all special (G3) orders,
    each inserted with its own column list (the special branch also fills the
    three order-detail columns); pending statuses relabelled from the strict
    latest revision of the serial (E6, U1: one aggregate joined once)."""
    from orderlens.functions.labels import PENDING_DESIGN, REVIEW_LABELS
    from orderlens.operators.joins import exclude_keys
    from orderlens.operators.latest import strict_latest
    from orderlens.operators.merge import append_by_name
    from orderlens.plans.legacy import branch_load
    from orderlens.plans.order_view import EXCLUDED_LINE_TYPES_V1

    rev = strict_latest(t["hip_revision"], "serial_number", "revision", "status", name="__rev_st"
                        ).withColumnRenamed("serial_number", "__rev_serial")

    headers = class_item_headers(t, class_segment2=class_segment2, include_set=include_set)
    old = t["old_order_view"]
    general = exclude_keys(old.where(~F.col("LINE_TYPE").isin(list(EXCLUDED_LINE_TYPES_V1))),
                           headers, "HEADER_ID", "header_id")
    special = t["special_order_view"].select(*LEGACY_GENERAL_COLUMNS, *LEGACY_SPECIAL_EXTRA.values())
    rows = append_by_name(general.select(*LEGACY_GENERAL_COLUMNS, F.lit(False).alias("__branch")),
                          special.withColumn("__branch", F.lit(True)))
    status = X.status_label("STATUS", F.lit(None), "__rev_st", closed=None, pending=PENDING_DESIGN,
                            review_labels=REVIEW_LABELS).alias("STATUS")
    common = [status if c == "STATUS" else F.col(c) for c in LEGACY_GENERAL_COLUMNS]
    extra = [F.col(src).alias(dst) for dst, src in LEGACY_SPECIAL_EXTRA.items()]
    return branch_load(rows, F.col("__branch"), rev, review_on="SERIAL_NUMBER", review_key="__rev_serial",
                       general_cols=common, special_cols=common + extra)


# --- J9: old-vs-new reconciliation ------------------------------------------------

def erp_reconcile(old: DataFrame, new: DataFrame, key: str = REFRESH_KEY) -> DataFrame:
    """One row - total lines, lines only in the new / only in the old
    table, and for every other column both tables share the number of common
    lines whose values differ (NULL-safe), as ``<COLUMN>_diff``.  ``key`` is unique."""
    from orderlens.operators.checks import reconcile_tree
    shared = [c for c in old.columns if c in set(new.columns) and c != key]
    return reconcile_tree(old, new, key, shared)
