"""The ERP preset (52-column order view) on hand-made ERP-shaped tables."""

import datetime as dt

import pytest

from orderlens.plans.erp import ORDER_VIEW_COLUMNS, erp_order_view

AS_OF = dt.datetime(2020, 3, 31)
D = lambda s: dt.datetime.fromisoformat(s)


@pytest.fixture(scope="module")
def erp_tables(spark):
    def df(rows, schema):
        return spark.createDataFrame(rows, schema)
    headers = df([
        (1, 100, 1, 10, "USD", "Doe", "Jane", "F", "1970/01/15 00:00:00", "42", "d10", "d11", "d17"),
        (2, 800000, 1, 10, "USD", None, None, None, None, None, None, None, None),   # above bound
        (3, 300, 9, 10, "USD", None, None, None, None, None, None, None, None),      # excluded type
        (4, 400, 1, 11, "USD", None, None, None, None, "x", None, None, None),       # no surgeon
        (5, 500, 1, 10, "EUR", None, None, None, "bad", None, None, None, None),     # G3 order
    ], "header_id long, order_number long, order_type_id long, sold_to_contact_id long, "
       "transactional_curr_code string, attribute1 string, attribute2 string, attribute3 string, "
       "attribute4 string, attribute9 string, attribute10 string, attribute11 string, attribute17 string")
    line_schema = ("header_id long, line_id long, line_type_id long, inventory_item_id long, "
                   "ship_to_org_id long, ship_from_org_id long, salesrep_id long, org_id long, "
                   "flow_status_code string, ordered_item string, attribute1 string, attribute4 string, "
                   "attribute7 string, invoiced_quantity double, unit_selling_price double, "
                   "request_date timestamp_ntz, promise_date timestamp_ntz, schedule_ship_date timestamp_ntz, "
                   "actual_shipment_date timestamp_ntz, last_update_date timestamp_ntz")

    def line(h, lid, typ, item, status, qty, serial=None, ship="2020-03-20"):
        return (h, lid, typ, item, 7, 70, 5, 50, status, f"ITEM{item}", serial, "2020/04/01", None,
                qty, 9.5, D("2020-01-01"), D("2020-02-01"), D(ship), None, D("2020-03-01"))
    lines = df([
        line(1, 11, 1, 1, "CLOSED", 1.0),                        # kept: closed, not returned
        line(1, 12, 2, 1, "BOOKED", 1.0),                        # excluded line type
        line(1, 13, 1, 1, "CLOSED", -1.0),                       # returned within 30 days -> RETURN
        line(1, 14, 1, 1, "CLOSED", 0.0, ship="2020-01-01"),     # returned long ago -> dropped
        line(1, 15, 1, 1, "PENDING_DESIGN_APPROVAL", 1.0, serial="A123"),
        line(1, 16, 1, 3, "BOOKED", 1.0),                        # patella category -> dropped
        line(2, 21, 1, 1, "BOOKED", 1.0),
        line(3, 31, 1, 1, "BOOKED", 1.0),
        line(4, 41, 1, 1, "BOOKED", 1.0),
        line(5, 51, 1, 2, "BOOKED", 1.0),                        # flagged item of a G3 order: kept
        line(5, 52, 1, 1, "BOOKED", 1.0),                        # unflagged line of a G3 order: dropped
    ], line_schema)
    items = df([(1, "CAT-1", "N1", "Knee", 0), (2, "CAT-2", "N2", "Hip", 1), (3, "CAT-3", "N3", "Pat", 0)],
               "inventory_item_id long, catalog string, item_number string, item_description string, ordcnf_flag int")
    types = df([(1, "Standard"), (2, "HIP Procedure"), (9, "OEM-X")], "transaction_type_id long, name string")
    contacts = df([(10, 1000, "Dr", "Who", "John"), (11, None, None, None, None)],
                  "cust_account_role_id long, person_party_id long, person_pre_name_adjunct string, "
                  "person_last_name string, person_first_name string")
    sites = df([(7, "1 Main", None, None, None, "Town", None, "ON", "CA", "R1", "T1", "CA", "General")],
               "site_use_id long, ps_address1 string, ps_address2 string, ps_address3 string, "
               "ps_address4 string, ps_city string, ps_state string, ps_province string, ps_country string, "
               "region string, territory string, country string, party_name string")
    reps = df([(5, 50, "Rep Five", None)], "salesrep_id long, salesrep_org_id long, salesrep_name string, salesrep_number string")
    scans = df([("A123", "Y", D("2020-03-01")), ("A123", "N", D("2020-03-05"))],
               "user2 string, user5 string, received_date timestamp_ntz")
    reviews = df([("A123", "approved", 1, D("2020-03-02")), ("A123", "declined", 2, D("2020-03-04"))],
                 "serial_number string, status string, revision int, date_submitted timestamp_ntz")
    cats = df([(1, 70, 1100000063, "NONE", "NONE"), (2, 70, 1100000063, "Partial", "Hips"),
               (3, 70, 1100000063, "Knee", "Patella L"), (1, 70, 99, "X", "Y")],
              "inventory_item_id long, organization_id long, category_set_id long, segment4 string, segment5 string")
    lookup = df([("US", "PRODCAT", 401, 0, "N2", "Hip System"), ("US", "PRODCAT", 401, 0, "N3", "PATELLA kit"),
                  ("DE", "PRODCAT", 401, 0, "N1", "Knie")],
                 "language string, lookup_type string, view_application_id int, security_group_id int, "
                 "lookup_code string, meaning string")
    return {"order_headers": headers, "order_lines": lines, "items": items,
            "transaction_types": types, "contacts": contacts, "site_use_view": sites, "salesreps": reps,
            "scans": scans, "reviews": reviews, "item_category_view": cats, "lookup_values": lookup}


@pytest.fixture(scope="module")
def erp(erp_tables):
    return erp_order_view(erp_tables, AS_OF, ["OEM-X"])


def test_shape(erp):
    assert tuple(erp.columns) == ORDER_VIEW_COLUMNS and len(erp.columns) == 52


def test_rows_kept(erp):
    got = sorted(r.LINE_ID for r in erp.collect())
    assert got == [11, 13, 15, 51]


def test_values(erp):
    r = {row.LINE_ID: row for row in erp.collect()}
    assert r[11].STATUS == "CLOSED" and r[13].STATUS == "RETURN"
    assert r[15].STATUS == "Re-Design"                       # latest revision 2 = declined
    assert r[15].SERIAL_NUMBER_ORI == "0123"
    assert r[15].SCAN_RECEIVED_DATE == D("2020-03-05") and r[15].SCAN_CP_FLAG == "N"
    assert r[15].DATE_SUBMITTED == D("2020-03-04")
    assert r[11].SCAN_RECEIVED_DATE is None
    assert r[11].PATIENT_DOB == "15-JAN-1970" and r[11].IRF_ID == 42
    assert r[11].CATALOG_NUMBER == "CAT1" and r[11].PRODUCT_CATEGORY == "NONE"
    assert r[51].PRODUCT_CATEGORY == "Hips" and r[51].ORDCNF_FLAG == 1 and r[51].ORDER_ORDCNF_FLAG == 1
    assert r[51].PATIENT_DOB is None                         # unparsable text -> NULL (lenient)
    assert r[11].SURGERY_LOCATION == "1 Main, Town, ON, CA, "
    assert r[11].SALES_REP_NAME == "Rep Five" and r[11].SALESREP_NUMBER == "X"
    assert r[11].RESCHEDULED_SURGERY_DATE == dt.date(2020, 4, 1)
    assert r[11].SURGEON_ID == 1000 and r[11].LINE_TYPE == "Standard"


def test_portal_view_preset(spark, erp):
    from orderlens.plans.erp import PORTAL_LEADING, PORTAL_TRAILING, erp_portal_view
    iview = spark.createDataFrame([("0123B",), ("0123B",)], "serial_number string")  # derived key 0123
    dof = spark.createDataFrame([("A123",)], "serial_number string")
    other = spark.createDataFrame([], "serial_number string")
    out = erp_portal_view(erp, {
        "iview_exists": (iview, "SERIAL_NUMBER_ORI", "serial_number_ori"),
        "dof_exists": (dof, "SERIAL_NUMBER", "serial_number"),
        "iview2_exists": (other, "SERIAL_NUMBER", "serial_number"),
    }, ["Hip%"])
    assert len(out.columns) == 42
    assert tuple(out.columns) == PORTAL_LEADING + ("iview_exists", "dof_exists", "iview2_exists") + PORTAL_TRAILING
    r = {row.LINE_ID: row for row in out.collect()}
    assert len(r) == 4                                     # duplicates in a list never multiply rows
    assert (r[15].iview_exists, r[15].dof_exists, r[15].iview2_exists) == (1, 1, 0)
    assert (r[11].iview_exists, r[11].dof_exists) == (0, 0)
    assert r[51].PRODUCT_DESCRIPTION == "Hip"              # no order detail text -> own description
    assert r[11].ACTUAL_SURGERY_DATE == r[11].RESCHEDULED_SURGERY_DATE


def test_directory_preset(spark):
    from orderlens.plans.erp import DIRECTORY_COLUMNS, erp_directory
    df = spark.createDataFrame
    t = {
        "account_roles": df([(1, 100, 7, 70, "A"), (2, 200, 8, 80, "I"), (3, 300, 9, 90, "A")],
                            "cust_account_role_id long, party_id long, cust_account_id long, "
                            "cust_acct_site_id long, current_role_state string"),
        "relationships": df([
            (100, 1000, 5000, 6000, "HZ_PARTIES", "PERSON", "HZ_PARTIES", "ORGANIZATION", None, None, "A", "CONTACT"),
            (200, 2000, 5001, 6000, "HZ_PARTIES", "PERSON", "HZ_PARTIES", "ORGANIZATION", None, None, "A", "CONTACT"),
            (300, 3000, 5002, 6000, "HZ_PARTIES", "PERSON", "HZ_PARTIES", "ORGANIZATION", None, None, "A", "OTHER"),
        ], "party_id long, relationship_id long, object_id long, subject_id long, object_table_name string, "
           "object_type string, subject_table_name string, subject_type string, start_date timestamp_ntz, "
           "end_date timestamp_ntz, status string, relationship_code string"),
        "org_contacts": df([(1000, "physician", "A"), (2000, "Nurse", "A"), (3000, "PHYSICIAN", "A")],
                           "party_relationship_id long, job_title string, status string"),
        "parties": df([(5000, "Ann", None, "Lee", None), (6000, None, None, None, "General")],
                      "party_id long, person_first_name string, person_middle_name string, "
                      "person_last_name string, party_name string"),
        "acct_sites": df([(7, 70, 700, "A")], "cust_account_id long, cust_acct_site_id long, party_site_id long, status string"),
        "party_sites": df([(700, 7000, "A")], "party_site_id long, location_id long, status string"),
        "locations": df([(7000, "1 Main", None, None, "Town", "MA", "02100", "US")],
                        "location_id long, address1 string, address2 string, address3 string, city string, "
                        "state string, postal_code string, country string"),
        "contact_points": df([
            (100, "HZ_PARTIES", "PHONE", "A", "Y", "617", "5550100", None, None),
            (100, "HZ_PARTIES", "PHONE", "A", "N", "999", "0000000", None, None),
            (100, "HZ_PARTIES", "EMAIL", "A", "Y", None, None, None, "ann@example.org"),
        ], "owner_table_id long, owner_table_name string, contact_point_type string, status string, "
           "primary_flag string, phone_area_code string, phone_number string, phone_extension string, "
           "email_address string"),
    }
    out = erp_directory(t)
    assert tuple(out.columns) == DIRECTORY_COLUMNS and len(out.columns) == 24
    rows = out.collect()
    assert [r.CUST_ACCOUNT_ROLE_ID for r in rows] == [1]   # nurse dropped; non-CONTACT role dropped
    r = rows[0]
    assert (r.SURGEON_ID, r.FIRSTNAME, r.HOSPITAL, r.CITY) == (5000, "Ann", "General", "Town")
    assert r.PHONE == "(617)5550100 " and r.EMAIL == "ann@example.org"


def test_mv_generation(erp_tables):
    from orderlens.plans.erp import MV_COLUMNS, erp_order_view_mv
    out = erp_order_view_mv(erp_tables, AS_OF, lookup_type="PRODCAT")
    assert tuple(out.columns) == MV_COLUMNS and len(MV_COLUMNS) == 47
    r = {row.LINE_ID: row for row in out.collect()}
    # no order-type exclusion in this generation: order 3 (type OEM-X) is reported
    assert sorted(r) == [11, 13, 15, 31, 51]
    assert r[11].PRODUCT_CATEGORY == "NOCAT" and r[11].PATELLA_FLAG == "False"   # lookup in DE only
    assert r[51].PRODUCT_CATEGORY == "Hip System"
    assert r[51].PRODUCT_DESC_ORDCNF is None and r[11].PRODUCT_DESC_ORDCNF is None  # gated: flag 0
    assert r[11].STATUS == "CLOSED" and r[15].STATUS == "Re-Design"


def test_draft_generation(spark, erp_tables):
    from orderlens.plans.erp import DRAFT_COLUMNS, erp_order_view_draft
    iv = spark.createDataFrame([("A123",)], "serial_number string")
    dof = spark.createDataFrame([], "serial_number string")
    out = erp_order_view_draft(erp_tables, AS_OF, lookup_type="PRODCAT", description_pattern="Hip%",
                               doc_lists={"IVIEW_EXISTS": iv, "DOF_EXISTS": dof})
    assert tuple(out.columns) == DRAFT_COLUMNS and len(DRAFT_COLUMNS) == 48
    r = {row.LINE_ID: row for row in out.collect()}
    # surgeon optional (order 4 kept), shipped lines older than 30 days on the actual
    # shipment date (NULL here) are aged out: closed-not-returned line 11 is dropped
    assert 41 in r and 11 not in r
    assert (r[15].IVIEW_EXISTS, r[15].DOF_EXISTS) == (1, 0)
    assert r[13].PATIENT_DOB == dt.date(1970, 1, 15)
    assert r[51].PRODUCT_DESCRIPTION == "Hip"                       # no detail text -> own description


@pytest.fixture(scope="module")
def pricing_tables(spark):
    df = spark.createDataFrame
    far, gone = D("2030-01-01"), D("2019-01-01")
    return {
        "list_headers": df([(500, None, None), (600, None, None), (700, None, gone)],
                           "list_header_id long, start_date_active timestamp_ntz, end_date_active timestamp_ntz"),
        "list_lines": df([(1, 500, 10.0, None, None), (2, 500, 5.0, None, None), (3, 600, 1.0, None, None),
                          (4, 700, 9.0, None, None), (5, 500, 7.0, None, gone)],
                         "list_line_id long, list_header_id long, operand double, "
                         "start_date_active timestamp_ntz, end_date_active timestamp_ntz"),
        "pricing_attributes": df([(1, "PRICING_ATTRIBUTE1", "1"), (2, "PRICING_ATTRIBUTE2", "30"),
                                  (3, "PRICING_ATTRIBUTE3", "ALL"), (4, "PRICING_ATTRIBUTE1", "2"),
                                  (5, "PRICING_ATTRIBUTE1", "2")],
                                 "list_line_id long, product_attribute string, product_attr_value string"),
        "system_items": df([(1, 84, "ITEM1"), (2, 84, "ITEM2"), (447191, 84, "IDENT")],
                           "inventory_item_id long, organization_id long, segment1 string"),
        "item_categories": df([(1, 10, 84, 1100000202), (2, 20, 84, 1100000202), (447191, 10, 84, 1100000202),
                               (447191, 30, 84, 5)],
                              "inventory_item_id long, category_id long, organization_id long, category_set_id long"),
        "categories": df([(10, "CATA"), (20, "CATB"), (30, "GRP"), (40, "OTHER")], "category_id long, segment1 string"),
        "parties": df([(1000, "H1", "A"), (1001, "H2", "A"), (2000, "G", "A"), (1002, "H3", "I")],
                      "party_id long, party_name string, status string"),
        "cust_accounts": df([(1000, "Yes"), (1001, "No")], "party_id long, attribute7 string"),
        "relationships": df([(1000, 2000, "PARTICIPATING", far, "A")],
                            "subject_id long, object_id long, relationship_code string, end_date timestamp_ntz, status string"),
        "group_precedence": df([(2000, None, 500, "YES", None, None), (None, 1001, 700, "YES", None, None)],
                               "grp_party_id long, cust_party_id long, grp_price_list_id long, active string, "
                               "start_date timestamp_ntz, end_date timestamp_ntz"),
        "party_sites": df([(1000, 1, 11, "A"), (1001, 2, 12, "A"), (1002, 3, 11, "A")],
                          "party_id long, party_site_id long, location_id long, status string"),
        "locations": df([(11, "US"), (12, "DE")], "location_id long, country string"),
        "acct_sites": df([(1, 21, "A"), (2, 22, "A"), (3, 23, "A")], "party_site_id long, cust_acct_site_id long, status string"),
        "site_uses": df([(21, 600, "A"), (22, 600, "A"), (23, 600, "A")],
                        "cust_acct_site_id long, price_list_id long, status string"),
    }


def test_erp_pricelist_item(pricing_tables):
    from orderlens.plans.erp import erp_pricelist_item
    rows = sorted((r.PRICE_LIST_ID, r.PRODUCT_ATTRIBUTE, r.INVENTORY_ITEM_ID or 0, r.PATIENTPAYIDENTITYPRICE)
                  for r in erp_pricelist_item(pricing_tables, AS_OF).collect())
    assert rows == [(500, "PRICING_ATTRIBUTE1", 1, None), (500, "PRICING_ATTRIBUTE2", 447191, 5.0),
                    (600, "PRICING_ATTRIBUTE3", 0, None)]


def test_erp_party_pricelist(pricing_tables):
    from orderlens.plans.erp import erp_party_pricelist
    rows = {r.HOSPITAL_ID: tuple(r) for r in erp_party_pricelist(pricing_tables, AS_OF).collect()}
    # H1 (US) takes its group's price list; H2 (DE) its site list; H3 inactive
    assert rows == {1000: (2000, 1000, "H1", 1, 500, "US"), 1001: (None, 1001, "H2", 0, 600, "DE")}


def test_erp_hospital_product(pricing_tables):
    from orderlens.plans.erp import erp_hospital_product
    m = erp_hospital_product(pricing_tables, AS_OF)
    assert m.columns == ["HOSPITAL_ID", "HOSPITAL", "PATIENTPAYREQUIRED", "PATIENTPAYIDENTITYPRICE", "CATA", "CATB"]
    rows = {r.HOSPITAL_ID: tuple(r)[1:] for r in m.collect()}
    assert rows == {1000: ("H1", 1, 5.0, 1, 0), 1001: ("H2", 0, None, 1, 1)}


def test_erp_incremental_refresh(spark, erp):
    from pyspark.sql import functions as F
    from orderlens.plans.erp import ORDER_VIEW_COLUMNS, erp_incremental_refresh
    view = erp.withColumn("LAST_UPDATE_DATE", F.lit(AS_OF).cast("timestamp_ntz"))  # all just updated
    # stored table: line 11 older (updated), line 13 same time (kept), line 99 gone (deleted)
    old = view.where("LINE_ID in (11, 13)").withColumn("STATUS", F.lit("OLD")).withColumn(
        "LAST_UPDATE_DATE", F.when(F.col("LINE_ID") == 11, F.lit(D("2020-01-01")))
        .otherwise(F.lit(AS_OF)).cast("timestamp_ntz"))
    gone = view.where("LINE_ID = 11").withColumn("LINE_ID", F.lit(99).cast("long"))
    target = old.unionByName(gone)
    out = erp_incremental_refresh(target, view, AS_OF + dt.timedelta(minutes=5))
    assert tuple(out.columns) == ORDER_VIEW_COLUMNS
    got = {r.LINE_ID: r.STATUS for r in out.collect()}
    assert got == {11: "CLOSED", 13: "OLD", 15: "Re-Design", 51: "BOOKED"}


def test_erp_legacy_load(spark):
    from orderlens.plans.erp import LEGACY_GENERAL_COLUMNS, erp_legacy_load
    df = spark.createDataFrame
    base_cols = [c for c in LEGACY_GENERAL_COLUMNS]

    def view_rows(rows, extra=()):
        schema = ", ".join(f"{c} {'long' if c in ('ORDER_ID', 'LINE_ID') else 'string'}" for c in base_cols)
        schema += ", HEADER_ID long" + "".join(f", {e} string" for e in extra)
        out = []
        for r in rows:
            d = {c: None for c in base_cols}
            d.update(r)
            out.append(tuple(d[c] for c in base_cols) + (r.get("HEADER_ID"),) + tuple(r.get(e) for e in extra))
        return df(out, schema)

    old = view_rows([
        {"ORDER_ID": 1, "LINE_ID": 11, "HEADER_ID": 100, "STATUS": "PENDING_DESIGN_APPROVAL", "SERIAL_NUMBER": "S1", "LINE_TYPE": "Standard"},
        {"ORDER_ID": 2, "LINE_ID": 21, "HEADER_ID": 200, "STATUS": "BOOKED", "LINE_TYPE": "Standard"},      # class item -> out
        {"ORDER_ID": 3, "LINE_ID": 31, "HEADER_ID": 300, "STATUS": "BOOKED", "LINE_TYPE": "HIP Procedure"},  # excluded type
        {"ORDER_ID": 4, "LINE_ID": 41, "HEADER_ID": 400, "STATUS": "PENDING_DESIGN_APPROVAL", "SERIAL_NUMBER": "S2", "LINE_TYPE": "Standard"},
    ])
    g3 = view_rows([{"ORDER_ID": 5, "LINE_ID": 51, "HEADER_ID": 500, "STATUS": "PENDING_DESIGN_APPROVAL",
                     "SERIAL_NUMBER": "S1", "LINE_TYPE": "HIP Procedure", "ORDER_DETAILS_2_ORDCNF": "d2"}],
                   extra=("PRODUCT_DESC_ORDCNF", "ORDER_DETAILS_ORDCNF", "ORDER_DETAILS_2_ORDCNF"))
    t = {
        "old_order_view": old, "special_order_view": g3,
        "hip_revision": df([("S1", 1, "pending"), ("S1", 2, "approved"), ("S2", 1, "declined"), ("S2", 1, "pending")],
                           "serial_number string, revision int, status string"),
        "order_lines": df([(200, 7, "BOOKED"), (400, 7, "CANCELLED")], "header_id long, inventory_item_id long, flow_status_code string"),
        "system_items": df([(7, 84)], "inventory_item_id long, organization_id long"),
        "item_categories": df([(7, 84, 1, 10), (7, 84, 2, 20)],
                              "inventory_item_id long, organization_id long, category_set_id long, category_id long"),
        "category_sets": df([(1, "Inventory"), (2, "IncludeSet")], "category_set_id long, category_set_name string"),
        "categories": df([(10, "WIP CLASSIFICATION", "KNEE CLASS"), (20, "Yes", None)],
                         "category_id long, segment1 string, segment2 string"),
    }
    out = erp_legacy_load(t, class_segment2="KNEE CLASS", include_set="IncludeSet")
    assert len(out.columns) == 39
    got = {r.LINE_ID: (r.STATUS, r.ORDER_DETAILS2) for r in out.collect()}
    # S1 latest revision approved; S2 has two rows at its max revision -> NULL -> status kept
    assert got == {11: ("Design Approved by Surgeon", None), 41: ("PENDING_DESIGN_APPROVAL", None),
                   51: ("Design Approved by Surgeon", "d2")}


def test_jobs_cli(spark, erp_tables, pricing_tables, caplog):
    import logging
    caplog.set_level(logging.INFO, logger="orderlens")
    from orderlens.plans.jobs import main
    from orderlens.session import scratch_path
    from orderlens.sources.store import read_current
    tables = scratch_path(spark, "t-erp-tables")
    for name, df in {**erp_tables, **pricing_tables}.items():
        df.write.parquet(f"{tables}/{name}")
    target = scratch_path(spark, "t-order-table")
    main(["order-refresh", "--tables", tables, "--target", target, "--as-of", str(AS_OF),
          "--excluded-order-types", "OEM-X"], spark=spark)
    assert sorted(r.LINE_ID for r in read_current(spark, target).collect()) == [11, 13, 15, 51]
    main(["order-refresh", "--tables", tables, "--target", target, "--mode", "incremental",
          "--as-of", str(AS_OF), "--excluded-order-types", "OEM-X"], spark=spark)
    assert sorted(r.LINE_ID for r in read_current(spark, target).collect()) == [11, 13, 15, 51]
    log = [r.getMessage() for r in caplog.records if "incremental refresh" in r.getMessage()]
    assert log and log[0].startswith("incremental refresh: deleted 0, updated 0, inserted 0") and "4 rows" in log[0]
    with pytest.raises(SystemExit):          # the excluded order types are not optional
        main(["order-refresh", "--tables", tables, "--target", target], spark=spark)
    timed = scratch_path(spark, "t-order-table-timed")
    main(["order-refresh", "--tables", tables, "--target", timed, "--as-of", str(AS_OF),
          "--excluded-order-types", "OEM-X", "--every", "1 second", "--runs", "2"], spark=spark)
    assert sorted(r.LINE_ID for r in read_current(spark, timed).collect()) == [11, 13, 15, 51]
    hot_target = scratch_path(spark, "t-order-table-hot")
    main(["order-refresh", "--tables", tables, "--target", hot_target, "--as-of", str(AS_OF),
          "--excluded-order-types", "OEM-X", "--hot-key-rows", "2"], spark=spark)
    assert sorted(r.LINE_ID for r in read_current(spark, hot_target).collect()) == [11, 13, 15, 51]
    matrix = scratch_path(spark, "t-matrix")
    main(["matrix-refresh", "--tables", tables, "--target", matrix, "--as-of", str(AS_OF)], spark=spark)
    assert {r.HOSPITAL_ID for r in read_current(spark, matrix).collect()} == {1000, 1001}


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_erp_plans_have_no_nested_loops(spark, erp_tables, pricing_tables):
    from orderlens.plans.erp import (
        erp_hospital_product, erp_order_view, erp_order_view_mv, erp_party_pricelist,
    )
    frames = {
        "order_view": erp_order_view(erp_tables, AS_OF, ["OEM-X"]),
        "mv": erp_order_view_mv(erp_tables, AS_OF, lookup_type="PRODCAT"),
        "party_pricelist": erp_party_pricelist(pricing_tables, AS_OF),
        "matrix": erp_hospital_product(pricing_tables, AS_OF),
    }
    for name, df in frames.items():
        p = _plan(df)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
        if name != "matrix":                    # the matrix's one window runs on reduced rows
            assert "Window" not in p, name


def test_erp_reconcile(erp):
    from pyspark.sql import functions as F
    from orderlens.plans.erp import erp_reconcile
    old = erp.where("LINE_ID <> 51").withColumn(
        "SHIPPED_DATE", F.when(F.col("LINE_ID") == 11, F.lit(D("2020-01-01"))).otherwise(F.col("SHIPPED_DATE")))
    r = erp_reconcile(old, erp).collect()[0]
    assert (r.n, r.only_new, r.only_old, r.SHIPPED_DATE_diff, r.STATUS_diff) == (4, 1, 0, 1, 0)


def test_register_views_sql(spark, erp_tables, erp):
    from orderlens.plans.views import register_order_views
    from orderlens.session import scratch_path
    from orderlens.sources.store import publish
    base = scratch_path(spark, "t-views")
    publish(erp, base)
    docs = {"iview_exists": (spark.createDataFrame([("0123B",)], "serial_number string"),
                             "SERIAL_NUMBER_ORI", "serial_number_ori"),
            "dof_exists": (spark.createDataFrame([], "serial_number string"), "SERIAL_NUMBER", "serial_number")}
    names = register_order_views(spark, erp_tables, AS_OF, ["OEM-X"], order_table=base, doc_lists=docs,
                                 override_patterns=["KNEE%"])
    assert names == ["order_view", "order_table", "portal_view"]
    r = spark.sql("select LINE_ID, iview_exists from portal_view where STATUS = 'Re-Design'").collect()
    assert [tuple(x) for x in r] == [(15, 1)]
    assert spark.sql("select count(*) from order_view").collect()[0][0] == 4
