"""SURVEY section 5(c) properties on the driver tables (sf0.01)."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF01
from orderlens.functions import change_guard
from orderlens.operators import assert_unique, incremental_refresh, recent
from orderlens.plans import driver
from orderlens.sources.tables import Tables


def test_matrix_has_one_row_per_hospital(spark):
    m = driver.q_hospital_product(spark, SF01)
    assert_unique(m, ["hospital_id"])
    assert m.count() > 0


def test_incremental_with_full_window_equals_full_refresh_up_to_guard(spark):
    t = Tables(spark, SF01)
    view, target = driver._merge_source(t), driver._merge_target(t)
    everything = [recent("upd", "1900-01-01", dt.timedelta(0)) | F.col("upd").isNull()]
    out = incremental_refresh(target, view, "id", everything, driver._merge_guard)
    # same keys as the view (deletes and inserts complete) ...
    assert out.select("id").exceptAll(view.select("id")).count() == 0
    assert view.select("id").exceptAll(out.select("id")).count() == 0
    # ... and every row differing from the view is one the guard kept back
    j = out.alias("o").join(view.alias("v"), "id").join(target.alias("t"), "id")
    differing = j.where(~F.col("o.st").eqNullSafe(F.col("v.st")))
    guard = change_guard(F.col("v.upd"), F.col("t.upd"), [(F.col("v.sub"), F.col("t.sub"))], sentinel=-1)
    assert differing.where(F.coalesce(guard, F.lit(False))).count() == 0
    assert differing.count() > 0                 # the guard really keeps some rows


def test_exists_flags_never_multiply_rows(spark):
    t = Tables(spark, SF01)
    assert driver.q_portal_view(spark, SF01).count() == t.orders.count()


def test_order_view_line_flags_consistent(spark):
    v = driver.q_order_view(spark, SF01)
    # kept lines are flagged lines or lines of unflagged orders
    assert v.where(~((F.col("flag") == 1) | (F.col("order_flag") == 0))).count() == 0
    assert v.where(F.col("order_id") >= 700001).count() == 0
