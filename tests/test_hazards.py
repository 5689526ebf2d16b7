"""SURVEY 1.1 hazards not covered elsewhere, on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from orderlens import operators as O
from orderlens.plans.order_view import EXCLUDED_LINE_TYPES, EXCLUDED_LINE_TYPES_V1
from orderlens.plans.refresh import run_full_refresh, run_refresh
from orderlens.session import scratch_path
from orderlens.sources.store import read_current


def test_h4_not_in_and_not_like_drop_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    assert [r.x for r in O.exclude_values(df, "x", ["a"]).collect()] == ["b"]
    assert [r.x for r in df.where(~F.col("x").like("a%")).collect()] == ["b"]
    # the older view guards with nvl(..., 'NOCAT') and keeps the NULL row
    kept = df.where(~F.coalesce(F.col("x"), F.lit("NOCAT")).like("a%")).collect()
    assert sorted(r.x or "" for r in kept) == ["", "b"]


def test_h5_filter_on_outer_side_makes_inner(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, "x")], "rk int, v string")
    j = left.join(right, F.col("k") == F.col("rk"), "left").where(F.col("v") != "y")
    assert [r.k for r in j.collect()] == [1]
    assert "Inner" in j._jdf.queryExecution().optimizedPlan().toString()


def test_h18_line_type_lists_are_literal():
    assert "HIP RMA Proc Cust Rec & Credit" in EXCLUDED_LINE_TYPES
    assert "HIP RMA Proc Cust Rec " in EXCLUDED_LINE_TYPES_V1          # trailing blank kept
    assert "HIP RMA Proc Cust Rec" not in EXCLUDED_LINE_TYPES_V1


def test_h21_true_row_counts(spark):
    df, obs = O.with_counts(spark.range(2500), "load")   # several "batches" of 1000
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 2500


def test_h22_refresh_mode_dispatch(spark):
    base = scratch_path(spark, "t-mode")
    view = spark.createDataFrame([(1, "a")], "id int, st string")
    run_refresh(spark, "full", view, base)
    assert [tuple(r) for r in read_current(spark, base).collect()] == [(1, "a")]
    with pytest.raises(ValueError):
        run_refresh(spark, "sometimes", view, base)
    assert run_full_refresh(view, base) > base


def test_scale_conf_sizes_partitions():
    from orderlens.session import scale_conf
    c = scale_conf(100 * 2**40)                      # 100 TB shuffle
    assert int(c["spark.sql.shuffle.partitions"]) == 409_600   # 256 MB each, no cap
    c = scale_conf(10 * 2**40)                       # 10 TB -> 40,960 partitions of 256 MB
    assert c["spark.sql.shuffle.partitions"] == "40960"
    assert c["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "256m"
    assert scale_conf(10 << 20)["spark.sql.shuffle.partitions"] == "200"
