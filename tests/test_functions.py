"""Micro cases (FIXTURES.md section 2): NULL and text rules of the scalar builders."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderlens import functions as X


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def run(df, expr):
    return [r[0] for r in df.select(expr.alias("y")).collect()]


def test_serial_suffix(spark):
    df = one_col(spark, ["12345A", "12345-B2", "12A34B", "12345", "A", "12\\34", None])
    assert run(df, X.serial_suffix("x")) == ["12345", "12345-", "12A34", "12345", "A", "12", None]


def test_serial_prefix(spark):
    df = one_col(spark, ["A123", "B1A", "1A", None])
    assert run(df, X.serial_prefix("x")) == ["0123", "01A", "1A", None]


def test_date_text(spark):
    df = one_col(spark, ["2020/03/01 00:00:00"])
    assert run(df, X.date_text(X.text_to_date("x"))) == ["01-MAR-2020"]


def test_date_prefix_lenient_and_strict(spark):
    df = one_col(spark, [None, "", "2020-13", "2020/02/30", "2020/02/29xyz"])
    assert run(df, X.text_to_date("x")) == [None, None, None, None, dt.date(2020, 2, 29)]
    with pytest.raises(Exception):
        one_col(spark, ["2020-13"]).select(X.text_to_date("x", strict=True)).collect()


def test_address(spark):
    df = spark.createDataFrame(
        [(None, None, None, None), ("1 Main", None, "ON", "CA"), ("", "", "", "")],
        "street string, state string, province string, country string")
    got = run(df, X.address_line(["street"], "state", "province", "country"))
    assert got == [", ", "1 Main, ON, CA, ", ", "]


def test_phone(spark):
    df = spark.createDataFrame([(None, None, None), ("555", "1234", "9")], "a string, n string, e string")
    assert run(df, X.phone_line("a", "n", "e")) == ["() ", "(555)1234 9"]


def test_category_label(spark):
    pairs = [("NONE", "NONE"), ("Partial", "X"), ("NONE", "X"), ("Y", "NONE"),
             (None, None), (None, "X"), ("Y", None), ("Y", "X")]
    df = spark.createDataFrame(pairs, "a string, b string")
    assert run(df, X.category_label("a", "b")) == ["NONE", "X", "X", "Y", "NOCAT", " X", "Y ", "Y X"]


def test_status_label(spark):
    rows = [("CLOSED", 0.0, None), ("CLOSED", None, None),
            ("PENDING_DESIGN_APPROVAL", 1.0, "declined"), ("PENDING_DESIGN_APPROVAL", 1.0, None),
            ("PENDING_DESIGN_APPROVAL", 1.0, "other")]
    df = spark.createDataFrame(rows, "code string, qty double, review string")
    assert run(df, X.status_label("code", "qty", "review")) == [
        "RETURN", "CLOSED", "Re-Design", "PENDING_DESIGN_APPROVAL", "PENDING_DESIGN_APPROVAL"]


def test_retention(spark):
    as_of = "2020-03-31"
    rows = [("CLOSED", None, "2019-01-01"), ("CANCELLED", 1.0, "2020-02-29"),
            ("CANCELLED", 1.0, "2020-03-02"), (None, 1.0, "2020-03-30")]
    df = spark.createDataFrame(rows, "st string, qty double, ship string").withColumn(
        "ship", F.col("ship").cast("timestamp_ntz"))
    assert run(df, X.retained("st", "qty", "ship", as_of)) == [True, False, True, None]


def test_flag_filter(spark):
    from orderlens.operators import keep_flagged_or_unflagged
    rows = [(1, 1), (0, 1), (0, 0), (None, 0), (None, None)]
    df = spark.createDataFrame(rows, "flag int, order_flag int")
    got = [tuple(r) for r in keep_flagged_or_unflagged(df, "flag", "order_flag").collect()]
    assert got == [(1, 1), (0, 0), (None, 0)]


def test_validity_open_ended(spark):
    df = spark.createDataFrame([(None, None)], "s timestamp_ntz, e timestamp_ntz")
    assert run(df, X.valid_at("s", "e", "2020-01-01")) == [True]


def test_change_guard(spark):
    sentinel = dt.date(2000, 1, 1)
    rows = [  # src_ts, tgt_ts, src_d, tgt_d
        ("2020-01-02", "2020-01-01", None, None),           # newer -> update
        ("2020-01-01", "2020-01-01", "2019-05-05", "2019-05-05"),  # same -> keep
        ("2020-01-01", None, "2019-05-05", "2019-05-05"),  # tgt ts NULL, dates equal -> keep
        ("2020-01-01", "2020-01-01", None, "2000-01-01"),  # NULL vs sentinel -> keep
        ("2020-01-01", "2020-01-01", None, "2019-05-05"),  # NULL vs other -> update
    ]
    df = spark.createDataFrame(rows, "s string, t string, sd string, td string").select(
        *[F.col(c).cast("timestamp_ntz" if c in "st" else "date").alias(c) for c in ("s", "t", "sd", "td")])
    guard = X.change_guard("s", "t", [("sd", "td")], sentinel=sentinel)
    assert [bool(v) for v in run(df, F.coalesce(guard, F.lit(False)))] == [True, False, False, False, True]


def test_blank_is_null_in_nvl2(spark):
    df = one_col(spark, ["", None, "a"])
    assert run(df, X.nvl2("x", F.lit("set"), F.lit("unset"))) == ["unset", "unset", "set"]
