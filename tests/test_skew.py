"""Hot keys: one user holds a third of all events (derived from the driver
table by Spark).  The skew-safe operators must equal their plain forms, and
reach the shuffle pre-aggregated."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF01
from orderlens import operators as O
from orderlens.sources.tables import Tables


@pytest.fixture(scope="module")
def hot_events(spark):
    ev = Tables(spark, SF01).events
    return ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(7).cast("long"))
                         .otherwise(F.col("user_id")))


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_share(hot_events):
    n = hot_events.count()
    assert hot_events.where(F.col("user_id") == 7).count() >= n // 3


def test_latest_per_key_hot(hot_events):
    got = O.latest_per_key(hot_events, "user_id", ["ts", "event_id"], ["event_type", "ts"])
    w = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))
    want = (hot_events.withColumn("rn", F.row_number().over(w)).where("rn = 1")
            .select("user_id", "event_type", "ts"))
    assert same(got, want)
    assert "partial_max" in plan(got)               # combined map-side before the shuffle


def test_group_max_hot(hot_events):
    got = O.group_max(hot_events, "value", "user_id", "mx").select("event_id", "mx")
    want = hot_events.select("event_id", F.max("value").over(Window.partitionBy("user_id")).alias("mx"))
    assert same(got, want)
    assert "Window" not in plan(got)


def test_strict_latest_hot(hot_events):
    got = O.strict_latest(hot_events, "user_id", F.to_date("ts"), "event_type")
    r = hot_events.select("user_id", F.to_date("ts").alias("rev"), F.upper("event_type").alias("st"))
    m = r.groupBy("user_id").agg(F.max("rev").alias("rev"))
    want = (r.join(m, ["user_id", "rev"]).groupBy("user_id")
             .agg(F.when(F.count(F.lit(1)) == 1, F.max("st")).alias("status")))
    assert same(got, want)


def test_left_join_many_hot(spark, hot_events):
    cust = Tables(spark, SF01).customer.select("c_custkey")
    ev = hot_events.select("user_id", "event_id")
    got = O.left_join_many(cust, ev, [("c_custkey", "user_id")])
    want = cust.join(ev, F.col("c_custkey") == F.col("user_id"), "left")
    assert same(got, want)


def test_exists_flag_hot(spark, hot_events):
    orders = Tables(spark, SF01).orders.select("o_orderkey", "o_custkey")
    got = O.exists_flag(orders, hot_events, "o_custkey", "user_id", "f")
    assert got.count() == orders.count()
    keys = hot_events.select("user_id").distinct()
    want = (orders.join(keys, F.col("o_custkey") == F.col("user_id"), "left")
            .select("o_orderkey", "o_custkey", F.when(F.col("user_id").isNull(), 0).otherwise(1).alias("f")))
    assert same(got, want)


def test_find_hot_keys(hot_events):
    assert O.find_hot_keys(hot_events, ["user_id"], 1000) == [(7,)]
    users = hot_events.select("user_id").distinct().count()
    assert len(O.find_hot_keys(hot_events, ["user_id"], 1)) == users        # a threshold, no cap


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_to_one_equals_plain_join(spark, hot_events, how):
    small = (hot_events.groupBy("user_id").agg(F.max("value").alias("mx"))
             .withColumnRenamed("user_id", "uid").where(F.col("uid") != 3))
    hot = O.find_hot_keys(hot_events, ["user_id"], 1000)
    got = O.join_to_one(hot_events, small, [("user_id", "uid")], how, hot)
    want = hot_events.join(small, F.col("user_id") == F.col("uid"), how).drop("uid")
    assert same(got.select(*want.columns), want)
    assert "BroadcastHashJoin" in plan(got)


def test_group_max_hot_keys(hot_events):
    hot = O.find_hot_keys(hot_events, ["user_id"], 1000)
    got = O.group_max(hot_events, "value", "user_id", "mx", null_keys="drop", hot_keys=hot)
    want = hot_events.select(*hot_events.columns,
                             F.max("value").over(Window.partitionBy("user_id")).alias("mx"))
    assert same(got, want)


def test_order_view_with_hot_orders_unchanged(spark):
    from dataclasses import replace
    from orderlens.plans import driver
    from orderlens.plans.order_view import order_view
    t = Tables(spark, SF01)
    hot = O.find_hot_keys(t.lineitem.withColumnRenamed("l_orderkey", "header_id"), ["header_id"], 7)
    assert hot                                   # orders with 7 lines exist at sf0.01
    base = driver.q_order_view(spark, SF01)
    roles = driver._order_view_roles(t)
    excluded = t.nation.where(F.col("n_name") == "NATION_9").select(F.col("n_nationkey").alias("grp"))
    cfg = replace(driver._order_view_config(), hot_order_keys=tuple(hot))
    got = order_view(**roles, cfg=cfg, excluded_groups=(excluded, "contact_group", "grp"))
    assert same(got, base)


def test_exists_flag_and_join_latest_hot_keys(spark, hot_events):
    hot = O.find_hot_keys(hot_events, ["user_id"], 1000)
    flags = hot_events.where(F.col("event_type") == "error")
    a = O.exists_flag(hot_events, flags, "user_id", "user_id", "f", hot_keys=hot)
    b = O.exists_flag(hot_events, flags, "user_id", "user_id", "f")
    assert same(a, b)
    ev2 = hot_events.select(F.col("user_id").alias("uid"), "ts", "event_id", "event_type")
    left = hot_events.select("event_id", "user_id").withColumnRenamed("event_id", "eid")
    c = O.join_latest(left, ev2, [("user_id", "uid")], ["ts", "event_id"], ["event_type"], hot_keys=hot)
    d = O.join_latest(left, ev2, [("user_id", "uid")], ["ts", "event_id"], ["event_type"])
    assert same(c.select(*d.columns), d)


@pytest.fixture
def small_splits(spark):
    """Sizes at which AQE treats a few hundred KB as skewed; no broadcast joins."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def split_joins(df):
    total = df.groupBy().agg(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")))
    total.collect()
    return total._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("skew=true")


def test_hot_keys_are_split_by_default(spark, small_splits):
    k = F.when(F.col("id") % 10 < 7, F.lit(7)).when(F.col("id") % 10 < 8, F.lit(None)).otherwise(F.col("id") % 997)
    big = spark.range(0, 200_000, 1, 8).select(k.alias("k"), F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    right = spark.range(0, 50_000, 1, 8).select((F.col("id") % 1000).alias("rk"), F.col("id").alias("ts"), (F.col("id") * 3).alias("x"))
    cases = {
        "join_latest": lambda: O.join_latest(big, right, [("k", "rk")], ["ts"], ["x"]),
        "exists_flag": lambda: O.exists_flag(big, right, "k", "rk", "f"),
        "group_max": lambda: O.group_max(big, "v", "k", "m", null_keys="drop"),
        "exclude_keys": lambda: O.exclude_keys(big, right.where("rk > 500"), "k", "rk"),
        "keep_keys": lambda: O.keep_keys(big, right, "k", "rk"),
        "two flags": lambda: O.exists_flag(O.exists_flag(big, right, "k", "rk", "f"), right.where("x > 9"), "k", "rk", "g"),
    }
    for name, make in cases.items():
        assert split_joins(make()) >= 1, name
    got = O.join_latest(big, right, [("k", "rk")], ["ts"], ["x"]).agg(F.count("*"), F.sum("x")).first()
    assert got[0] == 200_000 and got[1] == big.where("k is not null").select(
        F.sum((F.col("k") + 49_000) * 3)).first()[0]
