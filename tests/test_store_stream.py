"""Publish/versioning (A3/A4/A14) and streaming (K1-K3) against batch results."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from conftest import SF01
from orderlens.operators import latest_per_key
from orderlens.plans import driver
from orderlens.plans.refresh import run_full_refresh, run_incremental_refresh
from orderlens.plans.streams import LATEST_SCHEMA, latest_guard, stage_feed
from orderlens.session import scratch_path
from orderlens.sources.store import current_version, publish, read_current
from orderlens.sources.tables import Tables
from orderlens.streaming import refresh_on_trigger, stream_upsert


def test_publish_versions_and_incomplete_is_invisible(spark):
    base = scratch_path(spark, "t-publish")
    schema = StructType([StructField("id", LongType()), StructField("s", StringType())])
    assert read_current(spark, base, schema).count() == 0
    v1 = publish(spark.createDataFrame([(1, "a")], schema), base)
    # a version folder without _SUCCESS (a crashed writer) must not be picked up
    spark.createDataFrame([(9, "z")], schema).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(base + "/v999999999999999-crash")
    assert current_version(spark, base) == v1
    v2 = publish(spark.createDataFrame([(2, "b")], schema), base)
    assert v2 > v1 and current_version(spark, base) == v2
    assert [tuple(r) for r in read_current(spark, base).collect()] == [(2, "b")]


def test_full_then_incremental_job_equals_operator(spark):
    t = Tables(spark, SF01)
    base = scratch_path(spark, "t-merge")
    run_full_refresh(driver._merge_target(t), base)
    window = [F.col("upd") > F.lit("2000-01-01").cast("timestamp_ntz"), F.col("sub") == 2]
    run_incremental_refresh(spark, driver._merge_source(t), base, "id", window, driver._merge_guard)
    got = read_current(spark, base).select("id", "st", "upd")
    want = driver.q_incremental_refresh(spark, SF01)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_stream_upsert_equals_batch(spark):
    ev = Tables(spark, SF01).events.select("user_id", "event_type", "ts", "event_id")
    feed = stage_feed(spark, ev, 5, "t-feed")
    changes = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(feed)
    base = scratch_path(spark, "t-latest")
    q = stream_upsert(changes, base, LATEST_SCHEMA, ["user_id"], ["ts", "event_id"], latest_guard,
                      checkpoint=scratch_path(spark, "t-ckpt"))
    q.awaitTermination()
    assert len(q.recentProgress) >= 5            # several micro-batches
    got = read_current(spark, base)
    want = latest_per_key(ev, "user_id", ["ts", "event_id"], ["event_type", "ts", "event_id"])
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    assert got.count() == want.count()


def test_refresh_on_trigger_runs_job_per_batch(spark):
    ev = Tables(spark, SF01).events.select("event_id")
    feed = stage_feed(spark, ev, 3, "t-ticks")
    ticks = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(feed)
    calls = []
    q = refresh_on_trigger(ticks, lambda: calls.append(dt.datetime.now()) or "ok",
                           checkpoint=scratch_path(spark, "t-ckpt-ticks"))
    q.awaitTermination()
    assert len(calls) == 3


def test_publish_versions_strictly_increase(spark):
    base = scratch_path(spark, "t-fast")
    df = spark.createDataFrame([(1,)], "x int")
    paths = [publish(df.selectExpr(f"{i} as x"), base) for i in range(4)]
    assert paths == sorted(paths) and len(set(paths)) == 4
    assert [r.x for r in read_current(spark, base).collect()] == [3]


def test_stream_upsert_null_keys_equal_batch(spark):
    ev = Tables(spark, SF01).events.select(
        F.when(F.col("event_id") % 50 == 0, F.lit(None)).otherwise(F.col("user_id")).alias("user_id"),
        "event_type", "ts", "event_id")
    feed = stage_feed(spark, ev, 4, "t-feed-null")
    changes = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(feed)
    base = scratch_path(spark, "t-latest-null")
    q = stream_upsert(changes, base, LATEST_SCHEMA, ["user_id"], ["ts", "event_id"], latest_guard,
                      checkpoint=scratch_path(spark, "t-ckpt-null"))
    q.awaitTermination()
    got = read_current(spark, base)
    want = latest_per_key(ev, "user_id", ["ts", "event_id"], ["event_type", "ts", "event_id"])
    assert got.where(F.col("user_id").isNull()).count() == 1
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == want.count()


def test_prune_versions_keeps_newest_and_drops_crashed(spark):
    from orderlens.sources.store import _versions, prune_versions
    base = scratch_path(spark, "t-prune")
    df = spark.createDataFrame([(1,)], "x int")
    paths = [publish(df, base) for _ in range(4)]
    # a crashed writer between the 2nd and 3rd version (no _SUCCESS)
    crashed = paths[1].rsplit("/", 1)[1][:16] + "9-crash"
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{base}/{crashed}")
    dropped = prune_versions(spark, base, keep=2)
    assert dropped == sorted([paths[0].rsplit("/", 1)[1], paths[1].rsplit("/", 1)[1], crashed])
    assert _versions(spark, base) == [p.rsplit("/", 1)[1] for p in paths[2:]]
    assert read_current(spark, base).count() == 1


def test_discard_stages(spark):
    import os
    from orderlens.sources.store import discard_stages, materialize
    staged = materialize(spark.range(5), name="t-stage")
    out = scratch_path(spark, "t-stage-out")
    staged.write.parquet(out)
    done = discard_stages(spark)
    assert done and not os.path.exists(done[-1].replace("file:", ""))
    assert spark.read.parquet(out).count() == 5


def test_shared_dir_refuses_local_folder_on_a_cluster():
    import pytest
    from orderlens.session import shared_dir

    class _Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class _Remote:  # a client without a SparkContext (Spark Connect)
        def __init__(self, values):
            self.conf = _Conf(values)

        @property
        def sparkContext(self):
            raise RuntimeError("no SparkContext")

    with pytest.raises(RuntimeError):
        shared_dir(_Remote({"spark.master": "yarn"}))
    assert shared_dir(_Remote({"spark.master": "yarn",
                               "spark.checkpoint.dir": "hdfs:///shared/ckpt/"})) == "hdfs:///shared/ckpt"


def test_duplicate_key_leaves_the_old_version_current(spark):
    import pytest
    from orderlens.plans.refresh import run_full_refresh, run_matrix_refresh
    base = scratch_path(spark, "t-checked")
    good = spark.createDataFrame([(1, "a"), (2, "b")], "hospital_id int, s string")
    bad = spark.createDataFrame([(1, "x"), (1, "y")], "hospital_id int, s string")
    old = run_matrix_refresh(good, base)
    for job in (run_matrix_refresh, lambda df, path: run_full_refresh(df, path, key="hospital_id")):
        with pytest.raises(Exception, match="hospital_id"):
            job(bad, base)
        assert current_version(spark, base) == old
        assert sorted(r.s for r in read_current(spark, base).collect()) == ["a", "b"]


def test_failing_listing_raises_and_keeps_the_rows(spark, monkeypatch):
    import pytest
    from orderlens.sources import store
    base = scratch_path(spark, "t-listing")
    schema = StructType([StructField("id", LongType())])
    publish(spark.createDataFrame([(1,)], schema), base)
    fs = store._fs

    def broken(session, path):
        raise OSError("listing failed")
    monkeypatch.setattr(store, "_fs", broken)
    with pytest.raises(OSError):
        read_current(spark, base, schema)
    with pytest.raises(OSError):
        publish(spark.createDataFrame([(2,)], schema), base)
    monkeypatch.setattr(store, "_fs", fs)
    assert [r.id for r in read_current(spark, base).collect()] == [1]


def bucket_files(path):
    import glob
    import os
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(path.replace("file:", "") + "/base-*/*/*.parquet")
            + glob.glob(path.replace("file:", "") + "/delta-*/*/*.parquet")}


def test_bucketed_refresh_writes_in_proportion_to_the_change(spark):
    from orderlens.sources.buckets import read_bucketed, refresh_buckets, write_bucketed
    path = scratch_path(spark, "t-buckets")
    rows = [(i, "old", 0) for i in range(200)]
    write_bucketed(spark.createDataFrame(rows, "id int, s string, v int"), path, ["id"], 32)
    before = bucket_files(path)
    changes = spark.createDataFrame([(3, "new", 1), (4, "new", -1), (500, "new", 1)], "id int, s string, v int")
    keys = spark.createDataFrame([(i,) for i in range(200) if i != 7] + [(500,)], "id int")
    n = refresh_buckets(spark, path, changes, keys, lambda s, t: s("v") > t("v"))
    assert n["deleted"] == 1 and n["changes"] == 3 and n["inserted"] == 1 and n["buckets"] <= 3 and n["compared"] == 1
    after = bucket_files(path)
    assert all(after[f] == before[f] for f in before if f in after) and len(set(before) - set(after)) <= n["rewritten"]
    got = {r.id: (r.s, r.v) for r in read_bucketed(spark, path).collect()}
    want = {i: ("old", 0) for i in range(200) if i != 7}
    assert got == {**want, 3: ("new", 1), 500: ("new", 1)}
    # nothing to do writes nothing and compares no key; a NULL view key blocks deletes
    again = refresh_buckets(spark, path, changes.limit(0), keys, lambda s, t: F.lit(True))
    assert again["buckets"] == 0 and again["compared"] == 0 and bucket_files(path) == after
    null_key = keys.where("id > 100").unionByName(spark.createDataFrame([(None,)], "id int"))
    assert refresh_buckets(spark, path, changes.limit(0), null_key, lambda s, t: F.lit(True))["deleted"] == 0
    refresh_buckets(spark, path, changes.limit(0), keys.where("id = 9"), lambda s, t: F.lit(True))
    assert [r.id for r in read_bucketed(spark, path).collect()] == [9]
    assert refresh_buckets(spark, path, changes, keys.limit(0), lambda s, t: F.lit(True))["deleted"] == 4
    assert read_bucketed(spark, path).count() == 0


def test_buckets_split_with_the_table(spark):
    from orderlens.sources import buckets as B
    path = scratch_path(spark, "t-split")
    df = spark.range(1000).selectExpr("id", "id * 2 as v")
    B.write_bucketed(df.where("id < 100"), path, ["id"], 1, bucket_rows=60)
    assert len(B._load(spark, path).buckets) >= 2
    B.merge_buckets(spark, path, ["id"], 1, df, lambda s, t: s("v") > t("v"), bucket_rows=60)
    layout = B._load(spark, path)
    assert len(layout.buckets) >= 16 and all(b.rows <= 60 and not b.deltas for b in layout.buckets.values())
    assert sum(2.0 ** -b.depth for b in layout.buckets.values()) == 1.0
    assert B.read_bucketed(spark, path).exceptAll(df).count() == 0 and B.read_bucketed(spark, path).count() == 1000
    assert sum(b.print[0] for b in layout.buckets.values()) == 1000


def test_many_deltas_keep_the_newest_and_are_compacted(spark):
    from orderlens.sources import buckets as B
    path = scratch_path(spark, "t-deltas")
    B.write_bucketed(spark.range(400).selectExpr("id", "0L as v"), path, ["id"], 2)
    want = {i: 0 for i in range(400)}
    for step in range(1, 9):
        ids = [i for i in range(400) if i % 50 == step]
        rows = [(i, step) for i in sorted({*ids, 5})]
        B.merge_buckets(spark, path, ["id"], 2, spark.createDataFrame(rows, "id long, v long"), lambda s, t: s("v") > t("v"))
        want.update(dict(rows))
        keep = [i for i in want if i != 300 + step]
        want = {i: want[i] for i in keep}
        B.refresh_buckets(spark, path, spark.createDataFrame([], "id long, v long"),
                          spark.createDataFrame([(i,) for i in keep], "id long"), lambda s, t: F.lit(True))
        assert {r.id: r.v for r in B.read_bucketed(spark, path).collect()} == want
    layout = B._load(spark, path)
    assert sum(b.rows for b in layout.buckets.values()) == len(want)


def test_a_job_that_dies_before_publishing_leaves_the_old_table(spark, monkeypatch):
    import pytest
    from orderlens.sources import buckets as B
    path = scratch_path(spark, "t-dead")
    B.write_bucketed(spark.range(50).selectExpr("id", "'a' as s"), path, ["id"], 4)
    changes = spark.range(40, 60).selectExpr("id", "'b' as s")
    keys = spark.range(10, 60)
    with monkeypatch.context() as m:
        def dies(*args):
            raise RuntimeError("driver lost")
        m.setattr(B, "publish", dies)
        with pytest.raises(RuntimeError):
            B.refresh_buckets(spark, path, changes, keys, lambda s, t: F.lit(True))
    assert sorted((r.id, r.s) for r in B.read_bucketed(spark, path).collect()) == [(i, "a") for i in range(50)]
    assert B.refresh_buckets(spark, path, changes, keys, lambda s, t: F.lit(True))["deleted"] == 10
    assert sorted((r.id, r.s) for r in B.read_bucketed(spark, path).collect()) == [
        (i, "a" if i < 40 else "b") for i in range(10, 60)]
    B.prune_buckets(spark, path, keep=1)                                # also the files of the run that died
    used = {n for b in B._load(spark, path).buckets.values() for n in [b.base, *b.deltas]}
    assert {f.split("/")[-3] for f in bucket_files(path)} <= used
    assert B.read_bucketed(spark, path).count() == 50


def test_colliding_fingerprints_are_told_by_the_second_hash_or_the_count(spark, monkeypatch):
    from orderlens.sources import buckets as B
    path = scratch_path(spark, "t-prints")
    true = B.key_hashes
    monkeypatch.setattr(B, "key_hashes", lambda keys: (F.lit(0).cast("long"), true(keys)[1]))
    B.write_bucketed(spark.range(20).selectExpr("id", "1 as v"), path, ["id"], 1)
    none = spark.createDataFrame([], "id long, v int")
    swapped = spark.range(21).where("id <> 4")                           # same count, same first hash
    assert B.refresh_buckets(spark, path, none, swapped, lambda s, t: F.lit(True))["deleted"] == 1
    monkeypatch.setattr(B, "key_hashes", lambda keys: (F.lit(0).cast("long"), F.lit(0).cast("long")))
    B.write_bucketed(spark.range(20).selectExpr("id", "1 as v"), path + "2", ["id"], 1)
    assert B.refresh_buckets(spark, path + "2", none, spark.range(19), lambda s, t: F.lit(True))["deleted"] == 1


def test_null_keys_replace_nothing(spark):
    from orderlens.sources import buckets as B
    path = scratch_path(spark, "t-null-keys")
    rows = [(1, "a"), (None, "a"), (None, "b")]
    B.write_bucketed(spark.createDataFrame(rows, "id long, s string"), path, ["id"], 2)
    B.merge_buckets(spark, path, ["id"], 2, spark.createDataFrame([(None, "c"), (2, "c")], "id long, s string"), lambda s, t: F.lit(True))
    n = B.refresh_buckets(spark, path, spark.createDataFrame([(None, "d")], "id long, s string"), spark.range(2, 3), lambda s, t: F.lit(True))
    assert n["deleted"] == 1
    got = sorted((r.id or 0, r.s) for r in B.read_bucketed(spark, path).collect())
    assert got == [(0, "a"), (0, "b"), (0, "c"), (0, "d"), (2, "c")]


def test_stream_upsert_rewrites_touched_buckets(spark):
    from orderlens.sources.buckets import read_bucketed
    ev = Tables(spark, SF01).events.select(
        F.when(F.col("event_id") % 50 == 0, F.lit(None)).otherwise(F.col("user_id")).alias("user_id"),
        "event_type", "ts", "event_id")
    feed = stage_feed(spark, ev, 3, "t-feed-buckets")
    changes = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(feed)
    base = scratch_path(spark, "t-latest-buckets")
    q = stream_upsert(changes, base, LATEST_SCHEMA, ["user_id"], ["ts", "event_id"], latest_guard,
                      checkpoint=scratch_path(spark, "t-ckpt-buckets"), buckets=4)
    q.awaitTermination()
    got = read_bucketed(spark, base).select("user_id", "event_type", "ts", "event_id")
    want = latest_per_key(ev, "user_id", ["ts", "event_id"], ["event_type", "ts", "event_id"])
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == want.count()


def test_late_scans_land_from_state_across_a_restart(spark):
    import datetime as dt

    from pyspark.sql.types import TimestampNTZType

    from orderlens.plans.streams import SCAN_SCHEMA
    from orderlens.sources.buckets import read_bucketed
    from orderlens.streaming.refresh import late_matches
    day = lambda n, h=0: dt.datetime(2020, 1, 1) + dt.timedelta(days=n, hours=h)
    o_schema = StructType([StructField("order_id", LongType()), StructField("serial", LongType()), StructField("order_ts", TimestampNTZType())])
    s_schema = StructType([StructField("scan_serial", LongType()), StructField("scan_ts", TimestampNTZType())])
    o_path, s_path = scratch_path(spark, "t-orders"), scratch_path(spark, "t-scans")
    base, ckpt = scratch_path(spark, "t-late"), scratch_path(spark, "t-late-ckpt")

    def arrive(orders, scans):
        spark.createDataFrame(orders, o_schema).coalesce(1).write.mode("append").parquet(o_path)
        spark.createDataFrame(scans, s_schema).coalesce(1).write.mode("append").parquet(s_path)
        o = spark.readStream.schema(o_schema).parquet(o_path)
        s = spark.readStream.schema(s_schema).parquet(s_path)
        pairs = late_matches(o, s, [("serial", "scan_serial")], "order_ts", "scan_ts").select("order_id", "scan_ts")
        q = stream_upsert(pairs, base, SCAN_SCHEMA, ["order_id"], ["scan_ts"], lambda a, b: a("scan_ts") > b("scan_ts"),
                          checkpoint=ckpt, buckets=1)                      # the same checkpoint: a restarted query
        q.awaitTermination()
        return q

    orders = [(1, 10, day(0)), (2, 20, day(0)), (3, 30, day(0)), (4, None, day(0))]
    scans = [(10, day(0, 5)), (99, day(1)), (None, day(1))]
    arrive(orders, scans)
    later = [(10, day(13)), (20, day(13)), (30, day(15))]                  # 13 and 15 days late
    arrive([(5, 30, day(12))], later)
    arrive([(6, 60, day(40))], [(60, day(41)), (20, day(41))])
    q = arrive([], [])
    got = {r.order_id: r.scan_ts for r in read_bucketed(spark, base).collect()}
    every_o = orders + [(5, 30, day(12)), (6, 60, day(40))]
    every_s = scans + later + [(60, day(41)), (20, day(41))]
    want = {}
    for oid, k, t in every_o:
        hits = [u for j, u in every_s if j is not None and j == k and t <= u <= t + dt.timedelta(days=14)]
        if hits:
            want[oid] = max(hits)
    assert got == want == {1: day(13), 2: day(13), 5: day(15), 6: day(41)}
    assert q.lastProgress is None or sum(op.numRowsTotal for op in q.lastProgress.stateOperators) <= 4   # old rows left the state


def test_stream_derive_on_a_folder(spark):
    from orderlens.plans.streams import run_stream_derive
    folder = scratch_path(spark, "t-folder")
    spark.read.parquet(f"{SF01}/events.parquet").limit(500).repartition(3).write.parquet(folder + "/events.parquet")
    assert run_stream_derive(spark, folder).count() == 500


def test_keys_of_the_order_view_without_its_lookups(spark):
    from orderlens.plans import driver
    from orderlens.plans.order_view import order_view, order_view_keys
    roles, cfg = driver._order_view_roles(driver._t(spark, SF01)), driver._order_view_config(**driver.ORDER_TABLE_EXTRA)
    want = order_view(**roles, cfg=cfg).select(*driver.ORDER_TABLE_KEYS).distinct()
    got = order_view_keys(**{k: roles[k] for k in ("header", "lines", "items", "contacts")}, cfg=cfg, keys=driver.ORDER_TABLE_KEYS)
    assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_refresh_by_functions_deletes_also_where_a_bucket_is_merged_whole(spark):
    from orderlens.sources.buckets import read_bucketed, refresh_buckets, write_bucketed
    path = scratch_path(spark, "t-buckets-fn")
    write_bucketed(spark.range(200).select("id", F.lit(0).alias("v")), path, ["id"], 4)
    changes = lambda: spark.range(250).select("id", F.lit(1).alias("v")).where("id % 10 <> 3")
    n = refresh_buckets(spark, path, changes, lambda: changes().select("id"), lambda s, g: F.lit(True))
    assert n["deleted"] == 20 and n["inserted"] == 45 and n["rewritten"] > 0
    assert sorted(map(tuple, read_bucketed(spark, path).collect())) == [(i, 1) for i in range(250) if i % 10 != 3]
