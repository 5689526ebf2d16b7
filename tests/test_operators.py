"""Operator semantics on hand-made tables (FIXTURES.md section 2, SURVEY section 5)."""

import datetime as dt
import decimal
import itertools
import random

import pytest
from pyspark.sql import functions as F

from orderlens import operators as O
from orderlens.functions import change_guard


def _nkey(r):
    return tuple((x is None, x if x is not None else 0) for x in r)


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=_nkey)


def test_strict_latest(spark):
    df = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, "b"), (2, 3, "x"), (2, 3, "y"), (3, None, "z")],
        "k int, rev int, st string")
    got = rows(O.strict_latest(df, "k", "rev", "st"))
    assert got == [(1, "B"), (2, None)]        # key 3: no revision -> no row (lookup gives NULL)


def test_latest_per_key_equals_row_number(spark):
    random.seed(3)
    data = [(random.randint(0, 5), random.randint(0, 3), i, f"v{i}") for i in range(200)]
    df = spark.createDataFrame(data, "k int, ts int, id int, v string")
    got = rows(O.latest_per_key(df, "k", ["ts", "id"], ["v"]))
    best = {}
    for k, ts, i, v in data:
        if k not in best or (ts, i) > best[k][0]:
            best[k] = ((ts, i), v)
    assert got == sorted((k, b[1]) for k, b in best.items())


def test_group_max_keeps_rows_and_null_group(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (None, 1), (None, 0), (2, None)], "k int, f int")
    got = rows(O.group_max(df, "f", "k", "m"))
    assert got == rows(spark.createDataFrame(
        [(1, 0, 1), (1, 1, 1), (None, 1, 1), (None, 0, 1), (2, None, None)], "k int, f int, m int"))


def test_merge_upsert_truth_table(spark):
    tgt = spark.createDataFrame(
        [(1, "a", 10), (2, "b", 10), (3, "c", None), (4, "d", 10)], "id int, st string, upd int")
    src = spark.createDataFrame(
        [(1, "A", 11), (2, "B", 10), (3, "C", 5), (5, "E", 1)], "id int, st string, upd int")
    out = O.merge_upsert(tgt, src, ["id"], lambda s, t: s("upd") > t("upd"))
    # 1 newer -> update; 2 same -> keep; 3 target NULL -> unknown -> keep; 4 untouched; 5 insert
    assert rows(out) == [(1, "A", 11), (2, "b", 10), (3, "c", None), (4, "d", 10), (5, "E", 1)]


def test_merge_upsert_duplicate_source_key_raises(spark):
    tgt = spark.createDataFrame([(1, "a")], "id int, st string")
    src = spark.createDataFrame([(1, "x"), (1, "y")], "id int, st string")
    with pytest.raises(Exception, match="duplicate key"):
        O.merge_upsert(tgt, src, ["id"], lambda s, t: F.lit(True)).collect()


def test_delete_missing_null_aware(spark):
    tgt = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    s_null = spark.createDataFrame([(1,), (None,)], "id int")
    s_one = spark.createDataFrame([(1,)], "id int")
    s_empty = spark.createDataFrame([], "id int")
    key = lambda df: sorted(r[0] is None and -1 or r[0] for r in df.collect())
    assert key(O.delete_missing(tgt, s_null, "id")) == [-1, 1, 2]   # delete nothing
    assert key(O.delete_missing(tgt, s_one, "id")) == [-1, 1]       # delete 2 only
    assert key(O.delete_missing(tgt, s_empty, "id")) == []          # delete all


def test_incremental_twice_is_once(spark):
    tgt = spark.createDataFrame([(i, "old", i) for i in range(0, 20, 2)], "id int, st string, upd int")
    view = spark.createDataFrame([(i, "new", i + (i % 3)) for i in range(0, 30, 3)],
                                 "id int, st string, upd int")
    guard = lambda s, t: change_guard(s("upd"), t("upd"))
    once = O.incremental_refresh(tgt, view, "id", [F.col("upd") >= 0], guard)
    twice = O.incremental_refresh(once, view, "id", [F.col("upd") >= 0], guard)
    assert rows(once) == rows(twice)
    # a window covering everything gives the view itself when every row is newer or new
    assert {r[0] for r in once.collect()} == {r[0] for r in view.collect()}


def test_or_join_equals_nested_loop(spark):
    random.seed(7)
    left = [(i, random.randint(0, 4), random.choice([None, random.randint(0, 6)])) for i in range(40)]
    right = [(j, random.randint(0, 6), random.randint(0, 4)) for j in range(25)]
    l_df = spark.createDataFrame(left, "lid int, a int, b int")
    r_df = spark.createDataFrame(right, "rid int, ra int, rb int")
    got = rows(O.or_join(l_df, r_df, [("a", "rb"), ("b", "ra")], "left"), "lid", "rid")
    expect = []
    for lid, a, b in left:
        hits = [rid for rid, ra, rb in right if (a == rb) or (b is not None and b == ra)]
        expect += [(lid, rid) for rid in hits] or [(lid, None)]
    assert got == sorted(expect, key=_nkey)


def test_or_join_match_both_once(spark):
    l_df = spark.createDataFrame([(1, 5, 5), (2, 9, 9)], "lid int, a int, b int")
    r_df = spark.createDataFrame([(10, 5, 5)], "rid int, ra int, rb int")
    got = rows(O.or_join(l_df, r_df, [("a", "ra"), ("b", "rb")]), "lid", "rid")
    assert got == [(1, 10), (2, None)]


def test_or_join_three_conditions_types_and_repeated_rows(spark):
    r = random.Random(3)
    opt = lambda v: r.choice([None, v])
    left = [(r.randint(0, 5), opt(r.randint(0, 3)), opt(r.choice("xyz"))) for _ in range(30)]
    right = [(r.randint(0, 5), opt(r.randint(0, 3)), opt(r.choice("xyz"))) for _ in range(12)]
    conds = [("a", "ra"), ("b", "rb"), ("c", "rc")]
    l_df = spark.createDataFrame(left, "a int, b long, c string").repartition(3)
    r_df = spark.createDataFrame(right, "ra int, rb long, rc string")
    for how in ("left", "inner"):
        want = []
        for x in left:
            hits = [x + y for y in right if any(p is not None and p == q for p, q in zip(x, y))]
            want += hits or ([x + (None,) * 3] if how == "left" else [])
        assert rows(O.or_join(l_df, r_df, conds, how)) == sorted(want, key=_nkey)


def test_exists_flags_cost_one_join_per_column(spark):
    left = spark.createDataFrame([(1, 7, "a"), (2, None, "b"), (None, 8, "c"), (1, 7, "a")], "k int, j int, v string")
    docs = spark.createDataFrame([(1, "x"), (1, "y"), (None, "x"), (2, "y")], "d int, t string")
    flags = {"x": (docs.where("t = 'x'"), "k", "d"), "y": (docs.where("t = 'y'"), "k", "d"),
             "z": (spark.createDataFrame([(8,)], "e int"), "j", "e")}
    out = O.exists_flags(left, flags)
    assert out.columns == ["k", "j", "v", "x", "y", "z"]
    want = [(1, 7, "a", 1, 1, 0)] * 2 + [(2, None, "b", 0, 1, 0), (None, 8, "c", 0, 0, 1)]
    assert out._jdf.queryExecution().executedPlan().toString().count("Join") == 2
    assert rows(out) == sorted(want, key=_nkey)
    same = left
    for n, (df, a, b) in flags.items():
        same = O.exists_flag(same, df, a, b, n)
    assert rows(same) == rows(out)


def test_pivot_of_five_thousand_categories(spark):
    df = spark.range(20_000).selectExpr("id % 11 as h", "concat('C', cast(id * 7 % 5000 as string)) as cat")
    values = O.pivot_values(df, "cat")
    out = O.pivot_flags(df.where("id < 9000"), ["h"], "cat", values)
    assert len(values) == 5000 and len(out.columns) == 5001
    have = {(r.h, r.cat) for r in df.where("id < 9000").collect()}
    for r in out.collect():
        assert [v for v, x in zip(values, r[1:]) if x] == [v for v in values if (r.h, v) in have]


def test_pivot_over_several_bitmaps(spark):
    values = [f"v{i}" for i in range(70_000)]
    df = spark.createDataFrame([(1, "v0"), (1, "v32768"), (1, "v69999"), (2, "v32767"), (3, "other"), (None, None)], "k int, c string")
    got = {r.k: r.n for r in O.category_bitmaps(df, ["k"], "c", values).selectExpr(
        "k", "aggregate(map_values(bitmaps), 0L, (a, b) -> a + bitmap_count(b)) as n").collect()}
    assert got == {1: 3, 2: 1, 3: 0, None: 0}


def test_pivot_without_fill_keeps_nulls(spark):
    df = spark.createDataFrame([(1, "A"), (1, "A"), (2, "Z")], "h int, cat string")
    assert rows(O.pivot_flags(df, ["h"], "cat", ["A", "B"], fill=False)) == [(1, 1, None), (2, None, None)]


def test_exists_flag_never_multiplies(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    docs = spark.createDataFrame([(1,), (1,), (None,)], "k2 int")
    out = O.exists_flag(left, docs, "k", "k2", "dof")
    assert rows(out) == [(1, "a", 1), (2, "b", 0)]


def test_pivot_keeps_group_without_listed_category(spark):
    df = spark.createDataFrame([(1, "A"), (1, "B"), (2, "Z"), (3, None)], "h int, cat string")
    out = O.pivot_flags(df, ["h"], "cat", ["A", "B"])
    assert out.columns == ["h", "A", "B"]
    assert rows(out) == [(1, 1, 1), (2, 0, 0), (3, 0, 0)]


def test_pivot_rejects_non_identifiers(spark):
    df = spark.createDataFrame([(1, "a b;drop")], "h int, cat string")
    with pytest.raises(ValueError):
        O.pivot_flags(df, ["h"], "cat", ["a b;drop"])


def test_distinct_with_group_max_equals_window(spark):
    random.seed(11)
    data = [(random.randint(0, 4), random.randint(0, 1), random.choice([None, 1.5, 2.5]),
             random.choice("xyz")) for _ in range(80)]
    df = spark.createDataFrame(data, "h int, req int, price double, cat string")
    got = rows(O.distinct_with_group_max(df, "h", ["req", "price"], ["cat"]), "h", "req", "price", "cat")
    mx = {}
    for h, r, p, c in data:
        m = mx.setdefault(h, [None, None])
        m[0] = r if m[0] is None else max(m[0], r)
        if p is not None:
            m[1] = p if m[1] is None else max(m[1], p)
    assert got == sorted({(h, mx[h][0], mx[h][1], c) for h, _, _, c in data}, key=_nkey)


def test_reconcile_tree(spark):
    base = spark.range(5000).selectExpr("id", "id % 7 as a", "if(id % 11 = 0, null, cast(id as string)) as b", "id / 3 as c")
    plan = O.reconcile_tree(base, base, "id", ["a", "b", "c"])
    assert rows(plan) == [(5000, 0, 0, 0, 0, 0)]
    assert "Join" not in plan._jdf.queryExecution().toString()
    # one changed cell: only its column is compared, only the rows of its leaf are joined
    cell = base.selectExpr("id", "a", "if(id = 4321, 'x', b) as b", "c")
    one = O.reconcile_tree(base, cell, "id", ["a", "b", "c"])
    assert rows(one) == [(5000, 0, 0, 0, 1, 0)]
    assert "__o_b" in one._jdf.queryExecution().toString() and "__o_a" not in one._jdf.queryExecution().toString()
    # NULL against a value, in either direction
    gone = base.selectExpr("id", "a", "if(id in (10, 22), if(id = 10, null, ''), b) as b", "c")
    assert rows(O.reconcile_tree(base, gone, "id", ["a", "b", "c"])) == [(5000, 0, 0, 0, 2, 0)]


def test_reconcile_tree_equals_reconcile(spark):
    old = spark.range(3000).selectExpr("if(id = 5, null, id) as id", "id % 5 as a", "cast(id as string) as b")
    new = spark.range(40, 3100).selectExpr("if(id % 1000 = 7, null, id) as id", "id % 5 + if(id % 97 = 0, 1, 0) as a",
                                           "if(id % 13 = 0, null, cast(id as string)) as b")
    empty = old.limit(0)
    for x, y in ((old, new), (new, old), (old, empty), (empty, new), (empty, empty), (old, old)):
        want = rows(O.reconcile(x, y, "id", ["a", "b"]))
        shapes = [{"fanout": 4, "levels": 5}, {"fanout": 2, "levels": 1}, {"fanout": 16, "max_nodes": 2}]
        for shape in [{}] + shapes * (x is old and y is new):
            assert rows(O.reconcile_tree(x, y, "id", ["a", "b"], **shape)) == want
    other = old.selectExpr("cast(id as int) as id", "a", "b")
    assert rows(O.reconcile_tree(other, new, "id", ["a", "b"])) == rows(O.reconcile(other, new, "id", ["a", "b"]))


def test_reconcile_tree_has_no_list_of_nodes(spark):
    # every row differs: thousands of unequal leaves; they were a list of literals, in the plan and in each task
    old = spark.range(20_000).selectExpr("id", "id % 5 as a", "id as b")
    part = old.selectExpr("id", "a + 1 as a", "b").where("id % 3 > 0")
    some = old.selectExpr("id", "if(id < 3000, -1, a) as a", "b")
    for new in (part, some):
        tree = O.reconcile_tree(old, new, "id", ["a", "b"])
        plan = tree._jdf.queryExecution().optimizedPlan().toString()
        assert " INSET " not in plan and " IN (" not in plan and "LeftSemi" in plan
        assert rows(tree) == rows(O.reconcile(old, new, "id", ["a", "b"]))
    # all nodes of the last level differ: no node is picked
    tree = O.reconcile_tree(old, part, "id", ["a", "b"], fanout=16, levels=2)
    assert "LeftSemi" not in tree._jdf.queryExecution().optimizedPlan().toString()
    assert rows(tree) == [(20_000, 0, 6667, 13_333, 0)]


def test_reconcile_tree_differing_types(spark):
    # a column of other type hashes differently; its values are compared as the join compares them
    old = spark.range(300).selectExpr("id", "cast(id % 5 as int) as a")
    new = spark.range(300).selectExpr("id", "if(id = 7, 9, id % 5) as a")
    assert rows(O.reconcile_tree(old, new, "id", ["a"])) == [(300, 0, 0, 1)]


def test_reconcile(spark):
    old = spark.createDataFrame([(1, 1), (2, None), (3, 3)], "id int, upd int")
    new = spark.createDataFrame([(1, 1), (2, 2), (4, 4)], "id int, upd int")
    assert rows(O.reconcile(old, new, "id", ["upd"])) == [(4, 1, 1, 1)]


def test_with_counts(spark):
    df, obs = O.with_counts(spark.range(7), "step")
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 7


def test_duplicate_keys_and_assert_unique(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "a int, b int")
    assert rows(O.duplicate_keys(df, ["a", "b"])) == [(1, 1, 2)]
    with pytest.raises(ValueError):
        O.assert_unique(df, ["a", "b"])


def test_expand_by_list_in_blocks(spark):
    small = spark.createDataFrame([(i % 20000, f"v{i}") for i in range(25_000)], "j int, s string").repartition(7)
    out = O.expand_by_list(spark.range(3), small, block_rows=1000)
    p = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in p and "CartesianProduct" not in p
    want = sorted(tuple(r) for r in small.collect())
    got = sorted(tuple(r) for r in out.collect())
    assert len(got) == 75_000 and got == sorted((i, *w) for i in range(3) for w in want)
    cut = O.expand_by_list(spark.range(3), spark.range(20).withColumnRenamed("id", "j"), block_rows=10)
    assert sorted(tuple(r) for r in cut.collect()) == [(i, j) for i in range(3) for j in range(20)]


def test_expand_by_list_short(spark):
    out = O.expand_by_list(spark.range(3), spark.range(4).withColumnRenamed("id", "j"))
    assert out.columns == ["id", "j"]
    assert sorted(tuple(r) for r in out.collect()) == [(i, j) for i in range(3) for j in range(4)]
    assert O.expand_by_list(spark.range(3), spark.range(0).withColumnRenamed("id", "j")).count() == 0
    p = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in p and "CartesianProduct" not in p and "Exchange" not in p


def test_expand_by_list_keeps_types_and_nulls(spark):
    small = spark.createDataFrame(
        [(dt.date(2001, 10, 5), decimal.Decimal("1.50"), "a"), (None, None, None)],
        "d date, m decimal(10,2), s string")
    out = O.expand_by_list(spark.range(2), small)
    assert out.schema["d"].dataType == small.schema["d"].dataType
    assert out.schema["m"].dataType == small.schema["m"].dataType
    got = sorted(out.collect(), key=lambda r: (r["id"], r["s"] is None))
    assert [tuple(r) for r in got] == [
        (0, dt.date(2001, 10, 5), decimal.Decimal("1.50"), "a"), (0, None, None, None),
        (1, dt.date(2001, 10, 5), decimal.Decimal("1.50"), "a"), (1, None, None, None)]


def test_append_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "k int, s string")
    b = spark.createDataFrame([("y", 2, "d")], "s string, k int, detail string")
    assert rows(O.append_by_name(a, b), "k", "s", "detail") == [(1, "x", None), (2, "y", "d")]


_ = itertools


def test_left_join_many_equals_left_outer(spark):
    random.seed(5)
    left = [(i, random.choice([None, 0, 1, 2, 3])) for i in range(30)]
    right = [(j, random.choice([0, 0, 0, 0, 1, None]), j % 2) for j in range(40)]   # hot key 0
    l_df = spark.createDataFrame(left, "lid int, k int")
    r_df = spark.createDataFrame(right, "rid int, rk int, even int")
    got = rows(O.left_join_many(l_df, r_df, [("k", "rk")], F.col("even") == 0))
    want = rows(l_df.join(r_df.where("even = 0"), F.col("k") == F.col("rk"), "left"))
    assert got == want


def test_merge_upsert_several_null_source_keys_are_inserted(spark):
    tgt = spark.createDataFrame([(1, "a", 1), (None, "n", 1)], "id int, st string, upd int")
    src = spark.createDataFrame([(None, "x", 2), (None, "y", 3), (1, "b", 2)], "id int, st string, upd int")
    out = O.merge_upsert(tgt, src, ["id"], lambda s, t: s("upd") > t("upd"))
    assert rows(out) == rows(spark.createDataFrame(
        [(1, "b", 2), (None, "n", 1), (None, "x", 2), (None, "y", 3)], "id int, st string, upd int"))
