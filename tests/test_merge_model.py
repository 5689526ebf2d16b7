"""Randomized checks of merge_upsert / delete_missing against a plain-Python
model of SQL MERGE and NOT IN (three-valued logic), NULLs included."""

import random

import pytest

from orderlens import operators as O


def _gt(a, b):
    return None if a is None or b is None else a > b


def model_delete(target, source_keys):
    """DELETE WHERE key NOT IN (source keys): delete only when the predicate is TRUE."""
    if not source_keys:
        return list(target)
    has_null = any(k is None for k in source_keys)
    kept = []
    for row in target:
        k = row[0]
        if k is None:
            kept.append(row)                      # NULL NOT IN (non-empty) -> unknown
        elif k in source_keys:
            kept.append(row)                      # FALSE
        elif has_null:
            kept.append(row)                      # unknown
    return kept


def model_merge(target, source):
    """MERGE ON key: matched and src.upd > tgt.upd -> update; not matched -> insert."""
    out = []
    by_key = {}
    for s in source:
        if s[0] is not None:
            by_key[s[0]] = s
    matched = set()
    for t in target:
        s = by_key.get(t[0]) if t[0] is not None else None
        if s is not None:
            matched.add(t[0])
            out.append(s if _gt(s[2], t[2]) else t)
        else:
            out.append(t)
    for s in source:
        if s[0] is None or s[0] not in {t[0] for t in target if t[0] is not None}:
            out.append(s)
    return out


def key(r):
    return tuple((x is None, x if x is not None else 0) for x in r)


@pytest.mark.parametrize("seed", range(6))
def test_delete_missing_model(spark, seed):
    rnd = random.Random(seed)
    target = [(rnd.choice([None, *range(8)]), f"t{i}") for i in range(12)]
    source = [(rnd.choice([None] * (seed % 2) + list(range(10))),) for _ in range(rnd.randint(0, 6))]
    tdf = spark.createDataFrame(target, "id int, v string")
    sdf = spark.createDataFrame(source, "id int")
    got = sorted((tuple(r) for r in O.delete_missing(tdf, sdf, "id").collect()), key=key)
    want = sorted(model_delete(target, [s[0] for s in source]), key=key)
    assert got == want


@pytest.mark.parametrize("seed", range(6))
def test_merge_upsert_model(spark, seed):
    rnd = random.Random(100 + seed)
    t_keys = rnd.sample(range(15), 8) + [None]
    s_keys = rnd.sample(range(15), 7) + [None] * (seed % 3)
    target = [(k, f"t{k}", rnd.choice([None, 1, 2, 3])) for k in t_keys]
    source = [(k, f"s{k}", rnd.choice([None, 1, 2, 3])) for k in s_keys]
    tdf = spark.createDataFrame(target, "id int, st string, upd int")
    sdf = spark.createDataFrame(source, "id int, st string, upd int")
    out = O.merge_upsert(tdf, sdf, ["id"], lambda s, t: s("upd") > t("upd"))
    got = sorted((tuple(r) for r in out.collect()), key=key)
    assert got == sorted(model_merge(target, source), key=key)
