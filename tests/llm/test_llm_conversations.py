"""Conversation repair and the prefix trie against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from orderlens.llm import conversation_repair as repair
from orderlens.llm import prefix_trie

EMPTY = hashlib.sha256(b"").hexdigest()
EXTRA = ["rid", "dig", "n", "first", "audits", "depth", "slot", "tail", "conv", "__id"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def conv_frame(spark, rows):
    schema = "conv_id long, turn long, role string, text string" + "".join(f", {c} string" for c in EXTRA)
    return spark.createDataFrame([tuple(r) + ("!",) * len(EXTRA) for r in rows], schema).repartition(4)


def conversations(seed=5, n=60):
    r = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    texts = ["Hi.", "Go on", "Yes!", "", " \t", None, "Well?  ", "é.", "x" * 3000]
    rows = []
    for c in range(n):
        turns = [None] * r.randint(0, 1) + sorted(r.sample(range(12), r.randint(1, 9)))
        for t in turns:
            rows.append((c, t, r.choice(roles[:5] if c % 3 else roles), r.choice(texts) if r.random() < .6 else f"{r.random()}."))
    for t in range(150):  # one long conversation, with equal rows standing together
        rows.append((1000, t // 2, "user" if t % 3 else "assistant", f"t{t}." if t % 7 else "again."))
    rows += [rows[0]] * 4 + [(None, 1, "user", "a."), (None, 2, "assistant", "b.")]
    return rows


def damaged(rows):
    out = []
    word = lambda v: " " if v is None else str(v)
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{word(c)}:{word(t)}".encode()) % 20
        role, text = word(role), word(text)
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(c, t, role, text)] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        last = text.rstrip(" \t\n\v\f\r")[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """Forward dynamic programme over whole (cost, audit) values, one row at a time."""
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", ())}

    def relax(to, state, value):
        if state not in to or value[:2] < to[state][:2]:
            to[state] = value

    def inserts(at):
        for _ in range(3):
            for s, (cost, audit, out) in list(at.items()):
                name = {"u": "user", "a": "assistant"}[follow[s]]
                relax(at, follow[s], (cost + 5, audit + "I", (*out, f"{name}:")))
        return at

    for (_, _, role, text), fault in zip(rows, found):
        to = {}
        for s, (cost, audit, out) in inserts(best).items():
            relax(to, s, (cost + 2, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            if role[:1] == follow[s] or (role[:1] == "s" and s == ""):
                relax(to, role[0], (cost + more, audit + "K", (*out, f"{role}:{text}")))
            name = {"u": "user", "a": "assistant"}[follow[s]]
            relax(to, follow[s], (cost + more + 1, audit + "R", (*out, f"{name}:{text}")))
        best = to
    return min((v for s, v in inserts(best).items() if s in ("", "a")), key=lambda v: v[:2])


def exhaustive(rows, found):
    """Every edit list with up to two insertions, judged by the regular expression."""
    best = None
    for picks in itertools.product("DKua", repeat=len(rows)):
        if any(p != "D" and f in ("blank", "duplicate") for p, f in zip(picks, found)):
            continue
        for places in [()] + [c for k in (1, 2) for c in itertools.combinations_with_replacement(range(len(rows) + 1), k)]:
            for kinds in itertools.product("ua", repeat=len(places)):
                initials, audit, cost = "", "", 0
                for i in range(len(rows) + 1):
                    for at, k in zip(places, kinds):
                        if at == i:
                            initials, audit, cost = initials + k, audit + "I", cost + 5
                    if i < len(rows):
                        p = picks[i]
                        audit += p if p in "DK" else "R"
                        cost += {"D": 2, "K": 0}.get(p, 1) + (5 if p != "D" and found[i] == "truncated" else 0)
                        initials += "" if p == "D" else (rows[i][2][:1] or "?") if p == "K" else p
                if re.fullmatch("(s?(ua)+)?", initials) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
    return best


def expected_repairs(rows):
    by = defaultdict(list)
    for r in damaged(rows):
        by[r[0]].append(r)
    out = []
    for c in {r[0] for r in rows}:
        got = sorted(by[c], key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
        found = faults(got)
        cost, audit, text = cheapest(got, found)
        turns = [t for _, t, _, _ in got if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        heads = [r[2][:1] for r in got]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(heads, heads[1:]))
        n = Counter(found)
        out.append((c, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, sha("\n".join(text))))
    return out


REPORT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("seed", [5, 6])
def test_repair_equals_brute_force(spark, seed):
    rows = conversations(seed)
    got = repair.damage_and_repair(conv_frame(spark, rows))
    assert got.columns == REPORT
    assert Counter(tuple(r) for r in got.collect()) == Counter(expected_repairs(rows))


def test_repair_in_small_pieces(spark):
    rows = conversations(9, 12)
    whole = repair.repair_report(repair.damage(conv_frame(spark, rows)))
    cut = repair.repair_report(repair.damage(conv_frame(spark, rows)), piece_rows=3)
    assert Counter(map(tuple, cut.select(REPORT).collect())) == Counter(map(tuple, whole.select(REPORT).collect()))
    assert {r[0] for r in expected_repairs(rows)} >= {r.conv_id for r in whole.collect()}


def test_plain_programme_equals_exhaustive_search():
    r = random.Random(1)
    for _ in range(60):
        rows = [(0, i, r.choice(["system", "user", "assistant", "tool"]), r.choice(["a.", "b", "", "c."])) for i in range(r.randint(0, 4))]
        found = faults(rows)
        assert cheapest(rows, found)[:2] == exhaustive(rows, found)


def test_grammar_unrolls_long_runs():
    g = repair.Grammar(*repair.COSTS)
    runs = [(repair.symbol(1, False), 1001), (repair.GONE, 10**12 // 10**9), (repair.symbol(2, True), 5)]
    rows = [(0, 0, "user", f"{i}.") for i in range(1001)] + [(0, 0, "x", "")] * 1000 + [(0, 0, "assistant", f"z{i}") for i in range(5)]
    audit, s = g.unroll(runs, g.final, repair.START)
    cost, want, _ = cheapest(rows, faults(rows))
    assert audit + g.finish(s) == want


def test_repaired_turns_are_well_formed(spark):
    rows = conversations(3)
    turns = repair.repaired_turns(conv_frame(spark, rows), piece_rows=5).collect()
    by = defaultdict(list)
    for t in turns:
        by[t.conv_id].append((t.pos, t.role[:1]))
    for got in by.values():
        assert [p for p, _ in sorted(got)] == list(range(len(got)))
        assert re.fullmatch("s?(ua)+", "".join(c for _, c in sorted(got)))


def test_repair_of_nothing(spark):
    empty = conv_frame(spark, [(1, 1, "user", "x")]).filter("false")
    assert repair.damage_and_repair(empty).collect() == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = repair.damage_and_repair(conv_frame(spark, [(gone, 0, "user", "x")])).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", EMPTY)]


def ordered(rows):
    by = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            by[c].append((t is not None, t or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(got, key=lambda x: (x[0], x[1], x[2].encode(), hashlib.sha256(x[3].encode()).digest()))]
            for c, got in by.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def expected_trie(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, got in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(got) - 1) * len(k[-1][1].encode()) if k else 0
    return Counter(
        (min(got), len(k), min(members[k[:-1]]) if k else None, len(got), children[k], leaves[k], saved[k],
         sha(",".join(str(c) for c in sorted(got) if len(convs[c]) == len(k))))
        for k, got in members.items())


def shared_conversations(seed=2):
    r = random.Random(seed)
    rows, tree = [], [[]]
    for c in range(90):
        start = r.choice(tree)
        own = start[:r.randint(0, len(start))] + [(r.choice(["user", "assistant", None]), r.choice(["a", "bé", "", None, "c" * 500]))
                                                   for _ in range(r.randint(0, 4))]
        tree.append(own)
        rows += [(c if c % 7 else c * 1000, t if t else None, *x) for t, x in enumerate(own or [("user", "only")])]
    for c in (5000, 5001, 5002):  # long equal conversations, over several blocks
        rows += [(c, t, "user", f"{t % 11}") for t in range(60 + (c == 5002))]
    return rows + rows[:3] + [(None, 1, "user", "nobody")] + [(c, 0, "user", "same") for c in range(6000, 6040)]


TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def test_trie_equals_brute_force(spark):
    rows = shared_conversations()
    got = prefix_trie.rebuilt_trie(conv_frame(spark, rows))
    assert got.columns == TRIE
    assert Counter(map(tuple, got.collect())) == expected_trie(rebuilt(ordered(rows)))


@pytest.mark.parametrize("block", [1, 7])
def test_trie_in_blocks_and_under_a_crowded_sketch(spark, block, monkeypatch):
    rows = shared_conversations(4)
    monkeypatch.setattr(prefix_trie, "MIN_CELLS", 64)
    monkeypatch.setattr(prefix_trie, "SLICE", 16)
    turns = prefix_trie.turns_in_order(conv_frame(spark, rows))
    total = turns.groupBy("conv_id").agg({"pos": "max"}).withColumnRenamed("max(pos)", "total")
    nodes = prefix_trie.trie_nodes(prefix_trie.prefixes(turns, total, block), max_cells=64, block=block)
    assert Counter(map(tuple, nodes.select(TRIE).collect())) == expected_trie(ordered(rows))


def test_trie_of_one_and_of_nothing(spark):
    one = [(3, 1, "user", "x"), (3, 2, "assistant", "y")]
    got = prefix_trie.conversation_trie(conv_frame(spark, one)).select(TRIE)
    assert Counter(map(tuple, got.collect())) == expected_trie(ordered(one))
    assert prefix_trie.rebuilt_trie(conv_frame(spark, one).filter("false")).collect() == []


def test_sketch_screens_single_prefixes(spark):
    turns = prefix_trie.turns_in_order(conv_frame(spark, shared_conversations()))
    total = turns.groupBy("conv_id").agg({"pos": "max"}).withColumnRenamed("max(pos)", "total")
    paths = prefix_trie.prefixes(turns, total)
    flags = prefix_trie.screened(paths).collect()
    n = Counter(bytes(r.dig) for r in flags)
    assert not any(r.alone and n[bytes(r.dig)] > 1 for r in flags)
    single = [r.alone for r in flags if n[bytes(r.dig)] == 1]
    assert len(single) > 50 and sum(single) > 0.9 * len(single)
