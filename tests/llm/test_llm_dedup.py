"""Substring, exact and near deduplication against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash

import cases
from orderlens.llm import automaton_dedup, exact_dedup, repeats, scan, simhash, suffix_dedup
from orderlens.llm.components import connected_components


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_suffix_dedup_equals_brute_force(spark):
    rows = cases.repeated(cases.texts())
    got = rows_of(suffix_dedup.suffix_dedup(cases.frame(spark, rows)))
    assert got == Counter(cases.byte_spans(rows, 50))


def test_suffix_dedup_other_length_and_texts(spark):
    rows = cases.texts(seed=3, n=30)
    df = suffix_dedup.suffix_dedup(cases.frame(spark, rows), length=9, gram=4, with_text=True)
    got = {r.doc_id: r for r in df.collect()}
    for d, n, gone, spans, sha in cases.byte_spans(rows, 9):
        assert (got[d].n_bytes, got[d].n_removed, got[d].n_spans, got[d].kept_sha256) == (n, gone, spans, sha)
        assert hashlib.sha256(bytes(got[d].kept)).hexdigest() == sha
        assert len(got[d].spans) == 2 * spans


def test_suffix_dedup_empty(spark):
    assert suffix_dedup.suffix_dedup(cases.empty(spark)).collect() == []


@pytest.mark.parametrize("alphabet", [1, 2, 256])
def test_two_stage_suffix_array(alphabet):
    r = np.random.default_rng(alphabet)
    s = r.integers(1, alphabet + 1, 300).astype(np.uint16)
    s[r.integers(0, 300, 8)] = 0
    s[-1] = 0
    depth = 20
    array = suffix_dedup.two_stage_suffix_array(s, depth)
    assert sorted(array.tolist()) == list(range(300))
    padded = s.tolist() + [0] * depth
    heads = [padded[i:i + depth] for i in array]
    assert heads == sorted(heads)
    lcp = suffix_dedup.common_prefixes(s, array, depth)
    for a, b, n in zip(heads, heads[1:], lcp[1:]):
        same = next((k for k in range(depth) if a[k] != b[k]), depth)
        assert n == same


def test_automaton_dedup_equals_brute_force(spark):
    rows = cases.texts()
    got = rows_of(automaton_dedup.automaton_dedup(cases.frame(spark, rows)))
    assert got == Counter(cases.word_spans(rows, 20))


def test_automaton_dedup_repeated_rows_and_null_ids(spark):
    rows = cases.texts(n=20)
    got = rows_of(automaton_dedup.automaton_dedup(cases.frame(spark, rows + [rows[1], (None, rows[1][1])])))
    exp = cases.word_spans(rows + [(None, rows[1][1])], 20)
    again = next(e for e in exp if e[0] == rows[1][0])
    assert got == Counter(exp + [again])
    assert automaton_dedup.automaton_dedup(cases.empty(spark)).collect() == []


def test_match_reference(spark):
    docs = cases.frame(spark, [(1, "a b c d e f"), (2, None), (3, "x c d e y b c d")])
    ref = spark.createDataFrame([("q b c d e",), (None,), ("zz",)], "text string")
    got = {r.doc_id: [tuple(s) for s in r.spans]
           for r in automaton_dedup.match_reference(docs, ref, window=3, most_words=4).collect()}
    assert got == {1: [(1, 5)], 2: [], 3: [(1, 4), (5, 8)]}


def test_exact_dedup_equals_brute_force(spark):
    rows = cases.repeated(cases.texts())
    df = exact_dedup.exact_dedup(cases.frame(spark, rows), salts=3)
    norm = [(d, (t or "").translate(cases.LOWER)) for d, t in rows]
    groups = {}
    for d, t in norm:
        groups.setdefault(t, []).append(d)
    got = df.collect()
    assert len(got) == len(rows)
    kept = Counter()
    for r in got:
        t = next(t for d, t in norm if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        ids = [d for d in groups[t] if d is not None]
        assert r.keep_id == max(ids, default=None) and r.group_size == len(groups[t])
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}
    left = exact_dedup.keep_one(cases.frame(spark, rows))
    assert left.columns[:2] == ["doc_id", "text"] and "_id" in left.columns
    assert sorted((t or "").translate(cases.LOWER) for t in (r.text for r in left.collect())) == sorted(groups)
    assert exact_dedup.exact_dedup(cases.empty(spark)).collect() == []


def brute_fingerprint(text):
    w = cases.words(text)
    sh = [" ".join(w)] if 0 < len(w) < 4 else [" ".join(w[i:i + 4]) for i in range(len(w) - 3)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << k for k in range(64) if sum(x >> k & 1 for x in h) * 2 > len(h))


def brute_components(fps, radius):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("chunk", [2048, 3])
def test_simhash_equals_brute_force(spark, chunk):
    rows = cases.repeated(cases.texts())
    base = cases.texts()[13][1] or "one two three four five six seven eight nine ten"
    rows += [(200 + i, base + " tail" * (i % 3)) for i in range(12)]
    fps = [brute_fingerprint(t) for _, t in rows]
    comp = brute_components(fps, 4)
    exp = Counter()
    for (d, _), f, c in zip(rows, fps, comp):
        ids = [x for (x, _), y in zip(rows, comp) if y == c and x is not None]
        exp[d, simhash._signed(f), min(ids, default=None)] += 1
    got = simhash.simhash_components(cases.frame(spark, rows), chunk=chunk).select("doc_id", "fp", "component_id")
    assert rows_of(got) == exp


def test_bit_sliced_distances():
    r = np.random.default_rng(1)
    a = r.integers(0, 1 << 63, 130, dtype=np.uint64)
    b = a[:20] ^ (np.uint64(1) << r.integers(0, 64, (3, 20)).astype(np.uint64))[0]
    for radius in (0, 1, 4, 7):
        got = simhash.within(simhash.planes_of(a), b, radius)[:, :130]
        assert got.tolist() == [[(int(x) ^ int(y)).bit_count() <= radius for x in a] for y in b]


def test_near_links_are_complete(spark):
    r = np.random.default_rng(5)
    base = r.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = list({int(x) for x in base} | {int(x) ^ sum(1 << int(k) for k in r.choice(64, r.integers(1, 7), False))
                                         for x in base for _ in range(4)})
    df = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    got = {r.node: r.root for r in connected_components(simhash.near_edges(df, chunk=4)).collect()}
    comp = brute_components(fps, 4)
    pairs = lambda c: {frozenset((i, j)) for i in range(len(fps)) for j in range(i) if c[i] == c[j]}
    mine = [got.get(simhash._signed(f), f"alone {f}") for f in fps]
    assert pairs(mine) == pairs(comp)


def test_near_dedup_keeps_one_of_each_component(spark):
    rows = cases.repeated(cases.texts(n=30))
    left = simhash.near_dedup(cases.frame(spark, rows))
    assert "xx" in left.columns
    comp = brute_components([brute_fingerprint(t) for _, t in rows], 4)
    assert left.count() == len(set(comp))
    assert simhash.near_dedup(cases.empty(spark)).collect() == []


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{100 + i: 100 for i in range(40)}}


def thue_morse(n, letters=("a", "b")):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


def test_long_words_with_structure_stay_apart(spark):
    one, two = thue_morse(1024), thue_morse(1024, ("b", "a"))
    shared = " ".join(f"w{i}" for i in range(19))
    rows = [(1, f"{shared} {one}"), (2, f"{shared} {two}"), (3, f"{shared} {one * 3}"), (4, f"{shared} {one * 3}"), (5, f"{shared} {one}")]
    got = rows_of(automaton_dedup.automaton_dedup(cases.frame(spark, rows)))
    assert got == Counter(cases.word_spans(rows, 20))
    bytes_got = rows_of(suffix_dedup.suffix_dedup(cases.frame(spark, rows)))
    assert bytes_got == Counter(cases.byte_spans(rows, 50))


def test_word_hashes_tell_words_apart():
    words = [b"a" * n for n in range(1, 40)] + [b"a" * n + b"\0" for n in range(1, 40)] + [thue_morse(n).encode() for n in (1024, 2048, 4096)]
    words += [thue_morse(n, ("b", "a")).encode() for n in (1024, 2048, 4096)] + [b"abcdefgh" * 2, b"abcdefghabcdefgi"]
    buf = np.frombuffer(b" ".join(words) + b" " + b" ".join(words), np.uint8)
    size = np.array([len(w) for w in words * 2])
    start = np.cumsum(size + 1) - size - 1
    got = scan.word_hashes(buf, start, start + size)
    half = len(words)
    assert (got[:half] == got[half:]).all() and len(set(got.tolist())) == len(set(words))


def test_segments_with_equal_hashes_are_compared(spark, monkeypatch):
    zero = lambda sums, start, end: np.zeros(len(start), np.uint64)
    monkeypatch.setattr(repeats, "range_hash", zero)
    monkeypatch.setattr(suffix_dedup, "range_hash", zero)
    rows = cases.repeated(cases.texts(n=30))
    assert rows_of(suffix_dedup.suffix_dedup(cases.frame(spark, rows))) == Counter(cases.byte_spans(rows, 50))


def test_span_rows_of_nine_million_documents():
    n = 9_000_000
    rid = np.arange(n)
    least = last = 0
    for batch in repeats.span_rows(rid, np.zeros(n, np.int64), np.full(n, 3), np.full(n, 7)):
        spans = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.int64).reshape(-1, 2)
        assert (spans == [3, 7]).all()
        assert batch.column(0)[0].as_py() == least
        least += batch.num_rows
    assert least == n
