"""Licence scan, scoring, encoding, URL rules, decontamination and the pipeline."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import cases
from orderlens.llm import bpe, decontaminate, license_scan, lm_score, queries, toxicity, url_filter
from conftest import SF001

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_license_base_phrases_equal_brute_force(spark):
    r = random.Random(2)
    vocab = "under the mit license apache version 2 cc by nc The MIT é the-mit x".split()
    rows = [(i, " ".join(r.choice(vocab) for _ in range(r.randint(0, 60)))) for i in range(80)]
    rows += [(90, "Under the MIT License. UNDER THE mit-license cc-by-nc/4.0 Apache License, Version 2.0"), (91, None),
             (92, "")]
    rows += [rows[0], (None, "cc by nc")]
    got = Counter(tuple(x) for x in license_scan.license_scan(cases.frame(spark, rows)).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect())
    exp = Counter()
    for d, t in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(cases.LOWER))
        hit = [(i, lab) for p, lab in license_scan.BASE_PHRASES.items() for i in range(len(w))
               if w[i:i + len(p.split())] == p.split()]
        at = [i for i, _ in hit]
        exp[d, len(w), len(hit), min(at, default=None), max(at, default=None),
            ",".join(sorted({lab for _, lab in hit}))] += 1
    assert got == exp
    assert license_scan.license_scan(cases.empty(spark)).collect() == []


def test_license_templates_in_pieces(spark):
    text = ("intro Permission is hereby granted free of charge to any person obtaining a copy of this SOMETHING software "
            "and associated documentation files to deal in the software without restriction end")
    got = license_scan.license_scan(cases.frame(spark, [(1, text), (2, "permission is hereby granted to nobody")]))
    got = {r.doc_id: r for r in got.collect()}
    assert got[1].labels == "mit" and got[1].base_labels == "" and got[1].score > 0.9
    assert got[2].labels == "" and 0 < got[2].score < 0.6


def test_matching_statistics_equal_brute_force():
    r = random.Random(4)
    for _ in range(20):
        temps = [("t", " ".join(r.choice("abc") for _ in range(r.randint(1, 12)))) for _ in range(3)]
        a = license_scan.LicenceAutomaton({}, temps)
        text = [r.choice(sorted(a.vocab)) for _ in range(40)]
        subs = {tuple(t.encode().split()[i:j]) for _, t in temps for i in range(12) for j in range(i + 1, 13)}
        for place, _, n in a.stream([a.vocab[w] for w in text]):
            assert n == max(k for k in range(place + 2) if k == 0 or tuple(text[place - k + 1:place + 1]) in subs)


def test_bpe_equals_the_library(spark):
    rows = cases.repeated(cases.texts(n=20)) + [(300, "<|endoftext|> a<|endoftext|>\u00a0 \U0001f600 don't"),
                                                (301, "q" * 500), (302, "0" * 70 + "  \n\n x")]
    lib = Tokenizer.from_file(PATH)
    lib.no_truncation(), lib.no_padding()
    exp = Counter()
    for d, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        exp[d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    docs = cases.frame(spark, rows)
    assert Counter(tuple(r) for r in bpe.encode_digests(docs, PATH).collect()) == exp
    back = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter((d, t or "") for d, t in rows)
    assert bpe.encode_digests(cases.empty(spark), PATH).collect() == []


def test_bpe_cache_turns_over(monkeypatch):
    b = bpe.BytePairs(PATH)
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    lib = Tokenizer.from_file(PATH)
    for t in ["some words here and there", "more words and more", "some words again there"] * 2:
        assert b.encode(t) == lib.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_with_an_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF001)
    rel = con.sql(queries.ORACLES[name])
    assert rel.columns == df.columns
    assert Counter(map(tuple, df.collect())) == Counter(rel.fetchall())


def test_url_edge_cases(spark):
    urls = [None, "", "nothing", "http://", "HTTP://Sub.NET/x?y", "https://net", "http://net/", "http://annet/",
            "http://a.example.net/en/1#t", "http://example.net/en", "http://x.org/fr/", "http://EXAMPLE.com/de/?q",
            "a://b.net/?u=://c.org/fr/", "http://u.net:80/", "x\ny://org/fr/z"]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)] + [(3, "http://", "h", "r"), (None, None, "", "")],
                                  "page_id long, url string, html string, rule string")
    got = url_filter.url_verdicts(pages, url_filter.rule_frame(spark)).collect()
    assert len(got) == len(urls) + 2
    by = {r.page_id: r for r in got}
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest).group().translate(cases.LOWER)
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        fit = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES
               if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit, default=(0, None, "allow"))
        assert (by[i].host, by[i].path, by[i].rule, by[i].verdict) == (host, path, best[1], best[2]), u
    assert url_filter.url_verdicts(pages.limit(0), url_filter.rule_frame(spark)).collect() == []


def test_lm_scores_equal_brute_force(spark):
    rows = [(d, t) for d, t in cases.texts(n=40)] + [(None, "no id here")]
    good = {0, 1, 5, 11, 100}
    docs = cases.frame(spark, rows)
    labels = spark.createDataFrame([(d, 1, 0) for d in good] + [(2, 0, 0), (1, 1, 1), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in lm_score.quality_scores(docs, labels).collect()}
    assert len(got) == len(rows)
    v = lm_score.vocabulary(docs.select(F.coalesce("text", F.lit("")).alias("text")))[0]
    true_v = len({w for _, t in rows for w in cases.words(t)})
    assert abs(v - true_v) <= max(2, 0.03 * true_v)
    count = [[Counter(), Counter()], [Counter(), Counter()]]
    for d, t in rows:
        w = cases.words(t)
        for a, b in zip(["^"] + w, w):
            for k in {0, int(d in good)}:
                count[k][0][a] += 1
                count[k][1][a, b] += 1
    for d, t in rows:
        w, r = cases.words(t), got[d]
        assert r.n_tokens == len(w)
        if not w:
            assert (r.target_loss, r.background_loss, r.score) == (None, None, 0.0)
            continue
        loss = [sum(-math.log2((c2[a, b] + 100 / v) / (c1[a] + 100)) for a, b in zip(["^"] + w, w)) / len(w)
                for c1, c2 in count]
        assert math.isclose(r.target_loss, loss[1], abs_tol=1e-9)
        assert math.isclose(r.background_loss, loss[0], abs_tol=1e-9)
        assert math.isclose(r.score, loss[1] - loss[0], abs_tol=1e-9)


def test_lm_scores_repeated_and_empty(spark):
    docs = cases.frame(spark, [(1, "a b"), (1, "a b"), (2, "a c")])
    got = Counter((r.doc_id, r.n_tokens) for r in lm_score.lm_scores(docs, F.col("doc_id") == 1).collect())
    assert got == Counter({(1, 2): 2, (2, 2): 1})
    assert lm_score.lm_scores(cases.empty(spark), F.lit(True)).collect() == []


def test_lm_scores_do_not_depend_on_the_slices(spark, monkeypatch):
    rows = cases.repeated(cases.texts(n=30))
    docs = cases.frame(spark, rows)

    def got():
        return sorted((r.doc_id is None, r.doc_id, r.n_tokens, round(r.target_loss or 0, 9), round(r.background_loss or 0, 9))
                      for r in lm_score.lm_scores(docs, F.col("doc_id") % 2 == 0, vocabulary_size=500).collect())

    whole = got()
    monkeypatch.setattr(lm_score, "SLICE_BYTES", 1)        # a slice a row; repeated rows are equal slices
    assert len(whole) == len(rows) and got() == whole


def test_codes_of_words_in_one_bucket_use_all_bits():
    h = np.random.default_rng(1).integers(0, 1 << 63, 2_000_000).astype(np.uint64)
    one = h[lm_score.mix(h) >> np.uint64(56) == 7]
    assert len(np.unique(lm_score.code_of(one) >> np.uint64(32))) == 256


def toxic_set(spark, n=400):
    r = random.Random(3)
    vocab = ["".join(r.choice("bdfgklmn") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        w = [r.choice(vocab) for _ in range(r.randint(5, 60))]
        y = i % 5 == 0
        if y:
            w[r.randrange(len(w))] = r.choice(["idiot", "zorquan", "zorqued", "zorqul"])
        rows.append((i, " ".join(w)))
        labels.append((i, 0, int(y)))
    rows += [(n, None), (n + 1, ""), (None, "you idiot"), (0, rows[0][1])]
    labels += [(n, 0, 0), (None, 0, 1), (3, 0, None)]
    return cases.frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


def test_toxicity_on_held_out_rows(spark):
    docs, labels, known = toxic_set(spark)
    got = toxicity.toxicity_scores(docs, labels).collect()
    assert len(got) == 404 and all(0 <= r.score <= 1 for r in got)
    truth = {d: y for d, _, y in known if y is not None}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    right = sum(r.predicted == truth[r.doc_id] for r in held)
    assert len(held) > 50 and right >= 0.97 * len(held)
    # the labels of held-out rows have no influence
    flip = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2,
                                             1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.toxicity_scores(docs, flip).collect()
    assert Counter((r.doc_id, round(r.score, 9)) for r in got) == Counter((r.doc_id, round(r.score, 9)) for r in again)


def test_small_groups_of_toxic_rows_keep_their_label():
    """Toxic rows that share no voter with the larger group are not overruled by it."""
    y = np.arange(300) % 5 == 0
    small = y & (np.arange(300) % 20 == 0)
    votes = np.column_stack([small] * 6 + [y & ~small] * 4).astype(int)
    assert (toxicity.label_model(votes, y.astype(int)) > 0.9).tolist() == y.tolist()


def test_toxicity_trains_alike_when_ids_are_too_many_to_broadcast(spark, monkeypatch):
    docs, labels, _ = toxic_set(spark, 150)
    one = toxicity.train(docs, labels)
    monkeypatch.setattr(toxicity, "BROADCAST_IDS", 0)
    two = toxicity.train(docs, labels)
    assert one.induced == two.induced and np.allclose(one.weights + [one.bias], two.weights + [two.bias], atol=1e-9)


def test_toxicity_without_labels(spark):
    docs, labels, _ = toxic_set(spark, 20)
    for some in (labels.limit(0), labels.filter("toxic = 0")):
        got = {r.doc_id: r.predicted for r in toxicity.toxicity_scores(docs, some).collect()}
        assert got[None] == 1 and got[21] == 0
    assert toxicity.toxicity_scores(docs.limit(0), labels).collect() == []
    left = toxicity.drop_toxic(docs, labels)
    assert left.columns == docs.columns


def test_toxicity_counts_all_training_rows(spark):
    n = 30_000
    ids = spark.range(n).select(F.col("id").alias("doc_id")).withColumn("trains", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    late = [r[0] for r in ids.filter("trains").orderBy(F.desc(F.xxhash64("doc_id"))).limit(8).collect()]
    mean = F.col("doc_id").isin(late)
    plain = F.concat(F.lit("plain words number "), (F.col("doc_id") % 50).cast("string"))
    docs = ids.select("doc_id", F.when(mean, F.concat(plain, F.lit(" zorquan"))).when(F.col("doc_id") % 25 == 0, F.concat(plain, F.lit(" idiot"))).otherwise(plain).alias("text"))
    labels = ids.select("doc_id", F.lit(0).alias("quality"), (mean | (F.col("doc_id") % 25 == 0)).cast("int").alias("toxic"))
    # the rows with the rare word come last by the hash of their id
    assert {"zorquan", "idiot"} <= set(toxicity.train(docs, labels).induced)


def test_toxicity_keeps_every_entry_over_the_bound(spark):
    words = ["q" + "".join("bdfgklmnpr"[int(c)] for c in f"{i:03d}") for i in range(330)]
    rows = [(i, words[i // 12] if i % 2 == 0 else "calm") for i in range(3960)]
    labels = spark.createDataFrame([(i, 0, int(i % 2 == 0)) for i, _ in rows], "doc_id long, quality int, toxic int")
    rows += [(10_000 + i, "calm") for i in range(20_000)]
    calm = spark.range(10_000, 30_000).selectExpr("id doc_id", "0 quality", "0 toxic")
    model = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), labels.unionByName(calm))
    train = [w for i, w in rows[:3960] if i % 2 == 0 and zlib.crc32(str(i).encode()) % 4 != 2]
    often = {w for w, k in Counter(train).items() if k >= 4}
    assert len(often) > 256 and often <= set(model.induced)


def test_vote_pairs_and_fit_match_tables_in_memory(spark):
    r = np.random.default_rng(5)
    v = (r.random((300, 8)) < 0.3).astype(np.int64)
    packed = [(np.flatnonzero(row).astype(np.int32).tobytes(),) for row in v]
    voted = spark.createDataFrame(packed, "v binary").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    both = np.zeros((8, 8), int)
    for row in toxicity.vote_pairs(voted).collect():
        both[row.i, np.frombuffer(row.others, np.int32)] = np.frombuffer(row.both, np.int64)
    assert (both == v.T @ v * (1 - np.eye(8, dtype=int))).all()
    target = r.random(300)

    def slope(w, b):
        z = v @ w + b
        return float((np.log1p(np.exp(z)) - target * z).sum()), v.T @ (toxicity.sigmoid(z) - target), float((toxicity.sigmoid(z) - target).sum())

    w, b = toxicity.fit_linear(slope, v.sum(axis=0), 300, float(target.mean()))
    _, by_voter, by_one = slope(w, b)
    assert np.abs(by_voter + 0.5 * w).max() < 0.05 and abs(by_one + 1e-3 * b) < 0.05


def test_label_model_discounts_copies_of_a_voter():
    for seed in range(3):
        r = np.random.default_rng(seed)
        y = r.random(2000) < 0.2
        voters = [(r.random(2000) < np.where(y, p, 0.05)).astype(int) for p in (0.8, 0.6, 0.6)]
        noise = (r.random(2000) < 0.3).astype(int)
        noted = np.where(r.random(2000) < 0.05, ~y, y).astype(int)
        one, ten = (toxicity.label_model(np.column_stack(voters + [noise] * k), noted) > 0.5 for k in (1, 10))
        assert (one == ten).mean() > 0.99
        assert (ten == y).mean() >= (noted == y).mean() - 0.005


def brute_tiling(item, text, least):
    free_a, free_b, total = [True] * len(item), [True] * len(text), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and free_a[i + n] and free_b[j + n] \
                        and item[i + n] == text[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return total
        free_a[i:i + n] = free_b[j:j + n] = [False] * n
        total += n


def test_tiling_covers_as_brute_force():
    r = random.Random(9)
    for _ in range(60):
        a = [r.randint(1, 6) for _ in range(r.randint(1, 30))]
        b = [r.randint(1, 6) for _ in range(r.randint(0, 40))]
        a, b = np.array(a, np.uint64), np.array(b, np.uint64)
        least = min(3, len(a))
        tiles = decontaminate.tiling(a, b, 3)
        assert all((a[i:i + n] == b[j:j + n]).all() and n >= least for i, j, n in tiles)
        assert sum(n for _, _, n in tiles) == brute_tiling(a.tolist(), b.tolist(), least)


def test_decontamination(spark):
    item = " ".join(f"w{i}" for i in range(24))
    parts = item.split()
    cut = " ".join(parts[12:]) + " other words between " + " ".join(parts[:12])
    rows = [(1, "lead " + item.upper().replace(" ", ", ") + " tail"), (2, cut), (3, " ".join(parts[:8]) + " and no more"),
            (4, None), (5, ""), (6, "tiny item"), (7, "x " * 3000 + item), (1, "clean text"), (None, item), (7, "x " * 3000 + item)]
    bench = spark.createDataFrame([(10, item, 1), (11, None, 1), (12, "", 1), (13, "tiny item", 1), (10, item, 1)],
                                  "item_id long, text string, doc_id int")
    for block in (5, 10_000):
        got = Counter(tuple(r) for r in decontaminate.decontamination_report(
            cases.frame(spark, rows), bench, block_words=block).select(
            "doc_id", "best_item", F.round("best_coverage", 3), "contaminated").collect())
        assert got == Counter({(1, 10, 1.0, True): 1, (2, 10, 1.0, True): 1, (3, 10, 0.333, False): 1,
                               (4, None, 0.0, False): 1, (5, None, 0.0, False): 1, (6, 13, 1.0, True): 1,
                               (7, 10, 1.0, True): 2, (1, None, 0.0, False): 1, (None, 10, 1.0, True): 1})
    docs = cases.frame(spark, rows)
    left = decontaminate.decontaminate(docs, bench)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [1, 3, 4, 5]
    assert decontaminate.decontaminate(docs, bench.limit(0)).count() == len(rows)
    assert decontaminate.decontamination_report(cases.empty(spark), bench).collect() == []


def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    start, cols = docs.count(), docs.columns
    seen = [start]
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(step(spark, docs, SF001), name)
        assert docs.columns == cols
        seen.append(docs.count())
    assert seen == sorted(seen, reverse=True) and seen[-1] < start
    texts = [r.text.translate(cases.LOWER) for r in docs.collect()]
    assert len(set(texts)) == len(texts)
    lib = Tokenizer.from_file(PATH)
    want = {r.doc_id: len(lib.encode(r.text, add_special_tokens=False).ids) for r in docs.collect()}
    got = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, SF001).collect()}
    assert got == want


def test_entry_registers_the_ten_queries_and_the_pipeline():
    import __spark_entry__ as e
    names = e.queries()
    assert "pipeline" in names and all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11))


def test_decontamination_query_reports_every_document(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = queries.op10_decontamination(spark, SF001)
    assert Counter(r.doc_id for r in got.select("doc_id").collect()) == Counter(r.doc_id for r in docs.select("doc_id").collect())
    assert got.filter("not contaminated").count() > 0


def test_license_chain_survives_a_fragment_before_it(spark):
    text = ("you may obtain a copy of the License at X. Licensed under the Apache License Version 2.0 FOO "
            "you may not use this file except BAR in compliance with the license")
    short = text.split("X. ")[1]
    got = {r.doc_id: r for r in license_scan.license_scan(cases.frame(spark, [(1, text), (2, short)])).collect()}
    assert got[1].labels == got[2].labels == "apache-2" and got[1].score >= got[2].score


def test_license_chains_equal_exhaustive_search():
    r = random.Random(6)
    for _ in range(200):
        class Scan(license_scan.LicenceAutomaton):
            def __init__(self):
                self.texts = [("t", ["w"] * 30, False), ("base", ["w"] * 9, True), ("u", ["w"] * 12, False)]
                self.ends = [[(k, r.randrange(10, 30 if k == 0 else 12)) for k in r.sample(range(3), r.randint(1, 3))] for _ in range(6)]
        s = Scan()
        matches, end = [], 8
        for _ in range(r.randint(1, 7)):
            end += r.randint(1, 9)
            matches.append((end, r.randrange(6), r.randint(5, 9)))
        matches = [m for i, m in enumerate(matches) if not i or m[0] - m[2] >= matches[i - 1][0] - matches[i - 1][2]]
        want = {}
        for k in (0, 2):
            places = [(e, last, n) for e, state, n in matches for t, last in s.ends[state] if t == k]

            def longest(e, last, n, places=places):
                after = [longest(*p) for p in places if 0 <= p[0] - p[2] - e <= 10 and last < p[1] - p[2] + 1]
                return n + max(after, default=0)
            if places:
                want[k] = max(longest(*p) for p in places) / len(s.texts[k][1])
        assert s._chains(matches, 10) == pytest.approx(want)


def test_decontamination_of_long_words_with_structure(spark):
    tm = lambda x, y: "".join((x, y)[bin(i).count("1") % 2] for i in range(1024))
    docs = spark.createDataFrame([(1, f"a b c d {tm('a', 'b')}"), (2, f"a b c d {tm('b', 'a')}")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, f"a b c d {tm('a', 'b')}")], "item_id long, text string")
    got = {r.doc_id: (r.contaminated, r.best_coverage or 0.0) for r in decontaminate.decontamination_report(docs, bench).collect()}
    assert got[1] == (True, 1.0) and not got[2][0] and got[2][1] < 1


def test_trees_side_by_side_equal_single_ones():
    b = bpe.BytePairs(PATH)
    r = random.Random(2)
    words = [bytes(r.choice(b" abcdefghinorst\xc3\xa9\x00") for _ in range(r.randint(2, 65))) for _ in range(400)] + [b"  ", b"aa" * 30, b"the" * 20]
    for w in words:
        size = 1 << (len(w) - 2).bit_length()
        ids = b.merge_many([w, w[:2]], size)
        for got, text in zip(ids, (w, w[:2])):
            assert [i for i in got.tolist() if i >= 0] == b.merge([b.byte_id[x] for x in text])
