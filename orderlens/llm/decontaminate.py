"""Benchmark decontamination by greedy string tiling.

A passage of the benchmark may stand in a document cut up, reordered or reflowed.
Words (ASCII-lower-cased runs of letters, digits and non-ASCII characters) are
compared as hashes.  Seeds are windows of ``min_tile`` words that a document shares
with a benchmark item.  For each (document, item) pair with a seed, greedy tiling
runs: Karp-Rabin window hashes find the places where both agree, the longest
non-overlapping matches are marked as tiles, and this repeats on the unmarked words
until no match of ``min_tile`` words is left.  The share of the item's words under
tiles is its coverage; a document is contaminated when an item's coverage reaches
``threshold``.

The benchmark is sent to the executors in blocks of at most ``block_words`` words
each, so a broadcast never exceeds that whatever its size; each block scans the
documents once and a document's results are combined by aggregation.

Defined cases: null and empty texts match nothing; an item shorter than
``min_tile`` words is compared as one window of all its words; null and empty items
are left out; equal items each count; an empty benchmark contaminates nothing;
repeated documents each get a row; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import keep_rows
from orderlens.llm.scan import pieces, utf8, window_hash, word_hashes, words

MIN_TILE, THRESHOLD, BLOCK_WORDS = 5, 0.5, 2_000_000

IS_WORD = np.zeros(256, bool)
IS_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
FOLD = np.arange(256, dtype=np.uint8)      # lower-cases A-Z
FOLD[65:91] += 32


def _tokens(buf: np.ndarray, offsets: np.ndarray):
    low = FOLD[buf]
    start, end, doc = words(low, offsets, IS_WORD)
    return (word_hashes(low, start, end) if len(start) else np.empty(0, np.uint64)), doc


def _runs(a: np.ndarray, b: np.ndarray, free_a: np.ndarray, free_b: np.ndarray, least: int):
    """Maximal matches of unmarked words: (length, start in a, start in b), longest first."""
    ha, hb = window_hash(a, least), window_hash(b, least)
    if not len(ha) or not len(hb):
        return []
    order = np.argsort(hb, kind="stable")
    lo, hi = np.searchsorted(hb[order], ha, "left"), np.searchsorted(hb[order], ha, "right")
    found = []
    for i in np.flatnonzero(hi > lo).tolist():
        for j in order[lo[i]:hi[i]].tolist():
            if i and j and free_a[i - 1] and free_b[j - 1] and a[i - 1] == b[j - 1]:
                continue                                  # part of a match that starts earlier
            n, most = 0, min(len(a) - i, len(b) - j)
            while n < most and free_a[i + n] and free_b[j + n] and a[i + n] == b[j + n]:
                n += 1
            if n >= least:
                found.append((-n, i, j))
    return sorted(found)


def tiling(item: np.ndarray, text: np.ndarray, min_tile: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two word sequences: (start in item, start in text, length)."""
    least = max(1, min(min_tile, len(item)))
    free_a, free_b = np.ones(len(item), bool), np.ones(len(text), bool)
    tiles = []
    while True:
        marked = 0
        for n, i, j in _runs(item, text, free_a, free_b, least):
            if marked and -n < marked:
                break                                     # only the longest matches of this round
            if free_a[i:i - n].all() and free_b[j:j - n].all():
                free_a[i:i - n] = free_b[j:j - n] = False
                tiles.append((i, j, -n))
                marked = -n
        if not marked:
            return tiles


def _near_seeds(text: np.ndarray, at: np.ndarray, reach: int) -> np.ndarray:
    """The words within ``reach`` of a seed, groups kept apart by a value no word has."""
    at = np.unique(at)
    cut = np.flatnonzero(np.concatenate([[True], at[1:] - at[:-1] > 2 * reach]))
    out = []
    for a, b in zip(at[cut], at[np.append(cut[1:], len(at)) - 1]):
        out += [text[max(0, a - reach):b + reach + 1], np.zeros(1, np.uint64)]
    return np.concatenate(out)


class _Index:
    """The seeds of one block of benchmark items."""

    def __init__(self, items: list[tuple[int, bytes]], min_tile: int):
        self.min_tile = min_tile
        self.ids, self.words = [], []
        seeds, owner = {}, {}
        for item_id, text in items:
            buf = np.frombuffer(text, np.uint8)
            tok, _ = _tokens(buf, np.array([0, len(buf)]))
            if not len(tok):
                continue
            n = min(min_tile, len(tok))
            k = len(self.ids)
            self.ids.append(item_id)
            self.words.append(tok)
            seeds.setdefault(n, []).append(window_hash(tok, n))
            owner.setdefault(n, []).append(np.full(len(tok) - n + 1, k))
        self.tables = []
        for n in seeds:
            h, o = np.concatenate(seeds[n]), np.concatenate(owner[n])
            order = np.argsort(h, kind="stable")
            h, o = h[order], o[order]
            filled = np.zeros(1 << 20, bool)               # a first, cheap look
            filled[(h >> np.uint64(44)).astype(np.int64)] = True
            self.tables.append((n, h, o, filled))

    def seeds(self, tok: np.ndarray, doc: np.ndarray):
        """(document, item, place) of every shared window of a piece."""
        docs, items, places = [], [], []
        for n, h, o, filled in self.tables:
            w = window_hash(tok, n)
            if not len(w):
                continue
            at = np.flatnonzero(filled[(w >> np.uint64(44)).astype(np.int64)] & (doc[:len(w)] == doc[n - 1:]))
            lo, hi = np.searchsorted(h, w[at], "left"), np.searchsorted(h, w[at], "right")
            many = hi - lo
            at, lo, many = at[many > 0], lo[many > 0], many[many > 0]
            rank = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            docs.append(np.repeat(doc[at], many))
            items.append(o[np.repeat(lo, many) + rank])
            places.append(np.repeat(at, many))
        if not docs:
            return (np.empty(0, np.int64),) * 3
        return np.concatenate(docs), np.concatenate(items), np.concatenate(places)


def _block_scan(docs: DataFrame, items: list[tuple[int, bytes]], min_tile: int) -> DataFrame:
    """(row key, item_id, item words, covered words) of pairs that share a seed."""
    sent = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches):
        index = _Index(sent.value, min_tile)
        for b in batches:
            buf, offsets = utf8(b.column(2))
            out = []
            for first, last in pieces(offsets):
                lo = offsets[first]
                tok, doc = _tokens(buf[lo:offsets[last]], offsets[first:last + 1] - lo)
                d, k, p = index.seeds(tok, doc)
                order = np.lexsort((p, k, d))
                d, k, p = d[order], k[order], p[order]
                cut = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (k[1:] != k[:-1])])) if len(d) else []
                bounds = np.append(cut, len(d)).astype(int)
                spans = np.searchsorted(doc, np.arange(last - first + 1))
                for a, z in zip(bounds[:-1], bounds[1:]):
                    item = index.words[k[a]]
                    text = tok[spans[d[a]]:spans[d[a] + 1]]
                    near = _near_seeds(text, p[a:z] - spans[d[a]], len(item))
                    covered = sum(n for _, _, n in tiling(item, near, min_tile))
                    out.append((first + int(d[a]), index.ids[k[a]], len(item), covered))
            rows = pa.array([x[0] for x in out], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(rows), b.column(1).take(rows), pa.array([x[1] for x in out], pa.int64()),
                 pa.array([x[2] for x in out], pa.int64()), pa.array([x[3] for x in out], pa.int64())],
                names=["doc_id", "xx", "item_id", "item_words", "covered"])

    return docs.mapInArrow(run, "doc_id long, xx long, item_id long, item_words long, covered long")


def benchmark_blocks(bench: DataFrame, block_words: int = BLOCK_WORDS):
    """The benchmark's items in lists of at most ``block_words`` words (a longer item alone)."""
    spark = bench.sparkSession
    size = F.length(F.col("text").cast("binary"))
    items = bench.filter("text is not null and text <> ''").select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"),
        size.alias("size"))
    block, filled = [], 0
    for row in items.orderBy("item_id", "text").toLocalIterator():
        if block and filled + row["size"] > 2 * block_words:   # a word and its space take two bytes at least
            yield block
            block, filled = [], 0
        block.append((row["item_id"], bytes(row["text"])))
        filled += row["size"]
    if block:
        yield block


def tiled_pairs(docs: DataFrame, bench: DataFrame, min_tile: int = MIN_TILE,
                block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, xx (hash of the text), item_id, item_words, covered, coverage of all pairs with a seed."""
    text = F.col("text").cast("string")
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("xx"), text.alias("text"))
    out = None
    for block in benchmark_blocks(bench, block_words):
        found = _block_scan(src, block, min_tile)
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = docs.sparkSession.createDataFrame(
            [], "doc_id long, xx long, item_id long, item_words long, covered long")
    return out.withColumn("coverage", F.col("covered") / F.col("item_words"))


def decontamination_report(docs: DataFrame, bench: DataFrame, min_tile: int = MIN_TILE,
                           threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_items (at or above the threshold), best_item, best_coverage, contaminated; a row per document.

    best_item is the item with most coverage (the smallest id of equal ones), null without a seed.
    """
    text = F.col("text").cast("string")
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("xx"), text.alias("text"))
    rows = src.select("doc_id", "xx", F.lit(1).alias("copies"), F.lit(None).cast("long").alias("item_id"),
                      F.lit(None).cast("double").alias("coverage"))
    pairs = tiled_pairs(docs, bench, min_tile, block_words).select(
        "doc_id", "xx", F.lit(0).alias("copies"), "item_id", "coverage")
    # one keyed aggregate puts pairs to their documents; repeated rows give equal pairs
    best = F.max(F.when(F.col("item_id").isNotNull(), F.struct("coverage", (-F.col("item_id")).alias("k"))))
    agg = (rows.unionByName(pairs).groupBy("doc_id", "xx", "item_id")
           .agg(F.sum("copies").alias("copies"), F.max("coverage").alias("coverage"))
           .groupBy("doc_id", "xx")
           .agg(F.sum("copies").alias("copies"),
                F.count(F.when(F.col("coverage") >= threshold, 1)).alias("n_items"), best.alias("best")))
    return (agg.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select("doc_id", "n_items", (-F.col("best.k")).alias("best_item"),
                    F.coalesce("best.coverage", F.lit(0.0)).alias("best_coverage"),
                    (F.col("n_items") > 0).alias("contaminated")))


def decontaminate(docs: DataFrame, bench: DataFrame, min_tile: int = MIN_TILE, threshold: float = THRESHOLD,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without the contaminated rows; all columns kept."""
    ident = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    gone = (tiled_pairs(docs, bench, min_tile, block_words).filter(F.col("coverage") >= threshold)
            .select(ident.alias("id"), "xx").distinct())
    keys = {"id": ident, "xx": F.xxhash64(F.col("text").cast("string"))}
    return keep_rows(docs, keys, gone, "left_anti")
