"""Substring deduplication with suffix arrays built by two-stage sorting.

Every byte covered by a ``length``-byte string that also starts in a document with a
smaller doc_id is removed; strings are judged on the input.

``repeats`` deals the windows that may recur to buckets.  A bucket's segments form
one text whose suffix array is built in two stages: suffixes smaller than their
successor are sorted directly (to the depth that matters), and the rest are induced
by one scan over the buckets of first symbols.  Adjacent common prefixes then give
the classes of equal windows, and the least doc_id of each class keeps its window.

Defined cases: a null text is empty; texts under ``length`` bytes lose nothing; of
equal texts every one but those of the smallest doc_id is removed whole; a null
doc_id ranks after all ids; rows that share a doc_id never remove from each other;
repeated rows each get a row; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import stage
from orderlens.llm.repeats import (Bytes, load_segments, merge_spans, removed_spans, repeats, row_id, span_rows,
                                   text_classes)
from orderlens.llm.scan import BYTE_VALUES, equal_runs, pieces, prefix_sums, range_hash

LENGTH, GRAM = 50, 24
SYMBOLS, WIDTH = 257, 7          # 9-bit symbols, seven to a sort key
TASK_BYTES = 1 << 20             # text that one suffix array covers


def _keys(text: np.ndarray) -> np.ndarray:
    """The next WIDTH symbols at every place, packed."""
    n = len(text) - WIDTH + 1
    keys = np.zeros(n, np.uint64)
    for k in range(WIDTH):
        keys = (keys << np.uint64(9)) | text[k:k + n]
    return keys


def _direct(keys: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """``at`` sorted by the suffixes' first ``depth`` symbols; ties are refined only."""
    key = keys[at]
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    new = np.ones(len(at), bool)
    new[1:] = key[1:] != key[:-1]
    for done in range(WIDTH, depth, WIDTH):
        tied = ~new
        tied[:-1] |= ~new[1:]
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        group = np.cumsum(new)[slots]
        key = keys[at[slots] + done]
        order = np.lexsort((key, group))
        at[slots] = at[slots][order]
        key, group = key[order], group[order]
        new[slots[1:]] |= key[1:] != key[:-1]
        new[slots[1:]] |= group[1:] != group[:-1]
    return at


def two_stage_suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffix array of ``symbols`` (0..256, last one 0), exact to ``depth`` symbols."""
    n = len(symbols)
    text = np.concatenate([symbols.astype(np.uint64), np.zeros(depth + 2 * WIDTH, np.uint64)])
    sym = symbols.astype(np.int64)
    # smaller[i]: suffix i is smaller than its successor; equal neighbours share the answer
    differs = np.concatenate([sym[:-1] != sym[1:], [True]])
    stop = np.where(differs, np.arange(n), n)
    stop = np.minimum.accumulate(stop[::-1])[::-1]
    after = np.concatenate([sym[1:], [-1]])
    smaller = sym[stop] < after[stop]
    direct = _direct(_keys(text), np.flatnonzero(smaller), depth)
    counts = np.bincount(sym, minlength=SYMBOLS)
    begin = np.concatenate([[0], np.cumsum(counts)])
    n_direct = np.bincount(sym[direct], minlength=SYMBOLS)
    n_induced = counts - n_direct
    array = np.empty(n, np.int64)
    direct_at = np.concatenate([[0], np.cumsum(n_direct)])
    for c in np.flatnonzero(n_direct).tolist():            # sorted suffixes end their bucket
        array[begin[c] + n_induced[c]:begin[c + 1]] = direct[direct_at[c]:direct_at[c + 1]]
    fill = begin[:-1].copy()
    array[fill[sym[n - 1]]] = n - 1
    fill[sym[n - 1]] += 1

    def induce(scanned):
        before = scanned - 1
        before = before[before >= 0]
        before = before[~smaller[before]]
        if not len(before):
            return
        first = sym[before].astype(np.uint16)
        order = np.argsort(first, kind="stable")
        first, before = first[order].astype(np.int64), before[order]
        many = np.bincount(first, minlength=SYMBOLS)
        rank = np.arange(len(first)) - np.repeat(np.cumsum(many) - many, many)
        array[fill[first] + rank] = before
        np.add(fill, many, out=fill)

    for c in np.flatnonzero(counts).tolist():
        at = begin[c]
        while at < fill[c]:                                # the bucket may induce into itself
            upto = fill[c]
            induce(array[at:upto])
            at = upto
        induce(array[begin[c] + n_induced[c]:begin[c + 1]])
    return array


def common_prefixes(symbols: np.ndarray, array: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix, ``depth`` at most, of each suffix with the one before it in ``array``."""
    text = np.concatenate([symbols, np.full(depth, 0, symbols.dtype)])
    lcp = np.zeros(len(array), np.int64)
    live = np.arange(1, len(array))
    a, b = array[:-1], array[1:]
    for k in range(depth):
        same = text[a + k] == text[b + k]
        live, a, b = live[same], a[same], b[same]
        if not len(live):
            break
        lcp[live] = k + 1
    return lcp


def judge_segments(rid, windows, size, data, length: int):
    """(segment, window) indexes of the windows that a smaller rid has too."""
    n = len(size)
    begin = np.cumsum(size + 1) - size - 1                 # one separator after each segment
    symbols = np.zeros(int((size + 1).sum()) + 1, np.uint16)
    owner = np.repeat(np.arange(n), size)
    inside = np.arange(len(data)) - np.repeat(np.cumsum(size) - size, size)
    symbols[begin[owner] + inside] = data.astype(np.uint16) + 1
    array = two_stage_suffix_array(symbols, length)
    number = np.full(len(symbols), -1, np.int64)           # segment of each window start
    w_owner = np.repeat(np.arange(n), windows)
    w_inside = np.arange(len(w_owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    number[begin[w_owner] + w_inside] = w_owner
    array = array[number[array] >= 0]
    lcp = common_prefixes(symbols, array, length)
    cut = np.flatnonzero(lcp < length)
    who = rid[number[array]]
    least = np.repeat(np.minimum.reduceat(who, cut), np.diff(np.append(cut, len(array))))
    late = array[who > least]
    return number[late], late - begin[number[late]]


def content_hashes(data: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of each segment's bytes, half a megabyte of segments at a time."""
    offsets = np.concatenate([[0], np.cumsum(size)])
    out = [np.empty(0, np.uint64)]
    for first, last in pieces(offsets):
        at = offsets[first:last + 1] - offsets[first]
        out.append(range_hash(prefix_sums(BYTE_VALUES[data[offsets[first]:offsets[last]]]), at[:-1], at[1:]))
    return np.concatenate(out)


def judge(length: int):
    def run(batches):
        kept, settled = load_segments(batches)
        if settled is not None:
            rid, key, start, windows = settled
            yield from span_rows(rid, key, start, start + windows - 1 + length)
        if kept is None:
            return
        rid, key, start, windows, code, size, data = kept
        offset = np.cumsum(size) - size
        # equal segments of several batches: all but those of the least rid are settled
        whole = content_hashes(data, size)
        order = np.lexsort((rid, whole, code))
        new = ~repeats(code[order], whole[order], size[order])
        alike = np.flatnonzero(~new)                       # equal hashes: their bytes decide
        new[alike] = ~equal_runs(data, offset[order[alike]], offset[order[alike - 1]], size[order[alike]])
        least = rid[order][new][np.cumsum(new) - 1]
        late = rid[order] > least
        gone = order[late]
        yield from span_rows(rid[gone], key[gone], start[gone], start[gone] + windows[gone] - 1 + length)
        # an anchor with one content left has nothing to be compared with
        anchor = ~repeats(code[order])
        several = np.add.reduceat(new, np.flatnonzero(anchor))[np.cumsum(anchor) - 1] > 1
        order = order[several & ~late]
        ahead = np.cumsum(size[order])          # in order of code
        at = 0
        while at < len(order):
            upto = int(np.searchsorted(ahead, (ahead[at - 1] if at else 0) + TASK_BYTES, "right"))
            upto = max(upto, at + 1)
            while upto < len(order) and code[order[upto]] == code[order[upto - 1]]:
                upto += 1                                  # windows with one anchor stay together
            s = order[at:upto]
            at = upto
            n = size[s]
            take = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(offset[s], n)
            seg, win = judge_segments(rid[s], windows[s], n, data[take], length)
            first = start[s][seg] + win
            yield from span_rows(rid[s][seg], key[s][seg], first, first + length)

    return run


def suffix_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256; ``with_text`` adds kept (binary) and spans.

    One row per row of ``docs``.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = stage(docs.select(row_id().alias("rid"), "doc_id", F.xxhash64(text).alias("key"),
                             F.sha2(text, 256).alias("sha"), F.octet_length(text).cast("long").alias("n_bytes"))
                 .groupBy("rid", "doc_id", "key", "sha", "n_bytes").agg(F.count("*").alias("copies")), "rows")
    placed = text_classes(rows)
    cut = removed_spans(docs, placed, Bytes(length, min(gram, length)), False, judge(length))

    def finish(batches):
        for b in batches:
            out = []
            for rid, key, text, blobs in zip(*(x.to_pylist() for x in b.columns)):
                raw = text.encode("utf-8")
                spans = merge_spans(blobs, len(raw))
                edges = [0, *spans.ravel().tolist(), len(raw)]
                kept = b"".join([raw[a:z] for a, z in zip(edges[::2], edges[1::2])])
                out.append((rid, key, len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(),
                            kept if with_text else None, spans.ravel().tolist() if with_text else None))
            cols = list(zip(*out)) or [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(),
                                                       pa.binary(), pa.list_(pa.int64())))],
                names=["rid", "key", "n_removed", "n_spans", "kept_sha256", "kept", "spans"])

    changed = cut.mapInArrow(
        finish, "rid long, key long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans array<long>"
    ).dropDuplicates(["rid", "key"])            # repeated rows
    whole = (F.col("rid") > F.col("rep")) & (F.col("n_bytes") >= length)
    joined = placed.join(changed, ["rid", "key"], "left")
    result = joined.select(
        "rid", "key", "doc_id", "copies", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(whole, F.lit("").cast("binary")).otherwise(F.col("kept")).alias("kept"),
        F.when(whole, F.array(F.lit(0).cast("long"), F.col("n_bytes"))).otherwise(F.col("spans")).alias("spans"),
    ).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    if with_text:
        # texts that lose nothing are their own result
        source = docs.select(row_id().alias("rid"), F.xxhash64(text).alias("key"), text.cast("binary").alias("whole"))
        result = (result.join(source.dropDuplicates(["rid", "key"]), ["rid", "key"])
                  .withColumn("kept", F.coalesce("kept", "whole"))
                  .withColumn("spans", F.coalesce("spans", F.array().cast("array<long>"))))
        names += ["kept", "spans"]
    return result.select(*names)
