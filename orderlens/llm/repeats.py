"""Shared ground of the two substring operators: find and deal out repeated windows.

A window is ``window`` consecutive items (bytes or words) of one document.  Equal
windows choose the same gram (``scan.anchors``), so a window that stands in two
texts shares an anchor hash with its copy, and

1. ``shared_codes`` finds the anchor hashes that occur in two texts, or twice in one
   when ``within`` asks for it.  Only hashes are shuffled, to hash buckets, after
   each slice of a batch has reduced a hash to two texts; no repeated window is missed,
   and a hash met by chance only adds work.
2. ``segments`` cuts the windows of shared anchors out of the texts and deals them to
   buckets by anchor.  Before that each slice (4 MB of text) combines equal segments:
   the earliest is sent, all others are settled on the spot, so a passage that stands
   in a third of all documents reaches its bucket once per slice.

Exact copies never get that far: a text class (``text_classes``) is represented by
its earliest row.  Every frame keeps rows apart by (rid, key): rid is the doc_id with
null as the largest id, key a hash of the text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import buckets, join_groups, stage
from orderlens.llm.scan import (BYTE_VALUES, WHITE, anchors, equal_runs, pieces, prefix_sums, range_hash, sliced, utf8,
                                window_hash, word_hashes, words)

NULL_ID = (1 << 63) - 1


class Bytes:
    """Items are the bytes of the UTF-8 text."""

    def __init__(self, window: int, gram: int):
        self.window, self.gram = window, gram

    def items(self, buf, offsets):
        """(value, document, first byte, end byte) of every item."""
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        at = np.arange(len(buf))
        return BYTE_VALUES[buf], doc, at, at + 1


class Words:
    """Items are the words between ASCII white space."""

    def __init__(self, window: int, gram: int):
        self.window, self.gram = window, gram

    def items(self, buf, offsets):
        start, end, doc = words(buf, offsets, ~WHITE)
        return word_hashes(buf, start, end), doc, start, end


def codes_of(grams: np.ndarray, n_buckets: int) -> np.ndarray:
    """Bucket in the upper half, the rest of the hash in the lower."""
    low = grams & np.uint64(0xFFFFFFFF)
    return ((low * np.uint64(n_buckets)) >> np.uint64(32)) << np.uint64(32) | grams >> np.uint64(32)


def row_id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))


def keyed_text(docs: DataFrame) -> DataFrame:
    """(rid, key, text): text is never null."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(row_id().alias("rid"), F.xxhash64(text).alias("key"), text.alias("text"))


def text_classes(rows: DataFrame) -> DataFrame:
    """``rows`` (staged; rid, key, sha, copies, ...) with ``rep``, the least rid with the same text."""
    classes = stage(rows.groupBy("key", "sha").agg(F.min("rid").alias("rep"), F.count("*").alias("n")), "classes")
    return stage(join_groups(rows, classes, ["key", "sha"], "n").drop("n"), "placed")


def repeats(*columns: np.ndarray) -> np.ndarray:
    """True where a row of sorted columns equals the one before it."""
    out = np.ones(len(columns[0]), bool)
    out[:1] = False
    for c in columns:
        out[1:] &= c[1:] == c[:-1]
    return out


def packed(*columns) -> list[pa.Array]:
    return [pa.array(c, pa.binary()) for c in columns]


def cut_rows(by: np.ndarray, *arrays: np.ndarray):
    """Yield (value, slices) for runs of equal values in the sorted array ``by``."""
    cut = np.flatnonzero(np.concatenate([[True], by[1:] != by[:-1]])) if len(by) else []
    for a, z in zip(cut, np.append(cut[1:], len(by))):
        yield by[a], [x[a:z] for x in arrays]


def batch_anchors(batch_text: pa.Array, unit):
    """Per piece of a batch: (first document, anchor arrays, item arrays, bytes)."""
    buf, offsets = utf8(batch_text)
    for first, last in pieces(offsets):
        lo = offsets[first]
        part = buf[lo:offsets[last]]
        value, doc, start, end = unit.items(part, offsets[first:last + 1] - lo)
        grams = window_hash(value, unit.gram)
        at, head, tail = anchors(grams, doc, unit.gram, unit.window)
        yield first, grams[at], head, tail, value, doc, start, end, part


def shared_codes(texts: DataFrame, unit, within: bool) -> tuple[DataFrame, int]:
    """((key, codes), n_buckets): the anchor codes of each text that other texts have too.

    With ``within`` a code that stands twice in one text counts as well.
    """
    n = buckets(texts.sparkSession)

    def collect(batches):
        for b in sliced(batches, 1):
            keys = b.column(0).to_numpy()
            _, unique = np.unique(keys, return_index=True)
            unique = np.sort(unique)                       # equal texts of a batch: one is enough
            keys, text = keys[unique], b.column(1).take(pa.array(unique))
            owner, code, twice = [], [], []
            for first, grams, head, _, _, doc, _, _, _ in batch_anchors(text, unit):
                c, d = codes_of(grams, n), doc[head] + first
                order = np.lexsort((c, d))
                c, d = c[order], d[order]
                new = np.ones(len(c), bool)
                new[1:] = (c[1:] != c[:-1]) | (d[1:] != d[:-1])
                at = np.flatnonzero(new)
                code.append(c[at])
                owner.append(d[at])
                twice.append(np.diff(np.append(at, len(c))) > 1)
            if not code or not sum(map(len, code)):
                continue
            code, owner, twice = np.concatenate(code), np.concatenate(owner), np.concatenate(twice)
            order = np.argsort(code, kind="stable")
            code, owner, twice = code[order], owner[order], twice[order]
            cut = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            size = np.diff(np.append(cut, len(code)))
            rank = np.arange(len(code)) - np.repeat(cut, size)
            # met in two texts of this batch: known here, and two rows tell the bucket
            known = (np.repeat(size, size) > 1) | (twice if within else False)
            yield from rows_of(code[rank < 2], keys[owner[rank < 2]], (code[rank < 2] >> np.uint64(32)), False)
            k, o = code[known], keys[owner[known]]
            yield from rows_of(k, o, (o.view(np.uint64) % np.uint64(n)), True)

    def rows_of(code, key, bucket, known):
        order = np.lexsort((key, bucket))
        code, key, bucket = code[order], key[order], bucket[order]
        out = []
        for b, (c, k) in cut_rows(bucket, code, key):
            cut = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            counts = np.diff(np.append(cut, len(k))).astype(np.uint32)
            body = c if known else (c & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            out.append((int(b), known, k[cut].tobytes(), counts.tobytes(), body.tobytes()))
        if out:
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.bool_()), *packed(*cols[2:])],
                names=["bucket", "known", "keys", "counts", "codes"])

    def merge(batches):
        codes, keys, told, whom = [], [], [], []
        for b in batches:
            for bucket, known, k, m, c in zip(*(x.to_pylist() for x in b.columns)):
                k = np.repeat(np.frombuffer(k, np.int64), np.frombuffer(m, np.uint32))
                if known:
                    told.append(np.frombuffer(c, np.uint64))
                    whom.append(k)
                else:
                    codes.append(np.frombuffer(c, np.uint32).astype(np.uint64) | np.uint64(bucket << 32))
                    keys.append(k)
        if codes:
            codes, keys = np.concatenate(codes), np.concatenate(keys)
            order = np.argsort(codes, kind="stable")
            codes, keys = codes[order], keys[order]
            cut = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            shared = np.minimum.reduceat(keys, cut) != np.maximum.reduceat(keys, cut)
            keep = np.repeat(shared, np.diff(np.append(cut, len(codes))))
            told.append(codes[keep])
            whom.append(keys[keep])
        if told:
            told, whom = np.concatenate(told), np.concatenate(whom)
            # packed again, dealt out by text
            yield from rows_of(told, whom, whom.view(np.uint64) % np.uint64(n), True)

    def answer(batches):
        """One row per text: its shared codes."""
        codes, keys = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for b in batches:
            for k, m, c in zip(*(b.column(i).to_pylist() for i in (2, 3, 4))):
                keys.append(np.repeat(np.frombuffer(k, np.int64), np.frombuffer(m, np.uint32)))
                codes.append(np.frombuffer(c, np.uint64))
        codes, keys = np.concatenate(codes), np.concatenate(keys)
        order = np.argsort(keys, kind="stable")
        keys, codes = keys[order], codes[order]
        cut = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, int)
        for lo in range(0, len(cut), 20_000):
            at = cut[lo:lo + 20_000]
            end = cut[lo + 20_000] if lo + 20_000 < len(cut) else len(keys)
            offsets = (np.append(at, end) - at[0]).astype(np.int32) * 8
            blob = pa.Array.from_buffers(pa.binary(), len(at), [
                None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(codes[at[0]:end].tobytes())])
            yield pa.RecordBatch.from_arrays([pa.array(keys[at], pa.int64()), blob], names=["key", "codes"])

    packs = "bucket int, known boolean, keys binary, counts binary, codes binary"
    met = (texts.select("key", "text").mapInArrow(collect, packs)
           .repartition(n, "bucket").mapInArrow(merge, packs)
           .repartition(n, "bucket").mapInArrow(answer, "key long, codes binary"))
    return met, n


def segments(found: DataFrame, unit, n_buckets: int, by_document: bool) -> DataFrame:
    """Windows of shared anchors, dealt out by anchor.

    ``found`` is (rid, key, text, codes).  Rows with bucket >= 0 hold packed segments:
    rid and key of each document and its number of segments, then per segment start
    (item index), windows, code, size (bytes) and data; rows with a negative bucket
    hold what an earlier segment of the same batch settles, without the last three.  ``by_document``: only a smaller rid settles a segment;
    else an earlier start in the same row does, too.
    """
    def run(batches):
        for b in sliced(batches, 2):
            rids, keys = b.column(0).to_numpy(), b.column(1).to_numpy()
            lists = b.column(3)
            parts = []
            for first, grams, head, tail, value, doc, start, end, part in batch_anchors(b.column(2), unit):
                code, owner = codes_of(grams, n_buckets), doc[head] + first
                keep = np.zeros(len(code), bool)
                bounds = np.searchsorted(owner, np.arange(first, first + (doc[-1] if len(doc) else -1) + 2))
                for d in np.unique(owner).tolist():
                    a, z = bounds[d - first], bounds[d - first + 1]
                    mine = np.frombuffer(lists[d].as_py(), np.uint64)
                    keep[a:z] = np.isin(code[a:z], mine)
                code, owner, head, tail = code[keep], owner[keep], head[keep], tail[keep]
                if not len(code):
                    continue
                stop = tail + unit.window                  # items [head, stop) hold the windows head..tail
                whole = range_hash(prefix_sums(value), head, stop)
                base = np.searchsorted(doc, owner - first)
                lo, hi = start[head], end[stop - 1]
                size = hi - lo
                take = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size)
                parts.append((rids[owner], keys[owner], head - base, tail - head + 1, code, whole, size, part[take]))
            if not parts:
                continue
            rid, key, at, many, code, whole, size, data = map(np.concatenate, zip(*parts))
            # combine equal segments of the batch: the earliest goes on
            offset = np.cumsum(size) - size
            order = np.lexsort((at, key, rid, whole, code))
            order = order[~repeats(code[order], rid[order], key[order], at[order])]     # repeated rows count once
            same = np.concatenate([[False], (code[order][1:] == code[order][:-1]) & (whole[order][1:] == whole[order][:-1])
                                   & (size[order][1:] == size[order][:-1])])
            alike = np.flatnonzero(same)                   # equal hashes: their bytes decide
            same[alike] = equal_runs(data, offset[order[alike]], offset[order[alike - 1]], size[order[alike]])
            group = np.cumsum(~same) - 1
            lead = order[np.flatnonzero(~same)][group]     # the earliest of each one's group, in sorted order
            late = (rid[order] > rid[lead]) if by_document else same
            settled = order[late]
            rest = order[~late]
            bucket = (code[rest] >> np.uint64(32)).astype(np.int64)
            rest = rest[np.lexsort((at[rest], key[rest], rid[rest], bucket))]
            bucket = (code[rest] >> np.uint64(32)).astype(np.int64)
            yield from send(bucket, rest, rid, key, at, many, code, size, data, offset)
            if len(settled):
                settled = settled[np.lexsort((key[settled], rid[settled]))]
                none = np.zeros(0, np.uint8)
                yield from send(-1 - (key[settled] & 0x7FFFFFFF) % n_buckets, settled, rid, key, at, many,
                                code[:0], size[:0], none, offset)

    def send(bucket, rows, rid, key, at, many, code, size, data, offset):
        order = np.argsort(bucket, kind="stable")
        bucket, rows = bucket[order], rows[order]
        out = []
        for b, (r,) in cut_rows(bucket, rows):
            r = r[np.lexsort((at[r], key[r], rid[r]))]
            new = ~repeats(rid[r], key[r])                 # each document once, then its segments
            first = np.flatnonzero(new)
            row = [int(b), rid[r][first].tobytes(), key[r][first].tobytes(),
                   np.diff(np.append(first, len(r))).astype(np.uint32).tobytes(),
                   at[r].astype(np.uint32).tobytes(), many[r].astype(np.uint32).tobytes()]
            if b >= 0:
                n = size[r]
                take = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(offset[r], n)
                row += [(code[r] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes(),
                        n.astype(np.uint32).tobytes(), data[take].tobytes()]
            else:
                row += [b"", b"", b""]
            out.append(row)
        if out:
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *packed(*cols[1:])], names=NAMES)

    return found.select("rid", "key", "text", "codes").mapInArrow(run, SCHEMA)


NAMES = ["bucket", "rid", "key", "segments", "start", "windows", "code", "size", "data"]
SCHEMA = ("bucket int, rid binary, key binary, segments binary, start binary, windows binary, code binary, "
          "size binary, data binary")


def load_segments(batches):
    """All of a task's segment rows: (rid, key, start, windows, code, size, data), and the settled spans."""
    kept, settled = [], []
    for b in batches:
        for row in zip(*(x.to_pylist() for x in b.columns)):
            many = np.frombuffer(row[3], np.uint32)
            ints = [np.repeat(np.frombuffer(row[1], np.int64), many), np.repeat(np.frombuffer(row[2], np.int64), many),
                    np.frombuffer(row[4], np.uint32).astype(np.int64), np.frombuffer(row[5], np.uint32).astype(np.int64)]
            if row[0] >= 0:
                code = np.frombuffer(row[6], np.uint32).astype(np.uint64) | np.uint64(row[0] << 32)
                kept.append([*ints, code, np.frombuffer(row[7], np.uint32).astype(np.int64),
                             np.frombuffer(row[8], np.uint8)])
            else:
                settled.append(ints)
    kept = [np.concatenate(x) for x in zip(*kept)] if kept else None
    settled = [np.concatenate(x) for x in zip(*settled)] if settled else None
    return kept, settled


SPAN_DOCUMENTS = 1 << 20


def span_rows(rid, key, start, end):
    """Per (rid, key) one row of packed [start, end) items; touching spans are joined."""
    if not len(rid):
        return
    order = np.lexsort((start, key, rid))
    rid, key, start, end = rid[order], key[order], start[order], end[order]
    doc = np.concatenate([[True], (rid[1:] != rid[:-1]) | (key[1:] != key[:-1])])
    number = np.cumsum(doc)
    # documents in lots, so that their numbers leave 40 bits for places
    lots = np.flatnonzero(doc)[::SPAN_DOCUMENTS]
    for a, z in zip(lots, np.append(lots[1:], len(rid))):
        yield from _span_rows(rid[a:z], key[a:z], start[a:z], end[a:z], doc[a:z], number[a:z] - number[a])


def _span_rows(rid, key, start, end, doc, number):
    spread = number * (1 << 40)                            # keeps the running maximum inside a document
    reach = np.maximum.accumulate(end + spread)
    new = doc.copy()
    new[1:] |= start[1:] + spread[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(rid)) - 1
    pairs = np.column_stack([start[first], reach[last] - spread[last]])
    out = [(r[0], k[0], p.tobytes()) for _, (r, k, p) in cut_rows(number[first], rid[first], key[first], pairs)]
    for lo in range(0, len(out), 10_000):
        cols = list(zip(*out[lo:lo + 10_000]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary())],
            names=["rid", "key", "spans"])


def merge_spans(blobs, limit: int) -> np.ndarray:
    """Sorted, disjoint [start, end) rows from packed spans, clipped at ``limit``."""
    pairs = np.concatenate([np.frombuffer(x, np.int64).reshape(-1, 2) for x in blobs])
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    new = np.concatenate([[True], pairs[1:, 0] > reach[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(pairs)) - 1
    return np.minimum(np.column_stack([pairs[first, 0], reach[last]]), limit)


def removed_spans(docs: DataFrame, placed: DataFrame, unit, within: bool, judge) -> DataFrame:
    """(rid, key, text, spans): the text class representatives with something to remove.

    ``placed`` is what ``text_classes`` gives; ``judge`` turns a task's segment rows
    into span rows.
    """
    texts = keyed_text(docs)
    codes, n = shared_codes(texts, unit, within)
    codes = stage(codes, "codes")
    reps = placed.filter("rid = rep").select("rid", "key")
    wanted = reps.join(codes, "key")
    found = texts.join(wanted, ["rid", "key"]).select("rid", "key", "text", "codes")
    spans = (segments(found, unit, n, not within).repartition(n, "bucket")
             .mapInArrow(judge, "rid long, key long, spans binary")
             .groupBy("rid", "key").agg(F.collect_list("spans").alias("spans")))
    # the same keyed shuffle of the texts serves both joins
    return texts.join(spans, ["rid", "key"]).select("rid", "key", "text", "spans")
