"""SimHash near-duplicates with exact Hamming search by bit-sliced comparison.

Fingerprints: 64 bits from 4-word shingles (ASCII-lower-cased, white space
U+0020, U+0009-U+000D), XXH64 with seed 42; a bit is 1 when set in over half of
the shingles, repeats included.

Search: distinct fingerprints only, so copies collapse before any comparison.
The 64 bits are cut into six blocks; two fingerprints within four bits agree on
at least two blocks, so the fifteen block pairs are the join keys and no link is
lost.  The fingerprints under one key are compared bit-sliced: bit plane k holds
bit k of 64 fingerprints per machine word, differences are XORs of whole planes,
and the distances of all lanes grow together in carry-save counters; a block is
abandoned once every lane exceeds the radius.  A key with more than ``chunk``
fingerprints is dealt out as pairs of chunks, all of which are compared.

Defined cases: null and empty texts have fingerprint zero and link like any
other; a null doc_id gets a fingerprint and component but never names one unless
the whole component is null; repeated rows are kept; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import join_groups, keep_rows, stage
from orderlens.llm.components import connected_components

SHINGLE_WORDS, MAX_BITS, SEED = 4, 4, 42
CHUNK = 2048


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit SimHash of one text."""
    w = (text or "").encode("utf-8").lower().split()   # bytes: ASCII letters and white space only
    if not w:
        return 0
    joined = b" ".join(w)
    ends = np.cumsum([len(x) + 1 for x in w]) - 1
    if len(w) <= words:
        h = np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    else:
        first = [0, *(ends[:-1] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(first, ends[words - 1:].tolist())),
                        dtype=np.uint64, count=len(w) - words + 1)
    lanes = h.view(np.uint8).reshape(-1, 8)            # little-endian: lane 0 holds bits 0-7
    bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
    ones = np.concatenate([np.bincount(lanes[:, k], minlength=256) @ bits for k in range(8)])
    return sum(1 << k for k in np.flatnonzero(ones * 2 > len(h)).tolist())


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, xx, fp): xx is a hash of the text, fp the fingerprint as a signed long."""
    def run(batches):
        for b in batches:
            fps = [_signed(fingerprint(t.as_py(), words)) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps, pa.int64())],
                                             names=["doc_id", "xx", "fp"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("xx"),
                      F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, xx long, fp long")


def block_layout(max_bits: int) -> list[int]:
    """Masks of the join keys: max_bits + 2 blocks, taken in pairs."""
    n = max_bits + 2
    cuts = [64 * k // n for k in range(n + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    return [x | y for x, y in combinations(blocks, 2)]


def planes_of(values: np.ndarray) -> np.ndarray:
    """Vertical bit planes: row k holds bit k of all values, 64 values per word."""
    pad = -len(values) % 64
    v = np.concatenate([values, np.zeros(pad, np.uint64)])
    bits = np.unpackbits(v.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def within(planes: np.ndarray, queries: np.ndarray, radius: int) -> np.ndarray:
    """Boolean (queries x lanes): lane within ``radius`` bits of the query.

    All distances of a query grow together in carry-save counters of
    ``bit_length(radius)`` planes; a counter that would pass its top plane sets
    the lane's overflow bit.  The counters start at 2**planes - 1 - radius, so the
    overflow bit is set by exactly the (radius + 1)-th differing bit.  Queries all
    of whose lanes have overflowed are abandoned after every eighth bit.
    """
    depth = max(1, int(radius).bit_length())
    start = (1 << depth) - 1 - radius
    n, words = len(queries), planes.shape[1]
    full = ~np.uint64(0)
    over = np.zeros((n, words), np.uint64)
    live = np.arange(n)
    masks = np.where((queries[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1), full, np.uint64(0))
    counters = [np.full((n, words), full if start >> d & 1 else np.uint64(0)) for d in range(depth)]
    done = np.zeros((n, words), np.uint64)
    for k in range(64):
        carry = planes[k][None, :] ^ masks[live, k][:, None]
        for c in counters:
            carry, c[:] = c & carry, c ^ carry
        done |= carry
        if k % 8 == 7:
            alive = (done != full).any(axis=1)
            over[live] = done
            if not alive.any():
                break
            if not alive.all():
                live, done, counters = live[alive], done[alive], [c[alive] for c in counters]
    return np.unpackbits((~over).view(np.uint8).reshape(n, -1), axis=1, bitorder="little").astype(bool)


def _spread(values: np.ndarray, radius: int):
    """Edges of a spanning forest of the links among ``values`` (distinct, one key)."""
    planes = planes_of(values)
    unseen = np.ones(len(values), bool)
    while unseen.any():
        seed = int(np.flatnonzero(unseen)[0])
        unseen[seed] = False
        front = np.array([seed])
        while len(front):
            found = []
            for at in range(0, len(front), 64):
                near = within(planes, values[front[at:at + 64]], radius)[:, :len(values)]
                hit = np.flatnonzero(near.any(axis=0) & unseen)
                unseen[hit] = False
                found.append(hit)
            front = np.concatenate(found)
            for x in front.tolist():
                yield int(values[seed]), int(values[x])


def _links(keys: np.ndarray, fps: np.ndarray, radius: int):
    """Edges for rows sorted by key: small groups together, large ones one by one."""
    cut = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    size = np.diff(np.append(cut, len(keys)))
    for at, n in zip(cut[size > 64].tolist(), size[size > 64].tolist()):
        yield from _spread(fps[at:at + n], radius)
    for n in np.unique(size[(size > 1) & (size <= 64)]).tolist():
        first = cut[size == n]
        for i, j in combinations(range(n), 2):
            for lo in range(0, len(first), 1 << 16):
                a, b = fps[first[lo:lo + (1 << 16)] + i], fps[first[lo:lo + (1 << 16)] + j]
                # the lanes are pairs here: planes of the XORs against a query of zeros
                near = within(planes_of(a ^ b), np.zeros(1, np.uint64), radius)[0, :len(a)]
                yield from zip(a[near].tolist(), b[near].tolist())


def near_edges(fps: DataFrame, max_bits: int = MAX_BITS, chunk: int = CHUNK) -> DataFrame:
    """Links (u, v) whose components are those of all pairs within ``max_bits`` bits.

    ``fps`` holds distinct fingerprints (column fp).
    """
    masks = block_layout(max_bits)
    keyed = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).cast("int").alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k"))
        for k, m in enumerate(masks)])).alias("key")).select("key.t", "key.k", "fp")
    sizes = keyed.groupBy("t", "k").agg(F.count("*").alias("n")).filter("n > 1")
    # keys above the chunk size are few (at most 15 rows/chunk); each is dealt out as pairs of chunks
    big = stage(sizes.filter(F.col("n") > chunk), "hot-blocks").withColumn(
        "parts", F.ceil(F.col("n") / F.lit(chunk)).cast("int"))
    part = F.pmod(F.xxhash64("fp"), F.col("parts").cast("long")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = (keyed.join(big, ["t", "k"]).withColumn("mine", part).withColumn("other", other)
             .select("t", "k", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "fp"))
    plain = keyed.join(big, ["t", "k"], "left_anti").select(
        "t", "k", F.lit(0).alias("i"), F.lit(0).alias("j"), "fp")
    grouped = plain.unionByName(dealt).select(F.xxhash64("t", "k", "i", "j").alias("g"), "fp")

    def run(batches):
        keep_g, keep_f = np.empty(0, np.int64), np.empty(0, np.uint64)
        for b in batches:
            g = np.concatenate([keep_g, b.column(0).to_numpy()])
            f = np.concatenate([keep_f, b.column(1).to_numpy().view(np.uint64)])
            last = int(np.searchsorted(g, g[-1])) if len(g) else 0     # the last group may go on
            yield from emit(g[:last], f[:last])
            keep_g, keep_f = g[last:], f[last:]
        yield from emit(keep_g, keep_f)

    def emit(g, f):
        if len(g) > 1:
            e = np.array(list(_links(g, f, max_bits)), dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1])], names=["u", "v"])

    return grouped.repartition("g").sortWithinPartitions("g", "fp").mapInArrow(run, "u long, v long")


def simhash_components(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                       chunk: int = CHUNK) -> DataFrame:
    """doc_id, xx, fp (signed long), root (least fp of the component), component_id.

    One row per row of ``docs``.
    """
    rows = stage(fingerprints(docs, words), "fingerprints")
    classes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "classes")
    comps = connected_components(near_edges(classes.select("fp"), max_bits, chunk))
    placed = stage(classes.join(comps, classes["fp"] == comps["node"], "left").select(
        "fp", "rep", "n", F.coalesce("root", "fp").alias("root")), "placed")
    heads = stage(placed.groupBy("root").agg(F.min("rep").alias("component_id"),
                                             F.count("*").alias("members")), "heads")
    named = stage(join_groups(placed, heads, ["root"], "members").select("fp", "n", "root", "component_id"), "named")
    return join_groups(rows, named, ["fp"], "n").select("doc_id", "xx", "fp", "root", "component_id")


def near_dedup(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest doc_id.

    Null ids rank last; rows that share that doc_id are told apart by their text,
    and of rows equal in both one stays.
    """
    ident = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    winners = (simhash_components(docs, words, max_bits)
               .groupBy("root").agg(F.min(F.struct(ident.alias("id"), F.col("xx"))).alias("w"))
               .select("w.id", "w.xx"))
    keys = {"id": ident, "xx": F.xxhash64(F.col("text").cast("string"))}
    return keep_rows(docs, keys, winners, "left_semi", one_each=True)


def simhash_query(docs: DataFrame) -> DataFrame:
    return simhash_components(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
