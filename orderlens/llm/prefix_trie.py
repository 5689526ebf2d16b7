"""Prefix trie of conversations, grouped exactly after a count-min screening.

A node is a distinct sequence of first turns; its identity is a digest chained
over blocks of ``BLOCK`` turns, so the digests of a conversation of any length are
computed by several tasks and compare equal only for equal sequences.

1. turns are numbered by one range partitioning of narrow rows (texts become
   SHA-256 digests in the first scan and are never shuffled);
2. every prefix digest enters a count-min sketch: per task two bitmaps a hash row
   (seen, seen again), merged slice by slice and broadcast; its width follows the
   number of prefixes up to ``MAX_CELLS``, which bounds the broadcast;
3. a prefix whose estimate is one is proven to belong to one conversation: its
   node is emitted in place, without any shuffle;
4. all others are grouped by digest: members, smallest member, children.  Leaves
   and saved bytes below a node need no walk down the trie: each leaf and each
   node's saving is credited to one member, summed from its end backwards along
   its path, and added up over the members of a node.

Beyond about ``MAX_CELLS`` / 4 prefixes the sketch lets more through to step 4;
the result is exact at any size.

Defined cases: null role or text count as empty; rows of one conversation go by
turn (nulls first), then role, then the text's SHA-256; repeated rows are turns of
their own; rows without a conv_id belong to no conversation and are left out;
texts of any length are digested whole; an empty table has no node, not even a
root; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import buckets, join_groups, stage
from orderlens.llm.conversation_repair import mapped

#: Turns of one digest block; ids joined to one string at a time.
BLOCK = 1024
#: Cells of a hash row of the sketch: least, most, and per prefix.
MIN_CELLS, MAX_CELLS, CELLS_PER_PREFIX = 1 << 16, 1 << 25, 4
SLICE = 1 << 16
HASH_ROWS = 2
ROOT = b"\0" * 16


def turns_in_order(convs: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), item (digest of role and text), nbytes; staged and narrow."""
    n = buckets(convs.sparkSession)
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = convs.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), word("role").alias("role"),
        F.unhex(F.sha2(word("text"), 256)).alias("dig"), F.octet_length(word("text")).cast("long").alias("nbytes"),
        F.monotonically_increasing_id().alias("salt"))  # deals equal rows to several tasks
    order = ["conv_id", "turn", "role", "dig", "salt"]
    item = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", F.hex("dig")), 256))
    rows = stage(
        rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
        .select("conv_id", F.substring(item, 1, 16).alias("item"), "nbytes", F.monotonically_increasing_id().alias("rid")),
        "trie-order")
    rows = rows.withColumn("chunk", F.shiftright("rid", 33))
    chunks = rows.groupBy("conv_id", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    # At most one conversation runs on into each chunk, so there are no more such rows than chunks.
    carried = chunks.withColumn("before", F.sum("n").over(before)).filter("before is not null").drop("n")
    inside = Window.partitionBy("conv_id", "chunk").orderBy("rid")
    return (rows.withColumn("at", F.row_number().over(inside))
            .join(F.broadcast(carried), ["conv_id", "chunk"], "left")
            .select("conv_id", (F.col("at") + F.coalesce("before", F.lit(0))).alias("pos"), "item", "nbytes"))


def rebuild(turns: DataFrame, every: int = 5, modulus: int = 9) -> tuple[DataFrame, DataFrame]:
    """The query's conversations: the first h turns of conversation c - c % every, then c's
    own after its first h; h = crc32(decimal c) % modulus.  Returns their turns (conv_id,
    pos, item, nbytes) and the number of turns of each (conv_id, total)."""
    long = turns.groupBy("conv_id").agg(F.max("pos").alias("own"))
    base_id = (F.col("conv_id") - F.pmod("conv_id", F.lit(every))).alias("base_id")
    convs = long.select("conv_id", "own", base_id, (F.crc32(F.col("conv_id").cast("string")) % modulus).alias("h"))
    convs = stage(
        convs.join(long.select(F.col("conv_id").alias("base_id"), F.col("own").alias("base")), "base_id", "left")
        .withColumn("lent", F.least(F.coalesce("base", F.lit(0)), "h")), "trie-convs")
    heads = turns.filter(F.col("pos") < modulus).withColumnRenamed("conv_id", "base_id")
    lent = heads.join(convs.filter("h > 0").drop("own"), "base_id").filter("pos <= h").select("conv_id", "pos", "item", "nbytes")
    own = join_groups(turns, convs.select("conv_id", "own", "h", "lent"), ["conv_id"], "own")
    own = own.filter("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("lent")).alias("pos"), "item", "nbytes")
    total = convs.select("conv_id", (F.col("lent") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("total"))
    return lent.unionByName(own), total


def _digests(rows):
    """Digest chained within a block for each of its turns, and the one before it."""
    at, chain = None, None
    for r in rows:
        here = (r["conv_id"], r["block"])
        if here != at:
            at, chain = here, ROOT
        last, chain = chain, hashlib.sha256(chain + r["item"]).digest()[:16]
        yield {"conv_id": r["conv_id"], "depth": r["pos"], "block": r["block"], "dig": chain, "pdig": last, "nbytes": r["nbytes"]}


def _block_starts(rows):
    """Digest of everything before a block, from the digests of the full blocks in order."""
    at, chain = None, None
    for r in rows:
        if r["conv_id"] != at:
            at, chain = r["conv_id"], ROOT
        chain = hashlib.sha256(b"block" + chain + r["dig"]).digest()[:16]
        yield {"conv_id": at, "block": r["block"] + 1, "start": chain}


def prefixes(turns: DataFrame, total: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, depth, dig, pdig, nbytes, total: a row per conversation and depth, the root's too."""
    n = buckets(turns.sparkSession)
    fields = [("conv_id", pa.int64()), ("depth", pa.int64()), ("block", pa.int64()), ("dig", pa.binary()),
              ("pdig", pa.binary()), ("nbytes", pa.int64())]
    rows = turns.withColumn("block", F.floor((F.col("pos") - 1) / block).cast("long"))
    local = stage(mapped(
        rows.repartition(n, "conv_id", "block").sortWithinPartitions("conv_id", "block", "pos"), _digests, pa.schema(fields),
        "conv_id long, depth long, block long, dig binary, pdig binary, nbytes long"), "trie-blocks")
    full = local.filter(F.col("depth") % block == 0).select("conv_id", "block", "dig")
    starts = mapped(full.repartition(n, "conv_id").sortWithinPartitions("conv_id", "block"), _block_starts,
                    pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("start", pa.binary())]),
                    "conv_id long, block long, start binary")
    later = local.filter("block > 0").join(starts, ["conv_id", "block"])
    mixed = lambda c: F.substring(F.unhex(F.sha2(F.concat("start", F.lit(b"turn"), c), 256)), 1, 16)
    # The prefix before a block's first turn has the digest it got inside the block before.
    ends = local.filter(F.col("depth") % block == 0).select(
        "conv_id", (F.col("block") + 1).alias("block"), F.col("dig").alias("end"))
    prior = starts.select("conv_id", (F.col("block") + 1).alias("block"), F.col("start").alias("prior"))
    later = later.join(ends, ["conv_id", "block"]).join(prior, ["conv_id", "block"], "left")
    before = F.when(F.col("prior").isNull(), F.col("end")).otherwise(
        F.substring(F.unhex(F.sha2(F.concat("prior", F.lit(b"turn"), "end"), 256)), 1, 16))
    later = later.select("conv_id", "depth", mixed("dig").alias("dig"),
                         F.when((F.col("depth") - 1) % block == 0, before).otherwise(mixed("pdig")).alias("pdig"), "nbytes")
    first = local.filter("block = 0").select("conv_id", "depth", "dig", "pdig", "nbytes")
    roots = total.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("dig"),
                         F.lit(None).cast("binary").alias("pdig"), F.lit(0).cast("long").alias("nbytes"))
    below = join_groups(stage(first.unionByName(later), "trie-turns"), total, ["conv_id"], "total")
    return below.unionByName(roots.join(total, "conv_id"))


def sketch_cells(digests: np.ndarray, cells: int) -> list[np.ndarray]:
    """The cell of each 16-byte digest in each hash row."""
    words = np.ascontiguousarray(digests).view("<u8").reshape(-1, HASH_ROWS)
    return [words[:, i] & np.uint64(cells - 1) for i in range(HASH_ROWS)]


def as_digests(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8)


def count_min(digests: DataFrame, cells: int):
    """Per hash row a bitmap of the cells that were hit more than once (broadcast)."""
    def partial(batches):
        seen = [np.zeros(cells, np.bool_) for _ in range(HASH_ROWS)]
        again = [np.zeros(cells, np.bool_) for _ in range(HASH_ROWS)]
        for batch in batches:
            if batch.num_rows:
                for i, at in enumerate(sketch_cells(as_digests(batch.column(0)), cells)):
                    at, n = np.unique(at, return_counts=True)
                    again[i][at] |= seen[i][at] | (n > 1)
                    seen[i][at] = True
        for i in range(HASH_ROWS):
            for k in np.unique(np.flatnonzero(seen[i]) // SLICE):
                part = slice(k * SLICE, (k + 1) * SLICE)
                yield pa.RecordBatch.from_pydict({
                    "slot": pa.array([i * (cells // SLICE) + int(k)], pa.int64()),
                    "seen": [np.packbits(seen[i][part]).tobytes()], "again": [np.packbits(again[i][part]).tobytes()]})

    def merge(rows):
        slot = None
        for r in rows:
            a, b = (np.frombuffer(r[c], np.uint8) for c in ("seen", "again"))
            if r["slot"] != slot:
                if slot is not None:
                    yield {"slot": slot, "again": again.tobytes()}
                slot, seen, again = r["slot"], a, b
            else:
                again = again | b | (seen & a)
                seen = seen | a
        if slot is not None:
            yield {"slot": slot, "again": again.tobytes()}

    parts = digests.mapInArrow(partial, "slot long, seen binary, again binary")
    merged = mapped(parts.repartition(buckets(digests.sparkSession), "slot").sortWithinPartitions("slot"), merge,
                    pa.schema([("slot", pa.int64()), ("again", pa.binary())]), "slot long, again binary")
    bits = np.zeros(HASH_ROWS * cells // 8, np.uint8)
    for r in merged.toLocalIterator():  # HASH_ROWS * cells / 8 bytes at most
        bits[r["slot"] * SLICE // 8:(r["slot"] + 1) * SLICE // 8] = np.frombuffer(r["again"], np.uint8)
    return digests.sparkSession.sparkContext.broadcast(bits.tobytes())


def screened(paths: DataFrame, max_cells: int = MAX_CELLS) -> DataFrame:
    """``paths`` with two flags: ``alone`` and ``palone``, the estimate of the prefix and
    of its parent is one, so that a single conversation starts with it."""
    size = paths.count()
    cells = MIN_CELLS
    while cells < min(max_cells, CELLS_PER_PREFIX * size):
        cells *= 2
    sketch = count_min(paths.select("dig"), cells)

    def flag(batches):
        bits = np.frombuffer(sketch.value, np.uint8)
        for batch in batches:
            out = []
            for name in ("dig", "pdig"):
                column = batch.column(name).fill_null(ROOT) if batch.num_rows else batch.column(name)
                shared = np.ones(batch.num_rows, np.bool_)
                for i, at in enumerate(sketch_cells(as_digests(column), cells)):
                    at = at.astype(np.int64) + i * cells
                    shared &= (bits[at >> 3] >> (7 - (at & 7)) & 1).astype(np.bool_)
                out.append(pa.array(~shared))
            yield pa.RecordBatch.from_arrays([*batch.columns, *out], names=[*batch.schema.names, "alone", "palone"])

    ddl = "conv_id long, depth long, dig binary, pdig binary, nbytes long, total long, alone boolean, palone boolean"
    return paths.select("conv_id", "depth", "dig", "pdig", "nbytes", "total").mapInArrow(flag, ddl)


def _joined_ids(size):
    def step(rows):
        dig, held, first = None, [], None
        for r in rows:
            if held and (r["dig"] != dig or len(held) == size):
                yield {"dig": dig, "first": first, "ids": ",".join(held)}
                held = []
            if not held:
                dig, first = r["dig"], r["conv_id"]
            held.append(str(r["conv_id"]))
        if held:
            yield {"dig": dig, "first": first, "ids": ",".join(held)}
    return step


def _hashed_ids(rows):
    dig, sha = None, None
    for r in rows:
        if r["dig"] != dig:
            if dig is not None:
                yield {"dig": dig, "ends_sha256": sha.hexdigest()}
            dig, sha = r["dig"], hashlib.sha256(r["ids"].encode())
        else:
            sha.update(("," + r["ids"]).encode())
    if dig is not None:
        yield {"dig": dig, "ends_sha256": sha.hexdigest()}


def ends_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined conv_ids of each digest.  Ids are sorted and
    joined by range, so a node that a third of all conversations end in is sorted by several
    tasks; only the joined strings pass through one, which SHA-256 requires."""
    n = buckets(ends.sparkSession)
    joined = mapped(ends.repartitionByRange(n, "dig", "conv_id").sortWithinPartitions("dig", "conv_id"), _joined_ids(4096),
                    pa.schema([("dig", pa.binary()), ("first", pa.int64()), ("ids", pa.string())]),
                    "dig binary, first long, ids string")
    return mapped(joined.repartition(n, "dig").sortWithinPartitions("dig", "first"), _hashed_ids,
                  pa.schema([("dig", pa.binary()), ("ends_sha256", pa.string())]), "dig binary, ends_sha256 string")


def summed_back(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``rows`` (conv_id, depth, dig, leaf, saved) with leaf and saved summed over the
    conversation's rows at this depth or below, block by block."""
    rows = rows.withColumn("block", F.floor(F.col("depth") / block))
    sums = rows.groupBy("conv_id", "block").agg(F.sum("leaf").alias("leafs"), F.sum("saved").alias("saves"))
    after = Window.partitionBy("conv_id").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    later = (sums.select("conv_id", "block", F.sum("leafs").over(after).alias("leafs"), F.sum("saves").over(after).alias("saves"))
             .filter("leafs > 0 or saves > 0"))
    down = Window.partitionBy("conv_id", "block").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("leaf", F.sum("leaf").over(down)).withColumn("saved", F.sum("saved").over(down))
    return rows.join(later, ["conv_id", "block"], "left").select(
        "dig", (F.col("leaf") + F.coalesce("leafs", F.lit(0))).alias("leaf"),
        (F.col("saved") + F.coalesce("saves", F.lit(0))).alias("saved"))


def trie_nodes(paths: DataFrame, max_cells: int = MAX_CELLS, block: int = BLOCK) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
    of every node of ``paths`` (the rows of :func:`prefixes`), and its digest ``dig``."""
    paths = stage(screened(stage(paths, "trie-paths"), max_cells), "trie-screened")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    is_end = F.col("depth") == F.col("total")
    tails, maybe = paths.filter("alone"), paths.filter("not alone")
    # What a digest determines (parent, depth, last text's bytes) may stand in the key.
    nodes = stage(maybe.groupBy("dig", "pdig", "depth", "nbytes").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")), "trie-nodes")
    tops = tails.filter("not palone and depth > 0")  # a proven singleton below a node that may be shared
    children = nodes.select("pdig").unionByName(tops.select("pdig")).filter("pdig is not null").groupBy(
        F.col("pdig").alias("dig")).agg(F.count("*").alias("n_children"))
    nodes = stage(nodes.join(children, "dig", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))),
                  "trie-children")
    # Credits: a leaf to the smallest conversation that ends in it, a node's saving to its smallest member.
    placed = join_groups(maybe.select("conv_id", "depth", "dig", "total"),
                         nodes.select("dig", "n_convs", F.col("conv_id").alias("least"), "nbytes", "n_children"), ["dig"], "n_convs")
    least = F.col("conv_id") == F.col("least")
    credits = placed.select(
        "conv_id", "depth", "dig", F.when(is_end & least & (F.col("n_children") == 0), 1).otherwise(0).cast("long").alias("leaf"),
        F.when(least, (F.col("n_convs") - 1) * F.col("nbytes")).otherwise(0).cast("long").alias("saved"))
    ended = tails.filter(is_end).select("conv_id", "depth", F.lit(None).cast("binary").alias("dig"),
                                        F.lit(1).cast("long").alias("leaf"), F.lit(0).cast("long").alias("saved"))
    sums = summed_back(stage(credits.unionByName(ended), "trie-credits"), block).filter("dig is not null").groupBy("dig").agg(
        F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    shas = ends_digests(maybe.filter(is_end).select("dig", "conv_id"))
    exact = nodes.join(sums, "dig").join(shas, "dig", "left").select(
        "dig", "pdig", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", empty).alias("ends_sha256"))
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    local = tails.select(
        "dig", "pdig", "palone", "conv_id", "depth", one.alias("n_convs"), F.when(is_end, none).otherwise(one).alias("n_children"),
        one.alias("n_leaves"), none.alias("saved_tokens"),
        F.when(is_end, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(empty).alias("ends_sha256"))
    # A parent that may be shared has its smallest member in ``nodes``; any other is this conversation's own.
    waiting = stage(exact.withColumn("palone", F.lit(False)).unionByName(local.filter("not palone")), "trie-waiting")
    parents = nodes.select(F.col("dig").alias("pdig"), F.col("conv_id").alias("parent"), "n_children")
    linked = join_groups(waiting.withColumnRenamed("n_children", "kids"), parents, ["pdig"], "n_children", "left").drop(
        "n_children").withColumnRenamed("kids", "n_children")
    own = local.filter("palone").withColumn("parent", F.col("conv_id"))
    return linked.unionByName(own).select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("parent", "conv_id")).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "dig")


def conversation_trie(convs: DataFrame, max_cells: int = MAX_CELLS) -> DataFrame:
    """The trie of the conversations as they are (no turns lent between them)."""
    turns = stage(turns_in_order(convs), "trie-numbered")
    return trie_nodes(prefixes(turns, turns.groupBy("conv_id").agg(F.max("pos").alias("total"))), max_cells)


def rebuilt_trie(convs: DataFrame, max_cells: int = MAX_CELLS) -> DataFrame:
    """The query: the trie of the rebuilt conversations."""
    turns, total = rebuild(stage(turns_in_order(convs), "trie-numbered"))
    return trie_nodes(prefixes(turns, total), max_cells).drop("dig")
