"""Cross-entropy difference between matched target and background bigram models.

Both models are word bigram models with one shared vocabulary (all words of the
table), the same smoothing and the same unknown mass; the target model counts the
target rows, the background model all rows.  Per token

    loss = -log2((c(w1 w2) + mu / V) / (c(w1) + mu))

and a document's score is its mean target loss minus its mean background loss: the
lower, the more target-like.  Words are ASCII-lower-cased runs of anything but ASCII
white space; a document's first word follows a start mark.

Counting and scoring take one shuffle of token bigrams, packed as hashes (40 bits of
the first word beside its bucket, 32 of the second) and dealt out by first word: a bucket
holds all bigrams of its first words, so it has every count it needs.  It returns partial
losses to the slices of text that the bigrams came from, by the document's number in its
slice; the slice's list of documents travels once.  A slice is named by a hash of that list,
and rows are sorted within their partition first, so a task that runs again makes the same
slices.  First words with about a
thousandth of all tokens or more are found beforehand (a bounded list) and dealt out
by second word as well; their totals travel along as counts.

The vocabulary size is estimated by a HyperLogLog sketch of all words (2**14
registers, standard error 0.8 %) unless it is given.

Defined cases: null and empty texts have no tokens, null losses and score 0; a null
doc_id is scored and is not a target row; repeated rows count each time and each get
a row; without target rows the target model is uniform; an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import buckets
from orderlens.llm.decontaminate import FOLD
from orderlens.llm.repeats import cut_rows, packed
from orderlens.llm.scan import WHITE, mix, pieces, sliced, utf8, word_hashes, words

MU = 100.0
HOT_SHARE = 1000               # a hot word has at least one in so many tokens
SLOTS = 16                     # buckets that a hot first word is dealt to
REGISTER_BITS = 14
START = np.uint64(0x5354415254)
CODE_BYTES = 5
SLICE_BYTES = 1 << 23          # text packed at a time
PARTS = 4                      # a bucket's first words are scored in so many parts
#: Target ids up to this number (8 MB) are broadcast to the scan; beyond it they are joined by shuffle.
BROADCAST_IDS = 1_000_000


def code_of(first: np.ndarray) -> np.ndarray:
    """The low forty bits of a first word's mixed hash; its bucket comes from the highest bits."""
    return mix(first) & np.uint64((1 << 8 * CODE_BYTES) - 1)


def short(codes: np.ndarray) -> bytes:
    return np.ascontiguousarray(codes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :CODE_BYTES]).tobytes()


def long(packed_codes: bytes) -> np.ndarray:
    wide = np.zeros((len(packed_codes) // CODE_BYTES, 8), np.uint8)
    wide[:, :CODE_BYTES] = np.frombuffer(packed_codes, np.uint8).reshape(-1, CODE_BYTES)
    return wide.view(np.uint64).ravel()


def slice_name(rows: np.ndarray) -> int:
    """A slice's name: a hash of its row hashes in order, not negative."""
    place = np.arange(1, len(rows) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return int(np.bitwise_xor.reduce(mix(rows.view(np.uint64) + place)) >> np.uint64(1))


def _words(column: pa.Array):
    """Per piece: (first document, word hashes, document of each word)."""
    buf, offsets = utf8(column)
    for first, last in pieces(offsets):
        lo = offsets[first]
        part = FOLD[buf[lo:offsets[last]]]
        start, end, doc = words(part, offsets[first:last + 1] - lo, ~WHITE)
        if len(start):
            yield first, word_hashes(part, start, end), doc


def _first_words(word: np.ndarray, doc: np.ndarray) -> np.ndarray:
    before = np.empty_like(word)
    before[0] = START
    before[1:] = np.where(doc[1:] == doc[:-1], word[:-1], START)
    return before


def vocabulary(texts: DataFrame) -> tuple[int, list[int]]:
    """(estimated number of words, first words that may be hot).

    A word with 1/HOT_SHARE of all tokens has a quarter of that share in some task, and
    the tasks where it has less can hide a quarter of the bound at most: the sums over
    the tasks that report it reach three quarters, which at most 4/3 HOT_SHARE words do.
    """
    def run(batches):
        registers, total = np.zeros(1 << REGISTER_BITS, np.uint8), 0
        word, count = np.empty(0, np.uint64), np.empty(0, np.int64)
        for b in sliced(batches, 0):
            parts, sizes = [word], [count]
            for _, w, _ in _words(b.column(0)):
                w, n = np.unique(w, return_counts=True)
                parts.append(w)
                sizes.append(n)
                total += int(n.sum())
                slot = (w >> np.uint64(64 - REGISTER_BITS)).astype(np.int64)
                rest = (w << np.uint64(REGISTER_BITS)) | np.uint64(1 << (REGISTER_BITS - 1))
                zeros = (63 - np.floor(np.log2(rest.astype(np.float64)))).clip(0).astype(np.uint8)
                np.maximum.at(registers, slot, zeros + 1)
            allw, alln = np.concatenate(parts), np.concatenate(sizes)
            word, at = np.unique(allw, return_inverse=True)
            count = np.bincount(at, weights=alln, minlength=len(word)).astype(np.int64)
        if total:
            often = count * 4 * HOT_SHARE >= total
            yield pa.RecordBatch.from_arrays(
                [pa.array([registers.tobytes()], pa.binary()), pa.array([total], pa.int64()),
                 pa.array([word[often].view(np.int64).tolist()], pa.list_(pa.int64())),
                 pa.array([count[often].tolist()], pa.list_(pa.int64()))],
                names=["registers", "total", "words", "counts"])

    found = texts.select("text").mapInArrow(
        run, "registers binary, total long, words array<long>, counts array<long>").persist()
    total = found.agg(F.sum("total")).first()[0] or 0
    hot = (found.select(F.explode(F.arrays_zip("words", "counts")).alias("w"))
           .groupBy("w.words").agg(F.sum("w.counts").alias("n"))
           .filter(F.col("n") * 4 * HOT_SHARE >= 3 * total).select("words").orderBy("words"))
    hot = [r[0] for r in hot.collect()]                    # at most 4/3 HOT_SHARE words

    def merge(batches):
        registers = np.zeros(1 << REGISTER_BITS, np.uint8)
        for b in batches:
            for r in b.column(0):
                registers = np.maximum(registers, np.frombuffer(r.as_py(), np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([registers.tobytes()], pa.binary())], names=["registers"])

    rows = found.select("registers").coalesce(64).mapInArrow(merge, "registers binary").collect()
    found.unpersist()
    registers = np.zeros(1 << REGISTER_BITS, np.uint8)
    for r in rows:                                         # at most 64 sketches of 16 KB
        registers = np.maximum(registers, np.frombuffer(r[0], np.uint8))
    return cardinality(registers), hot


def cardinality(registers: np.ndarray) -> int:
    m = len(registers)
    raw = 0.7213 / (1 + 1.079 / m) * m * m / (2.0 ** -registers.astype(float)).sum()
    empty = int((registers == 0).sum())
    return max(1, round(m * np.log(m / empty) if raw <= 2.5 * m and empty else raw))


def lm_scores(docs: DataFrame, is_target: Column, mu: float = MU, vocabulary_size: int | None = None) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, score; one row per row of ``docs``.

    ``is_target`` is a boolean column over ``docs`` (null: no).
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    src = docs.select("doc_id", F.xxhash64("doc_id", text).alias("row"), text.alias("text"),
                      F.coalesce(is_target, F.lit(False)).alias("target"))
    size, hot_words = vocabulary(docs.select(text.alias("text")))
    size = vocabulary_size or size
    n = buckets(docs.sparkSession)
    hot_list = np.array(sorted({int(np.uint64(w & (1 << 64) - 1)) for w in hot_words} | {int(START)}), np.uint64)

    def bucket_of(h):
        return ((mix(h) >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)

    def deal(batches):
        for b in sliced(batches, 1, SLICE_BYTES):
            rows, target = b.column(0).to_numpy(), b.column(2).to_numpy(zero_copy_only=False)
            parts = [(w, _first_words(w, d), d + first) for first, w, d in _words(b.column(1))]
            if not parts:
                continue
            word, before, doc = map(np.concatenate, zip(*parts))
            at = np.searchsorted(hot_list, before).clip(0, len(hot_list) - 1)
            is_hot = hot_list[at] == before
            slot = np.where(is_hot, word % np.uint64(SLOTS) + np.uint64(1), np.uint64(0))
            bucket = bucket_of(before + slot * np.uint64(0x9E3779B97F4A7C15)).astype(np.int64)
            first, second = code_of(before), (mix(word) >> np.uint64(32)).astype(np.uint32)
            order = np.lexsort((first, bucket))
            name, nothing = slice_name(rows), (b"",) * 7
            out = [(name % n, name, *nothing, rows.tobytes())]
            for k, (f, p, d) in cut_rows(bucket[order], first[order], second[order], doc[order]):
                cut = np.flatnonzero(np.concatenate([[True], f[1:] != f[:-1]]))
                here, at = np.unique(d, return_inverse=True)
                out.append((int(k), name, short(f[cut]), np.diff(np.append(cut, len(f))).astype(np.uint32).tobytes(),
                            p.tobytes(), at.astype(np.uint16).tobytes(), here.astype(np.uint16).tobytes(),
                            np.packbits(target[here]).tobytes(), b"", b""))
            # totals of hot first words, to every bucket that holds a part of them
            w = before[is_hot]
            if len(w):
                hot, inverse = np.unique(w, return_inverse=True)
                names = code_of(hot)
                all_n = np.bincount(inverse)
                target_n = np.bincount(inverse, weights=target[doc[is_hot]])
                slots = np.arange(1, SLOTS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                places = bucket_of(hot[:, None] + slots[None, :])
                for k in np.unique(places).tolist():
                    here = (places == k).any(axis=1)
                    body = np.column_stack([names[here], all_n[here].astype(np.uint64),
                                            target_n[here].astype(np.uint64)])
                    out.append((int(k), name, *nothing[1:], np.ascontiguousarray(body).tobytes(), b""))
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), *packed(*cols[2:])],
                names=["bucket", "slice", "first", "many", "second", "doc", "here", "flags", "hot", "rows"])

    def sent(out):
        cols = list(zip(*out))
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *packed(*cols[1:])],
                                          names=["place", "slices", "many", "here", "n", "t", "b", "rows"])

    def judge(batches):
        # a task may hold several buckets: each is finished by itself
        held: dict[int, list] = {}
        for b in batches:
            for bucket, name, *blob, rows in zip(*(x.to_pylist() for x in b.columns)):
                if rows:
                    yield sent([(name % n, np.int64(name).tobytes(), *(b"",) * 5, rows)])
                else:
                    held.setdefault(bucket, []).append((name, *blob))
        for bucket in sorted(held):
            yield from score(held.pop(bucket))

    def score(blobs):
        hot = [np.frombuffer(x[7], np.uint64).reshape(-1, 3) for x in blobs if x[7]]
        blobs = [x for x in blobs if not x[7]]
        if not blobs:
            return
        here = [np.frombuffer(x[5], np.uint16) for x in blobs]
        flags = np.concatenate([np.unpackbits(np.frombuffer(x[6], np.uint8))[:len(h)] for x, h in zip(blobs, here)])
        ahead = np.cumsum([0] + [len(h) for h in here])
        totals = [np.zeros(len(flags)) for _ in range(3)]
        for part in range(PARTS):
            for total, more in zip(totals, part_sums(blobs, part, ahead, flags, hot)):
                total += more
        places: dict[int, list] = {}
        for k, x in enumerate(blobs):
            places.setdefault(x[0] % n, []).append(k)
        out = []
        for place, ks in sorted(places.items()):
            m, t, b = (np.concatenate([x[ahead[k]:ahead[k + 1]] for k in ks]) for x in totals)
            out.append((place, np.array([blobs[k][0] for k in ks], np.int64).tobytes(),
                        np.array([len(here[k]) for k in ks], np.uint32).tobytes(),
                        b"".join(here[k].tobytes() for k in ks), m.astype(np.uint32).tobytes(), t.tobytes(), b.tobytes(), b""))
        yield sent(out)

    def unite(batches):
        """The sums of each row over all buckets; equal slices have one list of rows."""
        listed, got = {}, []
        for batch in batches:
            for slices, *sums, rows in zip(*(batch.column(i).to_pylist() for i in range(1, 8))):
                if rows:
                    listed[int(np.frombuffer(slices, np.int64)[0])] = np.frombuffer(rows, np.int64)
                else:
                    got.append((slices, *sums))
        if got:
            names = np.array(sorted(listed), np.int64)
            ahead = np.cumsum([0] + [len(listed[k]) for k in names.tolist()])
            slices, many, here, m, t, b = (np.concatenate([np.frombuffer(x, kind) for x in column]) for column, kind in zip(
                zip(*got), (np.int64, np.uint32, np.uint16, np.uint32, np.float64, np.float64)))
            at = np.searchsorted(names, slices).clip(0, max(0, len(names) - 1))
            if not len(names) or (names[at] != slices).any():
                raise RuntimeError("losses of a slice that has no list of rows")
            at = np.repeat(ahead[at], many) + here
            m, t, b = (np.bincount(at, weights=x, minlength=ahead[-1]) for x in (m, t, b))
            row = np.concatenate([listed[k] for k in names.tolist()])
            known = np.flatnonzero(m)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row[known]), pa.array(m[known].astype(np.int64)), pa.array(t[known]), pa.array(b[known])],
                names=["row", "n", "t", "b"])

    def part_sums(blobs, part, ahead, flags, hot):
        """Tokens, target losses and background losses per row, for one part of the first words."""
        first, pair, doc = [], [], []
        for (_, f, m, p, d, *_), start in zip(blobs, ahead):
            f, m = long(f), np.frombuffer(m, np.uint32)
            mine = f % np.uint64(PARTS) == part
            entries = np.repeat(mine, m)
            first.append(np.repeat(f[mine], m[mine]))
            pair.append(np.frombuffer(p, np.uint32)[entries])
            doc.append(np.frombuffer(d, np.uint16)[entries].astype(np.int64) + start)
        first, pair, doc = map(np.concatenate, (first, pair, doc))
        if not len(first):
            return [np.zeros(len(flags))] * 3
        order = np.lexsort((pair, first))
        first, pair, doc = first[order], pair[order], doc[order]
        mine = flags[doc].astype(np.float64)
        start1 = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
        start2 = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (pair[1:] != pair[:-1])]))
        n1, n2 = np.diff(np.append(start1, len(first))), np.diff(np.append(start2, len(first)))
        all1, all2 = n1.astype(float), n2.astype(float)
        target1, target2 = np.add.reduceat(mine, start1), np.add.reduceat(mine, start2)
        if hot:
            found = np.concatenate(hot)
            word, inverse = np.unique(found[:, 0], return_inverse=True)
            total = np.bincount(inverse, weights=found[:, 1]), np.bincount(inverse, weights=found[:, 2])
            at = np.searchsorted(word, first[start1]).clip(0, len(word) - 1)
            known = word[at] == first[start1]
            all1[known], target1[known] = total[0][at[known]], total[1][at[known]]
        one = np.searchsorted(start1, start2, "right") - 1     # first word of each bigram
        loss = [np.repeat(-np.log2((c2 + mu / size) / (c1[one] + mu)), n2)
                for c2, c1 in ((target2, target1), (all2, all1))]
        return [np.bincount(doc, weights=x, minlength=len(flags)) for x in (None, *loss)]

    part = (src.select("row", "text", "target").sortWithinPartitions("row")
            .mapInArrow(deal, "bucket int, slice long, first binary, many binary, second binary, doc binary, "
                              "here binary, flags binary, hot binary, rows binary")
            .repartition(n, "bucket")
            .mapInArrow(judge, "place int, slices binary, many binary, here binary, n binary, t binary, b binary, rows binary")
            .repartition(n, "place").mapInArrow(unite, "row long, n long, t double, b double"))
    nothing = [F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("t"), F.lit(0.0).alias("b")]
    rows = docs.select(F.xxhash64("doc_id", text).alias("row"), "doc_id", F.lit(1).alias("copies"), *nothing)
    both = rows.unionByName(part.select("row", F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"),
                                        F.lit(0).alias("copies"), "n", "t", "b"))
    total = both.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.sum("copies").alias("copies"),
                                    F.sum("n").alias("n"), F.sum("t").alias("t"), F.sum("b").alias("b"))
    mean = [F.when(F.col("n") > 0, F.col(c) / F.col("n")) for c in ("t", "b")]
    return (total.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select("doc_id", F.expr("n div copies").alias("n_tokens"), mean[0].alias("target_loss"),
                    mean[1].alias("background_loss"), F.coalesce(mean[0] - mean[1], F.lit(0.0)).alias("score")))


def quality_scores(docs: DataFrame, labels: DataFrame, mu: float = MU) -> DataFrame:
    """``lm_scores`` with the rows labelled quality 1 as target."""
    good = (labels.filter("quality = 1 and doc_id is not null").select("doc_id").distinct()
            .withColumn("_good", F.lit(True)))
    if good.count() <= BROADCAST_IDS:
        good = F.broadcast(good)
    return lm_scores(docs.select("doc_id", "text").join(good, "doc_id", "left"), F.col("_good"), mu)
