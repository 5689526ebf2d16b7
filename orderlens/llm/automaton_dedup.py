"""Substring deduplication with suffix automata: repeated word windows keep their first place.

Words are runs of anything but ASCII white space.  Every word covered by a window of
``window`` words that also starts earlier (smaller doc_id, or earlier in the same
document) is removed; windows are judged on the input.

Here the reference is the corpus itself, so its automata grow with the input and
cannot be broadcast: each reference shard, the passages around one anchor, is dealt
to the task that also receives all text with that anchor (``repeats``).  In order of
place, each passage is streamed through the automaton of the earlier ones; matching
statistics of ``window`` words or more mark its spans; then it joins the automaton.
``match_reference`` is the broadcast form for a reference of bounded size.

Defined cases: a null text has no words; a null doc_id ranks after all ids; of two
rows with the same doc_id the one with the smaller text hash counts as earlier, and
rows equal in both count as one (each gets its result); texts under ``window`` words
lose nothing; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import stage
from orderlens.llm.repeats import (Words, load_segments, merge_spans, removed_spans, repeats, row_id, span_rows,
                                    text_classes)

WINDOW, GRAM = 20, 5
REFERENCE_WORDS = 500_000      # what match_reference may broadcast


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, words: list) -> None:
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for w in words:
            known = nxt[last].get(w)
            if known is not None:
                last = known if length[known] == length[last] + 1 else self._split(last, w, known)
                continue
            new = len(nxt)
            nxt.append({})
            link.append(0)
            length.append(length[last] + 1)
            at = last
            while at >= 0 and w not in nxt[at]:
                nxt[at][w] = new
                at = link[at]
            if at >= 0:
                target = nxt[at][w]
                if length[target] != length[at] + 1:
                    target = self._split(at, w, target)
                link[new] = target
            last = new

    def _split(self, at: int, w, target: int) -> int:
        copy = len(self.next)
        self.next.append(dict(self.next[target]))
        self.link.append(self.link[target])
        self.length.append(self.length[at] + 1)
        self.link[target] = copy
        while at >= 0 and self.next[at].get(w) == target:
            self.next[at][w] = copy
            at = self.link[at]
        return copy

    def statistics(self, words: list) -> list[int]:
        """For each word the length of the longest run that ends there and occurs in the automaton."""
        nxt, link, length = self.next, self.link, self.length
        state, matched, out = 0, 0, []
        for w in words:
            while state and w not in nxt[state]:
                state = link[state]
                matched = length[state]
            if w in nxt[state]:
                state = nxt[state][w]
                matched += 1
            out.append(matched)
        return out


def _later_windows(passages: list[tuple], window: int):
    """(index, first window, windows) of runs that an earlier passage of the list has.

    ``passages`` are (index, words) in order of place; equal ones need no automaton.
    """
    seen: set = set()
    automaton = None
    first = passages[0][1]
    for index, words in passages:
        content = tuple(words)
        if content in seen:
            yield index, 0, len(words) - window + 1
            continue
        if seen:
            if automaton is None:
                automaton = SuffixAutomaton()
                automaton.add(first)
            run = None
            for at, n in enumerate(automaton.statistics(words) + [0]):
                if n >= window:
                    run = at if run is None else run
                elif run is not None:
                    yield index, run - window + 1, at - run
                    run = None
            automaton.add(words)
        seen.add(content)


def judge(window: int):
    def run(batches):
        kept, settled = load_segments(batches)
        if settled is not None:
            rid, key, start, windows = settled
            yield from span_rows(rid, key, start, start + windows - 1 + window)
        if kept is None:
            return
        rid, key, start, windows, code, size, data = kept
        raw, offset = data.tobytes(), (np.cumsum(size) - size).tolist()
        size = size.tolist()
        order = np.lexsort((start, key, rid, code))
        order = order[~repeats(code[order], rid[order], key[order], start[order])]      # repeated rows count once
        sorted_codes = code[order]
        cut = np.flatnonzero(np.concatenate([[True], sorted_codes[1:] != sorted_codes[:-1]]))
        bounds = np.append(cut, len(order)).tolist()
        found = []
        for a, z in zip(bounds[:-1], bounds[1:]):
            if z - a < 2:
                continue
            group = order[a:z].tolist()
            found.extend(_later_windows(
                [(i, raw[offset[i]:offset[i] + size[i]].split()) for i in group], window))
        if found:
            index, first, many = np.array(found, np.int64).T
            begin = start[index] + first
            yield from span_rows(rid[index], key[index], begin, begin + many - 1 + window)

    return run


def _word_rows(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, key, sha, n_words, words_sha, copies); sha identifies the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def run(batches):
        for b in batches:
            out = []
            for t in b.column(3):
                raw = t.as_py().encode("utf-8")
                words = raw.split()                        # bytes: splits at ASCII white space only
                out.append((hashlib.sha256(raw).digest(), len(words), hashlib.sha256(b" ".join(words)).hexdigest()))
            cols = list(zip(*out)) or [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.string())], names=["rid", "doc_id", "key", "sha", "n_words", "words_sha"])

    return (docs.select(row_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
                        F.xxhash64(text).alias("key"), text.alias("text"))
            .mapInArrow(run, "rid long, doc_id long, key long, sha binary, n_words long, words_sha string")
            .groupBy("rid", "doc_id", "key", "sha", "n_words", "words_sha").agg(F.count("*").alias("copies")))


def automaton_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256; ``with_text`` adds kept (the words left, null when
    nothing was removed) and spans.  One row per row of ``docs``."""
    placed = text_classes(stage(_word_rows(docs), "rows"))
    cut = removed_spans(docs, placed, Words(window, min(gram, window)), True, judge(window))

    def finish(batches):
        for b in batches:
            out = []
            for rid, key, text, blobs in zip(*(x.to_pylist() for x in b.columns)):
                words = text.encode("utf-8").split()
                spans = merge_spans(blobs, len(words))
                edges = [0, *spans.ravel().tolist(), len(words)]
                left = [w for a, z in zip(edges[::2], edges[1::2]) for w in words[a:z]]
                kept = b" ".join(left)
                out.append((rid, key, len(words) - len(left), hashlib.sha256(kept).hexdigest(),
                            kept if with_text else None, spans.ravel().tolist() if with_text else None))
            cols = list(zip(*out)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(),
                                                       pa.list_(pa.int64())))],
                names=["rid", "key", "n_removed", "kept_sha256", "kept", "spans"])

    changed = cut.mapInArrow(
        finish, "rid long, key long, n_removed long, kept_sha256 string, kept binary, spans array<long>"
    ).dropDuplicates(["rid", "key"])            # repeated rows
    whole = (F.col("rid") > F.col("rep")) & (F.col("n_words") >= window)
    result = placed.join(changed, ["rid", "key"], "left").select(
        "doc_id", "copies", "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "words_sha")).alias("kept_sha256"),
        F.when(whole, F.lit("").cast("binary")).otherwise(F.col("kept")).alias("kept"),
        F.when(whole, F.array(F.lit(0).cast("long"), F.col("n_words"))).otherwise(F.col("spans")).alias("spans"),
    ).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + (["kept", "spans"] if with_text else [])
    return result.select(*names)


def match_reference(docs: DataFrame, reference: DataFrame, window: int = WINDOW,
                    most_words: int = REFERENCE_WORDS) -> DataFrame:
    """doc_id, spans: the word spans of each text that the reference texts hold, too.

    The reference is split into shards of at most ``most_words`` words; the automaton
    of each shard is broadcast and all documents are streamed through it.  Spans of
    different shards are united; documents without one have an empty list.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    src = docs.select(row_id().alias("rid"), "doc_id", F.xxhash64(text).alias("key"), text.alias("text"))
    shards, shard, filled = [], [], 0
    for row in reference.select(F.col("text").cast("string").alias("text")).filter("text is not null").toLocalIterator():
        words = row["text"].encode("utf-8").split()
        if shard and filled + len(words) > most_words:
            shards.append(shard)
            shard, filled = [], 0
        shard.append(words)
        filled += len(words)
    shards += [shard] if shard else []

    def scanner(sent):
        def run(batches):
            automaton = SuffixAutomaton()
            for words in sent.value:
                automaton.add(words)
            for b in batches:
                rid, key, start, end = [], [], [], []
                for r, k, t in zip(*(b.column(c).to_pylist() for c in range(3))):
                    for at, n in enumerate(automaton.statistics(t.encode("utf-8").split())):
                        if n >= window:
                            rid.append(r), key.append(k), start.append(at - n + 1), end.append(at + 1)
                yield from span_rows(*(np.array(x, np.int64) for x in (rid, key, start, end)))
        return run

    found = src.select("rid", "key").limit(0).withColumn("spans", F.lit(None).cast("binary"))
    for shard in shards:
        found = found.unionByName(src.select("rid", "key", "text").mapInArrow(
            scanner(spark.sparkContext.broadcast(shard)), "rid long, key long, spans binary"))

    @F.udf("array<struct<first:long,end:long>>")
    def united(blobs):
        if not blobs:
            return []
        return [(int(a), int(z)) for a, z in merge_spans(blobs, 1 << 62)]

    return (src.select("rid", "key", "doc_id")
            .join(found.groupBy("rid", "key").agg(F.collect_list("spans").alias("blobs")), ["rid", "key"], "left")
            .select("doc_id", united("blobs").alias("spans")))
