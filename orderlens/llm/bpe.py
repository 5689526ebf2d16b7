"""Byte-level BPE encoding and decoding with a segment tree over pair ranks.

The vocabulary is a public ``tokenizers`` JSON file whose path is a parameter and
which every task opens itself.  A text is split at the file's added tokens and
then by the byte-level pattern; within a piece the leaves of a segment tree hold
the merge rank of each adjacent pair, the root names the leftmost pair of lowest
rank, and a merge updates three leaves in logarithmic time, until no pair can be
merged.  Pieces recur, so each task keeps the encodings of recent ones in a cache
of bounded size; the short pieces that it lacks are merged together, a tree each.

Defined cases: a null text counts as empty and has no tokens; repeated rows each
get a row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the split pattern of byte-level BPE vocabularies of this family.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

CACHE_PIECES, CACHED_LENGTH = 600_000, 64
#: A leaf holds rank << PLACE_BITS | place, so the least leaf is the leftmost lowest rank.
ID_BITS, PLACE_BITS = 20, 34
PLACE = (1 << PLACE_BITS) - 1
NO_PAIR = 1 << 62
#: In trees of many short pieces a leaf has this many bits for the place.
SHORT_BITS, NO_RANK = 7, 1 << 40
#: Texts of about so many characters have their new pieces encoded together.
BATCH_CHARS = 1 << 20


def byte_alphabet() -> dict[str, int]:
    """The visible character that stands for each byte in the vocabulary file."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class BytePairs:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, alphabet = spec["model"]["vocab"], byte_alphabet()
        as_bytes = {t: bytes(alphabet[c] for c in t) for t in vocab}
        self.bytes_of = {i: as_bytes[t] for t, i in vocab.items()}
        self.byte_id = [0] * 256
        for c, b in alphabet.items():
            self.byte_id[b] = vocab[c]
        self.rank, self.merged = {}, []
        for pair in spec["model"]["merges"]:
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank.setdefault(vocab[a] << ID_BITS | vocab[b], len(self.merged) << PLACE_BITS)
            self.merged.append(vocab[a + b])
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of |= {i: c.encode("utf-8") for c, i in self.added.items()}
        self.split = regex.compile("|".join(
            regex.escape(c) for c in sorted(self.added, key=len, reverse=True))) if self.added else None
        self.pieces = regex.compile(PATTERN).findall
        self.new, self.old, self.odd = {}, {}, {}
        keys = np.array(list(self.rank), np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], np.array(list(self.rank.values()), np.int64)[order] >> PLACE_BITS
        self.merged_ids, self.byte_ids = np.array(self.merged, np.int64), np.array(self.byte_id, np.int64)

    def merge(self, ids: list[int]) -> list[int]:
        """The token ids of one piece given as byte ids."""
        n = len(ids)
        if n < 2:
            return ids
        rank, merged, leaves = self.rank.get, self.merged, n - 1
        size = 1 << (leaves - 1).bit_length()
        tree = [NO_PAIR] * (2 * size)
        left = ids[0]
        for i in range(leaves):
            right = ids[i + 1]
            tree[size + i] = rank(left << ID_BITS | right, NO_PAIR) | i
            left = right
        for i in range(size - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (best := tree[1]) < NO_PAIR:
            i = best & PLACE
            gone = after[i]
            token = ids[i] = merged[best >> PLACE_BITS]
            ids[gone] = -1
            follow = after[i] = after[gone]
            mid = size + i
            if follow < n:
                before[follow] = i
                tree[mid] = rank(token << ID_BITS | ids[follow], NO_PAIR) | i
            else:
                tree[mid] = NO_PAIR
            high = mid
            if gone < leaves:
                high = size + gone
                tree[high] = NO_PAIR
            low, previous = mid, before[i]
            if previous >= 0:
                low = size + previous
                tree[low] = rank(ids[previous] << ID_BITS | token, NO_PAIR) | previous
            # the three changed leaves climb together; paths that have met are walked once
            while high > 1:
                a, b = tree[low], tree[low ^ 1]
                up = low >> 1
                tree[up] = a if a < b else b
                if (mid >> 1) != up:
                    a, b = tree[mid], tree[mid ^ 1]
                    tree[mid >> 1] = a if a < b else b
                if (high >> 1) != (mid >> 1):
                    a, b = tree[high], tree[high ^ 1]
                    tree[high >> 1] = a if a < b else b
                low, mid, high = up, mid >> 1, high >> 1
        return [t for t in ids if t >= 0]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of tokens; NO_RANK where they do not merge."""
        key = left << ID_BITS | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NO_RANK)

    def merge_many(self, pieces: list[bytes], size: int) -> np.ndarray:
        """:meth:`merge` for many pieces of 2 to ``size`` + 1 bytes at once: one segment tree
        a row, all rows merge their leftmost lowest pair in each step.  Ids, -1 where merged away."""
        count, length = len(pieces), np.array([len(p) for p in pieces])
        inside = np.arange(size + 1) < length[:, None]
        ids = np.full((count, size + 1), -1, np.int64)
        ids[inside] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        tree = np.full((count, 2 * size + 1), NO_RANK << SHORT_BITS, np.int64)
        pairs = inside[:, 1:]
        row, at = np.nonzero(pairs)
        tree[:, size:2 * size][pairs] = self._ranks(ids[row, at], ids[row, at + 1]) << SHORT_BITS | at
        level = size
        while level > 1:
            level >>= 1
            tree[:, level:2 * level] = np.minimum(tree[:, 2 * level:4 * level:2], tree[:, 2 * level + 1:4 * level:2])
        after = np.tile(np.arange(1, size + 2), (count, 1))
        before = np.tile(np.arange(-1, size), (count, 1))
        live = np.flatnonzero(tree[:, 1] < NO_RANK << SHORT_BITS)
        while len(live):
            best = tree[live, 1]
            i, token = best & ((1 << SHORT_BITS) - 1), self.merged_ids[best >> SHORT_BITS]
            gone = after[live, i]
            follow = after[live, gone]
            ids[live, i], ids[live, gone], after[live, i] = token, -1, follow
            has = follow < length[live]
            before[live[has], follow[has]] = i[has]
            right = np.full(len(live), NO_RANK)
            right[has] = self._ranks(token[has], ids[live[has], follow[has]])
            tree[live, size + gone] = NO_RANK << SHORT_BITS
            tree[live, size + i] = right << SHORT_BITS | i
            prior = before[live, i]
            has = prior >= 0
            tree[live[has], size + prior[has]] = self._ranks(ids[live[has], prior[has]], token[has]) << SHORT_BITS | prior[has]
            up = [size + i, size + np.minimum(gone, size - 1), size + np.maximum(prior, 0)]
            step = size
            while step > 1:                                # the changed leaves' paths, level by level
                step >>= 1
                up = [u >> 1 for u in up]
                for u in up:
                    tree[live, u] = np.minimum(tree[live, 2 * u], tree[live, 2 * u + 1])
            live = live[tree[live, 1] < NO_RANK << SHORT_BITS]
        return ids

    def learn(self, pieces: set[str]) -> None:
        """Encode pieces that the cache lacks, those of up to 65 bytes together."""
        if len(self.new) >= CACHE_PIECES:
            self.old, self.new = self.new, {}
        groups: dict[int, list] = {}
        for p in pieces.difference(self.new):
            ids = self.old.get(p)
            if ids is not None:
                self.new[p] = ids
            else:
                raw = p.encode("utf-8")
                if 2 <= len(raw) <= 65:
                    groups.setdefault(1 << (len(raw) - 2).bit_length(), []).append((p, raw))
        for size, group in groups.items():
            for lo in range(0, len(group), 1 << 14):
                part = group[lo:lo + (1 << 14)]
                ids = self.merge_many([raw for _, raw in part], size)
                kept = ids >= 0
                tokens, ends = ids[kept].tolist(), np.cumsum(kept.sum(axis=1)).tolist()
                start = 0
                for (p, raw), end in zip(part, ends):
                    self._keep(p, raw, tokens[start:end])
                    start = end

    def _keep(self, piece: str, raw: bytes, ids: list[int]) -> None:
        back = b"".join([self.bytes_of[i] for i in ids])
        if back != raw:
            self.odd[piece] = back
        self.new[piece] = ",".join(map(str, ids))

    def piece(self, text: str) -> str:
        """The ids of one piece, joined by commas; remembers a piece that they do not decode to."""
        raw, byte_id = text.encode("utf-8"), self.byte_id
        self._keep(text, raw, self.merge([byte_id[b] for b in raw]))
        return self.new[text]

    def joined(self, pieces: list[str]) -> str:
        """The ids of consecutive pieces, joined by commas; a distinct piece is encoded once."""
        known, long = self.new, []
        for p in set(pieces).difference(known):
            ids = self.old.get(p)
            known[p] = self.piece(p) if ids is None else ids
            if len(p) > CACHED_LENGTH:
                long.append(p)
        out = ",".join([known[p] for p in pieces])
        for p in long:
            del known[p]
        return out

    def batch(self, texts: list[str | None]) -> Iterator[tuple[str, bytes]]:
        """:meth:`encoded` of each text; pieces new to the cache are encoded together first."""
        at = 0
        while at < len(texts):
            size, first, cut = 0, at, []
            while at < len(texts) and size < BATCH_CHARS:
                cut.append(self.pieces(texts[at] or ""))
                size += len(texts[at] or "")
                at += 1
            self.learn(set().union(*cut))
            for text, pieces in zip(texts[first:at], cut):
                yield self.encoded(text, pieces)

    def encoded(self, text: str | None, cut: list[str] | None = None) -> tuple[str, bytes]:
        """The ids of a text, joined by commas, and the bytes that they decode to; ``cut``
        are the pieces of the whole text, of use if it holds no added token."""
        text = text or ""
        spans = [(text, None)]
        if self.split is not None and self.split.search(text):
            cut, spans, at = None, [], 0
            for m in self.split.finditer(text):
                spans += [(text[at:m.start()], m.group())]
                at = m.end()
            spans.append((text[at:], None))
        ids, back = [], []
        for part, token in spans:
            pieces = self.pieces(part) if cut is None else cut
            if pieces:
                ids.append(self.joined(pieces))
                # each distinct piece was decoded when it was encoded; most decode to themselves
                odd = self.odd and not self.odd.keys().isdisjoint(pieces)
                back.append(b"".join([self.odd.get(p) or p.encode("utf-8") for p in pieces]) if odd else part.encode("utf-8"))
            if token is not None:
                ids.append(str(self.added[token]))
                back.append(self.bytes_of[self.added[token]])
        return ",".join(ids), b"".join(back)

    def encode(self, text: str | None) -> list[int]:
        ids = self.encoded(text)[0]
        return [int(i) for i in ids.split(",")] if ids else []

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.bytes_of[i] for i in ids).decode("utf-8", "replace")


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array of int): the token ids of each text."""
    def run(batches):
        bpe = BytePairs(path)
        for b in batches:
            ids = [[int(i) for i in listed.split(",")] if listed else [] for listed, _ in bpe.batch(b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))],
                                             names=["doc_id", "ids"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text: the text that each array of ids stands for; null ids give a null text."""
    def run(batches):
        bpe = BytePairs(path)
        for b in batches:
            text = [None if t.as_py() is None else bpe.decode(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(
        run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string")


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of the encoding and its decoding."""
    def run(batches):
        bpe = BytePairs(path)
        for b in batches:
            n, ids, back = [], [], []
            for listed, decoded in bpe.batch(b.column(1).to_pylist()):
                n.append(listed.count(",") + 1 if listed else 0)
                ids.append(hashlib.sha256(listed.encode()).hexdigest())
                back.append(hashlib.sha256(decoded.decode("utf-8", "replace").encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, "
             "decoded_sha256 string")
