"""Vectorised scanning of text batches: words, word and window hashes, anchors.

A batch is one byte buffer with document offsets, as Arrow stores strings.  Windows
have polynomial hashes over 64 bits of random byte (or word) values with a final mix:
equal strings have equal hashes wherever they stand.  Words are hashed block by block.
A hash brings equal strings together; callers that conclude equality compare bytes
(``equal_runs``) or say that they go by the hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

BASE = np.uint64(0x9E3779B97F4A7C15)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**0..n and the inverses, modulo 2**64."""
    if len(_powers[0]) <= n:
        size = max(n + 1, 2 * len(_powers[0]))
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        for k, base in enumerate((BASE, inverse)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p)
    return _powers[0], _powers[1]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    out = np.empty(len(values) + 1, np.uint64)
    out[0] = 0
    np.cumsum(values * powers(len(values))[0][:len(values)], out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the values in [start, end): the same for equal runs anywhere."""
    return mix((sums[end] - sums[start]) * powers(len(sums))[1][start] + (end - start).astype(np.uint64))


def window_hash(values: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` values; empty when there are fewer."""
    if len(values) < n:
        return np.empty(0, np.uint64)
    sums = prefix_sums(values)
    return mix((sums[n:] - sums[:-n]) * powers(len(values))[1][:len(values) - n + 1])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type)
                                  else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    at = at.astype(np.int64) if len(at) else np.zeros(1, np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return buf[at[0]:at[-1]], at - at[0]


def sliced(batches, column: int, limit: int = 1 << 22, rows: int = 10_000):
    """Arrow batches cut to about ``limit`` bytes of text and at most ``rows`` rows each, one row at least."""
    for b in batches:
        _, offsets = utf8(b.column(column))
        first = 0
        while first < b.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
            last = min(max(last, first + 1), first + rows, b.num_rows)
            yield b.slice(first, last - first)
            first = last


def pieces(offsets: np.ndarray, limit: int = 1 << 19):
    """Ranges (first, last) of documents with about ``limit`` bytes each, one document at least."""
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = max(last, first + 1)
        yield first, last
        first = last


WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True


def words(buf: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of every maximal run of word bytes; runs end with their document."""
    n = len(buf)
    if not n:
        return (np.empty(0, np.int64),) * 3
    inside = is_word[buf]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


LONG_WORD = 2048


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each run of bytes: eight bytes at a time are mixed into the state, so no
    structure of long words carries through (a polynomial's zeros do); very long ones by XXH64."""
    size = end - start
    state = mix(size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD1342543DE82EF95))
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    blocks = np.ndarray(len(buf) + 1, np.dtype("<u8"), padded, strides=(1,))      # the eight bytes from each place on
    here = np.flatnonzero(size <= LONG_WORD)
    at, left = start[here], size[here]
    while len(here):
        part = np.minimum(left, 8).astype(np.uint64)
        word = blocks[at] & (~np.uint64(0) >> (np.uint64(64) - np.uint64(8) * np.maximum(part, 1)))
        state[here] = mix((state[here] ^ word) * np.uint64(0xAEF17502108EF2D9) + np.uint64(0x2545F4914F6CDD1D))
        more = left > 8
        here, at, left = here[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        state[i] = xxhash.xxh64_intdigest(buf[start[i]:end[i]].tobytes(), 7)
    return state


def equal_runs(data: np.ndarray, start: np.ndarray, other: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether ``size`` bytes from ``start`` equal those from ``other``, pair by pair."""
    out = np.ones(len(size), bool)
    for first, last in pieces(np.concatenate([[0], np.cumsum(size)])):
        n = size[first:last]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        differs = data[np.repeat(start[first:last], n) + inside] != data[np.repeat(other[first:last], n) + inside]
        out[first + np.repeat(np.arange(last - first), n)[differs]] = False
    return out


def anchors(grams: np.ndarray, document: np.ndarray, gram: int, window: int):
    """Minimizers: for every window of ``window`` items inside one document, the
    leftmost least of its grams of ``gram`` items.

    ``grams[i]`` is the hash of items i..i+gram-1, ``document`` the document of each
    item.  Returns (anchor, first, last): windows that start at first..last choose
    the gram at ``anchor``.  Equal windows choose the gram at the same place in them,
    so two occurrences of a window always share an anchor's hash.
    """
    n, span = len(document), window - gram + 1
    if n < window:
        return (np.empty(0, np.int64),) * 3
    order = (mix(grams ^ np.uint64(0xA5A5A5A5A5A5A5A5)) & ~np.uint64(0xFFFFFFFF)) | np.arange(
        len(grams), dtype=np.uint64)
    least, have = order, 1
    while have < span:
        step = min(have, span - have)
        least = np.minimum(least[:len(least) - step], least[step:])
        have += step
    least = least[:n - window + 1]
    valid = document[:n - window + 1] == document[window - 1:]
    at = np.flatnonzero(valid)
    chosen = (least[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    if not len(at):
        return (np.empty(0, np.int64),) * 3
    cut = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (at[1:] != at[:-1] + 1)]))
    return chosen[cut], at[cut], at[np.append(cut[1:], len(at)) - 1]
