"""Small document tables with the awkward cases, and brute-force versions of the operators."""

import hashlib
import random
import re

EXTRA = ["rid", "key", "row", "id", "xx", "n", "code", "bucket", "target", "root", "item_id", "copies", "sha", "_id"]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts(seed=7, n=60):
    """Random texts with copies, near copies, shared passages, null, empty and very long ones."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 5))) for _ in range(60)]
    make = lambda k: " ".join(r.choice(vocab) for _ in range(k))
    passage, line = make(45), "x" * 80
    out = []
    for i in range(n):
        kind = i % 10
        t = make(r.randint(0, 90))
        if kind == 1:
            t = make(20) + " " + passage + " " + make(10)
        elif kind == 2:
            t = passage.upper()
        elif kind == 3 and out:
            t = out[r.randrange(len(out))][1] or ""
        elif kind == 4:
            t = line + "\n" + make(5) + "\t" + line
        elif kind == 5:
            w = make(30)
            t = w + " " + w
        out.append((i, t))
    out += [(100, None), (101, ""), (102, "  \n\t "), (103, make(4000)), (104, "a " * 300), (105, "ab" * 400)]
    return out


def frame(spark, rows, extra=True):
    """(doc_id, text) rows, some repeated, one without an id, and columns with helper names."""
    schema = "doc_id long, text string"
    rows = list(rows)
    if extra:
        schema += "".join(f", {c} string" for c in EXTRA)
        rows = [r + tuple(f"{c}!" for c in EXTRA) for r in rows]
    return spark.createDataFrame(rows, schema).repartition(5)


def repeated(rows):
    return rows + [rows[3], rows[3], (None, rows[1][1]), (None, "only here " * 9), (5, "another text with id five")]


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def rank(doc_id):
    return (1 << 63) - 1 if doc_id is None else doc_id


def byte_spans(rows, length):
    """n_bytes, n_removed, n_spans, sha per row: strings that also start under a smaller id."""
    least = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            least[w] = min(rank(d), least.get(w, rank(d)))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if least[b[i:i + length]] < rank(d):
                gone[i:i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def word_spans(rows, window):
    """n_words, n_removed, sha per row of distinct ids: windows that start earlier, too."""
    first, out = {}, []
    rows = sorted(rows, key=lambda r: rank(r[0]))
    split = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i:i + window]), (rank(d), i))
    for d, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < (rank(d), i):
                gone[i:i + window] = [True] * window
        out.append((d, len(w), sum(gone),
                    hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    return out


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
