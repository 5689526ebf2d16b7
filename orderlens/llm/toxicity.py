"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

Voters look at the text only and vote toxic or abstain:

* lexicon voters: word lists by kind of abuse, and induced entries (words and word
  beginnings) that are over-represented in toxic training rows;
* pattern voters: insults addressed to a person, masked words, shouting.

Over all labelled training rows the annotator's label is one more voter.  The label
model fits every voter's rates of voting in either class by EM; a voter's evidence is
divided by its redundancy, the sum of its squared conditional correlations with the
others it votes together with, so that nested entries do not count twice.  The
annotator does not read entries, so its evidence is never divided.  A logistic
classifier over the text voters is trained on the posterior labels of the same rows.
Training rows are those whose crc32(doc_id as text) mod 4 is not 2.

No step samples: every entry above ``MIN_SUPPORT`` and ``MIN_G2`` is a voter, and each
round of EM or of the classifier's fit is one pass over the rows' votes, staged once.
Texts meet their labels where they are scanned while the training ids fit a broadcast
of ``BROADCAST_IDS``; with more ids the texts are shuffled to them once and staged.
What reaches the driver is a few numbers per voter, from at most one task per core.
The passes add whole numbers (units of 2**-30), so the order of rows has no influence.

Defined cases: a null text counts as empty and gets the score of no votes; a doc_id
that is null or has no label is scored, never trained on; a doc_id labelled twice
takes the larger label; without both classes in the training rows the lexicon and pattern
voters weigh alike; repeated rows each get a row; an empty table gives an empty
result.  A very long text is judged whole, its distinct words once each; ties do not
arise, since every entry over the bounds votes.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import buckets, stage
from orderlens.operators.skew import plain_stage

MIN_SUPPORT, MIN_G2 = 4, 12.0
THRESHOLD = 0.3
#: Prior rates of the annotator's votes in toxic and clean rows, weighing as much as the rows.
ANNOTATOR = (0.98, 0.02)
STEMS = (3, 4, 5, 6, 7, 8)
#: Entries or pairs of voters a task combines before it passes them on; the passes' unit.
HELD, UNIT = 400_000, 2.0 ** 30
#: Training ids up to this number (some 32 MB) are broadcast to the scans of the texts.
BROADCAST_IDS = 1_000_000

# The word lists of the lexicon voters.
LEXICON = {
    "stupidity": "idiot idiots idiotic moron morons moronic imbecile stupid dumb dumbass fool fools foolish cretin",
    "worth": "worthless loser losers pathetic useless trash garbage scum filth vermin",
    "mockery": "clown clowns joke laughable ridiculous buffoon",
    "disgust": "disgusting disgusted repulsive vile revolting nasty",
    "hostility": "hate hated hateful despise loathe kill die destroy",
    "profanity": "damn crap shit bullshit fuck fucking bastard asshole bitch",
    "german": "dumm idiot arschloch abschaum dreck ekelhaft erbärmlich trottel versager wertlos",
    "french": "idiot idiote imbécile stupide ordure déchet dégoûtant pathétique minable nul",
    "spanish": "idiota imbécil estúpido basura escoria asqueroso patético inútil payaso perdedor",
}

# The pattern voters, applied to the lower-cased text.
PATTERNS = {
    "addressed": r"\b(?:you|they|he|she) (?:are|is|re) (?:such |so |just |nothing but )?(?:an? )?(?:\w+ )?"
                 r"(?:idiot|moron|loser|clown|scum|trash|pathetic|worthless|stupid|disgusting)",
    "dismissal": r"\b(?:shut up|get lost|go away|drop dead|screw you)\b",
    "masked": r"\b[a-z][*@#$]{2,}[a-z]*\b",
    "shouting": r"!{3,}",
}

WORD = re.compile(r"[^\W_]+")


def text_words(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def entries(text: str | None) -> set[str]:
    """Candidate lexicon entries of a text: whole words, beginnings marked with a star, and
    beginnings of two different words or more marked with two."""
    out = set()
    for w in text_words(text):
        if len(w) <= 24:
            out.add(w)
        for n in STEMS:
            if len(w) > n:
                stem = w[:n] + "*"
                if stem in out:
                    out.add(stem + "*")
                else:
                    out.add(stem)
    return out


class Voters:
    """All text voters in a fixed order; ``votes`` gives the indexes that vote toxic."""

    def __init__(self, induced: list[str]):
        self.names = list(LEXICON) + list(PATTERNS) + induced
        self.whole: dict[str, tuple] = {}
        self.stem: dict[str, int] = {}
        self.twice: dict[str, int] = {}
        for k, ws in enumerate(LEXICON.values()):
            for w in ws.split():
                self.whole[w] = self.whole.get(w, ()) + (k,)
        self.patterns = [(len(LEXICON) + k, re.compile(p)) for k, p in enumerate(PATTERNS.values())]
        for k, e in enumerate(induced, len(LEXICON) + len(PATTERNS)):
            if e.endswith("**"):
                self.twice[e[:-2]] = k
            elif e.endswith("*"):
                self.stem[e[:-1]] = k
            else:
                self.whole[e] = self.whole.get(e, ()) + (k,)
        self.lengths = sorted({len(s) for s in self.stem} | {len(s) for s in self.twice})

    def votes(self, text: str | None) -> list[int]:
        low, found, once = (text or "").lower(), set(), set()
        stem, twice, whole, lengths = self.stem, self.twice, self.whole, self.lengths
        for w in set(WORD.findall(low)):
            if w in whole:
                found.update(whole[w])
            for n in lengths:
                if len(w) <= n:
                    break
                start = w[:n]
                if start in stem:
                    found.add(stem[start])
                if start in twice:
                    if start in once:
                        found.add(twice[start])
                    once.add(start)
        found.update(k for k, p in self.patterns if p.search(low))
        return sorted(found)


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of all labelled training rows."""
    def trains(df):
        return df.filter("doc_id is not null").filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)

    usable = trains(labels).filter("toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    texts = trains(docs).select("doc_id", F.col("text").cast("string").alias("text"))
    if usable.count() <= BROADCAST_IDS:
        return texts.join(F.broadcast(usable), "doc_id").select("text", "toxic")
    return stage(texts.join(plain_stage(usable), "doc_id").select("text", "toxic"), "toxicity-rows")


def induce(rows: DataFrame, n_toxic: int, n_clean: int) -> list[str]:
    """All entries that tell toxic training rows apart (G statistic)."""
    def count(batches):
        seen: tuple[Counter, Counter] = Counter(), Counter()

        def passed_on():
            keys = list(seen[0].keys() | seen[1].keys())
            for at in range(0, len(keys), 50_000):
                part = keys[at:at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.string()), pa.array([seen[1][k] for k in part], pa.int64()),
                     pa.array([seen[0][k] for k in part], pa.int64())], names=["entry", "t", "c"])
            seen[0].clear(), seen[1].clear()

        for b in batches:
            for t, y in zip(b.column(0), b.column(1).to_pylist()):
                seen[1 if y > 0 else 0].update(entries(t.as_py()))
                if len(seen[0]) + len(seen[1]) > HELD:
                    yield from passed_on()
        yield from passed_on()

    t, c, nt, nc = F.col("t"), F.col("c"), float(n_toxic), float(n_clean)
    expect_t, expect_c = (t + c) * (nt / (nt + nc)), (t + c) * (nc / (nt + nc))
    g2 = 2 * (t * F.log(t / expect_t) + F.when(c > 0, c * F.log(c / expect_c)).otherwise(0.0))
    found = (rows.mapInArrow(count, "entry string, t long, c long")
             .groupBy("entry").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
             .filter((t >= MIN_SUPPORT) & ((t + 0.5) / (nt + 1) > 4 * (c + 0.5) / (nc + 1)))
             .filter(F.round(g2, 6) >= MIN_G2).select("entry").collect())
    return sorted(r["entry"] for r in found)


def sigmoid(odds):
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def unpacked(batch):
    """(voters, row of each, times each row occurs) of a batch of packed votes."""
    packed = batch.column(0).to_pylist()
    flat = np.frombuffer(b"".join(packed), np.int32)
    return flat, np.repeat(np.arange(len(packed)), [len(v) // 4 for v in packed]), batch.column(1).to_numpy()


def redundancy(n, i, together, votes, yes, rate1, rate0, q, q2):
    """Sum of squared conditional correlations of voter ``i`` with the voters ``j`` of
    ``together`` = (j, rows in which both vote); correlations below 0 count as 0."""
    j, both = together
    a, b, c = q2, q - q2, n - 2 * q + q2
    no = votes - yes

    def product(both, i, j):
        return (both - yes[i] * rate1[j] - no[i] * rate0[j] - yes[j] * rate1[i] - no[j] * rate0[i] + a * rate1[i] * rate1[j]
                + b * (rate1[i] * rate0[j] + rate0[i] * rate1[j]) + c * rate0[i] * rate0[j])

    def scale(k):
        return np.sqrt(np.maximum(product(votes[k], k, k), 0) / n) + 1e-6

    return 1.0 + float((np.clip(product(both, i, j) / n / (scale(i) * scale(j)), 0, 1) ** 2).sum())


def label_rounds(n: int, votes: np.ndarray, posteriors, redundancies, rounds: int = 12):
    """(evidence of each voter, constant) of the fitted label model; voter 0 is the annotator.

    ``votes`` counts each voter's rows among ``n``.  ``posteriors(evidence, constant)``
    gives the sums of q, of q*q and of q by voter, q the posterior under that model;
    ``redundancies(...)`` gives ``redundancy`` of every voter."""
    start = float(np.log(9))
    evidence, constant = np.zeros(len(votes)), -start
    evidence[0] = 2 * start
    for _ in range(rounds):
        q, q2, yes = posteriors(evidence, constant)
        prior = np.clip(q / n, 1e-3, 1 - 1e-3)
        rate1, rate0 = (yes + 0.5) / (q + 1), (votes - yes + 0.5) / (n - q + 1)
        rate1[0], rate0[0] = (rate1[0] + ANNOTATOR[0]) / 2, (rate0[0] + ANNOTATOR[1]) / 2
        weight = 1.0 / redundancies(n, votes, yes, rate1, rate0, q, q2)
        weight[0] = 1.0
        against = weight * np.log((1 - rate1) / (1 - rate0))
        evidence = weight * np.log(rate1 / rate0) - against
        constant = float(np.log(prior / (1 - prior)) + against.sum())
    return evidence, constant


def label_model(votes: np.ndarray, annotated: np.ndarray, rounds: int = 12) -> np.ndarray:
    """Posterior probability of the toxic class for each row of a table of votes in memory."""
    v = np.column_stack([annotated, votes]).astype(float)
    both = v.T @ v
    others = [np.array([j for j in np.flatnonzero(row) if j != i], int) for i, row in enumerate(both)]

    def posteriors(evidence, constant):
        q = sigmoid(constant + v @ evidence)
        return q.sum(), (q * q).sum(), q @ v

    def redundancies(n, *known):
        return np.array([redundancy(n, i, (j, both[i, j]), *known) for i, j in enumerate(others)])

    evidence, constant = label_rounds(len(v), v.sum(axis=0), posteriors, redundancies, rounds)
    return sigmoid(constant + v @ evidence)


def fit_linear(slope, votes: np.ndarray, n: int, prior: float, ridge: float = 0.5, rounds: int = 200):
    """(weights, intercept) of a logistic classifier for soft targets, by L-BFGS steps.

    ``slope(weights, intercept)`` gives the loss over all rows, its derivative by each
    voter and by the intercept; ``votes`` and ``n`` only scale the steps."""
    penalty = np.full(len(votes) + 1, ridge)
    penalty[-1] = 1e-3
    size = np.append(votes, n) * prior * (1 - prior) + penalty

    def at(w):
        loss, by_voter, by_one = slope(w[:-1], float(w[-1]))
        return loss + 0.5 * float(penalty @ (w * w)), np.append(by_voter, by_one) + penalty * w

    w = np.zeros(len(size))
    w[-1] = np.log(prior / (1 - prior))
    loss, grad = at(w)
    past: deque = deque(maxlen=12)
    for _ in range(rounds):
        step, used = -grad, []
        for s, y in reversed(past):
            used.append((s @ step) / (s @ y))
            step = step - used[-1] * y
        s, y = past[-1] if past else (grad, size * grad)
        step = step / size * ((s @ y) / (y @ (y / size)))
        for (s, y), part in zip(past, reversed(used)):
            step = step + s * (part - (y @ step) / (s @ y))
        falls, length = float(grad @ step), 1.0
        if -falls < 1e-7 * max(1.0, loss):
            break
        new_loss, new_grad = at(w + step)
        while new_loss > loss + 1e-4 * length * falls and length > 1e-3:
            length /= 4
            new_loss, new_grad = at(w + length * step)
        if new_loss >= loss:
            break
        s, y = length * step, new_grad - grad
        if s @ y > 0:
            past.append((s, y))
        w, loss, grad = w + s, new_loss, new_grad
    return w[:-1], float(w[-1])


class ToxicityModel:
    def __init__(self, induced: list[str], weights: np.ndarray, bias: float):
        self.induced, self.weights, self.bias = induced, [float(x) for x in weights], bias

    def scorer(self):
        induced, weights, bias = self.induced, self.weights, self.bias

        @F.pandas_udf("double")
        def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            voters = Voters(induced)
            for text in texts:
                odds = [bias + sum([weights[k] for k in voters.votes(t)]) for t in text]
                yield pd.Series(sigmoid(np.array(odds, dtype=float)))

        return score


def vote_rows(rows: DataFrame, induced: list[str]) -> DataFrame:
    """v (voters as packed numbers, the annotator is 0), n (rows with these votes)."""
    def vote(batches):
        voters = Voters(induced)
        for b in batches:
            packed = [np.array([0] * (y > 0) + [k + 1 for k in voters.votes(t.as_py())], np.int32).tobytes()
                      for t, y in zip(b.column(0), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary())], names=["v"])

    return rows.mapInArrow(vote, "v binary").groupBy("v").agg(F.count(F.lit(1)).alias("n"))


def vote_pairs(voted: DataFrame) -> DataFrame:
    """i, others, both: for each voter the voters it votes together with, and in how many rows."""
    schema = "i int, others binary, both binary"

    def packed(i, j, n):
        starts = np.flatnonzero(np.append(True, i[1:] != i[:-1])) if len(i) else []
        ends = np.append(starts[1:], len(i)) if len(i) else []
        return pa.RecordBatch.from_arrays(
            [pa.array([int(i[a]) for a in starts], pa.int32()),
             pa.array([j[a:b].astype(np.int32).tobytes() for a, b in zip(starts, ends)], pa.binary()),
             pa.array([n[a:b].astype(np.int64).tobytes() for a, b in zip(starts, ends)], pa.binary())],
            names=["i", "others", "both"])

    def summed(codes, counts):
        codes, where = np.unique(np.concatenate(codes), return_inverse=True)
        total = np.zeros(len(codes), np.int64)
        np.add.at(total, where, np.concatenate(counts))
        return codes, total

    def count(batches):
        codes, counts, held = [], [], 0
        for b in batches:
            for v, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                k = np.frombuffer(v, np.int32).astype(np.int64)
                if len(k) < 2:
                    continue
                pair = ((k[:, None] << 32) | k[None, :])[~np.eye(len(k), dtype=bool)]
                codes.append(pair), counts.append(np.full(len(pair), n, np.int64))
                held += len(pair)
                if held > 10 * HELD:
                    c, t = summed(codes, counts)
                    codes, counts, held = [c], [t], len(c)
                    if held > 5 * HELD:
                        yield packed(c >> 32, c & 0xFFFFFFFF, t)
                        codes, counts, held = [], [], 0
        if codes:
            c, t = summed(codes, counts)
            yield packed(c >> 32, c & 0xFFFFFFFF, t)

    def merge(batches):
        now, codes, counts = None, [], []
        for b in batches:
            for i, j, n in zip(*[c.to_pylist() for c in b.columns]):
                if i != now and codes:
                    c, t = summed(codes, counts)
                    yield packed(np.full(len(c), now), c, t)
                    codes, counts = [], []
                now = i
                codes.append(np.frombuffer(j, np.int32)), counts.append(np.frombuffer(n, np.int64))
        if codes:
            c, t = summed(codes, counts)
            yield packed(np.full(len(c), now), c, t)

    return (voted.mapInArrow(count, schema).repartition(buckets(voted.sparkSession), "i")
            .sortWithinPartitions("i").mapInArrow(merge, schema))


def passes(voted: DataFrame, size: int):
    """A function that runs one pass over the votes: ``work(voters, rows, times)`` of a batch
    gives whole numbers for each row, by name; returns their sums and, by voter, those of the first."""
    def run(work):
        def task(batches):
            total, by_voter = None, np.zeros(size, np.int64)
            for b in batches:
                flat, row, times = unpacked(b)
                got = work(flat, row, times)
                np.add.at(by_voter, flat, got[0][row])
                sums = np.array([int(g.sum()) for g in got], np.int64)
                total = sums if total is None else total + sums
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()]), pa.array([by_voter.tobytes()])],
                                                 names=["total", "by_voter"])

        parts = voted.mapInArrow(task, "total binary, by_voter binary").collect()
        return [sum(np.frombuffer(p[k], np.int64) for p in parts) for k in ("total", "by_voter")]

    return run


def train(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    rows = training_rows(docs, labels)
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy((F.col("toxic") > 0).cast("int").alias("toxic"))
             .count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        n = len(LEXICON) + len(PATTERNS)
        return ToxicityModel([], np.full(n, 3.0), -3.0)
    induced = induce(rows, sizes[1], sizes[0])
    size = len(Voters(induced).names) + 1
    cores = docs.sparkSession.sparkContext.defaultParallelism
    voted = stage(vote_rows(rows, induced), "toxicity-votes").coalesce(cores)
    pairs = stage(vote_pairs(voted), "toxicity-pairs").coalesce(cores)
    run = passes(voted, size)
    (n,), votes = run(lambda flat, row, times: [times])

    def odds(of, constant, flat, row, times):
        return constant + np.bincount(row, weights=of[flat], minlength=len(times))

    def posteriors(evidence, constant):
        def work(flat, row, times):
            q = sigmoid(odds(evidence, constant, flat, row, times))
            return [times * np.rint(x * UNIT).astype(np.int64) for x in (q, q * q)]

        (q, q2), yes = run(work)
        return q / UNIT, q2 / UNIT, yes / UNIT

    def redundancies(n, *known):
        def task(batches):
            for b in batches:
                i, others, both = [c.to_pylist() for c in b.columns]
                got = [redundancy(n, k, (np.frombuffer(j, np.int32), np.frombuffer(m, np.int64)), *known)
                       for k, j, m in zip(i, others, both)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.float64())], names=["i", "r"])

        out = np.ones(size)
        for r in pairs.mapInArrow(task, "i int, r double").collect():
            out[r["i"]] = r["r"]
        return out

    evidence, constant = label_rounds(int(n), votes, posteriors, redundancies)

    def slope(weights, intercept):
        of = np.append(0.0, weights)

        def work(flat, row, times):
            q = sigmoid(odds(evidence, constant, flat, row, times))
            z = np.clip(odds(of, intercept, flat, row, times), -30, 30)
            return [times * np.rint(x * UNIT).astype(np.int64) for x in (sigmoid(z) - q, np.log1p(np.exp(z)) - q * z)]

        (by_one, loss), by_voter = run(work)
        return loss / UNIT, by_voter[1:] / UNIT, by_one / UNIT

    prior = float(np.clip(posteriors(evidence, constant)[0] / n, 1e-3, 1 - 1e-3))
    weights, bias = fit_linear(slope, votes[1:], int(n), prior)
    return ToxicityModel(induced, weights, bias)


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted; one row per row of ``docs``."""
    score = train(docs, labels).scorer()
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return (docs.select("doc_id", held.alias("held_out"), score(F.col("text").cast("string")).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows scored as toxic; all columns kept."""
    score = train(docs, labels).scorer()
    return docs.filter(score(F.col("text").cast("string")) < threshold)
