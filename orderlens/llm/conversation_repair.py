"""Conversation structure repair by run-length dynamic programming.

A conversation is well formed when its role initials read ``(s?(ua)+)?``.  The
cheapest edits (keep, rerole, delete, insert) that make it so are found over four
states (nothing yet, after system, after user, after assistant).  A row's effect
is a 4x4 min-plus matrix that depends on its symbol alone (role initial, fault):

1. rows are numbered in order by one range partitioning of narrow rows, so a
   conversation of any length is dealt to several tasks; the first row of a
   (role, text) is found by an aggregate, so later ones are duplicates;
2. consecutive rows form pieces of bounded size; equal symbols collapse to runs,
   and a piece's matrix is built from cached binary powers of its runs' matrices;
3. per conversation the cost-to-go vectors pass backwards over the pieces;
4. every piece unrolls its choices from its vector, again by halving runs with
   the powers, for each state it may be entered in;
5. the rows stream once in order: states are chained, texts edited.

Only step 5 passes a whole conversation through one task: it streams batch by
batch, keeping one piece's edits (and, for the report, the SHA-256 state, which
cannot be computed in parts, and the audit string of the result).

Defined cases: null role or text count as one space; rows of one conversation go
by turn (nulls first), then role, then the text's SHA-256; equal rows stand next to each other
and all but the first are duplicates; a role's initial is its first character
(none for an empty role, which cannot be kept); of equally cheap edits the
ASCII-least audit is taken; a null conv_id is a conversation of its own; texts of
any length are hashed whole and otherwise only moved; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import buckets, stage

#: Costs: rerole, delete, insert, a truncated row that stays.
COSTS = (1, 2, 5, 5)
#: Rows (distinct by turn, role and text) of a piece at most.
PIECE_ROWS = 4096
BLANKS = " \t\n\x0b\x0c\r"
INF = 1 << 60
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that an inserted or reroled row leads to.
TURN = (USER, USER, ASSISTANT, USER)
ROLE_NAMES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = {"s": 0, "u": 1, "a": 2}
LEGAL = {(0, 1), (1, 2), (2, 1)}
#: Symbols: 0 must be deleted; else 1 + 2 * (s, u, a or other) + truncated.
GONE = 0

PIECES = pa.schema([
    ("conv_id", pa.string()), ("rid", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("dig", pa.binary()),
    ("syms", pa.list_(pa.int32())), ("lens", pa.list_(pa.int64())), ("matrix", pa.list_(pa.int64())),
    ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
    ("head", pa.int32()), ("tail", pa.int32())])


def symbol(kind: int, truncated: bool) -> int:
    return 1 + 2 * kind + truncated


def times(a, b):
    return tuple(tuple(min(a[i][k] + b[k][j] for k in range(4)) for j in range(4)) for i in range(4))


def onto(a, v):
    return tuple(min(a[i][k] + v[k] for k in range(4)) for i in range(4))


class Grammar:
    """Min-plus transitions of the symbols under given costs, with cached binary powers."""

    def __init__(self, rerole, delete, insert, truncated):
        if min(rerole, delete, insert) <= 0 or truncated < 0:
            raise ValueError("edits must cost something")
        self.rerole, self.delete, self.insert, self.truncated = rerole, delete, insert, truncated
        self.final = self._closed([0, INF, INF, 0])
        self.powers = {sym: [self._matrix(sym)] for sym in range(9)}
        self.choose = lru_cache(maxsize=None)(self._choose)

    def _closed(self, v):
        """Vector ``v`` with any number of insertions before it."""
        v = list(v)
        for _ in range(3):
            for s in range(4):
                v[s] = min(v[s], self.insert + v[TURN[s]])
        return tuple(min(x, INF) for x in v)

    def options(self, sym, s):
        """(edit, next state, cost) of a row of symbol ``sym`` in state ``s``; no insertions."""
        out = [("D", s, self.delete)]
        if sym != GONE:
            kind, cut = divmod(sym - 1, 2)
            extra = self.truncated if cut else 0
            if (kind == 0 and s == START) or (kind == 1 and TURN[s] == USER) or (kind == 2 and s == USER):
                out.append(("K", (SYSTEM, USER, ASSISTANT)[kind], extra))
            out.append(("R", TURN[s], self.rerole + extra))
        return out

    def _matrix(self, sym):
        rows = []
        for s in range(4):
            row, at, paid = [INF] * 4, s, 0
            for _ in range(4):  # insertions before the row: the states repeat after three
                for _, t, cost in self.options(sym, at):
                    row[t] = min(row[t], paid + cost)
                at, paid = TURN[at], paid + self.insert
            rows.append(tuple(row))
        return tuple(rows)

    def power(self, sym, k):
        """The matrix of 2 ** k rows of one symbol."""
        have = self.powers[sym]
        while len(have) <= k:
            have.append(times(have[-1], have[-1]))
        return have[k]

    def run_matrix(self, sym, n):
        out, k = None, 0
        while n:
            if n & 1:
                p = self.power(sym, k)
                out = p if out is None else times(out, p)
            n, k = n >> 1, k + 1
        return out

    def run_vector(self, sym, n, v):
        k = 0
        while n:
            if n & 1:
                v = onto(self.power(sym, k), v)
            n, k = n >> 1, k + 1
        return v

    def _choose(self, sym, s, after):
        """Edits of one row in state ``s`` with ``after`` the costs to go behind it."""
        here, edits = onto(self.power(sym, 0), after), ""
        while True:
            found = [(c, t) for c, t, cost in self.options(sym, s) if cost + after[t] == here[s]]
            if found and found[0][0] == "D":
                return edits + "D", s
            if self.insert + here[TURN[s]] == here[s]:
                edits, s = edits + "I", TURN[s]
                continue
            c, t = min(found)
            return edits + c, t

    def unroll(self, runs, end, s):
        """(audit, state behind it) of ``runs`` entered in state ``s``, ``end`` the costs to go."""
        vectors = [end]
        for sym, n in reversed(runs):
            vectors.append(self.run_vector(sym, n, vectors[-1]))
        out = []
        for (sym, n), v in zip(runs, vectors[-2::-1]):
            s = self._unroll_run(sym, n, v, s, out)
        return "".join(out), s

    def _unroll_run(self, sym, n, v, s, out):
        if sym == GONE:  # closed vectors: deleting now never costs more than inserting first
            out.append("D" * n)
            return s
        todo = [(n, v)]
        while todo:
            n, v = todo.pop()
            if n == 1:
                low = min(v)
                edits, s = self.choose(sym, s, tuple(x - low for x in v))
                out.append(edits)
            else:
                half = n >> 1
                todo += [(half, v), (n - half, self.run_vector(sym, half, v))]
        return s

    def finish(self, s):
        """Insertions behind the last row."""
        out = ""
        while self.final[s]:
            out, s = out + "I", TURN[s]
        return out


def records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def emit(rows: Iterator[dict], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def mapped(df: DataFrame, step, schema: pa.Schema, ddl: str) -> DataFrame:
    """``df.mapInArrow`` of a function over a stream of dicts."""
    return df.mapInArrow(lambda batches: emit(step(records(batches)), schema), ddl)


def _make_pieces(rows, model, limit):
    """Pieces of consecutive rows (rows come by conversation and rid)."""
    piece = None
    for r in rows:
        # Chunks that another task's rows lie between may meet in one task.
        if piece and (piece["conv_id"] != r["conv_id"] or piece["rid"] >> 33 != r["rid"] >> 33 or piece["size"] == limit):
            yield _sealed(piece, model)
            piece = None
        kind = INITIALS.get(r["role"][:1], 3)
        if piece is None:
            piece = {"conv_id": r["conv_id"], "rid": r["rid"], "turn": r["turn"], "role": r["role"], "dig": r["dig"],
                     "runs": [], "size": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0,
                     "head": kind, "tail": kind}
        else:
            piece["illegal"] += (piece["tail"], kind) not in LEGAL
            piece["tail"] = kind
        piece["size"] += 1
        n = r["n"]
        piece["illegal"] += n - 1
        if r["blank"]:
            piece["blank"] += n
        else:
            piece["duplicate"] += n - bool(r["first"])
            piece["truncated"] += bool(r["first"] and r["cut"])
        sym = GONE if r["blank"] or not r["first"] else symbol(kind, r["cut"])
        for s, k in ((sym, 1), (GONE, n - 1)):
            if k and piece["runs"] and piece["runs"][-1][0] == s:
                piece["runs"][-1][1] += k
            elif k:
                piece["runs"].append([s, k])
    if piece:
        yield _sealed(piece, model)


def _sealed(piece, model):
    matrix = None
    for sym, n in piece["runs"]:
        p = model.run_matrix(sym, n)
        matrix = p if matrix is None else times(matrix, p)
    return piece | {"syms": [s for s, _ in piece["runs"]], "lens": [n for _, n in piece["runs"]],
                    "matrix": [min(x, INF) for row in matrix for x in row]}


def _pass_back(pieces, model):
    """Costs to go behind each piece; pieces come last first."""
    held, v = None, model.final
    for p in pieces:
        if held:
            again = held["conv_id"] == p["conv_id"]
            yield held | {"opens": not again}
            v = onto([held["matrix"][4 * i:4 * i + 4] for i in range(4)], v) if again else model.final
        held = p | {"after": list(v), "closes": held is None or held["conv_id"] != p["conv_id"]}
    if held:
        yield held | {"opens": True}


def _unrolled(pieces, model):
    for p in pieces:
        runs, after = list(zip(p["syms"], p["lens"])), tuple(p["after"])
        audits, ends = [None] * 4, [None] * 4
        for s in (START,) if p["opens"] else range(4):
            audits[s], ends[s] = model.unroll(runs, after, s)
            if p["closes"]:
                audits[s] += model.finish(ends[s])
        first = onto([p["matrix"][4 * i:4 * i + 4] for i in range(4)], after)[START]
        yield p | {"audits": audits, "ends": ends, "cost": first if p["opens"] else 0}


def _applied(rows):
    """Repaired turns, and after each conversation its report; ``rows`` are pieces and
    their rows in order.  Yields ("turn", conv_id, role, text) and ("report", dict)."""
    now, edits, at, place, state = None, "", 0, START, START

    def until(stop):  # the edits before the next row, or all that are left
        nonlocal at, place
        while at < len(edits) and (edits[at] == "I" or stop):
            at, place = at + 1, TURN[place]
            yield "turn", now["conv_id"], ROLE_NAMES[place], ""

    for r in rows:
        if r["audits"] is not None:
            if now and now["conv_id"] == r["conv_id"]:
                now["illegal"] += (now["tail"], r["head"]) not in LEGAL
            else:
                if now:
                    yield from until(True)
                    yield "report", now
                now = {"conv_id": r["conv_id"], "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0,
                       "cost": r["cost"], "audit": []}
                state = place = START
            now["tail"] = r["tail"]
            for k in ("blank", "duplicate", "truncated", "illegal"):
                now[k] += r[k]
            edits, at, state = r["audits"][state], 0, r["ends"][state]
            now["audit"].append(edits)
        else:
            yield from until(False)
            edit = edits[at]
            at += r["n"]
            if edit == "K":
                place = (SYSTEM, USER, ASSISTANT)[INITIALS[r["role"][0]]]
                yield "turn", now["conv_id"], r["role"], r["text"]
            elif edit == "R":
                place = TURN[place]
                yield "turn", now["conv_id"], ROLE_NAMES[place], r["text"]
    if now:
        yield from until(True)
        yield "report", now


def _turn_rows(rows):
    pos = 0
    for kind, *got in _applied(rows):
        if kind == "report":
            pos = 0
        else:
            yield {"conv_id": got[0], "pos": pos, "role": got[1], "text": got[2]}
            pos += 1


def _report_rows(rows):
    sha, begun = hashlib.sha256(), False
    for kind, *got in _applied(rows):
        if kind == "turn":
            sha.update((("\n" if begun else "") + got[1] + ":" + got[2]).encode())
            begun = True
        else:
            yield got[0] | {"audit": "".join(got[0]["audit"]), "repaired_sha256": sha.hexdigest()}
            sha, begun = hashlib.sha256(), False


def _edited(convs: DataFrame, costs, piece_rows: int) -> DataFrame:
    """Pieces with their unrolled edits, and the rows, in order within each conversation."""
    spark = convs.sparkSession
    n = buckets(spark)
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    # Equal rows are one record with a count before anything is shuffled whole.
    rows = stage(
        convs.select(F.col("conv_id").cast("string").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                     F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), text.alias("text"))
        .groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n"))
        .withColumn("dig", F.unhex(F.sha2("text", 256))), "repair-rows")
    last = F.substring(F.rtrim(F.col("text"), F.lit(BLANKS)), -1, 1)
    order = ["conv_id", "turn", "role", "dig"]
    numbered = stage(
        rows.select(*order, "n", (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"))
        .repartitionByRange(n, *order).sortWithinPartitions(*order)
        .withColumn("rid", F.monotonically_increasing_id()), "repair-order")
    firsts = numbered.groupBy("conv_id", "role", "dig").agg(F.min("rid").alias("rid")).select("rid")
    flagged = numbered.join(firsts.withColumn("first", F.lit(True)), "rid", "left")
    model = tuple(costs)
    ddl = ("conv_id string, rid long, turn long, role string, dig binary, syms array<int>, lens array<long>, "
           "matrix array<long>, blank long, duplicate long, truncated long, illegal long, head int, tail int")
    pieces = mapped(
        flagged.repartition(n, "conv_id", F.shiftright("rid", 33)).sortWithinPartitions("conv_id", "rid"),
        lambda rows: _make_pieces(rows, Grammar(*model), piece_rows), PIECES, ddl)
    back = PIECES.append(pa.field("after", pa.list_(pa.int64()))).append(pa.field("closes", pa.bool_())).append(
        pa.field("opens", pa.bool_()))
    passed = mapped(
        pieces.repartition(n, "conv_id").sortWithinPartitions("conv_id", F.desc("rid")),
        lambda rows: _pass_back(rows, Grammar(*model)), back,
        ddl + ", after array<long>, closes boolean, opens boolean")
    done = pa.schema([f for f in PIECES if f.name not in ("syms", "lens", "matrix", "rid")] + [
        pa.field("audits", pa.list_(pa.string())), pa.field("ends", pa.list_(pa.int32())), pa.field("cost", pa.int64())])
    unrolled = mapped(
        passed.repartition(n, "conv_id", "rid"), lambda rows: _unrolled(rows, Grammar(*model)), done,
        "conv_id string, turn long, role string, dig binary, blank long, duplicate long, truncated long, illegal long, "
        "head int, tail int, audits array<string>, ends array<int>, cost long")
    both = unrolled.unionByName(rows.select(*order, "n", "text"), allowMissingColumns=True)
    return both.repartition(n, "conv_id").sortWithinPartitions(*order, F.col("audits").isNull())


def repaired_turns(convs: DataFrame, costs=COSTS, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """conv_id (as text), pos, role, text: the turns of every conversation after the cheapest repair."""
    schema = pa.schema([("conv_id", pa.string()), ("pos", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    return mapped(_edited(convs, costs, piece_rows), _turn_rows, schema,
                  "conv_id string, pos long, role string, text string")


def repair_report(convs: DataFrame, costs=COSTS, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """conv_id, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, gaps;
    one row per conversation that has rows.  ``repaired_sha256`` is that of the repaired
    ``role:text`` joined by newlines."""
    numbers = ("blank", "duplicate", "truncated", "illegal", "cost")
    schema = pa.schema([("conv_id", pa.string()), *((k, pa.int64()) for k in numbers),
                        ("audit", pa.string()), ("repaired_sha256", pa.string())])
    report = mapped(_edited(convs, costs, piece_rows), _report_rows, schema,
                    "conv_id string, " + ", ".join(f"{k} long" for k in numbers) + ", audit string, repaired_sha256 string")
    kind = convs.schema["conv_id"].dataType
    gaps = convs.groupBy("conv_id").agg(
        (F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0))).cast("long").alias("gaps"))
    report = report.withColumn("conv_id", F.col("conv_id").cast(kind))
    return (gaps.withColumnRenamed("conv_id", "__id").join(report, F.col("__id").eqNullSafe(F.col("conv_id")))
            .drop("__id"))


def damage(convs: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with the faults of the query planted: by crc32(``conv_id:turn``)
    modulo 20, 0 drops a row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes it the user's."""
    space = F.lit(" ")
    word = lambda c: F.coalesce(F.col(c).cast("string"), space)
    rows = convs.select("conv_id", "turn", word("role").alias("role"), word("text").alias("text"),
                        (F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn"))) % 20).alias("kind"))
    kind = F.col("kind")
    text: Column = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.filter(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def damage_and_repair(convs: DataFrame) -> DataFrame:
    """The query: every original conv_id with the report over its damaged rows; zeros, an
    empty audit and the empty text's digest where no row is left."""
    report = repair_report(damage(convs))
    ids = convs.select(F.col("conv_id").alias("__id")).distinct()
    out = ids.join(report, F.col("__id").eqNullSafe(F.col("conv_id")), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select(F.col("__id").alias("conv_id"), *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
