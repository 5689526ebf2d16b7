"""Randomized batches: each Column builder against a plain-Python model of the
reference's semantics (Oracle: '' is NULL, NULL || x = x; POSIX bracket class;
ordered CASE).  One Spark job per builder over a few hundred rows."""

import datetime as dt
import random
import re

from orderlens import functions as X

N = 400


def strings(rnd, alphabet="AB-\\12x ", n=N, maxlen=7):
    out = []
    for _ in range(n):
        r = rnd.random()
        out.append(None if r < 0.1 else "" if r < 0.15 else
                   "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, maxlen))))
    return out


def ora(x):          # Oracle: '' is NULL
    return None if x == "" else x


def cat(*parts):     # Oracle ||: NULL contributes nothing
    return "".join(p for p in parts if p is not None)


def run(spark, rows, schema, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr.alias("y")).collect()]


def test_serial_suffix_model(spark):
    vals = strings(random.Random(1))
    got = run(spark, [(v,) for v in vals], "x string", X.serial_suffix("x"))
    want = [None if v is None else re.sub(r"^(.+)[AB\\\-].*", r"\1", v, flags=re.S) for v in vals]
    assert got == want


def test_serial_prefix_model(spark):
    vals = strings(random.Random(2))
    got = run(spark, [(v,) for v in vals], "x string", X.serial_prefix("x"))
    want = [None if v is None else re.sub(r"^[AB]", "0", v) for v in vals]
    assert got == want


def test_category_label_model(spark):
    rnd = random.Random(3)
    pool = [None, "", "NONE", "Partial", "Knee", "Hip"]
    rows = [(rnd.choice(pool), rnd.choice(pool)) for _ in range(N)]

    def model(a, b):
        a, b = ora(a), ora(b)
        if a == "NONE" and b == "NONE":
            return "NONE"
        if a == "Partial" and b is not None:
            return b
        if a == "NONE" and b is not None:
            return b
        if b == "NONE" and a is not None:
            return a
        if a is None and b is None:
            return "NOCAT"
        return cat(a, " ", b)
    got = run(spark, rows, "a string, b string", X.category_label("a", "b"))
    assert got == [model(a, b) for a, b in rows]


def test_address_model(spark):
    rnd = random.Random(4)
    pool = [None, "", "x", "Main St"]
    rows = [tuple(rnd.choice(pool) for _ in range(6)) for _ in range(N)]

    def model(a1, a2, city, state, prov, country):
        parts = [cat(ora(p), ", ") if ora(p) is not None else "" for p in (a1, a2, city)]
        region = ora(state) if ora(state) is not None else ora(prov)
        tail = cat(ora(country), ", ") if ora(country) is not None else ""
        return "".join(parts) + cat(region, ", ") + tail
    got = run(spark, rows, "a1 string, a2 string, city string, st string, pr string, co string",
              X.address_line(["a1", "a2", "city"], "st", "pr", "co"))
    assert got == [model(*r) for r in rows]


def test_phone_model(spark):
    rnd = random.Random(5)
    pool = [None, "", "617", "555"]
    rows = [tuple(rnd.choice(pool) for _ in range(3)) for _ in range(N)]
    got = run(spark, rows, "a string, n string, e string", X.phone_line("a", "n", "e"))
    assert got == [cat("(", ora(a), ")", ora(n), " ", ora(e)) for a, n, e in rows]


def test_retention_model(spark):
    rnd = random.Random(6)
    as_of = dt.datetime(2020, 3, 31)
    rows = [(rnd.choice([None, "CLOSED", "CANCELLED", "BOOKED"]), rnd.choice([None, -1.0, 0.0, 1.0, 5.0]),
             rnd.choice([None, dt.datetime(2020, 1, 1), dt.datetime(2020, 3, 1), dt.datetime(2020, 3, 30)]))
            for _ in range(N)]

    def model(st, q, ship):
        def gt(a, b):
            return None if a is None or b is None else a > b

        def ge(a, b):
            return None if a is None or b is None else a >= b

        def AND(*xs):
            return False if any(x is False for x in xs) else (None if any(x is None for x in xs) else True)

        def OR(*xs):
            return True if any(x is True for x in xs) else (None if any(x is None for x in xs) else False)
        recent = ge(ship, as_of - dt.timedelta(days=30))
        not_in = None if st is None else st not in ("CLOSED", "CANCELLED")
        closed = None if st is None else st == "CLOSED"
        canc = None if st is None else st == "CANCELLED"
        return OR(not_in, AND(closed, gt(1.0 if q is None else q, 0)),
                  AND(closed, None if q is None else q <= 0, recent), AND(canc, recent))
    df = spark.createDataFrame(rows, "st string, q double, ship timestamp_ntz")
    got = [r[0] for r in df.select(X.retained("st", "q", "ship", as_of).alias("y")).collect()]
    assert got == [model(*r) for r in rows]


def test_valid_at_model(spark):
    rnd = random.Random(7)
    as_of = dt.datetime(2020, 1, 1)
    days = [None] + [dt.datetime(2019, 12, 30) + dt.timedelta(days=i) for i in range(5)]
    rows = [(rnd.choice(days), rnd.choice(days)) for _ in range(N)]

    def model(s, e):
        lo = as_of if s is None else s
        hi = as_of + dt.timedelta(days=1) if e is None else e
        return lo <= as_of <= hi
    df = spark.createDataFrame(rows, "s timestamp_ntz, e timestamp_ntz")
    got = [r[0] for r in df.select(X.valid_at("s", "e", as_of).alias("y")).collect()]
    assert got == [model(*r) for r in rows]


def test_status_label_model(spark):
    rnd = random.Random(8)
    rows = [(rnd.choice([None, "CLOSED", "PENDING_DESIGN_APPROVAL", "BOOKED"]),
             rnd.choice([None, -1.0, 0.0, 2.0]),
             rnd.choice([None, "pending", "DECLINED", "approved", "other"])) for _ in range(N)]
    labels = {"PENDING": "Pending Surgeon Review", "DECLINED": "Re-Design",
              "APPROVED": "Design Approved by Surgeon"}

    def model(code, q, rev):
        if code == "CLOSED" and q is not None and q <= 0:
            return "RETURN"
        if code == "PENDING_DESIGN_APPROVAL":
            return labels.get(rev.upper() if rev is not None else None, code)
        return code
    got = run(spark, rows, "c string, q double, r string", X.status_label("c", "q", "r"))
    assert got == [model(*r) for r in rows]

