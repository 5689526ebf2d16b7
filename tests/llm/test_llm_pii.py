"""Personal data: base spans against the contract's expressions in Python, bootstrapping on planted contexts."""

import hashlib
import random
import re

import cases
from orderlens.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    good = {"email": lambda s: True, "ip": lambda s: all(int(p) <= 255 for p in s.split(".")),
            "card": lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s)), "phone": lambda s: 8 <= len(digits(s)) <= 15}
    return [(k, m.start(), m.end()) for k, x in zip(good, (EMAIL, IP, CARD, PHONE))
            for m in x.finditer(text or "") if good[k](m.group())]


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def noise(r):
    alphabet = ["1", "2", "255", "256", "0", "00", ".", ".", "-", " ", "  ", "@", "a", "b.c", "+", "(", ")", "é", "😀", "%", "_",
                "4111 1111 1111 1111", "4111111111111111", "+1 (778) 555-8933", "x.y@z.com", "10.0.0.1", "\n", "\t"]
    return "".join(r.choice(alphabet) for _ in range(r.randint(0, 60)))


def test_base_spans_equal_the_expressions(spark):
    r = random.Random(4)
    rows = [(i, noise(r)) for i in range(1500)]
    rows += [(2000, None), (2001, ""), (2002, "a@b.c%d@e.f"), (2003, "a@b.c.@x.y"), (2004, "1.2.3.4.5.6.7.8.9"),
             (2005, "0000255.1.01.0 000256.1.1.1"), (2006, "1 " * 9000), (2007, "1" * 30000 + "@"), (2008, "a" * 60000),
             (2009, "é a.b@c.d " * 700), (2010, "a@" + "b." * 9000 + "c"), (2011, "+1" + "(" * 20000), (2012, "1.1.1.1 " * 900)]
    rows += [rows[5], rows[5], (None, "q@r.st"), (None, None)]
    got = pii.pii_report(cases.frame(spark, rows)).collect()
    want = {}
    for d, t in rows:
        want[d] = want.get(d, []) + [base(t)]
    assert len(got) == len(rows)
    for row in got:
        spans = next(s for s in want[row.doc_id] if hashlib.sha256(listed(s).encode()).hexdigest() == row.base_sha256)
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s[0] == k for s in spans) for k in pii.KINDS]
        assert set(listed(spans).split(",")) <= set(row.spans.split(",")) | {""}
    assert {r.doc_id for r in got} == {d for d, _ in rows}


def test_patterns_find_unseen_identifiers(spark):
    rows = [(i, f"Please write to mailbox user{i}@mail.example.com before noon") for i in range(12)]
    rows += [(100, "Please write to mailbox jane42.example before noon"), (101, "see jane42.example again"),
             (102, "the model number x99-model7 is listed"), (103, "call zz11yy22 or write"), (104, "nothing here")]
    rows += [(200 + i, f"the model number y{i}8-model is listed") for i in range(9)]
    got = {r.doc_id: r for r in pii.pii_report(cases.frame(spark, rows)).collect()}
    start = rows[12][1].index("jane42")
    assert got[100].spans == f"email:{start}:{start + 14}" and got[100].n_email == 0 and got[100].n_found == 1
    assert got[101].spans == "email:4:18"
    assert all(got[d].spans == "" for d in (102, 103, 104, *range(200, 209)))
    assert got[3].spans == listed(base(rows[3][1]))


def test_second_round_reaches_further(spark):
    seeds = [(i, f"ring the number +1 (212) 555-80{i:02d} today") for i in range(20)]
    links = [(100 + i, f"ring the number ext-77{i}x today") for i in range(6)] + [(200 + i, f"her line reads ext-77{i}x please") for i in range(6)]
    far = [(300, "her line reads loc-5566 please")]
    docs = cases.frame(spark, seeds + links + far)
    one = {r.doc_id: r.n_found for r in pii.pii_spans(docs, rounds=1).selectExpr("doc_id", "size(found) as n_found").collect()}
    three = {r.doc_id: r.n_found for r in pii.pii_spans(docs).selectExpr("doc_id", "size(found) as n_found").collect()}
    assert one[300] == 0 and three[300] == 1 and three[100] == 1 and three[205] == 1


def expected_found(rows):
    """The whole method over plain dictionaries."""
    from collections import Counter, defaultdict
    token = re.compile(r"(?<![A-Za-z0-9._%+@-])[A-Za-z._%+-]*[0-9@](?:[A-Za-z0-9._%+@-]*[A-Za-z0-9])?")
    words = lambda s: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[0-9]", "0", s.lower()))
    occ = []
    for n, (_, t) in enumerate(rows):
        t = t or ""
        taken = base(t)
        for k, x in [*zip(pii.KINDS, (EMAIL, IP, CARD, PHONE)), (None, token)]:
            found = list(x.finditer(t))
            for i, m in enumerate(found):
                a, b = m.span()
                if k and (k, a, b) not in taken or not k and (b - a < 5 or any(s < b and a < e for _, s, e in taken)):
                    continue
                left = words(t[found[i - 1].end() if i else 0:a][-48:])
                right = words(t[b:found[i + 1].start() if i + 1 < len(found) else len(t)][:24])
                ps = ([f"before {left[-2]} {left[-1]}"] if len(left) > 1 else []) + ([f"beside {left[-1]} _ {right[0]}"] if left and right else [])
                occ.append((n, k, a, b, m.group(), ps))
    edges = {(p, x) for *_, x, ps in occ for p in ps}
    kinds = defaultdict(Counter)
    for _, k, _, _, x, _ in occ:
        if k:
            kinds[x][k] += 1
    seeds = {x: (min(c, key=lambda k: (-c[k], pii.KINDS.index(k))), 1.0) for x, c in kinds.items()}
    known, size = dict(seeds), Counter(p for p, _ in edges)
    for _ in range(3):
        sums = defaultdict(list)
        for p, x in edges:
            if x in known:
                sums[p, known[x][0]].append(known[x][1])
        accepted = {p: (k, sum(v) / (size[p] + 1)) for (p, k), v in sums.items() if len(v) >= 3 and sum(v) / (size[p] + 1) >= 0.7}
        reach = defaultdict(lambda: 1.0)
        for p, x in edges:
            if p in accepted and x not in seeds:
                reach[x, accepted[p][0]] *= 1 - accepted[p][1]
        known = dict(seeds)
        for x in {x for x, _ in reach}:
            conf, k = max(((1 - v, -pii.KINDS.index(k)) for (y, k), v in reach.items() if y == x))
            if conf >= 0.8:
                known[x] = (pii.KINDS[-k], conf)
    found = defaultdict(set)
    for n, k, a, b, x, _ in occ:
        if k is None and x in known:
            found[n].add((known[x][0], a, b))
    return found


def test_found_spans_equal_a_plain_version(spark):
    r = random.Random(8)
    ids = [f"id{i}-{i * 37 % 101}x" for i in range(12)] + [f"user{i}@mail.org" for i in range(15)] + [f"10.0.{i}.7" for i in range(9)]
    frames = [("mail to", "now"), ("host at", "down"), ("see item", "there"), ("his key", "is")]
    rows = []
    for i in range(160):
        parts = []
        for _ in range(r.randint(1, 3)):
            x = r.choice(ids)
            a, b = frames[0] if "@" in x and r.random() < .9 else frames[1] if x.startswith("10.") and r.random() < .9 else r.choice(frames if "id" not in x else frames[2:])
            parts.append(f"{r.choice('abc')} {a} {x} {b}")
        rows.append((i, " ".join(parts)))
    rows += [(500 + i, f"q mail to id{i}-{i * 37 % 101}x now") for i in range(2)]
    found = expected_found(rows)
    order = lambda s: (pii.KINDS.index(s[0]), s[1])
    got = {row.doc_id: row.spans for row in pii.pii_report(cases.frame(spark, rows)).collect()}
    assert sum(map(len, found.values())) > 0
    for n, (d, t) in enumerate(rows):
        assert got[d] == listed(sorted([*base(t), *found[n]], key=order))


def test_nothing_to_find(spark):
    assert pii.pii_report(cases.empty(spark)).collect() == []
    got = pii.pii_report(spark.createDataFrame([(1, None), (2, "plain words")], "doc_id long, text string")).collect()
    assert [(r.spans, r.base_sha256) for r in got] == [("", hashlib.sha256(b"").hexdigest())] * 2
