"""Personal data by bootstrapped contextual extraction (DataFrame functions only).

Base entities (e-mail and IP addresses, card and phone numbers) are found by
patterns and checks.  They seed a graph between instances (identifier strings)
and lexical patterns (the words around an occurrence):

1. one scan of every text gives the base spans and all other identifiers (runs of
   ``[A-Za-z0-9._%+@-]`` with a digit or ``@``), each with its neighbouring words;
2. edges join each distinct instance with each distinct pattern it occurs in;
3. in each round a pattern's score for a kind is the share of its instances that
   are known to be of the kind, and an unknown instance gets the noisy-or of its
   accepted patterns; instances above the bound are known in the next round;
4. every occurrence of an instance found so is one more span of its kind, unless
   it touches a base span.

Texts never leave the scan: spans, identifiers and words around them do.  Instances
and patterns that hold a large share of the edges are joined by broadcast (there
can be few of them, see ``join_groups``); all sums combine before the shuffle.

Defined cases: a null text counts as empty; an empty text has no spans; repeated
rows each get a row, null doc_ids too; patterns are judged on distinct instances,
so copies of a document add no weight; a pattern or instance between two kinds of
equal score takes the kind listed first; a text of any length is scanned whole (every
expression is free of backtracking beyond one run, offsets are summed in blocks);
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import join_groups, stage, text_or_empty

KINDS = ["email", "ip", "card", "phone"]
# Possessive forms of the contract's expressions: the same leftmost matches without
# recursion or re-scans.  A run of e-mail letters is tried from its start only, or
# from where the last match ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BYTE = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])?"
OTHER = r"(?<![A-Za-z0-9._%+@-])[A-Za-z._%+-]*+[0-9@](?:[A-Za-z0-9._%+@-]*[A-Za-z0-9])?"
WORD = r"[^\x20\x09-\x0D]+"
#: Code points looked at before and after an occurrence for its neighbouring words.
BEFORE, AFTER = 48, 24
#: Distinct known instances that a pattern needs, and its least score.
MIN_SUPPORT, MIN_PATTERN = 3, 0.7
#: Least confidence of an instance, rounds, least length of an identifier found.
MIN_INSTANCE, ROUNDS, MIN_LENGTH = 0.8, 3, 5
_STEP = 256


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0), lambda a, x: a + x)


def running_sums(lengths: Column) -> Column:
    """Sum of the elements before each one, block by block: no step is quadratic."""
    def whole(xs):
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / _STEP).cast("int")),
                             lambda b: F.slice(xs, b * _STEP + 1, F.lit(_STEP)))
        return let(blocks, lambda bs: let(F.transform(bs, _total), lambda totals: F.flatten(F.transform(
            bs, lambda block, b: let(_total(F.slice(totals, F.lit(1), b)), lambda start: F.transform(
                block, lambda _, i: start + _total(F.slice(block, F.lit(1), i))))))))
    return let(lengths, whole)


def matches(text: Column, pattern: str, likely: Column) -> Column:
    """Leftmost matches as array of (start, end, text, left, right); offsets in code points.
    ``likely`` is a cheap necessary condition."""
    kind = "array<struct<start:int,end:int,text:string,left:string,right:string>>"
    none = F.array().cast(kind)

    def placed(hits):
        def spans(gaps):
            lengths = F.transform(hits, lambda h, i: F.length(F.get(gaps, i)) + F.length(h))
            return let(running_sums(lengths), lambda before: F.transform(hits, lambda h, i: let(
                F.get(before, i) + F.length(F.get(gaps, i)), lambda start: F.struct(
                    start.alias("start"), (start + F.length(h)).alias("end"), h.alias("text"),
                    F.right(F.get(gaps, i), F.lit(BEFORE)).alias("left"),
                    F.left(F.get(gaps, i + 1), F.lit(AFTER)).alias("right")))))
        return F.when(F.size(hits) > 0, let(F.split(text, pattern, -1), spans)).otherwise(none).cast(kind)
    return F.when(likely, let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)).otherwise(none)


def luhn(digits: Column) -> Column:
    """The check sum of a string of digits is a multiple of ten."""
    def value(i):
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))
    return _total(F.transform(F.sequence(F.lit(0), F.length(digits) - 1), value)) % 10 == 0


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def base_spans(text: Column) -> dict[str, Column]:
    """Per kind its valid matches."""
    digit = text.rlike("[0-9]")
    card = lambda s: let(_digits(s["text"]), lambda d: F.when(F.length(d).between(16, 19), luhn(d)).otherwise(False))
    return {
        "email": matches(text, EMAIL, F.contains(text, F.lit("@"))),
        "ip": F.filter(matches(text, IP, digit & F.contains(text, F.lit("."))),
                       lambda s: s["text"].rlike(rf"^{BYTE}\.{BYTE}\.{BYTE}\.{BYTE}$")),
        "card": F.filter(matches(text, CARD, digit), card),
        "phone": F.filter(matches(text, PHONE, F.contains(text, F.lit("+"))),
                          lambda s: F.length(_digits(s["text"])).between(8, 15)),
    }


def scanned(docs: DataFrame) -> DataFrame:
    """rid, doc_id and the arrays email, ip, card, phone and other; one row per row, staged."""
    text = F.col("__text")
    rows = docs.select("doc_id", text_or_empty().alias("__text"))
    rows = rows.select("doc_id", *[c.alias(k) for k, c in base_spans(text).items()],
                       matches(text, OTHER, text.rlike("[0-9@]")).alias("other"))
    return stage(rows.withColumn("rid", F.monotonically_increasing_id()), "pii-scan")


def occurrences(scan: DataFrame) -> DataFrame:
    """rid, kind (index; null for identifiers), start, end, text, left, right; identifiers
    that touch a base span are left out (their base span stands for them)."""
    def marked(column, kind):
        return F.transform(column, lambda s: F.struct(F.lit(kind).cast("int").alias("kind"), s.alias("s")))
    each = [marked(k, i) for i, k in enumerate(KINDS)]
    rows = scan.select("rid", F.inline(F.concat(*each, marked("other", None)))).select("rid", "kind", "s.*")
    # Per text, in order: the furthest end of a base span that began, the next one's start.
    end = F.expr("max(if(kind is null, null, end)) over (partition by rid order by start range between unbounded preceding and current row)")
    start = F.expr("min(if(kind is null, null, start)) over (partition by rid order by start range between current row and unbounded following)")
    rows = rows.withColumn("__end", end).withColumn("__start", start)
    touches = (F.coalesce(F.col("__end"), F.lit(0)) > F.col("start")) | (F.coalesce(F.col("__start") < F.col("end"), F.lit(False)))
    return rows.filter(F.col("kind").isNotNull() | (~touches & (F.length("text") >= MIN_LENGTH))).drop("__end", "__start")


def _patterns() -> Column:
    """Lexical patterns of an occurrence: the two words before it; the words beside it."""
    words = lambda c: F.regexp_extract_all(F.regexp_replace(F.lower(c), "[0-9]", "0"), F.lit(WORD), F.lit(0))
    before, after = words("left"), words("right")
    one, two, then = F.try_element_at(before, F.lit(-1)), F.try_element_at(before, F.lit(-2)), F.get(after, 0)
    return F.filter(F.array(F.concat(F.lit("before "), two, F.lit(" "), one), F.concat(F.lit("beside "), one, F.lit(" _ "), then)),
                    lambda p: p.isNotNull())


def bootstrap(found: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Instances found (text, kind, conf, n: occurrences outside base spans) and the accepted
    patterns of the last round (pattern, kind, score, support) over staged occurrences."""
    edges = stage(found.select(F.explode(_patterns()).alias("pattern"), "text").distinct(), "pii-edges")
    # A string is a seed of the kind it is most often; unknown strings carry their occurrences.
    counted = found.groupBy("text", "kind").agg(F.count("*").alias("n"))
    best = F.max(F.when(F.col("kind").isNotNull(), F.struct(F.col("n"), (-F.col("kind")).alias("kind"))))
    strings = counted.groupBy("text").agg((-best["kind"]).alias("seed"), F.sum(F.when(F.col("kind").isNull(), F.col("n"))).alias("n"))
    degrees = edges.groupBy("text").agg(F.count("*").alias("edges"))
    strings = stage(strings.join(degrees, "text", "left").withColumn("edges", F.coalesce("edges", F.lit(0).cast("long"))), "pii-strings")
    sizes = stage(edges.groupBy("pattern").agg(F.count("*").alias("size")), "pii-patterns")
    known = strings.select("text", F.col("seed").alias("kind"), F.lit(1.0).alias("conf"), "edges").filter("kind is not null")
    patterns = None
    for _ in range(rounds):
        told = join_groups(edges, known, ["text"], "edges")
        sums = (told.groupBy("pattern", "kind").agg(F.sum("conf").alias("conf"), F.count("*").alias("support"))
                .filter(F.col("support") >= MIN_SUPPORT))
        scored = sums.join(sizes, "pattern").withColumn("score", F.round(F.col("conf") / (F.col("size") + 1), 9))
        # Scores of one pattern add up to less than one, so at most one kind passes.
        patterns = stage(scored.filter(F.col("score") >= MIN_PATTERN).select("pattern", "kind", "score", "support", "size"), "pii-accepted")
        hits = join_groups(edges, patterns, ["pattern"], "size")
        noisy = F.round(1 - F.exp(F.sum(F.log(1 - F.col("score")))), 9)
        reached = hits.groupBy("text", "kind").agg(noisy.alias("conf"))
        top = reached.groupBy("text").agg(F.max(F.struct(F.col("conf"), (-F.col("kind")).alias("kind"))).alias("b"))
        new = (top.select("text", (-F.col("b.kind")).alias("kind"), F.col("b.conf").alias("conf")).filter(F.col("conf") >= MIN_INSTANCE)
               .join(strings.filter("seed is null").select("text", "edges"), "text"))
        known = stage(strings.filter("seed is not null").select("text", F.col("seed").alias("kind"), F.lit(1.0).alias("conf"), "edges")
                      .unionByName(new), "pii-known")
    instances = known.join(strings.select("text", "n"), "text").filter("n > 0").select("text", "kind", "conf", "n")
    return instances, patterns


def pii_spans(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, base and found: arrays of (kind index, start, end), ordered; a row per row of
    ``docs``.  ``found`` holds the spans that the bootstrapped patterns add."""
    scan = scanned(docs)
    seen = stage(occurrences(scan), "pii-occurrences")
    instances, _ = bootstrap(seen, rounds)
    unknown = seen.filter("kind is null").select("rid", "start", "end", "text")
    new = join_groups(unknown, stage(instances, "pii-instances"), ["text"], "n").groupBy("rid").agg(
        F.array_sort(F.collect_list(F.struct("kind", "start", "end"))).alias("found"))
    part = lambda i, k: F.transform(k, lambda s: F.struct(F.lit(i).cast("int").alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    base = F.concat(*[part(i, k) for i, k in enumerate(KINDS)])
    return scan.select("rid", "doc_id", base.alias("base")).join(new, "rid", "left").select(
        "doc_id", "base", F.coalesce("found", F.array().cast("array<struct<kind:int,start:int,end:int>>")).alias("found"))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii_report(docs: DataFrame) -> DataFrame:
    """The query: doc_id, base counts per kind, the digest of the base spans, all spans."""
    rows = pii_spans(docs)
    def count(i):
        return F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    return rows.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)], F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
                       _listed(F.array_sort(F.concat("base", "found"))).alias("spans"),
                       F.size("found").cast("long").alias("n_found"))
