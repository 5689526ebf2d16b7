"""Exact deduplication by skew-safe combining (DataFrame functions only).

Texts are equal when identical after lower-casing A-Z.  Three combining steps,
each grouping by the full normalised content (the digest only spreads the work):

1. local: the map-side half of the first aggregate reduces the copies of a text
   in one input partition to one record;
2. salted: (digest, salt, content) groups, the salt taken from the row id, so a
   text that fills a third of the table is dealt to ``salts`` tasks;
3. global: at most ``salts`` winners per content meet.

Rows then look their group up by digest, length and a second hash;
``join_groups`` broadcasts the few groups that are hot.

Defined cases: a null text counts as empty and equals other empty texts; a null
doc_id ranks below every id; of repeated rows with the same text and doc_id one
is kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import ascii_lower, join_groups, keep_rows, stage, text_or_empty

SALTS = 16


def exact_groups(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per distinct normalised text: (sha, xx, len, keep_id, group_size)."""
    norm = ascii_lower(text_or_empty())
    rows = docs.select(
        F.col("doc_id"), norm.alias("content"),
        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"))
    salted = rows.groupBy(F.xxhash64("content").alias("xx"), "salt", "content").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    full = salted.groupBy("xx", "content").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    return full.select(F.sha2("content", 256).alias("text_sha256"), "xx",
                       F.length("content").alias("len"), "keep_id", "group_size")


def exact_dedup(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256; one row per input row."""
    keys = ["text_sha256", "xx", "len"]
    norm = ascii_lower(text_or_empty())
    members = stage(
        docs.select("doc_id", norm.alias("content"))
        .select("doc_id", F.sha2("content", 256).alias("text_sha256"),
                F.xxhash64("content").alias("xx"), F.length("content").alias("len"))
        .groupBy("doc_id", *keys).agg(F.count("*").alias("copies")), "exact-members")
    groups = stage(exact_groups(docs, salts), "exact-groups")
    joined = join_groups(members, groups, keys, "group_size")
    each = joined.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return each.select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        "text_sha256")


def keep_one(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """``docs`` without the dropped copies; all columns kept.

    Repeated rows with equal doc_id and text count as copies: one of them stays.
    The look-up key (id, digest) belongs to one kept record, so it is never hot.
    """
    digest = F.sha2(ascii_lower(text_or_empty()), 256)
    ident = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    kept = exact_groups(docs, salts).select(
        F.coalesce(F.col("keep_id").cast("long"), F.lit(-(1 << 63))).alias("id"), F.col("text_sha256").alias("sha"))
    return keep_rows(docs, {"id": ident, "sha": digest}, kept, "left_semi", one_each=True)


ORACLE = """
with d as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
           from documents)
select doc_id, max(doc_id) over (partition by t) as keep_id,
       count(*) over (partition by t) as group_size,
       doc_id = max(doc_id) over (partition by t) as kept,
       sha256(t) as text_sha256
from d
"""
