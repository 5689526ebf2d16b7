"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.session import shared_dir
from orderlens.sources.store import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A join key is hot when it holds at least this share of all rows; at most
#: HOT_KEYS keys can do so, which bounds what is broadcast.
HOT_KEYS = 1000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of the corpus; also makes sure that the shared folder is known."""
    shared_dir(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage, and a
    lost executor costs a re-read only."""
    shared_dir(df.sparkSession)
    return materialize(df, name=name)


def buckets(spark: SparkSession) -> int:
    """Number of hash buckets for work dealt out by key: the shuffle partitions."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def join_groups(rows: DataFrame, groups: DataFrame, keys: Iterable[str], size_col: str,
                how: str = "inner", hot_keys: int = HOT_KEYS) -> DataFrame:
    """Join each row to its group's single record, safe for hot groups.

    ``groups`` has one row per key and ``size_col``, the number of ``rows`` with
    that key.  A group holding at least 1/``hot_keys`` of all rows is joined by
    broadcast: the sizes add up to the row count, so at most ``hot_keys`` groups
    qualify whatever the input size.  All other groups take the shuffled join,
    where no key exceeds that share.  Both frames are read twice: pass staged ones.
    """
    keys = list(keys)
    total = groups.agg(F.sum(size_col)).first()[0] or 0
    is_hot = F.col(size_col) * F.lit(hot_keys) >= F.lit(total)
    hot = F.broadcast(groups.filter(is_hot))
    cold = groups.filter(~is_hot)
    rest = rows.join(F.broadcast(groups.filter(is_hot).select(*keys)), keys, "left_anti")
    return rows.join(hot, keys, "inner").unionByName(rest.join(cold, keys, how))


def keep_rows(docs: DataFrame, keys: dict[str, Column], listed: DataFrame, how: str, one_each: bool = False) -> DataFrame:
    """The rows of ``docs`` whose key is listed (``how`` left_semi) or is not (left_anti).

    ``keys`` maps the key columns of ``listed`` to expressions over ``docs``, none of
    them null; ``one_each`` keeps one row per key.  Rows travel as a struct, so any
    column names may occur in ``docs``.
    """
    rows = docs.select(F.struct("*").alias("row"), *[c.alias(k) for k, c in keys.items()])
    kept = rows.join(listed, list(keys), how)
    if one_each:
        kept = kept.dropDuplicates(list(keys))
    return kept.select("row.*")
