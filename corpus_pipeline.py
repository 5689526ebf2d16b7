"""Corpus pipeline: toxicity, exact and near deduplication, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept;
all but the last return the columns of ``docs``.  Nulls, empty texts, repeated rows,
empty tables and extra columns are handled as the operators' modules state.
"""

from __future__ import annotations

import public_tokenizers

from orderlens.llm import bpe, decontaminate, exact_dedup, simhash, toxicity
from orderlens.llm.common import read, stage

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def drop_toxic(spark, docs, sf_dir):
    """Rows that the weakly supervised classifier scores below its threshold."""
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"))


def drop_copies(spark, docs, sf_dir):
    """Of equal texts (A-Z lower-cased) the row with the largest doc_id."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark, docs, sf_dir):
    """Of each SimHash component the row with the smallest doc_id."""
    return simhash.near_dedup(docs)


def drop_contaminated(spark, docs, sf_dir):
    """Rows that do not hold half of a benchmark item in tiles of five words or more."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def encode(spark, docs, sf_dir):
    """doc_id, number of tokens and digests of the ids and of the decoded text."""
    return bpe.encode_digests(docs, TOKENIZER)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("simhash_dedup", drop_near_copies),
          ("decontamination", drop_contaminated), ("bpe", encode)]

#: Training, components, tiling and merges have no SQL form; tests/llm compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
