"""The registered queries of the text operators: whole tables, production parameters."""

from __future__ import annotations

import public_tokenizers

from orderlens.llm import (
    automaton_dedup, bpe, conversation_repair, decontaminate, exact_dedup, license_scan, lm_score, pii, prefix_trie, simhash,
    suffix_dedup, toxicity, url_filter)
from orderlens.llm.common import read


def op1_suffix_dedup(spark, sf_dir):
    return suffix_dedup.suffix_dedup(read(spark, sf_dir, "documents"))


def op2_license_scan(spark, sf_dir):
    return license_scan.license_scan(read(spark, sf_dir, "documents"))


def op3_lm_score(spark, sf_dir):
    return lm_score.quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_toxicity(spark, sf_dir):
    return toxicity.toxicity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_automaton_dedup(spark, sf_dir):
    return automaton_dedup.automaton_dedup(read(spark, sf_dir, "documents"))


def op6_bpe(spark, sf_dir, path=None):
    return bpe.encode_digests(read(spark, sf_dir, "documents"), path or public_tokenizers.path("byte_bpe_50k.json"))


def op7_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


def op8_url_filters(spark, sf_dir):
    return url_filter.url_verdicts(read(spark, sf_dir, "pages"), url_filter.rule_frame(spark))


def op9_simhash(spark, sf_dir):
    return simhash.simhash_query(read(spark, sf_dir, "documents"))


def op10_decontamination(spark, sf_dir):
    return decontaminate.decontamination_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op11_pii(spark, sf_dir):
    return pii.pii_report(read(spark, sf_dir, "documents"))


def op12_conversation_repair(spark, sf_dir):
    return conversation_repair.damage_and_repair(read(spark, sf_dir, "conversations"))


def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.rebuilt_trie(read(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_license_scan, op3_lm_score, op4_toxicity, op5_automaton_dedup, op6_bpe, op7_exact_dedup, op8_url_filters, op9_simhash,
                                  op10_decontamination, op11_pii, op12_conversation_repair, op13_prefix_trie)}
ORACLES = {"op7_exact_dedup": exact_dedup.ORACLE, "op8_url_filters": url_filter.ORACLE}
