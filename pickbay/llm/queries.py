"""The registered query of each operator, over whole tables."""

from __future__ import annotations

from pickbay.llm import (chat, decontam, mixing, neardup, prefix_trie, quality_rules, resample, sharding, tokenbin,
                         tokencount, transducer, warc, weak_quality)
from pickbay.llm.common import stage, stage_path

SHARDS = 24


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark, sf_dir):
    """Token counts of all documents before and after a batch of edits to each."""
    trees = stage(tokencount.token_trees(table(spark, sf_dir, "documents")), "token-trees")
    return tokencount.apply_edits(tokencount.spread_edits(trees)).drop("text", "tree")


def op2_minhash_near_duplicates(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_warc_revisits(spark, sf_dir):
    return warc.revisit_table(table(spark, sf_dir, "pages"), stage_path(spark, "warc"))


def op4_decontamination(spark, sf_dir):
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_mixing(spark, sf_dir):
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op6_token_records(spark, sf_dir):
    return tokenbin.token_table(table(spark, sf_dir, "documents"), stage_path(spark, "token-records"))


def op7_chat_masks(spark, sf_dir):
    chats = chat.format_chats(chat.with_hostile(spark, table(spark, sf_dir, "conversations")))
    return chat.digests(stage(chats, "chat"))


def op8_sharding(spark, sf_dir):
    return sharding.balanced_shards(table(spark, sf_dir, "documents"), SHARDS)


def op9_quality_rules(spark, sf_dir):
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def quality_ablation(spark, sf_dir):
    """What each rule of the current policy adds to it, from the ledger's bits."""
    return quality_rules.ablation(stage(quality_rules.ledger(table(spark, sf_dir, "documents")), "quality-ledger"))


def op10_weak_quality(spark, sf_dir):
    return weak_quality.classify(table(spark, sf_dir, "documents"))


def op11_bpe_transducer(spark, sf_dir):
    return transducer.code_digests(table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark, sf_dir):
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_minhash_near_duplicates, op3_warc_revisits, op4_decontamination, op5_mixing,
    op6_token_records, op7_chat_masks, op8_sharding, op9_quality_rules, op10_weak_quality,
    op11_bpe_transducer, op12_importance_resampling, op13_prefix_trie,
    quality_ablation,
)}
