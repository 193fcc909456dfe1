"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers

from granary.llm import bpe, conversations, exact_dedup, html_text, lexical, line_dedup, mixing, near_dedup, quality, sharding, simhash, substring_dedup, wavelet
from granary.llm.common import documents


def op1_html_text(spark, sf_dir):
    return html_text.extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op2_line_dedup(spark, sf_dir):
    return line_dedup.line_report(documents(spark, sf_dir))


def op3_substring_dedup(spark, sf_dir):
    return substring_dedup.removed_spans(documents(spark, sf_dir))


def op4_minhash_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(documents(spark, sf_dir))


def op5_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op6_vector_sharding(spark, sf_dir):
    return sharding.shard_law(documents(spark, sf_dir))


def op7_source_mixing(spark, sf_dir):
    return mixing.taken_words(documents(spark, sf_dir))


def op8_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_and_decode(documents(spark, sf_dir), path, public_tokenizers.PATTERN)


def op9_wavelet_tokens(spark, sf_dir):
    return wavelet.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op10_quality_rules(spark, sf_dir):
    return quality.quality_rules(documents(spark, sf_dir))


def op11_lexical_search(spark, sf_dir):
    return lexical.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_conversation_repair(spark, sf_dir):
    return conversations.repair_damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_simhash_near_dedup(spark, sf_dir):
    return simhash.simhash_duplicates(documents(spark, sf_dir))


def queries() -> dict:
    return {f.__name__: f for f in (
        op1_html_text, op2_line_dedup, op3_substring_dedup, op4_minhash_near_dedup, op5_exact_dedup, op6_vector_sharding, op7_source_mixing, op8_bpe,
        op9_wavelet_tokens, op10_quality_rules, op11_lexical_search, op12_conversation_repair, op13_simhash_near_dedup,
    )}


def oracle_sql() -> dict[str, str]:
    return {"op2_line_dedup": line_dedup.ORACLE, "op5_exact_dedup": exact_dedup.ORACLE, "op11_lexical_search": lexical.ORACLE, "op12_conversation_repair": conversations.ORACLE}
