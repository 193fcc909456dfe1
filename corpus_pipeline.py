"""The corpus pipeline: quality rules, exact dedup, MinHash near-dedup, mixing to target weights, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that the next one gets after it was written
and read again. All but the last keep the columns of documents.
"""

from __future__ import annotations

import public_tokenizers

from granary.llm import bpe, exact_dedup, mixing, near_dedup, quality
from granary.llm.common import cut, cut_texts


def quality_rules(spark, docs, sf_dir):
    """Documents that pass the base rules and their language's and source's limits."""
    return quality.keep_good(docs)


def exact(spark, docs, sf_dir):
    """Of equal texts, the one with the most characters."""
    return exact_dedup.keep_first(docs)


def near(spark, docs, sf_dir):
    """Of near-duplicates, the smallest id of each component."""
    return near_dedup.keep_one(docs)


def mix(spark, docs, sf_dir):
    """Every document as often as the mix takes it."""
    return mixing.mixed(docs)


def encode(spark, docs, sf_dir):
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row, worked out at once in small batches."""
    return cut_texts(bpe.encode_and_decode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN))


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact), ("minhash_near_dedup", near), ("source_mixing", mix), ("byte_bpe", encode)]

#: Mixing draws and similarity aren't expressed in SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Applies the stages to the table documents; between stages the rows are cut from their lineage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if k == 0 else cut(docs), sf_dir)
    return docs
