"""The corpus pipeline: five operators, one after the other, over ``documents``.

Each stage works on all its predecessor kept, through a written table. All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cofi.llm import bpe, mixing, pii, quality, simhash
from cofi.llm.common import read_table
from cofi.llm.queries import PII_KEY, RANK_FILE, public_tokenizers
from cofi.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.mask(docs, PII_KEY)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, n_inside): the training tokens."""
    return bpe.encode(docs, RANK_FILE, public_tokenizers.PATTERN, offsets=False)


STAGES = [("quality rules", quality_rules), ("SimHash near-dedup", near_duplicates), ("PII pseudonyms", pseudonyms),
          ("source mixture", source_mixture), ("byte-level BPE", tokens)]

#: SQL can't express SimHash groups, the Feistel network or BPE; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if stage is not STAGES[-1][1]:
            docs = materialize(docs, f"pipeline-{name.split()[0]}")
    return docs
