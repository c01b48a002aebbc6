"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cofi.llm import (
    bpe, crosspoly, ctph, fm, hardneg, licenses, mixing, phrases, pii, quality, simhash, suffix, urls)
from cofi.llm.common import read_table

RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")


#: Stands for the secret that a production run is given.
PII_KEY = "pseudonym key of the registered queries"


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.selection(read_table(spark, sf_dir, "documents"))


def op2_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonyms(read_table(spark, sf_dir, "documents"), PII_KEY)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(read_table(spark, sf_dir, "documents"))


def op4_ctph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctph.edited_likeness(read_table(spark, sf_dir, "documents"))


def op5_fm_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm.digest(read_table(spark, sf_dir, "documents"))


def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digest(read_table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = quality.judge(read_table(spark, sf_dir, "documents"))
    return x.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digest(read_table(spark, sf_dir, "documents"), RANK_FILE, public_tokenizers.PATTERN)


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read_table(spark, sf_dir, "pages"), urls.rule_table(spark, urls.registered_rules()))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents"))


def op11_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosspoly.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hardneg.registered(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_mix_sources, op2_pii_pseudonyms, op3_simhash, op4_ctph, op5_fm_substrings,
                              op6_suffix_array, op7_quality_rules, op8_byte_bpe, op9_url_filters, op10_license_scan,
                              op11_embedding_neardup, op12_collocations, op13_hard_negatives)}

ORACLE_SQL: dict[str, str] = {"op1_mix_sources": mixing.oracle_sql(), "op9_url_filters": urls.oracle_sql(),
                              "op10_license_scan": licenses.oracle_sql(), "op11_embedding_neardup": crosspoly.oracle_sql(),
                              "op12_collocations": phrases.oracle_sql(), "op13_hard_negatives": hardneg.oracle_sql()}
