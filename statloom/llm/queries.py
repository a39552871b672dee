"""The thin queries over whole tables, one for each operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ..session import Scratch, shared_dir, table
from . import alignment, chat, decontaminate, language_id, language_model, licenses, packing, prefix_trie, quality_rules, simhash, site_quality, sql, suffix_dedup, token_files


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_bytes(spark, table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    return scratch.kept(packing.pack(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 1, scratch=scratch), "pieces")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = token_files.write_tokens(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 0, shared_dir(spark))
    return token_files.read_back(spark, made)


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = chat.with_probe(spark, table(spark, sf_dir, "conversations"))
    return chat.read_back(spark, chat.write_examples(spark, conversations, shared_dir(spark)))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(spark, table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_quality.classify(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(spark, table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), Scratch(spark))


def op12_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(spark, table(spark, sf_dir, "documents"), Scratch(spark))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    return scratch.kept(prefix_trie.trie(spark, table(spark, sf_dir, "conversations"), scratch), "nodes")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_language_id": op2_language_id,
    "op3_packing": op3_packing,
    "op4_token_files": op4_token_files,
    "op5_chat": op5_chat,
    "op6_decontaminate": op6_decontaminate,
    "op7_licenses": op7_licenses,
    "op8_quality_rules": op8_quality_rules,
    "op9_site_quality": op9_site_quality,
    "op10_simhash": op10_simhash,
    "op11_alignment": op11_alignment,
    "op12_language_model": op12_language_model,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE_SQL: dict[str, str] = {"op5_chat": chat.ORACLE, "op6_decontaminate": sql.HITS, "op13_prefix_trie": prefix_trie.ORACLE}
