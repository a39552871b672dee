"""The corpus pipeline: quality rules, near-dedup, repeats, benchmark passages, packing.

Each stage gets the written rows of the one before it. So the first thing that
it does is to drop what the stage before it left in scratch folders, and
nothing but rows and training sequences stays.
"""

from __future__ import annotations

import threading

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from statloom.llm import decontaminate, encode, near_copies, packing, quality_rules, suffix_dedup
from statloom.session import Scratch, shared_dir, table

TOKENIZER, END = "word_bpe_49k.json", 1

_run = threading.local()


def _drop_scratch() -> None:
    """Drops the scratch folder of the stage that this thread ran last; its rows have been written."""
    if held := getattr(_run, "scratch", None):
        held.drop()
    _run.scratch = None


def _scratch(spark: SparkSession) -> Scratch:
    _drop_scratch()
    _run.scratch = Scratch(spark)
    return _run.scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    _drop_scratch()
    return quality_rules.filter_documents(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_copies.keep_first(spark, docs, scratch=_scratch(spark))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without bytes that an earlier place has."""
    return suffix_dedup.remove_repeats(spark, docs, scratch=_scratch(spark))


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark window."""
    _drop_scratch()
    return decontaminate.drop_contaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All pieces with their ids and places; the training sequences themselves are written to the shared folder."""
    path, scratch = public_tokenizers.path(TOKENIZER), _scratch(spark)
    pieces = packing.pack(spark, docs, path, END, keep_ids=True, scratch=scratch)
    written = scratch.kept(packing.sequences(pieces), "sequences")
    return packing.placed_pieces(written, encode.encoder(path).width)


STAGES = [("quality_rules", quality), ("simhash_near_dedup", near_dedup), ("suffix_dedup", repeats), ("decontamination", benchmark_free), ("packing", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents, each written and read again."""
    docs, folder = table(spark, sf_dir, "documents"), shared_dir(spark)
    try:
        for name, stage in STAGES:
            rows = stage(spark, docs, sf_dir)
            rows.write.parquet(f"{folder}/{name}")
            docs = spark.read.schema(rows.schema).parquet(f"{folder}/{name}")
    finally:
        _drop_scratch()
    return docs
