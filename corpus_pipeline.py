"""A corpus pipeline over documents: toxicity, exact dedup, near-dedup, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read as the next one's docs. All
but the last return the columns of documents. Null and empty texts pass the first stage, are one group of copies in the
second and have no words to mix in the fourth; empty tables pass through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import bpe, mixing, simhash_vp, toxicity
from tickloom.llm import common as C
from tickloom.llm import exact_dedup as dedup

#: The file of the tokenizer's ranks, and the pattern that splits texts before.
RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
#: Workers of the last stage stand beside executors that the stages before have filled.
LEAN = bpe.Bounds(states=40_000, pairs=100_000, chunks=16_000_000, matches=5_000_000)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5; learned from the labels of this stage's documents."""
    return toxicity.accepted(docs, toxicity.fit(docs, C.table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal but for white space: the longest, then the smallest doc_id."""
    return C.keep(docs, dedup.exact_dedup(docs).select("doc_id", "key", "kept"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each group of similar ones: five-word shingles, similarity 0.8 or more."""
    groups = simhash_vp.near_groups(docs, simhash_vp.similarity_plan(similarity=0.8, shingle=5))
    return C.keep(docs, groups.select("doc_id", "key", (F.col("row_no") == F.col("first_row")).alias("kept")))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: not at all, once or twice."""
    return mixing.resample(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, exact."""
    return bpe.encode_documents(docs, RANKS, PATTERN, ("lang", "source"), LEAN)


STAGES = [("toxicity", without_toxic), ("exact dedup", without_copies), ("simhash near-dedup", without_near_copies), ("mixing", mixed), ("bpe", encoded)]

#: A learned model, fingerprints, a schedule of blocks and BPE have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = C.spool(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
