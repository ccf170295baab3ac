"""The queries opN_<name>: thin, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, idfiles, toxicity, warc
from . import common as C
from .exact_dedup import exact_dedup
from .fingerprints import fingerprint_edits
from .licenses import license_scan
from .mixing import mix_counts
from .secrets import secret_digests
from .simhash_vp import near_groups


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(C.table(spark, sf_dir, "documents")).drop("row_no", "key")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(C.table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.hex("print")).alias("fingerprint"), "component_id")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(C.table(spark, sf_dir, "pages"), C.fresh_path(spark, "warc"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(C.table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(C.table(spark, sf_dir, "documents"), tokenizers.path("byte_bpe_multi_50k.tiktoken"), tokenizers.PATTERN)


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(C.table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_counts(C.table(spark, sf_dir, "documents")).drop("row_no", "key")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, C.table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model)


def op9_idfiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = C.table(spark, sf_dir, "documents"), C.fresh_path(spark, "ids")
    return idfiles.read_ids(idfiles.write_ids(docs, tokenizers.path("byte_bpe_50k.json"), tokenizers.PATTERN, out, added=True))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(C.table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_simhash": op2_simhash,
        "op3_warc": op3_warc,
        "op4_fingerprints": op4_fingerprints,
        "op5_bpe": op5_bpe,
        "op6_licenses": op6_licenses,
        "op7_mixing": op7_mixing,
        "op8_toxicity": op8_toxicity,
        "op9_idfiles": op9_idfiles,
        "op10_secrets": op10_secrets,
    }
