"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, langid, licenses, minhash, mixing, packing, pii, quality, tokenscan, warc
from ._common import table
from .sql import LICENSE_SQL, MIXING_SQL, QUALITY_SQL


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_skip_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs))


def op3_chunked_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op4_ivf_pq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_license_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op6_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenscan.token_counts(table(spark, sf_dir, "documents"))


def op7_word_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    model = langid.fit(docs, ~held_out)
    return langid.identify(docs, model).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op8_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.replicate(table(spark, sf_dir, "documents"))


def op9_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return quality.quality(table(spark, sf_dir, "documents")).select(*kept)


def op10_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), threshold=85)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_skip_chain": op2_skip_chain,
    "op3_chunked_warc": op3_chunked_warc,
    "op4_ivf_pq": op4_ivf_pq,
    "op5_license_sentences": op5_license_sentences,
    "op6_separator_scan": op6_separator_scan,
    "op7_word_backoff": op7_word_backoff,
    "op8_poisson_mixing": op8_poisson_mixing,
    "op9_weak_supervision": op9_weak_supervision,
    "op10_lsh_forest": op10_lsh_forest,
}

ORACLE_SQL: dict[str, str] = {
    "op5_license_sentences": LICENSE_SQL,
    "op8_poisson_mixing": MIXING_SQL,
    "op9_weak_supervision": QUALITY_SQL,
}
