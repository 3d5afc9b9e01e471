"""Operators as stages of a corpus pipeline: each takes documents and returns documents, the last returns pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid, minhash, mixing, packing, pii
from ._common import materialize, workers_import

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A text whose best language is less probable than this is rejected.
LEAST_SCORE = 0.5
#: Texts whose word shingles agree in so many hundredths are near duplicates here; op10 alone has 85.
NEAR = 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter and those of no clear language; the others get the language found.

    Null, empty and blank texts are rejected. Every row stands for itself, so repeated rows and rows with a null id get equal
    treatment. Where no row has a label there is nothing to learn and every text is rejected. An empty table gives none.
    """
    workers_import(spark)
    model = langid.fit(docs, F.lit(True))
    found = langid.identify(docs.select(*COLUMNS), model, keep=("text", "lang", "source", "n_chars"))
    good = found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return good.select("doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group: the one with the smallest id.

    Rows that repeat an id and a text count once (with the least of their other columns); rows of one id with different texts all
    stay if the id does. Null and empty texts are alike to nothing and stay. Rows without an id have no group and stay, each.
    """
    workers_import(spark)
    kept = materialize(minhash.near_duplicates(docs, threshold=NEAR).where("kept and doc_id is not null").select("doc_id").distinct(), "kept")
    rows = docs.select(*COLUMNS)
    one = rows.where("doc_id is not null").join(kept, "doc_id", "left_semi").groupBy("doc_id", "text").agg(F.min(F.struct("lang", "source", "n_chars")).alias("_r"))
    return one.select("doc_id", "text", "_r.lang", "_r.source", "_r.n_chars").union(rows.where("doc_id is null")).select(*COLUMNS)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every span found by its kind in brackets; n_chars is counted anew.

    Null texts stay null (n_chars too), empty ones empty. Rows stand for themselves: repeated ones get equal results.
    """
    workers_import(spark)
    found = pii.find(docs, pii.fit(docs), keep=("lang", "source"), redact=True)
    return found.select("doc_id", F.col("redacted_text").alias("text"), "lang", "source", F.length("redacted_text").cast("long").alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or thins documents to the sources' target weights, in a global shuffle.

    A stage returns the columns of documents, so the copies of a document are equal rows: the number of a copy isn't kept. A null
    source is a source of its own; rows with a null or repeated id draw alike; a source without a character has rate 1.
    """
    return mixing.replicate(docs.select(*COLUMNS)).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of up to 1024 tokens, as packing.pack gives them.

    A null or empty text is the separator alone. Every row, repeated ones too, is packed once; a null id stays null. An empty table
    gives no piece.
    """
    workers_import(spark)
    return packing.pack(docs)
