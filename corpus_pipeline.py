"""The corpus pipeline: language, near duplicates, personal data, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cantor.llm import stages
from cantor.llm._common import materialize, table

STAGES = (
    ("language", stages.identify_language),
    ("near_duplicates", stages.drop_near_duplicates),
    ("personal_data", stages.redact_personal_data),
    ("mixing", stages.mix_sources),
    ("packing", stages.pack_sequences),
)

#: Language scores, marginals of the random field and token ids have no SQL; tests/llm has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage on all rows its predecessor kept, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
