"""The corpus pipeline: five stages over the documents table, each written and read again.

Order: quality ranking (rejected documents go), SimHash near-duplicates (one
document of each group stays), pseudonyms for personal data, source mixing,
byte-level BPE.  Each function takes (spark, docs, sf_dir) and returns a
DataFrame; all but the last return the columns of ``docs``, extra ones of any
name included.  A table without rows goes through as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postlens.llm import bpe, mixing, pii, quality, simhash
from postlens.llm.common import col, stored, table
from postlens.llm.queries import PII_KEY


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranking accepts; a null text is judged as an empty one, equal texts alike."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group, the first by id; texts without words are one group."""
    return simhash.keep_one(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, its personal data under pseudonyms; null and empty texts as they are."""
    return pii.pseudonymise(docs, PII_KEY, found=None)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as its source's weight draws it, none included; a null source is a source."""
    return mixing.mix(docs).select(*[col(c) for c in docs.columns])


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of each row; a null text has no tokens."""
    import public_tokenizers

    return bpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: Hash functions, learnt weights and merges are beyond SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name}")
    return docs
