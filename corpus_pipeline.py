"""The corpus pipeline: low-quality documents go, near copies go, leaked benchmark items go, personal data becomes
pseudonyms, and what is left is encoded.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a DataFrame. All but the last
return the columns of documents. Rows without a doc_id are kept where no named document of their group is, and are encoded
with the others; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, decontaminate, pii, quality, simhash
from tidemark.llm.common import stored, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.protect(docs, pii.key_of(spark))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs)


STAGES = [("quality", keep_quality), ("near_duplicates", keep_distinct), ("decontamination", keep_clean), ("pii", pseudonymise), ("bpe", encode)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
