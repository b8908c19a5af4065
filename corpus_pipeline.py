"""A training-data pipeline over ``documents``: each stage is written as Parquet and read again as the next one's input.

1. quality      learn from ``labels``, drop what the classifier rejects
2. near_copies  keep one document of each group of linked fingerprints, then of each group of texts that share 0.8 or more
                of their 5-word shingles
3. benchmark    drop documents that hold a window of a ``benchmark`` item
4. personal     mask personal data in the texts
5. tokens       BPE ids of the texts

Null and empty texts, repeated rows, empty tables and further columns are handled as the operators say; null ids come
first where the smallest id stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchgrid.llm import bpe, decontaminate, jaccard, pii, quality, simhash
from matchgrid.llm.common import table, written


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """No two documents that are left are linked, neither by fingerprints nor by shingles."""
    # read several times by what follows, so it is written and not dealt out again for each
    left = written(simhash.one_of_each(docs), "unlinked")
    return simhash.one_of_each(left, grouped=jaccard.near_copies)


def untested(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pii.redacted(docs, pii.fit(docs))
    if "n_chars" not in docs.columns:
        return out
    length = F.when(F.col("text").isNotNull(), F.char_length("text")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encoded(docs, public_tokenizers.path("word_bpe_49k.json"), ("doc_id", "lang", "source"))


STAGES = [("quality", good), ("near_copies", distinct), ("benchmark", untested), ("personal", masked), ("tokens", tokens)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: (doc_id, lang, source, n_tokens, ids) of what is left."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
