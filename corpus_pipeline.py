"""From raw documents to token ids: rejects toxic documents, keeps one of each group of near-duplicates, drops what
contains benchmark items, replaces personal data and encodes the rest.

Every stage takes (spark, docs, sf_dir) and works on all rows of the one before. All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlantern.llm import bpe, dartminhash, decontaminate, surrogates
from flowlantern.llm import toxicity as toxic
from flowlantern.llm.common import read, stored
from flowlantern.llm.queries import BYTE_RANKS, SURROGATE_KEY, toxicity_model


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below 0.5 of a model of the labelled ones."""
    model = toxicity_model(spark, docs, sf_dir)
    return docs.where(toxic.scored("text", model, spark)["score"] < 0.5)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each class of near-duplicates."""
    return dartminhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by a benchmark item."""
    return decontaminate.remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates in place of personal data; n_chars follows the text."""
    columns = docs.columns
    again = surrogates.redrawn(docs, SURROGATE_KEY)
    made = docs.withColumn("_made", surrogates.replaced("text", SURROGATE_KEY, again))
    changed = F.size("_made.entities") > 0
    made = made.withColumn("text", F.col("_made.text"))
    made = made.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return made.select(columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document."""
    ids = bpe.tokens("text", public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN)
    return docs.select("doc_id", ids.alias("ids")).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("encoding", encoding),
]

ORACLE_SQL = None  # models, signatures and tokenizers are beyond SQL; tests/llm tests the operators one by one


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
