"""Documents to training tokens: quality rules, near-duplicates, personal data, mixture, token ids.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but
the last return the columns of ``documents``. Part of the training-data operators in arborel.llm.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from arborel.llm import mixing, near_dup, pieces, pii, quality
from arborel.llm.common import stored, tuned
from arborel.llm.queries import REST, SEED, WEIGHTS


#: Documents are near-duplicates from a similarity of 0.8; op4 has a contract of its own.
SIMILAR = near_dup.Similarity(percent=80, matches=near_dup.matches_for(80))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or their language's perplexity band reject go."""
    tuned(spark)
    return quality.filter_documents(docs, quality.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates, the document with the least doc_id stays."""
    tuned(spark)
    return near_dup.keep_one(docs, SIMILAR).select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by pseudonyms of the same format."""
    tuned(spark)
    return pii.replace_in(docs, pii.session_key(spark))


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for, shuffled globally."""
    tuned(spark)
    return mixing.mix(docs, WEIGHTS, rest=REST, seed=SEED).select(docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and ids of every document's copy."""
    tuned(spark)
    return pieces.encode_documents(docs, "piece_bpe_32k.model").select("doc_id", "lang", "source", "n_tokens", "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("source mixture", source_mixture),
    ("token ids", token_ids),
]

#: The stages' methods cannot be expressed in SQL; tests hold them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
