"""Token counts: an exact histogram of encoded lengths and what follows from its suffix sums.

Texts are encoded whole where they lie; only (length, documents) pairs are shuffled, summed
before the shuffle. The histogram has one row for each different length, so the running
sums need far fewer rows than there are documents; even so they are taken by blocks of
lengths, whose totals alone meet in one task.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arborel.llm.common import over_texts, stored, texts_of
from arborel.llm.encoders import encoder

#: Lengths whose sums are taken together.
BLOCK = 4096


def lengths(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """One row a document: n_tokens of the whole text (null: none, 0)."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, sizes = encoder(vocabulary).encode(texts_of(batch))
        return pa.RecordBatch.from_arrays([pa.array(sizes)], ["n_tokens"])

    return docs.select(F.col(text).cast("string").alias("text")).mapInArrow(over_texts(count), "n_tokens long")


def histogram(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """Per encoded length: n_tokens, n_docs (documents of that length). An empty table has no rows."""
    return lengths(docs, vocabulary, text).groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def context_totals(counts: DataFrame) -> DataFrame:
    """For the histogram (n_tokens, n_docs), with each length L as a context limit:

    docs_over     documents longer than L
    tokens_over   their tokens
    docs_upto     documents of at most L tokens
    tokens_upto   their tokens
    truncated     tokens left when every document is cut to L: tokens_upto + L * docs_over
    quantile      docs_upto / all documents, so the q-quantile of the lengths is the least L with quantile >= q

    For a limit between two lengths the row of the next smaller length holds the suffix sums.
    """
    h = counts.withColumn("block", F.floor(F.col("n_tokens") / BLOCK)).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("b_docs"), F.sum("tokens").alias("b_tokens"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("b_docs").over(later), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("b_tokens").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("b_docs").over(whole).alias("all_docs"),
        F.sum("b_tokens").over(whole).alias("all_tokens"),
    )
    longer = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    h = h.join(blocks, "block").withColumns(
        {
            "docs_over": F.col("later_docs") + F.coalesce(F.sum("n_docs").over(longer), F.lit(0)),
            "tokens_over": F.col("later_tokens") + F.coalesce(F.sum("tokens").over(longer), F.lit(0)),
        }
    )
    return h.select(
        "n_tokens",
        "n_docs",
        "docs_over",
        "tokens_over",
        (F.col("all_docs") - F.col("docs_over")).alias("docs_upto"),
        (F.col("all_tokens") - F.col("tokens_over")).alias("tokens_upto"),
        (F.col("all_tokens") - F.col("tokens_over") + F.col("n_tokens") * F.col("docs_over")).alias("truncated"),
        ((F.col("all_docs") - F.col("docs_over")) / F.col("all_docs")).alias("quantile"),
    )


def token_counts(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    # the histogram is read twice below; written, its texts are encoded once
    return context_totals(stored(histogram(docs, vocabulary, text), "lengths"))
