"""The queries of the training-data operators, over whole tables with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborel.llm import html_text, mixing, near_dup, pieces, pii, quality, secrets, token_counts, token_files, topk
from arborel.llm.common import shared_folder, tuned


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tuned(spark).read.parquet(f"{sf_dir}/{name}.parquet")


#: Every source to an equal share of the mixture.
WEIGHTS = {f"src{i}": 0.05 for i in range(20)}
#: All other sources, and null, together have an equal share too.
REST = 0.05
SEED = 20


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256.0)


OP1_SQL = """
WITH v AS (SELECT CAST(vec_id AS BIGINT) AS vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS (SELECT vec_id, len(e) AS dim, unnest(e) AS x, unnest(range(1, len(e) + 1)) AS i FROM v),
s AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(sum(q.x * d.x) AS BIGINT) AS score
  FROM c q JOIN c d ON q.i = d.i AND q.dim = d.dim AND q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0 GROUP BY q.vec_id, d.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(_table(spark, sf_dir, "documents"), "piece_bpe_32k.model")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    token_files.write_tokens(_table(spark, sf_dir, "documents"), path, "word_bpe_49k.json", end_id=1)
    return token_files.read_documents(spark, path)


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(_table(spark, sf_dir, "pages"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), "byte_bpe_50k.tiktoken")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"), vocabulary="word_bpe_49k.json")


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"), WEIGHTS, rest=REST, seed=SEED)


OP9_SQL = mixing.mix_sql(WEIGHTS, SEED, columns="doc_id, text, lang, source, n_chars")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonyms(_table(spark, sf_dir, "documents"), pii.session_key(spark))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_topk": op1_exact_topk,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_quality": op3_quality,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_token_files": op5_token_files,
    "op6_html_extraction": op6_html_extraction,
    "op7_token_counts": op7_token_counts,
    "op8_secret_scan": op8_secret_scan,
    "op9_source_mixing": op9_source_mixing,
    "op10_pii": op10_pii,
}

ORACLE_SQL: dict[str, str] = {"op1_exact_topk": OP1_SQL, "op9_source_mixing": OP9_SQL}
