"""Exact top-k search: tiled matrix products, a partial selection in each tile, merged tops.

Vectors are turned into integers, floor(scale * x), and scored by inner product. Queries are
packed into tiles, which are dealt into groups of about ``BLOCK_BYTES``, and rows into shards, which
are dealt into buckets. Each group meets each bucket in a task of its own, which holds the group's
tiles, multiplies each with the bucket's shards one by one, selects the k best of the product and
merges them into the tops that it has so far. What tasks return, k rows for each query, is merged by a
tree. Nothing of queries or rows comes to the driver but the tiles' total size.

Vectors that are null, or that hold null or non-finite components, take no part; an empty
vector is a vector of no dimensions. Vectors are compared with those of equal dimension only.
A row whose id is null takes no part. Rows that repeat are rows of their own; a query id that
stands in several rows gets the best of all its rows, and rows that bear its own id are none of
its candidates. Scores beyond 64 bits are cut to the largest or smallest long.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborel.llm.common import stored

#: Queries of a tile, rows of a shard, bytes of a group of tiles.
TILE = 512
SHARD = 4096
BLOCK_BYTES = 16_000_000
#: Lists of one query that meet in one step of the tree.
FAN = 64

_LONG = np.iinfo(np.int64)


def _vectors(batch: pa.RecordBatch, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, integer vectors as doubles) of each dimension that the batch has; columns are id and list of double."""
    ids, lists = batch.column(0), batch.column(1)
    ok = np.asarray(ids.is_valid()) & np.asarray(lists.is_valid())
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten() if lists.null_count == 0 else lists.values.slice(lists.offsets[0].as_py(), lists.offsets[-1].as_py() - lists.offsets[0].as_py())
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
    starts = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    ok &= bad[starts[1:]] == bad[starts[:-1]]
    ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
    for dim in np.unique(sizes[ok]).tolist():
        rows = np.flatnonzero(ok & (sizes == dim))
        yield ids[rows], np.floor(scale * values[starts[rows][:, None] + np.arange(dim)[None, :]])


def _scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products; in doubles where those are exact, else in whole numbers of any size."""
    dim = queries.shape[1]
    most = (np.abs(queries).max(initial=0.0)) * (np.abs(rows).max(initial=0.0)) * max(dim, 1)
    if most < 2.0**52:
        return (queries @ rows.T).astype(np.int64)
    if most < 2.0**62 and max(np.abs(queries).max(), np.abs(rows).max()) < 2.0**62:
        return queries.astype(np.int64) @ rows.astype(np.int64).T
    a = np.array([[int(x) for x in q] for q in queries], object)
    b = np.array([[int(x) for x in r] for r in rows], object)
    return np.array([[min(max(sum(x * y for x, y in zip(q, r)), _LONG.min), _LONG.max) for r in b] for q in a], np.int64)


def select(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each row of scores, ties to smaller ids: (row, score, id). ids ascend; a row's own id is left out."""
    out_rows, out_scores, out_ids = [], [], []
    m = len(ids)
    wanted = k + 1  # one may be the query's own
    if m > 4 * wanted:
        limit = np.partition(scores, m - wanted, axis=1)[:, m - wanted]
        # own ids that stand in several rows may take more than one place
        doubled = np.isin(own, ids[1:][ids[1:] == ids[:-1]])
        limit[doubled] = _LONG.min
        rows, at = np.nonzero(scores >= limit[:, None])
    else:
        rows, at = (x.ravel() for x in np.indices(scores.shape))
    keep = ids[at] != own[rows]
    rows, at = rows[keep], at[keep]
    got = scores[rows, at]
    order = np.lexsort((ids[at], ~got, rows))  # ~x falls as x rises, without overflow
    rows, at, got = rows[order], at[order], got[order]
    first = np.searchsorted(rows, np.arange(len(scores)))
    good = np.arange(len(rows)) - first[rows] < k
    out_rows, out_scores, out_ids = rows[good], got[good], ids[at[good]]
    return out_rows, out_scores, out_ids


class _Tops:
    """The tops of one query tile, merged shard by shard."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, k: int):
        self.own, self.matrix, self.k = ids, matrix, k
        self.rows = np.empty(0, np.int64)
        self.scores = np.empty(0, np.int64)
        self.ids = np.empty(0, np.int64)

    def add(self, ids: np.ndarray, rows: np.ndarray) -> None:
        r, s, i = select(_scores(self.matrix, rows), ids, self.own, self.k)
        r, s, i = np.concatenate([self.rows, r]), np.concatenate([self.scores, s]), np.concatenate([self.ids, i])
        order = np.lexsort((i, ~s, r))
        r, s, i = r[order], s[order], i[order]
        good = np.arange(len(r)) - np.searchsorted(r, np.arange(len(self.own)))[r] < self.k
        self.rows, self.scores, self.ids = r[good], s[good], i[good]


def _packed(rows: DataFrame, scale: float, most: int) -> DataFrame:
    """Rows as matrices of at most so many, their ids in ascending order: (dim, ids, matrix)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, matrix in _vectors(batch, scale):
                order = np.argsort(ids, kind="stable")
                ids, matrix = ids[order], matrix[order]
                for i in range(0, len(ids), most):
                    part = matrix[i : i + most]
                    yield pa.RecordBatch.from_arrays([pa.array([part.shape[1]], pa.int32()), pa.array([ids[i : i + most].astype("<i8").tobytes()], pa.binary()), pa.array([part.astype("<f8").tobytes()], pa.binary())], ["dim", "ids", "matrix"])

    return rows.mapInArrow(run, "dim int, ids binary, matrix binary")


def _tiles(parts: dict[int, list[tuple[np.ndarray, np.ndarray]]], k: int) -> list[_Tops]:
    tops = []
    for found in parts.values():
        ids, matrix = (np.concatenate(x) for x in zip(*found))
        tops += [_Tops(ids[i : i + TILE], matrix[i : i + TILE], k) for i in range(0, len(ids), TILE)]
    return tops


def _scan(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The k best candidates of every query of a group in a bucket, from rows sorted by group, bucket and kind (tiles first)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple[int, int] | None = None
        waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        tops: list[_Tops] = []

        def done() -> Iterator[pa.RecordBatch]:
            for top in tops:
                lists = pa.array(np.full(len(top.rows), at[1], np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(top.own[top.rows]), pa.array(top.ids), pa.array(top.scores), lists], ["query_id", "vec_id", "score", "list"])

        for batch in batches:
            for group, bucket, kind, dim, raw_ids, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if (group, bucket) != at:
                    yield from done()
                    at, waiting, tops = (group, bucket), {}, []
                ids = np.frombuffer(raw_ids, "<i8")
                matrix = np.frombuffer(raw, "<f8").reshape(len(ids), dim)
                if kind == 0:
                    waiting.setdefault(dim, []).append((ids, matrix))
                    continue
                if waiting:
                    tops, waiting = _tiles(waiting, k), {}
                for top in tops:
                    if top.matrix.shape[1] == dim:
                        top.add(ids, matrix)
        yield from done()

    return run


def _merged(lists: DataFrame, k: int, parts: int) -> DataFrame:
    """Tops of tops, level by level, until at most FAN lists of a query meet at once."""
    lists = lists.withColumn("list", F.col("list") % parts)
    while parts > FAN:
        parts = -(-parts // FAN)
        level = Window.partitionBy("query_id", "list").orderBy(F.desc("score"), "vec_id")
        lists = lists.withColumn("list", F.col("list") % parts).withColumn("rank", F.row_number().over(level)).filter(F.col("rank") <= k).drop("rank")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best rows, all of them if there are fewer."""
    picked = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"), is_query.alias("is_query"))
    rows = picked.select("vec_id", "embedding")
    tiles = stored(_packed(picked.filter("is_query").select("vec_id", "embedding"), scale, TILE), "tiles")
    size = tiles.agg(F.sum(F.length("ids") + F.length("matrix"))).first()[0] or 0
    groups, buckets = max(1, math.ceil(size / BLOCK_BYTES)), max(1, rows.rdd.getNumPartitions())
    own = lambda n: F.pmod(F.xxhash64("ids"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    what = ["dim", "ids", "matrix"]
    dealt = tiles.select(own(groups).alias("group"), every(buckets).alias("bucket"), F.lit(0).alias("kind"), *what)
    dealt = dealt.unionByName(_packed(rows, scale, SHARD).select(every(groups).alias("group"), own(buckets).alias("bucket"), F.lit(1).alias("kind"), *what))
    dealt = dealt.repartition("group", "bucket").sortWithinPartitions("group", "bucket", "kind")
    return _merged(dealt.mapInArrow(_scan(k), "query_id long, vec_id long, score long, list int"), k, buckets)
