"""Token-id output in Simple-8b blocks, and reading it back.

Layout. A token table is a Parquet folder, which any store that Spark writes can hold and
whose commit survives lost tasks. A row is a run of whole documents in ascending id order:

    part      number of the writing task; parts are in id order
    seq       number of the run within its part
    before    ids of the part's earlier runs
    n_ids     ids in this run
    doc_ids   the documents' ids, 8 bytes little-endian each
    counts    their numbers of ids, Simple-8b words
    payload   all their ids, Simple-8b words (see simple8b)
    blocks    first word of every block of the payload, 4 bytes little-endian each, one more at the end

A document whose id is null stands first and is marked in ``nulls``. Documents of equal id
are in the order of their texts. Empty and null texts have the end id alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborel.llm import simple8b
from arborel.llm.common import GROUP_BYTES, slices, texts_of
from arborel.llm.encoders import encoder

RUN_SCHEMA = "part int, seq long, before long, n_ids long, doc_ids binary, nulls int, counts binary, payload binary, blocks binary"
_ARROW = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("before", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.binary()), ("nulls", pa.int32()), ("counts", pa.binary()), ("payload", pa.binary()), ("blocks", pa.binary())])


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int | None, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode every whole text and write the ids to ``path`` in ascending ``doc_id`` order.

    The texts are dealt by ranges of ids, so parts are of like size whatever one source
    holds; one part's memory is bounded by a slice of text. ``end_id`` ends each document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        coder = encoder(vocabulary)
        seq = before = 0
        for batch in batches:
            for piece in slices(batch, "text"):
                ids, sizes = coder.encode(texts_of(piece))
                if end_id is not None:
                    ids = np.insert(ids, np.cumsum(sizes), end_id)
                    sizes = sizes + 1
                keys = piece.column(0)
                words, first = simple8b.encode(ids)
                counts, _ = simple8b.encode(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int32()),
                        pa.array([seq], pa.int64()),
                        pa.array([before], pa.int64()),
                        pa.array([len(ids)], pa.int64()),
                        pa.array([keys.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes()], pa.binary()),
                        pa.array([keys.null_count], pa.int32()),
                        pa.array([counts.astype("<u8").tobytes()], pa.binary()),
                        pa.array([words.astype("<u8").tobytes()], pa.binary()),
                        pa.array([first.astype("<u4").tobytes()], pa.binary()),
                    ],
                    schema=_ARROW,
                )
                seq += 1
                before += len(ids)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    dealt = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    dealt.mapInArrow(run, RUN_SCHEMA).write.option("parquet.block.size", GROUP_BYTES).parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The runs of a token table with ``start``, the number of ids before each in the whole table.

    Only one total for each part meets in the running sum over parts.
    """
    runs = spark.read.schema(RUN_SCHEMA).parquet(path)
    totals = sorted((r.part, r.n) for r in runs.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    starts, so_far = [], 0
    for part, n in totals:
        starts.append((part, so_far))
        so_far += n
    offsets = spark.createDataFrame(starts or [(0, 0)], "part int, part_start long")
    return runs.join(F.broadcast(offsets), "part").withColumn("start", F.col("part_start") + F.col("before")).drop("part_start")


def _documents(row: dict) -> tuple[np.ndarray, int, np.ndarray, np.ndarray]:
    keys = np.frombuffer(row["doc_ids"], "<i8")
    counts = simple8b.decode(*_blocks(np.frombuffer(row["counts"], "<u8"), len(keys)), len(keys)).astype(np.int64)
    ids = simple8b.decode(np.frombuffer(row["payload"], "<u8"), np.frombuffer(row["blocks"], "<u4").astype(np.int64), row["n_ids"])
    return keys, row["nulls"], counts, ids


def _blocks(words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of the blocks of n values, found by walking the selectors."""
    first, have, i = [0], 0, 0
    selectors = (words >> np.uint64(60)).astype(np.int64).tolist()
    while i < len(words):
        s = selectors[i]
        i += 2 if s == 0 else 1
        have += int(simple8b.COUNTS[s])
        if have >= simple8b.BLOCK or i == len(words):
            first.append(i)
            have = 0
    return words, np.array(first, np.int64)


def read_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Per document of a token table: doc_id, start, n_tokens, ids_crc32 [, ids array<long>]."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, nulls, counts, ids = _documents(row)
                ends = np.cumsum(counts)
                begins = ends - counts
                plain = ids.astype("<u4")
                raw = memoryview(plain.tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
                mask = np.arange(len(keys)) < nulls
                columns = [pa.array(keys, mask=mask), pa.array(begins + row["start"]), pa.array(counts), pa.array(crc, pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int64))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return read_runs(spark, path).mapInArrow(run, schema)
