"""Shared plumbing: shared folders, bounded Arrow batches, vectorised word tables."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from arborel.operators.lineage import tables_folder

#: Text handled at once by a Python worker, in characters; a longer text is a slice of its own.
SLICE_CHARS = 1_000_000

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BASE_INV = pow(_BASE, -1, 1 << 64)


def shared_folder(spark: SparkSession) -> str:
    """This application's folder below the one that driver and executors share, ``spark.checkpoint.dir``;
    ``arborel.operators.lineage.forget`` deletes it."""
    return tables_folder(spark)


#: Bytes of an Arrow batch and of a Parquet row group of intermediate tables. Texts are large rows: Spark's
#: defaults would hold hundreds of MB a task on both sides of the pipe.
BATCH_BYTES = 8 << 20
GROUP_BYTES = 16 << 20


def tuned(spark: SparkSession) -> SparkSession:
    """The session with Arrow batches of at most ``BATCH_BYTES``, which bounds what a task of large texts holds."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read again.

    The written table cuts the lineage: an executor that is lost later does not
    cause what stands before it to run again.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("parquet.block.size", GROUP_BYTES).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it, letter case aside."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part has at most ``most`` bytes of text or one row."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = column.cast(pa.large_binary()) if pa.types.is_string(column.type) else column
    lengths = np.nan_to_num(pa.compute.binary_length(sizes).to_numpy(zero_copy_only=False).astype(float))
    ends = np.cumsum(lengths)
    start = 0
    while start < len(lengths):
        base = ends[start - 1] if start else 0.0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
    trim()


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library
    _trim = None


def trim() -> None:
    """Give memory that arrays have left back to the system; the allocators would keep it for the worker's life."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


_HELD: list[tuple[object, object]] = []


def held(key: object, make: Callable[[], object] | None = None) -> object:
    """What ``make`` builds for ``key``, kept in the worker until another key is asked for.

    So a worker that goes on to another operator does not carry the last one's tables along.
    """
    if _HELD and _HELD[0][0] == key:
        return _HELD[0][1]
    _HELD.clear()
    trim()
    if make is not None:
        _HELD.append((key, make()))
        return _HELD[0][1]
    return None


def blobs(column: pa.Array) -> list[memoryview]:
    """The values of a binary column without nulls, not copied."""
    if not len(column):
        return []
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].tolist()
    view = memoryview(data) if data is not None else memoryview(b"")
    return [view[a:b] for a, b in zip(at[:-1], at[1:])]


def over_texts(fn: Callable[[pa.RecordBatch], pa.RecordBatch], text: str = "text") -> Callable:
    """A ``mapInArrow`` function that applies ``fn`` to slices of bounded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                yield fn(part)

    return run


def texts_of(batch: pa.RecordBatch, text: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n - 1) modulo 2**64; those for usual slices are kept."""
    kept = _POWERS.get(base)
    if kept is not None and len(kept) >= n:
        return kept[:n]
    out = np.empty(1 << max(n - 1, 1).bit_length(), np.uint64)
    out[0] = 1
    done, step = 1, base & _MASK
    while done < len(out):
        out[done : 2 * done] = out[:done] * np.uint64(step)
        done *= 2
        step = step * step & _MASK
    if len(out) <= 4 * SLICE_CHARS:
        _POWERS[base] = out
    return out[:n]


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of some texts, as arrays over all of them.

    hashes: 64-bit hash of each word; first: index of each text's first word, with
    one more entry at the end; raw, starts, ends: UTF-8 bytes and the words' places there;
    offsets: where each text begins in raw (one space stands between texts).
    """

    def __init__(self, texts: list[str], lower: bool = False):
        parts = [t.encode("utf-8", "surrogatepass") for t in texts]
        raw = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
        self.raw = raw
        self.offsets = np.zeros(len(parts) + 1, np.int64)
        np.cumsum([len(p) + 1 for p in parts], out=self.offsets[1:])
        if not parts:
            raw = raw[:0]
        space = _SPACE[raw]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if len(raw) and not space[0]:
            edge = np.concatenate([[0], edge])
        self.starts, self.ends = edge[0::2], edge[1::2]
        self.first = np.searchsorted(self.starts, self.offsets)
        values = (_LOWER[raw] if lower else raw).astype(np.uint64) + np.uint64(1)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(values * _powers(_BASE, len(raw)), out=sums[1:])
        undo = _powers(_BASE_INV, len(raw) + 1)
        self.hashes = mix((sums[self.ends] - sums[self.starts]) * undo[self.starts] + (self.ends - self.starts).astype(np.uint64))

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the windows of n words, and the index of each text's first window (one more at the end)."""
        h = self.hashes
        count = np.maximum(np.diff(self.first) - (n - 1), 0)
        first = np.zeros(len(count) + 1, np.int64)
        np.cumsum(count, out=first[1:])
        if not first[-1]:
            return np.empty(0, np.uint64), first
        at = np.arange(first[-1]) + np.repeat(self.first[:-1] - first[:-1], count)
        out = np.zeros(len(at), np.uint64)
        for k in range(n):
            out = mix(out * np.uint64(0xD6E8FEB86659FD93) + h[at + k] + np.uint64(k))
        return out, first
