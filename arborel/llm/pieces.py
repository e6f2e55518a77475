"""SentencePiece encoding and decoding by a batched numpy Viterbi search.

The vocabulary file is read directly. Texts are cut into units that no piece can span; every
different unit is encoded once. Units of equal length advance together, one character at a
time: hashes of all their substrings are probed in the sorted piece keys, and for every end
position a maximum over the pieces that end there gives the backpointer.

What is maximised depends on the model. In a unigram model it is the sum of scores. In a BPE
model the segmentation that greedy merging makes is the only one in which each pair of
neighbouring pieces is one that merging would leave as it is; so for each prefix there is one
last piece, and a piece counts only if it may follow the last piece of the prefix before it.
The ids are therefore those of the SentencePiece library, not an approximation.

Characters without a piece become their UTF-8 bytes where the model has byte pieces, else the
unknown id (one for each run). Null and empty texts have no ids. Decoding gives the text back,
but for U+2581, which the format cannot tell from a blank, and for unknown ids.
"""

from __future__ import annotations

import itertools
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborel.llm.common import fresh, held, mix, slices, texts_of
from arborel.llm.encoders import resolve

META = "▁"

# Types of pieces and models in the file format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2

#: Different units whose ids a worker keeps, the first it meets; others are kept for one slice of text.
CACHED_UNITS = 300_000
#: Characters of units that advance together.
BATCH_CHARS = 120_000

#: Longer units are searched one by one, in windows of so many characters.
LONG = 400
WINDOW = 50_000

_BASE = 0xBF58476D1CE4E5B9 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            yield tag >> 3, data[at : at + size]
            at += size
        else:
            size = varint()
            yield tag >> 3, data[at : at + size]
            at += size


class Vocabulary:
    """Pieces of a model file, and arrays to probe them by hash."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            data = f.read()
        self.pieces: list[str] = []
        scores, self.types = [], []
        self.kind, self.prefix, squeeze, charsmap = UNIGRAM, True, True, b""
        for number, value in _fields(data):
            if number == 1:
                got = dict(_fields(value))
                self.pieces.append(got[1].decode())
                scores.append(struct.unpack("<f", got[2])[0] if 2 in got else 0.0)
                self.types.append(got.get(3, NORMAL))
            elif number == 2:
                self.kind = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                got = dict(_fields(value))
                self.prefix, squeeze, charsmap = bool(got.get(3, 1)), bool(got.get(4, 1)), got.get(2, b"")
        if self.kind not in (UNIGRAM, BPE) or squeeze or charsmap or USER in self.types or UNUSED in self.types:
            raise ValueError("only BPE and unigram models with the identity normaliser and without user-defined or unused pieces are known")
        self.unknown = self.types.index(UNKNOWN)
        self.bytes = {int(p[1:-1], 16): i for i, (p, t) in enumerate(zip(self.pieces, self.types)) if t == BYTE}
        normal = [i for i, t in enumerate(self.types) if t == NORMAL]
        self.longest = max(len(self.pieces[i]) for i in normal)
        self.singles = {self.pieces[i] for i in normal if len(self.pieces[i]) == 1}
        if any(not set(self.pieces[i]) <= self.singles for i in normal if len(self.pieces[i]) > 1) or any(META in self.pieces[i].lstrip(META) for i in normal):
            raise ValueError("pieces with characters that are no pieces, or with inner blanks, are not known")
        # pieces are numbered by the order in which they merge, single characters first
        normal.sort(key=lambda i: (len(self.pieces[i]) > 1, -scores[i], i))
        self.ids = np.array(normal, np.int64)
        self.scores = np.array([scores[i] for i in normal])
        self.sizes = np.array([len(self.pieces[i]) for i in normal], np.int64)
        self.powers = _grown(self.longest)[0][: self.longest + 1]
        raw = np.zeros(len(normal), np.uint64)
        for k, i in enumerate(normal):
            points = np.array([ord(c) for c in self.pieces[i]], np.uint64)
            raw[k] = (mix(points + np.uint64(1)) * self.powers[: len(points)]).sum(dtype=np.uint64)
        self.raw = raw
        order = np.argsort(raw)
        self.keys, self.numbers = raw[order], order.astype(np.int32)
        if len(np.unique(raw)) != len(raw):
            raise ValueError("two pieces have one hash")
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(raw >> np.uint64(44)).astype(np.int64)] = True
        # a trained merge is later than those it is made of; the last merge of each piece parts it in two
        self.left = np.arange(len(normal), dtype=np.int32)
        self.right = self.left.copy()
        self.reached = np.ones(len(normal), bool)
        if self.kind == BPE:
            self._split([self.pieces[i] for i in normal])
        flat = [self._plain(i) for i in range(len(self.pieces))]
        self.plain_sizes = np.fromiter(map(len, flat), np.int64, len(flat))
        self.plain_starts = np.cumsum(self.plain_sizes) - self.plain_sizes
        self.plain = np.frombuffer(b"".join(flat), np.uint8)

    def _plain(self, i: int) -> bytes:
        if self.types[i] == BYTE:
            return bytes([int(self.pieces[i][1:-1], 16)])
        if self.types[i] == CONTROL:
            return b""
        if self.types[i] == UNKNOWN:
            return " ⁇ ".encode()
        return self.pieces[i].replace(META, " ").encode()

    def _split(self, pieces: list[str]) -> None:
        rank = {p: k for k, p in enumerate(pieces)}
        for k, p in enumerate(pieces):
            if len(p) == 1:
                continue
            parts = list(p)
            while len(parts) > 2:
                best = min(range(len(parts) - 1), key=lambda j: rank.get(parts[j] + parts[j + 1], len(pieces)))
                if parts[best] + parts[best + 1] not in rank:
                    break
                parts[best : best + 2] = [parts[best] + parts[best + 1]]
            if len(parts) == 2:
                self.left[k], self.right[k] = rank[parts[0]], rank[parts[1]]
            else:
                self.reached[k] = False

    def probe(self, hashes: np.ndarray) -> np.ndarray:
        """Number of the piece of each hash, -1 if there is none."""
        out = np.full(hashes.shape, -1, np.int32)
        maybe = self.sieve[(hashes >> np.uint64(44)).astype(np.int64)]
        got = hashes[maybe]
        at = np.minimum(np.searchsorted(self.keys, got), len(self.keys) - 1)
        out[maybe] = np.where(self.keys[at] == got, self.numbers[at], -1)
        return out

    def lasting(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves each pair of pieces as it is.

        The later of the two last merges is undone, step by step down to characters; the pair
        does not last if at some stage a merge across it would have come before the next one.
        """
        out = np.ones(len(a), bool)
        live = np.arange(len(a))
        a, b = a.astype(np.int64), b.astype(np.int64)
        limit = np.full(len(a), np.iinfo(np.int64).max)
        while len(live):
            joined = self.probe(self.raw[a] + self.raw[b] * self.powers[self.sizes[a]])
            broken = (joined >= 0) & (joined < limit)
            out[live[broken]] = False
            right, left = self.right[a], self.left[b]
            first = np.where(a > b, True, left == b) & (right != a)  # undo a's merge
            first |= (a > b) & (right != a)
            second = ~first & (left != b)
            on = ~broken & (first | second)
            limit = np.where(first, a, b + 1)[on]
            a, b, live = np.where(first, right, a)[on], np.where(second, left, b)[on], live[on]
        return out


class PieceEncoder:
    """Encoder of one model with the units it has met."""

    def __init__(self, path: str):
        self.vocabulary = v = Vocabulary(path)
        # characters in no piece stand alone, so texts can be cut at line ends if those are among them
        apart = "" if "\n" in v.singles else "\n"
        self.find = re.compile(f" *[^ {apart}]+| +" + ("|\n" if apart else "")).findall
        self.known = _Numbers()
        self.pool = np.empty(0, np.int32)
        self.starts, self.sizes = np.empty(0, np.int64), np.empty(0, np.int64)

    def units(self, text: str) -> list[str]:
        if not text:
            return []
        text = text.replace(META, " ")
        return self.find(" " + text if self.vocabulary.prefix else text)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of ids of each text."""
        lists = [self.units(t) for t in texts]
        had, size = len(self.known), len(self.pool)
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        at = np.fromiter(map(self.known.__getitem__, itertools.chain.from_iterable(lists)), np.int64, int(counts.sum()))
        new = self.known.new
        if new:
            self._learn()
        many = self.sizes[at]
        ends = np.cumsum(many)
        total = int(ends[-1]) if len(ends) else 0
        out = self.pool[np.arange(total) + np.repeat(self.starts[at] - (ends - many), many)]
        done = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        if had >= CACHED_UNITS:
            for u in new:
                del self.known[u]
            self.pool, self.starts, self.sizes = self.pool[:size], self.starts[:had], self.sizes[:had]
        return out, np.diff(done)

    def _learn(self) -> None:
        units, self.known.new = [u.replace(" ", META) for u in self.known.new], []
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        sizes = np.zeros(len(units), np.int64)
        order = np.argsort(lengths, kind="stable")
        found: list[np.ndarray] = []
        placed: list[np.ndarray] = []
        start = 0
        while start < len(order):
            n = int(lengths[order[start]])
            stop = int(np.searchsorted(lengths[order], n, side="right"))
            for i in range(start, stop, max(1, BATCH_CHARS // n)):
                rows = order[i : min(stop, i + max(1, BATCH_CHARS // n))]
                if n > LONG and self.vocabulary.kind == BPE:
                    got = [self.advance_long(units[r]) for r in rows.tolist()]
                    ids, many = np.concatenate(got), np.array(list(map(len, got)))
                else:
                    ids, many = self.advance([units[r] for r in rows.tolist()], n)
                sizes[rows] = many
                found.append(ids)
                placed.append(rows)
            start = stop
        base = len(self.pool)
        starts = np.zeros(len(units), np.int64)
        rows = np.concatenate(placed)
        starts[rows] = base + np.cumsum(sizes[rows]) - sizes[rows]
        self.pool = np.concatenate([self.pool, *found])
        self.starts, self.sizes = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, sizes])

    def advance(self, units: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units of n characters each, one after another, and how many each has."""
        v = self.vocabulary
        b = len(units)
        points = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(b, n)
        most = min(v.longest, n)
        powers = _grown(n)
        sums = np.zeros((b, n + 1), np.uint64)
        np.cumsum(mix(points.astype(np.uint64) + np.uint64(1)) * powers[0][:n], axis=1, out=sums[:, 1:])
        # ending[i, :, k - 1]: the piece of k characters that ends before character i
        ending = np.full((n + 1, b, most), -1, np.int32)
        for k in range(1, most + 1):
            spans = (sums[:, k:] - sums[:, :-k]) * powers[1][: n + 1 - k]
            ending[k:, :, k - 1] = v.probe(spans).T
        if not v.reached.all():
            ending[(ending >= 0) & ~v.reached[ending]] = -1
        alone = len(v.ids)  # stands for a character without a piece
        ending[1:, :, 0][ending[1:, :, 0] < 0] = alone
        last = np.full((n + 1, b), -1, np.int32)
        size = np.zeros((n + 1, b), np.int16 if most < 1 << 15 else np.int32)
        best = np.zeros((n + 1, b))
        penalty = v.scores.min() - 10.0
        values = np.append(v.scores, penalty)
        for i in range(1, n + 1):
            reach = min(most, i)
            here = ending[i, :, :reach]
            rows, ks = np.nonzero(here >= 0)
            pieces = here[rows, ks]
            if v.kind == BPE:
                before = last[i - 1 - ks, rows]
                good = np.ones(len(rows), bool)
                both = (ks < i - 1) & (before < alone) & (pieces < alone)
                good[both] = v.lasting(before[both], pieces[both])
                good &= (before >= 0) | (ks == i - 1)
                worth = np.full(here.shape, -1, np.int32)
                worth[rows[good], ks[good]] = ks[good]
            else:
                worth = np.full(here.shape, -np.inf)
                worth[rows, ks] = best[i - 1 - ks, rows] + values[pieces]
            chosen = worth.argmax(1)
            best[i] = worth[np.arange(b), chosen]
            if v.kind == BPE:
                ok = best[i] >= 0
                last[i, ok] = here[np.arange(b), chosen][ok]
            else:
                last[i] = here[np.arange(b), chosen]
            size[i] = chosen + 1
        # walk back, all units together
        marks = np.zeros((b, n + 1), bool)
        at = np.full(b, n)
        rows = np.arange(b)
        while len(rows):
            marks[rows, at[rows]] = True
            at[rows] -= size[at[rows], rows]
            rows = rows[at[rows] > 0]
        row, end = np.nonzero(marks)
        return self._ids(last[end, row], row, end, points, b)

    def advance_long(self, unit: str) -> np.ndarray:
        """Ids of one long unit. All pairs of pieces that could be neighbours are tried at once, window by
        window, so that a step of the search only looks them up."""
        v = self.vocabulary
        n, most, alone = len(unit), v.longest, len(v.ids)
        points = np.frombuffer(unit.encode("utf-32-le", "surrogatepass"), np.uint32)
        last = np.full(n + 1, -1, np.int32)
        size = np.ones(n + 1, np.int16)
        for start in range(0, n, WINDOW):
            # pieces that end in this window, and for their neighbours, those that end shortly before it
            low, high = max(0, start - 2 * most), min(n, start + WINDOW)
            part = points[low:high].astype(np.uint64)
            powers = _grown(len(part))
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(mix(part + np.uint64(1)) * powers[0][: len(part)], out=sums[1:])
            ending = np.full((len(part) + 1, most), -1, np.int32)
            for k in range(1, min(most, len(part)) + 1):
                ending[k:, k - 1] = v.probe((sums[k:] - sums[:-k]) * powers[1][: len(part) + 1 - k])
            ending[(ending >= 0) & ~v.reached[ending]] = -1
            ending[1:, 0][ending[1:, 0] < 0] = alone
            ends, ks = np.nonzero(ending >= 0)
            pieces = ending[ends, ks]
            first = np.searchsorted(ends, np.arange(len(part) + 2))
            begins = ends - ks - 1
            before = np.where(begins > 0, first[begins + 1] - first[begins], 0)
            stop = np.cumsum(before)
            a = pieces[np.arange(int(stop[-1])) + np.repeat(first[begins] - (stop - before), before)]
            b = np.repeat(pieces, before)
            pairs, back = np.unique(a.astype(np.int64) * (alone + 1) + b, return_inverse=True)
            p, q = pairs // (alone + 1), pairs % (alone + 1)
            fine = np.ones(len(pairs), bool)
            both = (p < alone) & (q < alone)
            fine[both] = v.lasting(p[both], q[both])
            fits: list[set[int]] = [set() for _ in range(len(pieces))]
            good = np.flatnonzero(fine[back])
            for c, x in zip(np.repeat(np.arange(len(pieces)), before)[good].tolist(), a[good].tolist()):
                fits[c].add(x)
            of, begin = pieces.tolist(), begins.tolist()
            for i in range(start + 1 - low, high + 1 - low):
                for c in range(int(first[i]), int(first[i + 1])):
                    j = begin[c]
                    if (j == 0 and low == 0) or (j > 0 and int(last[low + j]) in fits[c]):
                        last[low + i] = of[c]
                        size[low + i] = i - j
        marks = []
        at = n
        while at > 0:
            marks.append(at)
            at -= int(size[at])
        end = np.array(marks[::-1])
        return self._ids(last[end], np.zeros(len(end), np.int64), end, points[None, :], 1)[0]

    def _ids(self, pieces: np.ndarray, row: np.ndarray, end: np.ndarray, points: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
        v = self.vocabulary
        alone = pieces == len(v.ids)
        ids = v.ids[np.where(alone, 0, pieces)].astype(np.int32)
        if not alone.any():
            return ids, np.bincount(row, minlength=b)
        out, of = [], []
        unknown_before = (-1, -1)
        for p, r, e, a in zip(ids.tolist(), row.tolist(), end.tolist(), alone.tolist()):
            if not a:
                out.append(p)
                of.append(r)
            elif v.bytes:
                found = [v.bytes[x] for x in chr(points[r, e - 1]).encode("utf-8", "surrogatepass")]
                out += found
                of += [r] * len(found)
            else:
                if unknown_before != (r, e - 1):
                    out.append(v.unknown)
                    of.append(r)
                unknown_before = (r, e)
        return np.array(out, np.int32), np.bincount(np.array(of, np.int64), minlength=b)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of ids that stand one text after another."""
        v = self.vocabulary
        sizes = v.plain_sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        raw = v.plain[np.arange(total) + np.repeat(v.plain_starts[ids] - (ends - sizes), sizes)].tobytes()
        cuts = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        texts = [raw[a:z].decode("utf-8", "replace") for a, z in zip(cuts[:-1], cuts[1:])]
        return [t[1:] if v.prefix and t.startswith(" ") else t for t in texts]


class _Numbers(dict):
    """Unit to number; a missing one gets the next number and is noted in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        at = self[unit] = len(self)
        self.new.append(unit)
        return at


_GROWN: list[np.ndarray] = []


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the hash base and of its inverse."""
    if not _GROWN or len(_GROWN[0]) <= n:
        size = max(1024, 2 * n)
        _GROWN[:] = [np.cumprod(np.array([1] + [x] * size, np.uint64)) for x in (_BASE, _BASE_INV)]
    return _GROWN[0], _GROWN[1]


def piece_encoder(name: str) -> PieceEncoder:
    path = resolve(name)
    return held(path, lambda: PieceEncoder(path))


def encode_documents(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens and ids (array<int>) of each whole text; underscores in front where these names clash."""
    columns = docs.columns
    at = columns.index(text)
    count, ids_name = fresh(docs, "n_tokens"), fresh(docs, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_encoder(model)
        for batch in batches:
            for part in slices(batch, text):
                ids, sizes = coder.encode([t or "" for t in part.column(at).to_pylist()])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sizes, pa.int64()), lists], [*columns, count, ids_name])

    from pyspark.sql import types as T

    schema = T.StructType([*docs.schema.fields, T.StructField(count, T.LongType()), T.StructField(ids_name, T.ArrayType(T.IntegerType()))])
    return docs.mapInArrow(run, schema)


def decode_documents(docs: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text of each array of ids (null and empty: empty) in a new column."""
    columns = docs.columns
    at = columns.index(ids)
    name = fresh(docs, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_encoder(model)
        for batch in batches:
            lists = batch.column(at).fill_null(pa.scalar([], batch.column(at).type)) if batch.column(at).null_count else batch.column(at)
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(coder.decode(flat, sizes), pa.string())], [*columns, name])

    from pyspark.sql import types as T

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.StringType())]))


def digests(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids_crc32 (of the ids as little-endian 32-bit numbers), and whether decoding them gives the text back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_encoder(model)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = texts_of(part)
                ids, sizes = coder.encode(texts)
                ends = np.cumsum(sizes).tolist()
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * (e - s) : 4 * e]) for e, s in zip(ends, sizes.tolist())]
                back = [a == t for a, t in zip(coder.decode(ids, sizes), texts)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(crc, pa.int64()), pa.array(back)], ["doc_id", "n_tokens", "ids_crc32", "round_trip"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean")
