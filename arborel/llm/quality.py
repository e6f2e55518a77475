"""Quality rules, the last of them a band of n-gram perplexity for each language.

The model is a modified Kneser-Ney model of GRAM = 6 characters as they are (letter case, marks and
signs count; a character is hashed to ten bits), one for each value of the language column. N-grams are
counted over all documents in Spark, and the probabilities are tables that grow with the corpus: nothing of
them is gathered whole. For scoring, the HEAD most frequent n-grams are a sorted hash array of bounded size that every
task has, which most characters find their n-gram in; the n-grams of all others are joined with the table.

A model of open size knows by heart what it was trained on, so documents are dealt into two halves and
each is scored by the counts of the other half. The half follows from the text alone (the least hash of
its five-word shingles), so that copies and most near copies fall into one.

A document is scored by its bits for each letter or digit, so that signs and blanks, however well the model
foresees them, make it dearer than plain words. Each language's band lies around the median of
its documents, so many quartile widths below and above; documents outside it are rejected.

Null and empty texts have no words and fail the base rule. Rows whose language is null are one more
language. Rows that repeat are judged each; extra columns pass through ``filter_documents`` unchanged.

``codes_of``, ``count_ngrams``, ``fit`` and ``Model`` are the small model of four folded characters, for
callers that need one of bounded size; the queries do not use it.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborel.llm.common import Words, fresh, held, mix, slices, stored, texts_of

LANGUAGES = ("en", "de", "fr", "es")

CLASSES = 32
ORDER = 4
CODES = CLASSES**ORDER

#: Characters of an n-gram of the model that documents are scored with, and bits of a character's hash.
GRAM = 6
BITS = 10
#: Different n-grams that a task holds before it sends its sums on, and new ones of a language before it adds them to its sums.
HELD = 1 << 22
NEW = 1 << 19
#: Most frequent n-grams that every task has, at 16 bytes each; others are joined.
HEAD = 1 << 20

#: Bits a letter are counted in bins of this width to find medians and quartiles.
BIN = 0.005
#: Documents with fewer words say little about their language's usual perplexity.
LEAST_WORDS = 50


@dataclass(frozen=True)
class Rules:
    """Parameters: below_widths and above_widths are the band's reach in quartile widths.

    A mean over few characters spreads more, so the reach grows as the square root of
    usual_chars / characters in shorter texts. Both reaches are set from labelled rows: those far below are near copies
    of others, which are not for this rule to judge, so the reach below is wide. Above, few of
    quality 1 lie higher, wrong-language and shuffled documents mostly do. A width that n documents
    give has an error that falls as the square root of n, so it counts (1 + 13 / sqrt(n)) times above.
    """

    languages: tuple[str, ...] = LANGUAGES
    least_words: int = LEAST_WORDS
    most_repeated: int = 50  # percent of words
    below_widths: float = 6.0
    above_widths: float = 2.5
    usual_chars: int = 1500
    least_width: float = 0.02  # a band's quartile width counts as this at least, in bits


def _classes() -> np.ndarray:
    """Class by code point below 0x250: 0 white space, 1-26 letters without their marks, 27 other
    letters, 28 digits, 29 full stop and comma, 30 other punctuation, 31 symbols and the rest."""
    out = np.full(0x250, 31, np.uint8)
    for c in range(0x250):
        ch = chr(c)
        base = unicodedata.normalize("NFD", ch)[0].lower()
        kind = unicodedata.category(ch)
        if ch.isspace():
            out[c] = 0
        elif "a" <= base <= "z":
            out[c] = ord(base) - 96
        elif kind[0] == "L":
            out[c] = 27
        elif kind[0] == "N":
            out[c] = 28
        elif ch in ".,":
            out[c] = 29
        elif kind[0] == "P":
            out[c] = 30
    return out


_CLASS = _classes()


def codes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The 4-gram code that ends at each character of each text, and each text's first (one more at the end).

    Three blanks stand before every text.
    """
    lead = " " * (ORDER - 1)
    points = np.frombuffer((lead + lead.join(texts) if texts else "").encode("utf-32-le", "surrogatepass"), np.uint32)
    classes = _CLASS[np.minimum(points, 0x24F)].astype(np.uint32)
    far = points > 0x24F
    if far.any():
        classes[far] = np.where((points[far] >= 0x2000) & (points[far] < 0x2070), 30, np.where((points[far] >= 0x20A0) & (points[far] < 0x2C00), 31, 27))
    codes = classes.copy()
    for k in range(1, ORDER):
        codes[k:] |= classes[:-k] << np.uint32(5 * k)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    keep = np.ones(len(points), bool)
    begins = np.cumsum(sizes + ORDER - 1) - sizes
    for k in range(1, ORDER):
        keep[begins - k] = False
    first = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(sizes, out=first[1:])
    return codes[keep], first


def _language(batch: pa.RecordBatch, column: int, languages: tuple[str, ...]) -> np.ndarray:
    """Index of each row's language; the rest is the last."""
    at = {x: i for i, x in enumerate(languages)}
    return np.array([at.get(x, len(languages)) for x in batch.column(column).to_pylist()], np.int64)


def count_ngrams(docs: DataFrame, rules: Rules, text: str = "text", lang: str = "lang") -> DataFrame:
    """(language, code, n) of all whole texts: each task sums its own, Spark sums over tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None)
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                codes, first = codes_of(texts_of(part))
                of = np.repeat(_language(part, 1, rules.languages), np.diff(first))
                for k in np.unique(of).tolist():
                    found = np.bincount(codes[of == k], minlength=CODES)
                    counts[k] = counts[k] + found if k in counts else found
        for k, found in counts.items():
            seen = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(seen), k, np.int32)), pa.array(seen.astype(np.int32)), pa.array(found[seen].astype(np.int64))], ["language", "code", "n"])

    rows = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    return rows.mapInArrow(run, "language int, code int, n long").groupBy("language", "code").agg(F.sum("n").alias("n"))


def _discounts(counts: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2 and 3 or more."""
    n = [float((counts == k).sum()) for k in (1, 2, 3, 4)]
    if n[0] == 0 or n[1] == 0:
        return np.array([0.0, 0.5, 0.75, 0.9])
    y = n[0] / (n[0] + 2 * n[1])
    d = [k + 1 - (k + 2) * y * (n[k + 1] / n[k] if n[k] else 0.0) for k in range(3)]
    return np.array([0.0, *(min(max(x, 0.1), k + 0.95) for k, x in enumerate(d))])


def _smoothed(counts: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Probability of every code given its context, from counts of all codes and the lower order's probabilities."""
    d = _discounts(counts)
    table = counts.reshape(-1, CLASSES).astype(float)
    cut = d[np.minimum(counts, 3)].reshape(-1, CLASSES)
    total = table.sum(1, keepdims=True)
    below = np.tile(lower.reshape(-1, CLASSES), (len(table) // (len(lower) // CLASSES), 1))
    safe = np.where(total > 0, total, 1.0)
    return np.where(total > 0, (table - cut) / safe + cut.sum(1, keepdims=True) / safe * below, below).reshape(-1)


@dataclass
class Model:
    """Of each language: sorted codes that occur, their log2 probabilities, and those of the next lower order."""

    rules: Rules
    keys: list[np.ndarray] = field(default_factory=list)
    bits: list[np.ndarray] = field(default_factory=list)
    context: list[np.ndarray] = field(default_factory=list)  # log2 of what an unseen code's context leaves it
    lower: list[np.ndarray] = field(default_factory=list)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_table"}

    def table(self) -> np.ndarray:
        """log2 probability by language and code, spread out once in each worker: all codes are looked
        up in the sorted keys together; those that are missing get their context's share of the lower order."""
        if "_table" not in self.__dict__:
            codes = np.arange(CODES)
            rows = []
            for keys, bits, context, lower in zip(self.keys, self.bits, self.context, self.lower):
                row = context[codes >> 5] + lower[codes & (CODES // CLASSES - 1)]
                at = np.searchsorted(keys, codes)
                found = np.zeros(CODES, bool)
                inside = at < len(keys)
                found[inside] = keys[at[inside]] == codes[inside]
                row[found] = bits[at[found]]
                rows.append(row)
            self._table = np.concatenate(rows)
        return self._table

    def bits_per_character(self, texts: list[str], languages: np.ndarray) -> np.ndarray:
        """Of each text; 0 for an empty one."""
        codes, first = codes_of(texts)
        sizes = np.diff(first)
        logs = self.table()[codes + np.repeat((languages * CODES).astype(np.uint32), sizes)]
        full = np.flatnonzero(sizes)
        out = np.zeros(len(texts))
        if len(full):
            out[full] = -np.add.reduceat(logs, first[full], dtype=np.float64) / sizes[full]
        return out


def fit(counts: DataFrame, rules: Rules) -> Model:
    """The model from the counts of ``count_ngrams``, of which there are a bounded number."""
    found = counts.toArrow()
    language, code, n = (found.column(c).to_numpy() for c in ("language", "code", "n"))
    model = Model(rules)
    for k in range(len(rules.languages) + 1):
        mine = language == k
        table = np.zeros(CODES, np.int64)
        table[code[mine]] = n[mine]
        # counts of lower orders: different codes of the next order that end in them
        orders = [table]
        for order in range(ORDER - 1, 0, -1):
            orders.append((orders[-1] > 0).reshape(CLASSES, CLASSES**order).sum(0))
        p = np.full(CLASSES, 1.0 / CLASSES)
        for size in reversed(orders[1:]):
            p = _smoothed(size, p)
        top = _smoothed(table, p)
        keys = np.flatnonzero(table)
        d = _discounts(table)[np.minimum(table, 3)].reshape(-1, CLASSES).sum(1)
        total = table.reshape(-1, CLASSES).sum(1)
        model.keys.append(keys.astype(np.int32))
        model.bits.append(np.log2(top[keys]).astype(np.float32))
        model.context.append(np.log2(np.where(total > 0, d / np.maximum(total, 1), 1.0).clip(1e-9)).astype(np.float32))
        model.lower.append(np.log2(p).astype(np.float32))
    return model


def grams_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The GRAM-character code that ends at each character of each text, and each text's length. Line feeds stand before every text."""
    lead = "\n" * (GRAM - 1)
    points = np.frombuffer((lead + lead.join(texts) if texts else "").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    chars = np.where(points < 768, points, 768 + points % 256)
    codes = chars.copy()
    for k in range(1, GRAM):
        codes[k:] |= chars[:-k] << (BITS * k)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    keep = np.ones(len(points), bool)
    begins = np.cumsum(sizes + GRAM - 1) - sizes
    for k in range(1, GRAM):
        keep[begins - k] = False
    return codes[keep], sizes


_LETTER: list[np.ndarray] = []


def letters_of(texts: list[str]) -> np.ndarray:
    """Letters, digits and the marks on them in each text."""
    if not _LETTER:
        _LETTER.append(np.fromiter((c.isalnum() or unicodedata.category(c)[0] == "M" for c in map(chr, range(0x110000))), bool, 0x110000))
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sums = np.concatenate([[0], np.cumsum(_LETTER[0][points])])
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    return np.diff(sums[ends], prepend=0)


def halves_of(words: Words) -> np.ndarray:
    """0 or 1 for each text: a bit of the least hash of its five-word shingles, or of its words if it has fewer."""
    out = np.zeros(len(words.first) - 1, np.int64)
    for hashes, first in ((words.hashes, words.first), words.windows(5)):
        full = np.flatnonzero(np.diff(first))
        if len(full):
            out[full] = np.minimum.reduceat(mix(hashes), first[full]) & np.uint64(1)
    return out


def _rows(docs: DataFrame, doc_id: str, text: str, lang: str) -> DataFrame:
    body = F.col(text).cast("string")
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("text"), F.xxhash64(F.col(lang).cast("string")).alias("language"), F.unhex(F.md5(body)).alias("key"))


def _planes(values: np.ndarray) -> bytes:
    """Whole numbers byte plane by byte plane, which compresses better than number by number."""
    return pa.compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes(), codec="zstd", asbytes=True)


def _from_planes(blob: bytes, size: int) -> np.ndarray:
    raw = pa.decompress(blob, decompressed_size=size * 8, codec="zstd")
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, size).T).view(np.int64).ravel()


class _Counts:
    """Sorted n-grams with their counts in each half, summed whenever NEW more have come."""

    def __init__(self):
        self.codes, self.n = np.empty(0, np.int64), np.empty((0, 2), np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, codes: np.ndarray, n: np.ndarray) -> None:
        self.waiting.append((codes, n))
        self.size += len(codes)
        if self.size >= max(NEW, len(self.codes) // 2):
            self.fold()

    def add_texts(self, codes: np.ndarray, halves: np.ndarray) -> None:
        """One occurrence of each code; sorted with the half in the lowest bit."""
        found = np.sort(codes << 1 | halves)
        first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else np.empty(0, np.int64)
        times, second = np.diff(first, append=len(found)), found[first] & 1
        self.add(found[first] >> 1, np.stack([times * (1 - second), times * second], 1))

    def fold(self) -> None:
        if self.waiting:
            codes = np.concatenate([self.codes, *(c for c, _ in self.waiting)])
            order = np.argsort(codes, kind="stable")
            codes = codes[order]
            first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.empty(0, np.int64)
            n = np.concatenate([self.n, *(n for _, n in self.waiting)])[order]
            self.codes, self.n = codes[first], np.add.reduceat(n, first) if len(first) else n
        self.waiting, self.size = [], 0


def count_grams(rows: DataFrame) -> DataFrame:
    """(language, code, n0, n1): occurrences in all whole texts of each half.

    Each task sums its own; its sums go, packed and sorted, to the parts that sum over tasks.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None)
        counts: dict[int, _Counts] = {}

        def packed() -> Iterator[pa.RecordBatch]:
            for k, table in counts.items():
                table.fold()
                of = (mix(table.codes.astype(np.uint64)) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
                order = np.argsort(of, kind="stable")
                cuts = np.searchsorted(of[order], np.arange(parts + 1, dtype=np.uint64)).tolist()
                out = []
                for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                    if b > a:
                        codes, n = table.codes[order[a:b]], table.n[order[a:b]]
                        out.append((i, k, b - a, _planes(np.diff(codes, prepend=0)), _planes(n.ravel())))
                if out:
                    types = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["part", "language", "size", "codes", "n"])
            counts.clear()

        for batch in batches:
            for part in slices(batch, "text"):
                texts = texts_of(part)
                codes, sizes = grams_of(texts)
                halves = np.repeat(halves_of(Words(texts)), sizes)
                languages = part.column(1).to_numpy()
                of = np.repeat(languages, sizes)
                for k in np.unique(languages).tolist():
                    mine = of == k
                    counts.setdefault(k, _Counts()).add_texts(codes[mine], halves[mine])
            if sum(len(c.codes) for c in counts.values()) >= HELD:
                yield from packed()
        yield from packed()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None)
        counts: dict[int, _Counts] = {}
        for batch in batches:
            for k, size, codes, n in zip(*(c.to_pylist() for c in batch.columns[1:])):
                deltas = _from_planes(codes, size)
                counts.setdefault(k, _Counts()).add(np.cumsum(deltas), _from_planes(n, 2 * size).reshape(-1, 2))
        for k, table in counts.items():
            table.fold()
            for i in range(0, len(table.codes), 1 << 16):
                codes, n = table.codes[i : i + (1 << 16)], table.n[i : i + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), k, np.int64)), pa.array(codes), pa.array(n[:, 0]), pa.array(n[:, 1])], ["language", "code", "n0", "n1"])

    packed = rows.select("text", "language").mapInArrow(run, "part int, language long, size long, codes binary, n binary")
    return packed.repartition(parts, "part").mapInArrow(merge, "language long, code long, n0 long, n1 long")


#: Orders that are smoothed together: n-grams are dealt by the characters before their last that all these orders have,
#: so that their contexts and what they are continued by meet in one place without further shuffles.
SPANS = ((6, 4), (3, 2), (1, 1))


def _suffix(code: str | Column, order: int) -> Column:
    return (F.col(code) if isinstance(code, str) else code).bitwiseAND((1 << BITS * order) - 1)


def _levels(top: DataFrame, high: int, low: int) -> DataFrame:
    """``top`` (language, code, n0, n1 of order ``high``) with s{k} and n{k}{half}, for k from high to low: the suffix of that
    order and how many different n-grams of the next order end in it; first{k} marks one row of each suffix."""
    more = [c for c in ("p0", "p1") if c in top.columns]
    rows = top.select("language", F.shiftright(_suffix("code", low), BITS).alias("at"), F.col("code").alias(f"s{high}"), *(F.col(f"n{h}").alias(f"n{high}{h}") for h in (0, 1)), F.lit(True).alias(f"first{high}"), *more)
    rows = rows.repartition("language", "at") if low > 1 else rows.repartition("language")
    for k in range(high - 1, low - 1, -1):
        rows = rows.withColumn(f"s{k}", _suffix(f"s{k + 1}", k))
        same = Window.partitionBy("language", "at", f"s{k}")
        # one row of each suffix of the order above stands first, so that it counts once
        rows = rows.withColumns(
            {f"n{k}{h}": F.count_if(F.col(f"first{k + 1}") & (F.col(f"n{k + 1}{h}") > 0)).over(same) for h in (0, 1)} | {f"first{k}": F.row_number().over(same.orderBy(f"s{high}")) == 1}
        )
    return rows


def _lower(levels: DataFrame, low: int) -> DataFrame:
    """The order below ``low``: (language, code, n0, n1), counted as different n-grams that end in it."""
    rows = levels.filter(f"first{low}").groupBy("language", _suffix(f"s{low}", low - 1).alias("code"))
    return rows.agg(*(F.count_if(F.col(f"n{low}{h}") > 0).alias(f"n{h}") for h in (0, 1)))


def _cuts(levels: DataFrame, high: int, low: int) -> DataFrame:
    """Modified Kneser-Ney discounts d{order}{half}{count} of each language, as ``_discounts`` has them."""
    orders = [(k, h) for k in range(high, low - 1, -1) for h in (0, 1)]
    n = levels.groupBy("language").agg(*(F.count_if(F.col(f"first{k}") & (F.col(f"n{k}{h}") == c)).cast("double").alias(f"c{k}{h}{c}") for k, h in orders for c in (1, 2, 3, 4)))
    out = []
    for k, h in orders:
        c = [F.col(f"c{k}{h}{x}") for x in (1, 2, 3, 4)]
        few = (c[0] == 0) | (c[1] == 0)
        y = c[0] / (c[0] + 2 * c[1])
        for x, usual in enumerate((0.5, 0.75, 0.9)):
            d = x + 1 - (x + 2) * y * F.when(c[x] > 0, c[x + 1] / c[x]).otherwise(0.0)
            out.append(F.when(few, usual).otherwise(F.least(F.greatest(d, F.lit(0.1)), F.lit(x + 0.95))).alias(f"d{k}{h}{x + 1}"))
    return n.select("language", *out)


def _smoothed_levels(levels: DataFrame, cuts: DataFrame, high: int, low: int) -> DataFrame:
    """(language, code, n, p0, p1) of order ``high``, from p0 and p1 of the order under ``low`` that ``levels`` has."""
    rows = levels.join(cuts, "language")
    for k in range(low, high + 1):
        context = Window.partitionBy("language", "at", F.shiftright(f"s{k}", BITS))
        found = {}
        for h in (0, 1):
            n = F.col(f"n{k}{h}")
            cut = F.when(n == 0, 0.0).when(n == 1, F.col(f"d{k}{h}1")).when(n == 2, F.col(f"d{k}{h}2")).otherwise(F.col(f"d{k}{h}3"))
            total = F.sum(F.when(F.col(f"first{k}"), n)).over(context)
            left = F.sum(F.when(F.col(f"first{k}"), cut)).over(context)
            found[f"p{h}"] = F.when(total > 0, (n - cut + left * F.col(f"p{h}")) / total).otherwise(F.col(f"p{h}"))
        rows = rows.withColumns(found)
    return rows.select("language", F.col(f"s{high}").alias("code"), (F.col(f"n{high}0") + F.col(f"n{high}1")).alias("n"), "p0", "p1")


def probabilities(counts: DataFrame) -> DataFrame:
    """(language, code, n, p0, p1) of every n-gram of ``counts``: all occurrences, and the probability by either half's counts.

    N-grams that a half does not have get its lower orders' share; rows of count 0 change nothing else.
    """
    tops = [counts]
    for high, low in SPANS[:-1]:
        tops.append(stored(_lower(_levels(tops[-1], high, low), low), "grams"))
    below = None
    for top, (high, low) in zip(reversed(tops), reversed(SPANS)):
        cuts = stored(_cuts(_levels(top, high, low), high, low), "discounts")
        if below is None:
            top = top.withColumns({f"p{h}": F.lit(2.0**-BITS) for h in (0, 1)})
        else:
            under = below.select("language", F.col("code").alias("shorter"), "p0", "p1")
            top = top.withColumn("shorter", _suffix("code", low - 1)).join(under, ["language", "shorter"])
        below = stored(_smoothed_levels(_levels(top, high, low), cuts, high, low), "probabilities")
    return below


def _hashes(codes: np.ndarray, languages: np.ndarray | int) -> np.ndarray:
    return mix(codes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + mix(np.asarray(languages, np.int64).astype(np.uint64)))


def _head(table: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """The most frequent n-grams, HEAD at most: the least count of those, their hashes in order, and log2 of their probabilities."""
    size = F.least(F.length(F.bin("n")), F.lit(62))  # counts by their number of bits
    sizes = {r[0]: r[1] for r in table.groupBy(size.alias("size")).count().collect()}
    least, n = 62, 0
    while least > 0 and n + sizes.get(least, 0) <= HEAD:
        n += sizes.get(least, 0)
        least -= 1
    found = table.filter(F.col("n") >= 1 << least if least else F.lit(True)).select("language", "code", "p0", "p1").toArrow()
    keys = _hashes(found.column("code").to_numpy(), found.column("language").to_numpy())
    order = np.argsort(keys)
    logs = np.log2(np.stack([found.column("p0").to_numpy(), found.column("p1").to_numpy()], 1)).astype(np.float32)
    return (1 << least if least else 0), keys[order], logs[order]


_KNOWN = {"doc_id": "long", "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long", "chars": "long", "letters": "long", "language": "long", "key": "binary"}


def score(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Per row: its base counts, length, language, key and bits a letter by the other half's model.

    The most frequent n-grams are a sorted hash array of bounded size that every task has; all others are looked up by a join,
    in which no n-gram is frequent.
    """
    least, keys, logs = _head(table)
    shared = rows.sparkSession.sparkContext.broadcast((keys, logs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, logs = held(None) or shared.value
        keys = np.append(keys, np.uint64(0xFFFFFFFFFFFFFFFF))
        logs = np.append(logs, np.zeros((1, 2), np.float32), 0)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = texts_of(part)
                words = Words(texts)
                halves = halves_of(words)
                counts = base_counts(texts, words)
                codes, sizes = grams_of(texts)
                language = part.column(2).to_numpy()
                hashes = _hashes(codes, np.repeat(language, sizes))
                order = np.argsort(hashes)
                at = np.empty(len(hashes), np.int64)
                at[order] = np.searchsorted(keys, hashes[order])
                known = keys[at] == hashes
                of = np.repeat(np.arange(len(texts)), sizes)
                sums = np.bincount(of[known], logs[at[known], 1 - halves[of[known]]], len(texts)).astype(float)
                rare = np.flatnonzero(~known)
                ends = np.searchsorted(of[rare], np.arange(len(texts) + 1))
                tail = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(codes[rare]))
                columns = [part.column(0), *(pa.array(c.astype(np.int64)) for c in counts), pa.array(sizes), pa.array(letters_of(texts)), part.column(2), part.column(3)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(halves), pa.array(sums), tail], [*_KNOWN, "half", "logs", "tail"])

    types = ", ".join(f"{k} {v}" for k, v in _KNOWN.items())
    found = rows.mapInArrow(run, f"{types}, half long, logs double, tail array<long>").withColumn("row", F.monotonically_increasing_id())
    found = stored(found, "scored")
    shared.unpersist()
    rare = found.select("row", "language", "half", F.explode("tail").alias("code"))
    other = F.when(F.col("half") == 0, F.col("p1")).otherwise(F.col("p0"))
    sums = rare.join(table.filter(F.col("n") < least), ["language", "code"]).groupBy("row").agg(F.sum(F.log2(other)).alias("rare"))
    bits = -(F.col("logs") + F.coalesce("rare", F.lit(0.0))) / F.greatest("letters", F.lit(1))
    return found.join(sums, "row", "left").select(*_KNOWN, bits.alias("bits_per_letter"))


@dataclass
class Trained:
    """What ``train`` leaves: tables of counts, scores of the documents trained on, and each language's band."""

    rules: Rules
    docs: DataFrame
    columns: tuple[str, str]
    counts: DataFrame
    scores: DataFrame
    bands: DataFrame


def train(docs: DataFrame, rules: Rules = Rules(), text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Trained:
    rows = _rows(docs, doc_id, text, lang)
    counts = stored(count_grams(rows), "counts")
    scores = stored(score(rows, probabilities(counts)), "scores")
    usual = scores.filter(F.col("n_words") >= rules.least_words).withColumn("bin", F.floor(F.col("bits_per_letter") / BIN) * BIN)
    bands = usual.groupBy("language").agg(F.percentile("bin", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"), F.count(F.lit(1)).alias("n"))
    width = F.greatest(F.col("q")[2] - F.col("q")[0], F.lit(rules.least_width))
    bands = bands.select("language", F.col("q")[1].alias("middle"), width.alias("width"), (1 + 13 / F.sqrt("n")).alias("unsure"))
    return Trained(rules, docs, (doc_id, text, lang), counts, scores, stored(bands, "bands"))


_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_BLANKS = " \t\n\v\f\r"
#: Bytes that begin a code point of a word.
_IN_WORD = (np.arange(256) & 0xC0) != 0x80
_IN_WORD[[ord(c) for c in _BLANKS]] = False
_BLANK = np.zeros(256, bool)
_BLANK[[ord(c) for c in _BLANKS]] = True


def count_words(texts: list[str]) -> np.ndarray:
    """Words of each text."""
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b" " + b" ".join(parts) + b" ", np.uint8)
    begins = np.flatnonzero(_BLANK[raw[:-1]] & ~_BLANK[raw[1:]])
    offsets = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=offsets[1:])
    return np.diff(np.searchsorted(begins, offsets))


def base_counts(texts: list[str], words: Words | None = None) -> tuple[np.ndarray, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    words = words or Words(texts)
    n_words = np.diff(words.first)
    raw, offsets = words.raw, words.offsets
    sums = np.concatenate([[0], np.cumsum(_IN_WORD[raw])])
    word_chars = sums[offsets[1:] - 1] - sums[offsets[:-1]] if len(texts) else np.empty(0, np.int64)
    sums = np.concatenate([[0], np.cumsum(_SYMBOL[raw])])
    n_symbols = sums[offsets[1:] - 1] - sums[offsets[:-1]] if len(texts) else np.empty(0, np.int64)
    dup = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        if "\n" in t:
            lines = [x for x in t.split("\n") if x.strip(_BLANKS)]
            dup[i] = len(lines) - len(set(lines))
    windows, first = words.windows(3)
    count = np.diff(first)
    of = np.repeat(np.arange(len(texts)), count)
    keys = mix(windows + of.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    same = np.zeros(len(keys), bool)
    if len(twice):
        same = twice[np.minimum(np.searchsorted(twice, keys), len(twice) - 1)] == keys
    covered = np.zeros(len(words.hashes) + 3, bool)
    at = np.flatnonzero(same)
    at = at - first[of[at]] + words.first[of[at]]
    for k in range(3):
        covered[at + k] = True
    sums = np.concatenate([[0], np.cumsum(covered)])
    n_repeat = sums[words.first[1:]] - sums[words.first[:-1]]
    return n_words, word_chars, n_symbols, dup, n_repeat


VERDICT = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long", "base_failed": "boolean", "bits_per_letter": "double", "kept": "boolean"}


def _verdicts(docs: DataFrame, model: Trained, doc_id: str, text: str, lang: str) -> DataFrame:
    rules, scores = model.rules, model.scores
    if docs is not model.docs or (doc_id, text, lang) != model.columns:
        rows = _rows(docs, doc_id, text, lang)
        none = [F.lit(0).cast("long").alias(n) for n in ("n0", "n1")]
        both = model.counts.unionByName(count_grams(rows).select("language", "code", *none))
        counts = stored(both.groupBy("language", "code").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "counts")
        scores = score(rows, probabilities(counts))
    failed = (F.col("n_words") < rules.least_words) | (100 * F.col("n_repeat_words") > rules.most_repeated * F.col("n_words"))
    reach = F.col("width") * F.sqrt(F.greatest(F.lit(1.0), rules.usual_chars / F.greatest(F.col("chars"), F.lit(1))))
    above = (F.col("bits_per_letter") - F.col("middle")) / reach
    inside = F.coalesce(above.between(-rules.below_widths, rules.above_widths * F.col("unsure")), F.lit(True))
    return scores.join(model.bands, "language", "left").withColumns({"base_failed": failed, "kept": ~failed & inside})


def judge(docs: DataFrame, model: Trained, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per row: doc_id, the base counts, base_failed, bits_per_letter and kept."""
    return _verdicts(docs, model, doc_id, text, lang).select("doc_id", *VERDICT)


def filter_documents(docs: DataFrame, model: Trained, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; the verdict follows from language and text."""
    key, of = fresh(docs, "key"), fresh(docs, "language")
    kept = _verdicts(docs, model, doc_id, text, lang).filter("kept").select(F.col("key").alias(key), F.col("language").alias(of)).distinct()
    rows = docs.withColumns({key: F.unhex(F.md5(F.col(text).cast("string"))), of: F.xxhash64(F.col(lang).cast("string"))})
    return rows.join(kept, [key, of], "left_semi").select(docs.columns)


def quality(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    return judge(docs, train(docs, rules))
