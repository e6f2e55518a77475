"""Personal data: format-preserving Feistel pseudonyms.

Validated numbers, dates and addresses are replaced by others of the same format, by a keyed
permutation of all values of that format. Equal values become equal pseudonyms in every
document and run with the same key, different values of a format become different ones, and
whoever has the key can undo it. Without a key the driver draws one at random, so that pseudonyms are
linked within one run and cannot be undone from this source.

    card    13 to 19 digits, plain or in groups, with a right Luhn digit; the new one is right too
    iban    country, two check digits that are right, 11 to 30 letters and digits
    ssn     ddd-dd-dddd outside the ranges never issued
    phone   +country and groups, or (ddd) ddd-dddd and ddd-ddd-dddd
    ip      four numbers of 0 to 255
    email   the local part and the labels of the domain but the last two are permuted
    date    a day of the calendar from 1900 to 2099, as yyyy-mm-dd, yyyy/mm/dd, dd.mm.yyyy, dd/mm/yyyy or mm/dd/yyyy

Where two kinds overlap, the earlier start counts, then the order above. As in any
permutation, single values may stay as they are, one in as many as the format has.
Null texts stay null; texts without personal data stay as they are, byte for byte.
"""

from __future__ import annotations

import datetime
import hashlib
import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborel.llm.common import fresh, held, slices

#: The key where none is given: drawn anew by every driver, so that no reader of this source can undo a pseudonym. Whoever
#: wants equal pseudonyms in several runs, or to undo them, gives a key.
KEY = os.urandom(32)
ROUNDS = 8
KINDS = ("card", "iban", "ssn", "phone", "ip", "email", "date")

# The shapes looked for, in order of precedence.
_SHAPES = (
    ("card", r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w-])(?!\.\d)"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    ("ssn", r"(?<![\w-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\w-])"),
    ("phone", r"(?<![\w+])\+\d{1,3}(?:[ .-]?\(\d{1,4}\)|(?=[ .-]?\d))(?:[ .-]?\d{2,5}){1,5}(?!\d)|(?<![\w(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])(?!\.\d)"),
    ("ip", r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w)(?!\.\d)"),
    ("email", r"@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,24}(?![A-Za-z0-9])"),  # what follows the local part
    ("date", r"(?<![\w./-])(?:(?:19|20)\d\d([-/])\d\d\1\d\d|\d\d?([./])\d\d?\2(?:19|20)\d\d)(?![\w/-])(?!\.\d)"),
)
_DIGITAL = [(k, re.compile(p, re.A)) for k, p in _SHAPES if k != "email"]
_AT_DOMAIN = re.compile(_SHAPES[5][1], re.A)
# Characters of a local part besides full stops.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_%+-"
_DIGIT_RUN = re.compile(r"\d[\d() ./-]{4}|\d{3}|[A-Z]{2}\d\d", re.A)
_DAY0 = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2100, 1, 1).toordinal() - _DAY0


def session_key(spark: SparkSession) -> bytes:
    """The key that the session names in spark.arborel.pii.key, else the driver's random one."""
    named = spark.conf.get("spark.arborel.pii.key", None)
    return named.encode() if named else KEY


def permute(value: int, size: int, tweak: str, key: bytes = KEY, back: bool = False) -> int:
    """A keyed permutation of 0..size-1: a Feistel network over the next even number of bits, walked until it is inside."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    width = (half + 7) // 8

    def turn(i: int, x: int) -> int:
        seed = f"{tweak}|{size}|{i}|{x}".encode()
        return int.from_bytes(hashlib.shake_128(key + b"|" + seed).digest(width), "big") & mask

    x = value
    while True:
        left, right = x >> half, x & mask
        if back:
            for i in reversed(range(ROUNDS)):
                left, right = right ^ turn(i, left), left
        else:
            for i in range(ROUNDS):
                left, right = right, left ^ turn(i, right)
        x = left << half | right
        if x < size:
            return x


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _fill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _shape(text: str) -> str:
    return "".join("9" if c.isdigit() else c for c in text)


def _number(text: str, kind: str, key: bytes, keep: int = 0) -> str:
    """All digits but the first ``keep`` permuted together."""
    digits = _digits(text)
    tail = digits[keep:]
    new = permute(int(tail), 10 ** len(tail), f"{kind}|{len(digits)}|{digits[:keep]}", key)
    return _fill(text, digits[:keep] + str(new).zfill(len(tail)))


def _card(text: str, key: bytes) -> str | None:
    digits = _digits(text)
    if not luhn(digits) or len(set(digits)) == 1:
        return None
    body = digits[:-1]
    new = str(permute(int(body), 10 ** len(body), f"card|{len(digits)}", key)).zfill(len(body))
    return _fill(text, new + next(c for c in "0123456789" if luhn(new + c)))


def _iban(text: str, key: bytes) -> str | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 != 1:
        return None
    body = plain[4:]
    new = _mixed(body, "iban|" + plain[:2], key)
    check = 98 - int("".join(str(int(c, 36)) for c in new + plain[:2] + "00")) % 97
    it = iter(f"{plain[:2]}{check:02d}{new}")
    return "".join(c if c == " " else next(it) for c in text)


def _mixed(text: str, tweak: str, key: bytes) -> str:
    """Letters and digits permuted together, each within its own kind; other characters stay."""
    radix = [10 if "0" <= c <= "9" else 26 if "a" <= c.lower() <= "z" else 1 for c in text]
    value, size = 0, 1
    for c, r in zip(text, radix):
        if r > 1:
            value = value * r + (ord(c) - 48 if r == 10 else ord(c.lower()) - 97)
            size *= r
    if size == 1:
        return text
    shape = "".join("9" if r == 10 else c if r == 1 else "A" if c.isupper() else "a" for c, r in zip(text, radix))
    value = permute(value, size, f"{tweak}|{shape}", key)
    out = []
    for c, r in zip(reversed(text), reversed(radix)):
        if r == 1:
            out.append(c)
            continue
        value, d = divmod(value, r)
        new = chr(48 + d) if r == 10 else chr(97 + d)
        out.append(new.upper() if c.isupper() else new)
    return "".join(reversed(out))


def _email(text: str, key: bytes) -> str:
    local, _, domain = text.rpartition("@")
    labels = domain.split(".")
    head, tail = labels[:-2], labels[-2:]
    new = _mixed(local, "email", key)
    return new + "@" + ".".join([*(_mixed(x, "domain", key) for x in head), *tail])


def _ip(text: str, key: bytes) -> str:
    value = 0
    for x in text.split("."):
        value = value << 8 | int(x)
    value = permute(value, 1 << 32, "ip", key)
    return ".".join(str(value >> s & 255) for s in (24, 16, 8, 0))


def _date(text: str, key: bytes) -> str | None:
    parts = re.split(r"([./-])", text)
    numbers, sep = parts[0::2], parts[1]
    orders = ("ymd",) if len(numbers[0]) == 4 else ("dmy", "mdy") if sep == "." else ("mdy", "dmy")
    for order in orders:
        got = dict(zip(order, map(int, numbers)))
        try:
            day = datetime.date(got["y"], got["m"], got["d"])
        except ValueError:
            continue
        new = datetime.date.fromordinal(_DAY0 + permute(day.toordinal() - _DAY0, _DAYS, "date|" + order, key))
        value = {"y": str(new.year), "m": str(new.month), "d": str(new.day)}
        return sep.join(value[o].zfill(2 if len(n) == 2 or order == "ymd" else 1) for o, n in zip(order, numbers))
    return None


def _ssn(text: str, key: bytes) -> str:
    area, group, serial = (int(x) for x in text.split("-"))
    areas = 899 - 1  # 001 to 899 without 666
    value = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    value, serial = divmod(permute(value, areas * 99 * 9999, "ssn", key), 9999)
    area, group = divmod(value, 99)
    area += 1
    return f"{area + (area >= 666):03d}-{group + 1:02d}-{serial + 1:04d}"


def _phone(text: str, key: bytes) -> str | None:
    digits = _digits(text)
    if not 7 <= len(digits) <= 15:
        return None
    country = len(re.match(r"\+?(\d*)", text)[1]) if text.startswith("+") else 0
    return _number(text, "phone|" + _shape(text), key, keep=min(country, len(digits) - 4))


_MAKE: dict[str, Callable[[str, bytes], str | None]] = {"card": _card, "iban": _iban, "ssn": _ssn, "phone": _phone, "ip": _ip, "email": _email, "date": _date}


def _cut(m: re.Match) -> int:
    """Where a phone number ends: before groups that would make it longer than 15 digits."""
    end = m.end()
    while len(_digits(m.string[m.start() : end])) > 15:
        end = max(m.string.rfind(c, m.start(), end) for c in " .-")
        if end <= m.start():
            return m.end()
    return end


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of addresses, sought from each at sign: the domain after it, the local part before it, which no
    other at sign and no address before it is part of. So no character is looked at more than a few times."""
    done = 0
    at = text.find("@")
    while at >= 0:
        before = text[done:at]
        local = before[len(before.rstrip(_LOCAL + ".")) :].rpartition("..")[2].lstrip(".")
        m = _AT_DOMAIN.match(text, at) if local and not local.endswith(".") else None
        if m:
            yield at - len(local), m.end()
        done = m.end() if m else at + 1
        at = text.find("@", done)


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of candidates by shape, in order and apart from each other."""
    found = []
    if "@" in text:
        found += [(a, 5, b, "email") for a, b in _emails(text)]
    if _DIGIT_RUN.search(text):
        for rank, (kind, shape) in enumerate(_DIGITAL):
            found += [(m.start(), rank, _cut(m) if kind == "phone" else m.end(), kind) for m in shape.finditer(text)]
    return [(a, b, k) for a, _, b, k in sorted(found)]


def pseudonymise(text: str, key: bytes = KEY) -> tuple[str, dict[str, int]]:
    """The text with pseudonyms, and how many values of each kind it had."""
    counts: dict[str, int] = {}
    out, done = [], 0
    for start, end, kind in find(text):
        if start < done:
            continue
        old = text[start:end]
        new = _MAKE[kind](old, key)
        if new is None:
            continue
        out += [text[done:start], new]
        done = end
        counts[kind] = counts.get(kind, 0) + 1
    if not out:
        return text, counts
    return "".join([*out, text[done:]]), counts


def replace_in(docs: DataFrame, key: bytes = KEY, text: str = "text", counts: bool = False) -> DataFrame:
    """``docs`` with its column ``text`` pseudonymised, all other columns as they are.

    With ``counts``, a column n_<kind> for each kind follows, with underscores in front where it is there already.
    Texts of any length are read in time that grows with their length.
    """
    columns = docs.columns
    at = columns.index(text)
    names = [fresh(docs, f"n_{k}") for k in KINDS] if counts else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None)
        for batch in batches:
            for part in slices(batch, text):
                done = [(t, {}) if t is None else pseudonymise(t, key) for t in part.column(at).to_pylist()]
                arrays = list(part.columns)
                arrays[at] = pa.array([t for t, _ in done], part.schema.field(at).type)
                arrays += [pa.array([c.get(k, 0) for _, c in done], pa.int64()) for k in KINDS[: len(names)]]
                yield pa.RecordBatch.from_arrays(arrays, columns + names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *(T.StructField(n, T.LongType()) for n in names)]))


def pseudonyms(docs: DataFrame, key: bytes = KEY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, text with pseudonyms, and n_<kind> for each kind."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return replace_in(rows, key, counts=True)
