"""Secret scans: fixed patterns, and credential values that are costly to guess.

Base spans (assign, access, hex) come from patterns. In credential contexts the method
looks at the whole value that stands there and finds the cheapest way to guess it, by
dynamic programming over its cuts into words, dates, repeats, keyboard walks, runs and
brute-force spans; values that cost more than a bound are spans of the kind ``guess``,
unless a base span already covers them.
"""

from __future__ import annotations

import hashlib
import json
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborel.llm.common import held, over_texts, texts_of
from arborel.llm.encoders import resolve

# The patterns of the base kinds, in the order in which equal starts are listed.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "guess")

# What a credential context looks like besides the base pattern.
_NAMES = r"pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|client[_-]?secret|credentials?|auth(?:orization)?|bearer"
_CONTEXT = re.compile(rf"(?<![a-z])(?:{_NAMES})(?:[\"']?\x20*(?::=|=>|[:=]|>)\x20*(?:bearer\x20|basic\x20)?|\x20(?=--?[a-z]))(?:\"([^\"\n]+)\"|'([^'\n]+)'|([^\s\"'<>,;]+))", re.I | re.A)

# Frequent passwords and words, most frequent first; the rank is the guess count.
WORDS = """password 123456 qwerty abc letmein monkey dragon iloveyou admin welcome login princess master hello freedom
whatever shadow sunshine football baseball superman batman trustno hunter killer pepper jordan michael ashley jessica
charlie secret summer winter spring autumn monday tuesday wednesday thursday friday saturday sunday january february
march april june july august september october november december love test user root guest changeme default server
database backup office company internet computer windows apple google orange cheese coffee cookie flower silver golden
purple yellow green black white blue red dog cat house world money power magic music star tiger lion eagle wolf the and
for you with this that have from your pass word key token null none true false example sample demo temp xxxx
are was not but all can had her his one our out day get has him how man new now old see two way who boy did its let put say she too
use about after again also always another any back because been before being between both came come could does down each even
every first found give good great here home into just know large last left life like line little long look made make many may
might more most much must name never next only other over own part people place right said same should show small some still
such take tell than their them then there these they thing think those three through time under until upon very want water well
went were what when where which while will work would write year years required optional missing invalid expired disabled enabled
unknown undefined empty provided generated rotated revoked forgotten hidden redacted removed changed updated reset expires follows
string integer number boolean object value type field account manager management service request response header cookies session
policy policies protected private public access client credentials authorization authentication authenticated basic bearer digest
username email address phone contact please enter choose create keep safe secure security stored storage vault environment
variable variables config configuration settings file files path directory local remote production development staging testing
correct horse battery staple""".split()
_RANK = {w: i + 2 for i, w in enumerate(WORDS)}
#: Letters that digits and signs often stand for.
_LEET = str.maketrans("4@301!$57", "aaeoiisst")
_KEYBOARD = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
_NEXT = {(a, b) for row in _KEYBOARD for p, q in zip(row, row[1:]) for a, b in ((p, q), (q, p))}
_NEXT |= {(a, b) for upper, lower in zip(_KEYBOARD, _KEYBOARD[1:]) for p, q in zip(upper, lower) for a, b in ((p, q), (q, p))}
_DATE = re.compile(r"(?:19|20)\d\d([-/.]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01])([-/.]?)(?:0?[1-9]|1[0-2])\2(?:19|20)?\d\d|(?:19|20)\d\d")

#: Guesses (power of ten) from which a value counts as a secret, and the shortest value looked at.
COST = 10.0
LEAST = 6
#: Longest unit of a repeat; words and keys that are written twice are longer and count as what they are.
UNIT = 4
#: From this length on, what repeats, walks and runs may start at is decided by their first NEAR characters.
NEAR = 32
#: A longer value is first tried by so many of its characters, which mostly tell that it costs enough.
PROBE = 2048
_CHOICE = math.log10(4)


def ranked_words(vocabulary: str | None) -> dict[str, int]:
    """Guess counts of words: WORDS in their order, then the whole words of a vocabulary with word ends, in the order of its ids."""
    ranks = dict(_RANK)
    if vocabulary:
        with open(resolve(vocabulary), encoding="utf-8") as f:
            ids = json.load(f)["model"]["vocab"]
        for token in sorted(ids, key=ids.get):
            word = token.removesuffix("</w>")
            if word != token and len(word) >= 3 and word.isalpha():
                ranks.setdefault(word, len(ranks) + 2)
    return ranks


class Words:
    """Ranks of words, and what tells quickly that no word ends with two characters."""

    def __init__(self, ranks: dict[str, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks), default=0)
        self.endings = {w[-2:] for w in ranks}


_COMMON = Words(_RANK)


def _spread(c: str) -> float:
    """Power of ten of the guesses for one character by brute force."""
    return 1.0 if c.isdigit() else math.log10(26) if c.isalpha() else math.log10(33)


def _repeats(value: str) -> list[tuple[int, int, int]]:
    """(start, end, unit) of the longest stretches of at least two equal units; those of a multiple of a shorter unit are left out."""
    points = np.frombuffer(value.encode("utf-32-le", "surrogatepass"), np.uint32)
    found: dict[int, tuple[list[int], list[int]]] = {}
    for unit in range(1, min(UNIT, len(points) // 2) + 1):
        same = np.concatenate([[False], points[unit:] == points[:-unit], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        starts, ends = edges[0::2], edges[1::2] + unit
        long = (ends - starts >= max(3, 2 * unit))
        starts, ends = starts[long], ends[long]
        for u, (s, e) in found.items():
            if unit % u == 0 and s:
                at = np.searchsorted(s, starts, side="right") - 1
                apart = (at < 0) | (np.asarray(e)[at] < ends)
                starts, ends = starts[apart], ends[apart]
        found[unit] = starts.tolist(), ends.tolist()
    return [(a, b, unit) for unit, (s, e) in found.items() for a, b in zip(s, e)]


class _Stretch:
    """A repeat, walk or run that began at ``start``: the cheapest way to a place from any place within it.

    Its price grows with the logarithm of its length, a new segment costs at least four guesses more. So once it is long,
    only starts among its first NEAR characters that are hardly dearer than the first can be the best.
    """

    def __init__(self, start: int, step: int, least: int, price: float):
        self.start, self.step, self.least, self.price = start, step, least, price
        self.few: list[int] | None = None

    def cost(self, best: list[float], i: int) -> float:
        size = i - self.start
        if size < 2 * NEAR + self.least:
            starts = range(i - self.least, self.start - 1, -self.step)
        else:
            if self.few is None:
                limit = best[self.start] + 0.5
                self.few = [j for j in range(self.start, self.start + NEAR + self.step) if best[j] <= limit]
            starts = [j for j in self.few if (i - j) % self.step == 0]
        return min((best[j] + math.log10((i - j) // self.step) for j in starts), default=math.inf) + self.price


def guess_cost(value: str, words: Words | None = None, enough: float = math.inf) -> float:
    """log10 of the guesses that the cheapest segmentation of ``value`` needs; 0 for an empty value.

    Costs of segments multiply. A brute-force span costs its alphabet to the power of its
    length; every other segment adds one choice of kind and place. Where the whole is sure to cost
    ``enough``, the search ends there with a cost of at least that.
    """
    if len(value) > 2 * PROBE and enough < math.inf:
        cost, sure = _cheapest(value[:PROBE], words or _COMMON, enough)
        if sure:
            return cost
    return _cheapest(value, words or _COMMON, enough)[0]


def _cheapest(value: str, words: Words, enough: float) -> tuple[float, bool]:
    """The cost, and whether the search ended before the value did, at a place that any longer value costs as much."""
    ranks, longest, endings = words.ranks, words.longest, words.endings
    low = value.lower()
    if len(low) != len(value):
        low = value
    plain = low.translate(_LEET)
    n = len(value)
    best = [0.0] + [math.inf] * n
    begins: dict[int, list[tuple[int, int, int]]] = {}
    for a, b, unit in _repeats(value):
        begins.setdefault(a + max(3, 2 * unit), []).append((a, b, unit))
    repeats: list[tuple[int, _Stretch]] = []
    walk = run = None
    steps = 0
    reach = max(longest, 10)
    i = 0
    while i < n:
        i += 1
        cost = best[i - 1] + _spread(value[i - 1])
        if i > 1:
            if (low[i - 2], low[i - 1]) not in _NEXT:
                walk = None
            elif walk is None:
                walk = _Stretch(i - 2, 1, 3, math.log10(160) + _CHOICE)
            step = ord(value[i - 1]) - ord(value[i - 2])
            if abs(step) != 1:
                run = None
            elif run is None or step != steps:
                run = _Stretch(i - 2, 1, 3, math.log10(20) + _CHOICE)
            steps = step
        for a, b, unit in begins.get(i, ()):
            repeats += [(b, _Stretch(a + k, unit, max(3, 2 * unit) if unit > 1 else 3, sum(map(_spread, value[a + k : a + k + unit])) + _CHOICE)) for k in range(unit)]
        repeats = [r for r in repeats if r[0] >= i]
        for stretch in (walk, run, *(r for _, r in repeats)):
            if stretch is not None and i - stretch.start >= stretch.least:
                cost = min(cost, stretch.cost(best, i))
        if low[max(0, i - 2) : i] in endings or plain[max(0, i - 2) : i] in endings:
            for size in range(2, min(longest, i) + 1):
                j = i - size
                part = low[j:i]
                rank, extra = ranks.get(part), _CHOICE
                if rank is None:
                    rank = ranks.get(plain[j:i])
                    extra += math.log10(4)
                if rank is not None:
                    if value[j:i] != part:
                        extra += math.log10(2 if value[j].isupper() or value[j:i].isupper() else size * 2)
                    cost = min(cost, best[j] + math.log10(rank) + extra)
        if value[i - 1].isdigit():
            for size in range(3, min(10, i) + 1):
                j = i - size
                if value[j].isdigit() and _DATE.fullmatch(value, j, i):
                    cost = min(cost, best[j] + math.log10(365 * 60 if size > 4 else 120) + _CHOICE)
        best[i] = cost
        # every way on passes one of the last places, or one within a stretch that is open here; looked at more rarely the longer it takes
        if cost >= enough and (i <= 2 * NEAR or i & (i - 1) == 0) and min(best[max(0, i - reach) : i + 1]) >= enough:
            opened = [s.start for s in (walk, run) if s is not None] + [a for found in begins.values() for a, b, _ in found if a < i < b]
            if not opened or min(best[min(opened) : i + 1]) >= enough:
                return cost, True
        # no cut deep within a long repeat is better than one near its ends
        for b, stretch in repeats:
            if i - stretch.start > 6 * NEAR and b - i > reach + 6 * NEAR:
                i = b - reach - 4 * NEAR
                break
    return best[n], False


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base kinds, ordered."""
    spans = []
    low = text.lower()
    if "passw" in low or "secret" in low or "token" in low or "api" in low:
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def guess_spans(text: str, base: list[tuple[int, int, int]], cost: float = COST, words: Words | None = None) -> list[tuple[int, int, int]]:
    """Values in credential contexts that are in no base span and cost ``cost`` or more to guess."""
    low = text.lower()
    if not any(w in low for w in ("pass", "pwd", "secret", "token", "key", "credential", "auth", "bearer")):
        return []
    out = []
    for m in _CONTEXT.finditer(text):
        group = m.lastindex
        value, start, end = m[group], m.start(group), m.end(group)
        if len(value) < LEAST:
            continue
        if any(a <= start and end <= b for a, _, b in base):
            continue
        if guess_cost(value, words, cost) >= cost:
            out.append((start, 3, end))
    return out


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame, cost: float = COST, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_assign, n_access, n_hex, n_guess, base_sha256, spans.

    ``vocabulary`` names a vocabulary file with word ends, whose words the dictionary has besides WORDS.

    Spans are ``kind:start:end`` in code points, by start, then kind as listed, comma-joined.
    Null and empty texts have no spans; rows that repeat are scanned each.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = held(("words", vocabulary), lambda: Words(ranked_words(vocabulary)))
        rows = []
        for t in texts_of(batch):
            base = base_spans(t)
            kinds = [k for _, k, _ in base]
            more = guess_spans(t, base, cost, words)
            rows.append((kinds.count(0), kinds.count(1), kinds.count(2), len(more), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(sorted(base + more))))
        columns = list(zip(*rows)) or [()] * 6
        types = [pa.int64()] * 4 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))], ["doc_id", "n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(over_texts(run), "doc_id long, n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string")
