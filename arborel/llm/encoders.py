"""Token encoders of public vocabulary files, built once per Python worker.

A vocabulary is named by a path or, for the files of the installed
``public_tokenizers`` package, by file name alone.
"""

from __future__ import annotations

import base64
import itertools
import json
import os
import re

import numpy as np

from arborel.llm.common import held

#: Different words whose ids a worker keeps, the first it meets; others are kept for one slice of text.
CACHED_WORDS = 600_000

#: Byte tables: white space for sure becomes a blank; and A-Z become a-z as well.
_BLANKED = np.arange(256, dtype=np.uint8)
_BLANKED[[9, 10]] = 32
_LOWERED = _BLANKED.copy()
_LOWERED[65:91] += 32
#: Beyond these, lower-casing before Unicode composition may differ from lower-casing after it.
_UNPLAIN = re.compile("[^\x00-\u02ff\u2010-\u2027]")
#: Lower-case Latin letters and signs that may follow them; no sign here begins a contraction.
_PLAIN_WORD = re.compile(rb"((?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+)([!#$%&*.,;:?|]*)\Z").match
#: How byte-level vocabularies write the bytes 0x80-0xA0 and 0xAD; the others that occur here stand for themselves.
_BYTE_LEVEL = {b: 256 + 33 + i for i, b in enumerate([*range(0x7F, 0xA1), 0xAD])}
#: UTF-8 bytes from this on begin code points from U+0300 on.
_FAR = 0xCC


def resolve(name: str) -> str:
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class _Ids(dict):
    """Word to index; a word that is missing gets the next index and is noted in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        at = self[word] = len(self)
        self.new.append(word)
        return at


class WordCachedEncoder:
    """Ids of whole texts from a lower-casing ``tokenizers`` file whose pre-tokeniser never joins what white space parts.

    Texts are cut at blanks, tabs and line ends, and before a full stop or comma that stands
    between a letter a-z and a blank; every different piece is encoded once by the library and
    looked up afterwards, which gives the ids of the whole text. A-Z are lower-cased first where
    nothing in the text could make that differ from what the vocabulary's own normaliser does.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        steps = [x.get("type") for x in (made.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        patterns = json.dumps(made.get("pre_tokenizer"))
        self.plain = made["model"]["type"] == "BPE" and steps == ["Split", "ByteLevel"] and r"[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+" in patterns and not made.get("post_processor")
        self.tails: dict[bytes, list[int]] = {}
        self.known = _Ids()
        self.pool = np.empty(0, np.uint32)
        self.starts = np.empty(0, np.int64)
        self.sizes = np.empty(0, np.int64)

    def _learn(self) -> None:
        """Ids of the new words. Lower-case words need no normaliser and no pre-tokeniser, so the library's
        model takes them as they are, with bytes written as its byte-level step would; signs that
        follow are a token of their own."""
        words, self.known.new = self.known.new, []
        ids: list[list[int] | None] = [None] * len(words)
        rest, tokenize = [], self.tokenizer.model.tokenize
        for i, w in enumerate(words):
            m = _PLAIN_WORD(w) if self.plain else None
            if m is None:
                rest.append(i)
                continue
            core, tail = m.groups()
            found = [t.id for t in tokenize(core.decode() if core.isascii() else core.decode("latin-1").translate(_BYTE_LEVEL))]
            if tail:
                if tail not in self.tails:
                    self.tails[tail] = self.tokenizer.encode(tail.decode(), add_special_tokens=False).ids
                found += self.tails[tail]
            ids[i] = found
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([words[i].decode() for i in rest], add_special_tokens=False)):
            ids[i] = e.ids
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.pool = np.concatenate([self.pool, np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(sizes.sum()))])

    @staticmethod
    def _pieces(texts: list[str]) -> tuple[list[bytes], np.ndarray]:
        """All pieces in order, and how many each text has."""
        parts = [t.encode() for t in texts]
        raw = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        plain = np.maximum.reduceat(raw, offsets[:-1]) < _FAR
        for i in np.flatnonzero(~plain).tolist():
            plain[i] = not _UNPLAIN.search(texts[i])
        for i, part in enumerate(parts):
            if b"<|" in part:
                plain[i] = False
        everywhere = bool(plain.all())
        low = _LOWERED[raw]
        if not everywhere:
            low = np.where(np.repeat(plain, sizes), low, _BLANKED[raw])
        stop = np.flatnonzero(((low == 46) | (low == 44))[1:-1] & (low[2:] == 32) & (low[:-2] >= 97) & (low[:-2] <= 122)) + 1
        if not everywhere and len(stop):
            stop = stop[plain[np.searchsorted(offsets, stop, side="right") - 1]]
        low = np.insert(low, stop, 32)
        offsets = offsets + np.searchsorted(stop, offsets)
        blanks = np.concatenate([[0], np.cumsum(low == 32)])[offsets]
        pieces = low.tobytes().split(b" ")
        return pieces[:-1], np.diff(blanks)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of ids of each text."""
        if not texts:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        pieces, counts = self._pieces(texts)
        had, size = len(self.known), len(self.pool)
        at = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        new = self.known.new
        if new:
            self._learn()
        many = self.sizes[at]
        ends = np.cumsum(many)
        out = self.pool[np.arange(int(ends[-1])) + np.repeat(self.starts[at] - (ends - many), many)]
        done = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        if had >= CACHED_WORDS:
            for w in new:
                del self.known[w]
            self.pool, self.starts, self.sizes = self.pool[:size], self.starts[:had], self.sizes[:had]
        return out, np.diff(done)


class RankEncoder:
    """Ids from a ``tiktoken`` rank file; no special tokens."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("arborel", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [self.encoding.encode_ordinary(t) for t in texts]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((x for i in ids for x in i), np.uint32, int(sizes.sum())), sizes


def encoder(name: str):
    path = resolve(name)
    return held(path, lambda: RankEncoder(path) if path.endswith(".tiktoken") else WordCachedEncoder(path))
