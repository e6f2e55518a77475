"""Simple-8b word-aligned coding of unsigned integers, vectorised over blocks.

A 64-bit word has a selector in its top four bits and, from the lowest bit on, as
many values of one width as the selector says. Selector 0 is the escape: the next
word holds one whole 64-bit value. Ids are cut into blocks of ``BLOCK`` values, each
starting on a word of its own, so all blocks of a batch advance together.
"""

from __future__ import annotations

import numpy as np

#: How many values a word of each selector packs, and their width in bits.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = np.array([64, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)

BLOCK = 1024
_SHIFT = np.uint64(60)


#: Bits of the values below 2**16, 1 for 0.
_BITS = np.maximum(1, np.ceil(np.log2(np.arange(1 << 16) + 1.0))).astype(np.int8)


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits of each value, 1 for 0."""
    small = values < np.uint64(1 << 16)
    if small.all():
        return _BITS[values.astype(np.uint16)]
    out = _BITS[(values & np.uint64(0xFFFF)).astype(np.uint16)]
    for k in (16, 32, 48):
        part = values >> np.uint64(k)
        more = part > 0
        out[more] = k + _BITS[(part[more] & np.uint64(0xFFFF)).astype(np.uint16)]
    return out


def encode(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Words of all blocks in order, and each block's first word (one more at the end)."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    blocks = -(-n // block)
    if not n:
        return np.empty(0, np.uint64), np.zeros(1, np.int64)
    widest = np.zeros(blocks * block, np.int8)
    widest[:n] = _widths(values)
    widest = widest.reshape(blocks, block)
    # widest: most bits among the next `have` values of the block; a word may be left partly empty only at a block's end
    selector, have = np.zeros((blocks, block), np.int8), 1
    least = int(widest.min(where=widest > 0, initial=64))
    for s in range(len(COUNTS) - 1, 0, -1):
        count, width = int(COUNTS[s]), int(WIDTHS[s])
        if width < least and count <= block and s > 1:
            # no full word of this width can be made; only a short block end could use it, as the next wider one can
            break
        while have < count:
            step = min(have, count - have)
            np.maximum(widest[:, : block - step], widest[:, step:], out=widest[:, : block - step])
            have += step
        selector[widest <= width] = s
    left = np.minimum(block, n - np.arange(blocks) * block)
    taken = COUNTS[selector]
    places = np.full((blocks, block), -1, np.int16 if block < 1 << 15 else np.int32)
    rows, at, k = np.arange(blocks), np.zeros(blocks, np.int64), 0
    while len(rows):
        places[rows, k] = at
        at = at + taken[rows, at]
        go = at < left[rows]
        rows, at, k = rows[go], at[go], k + 1
    places = places[:, :k]
    used = places >= 0
    b = np.repeat(np.arange(blocks), used.sum(1))
    a = places[used].astype(np.int64)
    begin = b * block + a
    s = selector.reshape(-1)[begin]
    words_of = np.where(s == 0, 2, 1)
    ends = np.cumsum(words_of)
    place = ends - words_of
    words = np.zeros(int(ends[-1]), np.uint64)
    flat = np.zeros(blocks * block + 64, np.uint64)
    flat[:n] = values
    room = left[b] - a
    for sel in range(len(COUNTS)):
        mine = np.flatnonzero(s == sel)
        if not len(mine):
            continue
        if sel == 0:
            words[place[mine] + 1] = flat[begin[mine]]
            continue
        count, width, of, free = int(COUNTS[sel]), int(WIDTHS[sel]), begin[mine], room[mine]
        packed = flat[of]
        for j in range(1, count):
            part = flat[of + j]
            if (free <= j).any():
                part = np.where(free > j, part, np.uint64(0))
            packed |= part << np.uint64(j * width)
        words[place[mine]] = packed | (np.uint64(sel) << _SHIFT)
    first = np.zeros(blocks + 1, np.int64)
    first[1:] = ends[np.cumsum(used.sum(1)) - 1]
    return words, first


def decode(words: np.ndarray, first: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The n values of ``encode``; words of all blocks are unpacked together, selector by selector."""
    words = np.asarray(words, np.uint64)
    if not n:
        return np.empty(0, np.uint64)
    selector = (words >> _SHIFT).astype(np.int64)
    # an escape's second word may look like any word: walk only where escapes may be
    heads = np.ones(len(words), bool)
    if (selector == 0).any():
        taken = -1
        for i in np.flatnonzero(selector == 0):
            if i != taken:
                heads[i + 1] = False
                taken = i + 1
    head = np.flatnonzero(heads)
    s = selector[head]
    block_of = np.searchsorted(first, head, side="right") - 1
    sizes = COUNTS[s]
    ends = np.cumsum(sizes)
    begins = ends - sizes
    lead = begins[np.searchsorted(head, first[:-1])]  # of each block's first word
    to = begins - lead[block_of] + block_of * block
    out = np.empty(int(len(first) - 1) * block + 64, np.uint64)
    for sel in range(len(COUNTS)):
        mine = np.flatnonzero(s == sel)
        if not len(mine):
            continue
        if sel == 0:
            out[to[mine]] = words[head[mine] + 1]
            continue
        count, width = int(COUNTS[sel]), int(WIDTHS[sel])
        part = (words[head[mine]][:, None] >> (np.arange(count, dtype=np.uint64) * np.uint64(width))[None, :]) & np.uint64((1 << width) - 1)
        where = to[mine][:, None] + np.arange(count)[None, :]
        fits = where < np.minimum((block_of[mine] + 1) * block, n)[:, None]
        out[where[fits]] = part[fits]
    return out[:n]
