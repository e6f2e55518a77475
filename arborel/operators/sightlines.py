"""Sightlines among rectangles, block by block in numpy.

Where buildings have trees by the hundred, and ways cross obstacles by the dozen, rows for all of them cost more than the
geometry. A building, tree or obstacle is dealt to the square blocks where it may matter; a tree is looked at in the block that
holds it, so each pair is found once. Obstacles are passed over only where the result is known, which is mostly so for all the ways
to a tree at once:

* A place well inside an obstacle that rises above the tree is hidden from some metres off: such pairs are listed, not looked at.
* From other trees, obstacles that fill all of a narrow sector hide what looks along it from beyond them: a way is held against one
  number for its sector.
* What may still be in view is held against all obstacles of the cells that its way crosses.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Shares of the heights looked from and at, and the length at both ends of a way in metres that obstacles may touch.
LEVELS = (0.0, 0.5, 1.0)
MARGIN = 0.05
#: Metres from which on trees under a higher obstacle are listed as hidden, and how deep inside the obstacle their place has to be.
CLOSE, DEEP = 5.0, 0.06
#: Trees of a tile, tests done at once, obstacles whose sectors a tree is given, and metres of a cell.
TREES, TESTS, ASKED, CELL = 64, 1 << 16, 64, 10.0
#: Ways that are walked together.
WAITING = 1 << 13
#: Sectors around a tree, the angle where they begin (no side of a rectangle lies along it), metres that their obstacles may be away,
#: the classes of eyes by height, and the metres that rounding is given.
SECTORS, TURN, AWAY, EYES, TINY = 64, 0.0123, 40.0, 4, 1e-6


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of so many members: each member's group and its place in it."""
    group = np.repeat(np.arange(len(counts)), counts)
    return group, np.arange(len(group)) - np.repeat(np.cumsum(counts) - counts, counts)


class Homes:
    """Buildings looked from: code (those of obstacles that are the same building), top, box."""

    def __init__(self, code: np.ndarray, top: np.ndarray, box: list[np.ndarray]):
        self.code, self.top, self.box = code, top, box


class Ways:
    """Ways from buildings' eyes to trees: rows of both sides, ends, length, heights, codes and what is hidden from each eye."""

    FIELDS = ("home", "tree", "ex", "ey", "ax", "ay", "way", "eye", "aim", "hcode", "tcode", "shade")

    def __init__(self, **fields: np.ndarray):
        self.__dict__ |= fields

    def some(self, rows: np.ndarray | slice) -> Ways:
        return Ways(**{f: getattr(self, f)[rows] for f in self.FIELDS})

    def __len__(self) -> int:
        return len(self.home)


class Aims:
    """Trees looked at: place, top and code; ``codes`` is the number of buildings' codes, and trees' codes follow them.

    ``cover`` and ``second`` are the rises of the two highest obstacles of different codes that a place is well inside of (-inf:
    none), ``by`` the code of the first. ``hidden`` tells trees that no building sees from ``CLOSE`` on."""

    def __init__(self, x: np.ndarray, y: np.ndarray, top: np.ndarray, code: np.ndarray, codes: int):
        self.x, self.y, self.top, self.code, self.codes = x, y, top, code, codes
        self.cover, self.second, self.by = np.full(len(x), -np.inf), np.full(len(x), -np.inf), np.full(len(x), -1)
        self.hidden = np.zeros(len(x), bool)

    def tiles(self, rows: np.ndarray) -> list[np.ndarray]:
        """Rows that lie close together."""
        from arborel.operators.blocks import groups

        if not len(rows):
            return []
        x, y = self.x[rows], self.y[rows]
        span = max(np.ptp(x), np.ptp(y), 1.0)
        return [rows[g] for g in groups(x, y, float(np.clip(span * np.sqrt(TREES / len(rows)), 10.0, max(span, 10.0))))]


def joined(parts: list[Ways]) -> Ways:
    return parts[0] if len(parts) == 1 else Ways(**{f: np.concatenate([getattr(p, f) for p in parts]) for f in Ways.FIELDS})


def _slab(low, high, start, step):
    """Where ways are between two lines: from, to (shares of the way). Ways that don't move across are there all along or never."""
    first, last = low - start, high - start
    first /= step
    last /= step
    low_first = np.minimum(first, last)
    np.maximum(first, last, out=last)
    still = np.flatnonzero(step == 0)
    if len(still):
        if low.ndim == step.ndim:
            low, high = low[still], high[still]
        start = start[still]
        low_first[still] = np.where((start >= low) & (start <= high), -np.inf, np.inf)
        last[still] = np.inf
    return low_first, last


class Block:
    """Obstacles of a block: code, rise and box; the obstacles of each cell are found when they are first needed."""

    def __init__(self, code: np.ndarray, rise: np.ndarray, box: list[np.ndarray], bounds: tuple[float, float, float, float]):
        order = np.argsort(-rise, kind="stable")
        self.code, self.rise, self.box = code[order], rise[order], [c[order] for c in box]
        self.bounds, self.starts = bounds, None

    def near(self, x0: float, y0: float, x1: float, y1: float) -> np.ndarray:
        """Obstacles that touch a box."""
        b = self.box
        return np.flatnonzero((b[2] >= x0) & (b[0] <= x1) & (b[3] >= y0) & (b[1] <= y1))

    def _hide(self, w: Ways, rows: np.ndarray, things: np.ndarray, near: np.ndarray, far: np.ndarray) -> None:
        """Raise the shades of ``rows`` (ascending) by obstacles that their ways cross from near to far."""
        if not len(rows):
            return
        first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        eye, rise = w.eye[rows], self.rise[things]
        for k, share in enumerate(LEVELS):
            over = rise - eye * share
            most = np.maximum.reduceat(eye * share + over / np.where(over >= 0, near, far), first)
            w.shade[rows[first], k] = np.maximum(w.shade[rows[first], k], most)

    def _cells(self) -> None:
        u0, v0, u1, v1 = self.bounds
        self.wide, self.high = int((u1 - u0) // CELL) + 1, int((v1 - v0) // CELL) + 1
        column = lambda x, most, low: np.clip(np.floor((x - low) / CELL), 0, most - 1).astype(np.int64)
        inside = self.near(u0, v0, u1, v1)
        x0, y0, x1, y1 = (c[inside] for c in self.box)
        i0, i1 = column(x0 - 1e-6, self.wide, u0), column(x1 + 1e-6, self.wide, u0)
        j0, j1 = column(y0 - 1e-6, self.high, v0), column(y1 + 1e-6, self.high, v0)
        thing, place = _spread((i1 - i0 + 1) * (j1 - j0 + 1))
        rows = (j1 - j0 + 1)[thing]
        cell = (i0[thing] + place // rows) * self.high + j0[thing] + place % rows
        order = np.argsort(cell, kind="stable")
        self.members = inside[thing[order]]
        self.starts = np.searchsorted(cell[order], np.arange(self.wide * self.high + 1))

    def walk(self, w: Ways) -> None:
        """Hold ways against all obstacles of the cells that they cross."""
        if self.starts is None:
            self._cells()
        u0, v0, _, _ = self.bounds
        for begin in range(0, len(w), 8192):
            part = slice(begin, begin + 8192)
            ex, ey, ax, ay = (v[part] for v in (w.ex, w.ey, w.ax, w.ay))
            west, east, south, north = np.minimum(ex, ax), np.maximum(ex, ax), np.minimum(ey, ay), np.maximum(ey, ay)
            first = np.floor((west - 1e-6 - u0) / CELL).astype(np.int64)
            way, k = _spread(np.floor((east + 1e-6 - u0) / CELL).astype(np.int64) - first + 1)
            i = first[way] + k
            # the stretch of the way in the column
            dx, dy = (ax - ex)[way], (ay - ey)[way]
            at = [np.clip((np.clip(u0 + (i + s) * CELL, west[way], east[way]) - ex[way]) / np.where(dx == 0, 1.0, dx), 0.0, 1.0) * dy + ey[way] for s in (0, 1)]
            low = np.where(dx == 0, south[way], np.minimum(*at)) - 1e-6
            high = np.where(dx == 0, north[way], np.maximum(*at)) + 1e-6
            j = np.floor((low - v0) / CELL).astype(np.int64)
            column, k = _spread(np.floor((high - v0) / CELL).astype(np.int64) - j + 1)
            i, j, way = i[column], j[column] + k, way[column]
            inside = (i >= 0) & (i < self.wide) & (j >= 0) & (j < self.high)
            cell, way = i[inside] * self.high + j[inside], way[inside]
            counts = self.starts[cell + 1] - self.starts[cell]
            total = np.cumsum(counts)
            cuts = np.unique(np.searchsorted(total, np.arange(0, total[-1] + TESTS if len(total) else 0, TESTS)))
            for p, q in zip(cuts, [*cuts[1:], len(cell)]):
                group, place = _spread(counts[p:q])
                if not len(group):
                    continue
                things, rows = self.members[self.starts[cell[p:q]][group] + place], begin + way[p:q][group]
                x0, y0, x1, y1 = (c[things] for c in self.box)
                sx, sy = w.ex[rows], w.ey[rows]
                dx, dy, margin = w.ax[rows] - sx, w.ay[rows] - sy, MARGIN / w.way[rows]
                (a, b), (c, d) = _slab(x0, x1, sx, dx), _slab(y0, y1, sy, dy)
                lo, hi = np.maximum(np.maximum(a, c), 0.0), np.minimum(np.minimum(b, d), 1.0)
                near, far, code = np.maximum(lo, margin), np.minimum(hi, 1 - margin), self.code[things]
                hit = (lo <= hi) & (near <= far) & (code != w.hcode[rows]) & (code != w.tcode[rows])
                self._hide(w, rows[hit], things[hit], near[hit], far[hit])

    def cover(self, aims: Aims, homes: Homes) -> None:
        """Tell the trees' covers, and which trees are hidden."""
        for tile in aims.tiles(np.arange(len(aims.x))):
            found = self.near(aims.x[tile].min(), aims.y[tile].min(), aims.x[tile].max(), aims.y[tile].max())
            if not len(found):
                continue
            (x0, y0, x1, y1), rise, code = (c[found] for c in self.box), self.rise[found], self.code[found]
            step = max(1, TESTS // len(found))
            for i in range(0, len(tile), step):
                t = tile[i : i + step]
                x, y, top = aims.x[t, None], aims.y[t, None], aims.top[t, None]
                inside = (x0 + DEEP <= x) & (x <= x1 - DEEP) & (y0 + DEEP <= y) & (y <= y1 - DEEP) & (top + TINY <= rise) & (top >= 0) & (code != aims.code[t, None])
                # obstacles come by their rise, the highest first
                at = inside.argmax(1)
                some = inside[np.arange(len(t)), at]
                aims.cover[t], aims.by[t] = np.where(some, rise[at], -np.inf), np.where(some, code[at], -1)
                inside &= code != aims.by[t, None]
                at = inside.argmax(1)
                aims.second[t] = np.where(inside[np.arange(len(t)), at], rise[at], -np.inf)
        highest = homes.top.max()
        enough = lambda rise: under(CLOSE, rise, highest, aims.top)
        aims.hidden = enough(aims.cover)
        # a building's own tree is inside, as a rule; where it is not, all of the tree's ways are looked at
        home = np.full(aims.codes + 1, -1)
        home[homes.code] = np.arange(len(homes.code))
        own = home[np.where(aims.hidden & ~enough(aims.second) & (aims.by < aims.codes), aims.by, aims.codes)]
        rows = np.flatnonzero(own >= 0)
        x0, y0, x1, y1 = (c[own[rows]] for c in homes.box)
        aims.hidden[rows[_gaps(x0, y0, x1, y1, aims.x[rows], aims.y[rows]) >= CLOSE * CLOSE]] = False

    def sectors(self, aims: Aims, trees: np.ndarray, eyes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each tree, class of eyes (up to that height) and sector: the length from which on ways are hidden, and by which code.

        An obstacle that both sides of a sector hit is hit all along it. The farthest way in, at one of the sides, hides least: the view
        from an eye above the obstacle passes over its far side, and ends in its shade if (eye - top) / (rise - top) times as far away."""
        least, by = np.full((len(trees), len(eyes), SECTORS), np.inf), np.full((len(trees), len(eyes), SECTORS), -1)
        x, y, top, code = (c[trees, None] for c in (aims.x, aims.y, aims.top, aims.code))
        found = self.near(x.min() - AWAY, y.min() - AWAY, x.max() + AWAY, y.max() + AWAY)
        found = found[(self.rise[found] > top.min()) & (np.minimum(self.box[2] - self.box[0], self.box[3] - self.box[1])[found] > 4 * TINY)]
        if not len(found):
            return least, by
        x0, y0, x1, y1 = (c[found] for c in self.box)
        angles = TURN + np.arange(SECTORS) * (2 * np.pi / SECTORS)
        east, north = 1 / np.cos(angles), 1 / np.sin(angles)
        count = min(ASKED, len(found))
        step = max(1, min(TESTS // len(found), 2 * TESTS // (count * SECTORS)))
        for i in range(0, len(trees), step):
            s = slice(i, i + step)
            above = self.rise[found] - top[s]
            fine = (above >= TINY) & (top[s] >= 0) & (self.code[found] != code[s])
            gap = np.sqrt(_gaps(x0, y0, x1, y1, x[s], y[s]))
            rank = np.where(fine, np.maximum(gap, gap * (eyes[-1] - top[s]) / np.where(fine, above, 1.0)), np.inf)
            best = np.argpartition(rank, count - 1, axis=1)[:, :count] if count < len(found) else np.broadcast_to(np.arange(count), rank.shape)
            fine, above = np.take_along_axis(fine, best, 1), np.take_along_axis(above, best, 1)
            a, b = ((c[best] - x[s] + d)[..., None] * east for c, d in ((x0, TINY), (x1, -TINY)))
            c, d = ((c[best] - y[s] + d)[..., None] * north for c, d in ((y0, TINY), (y1, -TINY)))
            begin, end = np.maximum(np.minimum(a, b), np.minimum(c, d)), np.minimum(np.maximum(a, b), np.maximum(c, d))
            np.maximum(begin, MARGIN, out=begin)
            begin[(begin > end) | (end < DEEP + 0.01) | ~fine[..., None]] = np.inf
            begin = np.maximum(begin, np.roll(begin, -1, axis=-1)) + TINY
            for k, eye in enumerate(eyes):
                ratio = (eye - top[s]) / np.where(fine, above, 1.0)
                ratio = np.where(np.isfinite(ratio), np.maximum(ratio, TINY), np.inf)
                length = np.maximum(begin + DEEP, begin * ratio[..., None])
                at = length.argmin(1)[:, None]
                least[s, k] = np.take_along_axis(length, at, 1)[:, 0]
                by[s, k] = self.code[found][np.take_along_axis(best[..., None], at, 1)[:, 0]]
        return least, by


def under(way, rise, eye, top):
    """Whether a tree well inside an obstacle of that rise is hidden on ways of that length from all eyes up to that height."""
    return (rise >= top + TINY) & (way >= 4 * MARGIN) & (way * (rise - top) >= (MARGIN + TINY) * (eye - top))


def _gaps(x0, y0, x1, y1, x, y):
    """Squared distances of places and boxes."""
    gap, up = np.maximum(x0 - x, x - x1), np.maximum(y0 - y, y - y1)
    np.maximum(gap, 0.0, out=gap)
    np.maximum(up, 0.0, out=up)
    gap *= gap
    up *= up
    gap += up
    return gap


def _met(homes: Homes, aims: Aims, trees: np.ndarray, least: float, most: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Trees of a tile, buildings, and which of them (a matrix) are at least and at most so far from each other."""
    x, y = aims.x[trees], aims.y[trees]
    slack = most * (1 + 1e-9) + 1e-6
    some = np.flatnonzero((homes.box[2] >= x.min() - slack) & (homes.box[0] <= x.max() + slack) & (homes.box[3] >= y.min() - slack) & (homes.box[1] <= y.max() + slack))
    step = max(1, TESTS // max(1, len(some)))
    x0, y0, x1, y1 = (c[some] for c in homes.box)
    for i in range(0, len(trees) if len(some) else 0, step):
        gap = _gaps(x0, y0, x1, y1, x[i : i + step, None], y[i : i + step, None])
        fine = gap <= most * most
        if least:
            fine &= gap >= least * least
        yield trees[i : i + step], some, fine


def hidden_pairs(homes: Homes, aims: Aims, reach: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs with hidden trees that are ``CLOSE`` or more and at most ``reach`` apart: trees, how many buildings each has, and these."""
    if not len(homes.top):
        return
    for tile in aims.tiles(np.flatnonzero(aims.hidden)):
        for trees, some, fine in _met(homes, aims, tile, CLOSE, reach):
            counts = np.count_nonzero(fine, axis=1)
            kept = counts > 0
            yield trees[kept], counts[kept], np.broadcast_to(some, fine.shape)[fine]


def _paired(homes: Homes, aims: Aims, trees: np.ndarray, reach: float, centre: bool, close: bool) -> Iterator[Ways]:
    """Ways of ``trees`` and the buildings at most ``reach`` apart; if ``close``, only those that ``hidden_pairs`` leaves."""
    for t, some, fine in _met(homes, aims, trees, 0.0, min(reach, CLOSE) if close else reach):
        r, h = np.nonzero(fine)
        r, h = t[r], some[h]
        ax, ay = aims.x[r], aims.y[r]
        b = [c[h] for c in homes.box]
        if close:
            kept = np.flatnonzero(_gaps(*b, ax, ay) < CLOSE * CLOSE)
            r, h, ax, ay, b = r[kept], h[kept], ax[kept], ay[kept], [c[kept] for c in b]
        if not len(r):
            continue
        if centre:
            ex, ey = (b[0] + b[2]) / 2, (b[1] + b[3]) / 2
        else:
            ex, ey = np.maximum(b[0], np.minimum(ax, b[2])), np.maximum(b[1], np.minimum(ay, b[3]))
            k = np.flatnonzero((ex == ax) & (ey == ay))  # inside, or on the outline: the nearest side, the first of those as near
            sides = np.stack([ay[k] - b[1][k], b[2][k] - ax[k], b[3][k] - ay[k], ax[k] - b[0][k]]).argmin(0)
            ex[k] = np.choose(sides, [ax[k], b[2][k], ax[k], b[0][k]])
            ey[k] = np.choose(sides, [b[1][k], ay[k], b[3][k], ay[k]])
        way = np.sqrt((ax - ex) ** 2 + (ay - ey) ** 2)
        yield Ways(home=h, tree=r, ex=ex, ey=ey, ax=ax, ay=ay, way=way, eye=homes.top[h], aim=aims.top[r], hcode=homes.code[h], tcode=aims.code[r], shade=np.full((len(r), 3), -np.inf))


def ways(homes: Homes, aims: Aims, block: Block | None, reach: float, centre: bool) -> Iterator[Ways]:
    """All ways at most ``reach`` long from a box to its trees; with the shades of the block's obstacles if it is given, and then
    without ``hidden_pairs``.

    A shade at or above a tree's top may be higher or lower than told, but is at or above it."""
    if not len(aims.x) or not len(homes.top):
        return
    left: list[Ways] = []
    waiting = 0

    def finished() -> Iterator[Ways]:
        if left:
            w = joined(left)
            left.clear()
            block.walk(w)
            yield w

    if block is None:
        for tile in aims.tiles(np.arange(len(aims.x))):
            yield from _paired(homes, aims, tile, reach, centre, False)
        return
    with np.errstate(divide="ignore", invalid="ignore"):
        eyes = np.unique(np.quantile(homes.top, np.arange(1, EYES + 1) / EYES, method="higher"))
        place = np.empty(len(aims.x), np.int64)
        for close in (True, False):
            for tile in aims.tiles(np.flatnonzero(aims.hidden == close)):
                if not close:
                    place[tile] = np.arange(len(tile))
                    least, by = block.sectors(aims, tile, eyes)
                for w in _paired(homes, aims, tile, reach, centre, close):
                    rise = np.where(w.hcode != aims.by[w.tree], aims.cover[w.tree], aims.second[w.tree])
                    known = under(w.way, rise, w.eye, w.aim)
                    if not close:
                        sector = np.floor((np.arctan2(w.ey - w.ay, w.ex - w.ax) - TURN) * (SECTORS / (2 * np.pi))).astype(np.int64) % SECTORS
                        at = place[w.tree], np.searchsorted(eyes, w.eye), sector
                        known |= (w.way >= least[at]) & (by[at] != w.hcode)
                    w.shade[known] = np.inf
                    known |= w.way == 0
                    yield w.some(known)
                    left.append(w.some(~known))
                    waiting += len(left[-1])
                    if waiting > WAITING:
                        waiting = 0
                        yield from finished()
        yield from finished()
