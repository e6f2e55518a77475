"""Planar geometry as Column expressions.

A polygon column ``parts`` is ARRAY<ARRAY<ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>>>: parts, each a
shell followed by its holes, every ring closed. Functions take column names of more than one letter (single
letters name the variables of the expressions) or SQL expressions
and return Columns, so all of it stays in the JVM; only the area of an intersection and the
outline of a buffer need numpy and are Arrow functions (see ``overlay``).

Points on a polygon's boundary: ``contains_point`` counts those on left and lower edges as
inside (each point of a partition of the plane is in one cell); distances treat the boundary
as part of the polygon. Empty or null geometry gives null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT = "struct<x:double,y:double>"
RING = f"array<{POINT}>"
PARTS = f"array<array<{RING}>>"


def rect_sql(x0: str, y0: str, x1: str, y1: str) -> str:
    corner = lambda x, y: f"named_struct('x', CAST({x} AS DOUBLE), 'y', CAST({y} AS DOUBLE))"
    ring = ", ".join(corner(x, y) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)))
    return f"array(array(array({ring})))"


def rect(x0: str, y0: str, x1: str, y1: str) -> Column:
    """A rectangle as a polygon."""
    return F.expr(rect_sql(x0, y0, x1, y1))


def _pairs(rings: str) -> str:
    """Edges of rings or lines: array of struct(ax, ay, bx, by)."""
    step = "named_struct('ax', p.x, 'ay', p.y, 'bx', q.x, 'by', q.y)"
    return f"flatten(transform({rings}, r -> zip_with(slice(r, 1, greatest(size(r) - 1, 0)), slice(r, 2, greatest(size(r) - 1, 0)), (p, q) -> {step})))"


def edges_sql(parts: str) -> str:
    return _pairs(f"flatten({parts})")


def _ring_area(ring: str) -> str:
    """Signed area; coordinates are taken from the first point on, which keeps large offsets from costing digits."""
    step = f"zip_with(slice({ring}, 1, greatest(size({ring}) - 1, 0)), slice({ring}, 2, greatest(size({ring}) - 1, 0)), (p, q) -> (p.x - {ring}[0].x) * (q.y - {ring}[0].y) - (q.x - {ring}[0].x) * (p.y - {ring}[0].y))"
    return f"(aggregate({step}, 0D, (s, v) -> s + v) / 2)"


def _corners(parts: str) -> tuple[str, str]:
    """Two opposite corners of a rectangle, null where there are none."""
    return tuple(f"get(get(get({parts}, 0), 0), {i})" for i in (0, 2))


def area(parts: str) -> Column:
    """Shells less holes."""
    a, b = _corners(parts)
    general = F.expr(f"aggregate(transform({parts}, g -> aggregate(slice(g, 2, greatest(size(g) - 1, 0)), abs({_ring_area('g[0]')}), (s, h) -> s - abs({_ring_area('h')}))), 0D, (s, v) -> s + v)")
    return F.when(is_box(parts), F.expr(f"abs(({b}.x - {a}.x) * ({b}.y - {a}.y))")).otherwise(general)


def perimeter(parts: str) -> Column:
    return F.expr(f"aggregate({edges_sql(parts)}, 0D, (s, e) -> s + sqrt((e.bx - e.ax) * (e.bx - e.ax) + (e.by - e.ay) * (e.by - e.ay)))")


def line_length(path: str) -> Column:
    """Length of a line, an array of points."""
    return F.expr(f"aggregate({_pairs(f'array({path})')}, 0D, (s, e) -> s + sqrt((e.bx - e.ax) * (e.bx - e.ax) + (e.by - e.ay) * (e.by - e.ay)))")


def bbox(parts: str) -> dict[str, Column]:
    points = f"flatten(flatten({parts}))"
    return {
        "x0": F.expr(f"array_min(transform({points}, p -> p.x))"),
        "y0": F.expr(f"array_min(transform({points}, p -> p.y))"),
        "x1": F.expr(f"array_max(transform({points}, p -> p.x))"),
        "y1": F.expr(f"array_max(transform({points}, p -> p.y))"),
    }


def centroid(parts: str) -> Column:
    """Area-weighted centroid, struct(x, y); rings are summed with the sign of shell or hole. Null without area. A rectangle's is its middle."""
    a, b = _corners(parts)
    middle = F.expr(f"if(({b}.x - {a}.x) * ({b}.y - {a}.y) = 0, NULL, named_struct('x', ({a}.x + {b}.x) / 2, 'y', ({a}.y + {b}.y) / 2))")
    o = f"{parts}[0][0][0]"
    ring = (
        "aggregate(zip_with(slice(r, 1, greatest(size(r) - 1, 0)), slice(r, 2, greatest(size(r) - 1, 0)), (p, q) -> "
        f"named_struct('c', (p.x - {o}.x) * (q.y - {o}.y) - (q.x - {o}.x) * (p.y - {o}.y), 'sx', p.x + q.x - 2 * {o}.x, 'sy', p.y + q.y - 2 * {o}.y)), "
        "named_struct('a', 0D, 'x', 0D, 'y', 0D), (s, e) -> named_struct('a', s.a + e.c, 'x', s.x + e.sx * e.c, 'y', s.y + e.sy * e.c))"
    )
    signed = f"flatten(transform({parts}, g -> transform(transform(g, r -> {ring}), (m, i) -> named_struct('a', m.a * sign(m.a) * if(i = 0, 1, -1), 'x', m.x * sign(m.a) * if(i = 0, 1, -1), 'y', m.y * sign(m.a) * if(i = 0, 1, -1)))))"
    total = f"aggregate({signed}, named_struct('a', 0D, 'x', 0D, 'y', 0D), (s, m) -> named_struct('a', s.a + m.a, 'x', s.x + m.x, 'y', s.y + m.y), s -> if(s.a = 0, NULL, named_struct('x', {o}.x + s.x / (3 * nullif(s.a, 0)), 'y', {o}.y + s.y / (3 * nullif(s.a, 0)))))"
    return F.when(is_box(parts), middle).otherwise(F.expr(total))


def contains_sql(parts: str, x: str, y: str) -> str:
    crossed = f"(e.ay > {y}) <> (e.by > {y}) AND {x} < (e.bx - e.ax) * ({y} - e.ay) / nullif(e.by - e.ay, 0) + e.ax"
    return f"(size(filter({edges_sql(parts)}, e -> {crossed})) % 2 = 1)"


def contains_point(parts: str, x: str, y: str) -> Column:
    return F.expr(contains_sql(parts, x, y))


def _along(x: str, y: str) -> str:
    """Place of the point's foot on edge e, 0 to 1."""
    return f"greatest(0D, least(1D, coalesce((({x} - e.ax) * (e.bx - e.ax) + ({y} - e.ay) * (e.by - e.ay)) / nullif((e.bx - e.ax) * (e.bx - e.ax) + (e.by - e.ay) * (e.by - e.ay), 0), 0D)))"


def boundary_distance2_sql(parts: str, x: str, y: str) -> str:
    feet = f"transform({edges_sql(parts)}, e -> named_struct('t', {_along(x, y)}, 'e', e))"
    return f"array_min(transform({feet}, f -> pow(f.e.ax + f.t * (f.e.bx - f.e.ax) - {x}, 2) + pow(f.e.ay + f.t * (f.e.by - f.e.ay) - {y}, 2)))"


def point_distance(parts: str, x: str, y: str) -> Column:
    """Distance of a point from a polygon, 0 inside."""
    return F.expr(f"if({contains_sql(parts, x, y)}, 0D, sqrt({boundary_distance2_sql(parts, x, y)}))")


def closest_point(parts: str, x: str, y: str) -> Column:
    """The boundary's point nearest to (x, y), struct(x, y); the first edge counts where several are as near."""
    feet = f"transform({edges_sql(parts)}, (e, i) -> named_struct('t', {_along(x, y)}, 'e', e, 'i', i))"
    near = f"transform({feet}, f -> named_struct('d', pow(f.e.ax + f.t * (f.e.bx - f.e.ax) - {x}, 2) + pow(f.e.ay + f.t * (f.e.by - f.e.ay) - {y}, 2), 'i', f.i, 'x', f.e.ax + f.t * (f.e.bx - f.e.ax), 'y', f.e.ay + f.t * (f.e.by - f.e.ay)))"
    return F.expr(f"transform(array(array_min({near})), m -> named_struct('x', m.x, 'y', m.y))[0]")


def bbox_distance2(x0: str, y0: str, x1: str, y1: str, x: str, y: str) -> Column:
    """Squared distance of a point from a box; the cheap test before an exact one."""
    return F.expr(f"pow(greatest({x0} - {x}, 0D, {x} - {x1}), 2) + pow(greatest({y0} - {y}, 0D, {y} - {y1}), 2)")


def is_box(parts: str) -> Column:
    """Whether a polygon is one rectangle along the axes: a ring of four corners of which each shares x with one neighbour and y
    with the other. Where both sides of a test are, closed forms of their boxes take the place of the general expressions."""
    # the ring is named once: an expression of all its corners' paths is too long a method for the JVM to compile
    at = lambda i: f"get(r, {i})"  # noqa: E731  null where there is none
    turn = lambda i, j, k: f"(({at(i)}.x = {at(j)}.x AND {at(j)}.y = {at(k)}.y) OR ({at(i)}.y = {at(j)}.y AND {at(j)}.x = {at(k)}.x))"
    return F.expr(f"coalesce(size({parts}) = 1 AND size(get({parts}, 0)) = 1 AND size(get(get({parts}, 0), 0)) = 5 AND exists(get({parts}, 0), r -> {turn(0, 1, 2)} AND {turn(1, 2, 3)} AND {turn(2, 3, 4)}), false)")


def is_own_box(parts: str, box: tuple[str, str, str, str]) -> Column:
    """``is_box`` where most polygons are the ring that ``rect`` draws around their box: those are told by comparing the two."""
    return F.coalesce(F.col(parts) == rect(*box), F.lit(False)) | is_box(parts)


def unless_box(parts: str) -> Column:
    """The polygon, or null if it is its box: what a shuffle need not carry."""
    return F.when(~is_box(parts), F.col(parts)).alias(parts)


def or_box(parts: str, box: tuple[str, str, str, str]) -> str:
    """SQL of what ``unless_box`` left out, from the box again."""
    return f"coalesce({parts}, {rect_sql(*box)})"


def in_polygon(parts: str, flag: str, box: tuple[str, str, str, str], x: str, y: str) -> Column:
    """``contains_point``; of rectangles (``flag``) in closed form."""
    x0, y0, x1, y1 = box
    return F.when(F.col(flag), F.expr(f"{x} >= {x0} AND {x} < {x1} AND {y} >= {y0} AND {y} < {y1}")).otherwise(contains_point(parts, x, y))


def box_gap(a: tuple[str, str, str, str], b: tuple[str, str, str, str]) -> Column:
    """Distance of two boxes, 0 where they touch or overlap."""
    gap = lambda k: f"greatest({a[k]} - {b[k + 2]}, 0D, {b[k]} - {a[k + 2]})"
    return F.expr(f"sqrt(pow({gap(0)}, 2) + pow({gap(1)}, 2))")


def nearest_boundary_point(parts: str, flag: str, box: tuple[str, str, str, str], x: str, y: str) -> Column:
    """``closest_point``; of rectangles (``flag``) in closed form, for points outside."""
    x0, y0, x1, y1 = box
    beside = f"({x} <= {x0} OR {x} >= {x1} OR {y} <= {y0} OR {y} >= {y1})"
    clamped = F.expr(f"named_struct('x', greatest({x0}, least({x}, {x1})), 'y', greatest({y0}, least({y}, {y1})))")
    return F.when(F.expr(f"{flag} AND {beside}"), clamped).otherwise(closest_point(parts, x, y))


def way_within(parts: str, flag: str, box: tuple[str, str, str, str], start: tuple[str, str], end: tuple[str, str]) -> Column:
    """``segment_cuts`` of the way from start to end; of rectangles (``flag``) in closed form."""
    lo, hi, out = ["0D"], ["1D"], []
    for a, b, low, high in ((start[0], end[0], box[0], box[2]), (start[1], end[1], box[1], box[3])):
        at = [f"({edge} - {a}) / nullif({b} - {a}, 0)" for edge in (low, high)]
        # least and greatest pass over nulls: along an axis that the way does not move on, it is within all along or not at all
        lo.append(f"least({at[0]}, {at[1]})")
        hi.append(f"greatest({at[0]}, {at[1]})")
        out.append(f"({a} = {b} AND ({a} < {low} OR {a} > {high}))")
    first, last = f"greatest({', '.join(lo)})", f"least({', '.join(hi)})"
    clipped = F.expr(f"if({' OR '.join(out)} OR {first} > {last}, NULL, named_struct('lo', {first}, 'hi', {last}))")
    return F.when(F.col(flag), clipped).otherwise(segment_cuts(parts, *start, *end))


def _crossing(e: str, g: str) -> str:
    """Whether two edges touch or cross, by orientation; collinear overlaps are found by their end points' distance of 0."""
    side = lambda a, x, y: f"(({a}.bx - {a}.ax) * ({y} - {a}.ay) - ({a}.by - {a}.ay) * ({x} - {a}.ax))"
    return f"(sign({side(e, f'{g}.ax', f'{g}.ay')}) * sign({side(e, f'{g}.bx', f'{g}.by')}) < 0 AND sign({side(g, f'{e}.ax', f'{e}.ay')}) * sign({side(g, f'{e}.bx', f'{e}.by')}) < 0)"


def polygon_distance(a: str, b: str) -> Column:
    """Distance of two polygons, 0 where they touch or overlap (one may lie inside the other)."""
    corner = lambda g: f"flatten(flatten({g}))"
    crossing = f"exists({edges_sql(a)}, e -> exists({edges_sql(b)}, g -> {_crossing('e', 'g')}))"
    inside = f"exists({corner(b)}, c -> {contains_sql(a, 'c.x', 'c.y')}) OR exists({corner(a)}, c -> {contains_sql(b, 'c.x', 'c.y')})"
    apart = f"sqrt(least(array_min(transform({corner(b)}, c -> {boundary_distance2_sql(a, 'c.x', 'c.y')})), array_min(transform({corner(a)}, c -> {boundary_distance2_sql(b, 'c.x', 'c.y')}))))"
    return F.expr(f"if({crossing} OR {inside}, 0D, {apart})")


def polygons_intersect(a: str, b: str) -> Column:
    """Whether two polygons share a point; touching counts."""
    return polygon_distance(a, b) == 0


def segment_cuts(parts: str, ax: str, ay: str, bx: str, by: str) -> Column:
    """Where the segment a-b is inside a polygon, as struct(lo, hi) of the first and last place from 0 to 1; null if it misses.

    Places are those of its crossings with edges, and its own ends where they are inside. Between
    lo and hi the segment may leave a concave polygon; for a function that is linear along the
    segment, both ends are attained.
    """
    dx, dy = f"({bx} - {ax})", f"({by} - {ay})"
    det = f"({dx} * (e.by - e.ay) - {dy} * (e.bx - e.ax))"
    t = f"(((e.ax - {ax}) * (e.by - e.ay) - (e.ay - {ay}) * (e.bx - e.ax)) / nullif({det}, 0))"
    u = f"(((e.ax - {ax}) * {dy} - (e.ay - {ay}) * {dx}) / nullif({det}, 0))"
    crossings = f"transform(filter({edges_sql(parts)}, e -> {t} BETWEEN 0 AND 1 AND {u} BETWEEN 0 AND 1), e -> {t})"
    # along an edge: the stretch that both share
    along = lambda x, y: f"(({x} - {ax}) * {dx} + ({y} - {ay}) * {dy}) / nullif({dx} * {dx} + {dy} * {dy}, 0)"
    p, q = along("e.ax", "e.ay"), along("e.bx", "e.by")
    stretches = f"transform(filter({edges_sql(parts)}, e -> {det} = 0 AND (e.ax - {ax}) * {dy} = (e.ay - {ay}) * {dx}), e -> array(greatest(0D, least({p}, {q})), least(1D, greatest({p}, {q}))))"
    on = f"flatten(filter({stretches}, s -> s[0] <= s[1]))"
    ends = f"filter(array(if({contains_sql(parts, ax, ay)}, 0D, NULL), if({contains_sql(parts, bx, by)}, 1D, NULL)), v -> v IS NOT NULL)"
    return F.expr(f"transform(array(concat({crossings}, {on}, {ends})), v -> if(size(v) = 0, NULL, named_struct('lo', array_min(v), 'hi', array_max(v))))[0]")


def convex_buffer_area(parts: str, radius: float, quad_segs: int | None = None) -> Column:
    """Area of a convex polygon grown by ``radius``; corners are arcs, or polygons of quad_segs edges a quarter."""
    import math

    corner = math.pi * radius**2 if quad_segs is None else 2 * quad_segs * radius**2 * math.sin(math.pi / (2 * quad_segs))
    return area(parts) + perimeter(parts) * F.lit(float(radius)) + F.lit(corner)
