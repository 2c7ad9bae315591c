"""Polygon functions as Column expressions.

A polygon is ``array<ring>``, a ring ``array<struct<x,y>>`` whose last point
repeats the first.  Rings follow the even-odd rule: one inside another is a hole,
one apart is another part, whatever their order and orientation.  Short
rings are handled by array functions; nothing here leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row, even where the
    optimizer would inline it into a filter or a lambda."""
    return F.transform(F.array(value), use)[0]


def point(x, y) -> Column:
    return F.struct(_col(x).cast("double").alias("x"), _col(y).cast("double").alias("y"))


def rectangle(x0, y0, x1, y1) -> Column:
    return F.array(F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1),
                           point(x0, y0)))


def _edges(ring: Column) -> Column:
    n = F.size(ring)
    return F.zip_with(F.slice(ring, F.lit(1), n - 1), F.slice(ring, F.lit(2), n - 1),
                      lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"),
                                            b["x"].alias("bx"), b["y"].alias("by")))


def all_edges(poly) -> Column:
    """Edges of every ring, as array<struct<ax,ay,bx,by>>."""
    return F.flatten(F.transform(_col(poly), _edges))


def _sum(items: Column, of) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda acc, e: acc + of(e))


def _ring_area(ring: Column) -> Column:
    # coordinates are taken relative to the first point: projected coordinates
    # are large and their raw cross products would cancel badly
    o = ring[0]
    return F.abs(_sum(_edges(ring), lambda e: (e["ax"] - o["x"]) * (e["by"] - o["y"])
                      - (e["bx"] - o["x"]) * (e["ay"] - o["y"]))) / 2


def _sign(poly: Column, ring: Column, i: Column) -> Column:
    """1 for the outline of a part, -1 for a hole: by the number of other rings
    around the middle of the ring's first edge."""
    x, y = (ring[0]["x"] + ring[1]["x"]) / 2, (ring[0]["y"] + ring[1]["y"]) / 2
    around = F.aggregate(F.sequence(F.lit(0), F.size(poly) - 1), F.lit(0), lambda n, j: n + F.when(
        (j != i) & edges_contain(_edges(F.get(poly, j)), x, y), 1).otherwise(0))
    return F.when((F.size(poly) == 1) | (around % 2 == 0), F.lit(1.0)).otherwise(F.lit(-1.0))


def parts(poly) -> Column:
    """The polygon's parts, each an outline and the holes right inside it, as
    array<array<ring>>: a ring inside an even number of others is an outline."""
    def grouped(poly: Column) -> Column:
        def place(ring: Column, i: Column) -> Column:
            x, y = (ring[0]["x"] + ring[1]["x"]) / 2, (ring[0]["y"] + ring[1]["y"]) / 2
            around = F.aggregate(F.sequence(F.lit(0), F.size(poly) - 1), F.lit(0), lambda n, j: n + F.when(
                (j != i) & edges_contain(_edges(F.get(poly, j)), x, y), 1).otherwise(0))
            return F.struct(ring.alias("ring"), around.alias("depth"), x.alias("x"), y.alias("y"))

        def part(o: Column, placed: Column) -> Column:
            holes = F.filter(placed, lambda h: (h["depth"] == o["depth"] + 1)
                             & edges_contain(_edges(o["ring"]), h["x"], h["y"]))
            return F.concat(F.array(o["ring"]), F.transform(holes, lambda h: h["ring"]))

        return let(F.transform(poly, place), lambda placed: F.transform(
            F.filter(placed, lambda o: o["depth"] % 2 == 0), lambda o: part(o, placed)))

    return let(_col(poly), lambda p: F.when(F.size(p) > 1, grouped(p)).when(p.isNotNull(), F.array(p)))


def area(poly) -> Column:
    """Area of all parts without their holes."""
    return let(_col(poly), lambda p: F.aggregate(
        F.transform(p, lambda ring, i: _sign(p, ring, i) * _ring_area(ring)), F.lit(0.0), lambda acc, a: acc + a))


def centroid(poly) -> Column:
    """Area-weighted centroid as struct<x,y>; holes weigh negatively."""
    return let(_col(poly), _centroid)


def _centroid(poly: Column) -> Column:
    base = poly[0][0]

    def moments(ring: Column, i: Column) -> Column:
        def cross(e):
            return ((e["ax"] - base["x"]) * (e["by"] - base["y"])
                    - (e["bx"] - base["x"]) * (e["ay"] - base["y"]))
        edges = _edges(ring)
        twice = _sum(edges, cross)
        sign = F.signum(twice) * _sign(poly, ring, i)
        return F.struct(
            (sign * twice).alias("a"),
            (sign * _sum(edges, lambda e: (e["ax"] + e["bx"] - 2 * base["x"]) * cross(e))).alias("mx"),
            (sign * _sum(edges, lambda e: (e["ay"] + e["by"] - 2 * base["y"]) * cross(e))).alias("my"))

    def finish(rings: Column) -> Column:
        total = _sum(rings, lambda r: r["a"])
        return F.struct((base["x"] + _sum(rings, lambda r: r["mx"]) / (3 * total)).alias("x"),
                        (base["y"] + _sum(rings, lambda r: r["my"]) / (3 * total)).alias("y"))

    return let(F.transform(poly, moments), finish)


def bbox(poly) -> Column:
    def box(points: Column) -> Column:
        xs = F.transform(points, lambda p: p["x"])
        ys = F.transform(points, lambda p: p["y"])
        return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"),
                        F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))
    return let(F.flatten(_col(poly)), box)


def edges_contain(edges: Column, px: Column, py: Column) -> Column:
    """Even-odd rule; an edge owns its lower end (half-open), so that touching
    polygons never both claim a point."""
    def crosses(e):
        spans = (e["ay"] > py) != (e["by"] > py)
        at = (e["bx"] - e["ax"]) * (py - e["ay"]) / (e["by"] - e["ay"]) + e["ax"]
        return F.when(spans, px < at).otherwise(F.lit(False))
    return F.aggregate(edges, F.lit(False), lambda inside, e: inside != crosses(e))


def contains(poly, px, py) -> Column:
    return let(all_edges(poly), lambda edges: edges_contain(edges, _col(px), _col(py)))


def edges_distance(edges: Column, px: Column, py: Column) -> Column:
    def gap(e):
        dx, dy = e["bx"] - e["ax"], e["by"] - e["ay"]
        along = F.when((dx == 0) & (dy == 0), F.lit(0.0)).otherwise(
            ((px - e["ax"]) * dx + (py - e["ay"]) * dy) / (dx * dx + dy * dy))
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
        qx, qy = px - (e["ax"] + t * dx), py - (e["ay"] + t * dy)
        return qx * qx + qy * qy
    return F.sqrt(F.array_min(F.transform(edges, gap)))


def edge_distance(poly, px, py) -> Column:
    return let(all_edges(poly), lambda edges: edges_distance(edges, _col(px), _col(py)))


def inset_contains(poly, px, py, inset) -> Column:
    """Is the point inside the polygon shrunk by ``inset``?  Shrinking by a
    disc keeps exactly the inner points at least ``inset`` from every edge."""
    px, py = _col(px), _col(py)
    return let(all_edges(poly), lambda edges: edges_contain(edges, px, py)
               & (edges_distance(edges, px, py) >= F.lit(float(inset))))


def scan_row(edges: Column, y: Column, inset: float = 0.0, strict: bool = False) -> Column:
    """What one horizontal line needs to know about a polygon: the x of its
    edge crossings and, per edge nearer than ``inset``, the x interval that is
    too close to it (``strict``: exactly the inset is too close as well).
    Testing a point of the line then costs a few compares instead of a pass
    over all edges."""
    def crossing(e):
        return (e["bx"] - e["ax"]) * (y - e["ay"]) / (e["by"] - e["ay"]) + e["ax"]

    xs = F.transform(F.filter(edges, lambda e: (e["ay"] > y) != (e["by"] > y)), crossing)
    if inset <= 0:
        near = F.array().cast("array<struct<lo:double,hi:double>>")
        return F.struct(xs.alias("xs"), near.alias("near"))
    d = F.lit(float(inset))

    def too_close(edge):
        step = F.struct((edge["bx"] - edge["ax"]).alias("dx"), (edge["by"] - edge["ay"]).alias("dy"))
        return let(step, lambda s: capsule(edge, s["dx"], s["dy"], F.sqrt(
            s["dx"] * s["dx"] + s["dy"] * s["dy"])))

    def capsule(e, dx, dy, length):
        reach = lambda v: F.when(F.abs(y - v) <= d, F.sqrt(d * d - (y - v) * (y - v)))

        def side(sign: float) -> Column:
            # the edge moved sideways by the inset, where it meets the line
            sy = e["ay"] + sign * d * dx / length
            sx = e["ax"] - sign * d * dy / length
            meets = (dy != 0) & (F.least(sy, sy + dy) <= y) & (y <= F.greatest(sy, sy + dy))
            return F.when(meets, sx + (y - sy) * dx / dy)

        ra, rb = reach(e["ay"]), reach(e["by"])
        # all points closer than the inset form a convex capsule: the line
        # cuts it in one interval, spanned by these points
        ends = F.array(e["ax"] - ra, e["ax"] + ra, e["bx"] - rb, e["bx"] + rb, side(1.0), side(-1.0))
        return let(ends, lambda v: F.struct(F.array_min(v).alias("lo"), F.array_max(v).alias("hi")))

    def within(e):
        low, high = F.least(e["ay"], e["by"]) - d, F.greatest(e["ay"], e["by"]) + d
        return (low <= y) & (y <= high) if strict else (low < y) & (y < high)

    reached = F.filter(edges, lambda e: within(e) & ((e["ax"] != e["bx"]) | (e["ay"] != e["by"])))
    return F.struct(xs.alias("xs"), F.transform(reached, too_close).alias("near"))


def on_row(scan: Column, x: Column, strict: bool = False) -> Column:
    """Is (x, y of the scan) inside, at least (``strict``: more than) the
    inset away from every edge?"""
    hit = F.aggregate(scan["xs"], F.lit(False), lambda odd, at: odd != (x < at))
    close = ((lambda g: (g["lo"] <= x) & (x <= g["hi"])) if strict
             else (lambda g: (g["lo"] < x) & (x < g["hi"])))
    return hit & ~F.exists(scan["near"], close)


def keep_if(value: Column, test) -> Column:
    """Generator: one row with ``value`` where ``test(value)``, else no row.
    Unlike a filter on a computed column it computes the value once."""
    return F.explode(F.filter(F.array(value), test))


def map_points(poly, f) -> Column:
    """Apply ``f(x, y) -> (x, y)`` to every vertex."""
    def move(p):
        x, y = f(p["x"], p["y"])
        return F.struct(x.alias("x"), y.alias("y"))
    return F.transform(_col(poly), lambda ring: F.transform(ring, move))


def _number(c: Column) -> Column:
    text = F.format_string("%.3f", c)
    return F.regexp_replace(F.regexp_replace(text, "0+$", ""), r"\.$", "")


def as_text(poly) -> Column:
    """Well-known text with at most three decimals."""
    def ring_text(ring):
        pts = F.transform(ring, lambda p: F.concat(_number(p["x"]), F.lit(" "), _number(p["y"])))
        return F.concat(F.lit("("), F.array_join(pts, ", "), F.lit(")"))

    def part_text(rings):
        return F.concat(F.lit("("), F.array_join(F.transform(rings, ring_text), ", "), F.lit(")"))

    return let(F.transform(parts(poly), part_text), lambda texts: F.when(
        F.size(texts) == 1, F.concat(F.lit("POLYGON "), texts[0])).otherwise(
        F.concat(F.lit("MULTIPOLYGON ("), F.array_join(texts, ", "), F.lit(")"))))


def _positions(rings: Column) -> Column:
    return F.transform(rings, lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"])))


def as_geojson(poly, whole) -> Column:
    """JSON text of ``whole(geometry)``: the geometry is a struct<type, coordinates>, a
    Polygon, or a MultiPolygon if there are several parts."""
    def geometry(kind: str, coordinates: Column) -> Column:
        return F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates"))

    return let(parts(poly), lambda p: F.when(
        F.size(p) > 1, F.to_json(whole(geometry("MultiPolygon", F.transform(p, _positions))))).otherwise(
        F.to_json(whole(geometry("Polygon", _positions(F.get(p, F.lit(0))))))))


def utm_zone(lon) -> Column:
    return (F.floor((_col(lon) + 180) / 6) + 1).cast("int")


def tile_name(grid_code) -> Column:
    return F.regexp_replace(_col(grid_code), "^MGRS-", "")


def tile_zone(tile) -> Column:
    return F.substring(_col(tile), 1, 2).cast("int")


def tile_epsg(tile) -> Column:
    return (tile_zone(tile) + 32600).cast("int")
