"""Arrangements of polygons: cells along edges, cuts at crossings, union, difference, rings, hulls.

Polygons are edge tables whose inside lies to the left (outer rings counter-clockwise, holes reversed).
Points are kept to ``SNAP``; edges meet in buckets along their course, never by polygon, so a polygon of
many edges is as good as many small ones. A ring is put together in one task, as it is one row at last.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellweave.domain import Domain
from cellweave.operators.components import connected_components
from cellweave.operators.spatial import inside
from cellweave.session import cut

#: Coordinates are rounded to so many decimals; points closer to an edge than ``NEAR`` lie on it.
SNAP, NEAR = 6, 2e-6
ENDS = ["xa", "ya", "xb", "yb"]


def snapped(edges: DataFrame) -> DataFrame:
    """gid and ends, rounded; edges of no length fall away."""
    return edges.select("gid", *[F.round(c, SNAP).alias(c) for c in ENDS]).filter("xa <> xb or ya <> yb")


def touched(edges: DataFrame, size: float, pad: float = 1e-5) -> DataFrame:
    """``edges`` with bx, by: every bucket within ``pad`` of an edge, column by column along its course."""
    fl = lambda c: F.floor(c / size).cast("int")
    xa, ya, xb, yb = map(F.col, ENDS)
    lo, hi = F.least(xa, xb), F.greatest(xa, xb)
    e = edges.withColumn("bx", F.explode(F.sequence(fl(lo - pad), fl(hi + pad))))
    slope = (yb - ya) / F.when(xb == xa, None).otherwise(xb - xa)
    at = lambda x: F.when(xb == xa, None).otherwise(ya + (F.greatest(lo, F.least(hi, x)) - xa) * slope)
    u, v = F.coalesce(at(F.col("bx") * size - pad), ya), F.coalesce(at((F.col("bx") + 1) * size + pad), yb)
    return e.withColumn("by", F.explode(F.sequence(fl(F.least(u, v) - pad), fl(F.greatest(u, v) + pad))))


def split(edges: DataFrame, size: float = 20.0, alone: Column | None = None) -> DataFrame:
    """gid and ends of the pieces of ``edges`` between all points where they meet or cross each other.

    Ends that lie on another edge cut it there; other crossings are computed once for both edges. Edges that are
    ``alone`` never meet each other, only the others; where they run along one, they take all its points, so pieces match.
    """
    e = cut(snapped(edges).withColumn("eid", F.monotonically_increasing_id()))
    keyed = touched(e.select("eid", *ENDS, (F.lit(False) if alone is None else alone).alias("alone")), size)
    p, q = keyed.filter(~F.col("alone")).alias("p"), keyed.alias("q")
    pairs = p.join(q, (F.col("p.bx") == F.col("q.bx")) & (F.col("p.by") == F.col("q.by")) & (F.col("q.alone") | (F.col("p.eid") < F.col("q.eid"))))
    box = lambda a, b, s: F.least(F.col(f"{s}.{a}"), F.col(f"{s}.{b}"))
    top = lambda a, b, s: F.greatest(F.col(f"{s}.{a}"), F.col(f"{s}.{b}"))
    meet = [(box(a, b, s) <= top(a, b, r) + NEAR) for a, b in (("xa", "xb"), ("ya", "yb")) for s, r in (("p", "q"), ("q", "p"))]
    pairs = pairs.filter(meet[0] & meet[1] & meet[2] & meet[3]).select(F.col("p.eid").alias("e"), F.col("q.eid").alias("f"), F.col("q.alone").alias("alone"), *[F.col(f"{s}.{c}").alias(s + c) for s in "pq" for c in ENDS]).distinct()

    def near(x: str, y: str, s: str) -> Column:
        ax, ay, bx, by = (F.col(s + c) for c in ENDS)
        vx, vy = bx - ax, by - ay
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((F.col(x) - ax) * vx + (F.col(y) - ay) * vy) / (vx * vx + vy * vy)))
        ex, ey = F.col(x) - ax - t * vx, F.col(y) - ay - t * vy
        return ex * ex + ey * ey <= NEAR * NEAR

    ends = [(f"{s}x{k}", f"{s}y{k}", r, eid) for s, r, eid in (("q", "p", "e"), ("p", "q", "f")) for k in "ab"]
    pairs = cut(pairs.select("*", *[near(x, y, r).alias(f"n{n}") for n, (x, y, r, _) in enumerate(ends)]))
    points = [pairs.filter(f"n{n}").select(F.col(eid).alias("eid"), F.col(x).alias("x"), F.col(y).alias("y")) for n, (x, y, _, eid) in enumerate(ends)]
    rx, ry, sx, sy = F.col("pxb") - F.col("pxa"), F.col("pyb") - F.col("pya"), F.col("qxb") - F.col("qxa"), F.col("qyb") - F.col("qya")
    wx, wy, det = F.col("qxa") - F.col("pxa"), F.col("qya") - F.col("pya"), rx * sy - ry * sx
    t, u = F.try_divide(wx * sy - wy * sx, det), F.try_divide(wx * ry - wy * rx, det)
    free = pairs.filter("not (n0 or n1 or n2 or n3)").filter(t.between(0, 1) & u.between(0, 1))
    cross = free.select("e", "f", F.round(F.col("pxa") + t * rx, SNAP).alias("x"), F.round(F.col("pya") + t * ry, SNAP).alias("y"))
    points = reduce(DataFrame.unionByName, [*points, cross.select(F.explode(F.array("e", "f")).alias("eid"), "x", "y")])
    if alone is not None:
        along = pairs.filter("alone and int(n0) + int(n1) + int(n2) + int(n3) > 1").select(F.col("e").alias("eid"), "f", *["q" + c for c in ENDS])
        points = points.unionByName(points.join(along, "eid").filter(near("x", "y", "q")).select(F.col("f").alias("eid"), "x", "y"))
    own = e.select("eid", F.explode(F.array(*[F.struct(F.col("x" + k).alias("x"), F.col("y" + k).alias("y")) for k in "ab"])).alias("o")).select("eid", "o.x", "o.y")
    points = points.unionByName(own).distinct().join(e, "eid")
    t = (F.col("x") - F.col("xa")) * (F.col("xb") - F.col("xa")) + (F.col("y") - F.col("ya")) * (F.col("yb") - F.col("ya"))
    w = W.partitionBy("eid").orderBy("t", "x", "y")
    pieces = points.withColumn("t", t).select("gid", F.col("x").alias("xa"), F.col("y").alias("ya"), F.lead("x").over(w).alias("xb"), F.lead("y").over(w).alias("yb"))
    return pieces.filter("xb is not null").filter("xa <> xb or ya <> yb")


def _lines(pieces: DataFrame) -> DataFrame:
    """Pieces with ``ends`` in a fixed order and ``ahead``: whether they run along it."""
    ahead = (F.col("xa") < F.col("xb")) | ((F.col("xa") == F.col("xb")) & (F.col("ya") < F.col("yb")))
    a, b = F.struct(F.col("xa").alias("x"), F.col("ya").alias("y")), F.struct(F.col("xb").alias("x"), F.col("yb").alias("y"))
    return pieces.select("gid", F.when(ahead, F.struct(a.alias("a"), b.alias("b"))).otherwise(F.struct(b.alias("a"), a.alias("b"))).alias("ends"), ahead.alias("ahead"))


def _middles(ends: DataFrame) -> DataFrame:
    mid = lambda c: (F.col("ends.a." + c) + F.col("ends.b." + c)) / 2
    return ends.select("ends", F.xxhash64("ends").alias("pid"), mid("x").alias("x"), mid("y").alias("y"))


def _grid(size: float) -> Domain:
    return Domain(1, 1, size, size, size, 0.0, 0.0)


def _directed(ends: DataFrame, ahead: str) -> DataFrame:
    pick = lambda p, q, c: F.when(F.col(ahead), F.col(f"ends.{p}.{c}")).otherwise(F.col(f"ends.{q}.{c}"))
    return ends.withColumns({"xa": pick("a", "b", "x"), "ya": pick("a", "b", "y"), "xb": pick("b", "a", "x"), "yb": pick("b", "a", "y")})


def dissolve(edges: DataFrame, size: float = 20.0) -> DataFrame:
    """xa, ya, xb, yb: the outline of the union of polygons that may overlap, touch or hold each other.

    A piece stays if the union lies on one side only: all polygons that own it own the same side, and no
    other polygon covers its middle.
    """
    e = cut(snapped(edges))
    lines = cut(_lines(split(e, size)))
    sides = lines.groupBy("ends").agg(F.max("ahead").alias("ahead"), F.min("ahead").alias("all_ahead")).filter("ahead = all_ahead").select("ends", "ahead")
    middles = cut(_middles(sides.select("ends")))
    held = inside(middles.select("pid", "x", "y"), e, _grid(size), "pid")
    own = lines.select(F.xxhash64("ends").alias("pid"), "gid").distinct()
    covered = held.join(own, ["pid", "gid"], "left_anti").select("pid").distinct()
    kept = sides.withColumn("pid", F.xxhash64("ends")).join(covered, "pid", "left_anti")
    return _directed(kept, "ahead").select(*ENDS)


def clip(a: DataFrame, b: DataFrame, keep: str, size: float = 20.0) -> DataFrame:
    """gid and ends: each polygon of ``a`` without (``keep`` = "outside") or within ("inside") the polygons of ``b``.

    ``b`` must not overlap itself (an outline by ``dissolve`` does not); its gid is not used.
    """
    within = keep == "inside"
    a, b = cut(snapped(a)), cut(snapped(b.withColumn("gid", F.lit(0).cast("long"))))
    tag = lambda df, k: df.withColumn("gid", F.struct(F.lit(k).alias("s"), F.col("gid").cast("long").alias("g")))
    lines = cut(_lines(split(tag(a, 0).unionByName(tag(b, 1)), size, F.col("gid.s") == 0)))
    first, second = (lines.filter(F.col("gid.s") == k).select(F.col("gid.g").alias("gid"), "ends", "ahead") for k in (0, 1))
    second = second.groupBy("ends").agg(F.max("ahead").alias("b_ahead"))
    # pieces of a: on b's outline by direction, others by the place of their middle
    mine = first.join(second, "ends", "left")
    middles = cut(_middles(mine.filter("b_ahead is null").select("ends").distinct()))
    in_b = inside(middles.select("pid", "x", "y"), b, _grid(size), "pid").select("pid", F.lit(True).alias("held")).distinct()
    mine = mine.withColumn("pid", F.xxhash64("ends")).join(in_b, "pid", "left")
    good = F.when(F.col("b_ahead").isNotNull(), (F.col("ahead") == F.col("b_ahead")) == F.lit(within)).otherwise(F.coalesce("held", F.lit(False)) == F.lit(within))
    mine = _directed(mine.filter(good), "ahead").select("gid", *ENDS)
    # pieces of b in the inside of a polygon of a bound what is left of it, the other way round outside
    middles = cut(_middles(second.select("ends")))
    hold = inside(middles.select("pid", "x", "y"), a, _grid(size), "pid")
    hold = hold.join(first.select(F.xxhash64("ends").alias("pid"), "gid").distinct(), ["pid", "gid"], "left_anti")
    its = second.withColumn("pid", F.xxhash64("ends")).withColumn("ahead", F.col("b_ahead") == F.lit(within)).join(hold, "pid")
    return mine.unionByName(_directed(its, "ahead").select("gid", *ENDS))


def _trace(xa: np.ndarray, ya: np.ndarray, xb: np.ndarray, yb: np.ndarray) -> list[np.ndarray]:
    """Rings, as orders of directed edges, with the inside to their left; a ring that comes back to a point is two."""
    n = len(xa)
    names, node = np.unique(np.stack([np.concatenate([xa, xb]), np.concatenate([ya, yb])], 1), axis=0, return_inverse=True)
    node = node.reshape(-1)
    start, end = node[:n], node[n:]
    away, back = np.arctan2(yb - ya, xb - xa), np.arctan2(ya - yb, xa - xb)
    order = np.argsort(start, kind="stable")
    first = np.searchsorted(start[order], np.arange(len(names) + 1))
    used, out = np.zeros(n, bool), []
    for k in range(n):
        if used[k]:
            continue
        path, seen, at = [], {}, k
        while not used[at]:
            used[at] = True
            seen[start[at]] = len(path)
            path.append(at)
            if end[at] in seen:  # a loop is closed
                low = seen[end[at]]
                loop = path[low:]
                out.append(np.array(loop))
                for x in loop:
                    seen.pop(start[x], None)
                path = path[:low]
                if not path:
                    break
                at_node, came = end[loop[-1]], path[-1]
            else:
                at_node, came = end[at], at
            free = [x for x in order[first[at_node] : first[at_node + 1]] if not used[x]]
            if not free:
                raise ValueError("an outline is not closed")
            at = min(free, key=lambda x: (back[came] - away[x]) % (2 * math.pi) or 2 * math.pi)
    return out


RING = "part:int,area:double,points:array<struct<x:double,y:double>>"


def chain(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """keys, part, area, points: rings of the directed pieces of each group; area is negative for holes. Points on a straight line are left out.

    Groups are rows with their pieces, many in one batch of Python: most groups are small.
    """

    def run(row) -> list[dict]:
        xa, ya, xb, yb = np.array([[p[c] for c in ENDS] for p in row], float).T
        out = []
        for loop in _trace(xa, ya, xb, yb):
            x, y = xa[loop], ya[loop]
            area = float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum() / 2)
            px, py, nx, ny = np.roll(x, 1), np.roll(y, 1), np.roll(x, -1), np.roll(y, -1)
            bend = np.abs((x - px) * (ny - y) - (y - py) * (nx - x)) > NEAR * np.hypot(nx - px, ny - py)
            bend = bend if bend.sum() > 2 else np.ones(len(x), bool)
            out.append({"part": len(out), "area": area, "points": [{"x": p, "y": q} for p, q in zip(x[bend].tolist(), y[bend].tolist(), strict=True)]})
        return out

    @F.pandas_udf(f"array<struct<{RING}>>")
    def traced(many: pd.Series) -> pd.Series:
        return pd.Series([run(row) for row in many])

    groups = pieces.groupBy(*keys).agg(F.collect_list(F.struct(*ENDS)).alias("p"))
    return groups.select(*keys, F.explode(traced("p")).alias("r")).select(*keys, "r.part", "r.area", "r.points")


def rings(outline: DataFrame) -> DataFrame:
    """rid, area, points of the rings of an outline; pieces that hang together are chained together."""
    node = lambda k: F.xxhash64(F.struct("x" + k, "y" + k))
    e = cut(outline.select(*ENDS, node("a").alias("a"), node("b").alias("b")))
    roots = connected_components(e)
    made = chain(e.join(roots.withColumnRenamed("node", "a"), "a").select("root", *ENDS), ["root"])
    return cut(made.select(F.monotonically_increasing_id().alias("rid"), "area", "points"))


def ring_pieces(made: DataFrame, gid: str) -> DataFrame:
    """gid and ends of rings given by their points."""
    p = made.select(F.col(gid).alias("gid"), "points", F.posexplode("points").alias("k", "a"))
    b = F.element_at("points", (F.col("k") + 1) % F.size("points") + 1)
    return p.select("gid", F.col("a.x").alias("xa"), F.col("a.y").alias("ya"), b["x"].alias("xb"), b["y"].alias("yb"))


def footprints(made: DataFrame, size: float = 20.0) -> DataFrame:
    """gid (the outer ring's rid), ring (0: outer), area, points: each hole goes to the smallest outer ring around it."""
    outer, hole = made.filter("area > 0"), made.filter("area < 0")
    mid = lambda c: (F.col("points")[0][c] + F.col("points")[1][c]) / 2
    held = inside(hole.select("rid", mid("x").alias("x"), mid("y").alias("y")), ring_pieces(outer, "rid"), _grid(size), "rid")
    own = held.join(outer.select(F.col("rid").alias("gid"), F.col("area").alias("around")), "gid").groupBy("rid").agg(F.min_by("gid", F.struct("around", "gid")).alias("gid"))
    w = W.partitionBy("gid").orderBy("rid")
    holes = hole.join(own, "rid").select("gid", F.row_number().over(w).alias("ring"), "area", "points")
    return outer.select(F.col("rid").alias("gid"), F.lit(0).alias("ring"), "area", "points").unionByName(holes)


def polygon_edges(polygons: DataFrame) -> DataFrame:
    return ring_pieces(polygons, "gid")


def union_buildings(edges: DataFrame, tolerance: float = 0.0, size: float = 20.0) -> DataFrame:
    """gid, ring, area, points of the footprints of building polygons: touching and overlapping ones are one; rings are simplified by ``tolerance``."""
    made = rings(dissolve(edges, size))
    if tolerance > 0:
        from cellweave.operators.lines import simplify_points

        made = made.withColumn("points", simplify_points(F.col("points"), F.lit(tolerance), F.lit(True)))
        cross = F.aggregate(F.zip_with("points", F.concat(F.slice("points", F.lit(2), F.size("points")), F.slice("points", 1, 1)), lambda p, q: p["x"] * q["y"] - q["x"] * p["y"]), F.lit(0.0), lambda s, v: s + v)
        made = made.filter(F.size("points") > 2).withColumn("area", cross / 2)
    return footprints(made, size)


def members(polygons: DataFrame, points: DataFrame, size: float = 20.0, pid: str = "id") -> DataFrame:
    """pid, gid: the footprints that hold points."""
    return inside(points, polygon_edges(polygons), _grid(size), pid)


def _hull(x: np.ndarray, y: np.ndarray) -> list[tuple[float, float]]:
    """Corners counter-clockwise from the lowest x, by the monotone chain; points on a side are left out."""
    p = sorted(set(zip(x.tolist(), y.tolist(), strict=True)))
    if len(p) < 3:
        return p

    def half(points):
        out: list[tuple[float, float]] = []
        for q in points:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]):
                out.pop()
            out.append(q)
        return out[:-1]

    return half(p) + half(p[::-1])


def hulls(points: DataFrame, keys: list[str], salts: int = 32) -> DataFrame:
    """keys, x, y, at: corners of the convex hull of each group's points. Parts of a group shrink to their hulls before they meet.

    Groups are rows with their points, many in one batch of Python: most groups are small.
    """

    @F.pandas_udf("array<struct<x:double,y:double>>")
    def corners(many: pd.Series) -> pd.Series:
        return pd.Series([[{"x": x, "y": y} for x, y in _hull(np.array([p["x"] for p in row]), np.array([p["y"] for p in row]))] for row in many])

    p = F.collect_list(F.struct("x", "y"))
    if salts > 1:
        part = points.select(*keys, "x", "y", F.pmod(F.xxhash64("x", "y"), F.lit(salts)).alias("salt"))
        some = part.groupBy(*keys, "salt").agg(p.alias("p")).select(*keys, F.explode(corners("p")).alias("p"))
        points = some.select(*keys, "p.x", "p.y")
    h = points.groupBy(*keys).agg(p.alias("p")).select(*keys, F.posexplode(corners("p")).alias("at", "p"))
    return h.select(*keys, "p.x", "p.y", "at")


def pair_hulls(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """a, b, x, y, at: the convex hull around both polygons of each pair. Each polygon is its own hull first, so a polygon in many pairs is sent as few points."""
    own = cut(hulls(edges.select("gid", F.col("xa").alias("x"), F.col("ya").alias("y")), ["gid"]))
    both = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("gid")).join(own, "gid")
    return hulls(both.select("a", "b", "x", "y"), ["a", "b"], salts=1)


def hull_edges(corners: DataFrame, keys: list[str]) -> DataFrame:
    """keys and ends of hulls given by corners; hulls of fewer than three corners have none."""
    w, whole = W.partitionBy(*keys).orderBy("at"), W.partitionBy(*keys)
    nxt = lambda c: F.coalesce(F.lead(c).over(w), F.min_by(c, "at").over(whole)).alias(c + "b")
    return corners.select(*keys, F.col("x").alias("xa"), F.col("y").alias("ya"), nxt("x"), nxt("y"), F.count("*").over(whole).alias("n")).filter("n > 2").drop("n")


def final_footprints(edges: DataFrame, pairs: DataFrame, least: float, size: float = 20.0) -> DataFrame:
    """gid, ring, area, points: the union of buildings and of the hulls around near pairs; footprints under ``least`` square metres go, with their holes."""
    h = hull_edges(pair_hulls(edges, pairs), ["a", "b"]).select(F.struct(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).alias("gid"), *ENDS)
    own = edges.select(F.struct(F.col("gid").cast("long").alias("a"), F.lit(None).cast("long").alias("b")).alias("gid"), *ENDS)
    polygons = cut(union_buildings(own.unionByName(h), 0.0, size))
    large = polygons.groupBy("gid").agg(F.sum("area").alias("net")).filter(F.col("net") >= least)
    return polygons.join(large.select("gid"), "gid")


def reintegrate(land: DataFrame, types: DataFrame, footprint_edges: DataFrame, building: int, size: float = 20.0) -> DataFrame:
    """part (land or building), gid, type and ends of the new land cover: the old polygons outside the footprints with their types, and the footprints, cut to the old land cover, as ``building``."""
    outline = cut(dissolve(footprint_edges, size))
    rest = clip(land, outline, "outside", size).join(types.select("gid", "type"), "gid").select(F.lit("land").alias("part"), "gid", "type", *ENDS)
    ground = cut(dissolve(land, size)).withColumn("gid", F.lit(0))
    built = clip(footprint_edges, ground, "inside", size).select(F.lit("building").alias("part"), "gid", F.lit(building).alias("type"), *ENDS)
    return rest.unionByName(built)


def split_by_fishnet(edges: DataFrame, net: Domain, most: float) -> DataFrame:
    """gid, i, j, part, area, points: polygons larger than ``most`` cut along the net, the others whole (i, j null).

    In each cell, the pieces of a polygon's edges and the pieces of the cell's border that lie in it are
    chained to rings; cells that no edge meets are whole squares. Edges meet only the cells on their course.
    """
    from cellweave.operators.edges import areas
    from cellweave.operators.spatial import coverage, edge_cells

    e = cut(edges.select("gid", *ENDS))
    size = areas(e).select("gid", "area")
    large = cut(e.join(size.filter(F.col("area") > most).select("gid"), "gid"))
    small = e.join(size.filter(F.col("area") <= most).select("gid"), "gid")
    cells = cut(edge_cells(large, net).select("gid", "i", "j", *[F.round(c, SNAP).alias(c) for c in ENDS]).filter("xa <> xb or ya <> yb"))
    covered = cut(coverage(large, net).select("gid", "i", "j"))
    line = lambda k, o, d: F.round(F.col(k) * d + o, SNAP)
    x0, y0, x1, y1 = line("i", net.origin_x, net.dx), line("j", net.origin_y, net.dy), F.round((F.col("i") + 1) * net.dx + net.origin_x, SNAP), F.round((F.col("j") + 1) * net.dy + net.origin_y, SNAP)
    # an edge on a line of the net is seen from both cells, and bounds the one on its left
    on_x, on_y = (F.col("xa") == F.col("xb")) & (F.col("xa") == x0), (F.col("ya") == F.col("yb")) & (F.col("ya") == y0)
    west, south = on_x & (F.col("yb") > F.col("ya")), on_y & (F.col("xb") < F.col("xa"))
    seen = cells.withColumn("own", ~west & ~south).unionByName(cells.filter(on_x).select("gid", (F.col("i") - 1).alias("i"), "j", *ENDS, west.alias("own"))).unionByName(cells.filter(on_y).select("gid", "i", (F.col("j") - 1).alias("j"), *ENDS, south.alias("own")))
    seen = cut(seen.join(covered, ["gid", "i", "j"], "left_semi"))
    # points on the border, counter-clockwise
    corner = F.array(*[F.struct(F.lit(k).alias("side"), F.lit(0.0).alias("at"), a.alias("x"), b.alias("y")) for k, (a, b) in enumerate(((x0, y0), (x1, y0), (x1, y1), (x0, y1)))])
    corners = covered.select("gid", "i", "j", F.explode(corner).alias("p")).select("gid", "i", "j", "p.*")
    ends = seen.select("gid", "i", "j", F.explode(F.array(*[F.struct(F.col("x" + k).alias("x"), F.col("y" + k).alias("y")) for k in "ab"])).alias("p")).select("gid", "i", "j", "p.x", "p.y").distinct()
    side = F.when((F.col("y") == y0) & (F.col("x") < x1), 0).when((F.col("x") == x1) & (F.col("y") < y1), 1).when((F.col("y") == y1) & (F.col("x") > x0), 2).when((F.col("x") == x0), 3)
    along = F.when(side == 0, F.col("x") - x0).when(side == 1, F.col("y") - y0).when(side == 2, x1 - F.col("x")).otherwise(y1 - F.col("y"))
    on = ends.select("gid", "i", "j", side.alias("side"), along.alias("at"), "x", "y").filter("side is not null")
    w, whole = W.partitionBy("gid", "i", "j").orderBy("side", "at"), W.partitionBy("gid", "i", "j")
    nxt = lambda c: F.coalesce(F.lead(c).over(w), F.min_by(c, F.struct("side", "at")).over(whole))
    border = on.unionByName(corners).distinct().select("gid", "i", "j", F.col("x").alias("xa"), F.col("y").alias("ya"), nxt("x").alias("xb"), nxt("y").alias("yb"))
    turned = seen.select("gid", "i", "j", F.col("xb").alias("xa"), F.col("yb").alias("ya"), F.col("xa").alias("xb"), F.col("ya").alias("yb"))
    free = border.join(seen.select("gid", "i", "j", *ENDS).unionByName(turned), ["gid", "i", "j", *ENDS], "left_anti")
    free = cut(free.withColumn("pid", F.monotonically_increasing_id()))
    mid = free.select("pid", ((F.col("xa") + F.col("xb")) / 2).alias("x"), ((F.col("ya") + F.col("yb")) / 2).alias("y"))
    held = inside(mid, large, net, "pid")
    free = free.join(held, ["pid", "gid"], "left_semi").select("gid", "i", "j", *ENDS)
    made = chain(seen.filter("own").select("gid", "i", "j", *ENDS).unionByName(free), ["gid", "i", "j"])
    kept = chain(small.select("gid", *ENDS), ["gid"]).select("gid", F.lit(None).cast("int").alias("i"), F.lit(None).cast("int").alias("j"), "part", "area", "points")
    return made.unionByName(kept)
