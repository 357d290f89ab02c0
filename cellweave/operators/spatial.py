"""Spatial joins on integer cell keys."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellweave.domain import Domain
from cellweave.operators import edges as ed
from cellweave.operators.grid import cell_of
from cellweave.session import cut, shuffle_parts

#: Cells of the domain that one task makes and keeps in memory, at most where partitions are of one size.
CELLS_IN_TASK = 500_000


def tasks(spark: SparkSession, dom: Domain) -> int:
    """Partitions for work that follows the cells of the domain: with more cells more of them, not larger ones."""
    return max(shuffle_parts(spark), dom.nx * dom.ny // CELLS_IN_TASK)


def edge_cells(edges: DataFrame, dom: Domain, by: tuple[str, ...] = ("gid",)) -> DataFrame:
    """gid (or ``by``), i, j and ends of the pieces of edges in the cells on their course, direction kept; a piece on a line counts to the cell above it or to its right.

    Rows follow the length of edges, not the area of polygons. Pieces may be single points.
    """
    xa, ya, xb, yb = map(F.col, ("xa", "ya", "xb", "yb"))
    e = edges.select(*by, "xa", "ya", "xb", "yb", (xa <= xb).alias("ahead"))
    at = lambda a, b: F.when(F.col("ahead"), a).otherwise(b)
    e = e.select(*by, "ahead", at(xa, xb).alias("x0"), at(ya, yb).alias("y0"), at(xb, xa).alias("x1"), at(yb, ya).alias("y1"))
    x0, y0, x1, y1, i, j = map(F.col, ("x0", "y0", "x1", "y1", "i", "j"))
    fi, fj = lambda x: F.floor((x - dom.origin_x) / dom.dx).cast("int"), lambda y: F.floor((y - dom.origin_y) / dom.dy).cast("int")
    e = e.withColumn("i", F.explode(F.sequence(fi(x0), fi(x1))))
    l, r = F.greatest(x0, i * dom.dx + dom.origin_x), F.least(x1, (i + 1) * dom.dx + dom.origin_x)
    slope = (y1 - y0) / F.when(x1 == x0, None).otherwise(x1 - x0)
    y_at = lambda x: F.when((x1 == x0) | (x <= x0), y0).when(x >= x1, y1).otherwise(y0 + (x - x0) * slope)
    e = e.select(*by, "ahead", "i", l.alias("x0"), y_at(l).alias("y0"), r.alias("x1"), F.when(x1 == x0, y1).otherwise(y_at(r)).alias("y1"))
    low, high = F.least(y0, y1), F.greatest(y0, y1)
    e = e.withColumn("j", F.explode(F.sequence(fj(low), fj(high))))
    in_row = lambda y: F.greatest(j * dom.dy + dom.origin_y, F.least((j + 1) * dom.dy + dom.origin_y, y))
    u, v = in_row(y0), in_row(y1)
    x_at = lambda y: x0 + (y - y0) * (x1 - x0) / F.when(y1 == y0, None).otherwise(y1 - y0)
    e = e.select(*by, "ahead", "i", "j", F.when(u == y0, x0).when(u == y1, x1).otherwise(x_at(u)).alias("x0"), u.alias("y0"), F.when(v == y1, x1).when(v == y0, x0).otherwise(x_at(v)).alias("x1"), v.alias("y1"))
    return e.select(*by, "i", "j", at(x0, x1).alias("xa"), at(y0, y1).alias("ya"), at(x1, x0).alias("xb"), at(y1, y0).alias("yb"))


def inside(points: DataFrame, edges: DataFrame, dom: Domain, pid: str = "id") -> DataFrame:
    """pid, gid: every polygon that holds each point (x, y); left and lower borders belong to a polygon. Only the cell size of ``dom`` matters.

    A point's cell knows, for each polygon, how often the line up from its left border is crossed above it;
    crossings beside the point come from the pieces of edges in its own cell. Cells between the edges of a
    column are filled in by the running count, so neither points nor cells ever meet all edges of a polygon.
    """
    i, j = cell_of(F.col("x"), F.col("y"), dom)
    p = points.select(pid, "x", "y", i.alias("i"), j.alias("j"))
    pieces = edge_cells(edges, dom).filter("ya <> yb")
    xa, ya, xb, yb = map(F.col, ("xa", "ya", "xb", "yb"))
    lo, hi = F.least(xa, xb), F.greatest(xa, xb)
    first, last = F.ceil((lo - dom.origin_x) / dom.dx).cast("int"), F.ceil((hi - dom.origin_x) / dom.dx).cast("int")
    m = edges.filter(xa != xb).withColumn("i", F.explode(F.sequence(first, last)))
    x = F.col("i") * dom.dx + dom.origin_x
    m = m.filter((xa >= x) != (xb >= x)).select("gid", "i", (ya + (x - xa) * (yb - ya) / (xb - xa)).alias("y"))
    lines = m.withColumn("j", F.floor((F.col("y") - dom.origin_y) / dom.dy).cast("int"))
    # kind of crossing beside a point: a piece, or a line that is crossed at ya
    none = F.lit(None).cast("double")
    events = pieces.select("gid", "i", "j", "xa", "ya", "xb", "yb").unionByName(lines.select("gid", "i", "j", none.alias("xa"), F.col("y").alias("ya"), none.alias("xb"), none.alias("yb")))
    # sent once to their polygon's column, and from there once to the points as one row for each cell
    at = events.repartition("gid", "i").groupBy("gid", "i", "j").agg(F.count_if(F.col("xa").isNull()).alias("n"), F.collect_list(F.struct("xa", "ya", "xb", "yb")).alias("events"))
    w = W.partitionBy("gid", "i").orderBy(F.desc("j"))
    at = at.select("gid", "i", "j", "events", (F.sum("n").over(w) - F.col("n")).alias("above"), F.sum("n").over(w).alias("below"), F.lead("j").over(w).alias("next"))
    filled = F.when((F.col("below") % 2 == 1) & (F.col("next") + 1 <= F.col("j") - 1), F.sequence(F.col("next") + 1, F.col("j") - 1))
    full = F.transform(filled, lambda j: F.struct(j.alias("j"), F.lit(1).cast("long").alias("above"), F.slice("events", 1, 0).alias("events")))
    cells = at.select("gid", "i", F.explode(F.concat(F.array(F.struct("j", "above", "events")), F.coalesce(full, F.array()))).alias("c")).select("gid", "i", "c.*")

    def hit(e: Column) -> Column:
        y, xa, ya, xb, yb = F.col("y"), e["xa"], e["ya"], e["xb"], e["yb"]
        x_at = F.when(xa == xb, xa).otherwise(xa + (y - ya) * (xb - xa) / F.when(ya == yb, None).otherwise(yb - ya))
        return F.when(xa.isNull(), ya > y).otherwise(((ya > y) != (yb > y)) & (x_at <= F.col("x")))

    # exploded tables look small to the planner, so the join is told not to broadcast
    near = p.hint("merge").join(cells.hint("merge"), ["i", "j"])
    return near.filter((F.col("above") + F.size(F.filter("events", hit))) % 2 == 1).select(pid, "gid")


def points_in_polygons(points: DataFrame, edges: DataFrame, dom: Domain, pid: str = "id") -> DataFrame:
    """pid, gid: the lowest polygon that holds each point (x, y); borders are half open."""
    return inside(points, edges, dom, pid).groupBy(pid).agg(F.min("gid").alias("gid"))


def held_cells(dom: Domain, layers: dict[str, tuple[DataFrame, tuple[str, ...]]], whole: bool = False) -> DataFrame:
    """i, j and for each layer (its edges and columns of them to keep) the lowest polygon that holds the cell's centre, under the layer's name, with its columns; borders half open.

    Cells that no layer holds are left out, or null with ``whole``. Polygons meet the centres of a column in crossings, kept
    as the first centre above them; these are sent to their column, and cells are made there. So crossings are
    shuffled, but no cells, and one task has as many cells however large the domain is.
    """

    def first(v: Column, origin: float, step: float, n: int) -> Column:
        """The first of n centres that is not below v; n where there is none."""
        centre = lambda k: F.lit(origin) + k * step + step / 2
        k = F.ceil(F.greatest(F.lit(-1.0), F.least(F.lit(n + 1.0), (v - origin) / step - 0.5))).cast("int")
        k = F.when(centre(k - 1) >= v, k - 1).when(centre(k) < v, k + 1).otherwise(k)  # as the coordinates are rounded
        return F.greatest(F.lit(0), F.least(F.lit(n), k)).cast("int")

    xa, ya, xb, yb, x = *map(F.col, ("xa", "ya", "xb", "yb")), F.lit(dom.origin_x) + F.col("i") * dom.dx + dom.dx / 2
    parts, kept = [], [c for _, keep in layers.values() for c in keep]
    for n, (edges, keep) in enumerate(layers.values()):
        begin, end = (first(f(xa, xb), dom.origin_x, dom.dx, dom.nx) for f in (F.least, F.greatest))
        e = edges.select("gid", *keep, "xa", "ya", "xb", "yb", begin.alias("begin"), end.alias("end")).filter("begin < end")
        e = e.withColumn("i", F.explode(F.sequence(F.col("begin"), F.col("end") - 1)))
        level = first(ya + (x - xa) * (yb - ya) / (xb - xa), dom.origin_y, dom.dy, dom.ny)
        parts.append(e.select(F.lit(n).alias("layer"), "i", "gid", level.alias("j"), *keep))
    if whole:
        columns = edges.sparkSession.range(dom.nx).select(F.lit(-1).alias("layer"), F.col("id").cast("int").alias("i"), F.explode(F.array(F.lit(0), F.lit(dom.ny))).alias("j"))
        parts.append(columns)
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    rows = rows.repartition(tasks(edges.sparkSession, dom), "i")
    w = W.partitionBy("i", "layer", "gid").orderBy("j")
    spans = rows.select("*", F.row_number().over(w).alias("n"), F.lead("j").over(w).alias("end")).filter("n % 2 = 1 and j < end")
    cells = spans.select("layer", "i", F.explode(F.sequence(F.col("j"), F.col("end") - 1)).alias("j"), "gid", *kept)
    own = lambda n: F.when(F.col("layer") == n, F.col("gid"))
    best = [a for n, (name, (_, keep)) in enumerate(layers.items()) for a in (F.min(own(n)).alias(name), *[F.min_by(c, own(n)).alias(c) for c in keep])]
    return cells.groupBy("i", "j").agg(*best)


def nearest(points: DataFrame, edges: DataFrame, size: float, pid: str = "id", most: float | None = None) -> DataFrame:
    """pid, gid, dist: the nearest edge set by (distance, gid); with ``most`` only within that distance.

    Edges lie in buckets of ``size``. Points look at their bucket and a ring of neighbours; the ring
    is doubled for points whose best hit is farther than the ring reaches, until none is left.
    """
    lo, hi = lambda a, b: F.floor(F.least(a, b) / size).cast("int"), lambda a, b: F.floor(F.greatest(a, b) / size).cast("int")
    keyed = edges.withColumn("bx", F.explode(F.sequence(lo("xa", "xb"), hi("xa", "xb")))).withColumn("by", F.explode(F.sequence(lo("ya", "yb"), hi("ya", "yb"))))
    open_, done, ring = points.select(F.col(pid), "x", "y"), None, 1
    limit = edges.agg(F.max(F.greatest(F.abs("xa"), F.abs("ya"), F.abs("xb"), F.abs("yb")))).first()[0]
    if limit is None:
        return open_.select(pid, F.lit(None).cast("int").alias("gid"), F.lit(None).cast("double").alias("dist")).limit(0)
    while True:
        reach = F.sequence(F.lit(-ring), F.lit(ring))
        look = open_.withColumn("bx", F.explode(F.transform(reach, lambda d: (F.floor(F.col("x") / size) + d).cast("int"))))
        look = look.withColumn("by", F.explode(F.transform(reach, lambda d: (F.floor(F.col("y") / size) + d).cast("int"))))
        d2 = ed.segment_distance2(*map(F.col, ("x", "y", "xa", "ya", "xb", "yb")))
        best = look.join(keyed, ["bx", "by"]).withColumn("d2", d2).groupBy(pid).agg(F.min(F.struct("d2", "gid")).alias("b"))
        best = best.select(pid, F.col("b.gid").alias("gid"), F.sqrt("b.d2").alias("dist"))
        sure = best.filter(F.col("dist") <= ring * size)
        last = (most is not None and ring * size >= most) or ring * size > 4 * max(limit, size)
        found = best if last else sure
        done = found if done is None else done.unionByName(found)
        if last:
            break
        open_ = open_.join(sure, pid, "left_anti")
        if open_.isEmpty():
            break
        ring *= 2
    return done if most is None else done.filter(F.col("dist") <= most)


def coverage(edges: DataFrame, dom: Domain, by: tuple[str, ...] = ("gid",)) -> DataFrame:
    """gid (or ``by``, the columns that name a polygon), i, j, area: area of each polygon in each cell, exact for any simple polygon with holes.

    Pieces of edges give the area under them in their own cell; what they cover of the cells below is a
    running sum down the column, which also fills the cells that no edge meets. Edges that are already
    partitioned by a column of ``by`` are not shuffled again.
    """
    i_ok = F.col("i").between(0, dom.nx - 1)
    pieces = edge_cells(edges, dom, by).filter(i_ok)
    floor = F.col("j") * dom.dy + dom.origin_y
    dx = F.col("xb") - F.col("xa")
    at = pieces.groupBy(*by, "i", "j").agg(F.sum(dx * ((F.col("ya") + F.col("yb")) / 2 - floor)).alias("own"), F.sum(dx).alias("dx"))
    w = W.partitionBy(*by, "i").orderBy(F.desc("j"))
    at = at.select(*by, "i", "j", "own", (F.sum("dx").over(w) - F.col("dx")).alias("above"), F.sum("dx").over(w).alias("below"), F.lead("j").over(w).alias("next"))
    cell = lambda j, area: F.struct(j.alias("j"), F.abs(area).alias("area"))
    edge = F.array(cell(F.col("j"), F.col("own") + F.col("above") * dom.dy))
    low, high = F.greatest(F.col("next") + 1, F.lit(0)), F.least(F.col("j") - 1, F.lit(dom.ny - 1))
    full = F.transform(F.sequence(low, high), lambda j: cell(j, F.col("below") * dom.dy))
    both = F.when((low <= high) & (F.abs("below") > 1e-9 * dom.dx), F.concat(edge, full)).otherwise(edge)
    return at.select(*by, "i", F.explode(both).alias("c")).select(*by, "i", "c.j", "c.area").filter(F.col("j").between(0, dom.ny - 1) & (F.col("area") > 1e-9))


def dominant(cover: DataFrame, cls: str = "cls") -> DataFrame:
    """i, j, cls with the largest single overlap, ties by lowest gid."""
    return cover.groupBy("i", "j").agg(F.max_by(cls, F.struct("area", -F.col("gid"))).alias(cls))


def fractions(cover: DataFrame, kind: str, least: float, cell_area: float) -> DataFrame:
    """i, j, kind, f: shares of a cell by kind; those at most ``least`` fall away, the rest sum to 1."""
    f = cover.groupBy("i", "j", kind).agg((F.sum("area") / cell_area).alias("f")).filter(F.col("f") > least)
    total = f.groupBy("i", "j").agg(F.sum("f").alias("s"))
    return f.join(total, ["i", "j"]).select("i", "j", kind, F.try_divide("f", "s").alias("f"))


def near_border(boxes: DataFrame, dom: Domain, d: float) -> Column:
    """Boxes closer than d to the outline of the domain."""
    x1, y1 = dom.origin_x + dom.nx * dom.dx, dom.origin_y + dom.ny * dom.dy
    gap = F.least(F.abs(F.col("x0") - dom.origin_x), F.abs(x1 - F.col("x1")), F.abs(F.col("y0") - dom.origin_y), F.abs(y1 - F.col("y1")))
    return gap < d


def nearest_polygon(points: DataFrame, edges: DataFrame, dom: Domain, size: float, pid: str = "id") -> DataFrame:
    """pid, gid: the polygon that holds each point (the lowest), else the nearest by (distance, gid)."""
    points = cut(points)
    held = cut(points_in_polygons(points, edges, dom, pid))
    rest = nearest(points.join(held, pid, "left_anti"), edges, size, pid)
    return held.unionByName(rest.select(pid, "gid"))


def nearest_box(asked: DataFrame, boxes: DataFrame, size: float) -> DataFrame:
    """gid, near: the nearest box by (gap, gid) of each asked box; buckets within a reach that doubles for those without a sure hit."""
    asked, boxes = cut(asked.select("gid", "x0", "y0", "x1", "y1")), cut(boxes.select("gid", "x0", "y0", "x1", "y1"))
    ends = boxes.unionByName(asked).agg(F.max(F.greatest(*[F.abs(c) for c in ("x0", "y0", "x1", "y1")]))).first()[0]
    none = asked.select("gid", F.col("gid").alias("near")).limit(0)
    if ends is None or boxes.isEmpty():
        return none

    def keyed(df, grow, step):
        seq = lambda a, b: F.sequence(F.floor((F.col(a) - grow) / step).cast("int"), F.floor((F.col(b) + grow) / step).cast("int"))
        return df.withColumn("bx", F.explode(seq("x0", "x1"))).withColumn("by", F.explode(seq("y0", "y1")))

    gap = lambda lo, hi: F.greatest(F.lit(0.0), F.col("a." + lo) - F.col("b." + hi), F.col("b." + lo) - F.col("a." + hi))
    d2 = gap("x0", "x1") * gap("x0", "x1") + gap("y0", "y1") * gap("y0", "y1")
    done, reach = none, size
    while not asked.isEmpty():
        a, b = keyed(asked, reach, 2 * reach).alias("a"), keyed(boxes, 0.0, 2 * reach).alias("b")
        pairs = a.join(b, (F.col("a.bx") == F.col("b.bx")) & (F.col("a.by") == F.col("b.by"))).select(F.col("a.gid").alias("gid"), F.struct(d2.alias("d2"), F.col("b.gid").alias("gid")).alias("n"))
        best = pairs.groupBy("gid").agg(F.min("n").alias("n"))
        last = reach > 4 * max(ends, size)
        sure = cut((best if last else best.filter(F.col("n.d2") <= reach * reach)).select("gid", F.col("n.gid").alias("near")))
        done = done.unionByName(sure)
        if last:
            break
        asked, reach = cut(asked.join(sure, "gid", "left_anti")), 2 * reach
    return done


def nearest_cell(points: DataFrame, cells: DataFrame, dom: Domain, d: float, apart: int = 50, pid: str = "id") -> DataFrame:
    """pid, i, j, dist: the nearest cell within d whose type differs from the point's by less than ``apart`` (ties: lowest i, j).

    Cells lie in blocks as wide as the reach; a point is sent to its block and the eight around it, not to each cell in reach.
    """
    i, j = cell_of(F.col("x"), F.col("y"), dom)
    ri, rj = max(1, math.ceil(d / dom.dx)), max(1, math.ceil(d / dom.dy))
    block = lambda c, r: F.floor(F.col(c) / r).cast("int")
    three = lambda c, r: F.explode(F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda k: (block(c, r) + k).cast("int")))
    p = points.select(F.col(pid), "x", "y", F.col("type").alias("own"), i.alias("pi"), j.alias("pj")).withColumn("bi", three("pi", ri)).withColumn("bj", three("pj", rj))
    c = cells.select("i", "j", "type", block("i", ri).alias("bi"), block("j", rj).alias("bj"))
    reach = (F.abs(F.col("i") - F.col("pi")) <= math.ceil(d / dom.dx)) & (F.abs(F.col("j") - F.col("pj")) <= math.ceil(d / dom.dy))
    near = p.hint("merge").join(c, ["bi", "bj"]).filter(reach & (F.abs(F.col("type") - F.col("own")) < apart))
    lo_x, lo_y = F.col("i") * dom.dx + dom.origin_x, F.col("j") * dom.dy + dom.origin_y
    gx = F.greatest(F.lit(0.0), lo_x - F.col("x"), F.col("x") - lo_x - dom.dx)
    gy = F.greatest(F.lit(0.0), lo_y - F.col("y"), F.col("y") - lo_y - dom.dy)
    best = near.withColumn("d2", gx * gx + gy * gy).filter(F.col("d2") <= d * d).groupBy(pid).agg(F.min(F.struct("d2", "i", "j")).alias("b"))
    return best.select(pid, "b.i", "b.j", F.sqrt("b.d2").alias("dist"))
