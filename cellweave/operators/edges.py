"""Polygons as edge tables, and what follows from them in closed form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellweave.domain import Domain


def ring_edges(df: DataFrame, gid: str, points: list[tuple[Column, Column]], keep: tuple[str, ...] = ()) -> DataFrame:
    """gid, edge, xa, ya, xb, yb of one ring given by column expressions for its points, and the columns ``keep``."""
    n = len(points)
    items = [F.struct(F.lit(k).alias("edge"), points[k][0].alias("xa"), points[k][1].alias("ya"), points[(k + 1) % n][0].alias("xb"), points[(k + 1) % n][1].alias("yb")) for k in range(n)]
    return df.select(F.col(gid).alias("gid"), *keep, F.explode(F.array(*items)).alias("e")).select("gid", *keep, "e.*")


def rectangle_edges(df: DataFrame, gid: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Counter-clockwise edges of x0, y0, x1, y1."""
    x0, y0, x1, y1 = map(F.col, ("x0", "y0", "x1", "y1"))
    return ring_edges(df, gid, [(x0, y0), (x1, y0), (x1, y1), (x0, y1)], keep)


def explode_rings(df: DataFrame, gid: str, rings: str = "rings") -> DataFrame:
    """Edges of ``rings ARRAY<ARRAY<STRUCT<x, y>>>`` (outer counter-clockwise, holes reversed)."""
    r = df.select(F.col(gid).alias("gid"), F.posexplode(rings).alias("ring", "pts"))
    r = r.select("gid", "ring", "pts", F.posexplode("pts").alias("edge", "a"))
    b = F.element_at("pts", (F.col("edge") + 1) % F.size("pts") + 1)
    return r.select("gid", "ring", "edge", F.col("a.x").alias("xa"), F.col("a.y").alias("ya"), b["x"].alias("xb"), b["y"].alias("yb"))


def areas(edges: DataFrame) -> DataFrame:
    """gid, area, cx, cy: signed-sum area and centroid of each polygon."""
    cross = F.col("xa") * F.col("yb") - F.col("xb") * F.col("ya")
    s = edges.groupBy("gid").agg(F.sum(cross).alias("s"), F.sum((F.col("xa") + F.col("xb")) * cross).alias("sx"), F.sum((F.col("ya") + F.col("yb")) * cross).alias("sy"))
    return s.select("gid", (F.abs("s") / 2).alias("area"), (F.col("sx") / (3 * F.col("s"))).alias("cx"), (F.col("sy") / (3 * F.col("s"))).alias("cy"))


def boxes(edges: DataFrame) -> DataFrame:
    return edges.groupBy("gid").agg(F.min("xa").alias("x0"), F.min("ya").alias("y0"), F.max("xa").alias("x1"), F.max("ya").alias("y1"))


def box_cells(box: DataFrame, dom: Domain) -> DataFrame:
    """Every cell that a bounding box touches, inside the domain: keys for equi-joins."""
    i0, i1 = (F.greatest(F.lit(0), F.floor((F.col("x0") - dom.origin_x) / dom.dx))), F.least(F.lit(dom.nx - 1), F.floor((F.col("x1") - dom.origin_x) / dom.dx))
    j0, j1 = (F.greatest(F.lit(0), F.floor((F.col("y0") - dom.origin_y) / dom.dy))), F.least(F.lit(dom.ny - 1), F.floor((F.col("y1") - dom.origin_y) / dom.dy))
    r = box.select("*", i0.cast("int").alias("i0"), i1.cast("int").alias("i1"), j0.cast("int").alias("j0"), j1.cast("int").alias("j1")).filter("i0 <= i1 and j0 <= j1")
    r = r.withColumn("i", F.explode(F.sequence("i0", "i1"))).withColumn("j", F.explode(F.sequence("j0", "j1")))
    return r.drop("i0", "i1", "j0", "j1")


def segment_distance2(px: Column, py: Column, xa: Column, ya: Column, xb: Column, yb: Column) -> Column:
    """Squared distance of a point from a segment."""
    vx, vy = xb - xa, yb - ya
    l2 = vx * vx + vy * vy
    t = F.when(l2 == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - xa) * vx + (py - ya) * vy) / F.when(l2 == 0, 1.0).otherwise(l2))))
    ex, ey = px - xa - t * vx, py - ya - t * vy
    return ex * ex + ey * ey


def clamped_area(x0: Column, x1: Column, y0: Column, h: float | Column) -> Column:
    """An edge's share (xa, ya, xb, yb) of the area between it and the floor of a cell, cut at the cell's height."""
    xa, ya, xb, yb = map(F.col, ("xa", "ya", "xb", "yb"))
    left, right = F.greatest(x0, F.least(xa, xb)), F.least(x1, F.greatest(xa, xb))
    h = F.lit(h) if not isinstance(h, Column) else h
    slope = (yb - ya) / F.when(xb == xa, None).otherwise(xb - xa)
    u, v, w = ya + (left - xa) * slope - y0, ya + (right - xa) * slope - y0, right - left
    fill = lambda t: F.when(t < 0, 0.0).when(t < h, t * t / 2).otherwise(h * h / 2 + h * (t - h))
    clamp = F.greatest(F.lit(0.0), F.least(h, u))
    piece = F.when(F.abs(v - u) < 1e-12, w * clamp).otherwise(w * (fill(v) - fill(u)) / (v - u))
    return F.when((xb == xa) | (w <= 0), 0.0).otherwise(F.signum(xb - xa) * piece)


def outline(edges: DataFrame) -> DataFrame:
    """xa, ya, xb, yb: the outline of polygons that may touch but do not overlap.

    Edges on one line are summed along it with their direction: where two polygons touch, opposite
    edges cancel, also where their points differ. Pieces that continue each other are one.
    """
    vx, vy = F.col("xb") - F.col("xa"), F.col("yb") - F.col("ya")
    length = F.sqrt(vx * vx + vy * vy)
    s = F.when((vx > 0) | ((vx == 0) & (vy > 0)), 1).otherwise(-1)
    e = edges.filter(length > 0).select("xa", "ya", "xb", "yb", s.alias("s"), F.round(s * vx / length, 9).alias("ux"), F.round(s * vy / length, 9).alias("uy"))
    along = lambda x, y: F.round(F.col(x) * F.col("ux") + F.col(y) * F.col("uy"), 6)
    off = F.round(F.col("ya") * F.col("ux") - F.col("xa") * F.col("uy"), 6).alias("c")
    ends = F.array(F.struct(along("xa", "ya").alias("t"), F.lit(1).alias("d")), F.struct(along("xb", "yb").alias("t"), F.lit(-1).alias("d")))
    ev = e.select("ux", "uy", off, F.explode(ends).alias("e")).groupBy("ux", "uy", "c", F.col("e.t").alias("t")).agg(F.sum("e.d").alias("d")).filter("d <> 0")
    w = W.partitionBy("ux", "uy", "c").orderBy("t")
    net = ev.select("*", F.lead("t").over(w).alias("u"), F.sum("d").over(w).alias("n")).filter("n <> 0")
    at = lambda t: (F.col(t) * F.col("ux") - F.col("c") * F.col("uy"), F.col(t) * F.col("uy") + F.col("c") * F.col("ux"))
    (xa, ya), (xb, yb) = at("t"), at("u")
    return net.select(xa.alias("xa"), ya.alias("ya"), xb.alias("xb"), yb.alias("yb"))
