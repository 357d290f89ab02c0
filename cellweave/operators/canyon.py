"""Street lines, transects and canyon statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.operators.raster import sample_nearest
from cellweave.operators.spatial import nearest
from cellweave.session import cut


def chop(lines: DataFrame, step: float, least: float = 40.0) -> DataFrame:
    """sid, part and ends of equal pieces (about ``step`` long) of straight lines longer than ``least``."""
    length = F.sqrt(F.pow(F.col("xb") - F.col("xa"), 2.0) + F.pow(F.col("yb") - F.col("ya"), 2.0))
    c = lines.withColumn("len", length).filter(F.col("len") > least).withColumn("n", F.ceil(F.col("len") / step).cast("int"))
    c = c.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    at = lambda a, b, k: F.col(a) + (F.col(b) - F.col(a)) * (F.col("part") + k) / F.col("n")
    return c.select("sid", "part", at("xa", "xb", 0).alias("sx"), at("ya", "yb", 0).alias("sy"), at("xa", "xb", 1).alias("ex"), at("ya", "yb", 1).alias("ey"))


def transects(pieces: DataFrame, reach: float) -> DataFrame:
    """sid, part, side, from the centre of each piece ``reach`` to the left (1) and right (-1)."""
    vx, vy = F.col("ex") - F.col("sx"), F.col("ey") - F.col("sy")
    n = F.sqrt(vx * vx + vy * vy)
    sides = F.explode(F.array(F.lit(1), F.lit(-1))).alias("side")
    p = pieces.select("sid", "part", ((F.col("sx") + F.col("ex")) / 2).alias("cx"), ((F.col("sy") + F.col("ey")) / 2).alias("cy"), (vx / n).alias("ux"), (vy / n).alias("uy"), sides)
    return p.select("sid", "part", "side", "cx", "cy", (F.col("cx") - F.col("side") * F.col("uy") * reach).alias("tx"), (F.col("cy") + F.col("side") * F.col("ux") * reach).alias("ty"))


def first_hit(rays: DataFrame, edges: DataFrame, size: float = 50.0) -> DataFrame:
    """sid, part, side, gid, t: the first edge that each ray meets, as a share of its length; ties by gid.

    Rays and edges meet in buckets that their boxes touch.
    """

    def keyed(df, a, b, c, d):
        seq = lambda p, q: F.sequence(F.floor(F.least(p, q) / size).cast("int"), F.floor(F.greatest(p, q) / size).cast("int"))
        return df.withColumn("bx", F.explode(seq(a, c))).withColumn("by", F.explode(seq(b, d)))

    m = keyed(rays, "cx", "cy", "tx", "ty").join(keyed(edges, "xa", "ya", "xb", "yb"), ["bx", "by"])
    rx, ry, ex, ey = F.col("tx") - F.col("cx"), F.col("ty") - F.col("cy"), F.col("xb") - F.col("xa"), F.col("yb") - F.col("ya")
    wx, wy, det = F.col("xa") - F.col("cx"), F.col("ya") - F.col("cy"), rx * ey - ry * ex
    t, s = F.try_divide(wx * ey - wy * ex, det), F.try_divide(wx * ry - wy * rx, det)
    hit = m.withColumn("t", t).withColumn("s", s).filter("t between 0 and 1 and s between 0 and 1")
    best = hit.groupBy("sid", "part", "side").agg(F.min(F.struct("t", "gid")).alias("b"))
    return best.select("sid", "part", "side", F.col("b.gid").alias("gid"), F.col("b.t").alias("t"))


def canyons(hits: DataFrame, rays: DataFrame, reach: float) -> DataFrame:
    """sid, part, width, orientation for pieces that are hit on both sides."""
    both = hits.groupBy("sid", "part").agg(F.count("*").alias("n"), F.sum("t").alias("t")).filter("n = 2")
    r = rays.filter("side = 1").select("sid", "part", "cx", "cy", F.pmod(F.degrees(F.atan2(F.col("tx") - F.col("cx"), F.col("ty") - F.col("cy"))) + 90.0, F.lit(360.0)).alias("orientation"))
    return both.join(r, ["sid", "part"]).select("sid", "part", "cx", "cy", (F.col("t") * reach).alias("width"), "orientation")


def canyon_stats(pieces: DataFrame) -> DataFrame:
    """i, j: mean width and circular mean of the orientation."""
    o = F.radians("orientation")
    a = pieces.groupBy("i", "j").agg(F.avg("width").alias("width"), F.avg(F.sin(o)).alias("s"), F.avg(F.cos(o)).alias("c"))
    return a.select("i", "j", "width", F.pmod(F.degrees(F.atan2("s", "c")) + 360.0, F.lit(360.0)).alias("orientation"))


def wall_heights(points: DataFrame, pixels: DataFrame, size: float, default: float, most: float = 100.0, tile: int = 64, pid: str = "id") -> DataFrame:
    """pid, height: the nearest valid pixel of the point's tile, else the nearest within ``most`` (ties: lowest py, px), else the default."""
    points = cut(points.select(pid, "x", "y"))
    own = cut(sample_nearest(points, pixels, size, tile, pid))
    x, y = (F.col("px") + 0.5) * size, (F.col("py") + 0.5) * size
    valid = pixels.filter("val is not null").select((F.col("py") * F.lit(1 << 31) + F.col("px")).alias("gid"), "val", x.alias("xa"), y.alias("ya"), x.alias("xb"), y.alias("yb"))
    far = nearest(points.join(own, pid, "left_anti"), valid, size, pid, most).join(valid.select("gid", "val"), "gid").select(pid, "val")
    return points.select(pid).join(own.unionByName(far), pid, "left").select(pid, F.coalesce("val", F.lit(default)).alias("height"))
