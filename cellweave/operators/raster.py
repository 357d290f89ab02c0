"""Rasters as pixel tables (px, py, val); R1, R2, R4-R9."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.operators.stencil import NINE


def mosaic(pixels: DataFrame) -> DataFrame:
    """One value per pixel; of overlapping tiles the highest rid that has a value wins."""
    return pixels.groupBy("px", "py").agg(F.max_by("val", F.when(F.col("val").isNotNull(), F.col("rid"))).alias("val"))


def retile(pixels: DataFrame, w: int = 64, h: int = 64, nodata: float = -1e9) -> DataFrame:
    """tx, ty, vals: full tiles in row order, gaps filled with nodata."""

    def filled(n: int, at: str, value: Column, gap: Column) -> Column:
        """Values in order of their place from 0 to n - 1; a place held twice is an error."""
        m = F.map_from_entries(F.collect_list(F.struct(F.col(at), value)))
        return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.coalesce(F.element_at(m, k), gap))

    # a map is searched from its beginning for each place, so tiles are put together row by row
    tile = [F.floor(F.col("px") / w).cast("int").alias("tx"), F.floor(F.col("py") / h).cast("int").alias("ty")]
    p = pixels.select(*tile, (F.col("py") % h).cast("int").alias("row"), (F.col("px") % w).cast("int").alias("at"), F.coalesce("val", F.lit(nodata)).alias("val"))
    rows = p.groupBy("tx", "ty", "row").agg(filled(w, "at", F.col("val"), F.lit(nodata)).alias("vals"))
    return rows.groupBy("tx", "ty").agg(F.flatten(filled(h, "row", F.col("vals"), F.array_repeat(F.lit(nodata), w))).alias("vals"))


def with_value(points: DataFrame, pixels: DataFrame, size: float, x: str = "x", y: str = "y") -> DataFrame:
    """The points with val of the pixel that holds them."""
    keyed = points.select("*", F.floor(F.col(x) / size).cast("int").alias("px"), F.floor(F.col(y) / size).cast("int").alias("py"))
    return keyed.join(pixels.select("px", "py", "val"), ["px", "py"], "left").select(*points.columns, "val")


def sample_value(points: DataFrame, pixels: DataFrame, size: float, pid: str = "id") -> DataFrame:
    """pid, val of the pixel that holds the point."""
    return with_value(points.select(pid, "x", "y"), pixels, size).select(pid, "val")


def sample_nearest(points: DataFrame, pixels: DataFrame, size: float, tile: int = 64, pid: str = "id") -> DataFrame:
    """pid, val of the nearest valid pixel of the point's tile (ties: lowest py, px).

    The own pixel answers almost always; only the others look at rings of neighbours, doubled until
    the best hit lies within the ring or the ring covers the tile.
    """
    keyed = points.select(F.col(pid), "x", "y", F.floor(F.col("x") / size).cast("int").alias("px"), F.floor(F.col("y") / size).cast("int").alias("py"))
    valid = pixels.filter("val is not null").select("px", "py", "val")
    done = keyed.join(valid, ["px", "py"]).select(pid, "val")
    open_, ring = keyed.join(valid, ["px", "py"], "left_anti"), 1
    while not open_.isEmpty():
        off = F.sequence(F.lit(-ring), F.lit(ring))
        look = open_.withColumnsRenamed({"px": "ox", "py": "oy"}).withColumn("px", F.explode(F.transform(off, lambda d: F.col("ox") + d))).withColumn("py", F.explode(F.transform(off, lambda d: F.col("oy") + d)))
        look = look.filter((F.floor(F.col("px") / tile) == F.floor(F.col("ox") / tile)) & (F.floor(F.col("py") / tile) == F.floor(F.col("oy") / tile)))
        d2 = F.pow((F.col("px") + 0.5) * size - F.col("x"), 2.0) + F.pow((F.col("py") + 0.5) * size - F.col("y"), 2.0)
        best = look.join(valid, ["px", "py"]).groupBy(pid).agg(F.min(F.struct(d2.alias("d2"), "py", "px", "val")).alias("b"))
        last = ring >= tile
        sure = best if last else best.filter(F.col("b.d2") <= (ring * size) ** 2)
        done = done.unionByName(sure.select(pid, F.col("b.val").alias("val")))
        if last:
            break
        open_ = open_.join(sure, pid, "left_anti")
        ring *= 2
    return done


def pixel_points(pixels: DataFrame, size: float) -> DataFrame:
    """x, y, val at pixel centres, without nodata."""
    return pixels.filter("val is not null").select(((F.col("px") + 0.5) * size).alias("x"), ((F.col("py") + 0.5) * size).alias("y"), "val")


def slope(pixels: DataFrame, size: float) -> DataFrame:
    """px, py, slope, aspect in degrees by Horn's 3 by 3 weights; only pixels with all nine values."""
    off = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in NINE])
    s = pixels.filter("val is not null").select("px", "py", "val", F.explode(off).alias("o"))
    s = s.select((F.col("px") - F.col("o.a")).alias("px"), (F.col("py") - F.col("o.b")).alias("py"), "val", F.col("o.a").alias("a"), F.col("o.b").alias("b"))
    wx, wy = F.col("a") * (2 - F.abs("b")), F.col("b") * (2 - F.abs("a"))
    g = s.groupBy("px", "py").agg(F.count("*").alias("n"), F.sum(wx * F.col("val")).alias("gx"), F.sum(wy * F.col("val")).alias("gy")).filter("n = 9")
    p, q = F.col("gx") / (8 * size), F.col("gy") / (8 * size)
    return g.select("px", "py", F.degrees(F.atan(F.sqrt(p * p + q * q))).alias("slope"), F.degrees(F.atan2(-p, -q)).alias("aspect"))
