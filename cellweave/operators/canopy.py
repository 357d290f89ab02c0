"""Tree crowns to leaf-area densities."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.domain import Domain
from cellweave.operators import edges as ed
from cellweave.operators.spatial import coverage, tasks


def canopy_levels(trees: DataFrame, dz: float) -> DataFrame:
    return trees.agg((F.ceil(F.max("treeh") / dz) + 1).cast("int").alias("nz"))


def tree_layers(trees: DataFrame, dz: float, nhv: int = 10) -> DataFrame:
    """gid, l, r: mean crown radius in each level over ``nhv`` sub-layers; ellipse, or cone for shape 4."""
    t = trees.withColumn("l", F.explode(F.sequence(F.floor(F.col("trunkh") / dz).cast("int"), F.ceil(F.col("treeh") / dz).cast("int"))))
    half = (F.col("treeh") - F.col("trunkh")) / 2

    def radius(s: Column) -> Column:
        h = (F.col("l") + (s + 0.5) / nhv) * dz
        u = (h - F.col("trunkh") - half) / half
        inside = (h >= F.col("trunkh")) & (h <= F.col("treeh"))
        return F.when(~inside, 0.0).when(F.col("crownshp") == 4, F.col("crownr") * (F.col("treeh") - h) / (F.col("treeh") - F.col("trunkh"))).otherwise(F.col("crownr") * F.sqrt(F.greatest(F.lit(0.0), 1 - u * u)))

    subs = F.sequence(F.lit(0), F.lit(nhv - 1))
    return t.select("gid", "l", (F.aggregate(subs, F.lit(0.0), lambda a, s: a + radius(s)) / nhv).alias("r")).filter("r > 0")


def tree_density(trees: DataFrame, layers: DataFrame, buildings: DataFrame, dom: Domain, ladens: float = 1.6, ladens_other: float = 1.0, ext: float = 0.5, corners: int = 40) -> DataFrame:
    """i, j, l, lad: crown discs (as polygons of ``corners`` sides) over cells, capped at the densest tree.

    Leaf area thins with the depth of the cell's centre below the crown's edge, less the cell's half
    diagonal. Cells of ``buildings`` (i, j, nz) higher than the layer get none.
    """
    disc = layers.join(trees.select("gid", "x", "y", "treeh", "tree_type"), "gid").repartition(tasks(trees.sparkSession, dom), "gid")
    c = [(F.col("x") + F.col("r") * math.cos(2 * math.pi * k / corners), F.col("y") + F.col("r") * math.sin(2 * math.pi * k / corners)) for k in range(corners)]
    own = ("l", "x", "y", "r", "treeh", "tree_type")
    share = coverage(ed.ring_edges(disc, "gid", c, own), dom, ("gid", *own))
    ex, ey = (F.col("i") + 0.5) * dom.dx + dom.origin_x - F.col("x"), (F.col("j") + 0.5) * dom.dy + dom.origin_y - F.col("y")
    below = F.least(F.col("treeh") - (F.col("l") + 0.5) * dom.dz, F.col("r") - F.sqrt(ex * ex + ey * ey))
    depth = F.greatest(below - math.sqrt(dom.dx**2 + dom.dy**2 + dom.dz**2) / 2, F.lit(0.0))
    tl = F.when(F.col("tree_type") == 1, ladens).otherwise(ladens_other)
    lad = tl / (tl * ext * depth + 1) * F.col("area") / (dom.dx * dom.dy)
    rows = share.select("i", "j", "l", lad.alias("lad"), tl.alias("cap")).hint("merge")
    rows = rows.join(buildings.select("i", "j", "nz").hint("merge"), ["i", "j"], "left").filter("nz is null or nz <= l")
    return rows.groupBy("i", "j", "l").agg(F.least(F.sum("lad"), F.max("cap")).alias("lad"))


def lad_from_lai(cells: DataFrame, dz: float, cap: float = 1.6) -> DataFrame:
    """i, j, k, lad, bad: leaf area index spread over the canopy's height; branches are a tenth."""
    c = cells.filter("canopy > 0 and lai > 0").withColumn("k", F.explode(F.sequence(F.lit(1), F.ceil(F.col("canopy") / dz).cast("int"))))
    inside = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("canopy") / dz - (F.col("k") - 1)))
    lad = F.least(F.lit(cap), F.col("lai") / F.col("canopy")) * inside
    return c.select("i", "j", "k", lad.alias("lad"), (0.1 * lad).alias("bad"))
