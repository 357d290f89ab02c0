"""Building heights from neighbours, voxels, roofs, outer walls and vertical surfaces."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.operators.numbering import number_rows
from cellweave.operators.stencil import _in_tiles
from cellweave.session import cut


def fill_heights(cells: DataFrame, radius: int) -> DataFrame:
    """Null heights from windows of growing radius: first of the same lid at every radius, then of any; nearest first, then lowest id.

    All windows are looked at in one square of cells with as many around it as the radii together reach: cells are sent once.
    """
    if radius < 1:
        return cells
    steps = [(same, r) for same in (True, False) for r in range(1, radius + 1)]

    def work(h: np.ndarray, known: np.ndarray, ids: np.ndarray, lids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h, known = (np.pad(x, radius) for x in (h, known))  # ids and lids: 0 where there is no cell
        ids, lids = np.pad(ids, radius), np.pad(lids, radius)
        far = np.iinfo("int64").max
        for same, r in steps:
            x, y = np.nonzero((ids > 0) & ~known)
            best, got = np.full(x.size, far), np.zeros(x.size, h.dtype)
            for a in range(-r, r + 1):
                for b in range(-r, r + 1):
                    at = x + a, y + b
                    ok = known[at] & ((lids[at] == lids[x, y]) & (lids[at] > 0) if same else True)
                    rank = np.where(ok, (a * a + b * b) * (ids.size + 1) + ids[at], far)
                    got, best = np.where(rank < best, h[at], got), np.minimum(rank, best)
            hit = best < far
            h[x[hit], y[hit]], known[x[hit], y[hit]] = got[hit], True
        inner = slice(radius, -radius)
        return h[inner, inner], known[inner, inner]

    return _in_tiles(cells, "height", sum(r for _, r in steps), work, also=("id", "lid"))


def voxels(cells: DataFrame) -> DataFrame:
    """i, j, k of occupied levels: from bottom + 1 to top; a building on the ground also fills level 0."""
    low = F.when(F.col("bottom") == 0, 0).otherwise(F.col("bottom") + 1)
    return cells.filter(F.col("top") >= low).select("i", "j", F.explode(F.sequence(low, F.col("top"))).alias("k"))


def outer_walls(cells: DataFrame, dx: float, dy: float) -> DataFrame:
    """id, direction, azimuth, xs, ys: one wall for each building cell and side without a building neighbour."""
    sides = F.array(*[F.struct(F.lit(n).alias("direction"), F.lit(a).alias("azimuth"), F.lit(di).alias("di"), F.lit(dj).alias("dj")) for n, a, di, dj in ((1, 0.0, 0, 1), (2, 90.0, 1, 0), (3, 180.0, 0, -1), (4, 270.0, -1, 0))])
    w = cells.select("id", "i", "j", "xcen", "ycen", "top", F.explode(sides).alias("s")).select("*", "s.*", (F.col("i") + F.col("s.di")).alias("ni"), (F.col("j") + F.col("s.dj")).alias("nj"))
    free = w.join(cells.select(F.col("i").alias("ni"), F.col("j").alias("nj")), ["ni", "nj"], "left_anti")
    return free.select("id", "i", "j", "direction", "azimuth", "top", (F.col("xcen") + F.col("di") * dx / 2).alias("xs"), (F.col("ycen") + F.col("dj") * dy / 2).alias("ys"))


def vertical_surfaces(walls: DataFrame, dz: float) -> DataFrame:
    """sid, id, direction, zs: a facet for each level of each wall, numbered by (id, direction, level)."""
    f = walls.filter("top > 0").select("id", "direction", "azimuth", "xs", "ys", F.explode(F.sequence(F.lit(0), F.col("top") - 1)).alias("level"))
    return number_rows(f.withColumn("zs", dz * (F.col("level") + 0.5)), ["id", "direction", "level"], "sid")


def roof_of_cell(cells: DataFrame, hits: DataFrame, near: tuple[int, ...] = (1, 2), far: int = 49) -> DataFrame:
    """id, i, j, rid: the roof of each building cell (id, i, j): its own (``hits``: id, rid), else that of the nearest cell that has one.

    First cells within each step of ``near`` give theirs, also those that got one a step before; then cells within ``far``.
    Nearest is by (rows or columns apart, squared distance, rid); cells farther from all others keep null. The far search asks
    buckets of cells that double until a hit is certain, and only owners with a neighbour that is none: others are never the nearest.
    """
    own = hits.filter("rid is not null").groupBy("id").agg(F.min("rid").alias("rid"))
    c = cut(cells.select("id", "i", "j").join(own, "id", "left"))
    gap = lambda a, b: F.abs(F.col(a) - F.col(b))
    rank = F.struct(F.greatest(gap("i", "oi"), gap("j", "oj")).alias("apart"), (gap("i", "oi") * gap("i", "oi") + gap("j", "oj") * gap("j", "oj")).alias("d2"), F.col("orid").alias("rid"))

    def around(df: DataFrame, r: int) -> DataFrame:
        steps = F.sequence(F.lit(-r), F.lit(r))
        return df.withColumn("di", F.explode(steps)).withColumn("dj", F.explode(steps)).filter("di <> 0 or dj <> 0")

    def filled(c: DataFrame, best: DataFrame) -> DataFrame:
        return cut(c.join(best.select("id", F.col("b.rid").alias("got")), "id", "left").select("id", "i", "j", F.coalesce("rid", "got").alias("rid")))

    for r in near:
        owners = c.filter("rid is not null").select(F.col("i").alias("oi"), F.col("j").alias("oj"), F.col("rid").alias("orid"))
        asked = around(c.filter("rid is null").select("id", "i", "j"), r).withColumn("oi", F.col("i") + F.col("di")).withColumn("oj", F.col("j") + F.col("dj"))
        c = filled(c, asked.join(owners, ["oi", "oj"]).groupBy("id").agg(F.min(rank).alias("b")))

    owners = c.filter("rid is not null").select(F.col("i").alias("oi"), F.col("j").alias("oj"), F.col("rid").alias("orid"))
    beside = around(owners, 1).select((F.col("oi") + F.col("di")).alias("oi"), (F.col("oj") + F.col("dj")).alias("oj"))
    full = beside.groupBy("oi", "oj").count().filter("count = 8").select("oi", "oj")
    rim = cut(owners.join(full, ["oi", "oj"], "left_anti"))
    asked, done, size = c.filter("rid is null").select("id", "i", "j"), None, min(4, far)
    while not asked.isEmpty():
        bucket = lambda v: F.floor(F.col(v) / size).cast("int")  # noqa: E731, B023
        side = F.sequence(F.lit(-1), F.lit(1))
        a = asked.withColumn("bi", F.explode(F.transform(side, lambda s: bucket("i") + s))).withColumn("bj", F.explode(F.transform(side, lambda s: bucket("j") + s)))
        o = rim.withColumn("bi", bucket("oi")).withColumn("bj", bucket("oj"))
        best = a.join(o, ["bi", "bj"]).groupBy("id").agg(F.min(rank).alias("b")).filter(F.col("b.apart") <= size)
        best = cut(best)
        done = best if done is None else done.unionByName(best)
        if size >= far:
            break
        asked, size = cut(asked.join(best, "id", "left_anti")), min(2 * size, far)
    return c if done is None else filled(c, done)
