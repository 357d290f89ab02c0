"""Centre lines of streets: distances, medial cells, merged and simplified lines."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.operators.components import connected_components
from cellweave.session import cut, shuffle_parts

#: What a step to the neighbour adds to the spread at a corner of right angles, in cells.
STEP = 0.52
POINTS = T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))


def distances(cells: DataFrame, most: int = 60) -> DataFrame:
    """i, j, d2, fi, fj of street cells (``street``): the nearest other cell and its squared distance in cells (ties: lowest i, j).

    The nearest other cell of each column comes from running values down and up it. A cell looks along its
    row only as far as its nearest other cell in row or column (``most`` where there is none), which
    bounds the distance; so streets cost their width, not their length. What lies outside the table is
    unknown, not a border.
    """

    def reach(part: str, order: str) -> tuple:
        here = F.when(~F.col("street"), F.col(order))
        back, on = W.partitionBy(part).orderBy(order), W.partitionBy(part).orderBy(F.desc(order))
        return F.last(here, ignorenulls=True).over(back), F.last(here, ignorenulls=True).over(on)

    c = cells.select("i", "j", "street")
    down, up = reach("i", "j")
    c = c.withColumn("down", down).withColumn("up", up)
    left, right = reach("j", "i")
    c = cut(c.withColumn("left", left).withColumn("right", right))
    gap = F.least(F.col("j") - F.col("down"), F.col("up") - F.col("j"), F.col("i") - F.col("left"), F.col("right") - F.col("i"), F.lit(most))
    look = c.filter("street").select("i", "j", F.explode(F.sequence(F.col("i") - gap, F.col("i") + gap)).alias("fi"))
    column = c.select(F.col("i").alias("fi"), "j", F.explode(F.array_distinct(F.array("down", "up"))).alias("fj")).filter("fj is not null")
    d2 = (F.col("fi") - F.col("i")) * (F.col("fi") - F.col("i")) + (F.col("fj") - F.col("j")) * (F.col("fj") - F.col("j"))
    best = look.join(column, ["fi", "j"]).groupBy("i", "j").agg(F.min(F.struct(d2.alias("d2"), "fi", "fj")).alias("b"))
    return best.select("i", "j", "b.d2", "b.fi", "b.fj")


def medial(cells: DataFrame, spread: float = 3.0, most: int = 60) -> DataFrame:
    """i, j, d2: cells on the middle of streets.

    A cell is on it if the nearest border of a neighbour lies on another side: the two border cells are
    farther apart than the root of ``spread`` times the distance (3: seen at over 120 degrees, so that
    corners throw no branches) and a share of a cell for the step to the neighbour. Of the two cells the
    one farther from the border counts, the lower one on a tie. Streets one cell wide are their own middle.
    """
    d = cut(distances(cells, most))
    line = cells.select("i", "j", "street")
    w = [(W.partitionBy(a).orderBy(b), b) for a, b in (("i", "j"), ("j", "i"))]
    gap = lambda f, v, c, step: ~f("street").over(v) & (f(c).over(v) == F.col(c) + step)
    thin = [gap(F.lag, v, c, -1) & gap(F.lead, v, c, 1) for v, c in w]
    thin = line.select("i", "j", "street", thin[0].alias("a"), thin[1].alias("b")).filter("street and (a or b)").select("i", "j", F.lit(1).cast("long").alias("d2"))
    near = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in ((1, 0), (0, 1))])).alias("o")
    p = d.select(*[F.col(c).alias("p" + c) for c in d.columns], near).select("*", (F.col("pi") + F.col("o.a")).alias("i"), (F.col("pj") + F.col("o.b")).alias("j"))
    m = p.join(d, ["i", "j"])
    apart = (F.col("pfi") - F.col("fi")) * (F.col("pfi") - F.col("fi")) + (F.col("pfj") - F.col("fj")) * (F.col("pfj") - F.col("fj"))
    m = m.filter(F.sqrt(apart) > F.sqrt(spread * F.greatest("pd2", "d2")) + STEP)
    pick = lambda c: F.when(F.col("d2") > F.col("pd2"), F.col(c)).otherwise(F.col("p" + c)).alias(c)
    return m.select(pick("i"), pick("j"), pick("d2")).unionByName(thin).distinct()


def cell_links(cells: DataFrame, dx: float, dy: float, ox: float = 0.0, oy: float = 0.0) -> DataFrame:
    """xa, ya, xb, yb: links between the centres of neighbouring cells; diagonal ones only where no cell beside them joins the two."""
    c = cut(cells.select("i", "j"))
    ways = [(1, 0), (0, 1), (1, 1), (1, -1)]
    p = c.select("i", "j", F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in ways])).alias("o")).select("i", "j", "o.a", "o.b", (F.col("i") + F.col("o.a")).alias("k"), (F.col("j") + F.col("o.b")).alias("l"))
    p = p.join(c.select(F.col("i").alias("k"), F.col("j").alias("l")), ["k", "l"])
    beside = lambda i, j: c.select(F.col("i").alias(i), F.col("j").alias(j), F.lit(True).alias(i + j))
    p = p.join(beside("k", "j"), ["k", "j"], "left").join(beside("i", "l"), ["i", "l"], "left")
    p = p.filter((F.col("a") == 0) | (F.col("b") == 0) | (F.col("kj").isNull() & F.col("il").isNull()))
    x, y = lambda c: (F.col(c) + 0.5) * dx + ox, lambda c: (F.col(c) + 0.5) * dy + oy
    return p.select(x("i").alias("xa"), y("j").alias("ya"), x("k").alias("xb"), y("l").alias("yb"))


def merge_lines(segments: DataFrame) -> DataFrame:
    """line, n, points: segments chained through every point where exactly two of them end; ends are compared to 1e-6.

    A line begins at its lower end (by x, y); a closed one at its lowest point, which is its last too.
    Segments of no length and repeated ones fall away. Chains come from distributed components; one line
    is put in order in one task, as it is one row at last.
    """
    s = segments.select(*[F.round(c, 6).alias(c) for c in ("xa", "ya", "xb", "yb")]).filter("xa <> xb or ya <> yb")
    a, b = F.struct(F.col("xa").alias("x"), F.col("ya").alias("y")), F.struct(F.col("xb").alias("x"), F.col("yb").alias("y"))
    s = s.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
    s = cut(s.withColumn("sid", F.monotonically_increasing_id()))
    ends = s.select("sid", F.explode(F.array("a", "b")).alias("p"))
    two = ends.groupBy("p").agg(F.count("*").alias("n"), F.min("sid").alias("u"), F.max("sid").alias("v")).filter("n = 2").select("u", "v")
    root = connected_components(two, "u", "v")
    named = s.join(root.withColumnRenamed("node", "sid"), "sid", "left").select(F.coalesce("root", "sid").alias("line"), "a.x", "a.y", F.col("b.x").alias("x2"), F.col("b.y").alias("y2"))

    def run(df: pd.DataFrame) -> pd.DataFrame:
        n = len(df)
        xy = np.concatenate([df[["x", "y"]].to_numpy(), df[["x2", "y2"]].to_numpy()])
        names, node = np.unique(xy, axis=0, return_inverse=True)
        node = node.reshape(-1)
        degree = np.bincount(node)
        order = np.argsort(node, kind="stable")
        first = np.searchsorted(node[order], np.arange(len(names)))
        single = np.flatnonzero(degree == 1)
        # a junction may be both ends of a line: it is where the walk must not go through
        at = int(single[0]) if len(single) else int(np.flatnonzero(degree > 2)[0]) if (degree > 2).any() else 0
        path, used = [at], np.zeros(n, bool)
        for _ in range(n):
            free = [e % n for e in order[first[at] : first[at] + degree[at]] if not used[e % n]]
            e = free[0]
            used[e] = True
            at = int(node[e] if node[e + n] == at else node[e + n])
            path.append(at)
        p = names[path]
        if tuple(p[-1]) < tuple(p[0]):
            p = p[::-1]
        return pd.DataFrame({"line": [df["line"].iloc[0]], "n": [len(p)], "points": [[{"x": x, "y": y} for x, y in p.tolist()]]})

    # lines are many and small: by the size of their rows alone they would meet in a few tasks
    return named.repartition(shuffle_parts(named.sparkSession), "line").groupBy("line").applyInPandas(run, "line long, n int, points array<struct<x:double,y:double>>")


def _douglas_peucker(x: np.ndarray, y: np.ndarray, tolerance: float) -> np.ndarray:
    """Which points stay: the farthest from a chord splits it while it is farther than ``tolerance``; by a stack, not by recursion."""
    keep = np.zeros(len(x), bool)
    keep[[0, -1]] = True
    todo = [(0, len(x) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        px, py, vx, vy = x[a + 1 : b] - x[a], y[a + 1 : b] - y[a], x[b] - x[a], y[b] - y[a]
        l2 = vx * vx + vy * vy
        t = np.clip((px * vx + py * vy) / l2, 0, 1) if l2 else 0.0
        d2 = (px - t * vx) ** 2 + (py - t * vy) ** 2
        k = int(np.argmax(d2))
        if d2[k] > tolerance * tolerance:
            keep[a + 1 + k] = True
            todo += [(a, a + 1 + k), (a + 1 + k, b)]
    return keep


@F.pandas_udf(POINTS)
def simplify_points(points: pd.Series, tolerance: pd.Series, closed: pd.Series) -> pd.Series:
    """Lines (or rings, whose first point stays) with fewer points, none of the old ones farther than the tolerance from them."""
    out = []
    for p, t, ring in zip(points, tolerance, closed, strict=True):
        if p is None or len(p) < 3:
            out.append(p)
            continue
        x, y = np.array([q["x"] for q in p]), np.array([q["y"] for q in p])
        if ring:
            x, y = np.append(x, x[0]), np.append(y, y[0])
        keep = np.flatnonzero(_douglas_peucker(x, y, t))
        out.append([{"x": x[k], "y": y[k]} for k in (keep[:-1] if ring else keep).tolist()])
    return pd.Series(out)


def centre_lines(cells: DataFrame, dx: float, dy: float, tolerance: float, ox: float = 0.0, oy: float = 0.0) -> DataFrame:
    """line, points: simplified centre lines of street cells."""
    made = merge_lines(cell_links(medial(cells), dx, dy, ox, oy))
    return made.select("line", simplify_points("points", F.lit(tolerance), F.lit(False)).alias("points"))
