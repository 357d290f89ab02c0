"""Cut-cell surfaces: corners, normals, vertices."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.domain import Domain
from cellweave.operators.numbering import number_rows


def corner_lattice(spark: SparkSession, dom: Domain) -> DataFrame:
    """i, j, x, y of all cell corners, one more than cells each way."""
    n = spark.range((dom.nx + 1) * (dom.ny + 1)).withColumnRenamed("id", "n")
    i, j = F.floor(F.col("n") / (dom.ny + 1)).cast("int"), (F.col("n") % (dom.ny + 1)).cast("int")
    return n.select(i.alias("i"), j.alias("j"), (i * dom.dx + dom.origin_x).alias("x"), (j * dom.dy + dom.origin_y).alias("y"))


def corner_heights(cells: DataFrame, value: str) -> DataFrame:
    """i, j and the mean of the up to four cells around each corner."""
    off = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)])
    c = cells.select((F.col("i")).alias("ci"), F.col("j").alias("cj"), value, F.explode(off).alias("o"))
    return c.select((F.col("ci") + F.col("o.a")).alias("i"), (F.col("cj") + F.col("o.b")).alias("j"), value).groupBy("i", "j").agg(F.avg(value).alias(value))


def normals(faces: DataFrame, verts: str = "verts") -> DataFrame:
    """fid, nx, ny, nz, area: fan triangles about the centre, summed cross products."""
    n = F.size(verts)
    mean = lambda f: F.aggregate(verts, F.lit(0.0), lambda s, v: s + v[f]) / n
    f = faces.withColumn("c", F.struct(mean("x").alias("x"), mean("y").alias("y"), mean("z").alias("z")))
    nxt = F.concat(F.slice(verts, 2, n), F.slice(verts, 1, 1))

    def cross(a, b, c):
        (ux, uy, uz), (vx, vy, vz) = [(p["x"] - c["x"], p["y"] - c["y"], p["z"] - c["z"]) for p in (a, b)]
        return F.struct((uy * vz - uz * vy).alias("x"), (uz * vx - ux * vz).alias("y"), (ux * vy - uy * vx).alias("z"))

    f = f.withColumn("t", F.zip_with(verts, nxt, lambda a, b: cross(a, b, F.col("c"))))
    total = lambda k: F.aggregate("t", F.lit(0.0), lambda s, v: s + v[k])
    f = f.select("fid", total("x").alias("x"), total("y").alias("y"), total("z").alias("z"))
    size = F.sqrt(reduce(lambda p, q: p + q, [F.col(k) * F.col(k) for k in "xyz"]))
    return f.select("fid", *[F.try_divide(F.col(k), size).alias("n" + k) for k in "xyz"], (size / 2).alias("area"))


def vertex_index(faces: DataFrame, verts: str = "verts") -> DataFrame:
    """fid, at, vid: faces as references to vertices that are kept once, numbered by (x, y, z)."""
    v = faces.select("fid", F.posexplode(verts).alias("at", "v")).select("fid", "at", "v.x", "v.y", "v.z")
    ids = number_rows(v.select("x", "y", "z").distinct(), ["x", "y", "z"], "vid")
    return v.join(ids, ["x", "y", "z"]).select("fid", "at", "vid")


def grid_points(edges: DataFrame, dom: Domain, least: float = 1e-3) -> DataFrame:
    """gid, edge, i, j, x, y: where edges cross the borders of the cells (i, j), at least ``least`` of a cell away from their corners.

    Edges that run along a grid line cross only the lines across it; a point on a corner counts to the cell above it or to its right.
    """

    def crossings(axis: str, p: str, q: str, d: float, o: float, e: float, f: float) -> DataFrame:
        a, b, u, v = F.col(p + "a"), F.col(p + "b"), F.col(q + "a"), F.col(q + "b")
        first, last = F.ceil((F.least(a, b) - o) / d).cast("int"), F.floor((F.greatest(a, b) - o) / d).cast("int")
        c = edges.filter(a != b).withColumn("m", F.explode(F.when(first <= last, F.sequence(first, last))))
        at = (u + (v - u) * (F.col("m") * d + o - a) / (b - a) - f) / e
        c = c.select("gid", "edge", "m", at.alias("at"), F.floor(at).cast("int").alias("n"))
        part = F.greatest(F.lit(least), F.least(F.lit(1 - least), F.col("at") - F.col("n")))
        c = c.select("gid", "edge", "m", "n", (F.col("m") * d + o).alias(p), ((F.col("n") + part) * e + f).alias(q))
        c = c.withColumn("side", F.explode(F.array(F.col("m") - 1, F.col("m"))))
        i, j = (F.col("side"), F.col("n")) if axis == "x" else (F.col("n"), F.col("side"))
        return c.select("gid", "edge", i.alias("i"), j.alias("j"), "x", "y")

    both = crossings("x", "x", "y", dom.dx, dom.origin_x, dom.dy, dom.origin_y).unionByName(crossings("y", "y", "x", dom.dy, dom.origin_y, dom.dx, dom.origin_x))
    return both.filter(F.col("i").between(0, dom.nx - 1) & F.col("j").between(0, dom.ny - 1))


def chords(points: DataFrame) -> DataFrame:
    """gid, i, j, px, py, qx, qy, plain: the chord of each cell that a wall crosses, from the lowest to the highest of its border points (by x, y); cells of one point have none.

    ``plain``: the wall crosses the cell once, along one edge.
    """
    p = F.struct("x", "y")
    c = points.groupBy("gid", "i", "j").agg(F.min(p).alias("p"), F.max(p).alias("q"), ((F.count("*") == 2) & (F.min("edge") == F.max("edge"))).alias("plain")).filter("p <> q")
    return c.select("gid", "i", "j", F.col("p.x").alias("px"), F.col("p.y").alias("py"), F.col("q.x").alias("qx"), F.col("q.y").alias("qy"), "plain")


def _both_halves(dom: Domain) -> list[Column]:
    """Corners of the parts of a cut cell left and right of its chord."""
    x0, y0 = F.col("i") * dom.dx + dom.origin_x, F.col("j") * dom.dy + dom.origin_y
    x1, y1 = x0 + dom.dx, y0 + dom.dy
    eps = 1e-9 * max(dom.dx, dom.dy)

    def place(x, y):
        on = F.when(F.abs(y - y0) <= eps, (x - x0) / dom.dx).when(F.abs(x - x1) <= eps, 1 + (y - y0) / dom.dy)
        return on.when(F.abs(y - y1) <= eps, 2 + (x1 - x) / dom.dx).otherwise(3 + (y1 - y) / dom.dy)

    at = lambda t, x, y: F.struct(t.cast("double").alias("t"), x.alias("x"), y.alias("y"))
    ends = [at(place(F.col(a), F.col(b)), F.col(a), F.col(b)) for a, b in (("px", "py"), ("qx", "qy"))]
    corners = [at(F.lit(k), a, b) for k, (a, b) in enumerate(((x0, y0), (x1, y0), (x1, y1), (x0, y1)))]
    border = F.array_sort(F.array(*corners, *ends))
    over = lambda p: (F.col("qx") - F.col("px")) * (p["y"] - F.col("py")) - (F.col("qy") - F.col("py")) * (p["x"] - F.col("px"))
    tiny = 1e-9 * dom.dx * dom.dy
    return [F.transform(F.filter(border, held), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))) for held in (lambda p: over(p) >= -tiny, lambda p: over(p) <= tiny)]


def cell_halves(cut_at: DataFrame, dom: Domain) -> DataFrame:
    """gid, i, j, side (1: left of the chord, 2: right), points, area, and the chord: both parts of each cut cell, counter-clockwise.

    A part is the corners on its side of the chord and the chord's ends, in the order of the border. Chords
    along a side of the cell cut nothing off and fall away.
    """
    c = cut_at.withColumn("half", F.array(*[F.struct(F.lit(k).alias("side"), p.alias("points")) for k, p in enumerate(_both_halves(dom), 1)]))

    def area(p: Column) -> Column:
        nxt = F.concat(F.slice(p, F.lit(2), F.size(p)), F.slice(p, 1, 1))
        return F.aggregate(F.zip_with(p, nxt, lambda a, b: a["x"] * b["y"] - b["x"] * a["y"]), F.lit(0.0), lambda s, v: s + v) / 2

    c = c.withColumn("half", F.transform("half", lambda h: F.struct(h["side"].alias("side"), h["points"].alias("points"), area(h["points"]).alias("area"))))
    c = c.filter(F.array_min(F.transform("half", lambda h: h["area"])) > 1e-6 * dom.dx * dom.dy).withColumn("half", F.explode("half"))
    return c.select("gid", "i", "j", "px", "py", "qx", "qy", "half.side", "half.points", "half.area")


def _under(g: list[np.ndarray], a: np.ndarray, b: np.ndarray, line: tuple | None = None) -> np.ndarray:
    """Area from x = a to b that lies in a unit cell under its chord (and under a line (x, y, slope)); ``g``: x, y, slope and far x of the chord, and the cell's corner."""
    px, py, slope, qx, x0, y0 = g
    stops = [a, b, np.clip(px, a, b), np.clip(qx, a, b)]
    if line is not None:
        lx, ly, rise = line
        with np.errstate(all="ignore"):
            meet = px + (ly + (px - lx) * rise - py) / (slope - rise)
        stops.append(np.clip(np.where(np.isfinite(meet), meet, a), a, b))
    stops = np.sort(np.stack(stops), axis=0)
    total = np.zeros(a.shape)
    for lo, hi in zip(stops[:-1], stops[1:]):  # all is straight between two stops
        x = (lo + hi) / 2
        with np.errstate(invalid="ignore"):
            y = np.where(np.isinf(slope), np.where(x < px, 0.0, 1.0), py + (x - px) * slope - y0)
        y = np.clip(y, 0.0, 1.0)
        if line is not None:
            y = np.minimum(y, ly + (x - lx) * rise - y0)
        total += y * (hi - lo)
    return total


def _built(i: np.ndarray, j: np.ndarray, ends: list[np.ndarray], chord: np.ndarray, before: float, at_once: int = 1 << 19) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Of each chord: the area above it and below it (left and right of an upright one) that an outline holds, and the area below it; and the last column's state for the cells that follow.

    Rows of whole unit cells, columns in turn, each from the top: pieces of the outline and chords (ends from the lower x).
    What lies under a piece counts by its direction. Pieces above a cell count with the whole cell below them: a column's state is
    how often its left border is covered there, and it changes along the top where a piece comes in or goes out.
    """
    xa, ya, xb, yb = ends
    cell = np.cumsum(np.append(True, (i[1:] != i[:-1]) | (j[1:] != j[:-1]))) - 1
    first = np.flatnonzero(np.diff(cell, prepend=-1))
    sign = np.where(chord, 0.0, np.sign(xa - xb))
    begins = sign * (np.minimum(xa, xb) == i)
    run = np.concatenate(([0.0], np.cumsum(begins)))
    column = np.flatnonzero(np.diff(i, prepend=i[0] - 1))
    carried = np.where(i == i[0], before, 0.0)
    state = run[first] - run[column[np.searchsorted(column, first, "right") - 1]] + carried[first]
    after = run[-1] - run[column[-1]] + carried[-1]
    pieces, asked = np.flatnonzero(~chord), np.flatnonzero(chord)
    of = np.searchsorted(cell[pieces], np.arange(first.size + 1))
    n = np.diff(of)[cell[asked]]
    whole, under, low = (np.zeros(asked.size) for _ in range(3))
    with np.errstate(divide="ignore", invalid="ignore"):
        slope = np.where(xa == xb, np.inf, (yb - ya) / (xb - xa))
    g_of = lambda c: [xa[c], ya[c], slope[c], xb[c], i[c].astype(float), j[c].astype(float)]
    ends_at = np.cumsum(n)
    a = 0
    while a < asked.size:  # as many chords as meet about at_once pieces, one at least
        z = max(a + 1, int(np.searchsorted(ends_at, (ends_at[a - 1] if a else 0) + at_once, "right")))
        own = asked[a:z]
        g, s = g_of(own), state[cell[own]]
        low[a:z] = _under(g, g[4], g[4] + 1)
        whole[a:z], under[a:z] = s, s * low[a:z]
        k = np.repeat(np.arange(a, z), n[a:z])
        p = pieces[of[cell[asked[k]]] + np.arange(k.size) - np.repeat(np.cumsum(n[a:z]) - n[a:z], n[a:z])]
        g = g_of(asked[k])
        lo, hi, rise = np.minimum(xa[p], xb[p]), np.maximum(xa[p], xb[p]), np.where(np.isfinite(slope[p]), slope[p], 0.0)
        full = sign[p] * (hi - lo) * ((ya[p] + yb[p]) / 2 - g[5])
        part = sign[p] * _under(g, lo, hi, (xa[p], ya[p], rise))
        for x, y, d in ((xa[p], ya[p], 1.0), (xb[p], yb[p], -1.0)):
            top = np.flatnonzero((y == g[5] + 1) & (x > g[4]))
            t = [v[top] for v in g]
            full[top] += d * (t[4] + 1 - x[top])
            part[top] += d * _under(t, np.minimum(x[top], t[4] + 1), t[4] + 1)
        whole[a:z] += np.bincount(k - a, full, z - a)
        under[a:z] += np.bincount(k - a, part, z - a)
        a = z
    return whole - under, under, low, after


def built_halves(cut_at: DataFrame, outline: DataFrame, dom: Domain) -> DataFrame:
    """``cut_at`` with ``left`` and ``right``: (area, built) of the part of the cell on each side of its chord; built: the area of the ``outline`` (without overlaps) in it, exact.

    Pieces of the outline and chords are sent to the column of their cell once, and are read there from the top down,
    with only the pieces of one cell and a count of what lies above in memory.
    """
    from cellweave.operators.spatial import edge_cells, tasks

    def units(c: str, o: float, d: float):
        u = (F.col(c) - o) / d
        return F.when(F.abs(u - F.rint(u)) < 1e-9, F.rint(u)).otherwise(u).alias(c)  # lines of the grid are exact

    lines = outline.select(F.lit(0).alias("gid"), *[units(c, *((dom.origin_x, dom.dx) if c[0] == "x" else (dom.origin_y, dom.dy))) for c in ("xa", "ya", "xb", "yb")])
    pieces = edge_cells(lines, Domain(dom.nx, dom.ny, 1.0, 1.0, 1.0, 0.0, 0.0)).filter("xa <> xb or ya <> yb").drop("gid")
    rows = pieces.unionByName(cut_at.select(F.col("i").cast("int").alias("i"), F.col("j").cast("int").alias("j"), F.struct(*cut_at.columns).alias("chord")), allowMissingColumns=True)
    rows = rows.repartition(tasks(outline.sparkSession, dom), "i").sortWithinPartitions("i", F.desc("j"))
    kept = cut_at.schema

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, column, state = [], None, 0.0

        def done(t: pa.Table) -> Iterator[pa.RecordBatch]:
            nonlocal column, state
            t = t.combine_chunks()
            num = lambda c: c.to_numpy(zero_copy_only=False)
            c = t["chord"].combine_chunks()
            i, j, chord = num(t["i"].combine_chunks()).astype("int64"), num(t["j"].combine_chunks()).astype("int64"), num(c.is_valid())
            own = c.filter(pa.array(chord))
            p, q = ([(num(own.field(s + x)).astype(float) - o) / d for x, o, d in (("x", dom.origin_x, dom.dx), ("y", dom.origin_y, dom.dy))] for s in "pq")
            turned = (p[0] > q[0]) | ((p[0] == q[0]) & (p[1] > q[1]))
            ends = [num(t[x].combine_chunks()).copy() for x in ("xa", "ya", "xb", "yb")]
            for x, one, two in zip(ends, (*p, *q), (*q, *p)):
                x[chord] = np.where(turned, two, one)
            above, below, low, state = _built(i, j, ends, chord, state if i[0] == column else 0.0)
            column = i[-1]
            if len(own):
                sides = [[np.where(turned, b, a) * (dom.dx * dom.dy) for a, b in pair] for pair in (((1 - low, low), (above, below)), ((low, 1 - low), (below, above)))]
                both = [pa.StructArray.from_arrays([pa.array(v) for v in side], ["area", "built"]) for side in sides]
                yield pa.RecordBatch.from_arrays([*own.flatten(), *both], [*kept.names, "left", "right"])

        for b in batches:
            if not b.num_rows:
                continue
            i, j = b.column("i").to_numpy(), b.column("j").to_numpy()
            last = int(np.flatnonzero((i != i[-1]) | (j != j[-1])).max(initial=-1)) + 1  # the last cell may go on
            same = waiting and (waiting[-1].column("i")[0].as_py(), waiting[-1].column("j")[0].as_py()) == (i[-1], j[-1])
            if last or (waiting and not same):
                yield from done(pa.Table.from_batches([*waiting, b.slice(0, last)]))
                waiting = []
            waiting.append(b.slice(last))
        if waiting:
            yield from done(pa.Table.from_batches(waiting))

    part = T.StructType([T.StructField(c, T.DoubleType()) for c in ("area", "built")])
    return rows.mapInArrow(meet, T.StructType([*kept.fields, T.StructField("left", part), T.StructField("right", part)]))


def split_cell(cut_at: DataFrame, outline: DataFrame, dom: Domain) -> DataFrame:
    """gid, i, j, side, points, area, share, nx, ny: the part of each cut cell that lies more in the buildings (the right one on a tie), and the chord's unit normal that points away from it; further columns of ``cut_at`` stay.

    ``outline``: the buildings as an outline without overlaps. Shares are exact areas within the parts.
    """
    rest = [c for c in cut_at.columns if c not in ("gid", "i", "j", "px", "py", "qx", "qy")]
    h = built_halves(cut_at, outline, dom).filter(F.least("left.area", "right.area") > 1e-6 * dom.dx * dom.dy)
    h = h.withColumns({k: F.round(F.col(k + ".built") / F.col(k + ".area"), 6) + 0.0 for k in ("left", "right")} | {"areas": F.struct(F.col("left.area").alias("left"), F.col("right.area").alias("right"))})
    first = F.col("left") > F.col("right")
    pick = lambda a, b: F.when(first, a).otherwise(b)
    one, two = _both_halves(dom)
    away = F.when(first, 1.0).otherwise(-1.0)
    vx, vy = F.col("qx") - F.col("px"), F.col("qy") - F.col("py")
    size = F.sqrt(vx * vx + vy * vy)
    return h.select("gid", "i", "j", pick(1, 2).alias("side"), pick(one, two).alias("points"), pick(F.col("areas.left"), F.col("areas.right")).alias("area"), pick(F.col("left"), F.col("right")).alias("share"), (away * vy / size).alias("nx"), (-away * vx / size).alias("ny"), *rest)
