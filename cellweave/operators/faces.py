"""Faces of cut cells as rings of 3-D vertices: terrain, slices by level, flat tops, keys of vertices, closed surfaces.

A face is a row with ``verts ARRAY<STRUCT<x, y, z>>``, counter-clockwise seen from the air. Everything up to
the keys of vertices is done inside a row: slices and keys over whole batches of rings at once, the rest by expressions over the array.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.domain import Domain
from cellweave.operators.numbering import number_rows
from cellweave.session import cut

#: Steps (k, j, i) from the full corner of a vertex to the free one, by direction.
STEPS = [(1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1)]


#: Cells along the side of a square of terrain that is made at once.
TILE = 128
RING = T.ArrayType(T.StructType([T.StructField(c, T.DoubleType()) for c in "xyz"]))


def point(x: Column, y: Column, z: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"), z.cast("double").alias("z"))


def _turned(ring: Column, by: int) -> Column:
    """The ring that starts ``by`` places later (1) or earlier (-1)."""
    n = F.size(ring)
    return F.concat(F.slice(ring, 2, n), F.slice(ring, 1, 1)) if by == 1 else F.concat(F.slice(ring, -1, 1), F.slice(ring, F.lit(1), n - 1))


def _heights(ring: Column) -> tuple[Column, Column]:
    z = F.transform(ring, lambda v: v["z"])
    return F.array_min(z), F.array_max(z)


def _rings(starts: np.ndarray, points: list[np.ndarray]) -> pa.Array:
    """Rings as an array column; ``starts``: where each begins, and the end."""
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.StructArray.from_arrays([pa.array(p) for p in points], "xyz"))


def _as_rings(faces: DataFrame, verts: str) -> Column:
    """The rings with coordinates in double precision."""
    plain = faces.schema[verts].dataType.simpleString() == RING.simpleString()
    return F.col(verts) if plain else F.transform(verts, lambda v: point(v["x"], v["y"], v["z"]))


def _starts(of: np.ndarray, rings: int) -> np.ndarray:
    """Where each ring begins, and the end; ``of``: ring of each point, in order."""
    return np.concatenate(([0], np.cumsum(np.bincount(of, minlength=rings))))


def _distinct(of: np.ndarray, points: list[np.ndarray], rings: int) -> np.ndarray:
    """Which points are not yet in their ring before."""
    at = np.arange(of.size) - _starts(of, rings)[of]
    new = np.ones(of.size, bool)
    for lag in range(1, at.max(initial=0) + 1):
        here = np.flatnonzero(at >= lag)
        new[here[np.logical_and.reduce([p[here] == p[here - lag] for p in points])]] = False
    return new


def _layers(rings: pa.ListArray, dz: float, at_once: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """(row, k, ring) of every layer that the rings reach.

    Crossings are found from the lower end of a whole side, so faces and layers that share one get the same point.
    """
    of = pc.list_parent_indices(rings).to_numpy().astype("int64")
    flat = rings.flatten()
    p = [c.to_numpy(zero_copy_only=False) for c in flat.flatten()]  # null as NaN
    ok = np.logical_and.reduce([~np.isnan(c) for c in p])
    of, p = of[ok], [c[ok] for c in p]
    new = _distinct(of, p, len(rings))
    of, p = of[new], [c[new] for c in p]
    enough = np.bincount(of, minlength=len(rings)) >= 3
    of, p = of[enough[of]], [c[enough[of]] for c in p]
    if not of.size:
        return
    rows, first = np.unique(of, return_index=True)
    size = np.diff(np.append(first, of.size))
    last = np.ceil(np.maximum.reduceat(p[2], first) / dz).astype("int64") - 1
    low = np.minimum(np.floor(np.minimum.reduceat(p[2], first) / dz).astype("int64"), last)
    n = last - low + 1
    ends = np.cumsum(n * size)
    after = np.arange(of.size) + 1
    after[first + size - 1] = first
    a = 0
    while a < rows.size:  # as many faces as make about at_once points, one at least
        z = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + at_once, "right")))
        face = np.repeat(np.arange(a, z), n[a:z])
        k = low[face] + np.arange(face.size) - np.repeat(np.cumsum(n[a:z]) - n[a:z], n[a:z])
        side = np.repeat(np.arange(face.size), size[face])
        here = first[face][side] + np.arange(side.size) - np.repeat(np.cumsum(size[face]) - size[face], size[face])
        there, bottom, top = after[here], (k * dz)[side], ((k + 1) * dz)[side]
        rising = p[2][here] < p[2][there]
        lo, hi = np.where(rising, here, there), np.where(rising, there, here)
        rise = p[2][hi] - p[2][lo]
        rise[rise == 0] = np.nan

        def met(level):
            t = (level - p[2][lo]) / rise  # noqa: B023
            return [p[0][lo] + t * (p[0][hi] - p[0][lo]), p[1][lo] + t * (p[1][hi] - p[1][lo]), level], (p[2][lo] < level) & (p[2][hi] > level)  # noqa: B023

        one, two = met(np.where(rising, bottom, top)), met(np.where(rising, top, bottom))
        keep = np.stack([(p[2][here] >= bottom) & (p[2][here] <= top), one[1], two[1]], 1).ravel()
        out = [np.stack([p[c][here], one[0][c], two[0][c]], 1).ravel()[keep] for c in range(3)]
        of_out = np.repeat(side, 3)[keep]
        new = _distinct(of_out, out, face.size)
        of_out, out = of_out[new], [c[new] for c in out]
        whole = np.bincount(of_out, minlength=face.size) >= 3
        name = np.cumsum(whole) - 1
        kept = whole[of_out]
        yield rows[face[whole]], k[whole], _rings(_starts(name[of_out[kept]], int(whole.sum())), [c[kept] for c in out])
        a = z


def slice_faces(faces: DataFrame, dz: float, verts: str = "verts") -> DataFrame:
    """Each face once for every layer k (from k*dz to (k+1)*dz) that it reaches, cut to the layer; other columns stay.

    A level face belongs to the layer whose top it is, if it lies on a level. Repeated vertices count once, vertices with
    unknown coordinates not at all; faces of fewer than three fall away, and so do null faces. Parts of convex faces are exact;
    in a saddle, whose opposite corners leave the layer, the corners that stay are joined across the middle.
    """
    kept = [c for c in faces.columns if c not in (verts, "k")]
    names = [c for c in faces.columns if c != "k"] + ["k"]

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, k, ring in _layers(b.column(verts), dz):
                own = b.select(kept).take(pa.array(row)) if kept else None
                made = {verts: ring, "k": pa.array(k, pa.int32())}
                yield pa.RecordBatch.from_arrays([made[c] if c in made else own.column(c) for c in names], names)

    schema = T.StructType([T.StructField(verts, RING) if c == verts else T.StructField("k", T.IntegerType()) if c == "k" else faces.schema[c] for c in names])
    return faces.withColumn(verts, _as_rings(faces, verts)).filter(F.col(verts).isNotNull()).mapInArrow(cut_up, schema)


def wall_faces(walls: DataFrame) -> DataFrame:
    """``verts`` of upright walls (x1, y1) to (x2, y2), with the air on the right, from z1b and z2b up to z1 and z2; other columns stay."""
    p = lambda n, z: point(F.col("x" + n), F.col("y" + n), F.col(z))
    return walls.withColumn("verts", F.array(p("1", "z1b"), p("2", "z2b"), p("2", "z2"), p("1", "z1"))).drop("x1", "y1", "x2", "y2", "z1", "z2", "z1b", "z2b")


def slice_walls(walls: DataFrame, dz: float) -> DataFrame:
    """Upright walls cut to the layers that they reach."""
    return slice_faces(wall_faces(walls), dz)


def terrain_faces(corners: DataFrame, dom: Domain) -> DataFrame:
    """i, j, verts: one face for each cell whose four corners (i, j, z) are all known.

    Corners meet in squares of ``TILE`` cells, so each is sent about once, and faces beside each other stay together.
    """
    to = lambda c: F.explode(F.array_distinct(F.array(F.floor((F.col(c) - 1) / TILE), F.floor(F.col(c) / TILE))))
    c = corners.filter("z is not null").select("i", "j", F.col("z").cast("double").alias("z"))
    i_type, j_type = c.schema["i"].dataType, c.schema["j"].dataType
    c = c.withColumn("_ti", to("i")).withColumn("_tj", to("j"))

    def one(t: pa.Table) -> pa.Table:
        i, j = (t[n].to_numpy().astype("int64") for n in "ij")
        i0, j0 = t["_ti"][0].as_py() * TILE, t["_tj"][0].as_py() * TILE
        z = np.full((TILE + 1, TILE + 1), np.nan)
        known = np.zeros(z.shape, bool)
        z[i - i0, j - j0], known[i - i0, j - j0] = t["z"].to_numpy(), True
        a, b = np.nonzero(known[:-1, :-1] & known[1:, :-1] & known[1:, 1:] & known[:-1, 1:])
        ring_i, ring_j = a[:, None] + [0, 1, 1, 0], b[:, None] + [0, 0, 1, 1]
        at = [((ring_i + i0) * dom.dx + dom.origin_x).ravel(), ((ring_j + j0) * dom.dy + dom.origin_y).ravel(), z[ring_i, ring_j].ravel()]
        ids = [pa.array(x, t[n].type) for x, n in ((a + i0, "i"), (b + j0, "j"))]
        return pa.table([*ids, _rings(np.arange(a.size + 1) * 4, [x.astype(float) for x in at])], ["i", "j", "verts"])

    return c.groupBy("_ti", "_tj").applyInArrow(one, T.StructType([T.StructField("i", i_type), T.StructField("j", j_type), T.StructField("verts", RING)]))


def split_flat_tops(faces: DataFrame, dz: float, verts: str = "verts") -> DataFrame:
    """Faces, with those of three or more vertices on the level that is their top split into two; ``part``: 0 whole, 1 the rest, 2 the flat top.

    The rest keeps what lies lower and the top vertices next to it. Level faces and tops between levels stay whole.
    """
    ring = F.col(verts)
    low, top = _heights(ring)
    f = faces.withColumn("low", low).withColumn("top", top)
    flat = F.filter(ring, lambda v: v["z"] == F.col("top"))
    next_to = F.zip_with(F.zip_with(ring, _turned(ring, -1), lambda v, p: F.struct(v.alias("v"), p["z"].alias("p"))), _turned(ring, 1), lambda v, n: F.struct(v["v"].alias("v"), F.least(v["v"]["z"], v["p"], n["z"]).alias("m")))
    rest = F.transform(F.filter(next_to, lambda v: v["m"] < F.col("top")), lambda v: v["v"])
    split = (F.size(flat) >= 3) & (F.col("low") < F.col("top")) & (F.col("top") / dz == F.rint(F.col("top") / dz))
    one = lambda n, r: F.struct(F.lit(n).alias("part"), r.alias("verts"))
    f = f.withColumn("piece", F.explode(F.when(split, F.array(one(1, rest), one(2, flat))).otherwise(F.array(one(0, ring)))))
    return f.withColumn(verts, F.col("piece.verts")).withColumn("part", F.col("piece.part")).filter((F.col("part") == 0) | (F.size(verts) >= 3)).drop("piece", "low", "top")


def _keys(rings: pa.ListArray, dom: Domain) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray], list[pa.Array]]:
    """Of every vertex: its ring, its place there, whether it has no key, (k, j, i, dir, len), and its coordinates."""
    of = pc.list_parent_indices(rings).to_numpy().astype("int64")
    shown = rings.flatten().flatten()
    xyz = [c.to_numpy(zero_copy_only=False) for c in shown]  # null as NaN
    starts = _starts(of, len(rings))
    at, here = np.arange(of.size) - starts[of], np.arange(of.size)
    before = np.where(at == 0, starts[of + 1] - 1, here - 1)
    after = np.where(here + 1 == starts[of + 1], starts[of], here + 1)
    u, w = [c - c[before] for c in xyz], [c[after] - c for c in xyz]
    cell = [(xyz[0] - dom.origin_x) / dom.dx, (xyz[1] - dom.origin_y) / dom.dy, xyz[2] / dom.dz]
    near = [np.rint(c) for c in cell]
    on = [np.abs(c - r) < 1e-9 for c, r in zip(cell, near)]
    lean, found = [], []
    for n, c in enumerate((2, 1, 0)):
        p, q = (c + 1) % 3, (c + 2) % 3
        turn = u[p] * w[q] - u[q] * w[p]
        full = np.where(on[c], near[c], np.where(turn >= 0, np.floor(cell[c]), np.ceil(cell[c])))
        lean.append(np.where(on[p] & on[q] & ~np.isnan(cell[c]), np.where(np.isnan(turn), -0.5, np.abs(turn)), -1.0))
        found.append([*[full if e == c else near[e] for e in (2, 1, 0)], np.where(turn >= 0, 2.0 * n, 2.0 * n + 1), np.where(on[c], 0.0, np.abs(cell[c] - full))])
    most = np.argmax(lean, axis=0)  # the first of equals: k, j, i
    none = np.max(lean, axis=0) == -1
    return of, at, none, [np.where(none, 0.0, np.choose(most, [f[v] for f in found])) for v in range(5)], shown


def vertex_keys(faces: DataFrame, dom: Domain, fid: str = "fid", verts: str = "verts") -> DataFrame:
    """fid, at, k, j, i, dir, len, x, y, z: the edge of the cell that each vertex lies on, as full corner and direction to the free one, and its distance from the full corner in cells.

    The free side is where the face turns its air side at the vertex. A vertex on a corner takes the edge that its face leans to most
    (ties: k, j, i). Vertices on no edge of a cell, or with an unknown coordinate, have no key.
    """
    names = ["fid", "at", "k", "j", "i", "dir", "len", "x", "y", "z"]

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of, at, none, e, shown = _keys(b.column("verts"), dom)
            e = [pa.array(v if n == 4 else v.astype("int32"), mask=none) for n, v in enumerate(e)]
            yield pa.RecordBatch.from_arrays([b.column("fid").take(pa.array(of)), pa.array(at, pa.int32()), *e, *shown], names)

    kinds = {"fid": faces.schema[fid].dataType, **dict.fromkeys(("at", "k", "j", "i", "dir"), T.IntegerType())}
    schema = T.StructType([T.StructField(n, kinds.get(n, T.DoubleType())) for n in names])
    return faces.select(F.col(fid).alias("fid"), _as_rings(faces, verts).alias("verts")).mapInArrow(keyed, schema)


def keyed_index(keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vid, k, j, i, dir, len) of every edge that holds a vertex, numbered by (k, j, i, dir), and the faces as (fid, at, vid); vertices without a key are left out."""
    on_edge = cut(keys.filter("dir is not null").select("fid", "at", "k", "j", "i", "dir", "len"))
    v = cut(number_rows(on_edge.groupBy("k", "j", "i", "dir").agg(F.min("len").alias("len")), ["k", "j", "i", "dir"], "vid"))
    return v.select("vid", "k", "j", "i", "dir", "len"), on_edge.join(v.select("k", "j", "i", "dir", "vid"), ["k", "j", "i", "dir"]).select("fid", "at", "vid")


def watertight_check(refs: DataFrame, vertices: DataFrame, dom: Domain) -> DataFrame:
    """rule, what, n: what keeps a surface of cut cells from being closed; no rows for a sound one.

    ``refs``: fid, at, vid; ``vertices``: vid, k, j, i, dir, len. Rules:
    corner - a corner (k, j, i) that is full for one vertex and free for another; n: vertices that say so.
    unknown - a face that refers to a vertex that is not there; n: how often.
    repeated - a face that ends with its first vertex; n: vertices of the face.
    edge - a face with neighbours in its ring that are not one step apart (same direction) or share no corner; n: such pairs.
    faces - a vertex with other than 4 faces (2 on a side of the domain, 1 where two sides meet), singular ones aside; n: its faces.
    A vertex is singular if it lies on its full corner, or if one of its faces has a vertex that lies on that same corner.
    """
    steps = F.array(*[F.struct(*[F.lit(s).alias(c) for s, c in zip(step, "kji")]) for step in STEPS])
    v = vertices.withColumn("s", F.element_at(steps, F.col("dir") + 1))
    corner = lambda free: F.struct(*[(F.col(c) + F.col("s." + c) * free).alias(c) for c in "kji"])
    v = v.select("vid", "dir", "len", corner(0).alias("full"), corner(1).alias("free"), F.struct("s.k", "s.j", "s.i").alias("s"))
    name = lambda c: F.concat_ws(",", F.col(c + ".k"), F.col(c + ".j"), F.col(c + ".i"))
    ends = v.select(F.explode(F.array(F.struct(F.col("full").alias("c"), F.lit(1).alias("is")), F.struct(F.col("free").alias("c"), F.lit(0).alias("is")))).alias("e")).select("e.*")
    clash = ends.groupBy("c").agg(F.count("*").alias("n"), F.min("is").alias("a"), F.max("is").alias("b")).filter("a <> b")
    clash = clash.select(F.lit("corner").alias("rule"), name("c").alias("what"), "n")

    # a face's vertices lie in one sorted run: neighbours are looked at in passing, no ring is collected
    run = W.partitionBy("fid")
    along = run.orderBy("at", "vid")
    r = refs.select("fid", "at", "vid").join(v, "vid", "left")
    seen = F.struct("dir", "full", "free")
    r = r.select("fid", "vid", "dir", "full", "free", "s", F.lead(seen).over(along).alias("b"), F.first("vid").over(along).alias("start"), F.collect_set(F.when(F.col("len") == 0, F.col("full"))).over(run).alias("on"))
    gap = [F.col(f"b.full.{c}") - F.col(f"full.{c}") for c in "kji"]
    moved = sum((F.abs(g) for g in gap[1:]), F.abs(gap[0]))
    ahead = sum((g * F.col(f"s.{c}") for g, c in zip(gap[1:], "ji")), gap[0] * F.col("s.k"))
    same = lambda x: F.col("b." + x).eqNullSafe(F.col(x))
    bad = F.when(F.col("dir").isNull() | F.col("b.dir").isNull(), False).when(F.col("dir") == F.col("b.dir"), (ahead != 0) | (moved != 1)).otherwise(~(same("full") | same("free")))
    # a vertex of a face is singular if any of that face's vertices lies on its full corner
    r = cut(r.select("fid", "vid", bad.alias("bad"), F.col("dir").isNull().alias("lost"), (F.col("b").isNull() & (F.col("start") == F.col("vid"))).alias("back"), F.array_contains("on", F.col("full")).alias("single")))
    found = r.groupBy("fid").agg(F.count("*").alias("m"), F.count_if("lost").alias("lost"), F.max("back").alias("back"), F.count_if("bad").alias("bad")).filter("lost > 0 or back or bad > 0")
    found = found.select("fid", F.explode(F.array(
        F.struct(F.lit("unknown").alias("rule"), F.col("lost").alias("n")),
        F.struct(F.lit("repeated").alias("rule"), F.when(F.col("back"), F.col("m")).otherwise(0).alias("n")),
        F.struct(F.lit("edge").alias("rule"), F.col("bad").alias("n")))).alias("e")).filter("e.n > 0")
    found = found.select("e.rule", F.col("fid").cast("string").alias("what"), F.col("e.n").cast("long").alias("n"))
    per = r.groupBy("vid").agg(F.count("*").alias("n"), F.max("single").alias("single"))
    per = v.join(per, "vid", "left").fillna({"n": 0, "single": False})
    border = lambda c, size: (F.col("full." + c) == F.col("free." + c)) & F.col("full." + c).isin([0, size])
    sides = border("i", dom.nx).cast("int") + border("j", dom.ny).cast("int") + ((F.col("full.k") == 0) & (F.col("free.k") == 0)).cast("int")
    due = F.when(sides == 0, 4).when(sides == 1, 2).when(sides == 2, 1).otherwise(-1)
    wrong = per.filter((F.col("n") != due) & ~F.col("single") & (F.col("len") != 0)).select(F.lit("faces").alias("rule"), F.col("vid").cast("string").alias("what"), "n")
    return clash.unionByName(found).unionByName(wrong)


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal keys together, and where each group begins in it."""
    order = np.lexsort(keys)
    new = np.ones(order.size, bool)
    new[1:] = np.logical_or.reduce([k[order[1:]] != k[order[:-1]] for k in keys])
    return order, np.flatnonzero(new)


def closed_check(faces: DataFrame, dom: Domain, here: Column | None = None, fid: str = "fid", verts: str = "verts") -> DataFrame:
    """rule, what, k, j, i, dir, n: the rules of ``watertight_check`` for the index of ``faces`` itself; k, j, i, dir: the vertex of rule "faces", else null.

    Faces that are not ``here`` have vertices in the index, but are missing from the surface. Rules of a face, and which of its vertices
    share a full corner, are found in whole batches of rings. For the rest all that is known of a corner meets in one row: the
    faces of the up to six vertices that lie on its edges, and bits for what holds of them. One shuffle of about a row for each corner,
    combined before it is sent; no index is numbered, written or joined.
    """
    steps = np.array(STEPS)
    counts = [f"n{d}" for d in range(6)]
    # bits by direction: the corner is full in a vertex (0), which lies on it (6), it is free in one (12); from 18 on
    # for each direction which vertices of that corner share a face with its vertex
    names = ["rule", "what", "k", "j", "i", *counts, "bits"]
    kinds = {"rule": T.StringType(), "what": T.StringType(), **dict.fromkeys("kji", T.IntegerType())}
    schema = T.StructType([T.StructField(n, kinds.get(n, T.LongType())) for n in names])

    def defects(own: pa.Array, of: np.ndarray, at: np.ndarray, d: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows, first = np.unique(of, return_index=True)
        size = np.diff(np.append(first, of.size))
        last, end = first + size - 1, at + steps[d]
        gap = at[1:] - at[:-1]
        straight = ((gap * steps[d[:-1]]).sum(1) != 0) | (np.abs(gap).sum(1) != 1)
        apart = (gap != 0).any(1) & (end[1:] != end[:-1]).any(1)
        bad = np.append(np.where(d[1:] == d[:-1], straight, apart) & (of[1:] == of[:-1]), False)
        back = (at[first] == at[last]).all(1) & (d[first] == d[last])
        for rule, n in (("repeated", np.where(back, size, 0)), ("edge", np.add.reduceat(bad.astype("int64"), first))):
            if hit := np.flatnonzero(n).tolist():
                none, zero = pa.nulls(len(hit), pa.int32()), pa.array(np.zeros(len(hit), "int64"))
                yield pa.RecordBatch.from_arrays([pa.array([rule] * len(hit)), own.take(pa.array(rows[hit])), none, none, none, pa.array(n[hit]), *[zero] * 6], names)

    def looked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of, _, none, e, _ = _keys(b.column("verts"), dom)
            of, e = of[~none], [v[~none] for v in e]
            if not of.size:
                continue
            at, d, zero = np.stack(e[:3], 1).astype("int64"), e[3].astype("int64"), e[4] == 0
            on = b.column("here").to_numpy(zero_copy_only=False)[of]
            if on.any():
                yield from defects(b.column("what"), of[on], at[on], d[on])
            order, first = _groups(*at.T, of)
            shared = np.repeat(np.bitwise_or.reduceat((1 << d)[order], first), np.diff(np.append(first, of.size)))
            near = np.empty_like(d)
            near[order] = shared
            bits = np.concatenate([(1 << d) | (zero << (6 + d)) | np.where(on, near << (18 + 6 * d), 0), 1 << (12 + d)])
            corner = np.concatenate([at, at + steps[d]])
            order, first = _groups(*corner.T)
            n = [np.add.reduceat(np.concatenate([on & (d == x), np.zeros(d.size, bool)])[order].astype("int64"), first) for x in range(6)]
            made = [pa.array(v) for v in (*corner[order[first]].astype("int32").T, *n, np.bitwise_or.reduceat(bits[order], first))]
            none = pa.nulls(first.size, pa.string())
            yield pa.RecordBatch.from_arrays([none, none, *made], names)

    f = faces.select(F.col(fid).cast("string").alias("what"), _as_rings(faces, verts).alias("verts"), F.coalesce(F.lit(True) if here is None else here, F.lit(False)).alias("here"))
    c = f.mapInArrow(looked, schema).groupBy("rule", "what", "k", "j", "i").agg(*[F.sum(n).alias(n) for n in counts], F.expr("bit_or(bits)").alias("bits"))

    part = lambda low, size=6: F.shiftright(F.col("bits"), low).bitwiseAND((1 << size) - 1)

    def due(d: int) -> Column:
        flat = [x for x, s in zip("kji", STEPS[d]) if s == 0]
        sides = sum((F.col(x).isin([0, *([n] if n is not None else [])]).cast("int") for x, n in (("i", dom.nx), ("j", dom.ny), ("k", None)) if x in flat), F.lit(0))
        return F.when(sides == 0, 4).when(sides == 1, 2).when(sides == 2, 1).otherwise(-1)

    key = [F.lit(None).cast("int").alias(x) for x in ("k", "j", "i", "dir")]
    row = lambda rule, what, n, k=key: F.struct(rule.alias("rule"), what.alias("what"), *k, n.cast("long").alias("n"))
    wrong = []
    for d in range(6):
        single = part(18 + 6 * d).bitwiseAND(part(6)) != 0
        odd = (part(d, 1) == 1) & (F.col(f"n{d}") != due(d)) & ~single & (part(6 + d, 1) == 0)
        wrong.append(F.when(odd, row(F.lit("faces"), F.concat_ws(",", "k", "j", "i", F.lit(d)), F.col(f"n{d}"), [F.col("k"), F.col("j"), F.col("i"), F.lit(d).alias("dir")])))
    clash = F.when((part(0) != 0) & (part(12) != 0), row(F.lit("corner"), F.concat_ws(",", "k", "j", "i"), F.bit_count(part(0)) + F.bit_count(part(12))))
    of_face = F.when(F.col("rule").isNotNull(), F.array(row(F.col("rule"), F.col("what"), F.col("n0"))))
    return c.select(F.explode(F.filter(F.coalesce(of_face, F.array(clash, *wrong)), lambda r: r.isNotNull())).alias("r")).select("r.*")
