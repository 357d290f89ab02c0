"""Shares of cut cells by columns: equal to clipping every half, without joins."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.domain import Domain
from cellweave.operators import arrange as ar
from cellweave.operators import cutcell as cc
from cellweave.operators import edges as ed
from cellweave.plans.grid_queries import QUERIES

EDGES = "gid int, edge int, xa double, ya double, xb double, yb double"
SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def walls(seed, dom):
    """Polygons that overlap, hold each other, lie on lines of the grid, and reach over many cells and out of the domain."""
    rnd = random.Random(seed)
    w, h = dom.nx * dom.dx, dom.ny * dom.dy
    out = []
    for gid in range(12):
        cx, cy, size = rnd.uniform(0, w), rnd.uniform(-0.1 * h, 1.1 * h), rnd.choice([0.4, 0.9, 2.2])
        if gid % 4 == 0:  # corners of the grid
            x0, y0 = dom.dx * rnd.randrange(dom.nx - 2), dom.dy * rnd.randrange(dom.ny - 2)
            ring = [(x0, y0), (x0 + 2 * dom.dx, y0), (x0 + 2 * dom.dx, y0 + dom.dy), (x0 + dom.dx, y0 + 2 * dom.dy), (x0, y0 + 2 * dom.dy)]
        else:
            turns = sorted(rnd.uniform(0, 2 * math.pi) for _ in range(rnd.randrange(3, 8)))
            ring = [(cx + size * dom.dx * math.cos(t), cy + size * dom.dy * math.sin(t)) for t in turns]
        ring = [(x + dom.origin_x, y + dom.origin_y) for x, y in ring]
        out += [(gid, k, *ring[k], *ring[(k + 1) % len(ring)]) for k in range(len(ring))]
    return out


def clipped(cut_at, outline, dom):
    """Built area of each half, by clipping it."""
    halves = cc.cell_halves(cut_at, dom).withColumn("id", F.struct("gid", "i", "j", "side"))
    ids = {tuple(r["id"]): (n, r["area"]) for n, r in enumerate(halves.select("id", "area").orderBy("id").collect())}
    number = F.udf(lambda a: ids[tuple(a)][0], "int")
    built = ed.areas(ar.clip(ar.ring_pieces(halves.withColumn("id", number("id")), "id"), outline, "inside", max(dom.dx, dom.dy)))
    found = {r["gid"]: r["area"] for r in built.collect()}
    return {k: (area, found.get(n, 0.0)) for k, (n, area) in ids.items()}


@pytest.mark.parametrize("seed,dom", [(1, Domain(9, 8, 10.0, 10.0, 5.0, 0.0, 0.0)), (2, Domain(9, 8, 0.7, 0.3, 5.0, -40.1, 3.7)), (3, Domain(7, 12, 10.0, 4.0, 5.0, -20.0, 100.0))])
def test_halves_are_built_as_clipped(spark, monkeypatch, seed, dom):
    if dom.dx < 1:
        monkeypatch.setattr(ar, "SNAP", 9)  # the clipped ones are of few micrometres
        monkeypatch.setattr(ar, "NEAR", 2e-9)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # cells and columns go on in the next batch
    try:
        e = spark.createDataFrame(walls(seed, dom), EDGES).cache()
        chords = cc.chords(cc.grid_points(e, dom))
        turned = chords.withColumns({"gid": F.col("gid") + 100, "px": F.col("qx"), "py": F.col("qy"), "qx": F.col("px"), "qy": F.col("py")})
        both = chords.unionByName(turned).cache()
        outline = ar.dissolve(e, max(dom.dx, dom.dy)).cache()
        got = {(r["gid"], r["i"], r["j"]): r for r in cc.built_halves(both, outline, dom).collect()}
        want = clipped(both, outline, dom)
        assert len(got) == both.count() and len(want) > 80
        for (gid, i, j, side), (area, built) in want.items():
            r = got[gid, i, j]["left" if side == 1 else "right"]
            assert (r["area"], r["built"]) == pytest.approx((area, built), abs=2e-5 * dom.dx * dom.dy)
        shares = [round(b / a, 3) for a, b in want.values()]
        assert 0.0 in shares and 1.0 in shares and len(set(shares)) > 12
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_many_chords_of_a_cell_meet_in_parts():
    """The same areas however few pairs of chords and pieces are held at once."""
    rnd = random.Random(4)
    ring = [(0.2, 0.1), (0.9, 0.3), (0.7, 0.8), (0.3, 0.6)]
    rows = [(*ring[k], *ring[(k + 1) % 4], False) for k in range(4)] + [(0.0, rnd.random(), 1.0, rnd.random(), True) for _ in range(50)]
    rnd.shuffle(rows)
    ends, chord = [np.array([r[c] for r in rows]) for c in range(4)], np.array([r[4] for r in rows])
    zero = np.zeros(len(rows), "int64")
    a, b = (cc._built(zero, zero, ends, chord, 0.0, n) for n in (1 << 19, 3))
    assert all(np.allclose(x, y) for x, y in zip(a, b)) and np.allclose(a[0] + a[1], a[0][0] + a[1][0])


def test_cut_cells_are_not_clipped(spark):
    """After the outline is made, its pieces and the chords are sent to their columns once; nothing is joined."""
    e = spark.createDataFrame(walls(5, Domain(9, 8, 10.0, 10.0, 5.0, 0.0, 0.0)), EDGES)
    dom = Domain(9, 8, 10.0, 10.0, 5.0, 0.0, 0.0)
    p = plan(cc.split_cell(cc.chords(cc.grid_points(e, dom)), e.select("xa", "ya", "xb", "yb"), dom))
    assert "Join" not in p and "Window" not in p and p.count("Exchange hashpartitioning") == 2
    assert "array_sort" not in plan(QUERIES["k8_chord_normal"](spark, SF))  # corners of halves are not made where they are not asked for
