"""Union, clipping, rings and hulls of polygons against plain counts on small squares and random points."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cellweave.domain import Domain
from cellweave.operators import arrange as ar
from cellweave.operators import edges as ed
from cellweave.operators import spatial as sp

EDGES = "gid long, xa double, ya double, xb double, yb double"


def ring(gid, points):
    return [(gid, float(a[0]), float(a[1]), float(b[0]), float(b[1])) for a, b in zip(points, points[1:] + points[:1])]


def box(gid, x0, y0, x1, y1):
    return ring(gid, [(x0, y0), (x1, y0), (x1, y1), (x0, y1)])


def diamond(gid, x, y, r):
    return ring(gid, [(x + r, y), (x, y + r), (x - r, y), (x, y - r)])


def star(gid, x, y, r, n, seed):
    rnd = random.Random(seed)
    return ring(gid, [(round(x + (q := r * rnd.uniform(0.4, 1)) * math.cos(2 * math.pi * k / n), 3), round(y + q * math.sin(2 * math.pi * k / n), 3)) for k in range(n)])


def held(edges, x, y):
    """Parity of crossings, by polygon."""
    out = {}
    for g, xa, ya, xb, yb in edges:
        if (ya > y) != (yb > y) and xa + (y - ya) * (xb - xa) / (yb - ya) > x:
            out[g] = not out.get(g, False)
    return {g for g, v in out.items() if v}


def frame(spark, edges):
    return spark.createDataFrame(edges, EDGES)


def test_inside_is_parity(spark):
    rnd = random.Random(1)
    edges = [e for k in range(12) for e in star(k, rnd.uniform(0, 60), rnd.uniform(0, 60), rnd.uniform(3, 40), rnd.choice([3, 7, 40]), k)] + box(20, 10, 10, 30, 30)
    pts = [(k, rnd.uniform(-20, 90), rnd.uniform(-20, 90)) for k in range(400)] + [(400, 10.0, 10.0), (401, 30.0, 20.0), (402, 10.0, 30.0)]
    got = {}
    for r in sp.inside(spark.createDataFrame(pts, "id long, x double, y double"), frame(spark, edges), Domain(1, 1, 7.0, 5.0, 1.0, 0.5, 0.25)).collect():
        got.setdefault(r["id"], set()).add(r["gid"])
    assert got == {k: h for k, x, y in pts if (h := held(edges, x, y))}


def test_coverage_of_a_large_polygon(spark):
    """Ten thousand edges over a grid: rows follow the outline and the cells covered."""
    big = star(1, 200.0, 200.0, 190.0, 10_000, 3)
    dom = Domain(40, 40, 10.0, 10.0, 1.0, 0.0, 0.0)
    c = sp.coverage(frame(spark, big), dom).toPandas()
    area = sum(xa * yb - xb * ya for _, xa, ya, xb, yb in big) / 2
    assert abs(c["area"].sum() - area) < 1e-6 and c["area"].max() <= 100 + 1e-9 and not c.duplicated(["i", "j"]).any()
    assert sp.edge_cells(frame(spark, big), dom).count() < 100_000  # cells times edges are 16 million


CASES = [
    (box(1, 0, 0, 10, 10) + box(2, 5, 5, 15, 15), 175, 1, 0),  # overlapping
    (box(1, 0, 0, 10, 10) + box(2, 10, 0, 20, 10), 200, 1, 0),  # sharing a side
    (box(1, 0, 0, 10, 10) + box(2, 10, 3, 20, 7), 140, 1, 0),  # touching along part of a side
    (box(1, 0, 0, 10, 10) + box(2, 10, 10, 20, 20), 200, 2, 0),  # at a corner only
    (box(1, 0, 0, 10, 10) + box(2, 2, 2, 5, 5), 100, 1, 0),  # nested
    (box(1, 0, 0, 10, 10) + box(2, 0, 0, 10, 10), 100, 1, 0),  # twice the same
    (box(1, 0, 0, 30, 10) + box(2, 0, 20, 30, 30) + box(3, 0, 0, 10, 30) + box(4, 20, 0, 30, 30), 800, 1, 1),  # around a yard
    (box(1, 0, 0, 30, 10) + box(2, 0, 20, 30, 30) + box(3, 0, 0, 10, 30) + box(4, 20, 0, 30, 30) + box(5, 13, 13, 17, 17), 816, 2, 1),  # with an island
    (box(1, 0, 0, 9, 9) + ring(1, [(3, 3), (3, 6), (6, 6), (6, 3)]) + box(2, 20, 0, 21, 1), 73, 2, 1),  # a hole of its own
    (box(1, 0, 0, 9, 9) + ring(1, [(3, 3), (3, 6), (6, 6), (6, 3)]) + box(2, 3, 3, 6, 6), 81, 1, 0),  # filled exactly
    (diamond(1, 0, 0, 10) + diamond(2, 10, 0, 10), 350, 1, 0),
    (diamond(1, 0, 0, 10) + diamond(2, 20, 0, 10), 400, 2, 0),
    (diamond(1, 0, 0, 10) + box(2, -5, -5, 5, 5) + diamond(3, 0, 0, 2), 200, 1, 0),
]


def moved(edges, x, gids=0):
    return [(g + gids, xa + x, ya, xb + x, yb) for g, xa, ya, xb, yb in edges]


def test_union(spark):
    """All cases side by side, 1000 apart."""
    edges = [e for k, (c, *_) in enumerate(CASES) for e in moved(c, 1000 * k, 100 * k)]
    got = {}
    for r in ar.footprints(ar.rings(ar.dissolve(frame(spark, edges), 7.0)), 7.0).collect():
        p = [(q["x"], q["y"]) for q in r["points"]]
        got.setdefault(round(p[0][0] / 1000), []).append((r["ring"], r["area"]))
        # orientation, and closed rings of distinct points
        assert len(set(p)) == len(p) and (r["area"] > 0) == (r["ring"] == 0)
        assert sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(p, p[1:] + p[:1])) / 2 == pytest.approx(r["area"], abs=1e-6)
    for k, (_, area, outer, holes) in enumerate(CASES):
        assert (round(sum(a for _, a in got[k]), 5), sum(n == 0 for n, _ in got[k]), sum(n > 0 for n, _ in got[k])) == (area, outer, holes), CASES[k]


def random_polygons(seed, n=14):
    rnd = random.Random(seed)
    return [e for k in range(n) for e in (star(k, rnd.uniform(0, 60), rnd.uniform(0, 60), rnd.uniform(4, 16), rnd.choice([3, 5, 9]), seed * 100 + k) if k % 3 else box(k, *(lambda x, y: (x, y, x + rnd.randrange(3, 20), y + rnd.randrange(3, 20)))(rnd.randrange(50), rnd.randrange(50))))]


def test_union_and_clip_hold_random_points(spark):
    edges, other = ([e for k in (0, 1) for e in moved(random_polygons(k + first, n), 200.0 * k, 50 * k)] for first, n in ((1, 14), (51, 8)))
    outline = ar.cut(ar.dissolve(frame(spark, other), 5.0))
    out = {"union": [(0, *r) for r in outline.collect()]}
    for keep in ("inside", "outside"):
        out[keep] = [tuple(r) for r in ar.clip(frame(spark, edges), outline.withColumn("gid", F.lit(0)), keep, 5.0).collect()]
    rnd = random.Random(7)
    for k in range(3000):
        x, y = rnd.uniform(-10, 80) + 200 * (k % 2), rnd.uniform(-10, 80)
        mine, theirs = held(edges, x, y), bool(held(other, x, y))
        assert bool(held(out["union"], x, y)) == theirs
        assert held(out["inside"], x, y) == (mine if theirs else set())
        assert held(out["outside"], x, y) == (set() if theirs else mine)


def plain_hull(points):
    """Corners: points that are no convex combination, by every directed pair."""
    p, out = sorted(set(points)), set()
    for a in p:
        for b in p:
            if a != b and all((b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0]) > 0 or ((b[0] - a[0]) * (c[1] - a[1]) == (b[1] - a[1]) * (c[0] - a[0]) and min(a, b) <= c <= max(a, b)) for c in p):
                out |= {a, b}
    return out


def test_hulls(spark):
    rnd = random.Random(4)
    groups = {k: [(float(rnd.randrange(9)), float(rnd.randrange(9))) for _ in range(rnd.choice([1, 2, 3, 8, 60]))] for k in range(25)}
    groups[30] = [(float(k), float(k)) for k in range(5)] * 2
    df = spark.createDataFrame([(k, x, y) for k, g in groups.items() for x, y in g], "k long, x double, y double")
    got = {}
    for r in ar.hulls(df, ["k"]).orderBy("at").collect():
        got.setdefault(r["k"], []).append((r["x"], r["y"]))
    for k, g in groups.items():
        assert set(got[k]) == (plain_hull(g) or set(g)), k
        turn = [(b[0] - a[0]) * (c[1] - b[1]) - (b[1] - a[1]) * (c[0] - b[0]) for a, b, c in zip(got[k], got[k][1:] + got[k][:1], got[k][2:] + got[k][:2])]
        assert len(got[k]) < 3 or min(turn) > 0


def test_final_footprints(spark):
    edges = box(1, 0, 0, 20, 20) + box(2, 25, 0, 45, 20) + box(3, 100, 0, 105, 5) + diamond(4, 200, 0, 20)
    pairs = spark.createDataFrame([(1, 2)], "a long, b long")
    got = ar.final_footprints(frame(spark, edges), pairs, 400.0, 10.0).collect()
    assert sorted(round(r["area"], 6) for r in got) == [800, 900]  # the gap is bridged, the small one is gone


def test_fishnet(spark):
    net = Domain(12, 12, 5.0, 7.0, 1.0, -3.0, -4.0)
    edges = box(1, 2, 3, 22, 17) + diamond(2, 20, 20, 12) + box(3, 40, 40, 41, 41) + box(4, 2, 3, 42, 45) + ring(4, [(12, 10), (12, 24), (27, 24), (27, 10)])
    edges += star(5, 25, 30, 26, 60, 5) + ring(6, [(0, 0), (30, 2), (4, 4), (30, 6), (1, 8)])
    got = ar.split_by_fishnet(frame(spark, edges), net, 10.0).collect()
    cover = {(r["gid"], r["i"], r["j"]): r["area"] for r in sp.coverage(frame(spark, edges), net).collect()}
    parts = {}
    for r in got:
        if r["i"] is None:
            assert r["gid"] == 3 and r["area"] == 1
            cover = {k: v for k, v in cover.items() if k[0] != 3}
            continue
        p = [(q["x"], q["y"]) for q in r["points"]]
        assert len(p) >= 3 and len(set(p)) == len(p)
        assert all(-3 + 5 * r["i"] - 1e-6 <= x <= 2 + 5 * r["i"] + 1e-6 and -4 + 7 * r["j"] - 1e-6 <= y <= 3 + 7 * r["j"] + 1e-6 for x, y in p)
        parts[r["gid"], r["i"], r["j"]] = parts.get((r["gid"], r["i"], r["j"]), 0) + r["area"]
    assert parts.keys() == cover.keys()
    assert all(parts[k] == pytest.approx(cover[k], abs=1e-4) for k in cover)


def test_reintegrate(spark):
    land = frame(spark, box(1, 0, 0, 50, 100) + box(2, 50, 0, 100, 100))
    types = spark.createDataFrame([(1, 101), (2, 202)], "gid long, type int")
    feet = frame(spark, box(7, 40, 40, 60, 60) + box(8, 90, 90, 120, 120))
    got = ar.reintegrate(land, types, feet, 906, 25.0)
    area = {}
    for r in got.collect():
        k = (r["part"], r["gid"], r["type"])
        area[k] = area.get(k, 0) + (r["xa"] * r["yb"] - r["xb"] * r["ya"]) / 2
    assert area == pytest.approx({("land", 1, 101): 4800, ("land", 2, 202): 4700, ("building", 7, 906): 400, ("building", 8, 906): 100})


def test_empty(spark):
    none = spark.createDataFrame([], EDGES)
    assert ar.dissolve(none).count() == 0 and ar.rings(ar.dissolve(none)).count() == 0
    assert ar.split_by_fishnet(none, Domain(2, 2, 5.0, 5.0, 1.0, 0.0, 0.0), 1.0).count() == 0
    assert ar.clip(none, none, "inside").count() == 0 and ed.areas(none).count() == 0


def test_split_cell(spark):
    """Both parts make up the cell, the part that is more built stays, the normal leads away from it."""
    from cellweave.operators import cutcell as cc

    dom = Domain(8, 8, 10.0, 10.0, 5.0, 0.0, 0.0)
    walls = diamond(1, 25.3, 24.1, 17.7) + ring(2, [(52.0, 51.0), (77.0, 55.0), (66.0, 74.0)])
    e = frame(spark, walls).withColumn("edge", F.lit(0))
    c = cc.chords(cc.grid_points(e, dom))
    halves = cc.cell_halves(c, dom).collect()
    both = {}
    for r in halves:
        both.setdefault((r["gid"], r["i"], r["j"]), []).append(r["area"])
    assert both and all(len(v) == 2 and sum(v) == pytest.approx(100) for v in both.values())
    rnd = random.Random(6)
    got = cc.split_cell(c, ar.dissolve(frame(spark, walls)), dom).collect()
    assert len(got) == len(both)
    for r in got:
        p = [(q["x"], q["y"]) for q in r["points"]]
        part = ring(0, p)
        inside_ = [(x, y) for x, y in ((rnd.uniform(10 * r["i"], 10 * r["i"] + 10), rnd.uniform(10 * r["j"], 10 * r["j"] + 10)) for _ in range(4000)) if held(part, x, y)]
        share = sum(bool(held(walls, x, y)) for x, y in inside_) / max(1, len(inside_))
        if len(inside_) > 200:
            assert share == pytest.approx(r["share"], abs=0.12)
        assert math.hypot(r["nx"], r["ny"]) == pytest.approx(1)
        middle = (sum(x for x, _ in p) / len(p), sum(y for _, y in p) / len(p))
        chord = next(q for q in halves if (q["gid"], q["i"], q["j"]) == (r["gid"], r["i"], r["j"]))
        assert (middle[0] - chord["px"]) * r["nx"] + (middle[1] - chord["py"]) * r["ny"] < 0


@pytest.mark.parametrize("a,b,normal", [((0.0, 4.0), (10.0, 4.0), (0, 1)), ((4.0, 0.0), (4.0, 10.0), (1, 0)), ((0.0, 0.0), (10.0, 10.0), (-0.5**0.5, 0.5**0.5)), ((0.0, 0.0), (10.0, 0.0), None)])
def test_normals_of_plain_chords(spark, a, b, normal):
    from cellweave.operators import cutcell as cc

    dom = Domain(1, 1, 10.0, 10.0, 5.0, 0.0, 0.0)
    house = box(0, -5, -5, 20, 4) if a[1] == b[1] else box(0, -5, -5, 4, 20) if a[0] == b[0] else ring(0, [(-5, -5), (25, -5), (25, 25)])
    c = spark.createDataFrame([(1, 0, 0, *a, *b)], "gid int, i int, j int, px double, py double, qx double, qy double")
    got = cc.split_cell(c, ar.dissolve(frame(spark, house)), dom).collect()
    assert [(r["share"], pytest.approx((r["nx"], r["ny"]))) for r in got] == ([(1.0, normal)] if normal else [])
