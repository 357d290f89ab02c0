"""Faces of cut cells: slices, flat tops, keys of vertices and closed surfaces, against plain versions."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cellweave.domain import Domain
from cellweave.operators import faces as fc

FACES = "fid long, verts array<struct<x:double,y:double,z:double>>"
WALLS = "fid long, x1 double, y1 double, x2 double, y2 double, z1b double, z1 double, z2b double, z2 double"


def area(p):
    """Size of the summed cross products of a ring about its first point."""
    s = [0.0, 0.0, 0.0]
    for a, b in zip(p[1:], p[2:]):
        u, v = [a[k] - p[0][k] for k in range(3)], [b[k] - p[0][k] for k in range(3)]
        s = [s[0] + u[1] * v[2] - u[2] * v[1], s[1] + u[2] * v[0] - u[0] * v[2], s[2] + u[0] * v[1] - u[1] * v[0]]
    return math.sqrt(sum(x * x for x in s)) / 2


def rings(df):
    return {(r["fid"], r["k"]): [tuple(v) for v in r["verts"]] for r in df.collect()}


def planar(rnd, n):
    """A convex ring in a random plane."""
    a, b, c = rnd.uniform(-2, 2), rnd.uniform(-2, 2), rnd.uniform(-20, 40)
    at = sorted(rnd.uniform(0, 2 * math.pi) for _ in range(n))
    return [(x := 9 * math.cos(t), y := 6 * math.sin(t), a * x + b * y + c) for t in at]


def test_slices_of_planes(spark):
    rnd = random.Random(4)
    made = {k: planar(rnd, rnd.randint(3, 7)) for k in range(60)}
    got = rings(fc.slice_faces(spark.createDataFrame(list(made.items()), FACES), 5.0))
    for fid, p in made.items():
        own = {k: r for (f, k), r in got.items() if f == fid}
        low, high = min(v[2] for v in p), max(v[2] for v in p)
        assert sorted(own) == list(range(math.floor(low / 5), math.ceil(high / 5)))
        assert sum(map(area, own.values())) == pytest.approx(area(p), rel=1e-9)
        for k, r in own.items():
            assert all(5 * k <= v[2] <= 5 * k + 5 for v in r) and len(set(r)) == len(r) >= 3
            if k + 1 in own:  # both sides of a level have the same points on it
                assert {v for v in r if v[2] == 5 * k + 5} == {v for v in own[k + 1] if v[2] == 5 * k + 5}


def test_awkward_faces(spark):
    rows = [
        (1, [(0.0, 0.0, 10.0), (4.0, 0.0, 10.0), (4.0, 4.0, 10.0)]),  # on a level: the layer below it
        (2, [(0.0, 0.0, 11.0), (4.0, 0.0, 11.0), (4.0, 4.0, 11.0)]),
        (3, [(0.0, 0.0, 1.0), (0.0, 0.0, 1.0), (4.0, 4.0, 3.0)]),  # two different vertices
        (4, None), (5, []), (6, [None, (0.0, 0.0, 1.0), (4.0, 0.0, 1.0), (4.0, 4.0, 2.0)]),
        (7, [(0.0, 0.0, -7.0), (4.0, 0.0, -7.0), (4.0, 4.0, -1.0), (0.0, 4.0, -1.0)]),
    ]
    df = spark.createDataFrame(rows, FACES)
    got = rings(fc.slice_faces(df, 5.0))
    assert sorted(got) == [(1, 1), (2, 2), (6, 0), (7, -2), (7, -1)]
    assert sum(area(got[7, k]) for k in (-2, -1)) == pytest.approx(area(rows[6][1]))
    assert fc.slice_faces(df.limit(0), 5.0).count() == 0


def test_walls(spark):
    rnd = random.Random(6)
    rows = []
    for k in range(40):
        b1, b2 = rnd.uniform(0, 9), rnd.uniform(0, 9)
        rows.append((k, *[rnd.uniform(0, 50) for _ in range(4)], b1, b1 + rnd.choice([0.0, 3.0, 17.5]), b2, b2 + rnd.choice([2.0, 20.0])))
    got = rings(fc.slice_walls(spark.createDataFrame(rows, WALLS), 2.5))
    for k, x1, y1, x2, y2, b1, t1, b2, t2 in rows:
        assert sum(area(r) for (f, _), r in got.items() if f == k) == pytest.approx(math.hypot(x2 - x1, y2 - y1) * (t1 - b1 + t2 - b2) / 2)


def plain_split(p, dz):
    top = max(v[2] for v in p)
    if min(v[2] for v in p) == top or sum(v[2] == top for v in p) < 3 or top % dz:
        return {0: p}
    n, one, two = len(p), [], []
    for k, v in enumerate(p):
        if v[2] == top:
            two.append(v)
        if min(p[k - 1][2], v[2], p[(k + 1) % n][2]) < top:
            one.append(v)
    return {1: one, 2: two}


def test_flat_tops(spark):
    rnd, made = random.Random(8), {}
    for k in range(200):
        n = rnd.randint(3, 7)
        made[k] = [(float(round(9 * math.cos(6.28 * q / n), 3)), float(round(9 * math.sin(6.28 * q / n), 3)), rnd.choice([5.0, 5.0, 5.0, 2.5, 4.0])) for q in range(n)]
    got = {}
    for r in fc.split_flat_tops(spark.createDataFrame(list(made.items()), FACES), 5.0).collect():
        got.setdefault(r["fid"], {})[r["part"]] = [tuple(v) for v in r["verts"]]
    assert got == {k: plain_split(p, 5.0) for k, p in made.items()}
    assert sum(1 in v for v in got.values()) > 40


DOM = Domain(6, 5, 10.0, 8.0, 5.0, 100.0, -40.0)


def surface(spark, heights):
    corners = spark.createDataFrame([(i, j, z) for (i, j), z in heights.items()], "i int, j int, z double")
    f = fc.slice_faces(fc.terrain_faces(corners, DOM), DOM.dz)
    f = f.withColumn("fid", ((F.col("i") * 1000 + F.col("j")) * 1000 + F.col("k")).cast("long"))
    return fc.keyed_index(fc.vertex_keys(f, DOM))


def rough(seed):
    rnd = random.Random(seed)
    return {(i, j): rnd.uniform(0.1, 24) for i in range(DOM.nx + 1) for j in range(DOM.ny + 1)}


def edges_met(heights):
    """(k, j, i, dir) to distance: every edge of the lattice with one end under the terrain."""
    out = {}
    for (i, j), z in heights.items():
        k = math.floor(z / DOM.dz)
        out[k, j, i, 0] = z / DOM.dz - k
        for di, dj, up, down in ((1, 0, 5, 4), (0, 1, 3, 2)):
            if (q := heights.get((i + di, j + dj))) is not None:
                for n in range(30):
                    if min(z, q) < n * DOM.dz < max(z, q):
                        f = (n * DOM.dz - z) / (q - z)
                        full = (n, j + dj, i + di, up) if q > z else (n, j, i, down)
                        out[full] = 1 - f if q > z else f
    return out


def test_keys_are_the_edges_that_the_terrain_meets(spark):
    heights = rough(2)
    v, refs = surface(spark, heights)
    got = {(r["k"], r["j"], r["i"], r["dir"]): r["len"] for r in v.collect()}
    want = edges_met(heights)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    assert fc.watertight_check(refs, v, DOM).count() == 0


def test_planted_defects(spark):
    v, refs = surface(spark, rough(3))
    v, refs = v.cache(), refs.cache()
    rows, faces = v.collect(), {}
    for r in refs.orderBy("fid", "at").collect():
        faces.setdefault(r["fid"], []).append(r["vid"])

    def rules(new_refs, new_vertices):
        return {(r["rule"], r["what"]) for r in fc.watertight_check(new_refs, new_vertices, DOM).collect()}

    one = next(f for f, p in faces.items() if len(p) > 3)
    assert rules(refs.filter(F.col("fid") != one), v) == {("faces", str(x)) for x in faces[one]}  # a hole
    assert ("unknown", str(one)) in rules(refs, v.filter(F.col("vid") != faces[one][0]))
    again = refs.unionByName(spark.createDataFrame([(one, 99, faces[one][0])], refs.schema))
    assert ("repeated", str(one)) in rules(again, v)
    far = next(r["vid"] for r in rows if r["vid"] not in faces[one] and r["i"] + r["j"] > 8)
    bent = refs.withColumn("vid", F.when((F.col("fid") == one) & (F.col("at") == 1), F.lit(far)).otherwise(F.col("vid")).cast(refs.schema["vid"].dataType))
    assert ("edge", str(one)) in rules(bent, v)
    up = next(r for r in rows if r["dir"] == 0)  # its free corner is said to be full
    clash = v.unionByName(spark.createDataFrame([(9999, up["k"] + 1, up["j"], up["i"], 0, 0.5)], v.schema))
    assert ("corner", f"{up['k'] + 1},{up['j']},{up['i']}") in rules(refs, clash)


def test_a_vertex_on_a_corner_is_singular(spark):
    heights = rough(5)
    heights[3, 2] = 10.0
    v, refs = surface(spark, heights)
    assert v.filter("len = 0").count() > 0
    bad = fc.watertight_check(refs, v, DOM).filter("rule = 'faces'").join(v, F.col("what") == v["vid"].cast("string"))
    assert bad.filter("i = 3 and j = 2").count() == 0


def plain_roofs(cells, hits, near=(1, 2), far=49):
    rid = {k: hits.get(k) for k in cells}
    for r in (*near, far):
        new = {}
        for k, (i, j) in cells.items():
            if rid[k] is None:
                best = min(((max(abs(i - a), abs(j - b)), (i - a) ** 2 + (j - b) ** 2, rid[q]) for q, (a, b) in cells.items() if rid[q] is not None and max(abs(i - a), abs(j - b)) <= r), default=None)
                if best:
                    new[k] = best[2]
        rid |= new
    return rid


@pytest.mark.parametrize("seed,share,far", [(1, 0.5, 49), (2, 0.02, 49), (3, 0.01, 11), (4, 0.0, 49)])
def test_roofs_of_cells(spark, seed, share, far):
    from cellweave.operators.buildings import roof_of_cell

    rnd = random.Random(seed)
    at = rnd.sample([(i, j) for i in range(-20, 60) for j in range(70)], 900) + [(i, j) for i in range(200, 208) for j in range(8)]
    cells = dict(enumerate(dict.fromkeys(at)))
    hits = {k: rnd.randint(1, 40) for k in cells if rnd.random() < share}
    df = spark.createDataFrame([(k, i, j) for k, (i, j) in cells.items()], "id int, i int, j int")
    got = {r["id"]: r["rid"] for r in roof_of_cell(df, spark.createDataFrame(list(hits.items()), "id int, rid int"), far=far).collect()}
    assert got == plain_roofs(cells, hits, far=far)
