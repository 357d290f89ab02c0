"""Work that must not grow faster than the input: plans without joins or broadcasts of exploded rows, fewer rows sent."""

import random

from pyspark.sql import functions as F

from cellweave.domain import Domain
from cellweave.operators import arrange, spatial, stencil


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def squares(spark, n, mod):
    return spark.range(n * n).select((F.col("id") / n).cast("int").alias("i"), (F.col("id") % n).cast("int").alias("j"), (F.col("id") * 7919 % mod).cast("int").alias("nz"))


def test_nearest_cell_is_not_broadcast_and_equals_brute_force(spark):
    rnd, dom, d = random.Random(5), Domain(30, 30, 10.0, 5.0, 5.0, -120.0, -70.0), 23.0
    cells = [(i, j, 100 * rnd.randrange(1, 4)) for i in range(30) for j in range(30) if rnd.random() < 0.2]
    points = [(k, rnd.uniform(-160, 220), rnd.uniform(-90, 100), 100 * rnd.randrange(1, 4)) for k in range(150)] + [(150, -50.0, 10.0, 200)]
    made = spatial.nearest_cell(spark.createDataFrame(points, "id int, x double, y double, type int"), spark.createDataFrame(cells, "i int, j int, type int"), dom, d)
    assert "Broadcast" not in plan(made)
    want = {}
    for k, x, y, own in points:
        hits = []
        for i, j, t in cells:
            gx, gy = max(0.0, i * 10 - 120 - x, x - i * 10 + 110), max(0.0, j * 5 - 70 - y, y - j * 5 + 65)
            if abs(t - own) < 50 and gx * gx + gy * gy <= d * d:
                hits.append((gx * gx + gy * gy, i, j))
        if hits:
            want[k] = min(hits)[1:]
    assert {r["id"]: (r["i"], r["j"]) for r in made.collect()} == want and len(want) > 50


def test_inside_is_not_broadcast(spark):
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 25.0, 25.0), (3, 45.0, 5.0)], "id int, x double, y double")
    box = spark.createDataFrame([(7, 0.0, 0.0, 40.0, 0.0), (7, 40.0, 0.0, 40.0, 40.0), (7, 40.0, 40.0, 0.0, 40.0), (7, 0.0, 40.0, 0.0, 0.0)], "gid int, xa double, ya double, xb double, yb double")
    held = spatial.inside(points, box, Domain(1, 1, 10.0, 10.0, 10.0, 0.0, 0.0))
    assert "Broadcast" not in plan(held)
    assert sorted(tuple(r) for r in held.collect()) == [(1, 7), (2, 7)]


def test_minima_and_corners_are_filled_without_joins(spark):
    cells = squares(spark, 12, 13).withColumn("tag", F.concat_ws("-", "i", "j"))
    for made in (stencil.fill_minima(cells), stencil.fill_corners(cells, 12, 12)):
        assert "Join" not in plan(made)
        assert made.columns == cells.columns and made.filter("tag = concat_ws('-', i, j)").count() == 144
    nz = {(r["i"], r["j"]): r["nz"] for r in cells.collect()}
    for made, ghost in ((stencil.fill_minima(cells), None), (stencil.fill_corners(cells, 12, 12), 9999)):
        for r in made.collect():
            near = [nz.get((r["i"] + a, r["j"] + b), ghost) for a, b in stencil.FOUR]
            higher = [x for x in near if x is not None and x > nz[r["i"], r["j"]]]
            assert r["nz"] == (min(higher) if len(higher) > 2 else nz[r["i"], r["j"]])


def test_saddles_rise_without_joins(spark):
    cells = squares(spark, 12, 17)
    made = stencil.saddles(cells)
    assert "Join" not in plan(made)
    nz = {(r["i"], r["j"]): r["nz"] for r in cells.collect()}
    want = dict(nz)
    for i in range(11):
        for j in range(11):
            a, b, c, d = (i, j), (i + 1, j), (i, j + 1), (i + 1, j + 1)
            for low, high in (((a, d), (b, c)), ((b, c), (a, d))):
                to = min(nz[h] for h in high)
                if max(nz[k] for k in low) < to:
                    want |= {k: max(want[k], to) for k in low}
    assert {(r["i"], r["j"]): r["nz"] for r in made.collect()} == want != nz


def test_alone_edges_meet_only_the_others(spark):
    # 1, 2: alone and crossing; 3: crosses both; 4: alone along 3; 5: alone, ends on 3 inside 4
    rows = [(1, 0.0, 0.0, 10.0, 10.0), (2, 0.0, 10.0, 10.0, 0.0), (3, -5.0, 2.0, 15.0, 2.0), (4, 3.0, 2.0, 7.0, 2.0), (5, 5.0, 2.0, 5.0, -4.0)]
    edges = spark.createDataFrame(rows, "gid int, xa double, ya double, xb double, yb double")
    got: dict = {}
    for r in arrange.split(edges, 20.0, F.col("gid") != 3).collect():
        got.setdefault(r["gid"], []).append((r["xa"], r["ya"], r["xb"], r["yb"]))
    assert sorted(got[1]) == [(0.0, 0.0, 2.0, 2.0), (2.0, 2.0, 10.0, 10.0)]
    assert sorted(got[2]) == [(0.0, 10.0, 8.0, 2.0), (8.0, 2.0, 10.0, 0.0)]
    cuts = [-5.0, 2.0, 3.0, 5.0, 7.0, 8.0, 15.0]
    assert sorted(got[3]) == [(a, 2.0, b, 2.0) for a, b in zip(cuts, cuts[1:])]
    assert sorted(got[4]) == [(3.0, 2.0, 5.0, 2.0), (5.0, 2.0, 7.0, 2.0)]  # as the pieces of 3
    assert got[5] == [(5.0, 2.0, 5.0, -4.0)]


def test_hulls_and_rings_do_not_call_python_for_each_group(spark):
    box = spark.range(40).select(F.col("id").alias("g"), F.explode(F.array(*[F.struct(*[F.lit(float(v)).alias(c) for v, c in zip(e, arrange.ENDS)]) for e in ((0, 0, 4, 0), (4, 0, 4, 3), (4, 3, 0, 3), (0, 3, 0, 0))])).alias("e")).select("g", "e.*")
    hulls = arrange.hulls(box.select("g", F.col("xa").alias("x"), F.col("ya").alias("y")), ["g"])
    made = arrange.chain(box, ["g"])
    for df in (hulls, made):
        assert "FlatMapGroupsInPandas" not in plan(df)
    corners = {}
    for r in hulls.orderBy("g", "at").collect():
        corners.setdefault(r["g"], []).append((r["x"], r["y"]))
    assert len(corners) == 40 and all(c == [(0.0, 0.0), (4.0, 0.0), (4.0, 3.0), (0.0, 3.0)] for c in corners.values())
    assert sorted((r["g"], r["part"], r["area"], len(r["points"])) for r in made.collect()) == [(g, 0, 12.0, 4) for g in range(40)]
