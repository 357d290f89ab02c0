"""Cells held by polygons, and steps that must not send cells or sort what they need not."""

import math
import random
import time

from pyspark.sql import functions as F

from cellweave.domain import Domain
from cellweave.operators import canopy as cp
from cellweave.operators import cube as cb
from cellweave.operators import edges as ed
from cellweave.operators import lines as ln
from cellweave.operators import raster as rs
from cellweave.operators import spatial as sp
from cellweave.plans import grid_queries as gq
from cellweave.sources import cube_files

SF = "/root/testdata/sf0.001"
EDGES = "gid int, xa double, ya double, xb double, yb double, kind int"


def plan(df) -> list[str]:
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def shuffles(df) -> int:
    return sum("Exchange hashpartitioning" in line for line in plan(df))


def star(gid, cx, cy, r, n, rng, turn=1):
    pts = [(cx + turn * r * rng.uniform(0.4, 1) * math.cos(2 * math.pi * k / n), cy + r * rng.uniform(0.4, 1) * math.sin(2 * math.pi * k / n)) for k in range(n)]
    return [(gid, *p, *q, gid * 10) for p, q in zip(pts, pts[1:] + pts[:1], strict=True)]


def holds(edges, x, y):
    n = 0
    for _, xa, ya, xb, yb, _ in edges:
        if (xa <= x) != (xb <= x):
            n += ya + (x - xa) * (yb - ya) / (xb - xa) <= y
    return n % 2 == 1


def test_held_cells_by_brute_force(spark):
    rng, dom = random.Random(5), Domain(17, 23, 2.5, 1.5, 1.0, -7.3, 4.1)
    layers = []
    for first in (1, 100):
        polygons = {}
        for g in range(first, first + 9):
            cx, cy, r = rng.uniform(-12, 40), rng.uniform(0, 42), rng.uniform(2, 14)
            polygons[g] = star(g, cx, cy, r, 11, rng) + (star(g, cx, cy, r * 0.3, 5, rng, -1) if g % 2 else [])
        layers.append(polygons)
    square = [(50, 0.2, 10.1, 5.2, 10.1, 500), (50, 5.2, 10.1, 5.2, 13.1, 500), (50, 5.2, 13.1, 0.2, 13.1, 500), (50, 0.2, 13.1, 0.2, 10.1, 500)]
    layers[0][50] = square
    frames = [spark.createDataFrame([e for p in ly.values() for e in p], EDGES) for ly in layers]
    want = {}
    for i in range(dom.nx):
        for j in range(dom.ny):
            x, y = dom.origin_x + i * dom.dx + dom.dx / 2, dom.origin_y + j * dom.dy + dom.dy / 2
            a, b = (min((g for g, e in ly.items() if holds(e, x, y)), default=None) for ly in layers)
            want[i, j] = (a, None if a is None else a * 10, b)
    both = {"a": (frames[0], ("kind",)), "b": (frames[1], ())}
    rows = sp.held_cells(dom, both, whole=True).collect()
    assert len(rows) == len(want) and {(r["i"], r["j"]): (r["a"], r["kind"], r["b"]) for r in rows} == want
    some = sp.held_cells(dom, both).collect()
    assert {(r["i"], r["j"]): (r["a"], r["kind"], r["b"]) for r in some} == {k: v for k, v in want.items() if v != (None, None, None)}
    assert len({v[0] for v in want.values()}) > 4 and len(some) < len(rows)


def test_borders_on_centres_are_half_open(spark):
    e = ed.rectangle_edges(spark.createDataFrame([(1, 5.0, 5.0, 25.0, 35.0), (2, 5.0, 5.0, 5.0, 35.0)], "gid int, x0 double, y0 double, x1 double, y1 double"), "gid")
    got = {(r["i"], r["j"]) for r in sp.held_cells(Domain(5, 5, 10.0, 10.0, 1.0, 0.0, 0.0), {"lid": (e, ())}).collect()}
    assert got == {(i, j) for i in (0, 1) for j in (0, 1, 2)}


def test_cells_of_classes_and_buildings_are_shuffled_once(spark):
    assert shuffles(gq.class_cells(spark, SF).select("i", "j", "lid", "type")) == 1  # of crossings
    assert shuffles(gq.urban_cells(spark, SF).select("i", "j", "lid", "type")) == 1


def test_coverage_stays_where_polygons_are(spark):
    df = spark.range(50).select(F.col("id").alias("gid"), *[(F.col("id") * 7.0 + k).alias(c) for c, k in (("x0", 0), ("y0", 0), ("x1", 25), ("y1", 31))])
    cover = sp.coverage(ed.rectangle_edges(df.repartition(3, "gid"), "gid"), Domain(60, 60, 10.0, 10.0, 1.0, 0.0, 0.0))
    total = cover.groupBy("gid").agg(F.sum("area").alias("a"))
    assert shuffles(total) == 1 and all(abs(r["a"] - 25 * 31) < 1e-6 for r in total.collect())


def test_tree_layers_need_no_shuffle(spark):
    trees = spark.createDataFrame([(1, 2.0, 9.0, 3.0, 0), (2, 1.0, 12.0, 2.0, 4)], "gid int, trunkh double, treeh double, crownr double, crownshp int")
    assert shuffles(cp.tree_layers(trees, 5.0)) == 0


def test_override_sends_only_corners_inside_a_building_to_its_level(spark):
    corners = spark.range(100).select((F.col("id") / 10).cast("int").alias("i"), (F.col("id") % 10).cast("int").alias("j"))
    inside = spark.createDataFrame([(1, 1, 7), (1, 2, 7), (2, 2, 8), (3, 3, None)], "i int, j int, lid int")
    tops = spark.createDataFrame([(7, 3), (7, 5)], "lid int, top int")
    df = cb.building_override(corners, inside, tops)
    assert {(r["i"], r["j"]): r["top"] for r in df.collect() if r["top"] is not None} == {(1, 1): 5, (1, 2): 5} and df.count() == 100
    assert not any("LeftOuter" in line and "[lid" in line for line in plan(df))


def test_building_variables_ask_only_building_cells_for_their_class(spark):
    tops = spark.createDataFrame([(1, 0, 0, 4, 2), (2, 0, 1, 4, 2), (3, 0, 2, 5, 1)], "id int, i int, j int, lid int, top int")
    df = cb.building_variables(spark.createDataFrame([(1, 903), (2, 103), (9, 906)], "id int, type int"), tops, 5.0)
    assert sorted((r["j"], r["value"]) for r in df.filter("var = 'building_type'").collect()) == [(0, 3.0), (1, 1.0), (2, 1.0)]
    assert any(">= 900" in line for line in plan(df))


def test_large_tiles_are_put_together_row_by_row(spark):
    n = 400
    p = spark.range(n * n).filter("id % 3 <> 1").select((F.col("id") % n).alias("px"), F.expr(f"id div {n}").alias("py"), F.when(F.col("id") % 5 != 0, F.col("id").cast("double")).alias("val")).filter("py <> 17")
    began = time.time()
    (row,) = rs.retile(p, n, n).collect()
    assert time.time() - began < 30  # a search of one map for each pixel took minutes
    assert row["vals"] == [-1e9 if k % 3 == 1 or k % 5 == 0 or k // n == 17 else float(k) for k in range(n * n)]


def test_written_cube_is_whole_over_its_cells(spark, tmp_path):
    cells = spark.createDataFrame([(0, 0), (0, 1), (1, 0)], "i int, j int")
    cube = spark.createDataFrame([("a", 0, 0, 1.5), ("b", 1, 0, None), ("b", 0, 1, float("nan")), ("c", 0, 0, 9.0), ("a", 7, 7, 2.0)], "var string, j int, i int, value double")
    cube_files.write_cube(cube, cells, ["a", "b"], str(tmp_path / "cube"), {})
    got = {(r["var"], r["j"], r["i"]): r["value"] for r in cube_files.read_cube(spark, str(tmp_path / "cube")).collect()}
    assert len(got) == 6 and got["a", 0, 0] == 1.5 and math.isnan(got["b", 0, 1])
    assert all(v == -9999.0 for k, v in got.items() if k not in {("a", 0, 0), ("b", 0, 1)})


def test_points_meet_polygons_in_one_join(spark):
    rng = random.Random(8)
    polygons = {g: star(g, rng.uniform(0, 60), rng.uniform(0, 60), rng.uniform(3, 30), 13, rng) for g in range(12)}
    points = [(k, rng.uniform(-5, 65), rng.uniform(-5, 65)) for k in range(400)]
    found = sp.inside(spark.createDataFrame(points, "id int, x double, y double"), spark.createDataFrame([e for p in polygons.values() for e in p], EDGES), Domain(1, 1, 7.0, 5.0, 1.0, 0.0, 0.0))
    assert shuffles(found) == 3  # edges to columns, cells and points to each other
    rows = found.collect()
    assert len(rows) == len(set(rows)) and {(r["id"], r["gid"]) for r in rows} == {(k, g) for k, x, y in points for g, e in polygons.items() if holds(e, x, y)}


def test_lines_are_dealt_to_all_tasks(spark):
    segments = spark.range(400).select((F.col("id") * 10.0).alias("xa"), F.lit(0.0).alias("ya"), (F.col("id") * 10.0 + 5).alias("xb"), F.lit(0.0).alias("yb"))
    df = ln.merge_lines(segments)
    assert any("Exchange hashpartitioning(line" in line and "REPARTITION_BY_NUM" in line for line in plan(df)) and df.count() == 400
