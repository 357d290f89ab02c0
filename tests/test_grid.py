"""Every registered gridding query against its SQL in DuckDB, and properties that must hold."""

import math

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cellweave.domain import Domain
from cellweave.operators import buildings, canopy, canyon, edges, grid, landcover, spatial, stencil
from cellweave.operators.components import connected_components
from cellweave.plans import fixtures as fx
from cellweave.plans import grid_queries as gq

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(gq.SQL))
def test_oracle(spark, duck, name):
    a, b = gq.QUERIES[name](spark, SF).toPandas(), duck.sql(gq.SQL[name]).df()
    assert sorted(a.columns) == sorted(b.columns) and len(a) == len(b) > 0
    cols = sorted(a.columns)
    a, b = (x[cols].sort_values(cols).reset_index(drop=True).astype(object).where(lambda v: v.notna(), None) for x in (a, b))
    pd.testing.assert_frame_equal(a, b, check_dtype=False)


def test_projection_round_trip(spark):
    d = spark.range(200).select((F.col("id") % 20 * 0.3 + 12).alias("lon"), (F.col("id") / 4 + 5).alias("lat"))
    e, n = grid.lonlat_to_utm(F.col("lon"), F.col("lat"), 33)
    lon, lat = grid.utm_to_lonlat(F.col("e"), F.col("n"), 33)
    worst = d.withColumn("e", e).withColumn("n", n).select(F.max(F.greatest(F.abs(lon - F.col("lon")), F.abs(lat - F.col("lat")))).alias("w")).first()["w"]
    assert worst < 1e-8


def test_filled_surface_has_no_minima(spark):
    cells = fx.layer(spark, SF, "fx_levels").select("id", "i", "j", "nz")
    full = stencil.fill_minima_all(cells)
    assert stencil.fill_minima(full).exceptAll(full).isEmpty()
    assert full.join(cells.withColumnRenamed("nz", "was"), ["id", "i", "j"]).filter("nz < was").isEmpty()


def plain_basins(nz, least=10, most=21):
    """nz: (i, j) to level; the filled levels and the rounds that changed any."""
    nz, around, turns = dict(nz), ((-1, 0), (1, 0), (0, -1), (0, 1)), 0
    for _ in range(most):
        new, done = dict(nz), set()
        for start in nz:
            if start in done:
                continue
            region, todo, rim = {start}, [start], []
            while todo:
                i, j = todo.pop()
                for a, b in around:
                    n = (i + a, j + b)
                    if n in nz and nz[n] != nz[start]:
                        rim.append(nz[n])
                    elif n in nz and n not in region:
                        region.add(n)
                        todo.append(n)
            done |= region
            if len(region) < least and rim and min(rim) > nz[start]:
                new |= dict.fromkeys(region, min(rim))
        if new == nz:
            break
        nz, turns = new, turns + 1
    return nz, turns


def test_basins_are_filled_in_rounds(spark):
    # a hole of 1 cell in a basin of 3 by 3 in a plain, and one in a basin too large to fill
    nz = {(i, j): 3 for i in range(14) for j in range(10)}
    nz |= {(i, j): 1 for i in range(1, 4) for j in range(1, 4)} | {(2, 2): 0}
    nz |= {(i, j): 1 for i in range(6, 12) for j in range(1, 8)} | {(8, 3): 0}
    cells = spark.createDataFrame([(i * 10 + j, i, j, z) for (i, j), z in nz.items()], "id int, i int, j int, nz int")
    want, turns = plain_basins(nz)
    full = stencil.fill_small_basins_all(cells)
    assert {(r["i"], r["j"]): r["nz"] for r in full.collect()} == want and turns == 2
    assert want[2, 2] == 3 and want[8, 3] == 1


def test_p7_all_leaves_no_small_basin(spark):
    cells = fx.layer(spark, SF, "fx_levels").select("id", "i", "j", "nz")
    full = gq.QUERIES["p7_fill_small_basins_all"](spark, SF)
    assert {(r["i"], r["j"]): r["nz"] for r in full.collect()} == plain_basins({(r["i"], r["j"]): r["nz"] for r in cells.collect()})[0]
    assert stencil.fill_small_basins(full).exceptAll(full).isEmpty()
    assert full.join(cells.withColumnRenamed("nz", "was"), ["id", "i", "j"]).filter("nz < was").isEmpty()


def test_components_of_a_long_path(spark):
    e = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).unionAll(spark.createDataFrame([(1000, 1001), (1001, 1001)], "a long, b long"))
    got = {r["node"]: r["root"] for r in connected_components(e).collect()}
    assert got == {k: 0 for k in range(201)} | {1000: 1000, 1001: 1000}


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_guards(spark):
    with pytest.raises(ValueError, match="walls"):
        landcover.assert_inputs({"walls": None, "roofs": spark.range(1)})
    with pytest.raises(ValueError, match="code"):
        landcover.standardize_columns(spark.range(1), {}, ["code"])


def plain_fill_heights(cells, radius):
    """cells: (i, j) to (id, lid, height)."""
    for same in (True, False):
        for r in range(1, radius + 1):
            new = {}
            for (i, j), (_, lid, h) in cells.items():
                if h is None:
                    near = [(a * a + b * b, *cells[i + a, j + b]) for a in range(-r, r + 1) for b in range(-r, r + 1) if (i + a, j + b) in cells]
                    near = [(d, n, x) for d, n, k, x in near if x is not None and (k == lid or not same)]
                    if near:
                        new[i, j] = min(near)[2]
            for k, h in new.items():
                cells[k] = (*cells[k][:2], h)
    return {n: (lid, h) for n, lid, h in cells.values()}


def test_b3_fills_as_brute_force(spark):
    rows = gq.building_cells(spark, SF).select("i", "j", "id", "lid", "height").collect()
    want = plain_fill_heights({(r["i"], r["j"]): (r["id"], r["lid"], r["height"]) for r in rows}, 4)
    got = {r["id"]: (r["lid"], r["height"]) for r in gq.QUERIES["b3_fill_from_neighbours"](spark, SF).collect()}
    assert got == want and any(r["height"] is None for r in rows)


def test_b3_takes_the_same_building_at_four_cells_before_another(spark):
    cells = spark.createDataFrame([(1, 0, 0, 7, None), (2, 1, 0, 8, 5.0), (3, 0, 4, 7, 9.0), (4, 20, 20, 7, None), (5, 24, 20, 8, 6.0), (6, 30, 0, 7, None), (7, 35, 0, 7, 4.0)], "id int, i int, j int, lid int, height double")
    assert {r["id"]: r["height"] for r in buildings.fill_heights(cells, 4).collect()} == {1: 9.0, 2: 5.0, 3: 9.0, 4: 6.0, 5: 6.0, 6: None, 7: 4.0}


def clipped_area(pts, x0, y0, x1, y1):
    """Area of a polygon within a box: cut by its four sides one after another."""
    for axis, at, sign in ((0, x0, 1), (0, x1, -1), (1, y0, 1), (1, y1, -1)):
        out = []
        for a, b in zip(pts, pts[1:] + pts[:1]):
            u, v = sign * (a[axis] - at), sign * (b[axis] - at)
            if u >= 0:
                out.append(a)
            if u * v < 0:
                t = u / (u - v)
                out.append((a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])))
        pts = out
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(pts, pts[1:] + pts[:1]))) / 2


def plain_density(trees, layers, nz, dom):
    """(i, j, l) to lad; trees: gid to (x, y, treeh, type), layers: (gid, l, r), nz: (i, j) to a building's level."""
    lad, cap = {}, {}
    half = math.sqrt(dom.dx**2 + dom.dy**2 + dom.dz**2) / 2
    for gid, l, r in layers:
        x, y, treeh, kind = trees[gid]
        tl = 1.6 if kind == 1 else 1.0
        ring = [(x + r * math.cos(2 * math.pi * k / 40), y + r * math.sin(2 * math.pi * k / 40)) for k in range(40)]
        for i in range(max(0, int((x - r) // dom.dx)), min(dom.nx, int((x + r) // dom.dx) + 1)):
            for j in range(max(0, int((y - r) // dom.dy)), min(dom.ny, int((y + r) // dom.dy) + 1)):
                area = clipped_area(ring, i * dom.dx, j * dom.dy, (i + 1) * dom.dx, (j + 1) * dom.dy)
                if area > 1e-9 and nz.get((i, j), 0) <= l:
                    edge = max(min(treeh - (l + 0.5) * dom.dz, r - math.hypot((i + 0.5) * dom.dx - x, (j + 0.5) * dom.dy - y)) - half, 0)
                    lad[i, j, l] = lad.get((i, j, l), 0) + tl / (tl * 0.5 * edge + 1) * area / (dom.dx * dom.dy)
                    cap[i, j, l] = max(cap.get((i, j, l), 0), tl)
    return {k: min(v, cap[k]) for k, v in lad.items()}


def test_t3_density_leaves_out_buildings_and_thins_by_depth(spark):
    dom = Domain(nx=12, ny=12, dx=2.0, dy=2.0, dz=2.0, origin_x=0.0, origin_y=0.0)
    rows = [(1, 11.3, 10.1, 18.0, 3.0, 8.0, 1, 1), (2, 4.2, 15.7, 9.0, 2.0, 3.0, 4, 0), (3, 22.9, 1.1, 12.0, 3.0, 5.0, 2, 2)]
    trees = spark.createDataFrame(rows, "gid int, x double, y double, treeh double, trunkh double, crownr double, crownshp int, tree_type int")
    nz = {(5, 5): 4, (4, 5): 100, (6, 6): 1, (2, 7): 2}
    layers = canopy.tree_layers(trees, dom.dz)
    got = canopy.tree_density(trees, layers, spark.createDataFrame([(*k, z) for k, z in nz.items()], "i int, j int, nz int"), dom).collect()
    want = plain_density({t[0]: (*t[1:4], t[7]) for t in rows}, [tuple(r) for r in layers.select("gid", "l", "r").collect()], nz, dom)
    assert {(r["i"], r["j"], r["l"]): r["lad"] for r in got} == pytest.approx(want, abs=1e-9)
    cells = {k[:2] for k in want}
    assert (4, 5) not in cells and (5, 5, 4) in want and (5, 5, 3) not in want and min(want[k] for k in want if k[:2] == (5, 4)) < 0.9


def test_t3_query_as_brute_force(spark):
    dom, t = fx.domain(spark, SF), fx.layer(spark, SF, "fx_trees")
    trees = {r["gid"]: (r["x"], r["y"], r["treeh"], r["tree_type"]) for r in t.collect()}
    layers = [tuple(r) for r in canopy.tree_layers(t, 5.0).select("gid", "l", "r").collect()]
    nz = {(r["i"], r["j"]): r["top"] for r in gq.tops(spark, SF).collect()}
    got = {(r["i"], r["j"], r["l"]): r["lad"] for r in gq.QUERIES["t3_tree_density"](spark, SF).collect()}
    assert got == pytest.approx(plain_density(trees, layers, nz, dom), abs=1e-9)
    assert len(got) < len(plain_density(trees, layers, {}, dom))


def test_fixpoints_stand_still_and_only_rise(spark):
    """The looped corrections: another round changes nothing, and nothing falls."""
    nx = fx.domain(spark, SF).nx
    cells = fx.layer(spark, SF, "fx_levels").select("id", "i", "j", "nz")
    for full, once in ((stencil.fill_corners_all(cells, nx, nx), lambda c: stencil.fill_corners(c, nx, nx)), (stencil.saddles_all(cells), stencil.saddles)):
        assert once(full).select("i", "j", "nz").exceptAll(full.select("i", "j", "nz")).isEmpty()
        both = full.join(cells.withColumnRenamed("nz", "was"), ["i", "j"])
        assert both.filter("nz < was").isEmpty() and not both.filter("nz > was").isEmpty()


def test_building_holes_are_filled_to_the_end(spark):
    """A ring of buildings closes over its yard, row by row."""
    cells = [(i, j, 10 * i + j, 1 <= i <= 5 and 1 <= j <= 5 and not (2 <= i <= 4 and j == 3)) for i in range(7) for j in range(7)]
    d = spark.createDataFrame([(k, i, j, b, 3) for i, j, k, b in cells], "id int, i int, j int, is_building boolean, lid int")
    full = stencil.fill_building_holes_all(d, 7, 7)
    assert {(r["i"], r["j"]) for r in full.filter("is_building").collect()} == {(i, j) for i in range(1, 6) for j in range(1, 6)}
    assert stencil.fill_building_holes(full, 7, 7).isEmpty()


def test_layer_pockets(spark):
    """A pocket of two cells rises, one that touches a lower cell at a corner does not, nor one too large."""
    level = {(i, j): 3 for i in range(9) for j in range(9)} | {(1, 1): 2, (1, 2): 2, (4, 4): 2, (5, 5): 1} | {(7, j): 2 for j in range(1, 6)}
    d = spark.createDataFrame([(9 * i + j, i, j, z) for (i, j), z in level.items()], "id int, i int, j int, nz int")
    got = {(r["i"], r["j"]): r["nz"] for r in stencil.fill_layer_pockets(d, 2, 3).collect()}
    assert got == level | {(1, 1): 3, (1, 2): 3}
    got = {(r["i"], r["j"]): r["nz"] for r in stencil.fill_layer_pockets_all(d, 1, 2, 3).collect()}
    assert got[5, 5] == 3 and got[4, 4] == 3


def test_courtyards_are_filled_to_the_end(spark):
    """1 - 2 - 3: yard 2 lies between building 1 and yard 3, which lies between 2 and building 4."""
    t = spark.createDataFrame([(1, 902), (2, 101), (3, 101), (4, 901), (5, 101)], "gid int, type int")
    pairs = spark.createDataFrame([(1, 2), (3, 4), (1, 5)], "a int, b int")
    areas = spark.createDataFrame([(k, 50.0) for k in range(1, 6)], "gid int, area double")
    got = {r["gid"]: r["type"] for r in landcover.fill_courtyards_all(t, pairs, areas, 400.0).collect()}
    assert got == {1: 902, 2: 902, 3: 901, 4: 901, 5: 902}


def test_outline_of_boxes_with_different_corners(spark):
    boxes = spark.createDataFrame([(1, 0.0, 0.0, 10.0, 10.0), (2, 10.0, 2.0, 14.0, 6.0), (3, 30.0, 30.0, 31.0, 31.0)], "gid int, x0 double, y0 double, x1 double, y1 double")
    got = {tuple(r) for r in edges.outline(edges.rectangle_edges(boxes, "gid")).collect()}
    one = {(0, 0, 10, 0), (0, 10, 10, 10), (0, 0, 0, 10), (10, 0, 10, 2), (10, 6, 10, 10), (10, 2, 14, 2), (10, 6, 14, 6), (14, 2, 14, 6)}
    assert got == one | {(30, 30, 31, 30), (30, 31, 31, 31), (30, 30, 30, 31), (31, 30, 31, 31)}


def test_wall_heights_fall_back_to_near_pixels_then_to_the_default(spark):
    points = spark.createDataFrame([(1, 5.0, 5.0), (2, 15.0, 5.0), (3, 500.0, 5.0)], "id int, x double, y double")
    pixels = spark.createDataFrame([(0, 0, 7.0), (1, 0, None)], "px int, py int, val double")
    assert {r["id"]: r["height"] for r in canyon.wall_heights(points, pixels, 10.0, 3.0, tile=1).collect()} == {1: 7.0, 2: 7.0, 3: 3.0}


def test_nearest_box_far_away(spark):
    box = "gid int, x0 double, y0 double, x1 double, y1 double"
    asked = spark.createDataFrame([(9, 0.0, 0.0, 1.0, 1.0)], box)
    others = spark.createDataFrame([(1, 900.0, 0.0, 901.0, 1.0), (2, -890.0, 0.0, -880.0, 1.0)], box)
    assert [tuple(r) for r in spatial.nearest_box(asked, others, 40.0).collect()] == [(9, 2)]
    assert spatial.nearest_box(asked, others.limit(0), 40.0).count() == 0
