"""Fixpoints over regions that are done in squares of cells: equal to brute force across the squares' borders, one shuffle, no join."""

import random

from cellweave.domain import Domain
from cellweave.operators import buildings, faces, stencil
from tests.test_grid import plain_basins, plain_fill_heights
from tests.test_limits import plan


def rough(seed, n, levels, gaps=0.03):
    rnd = random.Random(seed)
    return {(i, j): rnd.randrange(levels) for i in range(-3, n) for j in range(-7, n) if rnd.random() >= gaps}


def as_cells(spark, nz):
    return spark.createDataFrame([(n, i, j, z) for n, ((i, j), z) in enumerate(nz.items())], "id int, i int, j int, nz int")


def levels_of(df):
    return {(r["i"], r["j"]): r["nz"] for r in df.collect()}


def test_basins_in_one_shuffle_equal_brute_force(spark):
    # levels that settle only after more rounds than are done at once
    nz = rough(3, 40, 4)
    cells = as_cells(spark, nz)
    want, turns = plain_basins(nz, least=6)
    once = stencil.fill_small_basins(cells, 6)
    assert turns > 1 and plan(once).count("Exchange") == 1 and "Join" not in plan(once)
    assert levels_of(once) == plain_basins(nz, least=6, most=1)[0]
    assert levels_of(stencil.fill_small_basins_all(cells, 6, at_once=1)) == levels_of(stencil.fill_small_basins_all(cells, 6)) == want
    assert levels_of(stencil.fill_small_basins_all(cells, 6, most=2, at_once=2)) == plain_basins(nz, least=6, most=2)[0]


def test_basins_across_squares(spark, monkeypatch):
    real = stencil._in_tiles
    monkeypatch.setattr(stencil, "_in_tiles", lambda cells, value, halo, work: real(cells, value, halo, work, tile=5))
    nz = rough(4, 30, 3)
    got = stencil.fill_small_basins_all(as_cells(spark, nz), 5, at_once=3)
    assert got.columns == ["id", "i", "j", "nz"] and levels_of(got) == plain_basins(nz, least=5)[0]


def test_unknown_levels_stay(spark):
    nz = {(i, j): 5 for i in range(5) for j in range(5)} | {(2, 2): 1, (2, 3): None}
    assert levels_of(stencil.fill_small_basins_all(as_cells(spark, nz))) == nz | {(2, 2): 5}


def plain_pockets(nz, level, most):
    new, done = dict(nz), set()
    for start in nz:
        if nz[start] != level or start in done:
            continue
        region, todo = {start}, [start]
        while todo:
            i, j = todo.pop()
            for n in ((i - 1, j), (i + 1, j), (i, j - 1), (i, j + 1)):
                if nz.get(n) == level and n not in region:
                    region.add(n)
                    todo.append(n)
        done |= region
        low = any(nz.get((i + a, j + b), level) < level for i, j in region for a in (-1, 0, 1) for b in (-1, 0, 1))
        if len(region) <= most and not low:
            new |= dict.fromkeys(region, level + 1)
    return new


def test_pockets_in_one_shuffle_equal_brute_force(spark, monkeypatch):
    real = stencil._in_tiles
    nz = {k: max(v - 1, 1 + (k[0] % 7 > 0)) for k, v in rough(6, 30, 5).items()}
    for most in (1, 3, 5):
        for tile in (256, 4):
            monkeypatch.setattr(stencil, "_in_tiles", lambda cells, value, halo, work, tile=tile: real(cells, value, halo, work, tile=tile))
            got = stencil.fill_layer_pockets(as_cells(spark, nz), 2, most)
            assert plan(got).count("Exchange") == 1 and "Join" not in plan(got)
            want = plain_pockets(nz, 2, most)
            assert levels_of(got) == want and want != nz


def test_terrain_across_squares_is_sliced_in_batches(spark, monkeypatch):
    """Every corner is sent once or twice, not four times; slices are cut in one pass without expressions over arrays."""
    z = {k: v * 3.1 + 1.37 for k, v in rough(8, 12, 4).items()}
    corners = spark.createDataFrame([(i, j, v) for (i, j), v in z.items()], "i int, j int, z double")
    dom = Domain(12, 12, 10.0, 10.0, 5.0, -40.0, 3.0)
    monkeypatch.setattr(faces, "TILE", 5)
    made = faces.terrain_faces(corners, dom)
    assert plan(made).count("Exchange") == 1 and "collect_list" not in plan(made)
    around = ((0, 0), (1, 0), (1, 1), (0, 1))
    want = {(i, j): [((i + a) * 10.0 - 40.0, (j + b) * 10.0 + 3.0, z[i + a, j + b]) for a, b in around] for i, j in z if all((i + a, j + b) in z for a, b in around)}
    assert {(r["i"], r["j"]): [tuple(v) for v in r["verts"]] for r in made.collect()} == want
    cut = faces.slice_faces(made, dom.dz)
    assert "zip_with" not in plan(cut) and "explode" not in plan(cut).split("MapInArrow")[0]
    for r in cut.collect():
        assert all(r["k"] * 5 <= v["z"] <= r["k"] * 5 + 5 for v in r["verts"]) and len(set(r["verts"])) == len(r["verts"]) >= 3
    assert {(r["i"], r["j"]) for r in cut.collect()} == set(want)


def test_slices_keep_columns_and_drop_unknown_corners(spark):
    rows = [(1, "a", [(0, 0, 0), (4, 0, 0), (4, 0, None), (4, 0, 12), (0, 0, 12), (0, 0, 0)]), (2, "b", None), (3, "c", [(0, 0, 1), (1, 0, 1)]), (4, "d", [(0, 0, 5), (1, 0, 5), (1, 1, 5)])]
    df = spark.createDataFrame(rows, "fid int, name string, verts array<struct<x: int, y: int, z: int>>")
    got = faces.slice_faces(df, 5.0)
    assert got.columns == ["fid", "name", "verts", "k"]
    assert sorted((r["fid"], r["name"], r["k"], len(r["verts"])) for r in got.collect()) == [(1, "a", 0, 4), (1, "a", 1, 4), (1, "a", 2, 4), (4, "d", 0, 3)]


def test_closed_surface_check_collects_no_rings(spark):
    """Keys come from whole batches of rings, and a face's neighbours from one sorted run; a vertex with an unknown coordinate has no key."""
    dom = Domain(4, 4, 10.0, 10.0, 5.0, 0.0, 0.0)
    ring = [(0.0, 0.0, 2.0), (10.0, 0.0, 2.0), (10.0, 10.0, 2.0), (0.0, 10.0, None)]
    df = spark.createDataFrame([(1, ring), (2, None), (3, [])], "fid int, verts array<struct<x: double, y: double, z: double>>")
    keys = faces.vertex_keys(df, dom)
    assert "zip_with" not in plan(keys)
    got = sorted(((r["fid"], r["at"], r["j"], r["i"], r["dir"], r["z"]) for r in keys.collect()), key=lambda r: r[:2])
    assert [r[:4] + r[5:] for r in got] == [(1, 0, 0, 0, 2.0), (1, 1, 0, 1, 2.0), (1, 2, 1, 1, 2.0), (1, 3, None, None, None)] and got[3][4] is None
    vertices, refs = faces.keyed_index(keys)
    found = faces.watertight_check(refs, vertices, dom)
    assert "zip_with" not in plan(found) and "collect_list" not in plan(found)
    assert {r["rule"] for r in found.collect()} >= {"faces"}


def test_heights_are_filled_in_one_shuffle_as_brute_force(spark, monkeypatch):
    rnd = random.Random(9)
    cells = {}
    for i in range(-4, 22):
        for j in range(-2, 22):
            if rnd.random() < 0.5:
                cells[i, j] = (1000 - 30 * i + j, rnd.choice([1, 2, 3, 4]), rnd.choice([None] * 5 + [3.5, 7.0]))
    df = spark.createDataFrame([(i, j, *v) for (i, j), v in cells.items()], "i int, j int, id int, lid int, height double")
    want = plain_fill_heights(dict(cells), 2)
    made = buildings.fill_heights(df, 2)
    assert plan(made).count("Exchange") == 1 and "Join" not in plan(made)
    real = buildings._in_tiles
    for tile in (256, 6):
        monkeypatch.setattr(buildings, "_in_tiles", lambda *a, tile=tile, **k: real(*a, tile=tile, **k))
        assert {r["id"]: (r["lid"], r["height"]) for r in buildings.fill_heights(df, 2).collect()} == want
