"""Registered queries of the output cube, added to those of grid_queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.domain import Domain
from cellweave.operators import canopy as cp
from cellweave.operators import cube as cb
from cellweave.operators import cutcell as cc
from cellweave.operators import edges as ed
from cellweave.operators import landcover as lc
from cellweave.operators import params as pr
from cellweave.operators import spatial as sp
from cellweave.operators import stencil as st
from cellweave.plans import grid_queries as gq
from cellweave.plans.grid_queries import BC, CL, CV, TOP, UC, D, L, query
from cellweave.session import shared_dir
from cellweave.sources import cube_files

WITH = "WITH " + CL + ", " + BC + ", " + UC
LAYERS = ["fx_landcover", "fx_street", "fx_trees", "fx_extras"]
DEPTHS, PARS = [0.25, 0.25, 0.5, 1.0], [(1.5, 1.0), (2e6, 1.5e6)]
TEMPS = [(1, 283.0), (2, 284.5), (3, 285.0)]


@query("s3_verify_import", " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n, count(*) > 0 AS ok FROM {n}" for n in LAYERS))
def _(s, d):
    return cb.verify_import({n: L(s, d, n) for n in LAYERS})


@query("s9_default_srid", "SELECT lid, CAST(CASE WHEN lid % 3 = 0 THEN 32633 ELSE 3035 END AS INT) AS srid FROM fx_landcover")
def _(s, d):
    return cb.default_srid(L(s, d, "fx_landcover").select("lid", F.when(F.col("lid") % 3 != 0, 3035).alias("srid")), 32633)


@query("s13_write_cube", "WITH " + gq.CUBE + ", v AS (SELECT DISTINCT var FROM cube) SELECT v.var, g.j, g.i, coalesce(c.value, -9999::DOUBLE) AS value FROM v CROSS JOIN fx_grid g LEFT JOIN cube c ON c.var = v.var AND c.i = g.i AND c.j = g.j")
def _(s, d):
    path = f"{shared_dir(s)}/cube-{uuid.uuid4().hex}"
    cube_files.write_cube(gq.cube(s, d), L(s, d, "fx_grid"), [n for n, _, _ in pr.SPEC], path, {"zt": {"units": "m"}})
    return cube_files.read_cube(s, path)


@query("s14_cube_metadata", "SELECT 'Conventions' AS key, 'CF-1.7' AS value UNION ALL SELECT unnest(['origin_x', 'origin_y', 'dx', 'dy', 'dz']), unnest(['0.0', '0.0', '10.0', '10.0', '5.0']) UNION ALL SELECT unnest(['nx', 'ny']), CAST(nx AS VARCHAR) FROM fx_dom")
def _(s, d):
    return cb.metadata(s, D(s, d))


@query("s15_coordinates", "SELECT id, j, i, xcen AS x, ycen AS y, 500000 + xcen AS \"E_UTM\", 5500000 + ycen AS \"N_UTM\" FROM fx_grid")
def _(s, d):
    return cb.coordinates(L(s, d, "fx_grid"), gq.placed(s, d), 33).select("id", "j", "i", "x", "y", "E_UTM", "N_UTM")


@query("r3_resample", "SELECT g.i, g.j, p.val FROM fx_grid g JOIN fx_dem p ON p.px = floor(g.xcen / 25) AND p.py = floor(g.ycen / 25)")
def _(s, d):
    return cb.resample(L(s, d, "fx_grid"), L(s, d, "fx_dem"), 25.0)


@query("v2_surface_fraction", WITH + " SELECT CAST(k AS INT) AS layer, j, i, CASE WHEN CAST(floor(type / 100) AS INT) - 1 = k THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value FROM uc CROSS JOIN range(3) r(k) WHERE type >= 100 AND type < 400")
def _(s, d):
    return cb.surface_fraction(gq.urban_cells(s, d))


@query("v5_water_pars", WITH + ", t AS (SELECT * FROM (VALUES (1, 283.0), (2, 284.5), (3, 285.0)) t(class, v)) SELECT 0 AS par, j, i, CAST(v AS DOUBLE) AS value FROM uc JOIN t ON class = type - 300 WHERE type >= 300 AND type < 400")
def _(s, d):
    return cb.by_class(gq.urban_cells(s, d), "water", 300, s.createDataFrame([(c, 0, v) for c, v in TEMPS], "class int, par int, value double"))


def materials(s, d) -> DataFrame:
    return gq.urban_cells(s, d).join(F.broadcast(L(s, d, "fx_material").withColumnRenamed("code", "catland")), "catland")  # at most two rows a nation


MAT = WITH + ", mc AS (SELECT uc.*, m.albedo, m.emissivity, m.roughness FROM uc JOIN fx_material m ON m.code = uc.catland)"


@query("v6_pavement_pars", MAT + " SELECT CAST(p AS INT) AS par, j, i, CASE p WHEN 0 THEN roughness WHEN 1 THEN albedo ELSE emissivity END AS value FROM mc CROSS JOIN range(3) r(p) WHERE type >= 200 AND type < 300")
def _(s, d):
    return cb.material_pars(materials(s, d), "pavement", ["roughness", "albedo", "emissivity"])


@query("v6_vegetation_pars", MAT + " SELECT CAST(p AS INT) AS par, j, i, CASE p WHEN 0 THEN albedo ELSE emissivity END AS value FROM mc CROSS JOIN range(2) r(p) WHERE type >= 100 AND type < 200")
def _(s, d):
    return cb.material_pars(materials(s, d), "vegetation", ["albedo", "emissivity"])


@query("v7_pavement_subsurface_pars", WITH + ", z AS (SELECT * FROM (VALUES (0, 0.25), (1, 0.5), (2, 1.0), (3, 2.0)) t(layer, zsoil)), p AS (SELECT * FROM (VALUES (0, 1.5, 1.0), (1, 2000000, 1500000)) t(par, up, low)) SELECT par, layer, CAST(zsoil AS DOUBLE) AS zsoil, j, i, CAST(CASE WHEN layer < 2 THEN up ELSE low END AS DOUBLE) AS value FROM uc CROSS JOIN z CROSS JOIN p WHERE type >= 200 AND type < 300")
def _(s, d):
    return cb.subsurface_pars(gq.urban_cells(s, d), DEPTHS, 2, PARS)


@query("v8_buildings", WITH + TOP + " SELECT unnest(['building_id', 'buildings_2d', 'building_type']) AS var, tp.j, tp.i, CAST(unnest([tp.lid, tp.top * 5, uc.type - 900]) AS DOUBLE) AS value FROM tp JOIN uc USING (id)")
def _(s, d):
    return cb.building_variables(gq.urban_cells(s, d), gq.tops(s, d), 5.0)


@query("v9_albedo_pars", WITH + " SELECT CAST(p AS INT) AS par, j, i, round(m.albedo + p / 100::DOUBLE, 6) AS value FROM uc JOIN fx_material m ON m.code = uc.type - 100 CROSS JOIN range(7) r(p) WHERE type >= 100 AND type < 200")
def _(s, d):
    m = L(s, d, "fx_material").select(F.col("code").alias("class"), F.posexplode(F.array(*[F.round(F.col("albedo") + k / 100, 6) for k in range(7)])).alias("par", "value"))
    return cb.by_class(gq.urban_cells(s, d), "vegetation", 100, m)


@query("v10_albedo_of_facades", WITH + " SELECT uc.id, coalesce(CASE WHEN bc.lid % 2 = 0 THEN (bc.lid % 25) / 100::DOUBLE END, r.albedo, m.albedo) AS albedo FROM uc LEFT JOIN bc USING (id) LEFT JOIN fx_roofs r ON r.rid = bc.lid LEFT JOIN fx_material m ON m.code = uc.catland")
def _(s, d):
    cells = gq.urban_cells(s, d).join(gq.building_cells(s, d).select("id", F.col("lid").alias("b")), "id", "left")
    walls = L(s, d, "fx_walls").filter("wid % 8 = 0").select(F.expr("wid div 4").alias("b"), (F.col("wallcatd") / 100.0).alias("wall"))
    cells = cells.join(walls, "b", "left").join(L(s, d, "fx_roofs").select(F.col("rid").alias("b"), F.col("albedo").alias("roof")), "b", "left")
    m = F.broadcast(L(s, d, "fx_material").select(F.col("code").alias("catland"), "albedo"))
    return cells.join(m, "catland", "left").select("id", F.coalesce("wall", "roof", "albedo").alias("albedo"))


@query("v14_cap_window_fraction", "SELECT wid, CASE WHEN w > 0.95 THEN 0.95::DOUBLE ELSE w END AS win, CASE WHEN w > 0.95 THEN 0.05::DOUBLE ELSE 1 - w END AS wall FROM (SELECT wid, winfracu + (wid % 4) / 20::DOUBLE AS w FROM fx_walls)")
def _(s, d):
    w = L(s, d, "fx_walls").select("wid", (F.col("winfracu") + F.col("wid") % 4 / 20.0).alias("w"))
    win, wall = cb.cap_window_fraction(F.col("w"), 1 - F.col("w"))
    return w.select("wid", win.alias("win"), wall.alias("wall"))


@query("b1_buildings_grid", WITH + " SELECT id, i, j, lid, type FROM uc WHERE type >= 900 AND type < 1000")
def _(s, d):
    return gq.urban_cells(s, d).filter(pr.class_range("building")).select("id", "i", "j", "lid", "type")


@query("b5_min_levels", "WITH " + BC + TOP + " SELECT id, greatest(top, 3) AS top FROM tp")
def _(s, d):
    return cb.min_levels(gq.tops(s, d), 3).select("id", "top")


@query("b11_type_under_structure", WITH + ", x AS (SELECT g.id, min(e.gid) AS gid FROM fx_grid g JOIN fx_extras e ON g.xcen >= e.x0 AND g.xcen < e.x1 AND g.ycen >= e.y0 AND g.ycen < e.y1 WHERE e.class3d = 'passage' GROUP BY 1) SELECT uc.id, coalesce(e.typed, uc.type) AS type FROM uc LEFT JOIN x USING (id) LEFT JOIN fx_extras e ON e.gid = x.gid")
def _(s, d):
    e = L(s, d, "fx_extras").filter("class3d = 'passage'")
    hit = sp.points_in_polygons(L(s, d, "fx_grid").select("id", F.col("xcen").alias("x"), F.col("ycen").alias("y")), ed.rectangle_edges(e, "gid"), D(s, d))
    return cb.type_under_structure(gq.urban_cells(s, d), hit.join(e.select("gid", "typed"), "gid").select("id", "typed"))


@query("t6_canopy_cube", "WITH c AS (SELECT px AS i, py AS j, lai, canopy, unnest(range(0, CAST(ceil(canopy / 5) AS INT) + 1)) AS k FROM fx_block_raster WHERE canopy > 0 AND lai > 0) SELECT i, j, CAST(k AS INT) AS k, CASE WHEN k = 0 THEN 0 ELSE round(least(1.6, lai / canopy) * greatest(0, least(1, canopy / 5 - (k - 1))), 9) END AS lad FROM c")
def _(s, d):
    c = L(s, d, "fx_block_raster").select(F.col("px").alias("i"), F.col("py").alias("j"), "lai", "canopy")
    return cb.canopy_cube(cp.lad_from_lai(c, 5.0)).withColumn("lad", F.round("lad", 9))


@query("u11_frontal_fraction", "WITH " + CV + ", b AS (SELECT osm_id AS gid, (x1 - x0) * (y1 - y0) AS plan, 2 * ((x1 - x0) + (y1 - y0)) * 9 + (x1 - x0) * (y1 - y0) AS surface FROM fx_street) SELECT i, j, round(least(0.99, sum(area / plan * surface) / 100), 6) AS value FROM cv JOIN b USING (gid) WHERE area > 1e-9 GROUP BY 1, 2")
def _(s, d):
    e = ed.rectangle_edges(L(s, d, "fx_street"), "osm_id")
    wall = e.groupBy("gid").agg(F.sum(F.abs(F.col("xb") - F.col("xa")) + F.abs(F.col("yb") - F.col("ya"))).alias("ring"))
    b = wall.join(ed.areas(e), "gid").select("gid", F.col("area").alias("plan"), (F.col("ring") * 9 + F.col("area")).alias("surface"))
    return cb.frontal_fraction(sp.coverage(e, D(s, d)).select("gid", "i", "j", "area"), b, 100.0).withColumn("value", F.round("value", 6))


@query("u13_layer_defaults", "WITH " + BC + " SELECT v.var, v.layer, bc.j, bc.i, CAST(v.value AS DOUBLE) AS value FROM bc CROSS JOIN (VALUES ('thickness', 0, 0.02), ('thickness', 1, 0.15), ('conductivity', 0, 0.8)) v(var, layer, value)")
def _(s, d):
    return cb.layer_defaults(gq.building_cells(s, d), [("thickness", 0, 0.02), ("thickness", 1, 0.15), ("conductivity", 0, 0.8)])


@query("w5_surface_coords", "WITH " + BC + TOP + gq.WALLS + " SELECT id, direction, 500000 + xs AS e_utm, 5500000 + ys AS n_utm FROM wl")
def _(s, d):
    dom = gq.placed(s, d)
    return gq.w2(s, d).select("id", "direction", (F.col("xs") + dom.origin_x).alias("e_utm"), (F.col("ys") + dom.origin_y).alias("n_utm"))


@query("k3_building_override", "WITH " + BC + TOP + ", cr AS (SELECT a.p_partkey::INT AS i, c.p_partkey::INT AS j FROM part a CROSS JOIN part c CROSS JOIN fx_dom d WHERE a.p_partkey <= d.nx AND c.p_partkey <= d.nx), x AS (SELECT i, j, min(osm_id) AS lid FROM cr JOIN fx_street s ON i * 10 >= s.x0 AND i * 10 < s.x1 AND j * 10 >= s.y0 AND j * 10 < s.y1 GROUP BY 1, 2), t AS (SELECT lid, max(top) AS top FROM tp GROUP BY 1) SELECT cr.i, cr.j, t.top FROM cr LEFT JOIN x USING (i, j) LEFT JOIN t USING (lid)")
def _(s, d):
    dom = D(s, d)
    # corners are the centres of a grid that lies half a cell lower
    around = Domain(dom.nx + 1, dom.ny + 1, dom.dx, dom.dy, dom.dz, dom.origin_x - dom.dx / 2, dom.origin_y - dom.dy / 2)
    return cb.building_override(cc.corner_lattice(s, dom), sp.held_cells(around, {"lid": gq.street_layer(s, d)}), gq.tops(s, d))


@query("k5_corner_building_height", "WITH " + BC + TOP + ", o AS (SELECT a.range - 1 AS a, b.range - 1 AS b FROM range(3) a, range(3) b) SELECT l.i, l.j, l.nz + max(coalesce(tp.top, 0)) AS nz FROM fx_levels l CROSS JOIN o LEFT JOIN tp ON tp.i = l.i + o.a AND tp.j = l.j + o.b GROUP BY l.i, l.j, l.nz")
def _(s, d):
    offsets = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    near = gq.tops(s, d).select("i", "j", "top", F.explode(offsets).alias("o")).groupBy((F.col("i") + F.col("o.a")).alias("i"), (F.col("j") + F.col("o.b")).alias("j")).agg(F.max("top").alias("top"))
    return L(s, d, "fx_levels").join(near, ["i", "j"], "left").select("i", "j", (F.col("nz") + F.greatest(F.coalesce("top", F.lit(0)), F.lit(0))).alias("nz"))


@query("k15_dedupe_faces", "WITH f AS (SELECT fid, x0, y0, x1, y1, z00, z10, z11, z01 FROM fx_faces UNION ALL SELECT fid + 1000000, x0, y0, x1, y1, z00, z10, z11, z01 FROM fx_faces WHERE fid % 3 = 0) SELECT CAST(min(fid) AS INT) AS fid, x0, y0, x1, y1, z00, z10, z11, z01 FROM f GROUP BY x0, y0, x1, y1, z00, z10, z11, z01")
def _(s, d):
    f = L(s, d, "fx_faces")
    twice = f.filter(F.col("fid") % 3 == 0).withColumn("fid", (F.col("fid") + 1000000).cast("int"))
    return cb.dedupe_faces(f.unionByName(twice), ["x0", "y0", "x1", "y1", "z00", "z10", "z11", "z01"], "fid")


FACES = WITH + ", fc AS (SELECT f.fid, CASE WHEN type >= 900 THEN 'building' WHEN type >= 300 THEN 'water' WHEN type >= 200 THEN 'pavement' WHEN type >= 100 THEN 'vegetation' END AS kind, type % 100 AS class FROM fx_faces f LEFT JOIN uc ON uc.i = floor((x0 + x1) / 20) AND uc.j = floor((y0 + y1) / 20))"


@query("k23_face_classes", FACES + " SELECT fid, kind, class FROM fc")
def k23(s, d):
    return cb.face_classes(L(s, d, "fx_faces"), gq.urban_cells(s, d), D(s, d))


@query("k24_face_type_check", FACES + " SELECT fid FROM fc WHERE fid % 9 = 0 OR kind IS NULL OR class IS NULL")
def _(s, d):
    broken = k23(s, d).withColumn("class", F.when(F.col("fid") % 9 != 0, F.col("class")))
    return cb.face_type_check(broken)


# fixpoints: rounds until nothing changes, tested by their property


@query("p3_fill_building_holes_all")
def _(s, d):
    dom = D(s, d)
    return st.fill_building_holes_all(L(s, d, "fx_levels").select("id", "i", "j", "is_building", (F.col("id") % 7).cast("int").alias("lid")), dom.nx, dom.ny)


@query("p5_fill_corners_all")
def _(s, d):
    dom = D(s, d)
    return st.fill_corners_all(L(s, d, "fx_levels").select("id", "i", "j", "nz"), dom.nx, dom.ny)


@query("k4_saddle_filter_all")
def _(s, d):
    return st.saddles_all(L(s, d, "fx_levels"))


@query("c7_fill_courtyards_all")
def _(s, d):
    t = L(s, d, "fx_street").select(F.col("osm_id").alias("gid"), F.when(F.col("osm_id") % 4 == 0, 101).otherwise(900 + F.col("osm_id") % 6).cast("int").alias("type"))
    return lc.fill_courtyards_all(t, gq.l10(s, d), ed.areas(ed.rectangle_edges(L(s, d, "fx_street"), "osm_id")), 400.0)


REG2 = gq.REG.replace("WHERE a.nz = b.nz)", "WHERE a.nz = 2 AND b.nz = 2)").replace("AS root FROM fx_levels UNION", "AS root FROM fx_levels WHERE nz = 2 UNION")


@query("p8_fill_layer_pockets", "WITH " + gq.N4 + ", " + REG2 + ", o8 AS (SELECT a.range - 1 AS di, b.range - 1 AS dj FROM range(3) a, range(3) b), lw AS (SELECT DISTINCT rg.root FROM rg JOIN fx_levels c USING (id) JOIN o8 ON true JOIN fx_levels b ON b.i = c.i + o8.di AND b.j = c.j + o8.dj WHERE b.nz < 2), up AS (SELECT root FROM rg GROUP BY root HAVING count(*) <= 4 AND root NOT IN (SELECT root FROM lw)) SELECT c.id, c.nz + CASE WHEN up.root IS NOT NULL THEN 1 ELSE 0 END AS nz FROM fx_levels c LEFT JOIN rg USING (id) LEFT JOIN up ON up.root = rg.root")
def _(s, d):
    return st.fill_layer_pockets(L(s, d, "fx_levels").select("id", "i", "j", "nz"), 2, 4).select("id", "nz")


gq.SQL["p8_fill_layer_pockets"] = "WITH RECURSIVE " + gq.SQL["p8_fill_layer_pockets"].removeprefix("WITH ")
