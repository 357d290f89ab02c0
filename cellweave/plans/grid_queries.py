"""Registered queries of the gridding operators; each oracle states the same result in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.domain import Domain
from cellweave.operators import buildings as bl
from cellweave.operators import canopy as cp
from cellweave.operators import canyon as cy
from cellweave.operators import cube as cb
from cellweave.operators import cutcell as cc
from cellweave.operators import edges as ed
from cellweave.operators import grid as gr
from cellweave.operators import landcover as lc
from cellweave.operators import numbering as nb
from cellweave.operators import params as pr
from cellweave.operators import raster as rs
from cellweave.operators import spatial as sp
from cellweave.operators import stencil as st
from cellweave.plans import fixtures as fx
from cellweave.session import table

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` follows the fixture layers and may begin with more of them."""

    def add(f):
        QUERIES[name] = f
        if sql:
            body = sql.strip()
            SQL[name] = fx.PREFIX + (", " + body[5:] if body.upper().startswith("WITH ") else body)
        return f

    return add


L, D = fx.layer, fx.domain

#: Shared steps of the oracles.
LC = "lc AS (SELECT l.lid, k.type_land AS type, l.catland, l.x0, l.y0, l.x1, l.y1 FROM fx_landcover l JOIN fx_codes k USING (code))"
CL = LC + ", cl AS (SELECT g.id, g.i, g.j, g.xcen, g.ycen, l.lid, l.type, l.catland FROM fx_grid g LEFT JOIN lc l ON l.x0 = floor(g.xcen / 40) * 40 AND l.y0 = floor(g.ycen / 40) * 40)"
BC = "hit AS (SELECT g.id, min(s.osm_id) AS lid FROM fx_grid g JOIN fx_street s ON g.xcen >= s.x0 AND g.xcen < s.x1 AND g.ycen >= s.y0 AND g.ycen < s.y1 GROUP BY g.id), bc AS (SELECT g.id, g.i, g.j, g.xcen, g.ycen, h.lid, b.val AS height FROM fx_grid g JOIN hit h USING (id) LEFT JOIN fx_bheight b ON b.px = floor(g.xcen / 20) AND b.py = floor(g.ycen / 20))"
#: After CL and BC.
UC = "uc AS (SELECT cl.id, cl.i, cl.j, coalesce(bc.lid, cl.lid) AS lid, CAST(coalesce(900 + bc.lid % 7, cl.type) AS INT) AS type, cl.catland FROM cl LEFT JOIN bc USING (id))"
N4 = "o4 AS (SELECT * FROM (VALUES (-1, 0), (1, 0), (0, -1), (0, 1)) t(di, dj))"
CV = "cv AS (SELECT s.osm_id AS gid, g.i, g.j, greatest(0, least(s.x1, g.xcen + 5) - greatest(s.x0, g.xcen - 5)) * greatest(0, least(s.y1, g.ycen + 5) - greatest(s.y0, g.ycen - 5)) AS area FROM fx_street s JOIN fx_grid g ON g.xcen + 5 > s.x0 AND g.xcen - 5 < s.x1 AND g.ycen + 5 > s.y0 AND g.ycen - 5 < s.y1)"


def typed(s, d) -> DataFrame:
    """Land cover with classes."""
    return lc.map_types(L(s, d, "fx_landcover"), L(s, d, "fx_codes"), F.lit(False))


def land_layer(s, d) -> tuple[DataFrame, tuple[str, ...]]:
    return ed.rectangle_edges(typed(s, d), "lid", ("type", "catland")), ("type", "catland")


def street_layer(s, d) -> tuple[DataFrame, tuple[str, ...]]:
    return ed.rectangle_edges(L(s, d, "fx_street"), "osm_id"), ()


def class_cells(s, d) -> DataFrame:
    """The grid with the land-cover polygon of each cell centre."""
    dom = D(s, d)
    cells = sp.held_cells(dom, {"lid": land_layer(s, d)}, whole=True)
    return gr.located(cells, dom).select("id", "i", "j", "xcen", "ycen", "lid", "type", "catland")


def urban_cells(s, d) -> DataFrame:
    """The cells with footprints over the land cover: lid and class of the building where there is one."""
    dom = D(s, d)
    c = gr.located(sp.held_cells(dom, {"lid": land_layer(s, d), "b": street_layer(s, d)}, whole=True), dom)
    return c.select("id", "i", "j", "xcen", "ycen", F.coalesce("b", "lid").alias("lid"), F.coalesce(900 + F.col("b") % 7, "type").cast("int").alias("type"), "catland")


def placed(s, d) -> Domain:
    """The domain as placed in its UTM zone."""
    dom = D(s, d)
    return Domain(dom.nx, dom.ny, dom.dx, dom.dy, dom.dz, 500_000.0, 5_500_000.0)


def building_cells(s, d) -> DataFrame:
    """Cells whose centre lies in a footprint, with the sampled height."""
    dom = D(s, d)
    c = gr.located(sp.held_cells(dom, {"lid": street_layer(s, d)}), dom)
    c = rs.with_value(c, L(s, d, "fx_bheight"), 20.0, "xcen", "ycen")
    return c.select("id", "i", "j", "xcen", "ycen", "lid", F.col("val").alias("height"))


def diamond_edges(s, d) -> DataFrame:
    x, y, rx, ry = map(F.col, ("cx", "cy", "rx", "ry"))
    # partitioned before they grow to edges and cells, which then stay where their polygon is
    return ed.ring_edges(L(s, d, "fx_diamond").repartition(sp.tasks(s, D(s, d)), "gid"), "gid", [(x + rx, y), (x, y + ry), (x - rx, y), (x, y - ry)])


# sources, schema


@query("s4_standardize_columns", "SELECT lid AS land_id, code, catland FROM fx_landcover")
def _(s, d):
    return lc.standardize_columns(L(s, d, "fx_landcover"), {"lid": "land_id"}, ["land_id", "code"]).select("land_id", "code", "catland")


@query("s5_load_lookup", "SELECT code, albedo, emissivity FROM fx_material")
def _(s, d):
    return lc.load_lookup(L(s, d, "fx_material"), "code").select("code", "albedo", "emissivity")


@query("s6_capability_flags", "SELECT (SELECT count(*) FROM fx_landcover JOIN fx_codes USING (code) WHERE type_street >= 900 AND type_street <= 999) > 0 AS has_buildings, (SELECT count(*) FROM fx_extras) > 0 AS has_3d, (SELECT count(*) FROM fx_material) > 0 AS has_surface_params, (SELECT count(*) FROM fx_trees) > 0 AS has_trees")
def _(s, d):
    one = lambda df, c, name: df.agg((F.count_if(c) > 0).alias(name))
    flags = one(lc.map_types(L(s, d, "fx_landcover"), L(s, d, "fx_codes"), F.lit(True)), F.col("type").between(900, 999), "has_buildings")
    for layer, name in (("fx_extras", "has_3d"), ("fx_material", "has_surface_params"), ("fx_trees", "has_trees")):
        flags = flags.crossJoin(one(L(s, d, layer), F.lit(True), name))  # one row each
    return flags


@query("s8_unique_key", "SELECT CAST(row_number() OVER (ORDER BY o_custkey, o_orderkey) AS INT) AS k, o_custkey AS old_k, o_orderkey FROM orders")
def _(s, d):
    return nb.ensure_unique_key(table(s, d, "orders").select(F.col("o_custkey").alias("k"), "o_orderkey"), "k", ["o_orderkey"]).select("k", "old_k", "o_orderkey")


@query("s10_extent", "SELECT min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM fx_street")
def _(s, d):
    return lc.extent(L(s, d, "fx_street"))


@query("s11_clip_to_extent", "SELECT osm_id FROM fx_street WHERE x1 > 100 AND x0 < 400 AND y1 > 100 AND y0 < 400")
def _(s, d):
    return lc.clip_to_extent(L(s, d, "fx_street"), 100, 100, 400, 400).select("osm_id")


@query("s12_explode_rings", "SELECT osm_id AS gid, CAST(4 AS BIGINT) AS n_edges, 2 * ((x1 - x0) + (y1 - y0)) AS perimeter FROM fx_street")
def _(s, d):
    p = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    rings = L(s, d, "fx_street").withColumn("rings", F.array(F.array(p("x0", "y0"), p("x1", "y0"), p("x1", "y1"), p("x0", "y1"))))
    e = ed.explode_rings(rings, "osm_id")
    return e.groupBy("gid").agg(F.count("*").alias("n_edges"), F.sum(F.abs(F.col("xb") - F.col("xa")) + F.abs(F.col("yb") - F.col("ya"))).alias("perimeter"))


@query("s15_axis_coords", "SELECT DISTINCT i, xcen AS x FROM fx_grid")
def _(s, d):
    return L(s, d, "fx_grid").select("i", F.col("xcen").alias("x")).distinct()


# grid


@query("g1_make_grid", "SELECT id, i, j, xcen - 5 AS xmi, xcen + 5 AS xma, ycen - 5 AS ymi, ycen + 5 AS yma, xcen, ycen FROM fx_grid")
def _(s, d):
    return gr.make_grid(s, D(s, d))


@query("g2_make_fishnet", "SELECT CAST(i * n + j + 1 AS INT) AS id, i, j, i * 160.0 AS xmi, j * 160.0 AS ymi FROM fx_grid, (SELECT CAST(ceil(b * 40 / 160.0) AS INT) AS n FROM fx_dom) WHERE i < n AND j < n".replace("160.0", "CAST(160 AS DOUBLE)"))
def _(s, d):
    e = D(s, d).nx * 10.0
    return gr.make_fishnet(s, 0, 0, e, e, 160.0, 160.0).select("id", "i", "j", "xmi", "ymi")


def _utm_sql() -> str:
    radius, e, alpha, _ = gr._series()
    east = " + ".join(f"{a!r} * cos({2 * k} * xi) * sinh({2 * k} * eta)" for k, a in enumerate(alpha, 1))
    north = " + ".join(f"{a!r} * sin({2 * k} * xi) * cosh({2 * k} * eta)" for k, a in enumerate(alpha, 1))
    return f"""WITH p AS (SELECT id, radians(49.5 + j * 0.001) AS phi, radians(14.0 + i * 0.001 - 15) AS lam FROM fx_grid),
t AS (SELECT id, lam, sinh(atanh(sin(phi)) - {e!r} * atanh({e!r} * sin(phi))) AS t FROM p),
x AS (SELECT id, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta FROM t)
SELECT id, round(500000.0 + {0.9996 * radius!r} * (eta + {east}), 3)::DOUBLE AS e, round({0.9996 * radius!r} * (xi + {north}), 3)::DOUBLE AS n FROM x"""


@query("g4_reproject", _utm_sql())
def _(s, d):
    e, n = gr.lonlat_to_utm(14.0 + F.col("i") * 0.001, 49.5 + F.col("j") * 0.001, 33)
    return L(s, d, "fx_grid").select("id", F.round(e, 3).alias("e"), F.round(n, 3).alias("n"))


@query("g5_cell_of", "SELECT gid, CAST(floor(x / 10) AS INT) AS i, CAST(floor(y / 10) AS INT) AS j FROM fx_trees")
def _(s, d):
    i, j = gr.cell_of(F.col("x"), F.col("y"), D(s, d))
    return L(s, d, "fx_trees").select("gid", i.alias("i"), j.alias("j"))


@query("g6_vertical_index", "SELECT px, py, CAST(round_even((val - 190) / 5, 0) AS INT) AS nz FROM fx_dem WHERE val IS NOT NULL")
def _(s, d):
    return L(s, d, "fx_dem").filter("val is not null").select("px", "py", gr.vertical_index(F.col("val"), 190.0, 5.0).alias("nz"))


# raster


@query("r1_mosaic", "WITH t AS (SELECT 1 AS rid, px, py, val FROM fx_dem UNION ALL SELECT 2, px + 3, py + 2, val FROM fx_bheight) SELECT px, py, arg_max(val, rid) FILTER (WHERE val IS NOT NULL) AS val FROM t GROUP BY px, py")
def _(s, d):
    a = L(s, d, "fx_dem").select(F.lit(1).alias("rid"), "px", "py", "val")
    b = L(s, d, "fx_bheight").select(F.lit(2).alias("rid"), F.col("px") + 3, F.col("py") + 2, "val")
    return rs.mosaic(a.union(b))


@query("r2_clip_tiles", "SELECT DISTINCT CAST(floor(px / 8) AS INT) AS tx, CAST(floor(py / 8) AS INT) AS ty FROM fx_dem WHERE (floor(px / 8) + 1) * 200 > 100 AND floor(px / 8) * 200 < 700 AND (floor(py / 8) + 1) * 200 > 100 AND floor(py / 8) * 200 < 700")
def _(s, d):
    t = rs.retile(L(s, d, "fx_dem"), 8, 8).select("tx", "ty", (F.col("tx") * 200.0).alias("x0"), (F.col("ty") * 200.0).alias("y0"), (F.col("tx") * 200.0 + 200).alias("x1"), (F.col("ty") * 200.0 + 200).alias("y1"))
    return lc.clip_to_extent(t, 100, 100, 700, 700).select("tx", "ty")


@query("r4_retile", "SELECT CAST(floor(px / 64) AS INT) AS tx, CAST(floor(py / 64) AS INT) AS ty, CAST(4096 AS INT) AS size, CAST(4096 - count(val) AS INT) AS n_nodata, round(sum(val), 4) AS total FROM fx_dem GROUP BY 1, 2")
def _(s, d):
    t = rs.retile(L(s, d, "fx_dem"))
    ok = F.filter("vals", lambda v: v != -1e9)
    return t.select("tx", "ty", F.size("vals").alias("size"), (F.size("vals") - F.size(ok)).alias("n_nodata"), F.round(F.aggregate(ok, F.lit(0.0), lambda a, v: a + v), 4).alias("total"))


@query("r5_nodata", "SELECT px, py, coalesce(val, -1e9) AS val FROM fx_dem")
def _(s, d):
    return L(s, d, "fx_dem").select("px", "py", F.coalesce("val", F.lit(-1e9)).alias("val"))


NEAREST = """WITH p AS (SELECT id, xcen AS x, ycen AS y, CAST(floor(xcen / 25) AS INT) AS px, CAST(floor(ycen / 25) AS INT) AS py FROM fx_grid),
own AS (SELECT p.id, m.val FROM p JOIN fx_dem m USING (px, py) WHERE m.val IS NOT NULL),
far AS (SELECT p.id, m.val, row_number() OVER (PARTITION BY p.id ORDER BY ((m.px + 0.5) * 25 - p.x) ** 2 + ((m.py + 0.5) * 25 - p.y) ** 2, m.py, m.px) AS n
 FROM p ANTI JOIN own USING (id) JOIN fx_dem m ON m.px // 64 = p.px // 64 AND m.py // 64 = p.py // 64 WHERE m.val IS NOT NULL)
"""


@query("r6_sample_nearest", NEAREST + "SELECT id, val FROM own UNION ALL SELECT id, val FROM far WHERE n = 1")
def r6(s, d):
    return rs.sample_nearest(L(s, d, "fx_grid").select("id", F.col("xcen").alias("x"), F.col("ycen").alias("y")), L(s, d, "fx_dem"), 25.0)


@query("r7_sample_value", "SELECT g.id, r.imperv AS val FROM fx_grid g LEFT JOIN fx_block_raster r ON r.px = floor(g.xcen / 40) AND r.py = floor(g.ycen / 40)")
def _(s, d):
    p = L(s, d, "fx_grid").select("id", F.col("xcen").alias("x"), F.col("ycen").alias("y"))
    return rs.sample_value(p, L(s, d, "fx_block_raster").withColumnRenamed("imperv", "val"), 40.0)


@query("r8_pixel_points", "SELECT (px + 0.5) * 25 AS x, (py + 0.5) * 25 AS y, val FROM fx_dem WHERE val IS NOT NULL".replace("0.5", "CAST(0.5 AS DOUBLE)"))
def _(s, d):
    return rs.pixel_points(L(s, d, "fx_dem"), 25.0)


@query("r9_slope", """WITH o AS (SELECT a.range - 1 AS a, b.range - 1 AS b FROM range(3) a, range(3) b),
g AS (SELECT p.px - o.a AS px, p.py - o.b AS py, count(*) AS n, sum(o.a * (2 - abs(o.b)) * p.val) / 200 AS p, sum(o.b * (2 - abs(o.a)) * p.val) / 200 AS q FROM fx_dem p, o WHERE p.val IS NOT NULL GROUP BY 1, 2)
SELECT CAST(px AS INT) AS px, CAST(py AS INT) AS py, round(degrees(atan(sqrt(p * p + q * q))), 6) AS slope, round(degrees(atan2(-p, -q)), 6) AS aspect FROM g WHERE n = 9""")
def _(s, d):
    return rs.slope(L(s, d, "fx_dem"), 25.0).select("px", "py", F.round("slope", 6).alias("slope"), F.round("aspect", 6).alias("aspect"))


@query("r10_zonal_mean", "SELECT CAST(floor(px / 2) AS INT) AS i, CAST(floor(py / 2) AS INT) AS j, round(avg(val), 6) AS h FROM fx_bheight WHERE val IS NOT NULL GROUP BY 1, 2")
def _(s, d):
    p = rs.pixel_points(L(s, d, "fx_bheight"), 20.0)
    return p.groupBy(F.floor(F.col("x") / 40).cast("int").alias("i"), F.floor(F.col("y") / 40).cast("int").alias("j")).agg(F.round(F.avg("val"), 6).alias("h"))


@query("r11_lai_canopy", "SELECT px, py, lai * 0.5 AS lai, CASE WHEN canopy >= 5 THEN canopy ELSE 0 END AS canopy FROM fx_block_raster".replace("0.5", "CAST(0.5 AS DOUBLE)"))
def _(s, d):
    return L(s, d, "fx_block_raster").select("px", "py", (F.col("lai") * 0.5).alias("lai"), F.when(F.col("canopy") >= 5, F.col("canopy")).otherwise(0.0).alias("canopy"))


# land cover


@query("l2_background", "WITH " + CL + " SELECT i, j FROM cl WHERE lid IS NULL")
def _(s, d):
    return class_cells(s, d).filter("lid is null").select("i", "j")


@query("l3_filter_streetmap", "SELECT osm_id AS gid, (x1 - x0) * (y1 - y0) AS area FROM fx_street WHERE (x1 - x0) * (y1 - y0) > 200")
def _(s, d):
    return ed.areas(ed.rectangle_edges(L(s, d, "fx_street"), "osm_id")).filter("area > 200").select("gid", "area")


@query("l4_centroid_code", "WITH " + LC + " SELECT s.osm_id AS id, min(l.lid) AS gid FROM fx_street s JOIN lc l ON (s.x0 + s.x1) / 2 >= l.x0 AND (s.x0 + s.x1) / 2 < l.x1 AND (s.y0 + s.y1) / 2 >= l.y0 AND (s.y0 + s.y1) / 2 < l.y1 GROUP BY 1")
def _(s, d):
    c = ed.areas(ed.rectangle_edges(L(s, d, "fx_street"), "osm_id")).select(F.col("gid").alias("id"), F.col("cx").alias("x"), F.col("cy").alias("y"))
    return sp.points_in_polygons(c, ed.rectangle_edges(L(s, d, "fx_landcover"), "lid"), D(s, d))


@query("l5_priority_overlay", "WITH " + CL + ", " + BC + " SELECT i, j, lid, CAST(906 AS INT) AS type FROM bc UNION ALL SELECT i, j, lid, type FROM cl WHERE lid IS NOT NULL AND id NOT IN (SELECT id FROM bc)")
def _(s, d):
    land = class_cells(s, d).filter("lid is not null").select("i", "j", "lid", "type", F.lit(2).alias("priority"))
    street = building_cells(s, d).select("i", "j", "lid", F.lit(906).alias("type"), F.lit(1).alias("priority"))
    return lc.overlay(street.unionByName(land)).select("i", "j", "lid", "type")


@query("l6_merge_layers", "WITH m AS (SELECT 1 AS src, lid AS old FROM fx_landcover UNION ALL SELECT 2, osm_id FROM fx_street) SELECT CAST(row_number() OVER (ORDER BY src, old) AS INT) AS lid, src, old FROM m")
def _(s, d):
    m = L(s, d, "fx_landcover").select(F.lit(1).alias("src"), F.col("lid").alias("old")).unionByName(L(s, d, "fx_street").select(F.lit(2).alias("src"), F.col("osm_id").alias("old")))
    return nb.number_rows(m, ["src", "old"], "lid").select("lid", "src", "old")


@query("l7_map_types", "SELECT l.lid, CAST(CASE WHEN l.lid % 11 = 5 THEN 103 ELSE k.type_street END AS INT) AS type FROM fx_landcover l JOIN fx_codes k USING (code)")
def _(s, d):
    unknown = L(s, d, "fx_landcover").withColumn("code", F.when(F.col("lid") % 11 == 5, -1).otherwise(F.col("code")))
    return lc.map_types(unknown, L(s, d, "fx_codes"), F.lit(True)).select("lid", "type")


@query("l8_typed_landcover", "SELECT l.lid, CAST(CASE WHEN l.lid % 7 = 3 THEN 901 WHEN l.lid % 5 = 0 THEN 103 ELSE k.type_land END AS INT) AS type FROM fx_landcover l JOIN fx_codes k USING (code)")
def _(s, d):
    land = typed(s, d).select("lid", F.when(F.col("lid") % 5 != 0, F.col("type")).alias("type"))
    return land.select("lid", lc.typed_landcover(F.col("type"), F.col("lid") % 7 == 3).alias("type"))


PAIRS = "pr AS (SELECT a.osm_id AS a, b.osm_id AS b FROM fx_street a JOIN fx_street b ON a.osm_id < b.osm_id AND a.x0 <= b.x1 + 15 AND b.x0 <= a.x1 + 15 AND a.y0 <= b.y1 + 15 AND b.y0 <= a.y1 + 15 WHERE greatest(0, a.x0 - b.x1, b.x0 - a.x1) ** 2 + greatest(0, a.y0 - b.y1, b.y0 - a.y1) ** 2 <= 225)"


@query("l10_adjacent_pairs", "WITH " + PAIRS + " SELECT a, b FROM pr")
def l10(s, d):
    return lc.adjacent_pairs(L(s, d, "fx_street").withColumnRenamed("osm_id", "gid"), 15.0)


@query("l11_wall_segments", "WITH w AS (SELECT wid, xa, ya, xb, yb, greatest(1, CAST(ceil(sqrt((xb - xa) ** 2 + (yb - ya) ** 2) / 3) AS INT)) AS n FROM fx_walls), p AS (SELECT *, unnest(range(n)) AS k FROM w) SELECT CAST(floor(wid / 4) AS INT) AS gid, CAST(wid % 4 AS INT) AS edge, CAST(k AS INT) AS part, round(xa + (xb - xa) * k / n, 6) AS sx, round(ya + (yb - ya) * k / n, 6) AS sy FROM p")
def _(s, d):
    return lc.wall_segments(ed.rectangle_edges(L(s, d, "fx_street"), "osm_id"), 3.0).select("gid", "edge", "part", F.round("sx", 6).alias("sx"), F.round("sy", 6).alias("sy"))


@query("l14_smooth_corners", "WITH p AS (SELECT osm_id AS gid, unnest([0, 1, 2, 3, 4, 5, 6, 7]) AS k, unnest([x0, (x0 + x1) / 2, x1, x1, x1, (x0 + x1) / 2, x0, x0]) AS x, unnest([y0, y0, y0, (y0 + y1) / 2, y1, y1, y1, (y0 + y1) / 2]) AS y FROM fx_street) SELECT gid, CAST(k AS INT) AS at, x, y FROM p WHERE k % 2 = 1")
def _(s, d):
    x0, y0, x1, y1 = map(F.col, ("x0", "y0", "x1", "y1"))
    mx, my = (x0 + x1) / 2, (y0 + y1) / 2
    pts = F.array(*[F.struct(a.alias("x"), b.alias("y")) for a, b in ((x0, y0), (mx, y0), (x1, y0), (x1, my), (x1, y1), (mx, y1), (x0, y1), (x0, my))])
    p = L(s, d, "fx_street").select(F.col("osm_id").alias("gid"), F.posexplode(pts).alias("at", "p")).select("gid", "at", "p.x", "p.y")
    return lc.smooth_corners(p)


# spatial joins


@query("j1_class_cells", "WITH " + CL + " SELECT type, count(*) AS n FROM cl WHERE type IS NOT NULL GROUP BY type")
def _(s, d):
    return class_cells(s, d).filter("type is not null").groupBy("type").agg(F.count("*").alias("n"))


@query("j1_points_in_diamonds", "SELECT g.id, min(f.gid) AS gid FROM fx_grid g JOIN fx_diamond f ON abs(g.xcen + 0.23719 - f.cx) / f.rx + abs(g.ycen + 0.11373 - f.cy) / f.ry < 1 GROUP BY g.id")
def _(s, d):
    return sp.points_in_polygons(L(s, d, "fx_grid").select("id", (F.col("xcen") + 0.23719).alias("x"), (F.col("ycen") + 0.11373).alias("y")), diamond_edges(s, d), D(s, d))


@query("j2_nearest_polygon", "WITH " + CL + ", f AS (SELECT c.id, l.lid, greatest(0, l.x0 - c.xcen, c.xcen - l.x1) ** 2 + greatest(0, l.y0 - c.ycen, c.ycen - l.y1) ** 2 AS d2 FROM cl c JOIN lc l ON l.x0 <= c.xcen + 2000 AND l.x1 >= c.xcen - 2000 WHERE c.lid IS NULL), n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d2, lid) AS n FROM f) SELECT id, lid AS gid, round(sqrt(d2), 6) AS dist FROM n WHERE n = 1")
def _(s, d):
    lost = class_cells(s, d).filter("lid is null").select("id", F.col("xcen").alias("x"), F.col("ycen").alias("y"))
    return sp.nearest(lost, ed.rectangle_edges(typed(s, d), "lid"), 40.0).withColumn("dist", F.round("dist", 6))


@query("j3_coverage", "WITH " + CV + " SELECT gid, i, j, round(area, 6) AS area FROM cv WHERE area > 1e-9")
def _(s, d):
    return sp.coverage(ed.rectangle_edges(L(s, d, "fx_street"), "osm_id"), D(s, d)).select("gid", "i", "j", F.round("area", 6).alias("area"))


@query("j3_diamond_area", "SELECT gid, round(2 * rx * ry, 6) AS area FROM fx_diamond, fx_dom WHERE cx + rx <= b * 40 AND cy + ry <= b * 40 AND cx >= rx AND cy >= ry")
def _(s, d):
    dom = D(s, d)
    e = dom.nx * dom.dx
    inside = L(s, d, "fx_diamond").filter((F.col("cx") + F.col("rx") <= e) & (F.col("cy") + F.col("ry") <= e) & (F.col("cx") >= F.col("rx")) & (F.col("cy") >= F.col("ry"))).select("gid")
    return sp.coverage(diamond_edges(s, d), dom).groupBy("gid").agg(F.round(F.sum("area"), 6).alias("area")).join(inside, "gid")


@query("j4_dominant_type", "WITH " + CV + ", n AS (SELECT i, j, gid % 10 AS cls, row_number() OVER (PARTITION BY i, j ORDER BY area DESC, gid) AS n FROM cv WHERE area > 1e-9) SELECT i, j, CAST(cls AS INT) AS cls FROM n WHERE n = 1")
def _(s, d):
    c = sp.coverage(ed.rectangle_edges(L(s, d, "fx_street"), "osm_id"), D(s, d)).select("gid", "i", "j", F.round("area", 9).alias("area"))
    return sp.dominant(c.withColumn("cls", (F.col("gid") % 10).cast("int")))


@query("j5_normalize_fractions", "WITH " + CV + ", f AS (SELECT i, j, gid % 3 AS kind, sum(area) / 100 AS f FROM cv WHERE area > 1e-9 GROUP BY ALL HAVING sum(area) / 100 > 0.05) SELECT i, j, CAST(kind AS INT) AS kind, round(f / sum(f) OVER (PARTITION BY i, j), 6) AS f FROM f")
def _(s, d):
    c = sp.coverage(ed.rectangle_edges(L(s, d, "fx_street"), "osm_id"), D(s, d)).withColumn("area", F.round("area", 9))
    return sp.fractions(c.withColumn("kind", (F.col("gid") % 3).cast("int")), "kind", 0.05, 100.0).withColumn("f", F.round("f", 6))


@query("j6_building_cells", "WITH " + BC + " SELECT id, lid FROM bc")
def _(s, d):
    return building_cells(s, d).select("id", "lid")


@query("j8_within_class", "WITH " + CL + " SELECT t.gid, l.lid FROM fx_trees t JOIN lc l ON l.x0 = floor(t.x / 40) * 40 AND l.y0 = floor(t.y / 40) * 40 WHERE l.type < 200")
def _(s, d):
    green = typed(s, d).filter("type < 200")
    trees = L(s, d, "fx_trees").select(F.col("gid").alias("tid"), "x", "y")
    return sp.points_in_polygons(trees, ed.rectangle_edges(green, "lid"), D(s, d), "tid").select(F.col("tid").alias("gid"), F.col("gid").alias("lid"))


@query("j9_nearest_within", "WITH f AS (SELECT t.gid, s.osm_id, least(CASE WHEN t.x BETWEEN s.x0 AND s.x1 AND t.y BETWEEN s.y0 AND s.y1 THEN least(t.x - s.x0, s.x1 - t.x, t.y - s.y0, s.y1 - t.y) ELSE 1e9 END, CASE WHEN t.x BETWEEN s.x0 AND s.x1 AND t.y BETWEEN s.y0 AND s.y1 THEN 1e9 ELSE sqrt(greatest(0, s.x0 - t.x, t.x - s.x1) ** 2 + greatest(0, s.y0 - t.y, t.y - s.y1) ** 2) END) AS dist FROM fx_trees t JOIN fx_street s ON t.x BETWEEN s.x0 - 12 AND s.x1 + 12 AND t.y BETWEEN s.y0 - 12 AND s.y1 + 12) SELECT gid AS id, round(min(dist), 6) AS dist FROM f WHERE dist <= 12 GROUP BY gid")
def _(s, d):
    t = L(s, d, "fx_trees").select(F.col("gid").alias("id"), "x", "y")
    return sp.nearest(t, ed.rectangle_edges(L(s, d, "fx_street"), "osm_id"), 12.0, "id", 12.0).select("id", F.round("dist", 6).alias("dist"))


@query("j10_near_boundary", "SELECT osm_id FROM fx_street, fx_dom WHERE least(abs(x0), abs(b * 40 - x1), abs(y0), abs(b * 40 - y1)) < 30")
def _(s, d):
    return L(s, d, "fx_street").filter(sp.near_border(None, D(s, d), 30.0)).select("osm_id")


@query("j12_coverage_check", "WITH " + CL + " SELECT count(*) AS n FROM cl WHERE lid IS NULL")
def _(s, d):
    return class_cells(s, d).filter("lid is null").agg(F.count("*").alias("n"))


# class corrections


@query("c1_force_type", "WITH " + CL + ", " + BC + ", " + UC + " SELECT id, CASE WHEN type BETWEEN 900 AND 999 THEN 202 ELSE type END AS type FROM uc")
def _(s, d):
    return urban_cells(s, d).select("id", F.when(F.col("type").between(900, 999), 202).otherwise(F.col("type")).alias("type"))


@query("c2_single_layer_type", "WITH " + CL + " SELECT id, CASE WHEN type < 900 THEN 101 ELSE type END AS type FROM cl")
def _(s, d):
    return class_cells(s, d).select("id", F.when(F.col("type") < 900, 101).otherwise(F.col("type")).alias("type"))


@query("c3_impervious_fix", "WITH " + CL + " SELECT c.id, CASE WHEN c.type = 202 AND r.imperv <= 50 THEN 103 ELSE c.type END AS type FROM cl c LEFT JOIN fx_block_raster r ON r.px = floor(c.xcen / 40) AND r.py = floor(c.ycen / 40)")
def _(s, d):
    c = class_cells(s, d)
    v = rs.sample_value(c.select("id", F.col("xcen").alias("x"), F.col("ycen").alias("y")), L(s, d, "fx_block_raster").withColumnRenamed("imperv", "val"), 40.0)
    return c.join(v, "id").select("id", lc.impervious(F.col("type"), F.col("val")).alias("type"))


@query("c4_boundary_buildings_off", "SELECT osm_id, CASE WHEN least(abs(x0), abs(b * 40 - x1), abs(y0), abs(b * 40 - y1)) < 30 THEN 202 ELSE 906 END AS type FROM fx_street, fx_dom")
def _(s, d):
    return L(s, d, "fx_street").select("osm_id", F.when(sp.near_border(None, D(s, d), 30.0), 202).otherwise(906).alias("type"))


@query("c5_drop_small_buildings", "SELECT osm_id AS gid, CASE WHEN (x1 - x0) * (y1 - y0) < 200 THEN 202 ELSE 906 END AS type FROM fx_street")
def _(s, d):
    return ed.areas(ed.rectangle_edges(L(s, d, "fx_street"), "osm_id")).select("gid", F.when(F.col("area") < 200, 202).otherwise(906).alias("type"))


@query("c7_fill_courtyards", "WITH " + PAIRS + ", t AS (SELECT osm_id AS gid, CASE WHEN osm_id % 4 = 0 THEN 101 ELSE 900 + osm_id % 6 END AS type, (x1 - x0) * (y1 - y0) AS area FROM fx_street), b AS (SELECT a, b FROM pr UNION ALL SELECT b, a FROM pr), n AS (SELECT b.a, min(t.type) AS lo FROM b JOIN t ON t.gid = b.b GROUP BY b.a) SELECT t.gid, CAST(CASE WHEN t.type < 900 AND n.lo >= 900 AND t.area < 400 THEN n.lo ELSE t.type END AS INT) AS type FROM t LEFT JOIN n ON n.a = t.gid")
def _(s, d):
    t = L(s, d, "fx_street").select(F.col("osm_id").alias("gid"), F.when(F.col("osm_id") % 4 == 0, 101).otherwise(900 + F.col("osm_id") % 6).cast("int").alias("type"))
    return lc.fill_courtyards(t, l10(s, d), ed.areas(ed.rectangle_edges(L(s, d, "fx_street"), "osm_id")), 400.0)


# terrain and stencils


@query("p1_terrain_height", NEAREST + ", v AS (SELECT id, val FROM own UNION ALL SELECT id, val FROM far WHERE n = 1) SELECT p.id, coalesce(v.val, (SELECT min(val) FROM v)) AS height FROM p LEFT JOIN v USING (id)")
def _(s, d):
    v = r6(s, d)
    low = v.agg(F.min("val").alias("low"))
    return L(s, d, "fx_grid").select("id").join(v, "id", "left").crossJoin(low).select("id", F.coalesce("val", "low").alias("height"))  # one row


@query("p2_origin_z", NEAREST + ", v AS (SELECT id, val FROM own UNION ALL SELECT id, val FROM far WHERE n = 1), o AS (SELECT min(val) AS z FROM v) SELECT id, CAST(round_even((val - z) / 5, 0) AS INT) AS nz FROM v, o")
def _(s, d):
    v = r6(s, d)
    return v.crossJoin(v.agg(F.min("val").alias("z"))).select("id", gr.vertical_index(F.col("val"), F.col("z"), 5.0).alias("nz"))  # one row


@query("p3_fill_building_holes", "WITH " + N4 + ", l AS (SELECT *, id % 7 AS lid FROM fx_levels), m AS (SELECT b.i - o.di AS i, b.j - o.dj AS j, b.lid, count(*) AS k FROM l b, o4 o WHERE b.is_building GROUP BY 1, 2, 3), t AS (SELECT i, j, sum(k) AS k FROM m GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY i, j ORDER BY k, lid) AS n FROM m) SELECT l.i, l.j, CAST(r.lid AS INT) AS lid FROM l JOIN t USING (i, j) JOIN r ON r.i = l.i AND r.j = l.j AND r.n = 1, fx_dom d WHERE NOT l.is_building AND t.k + (l.i = 0)::INT + (l.i = d.nx - 1)::INT + (l.j = 0)::INT + (l.j = d.nx - 1)::INT > 2")
def _(s, d):
    dom = D(s, d)
    return st.fill_building_holes(L(s, d, "fx_levels").withColumn("lid", (F.col("id") % 7).cast("int")), dom.nx, dom.ny)


UP = "h AS (SELECT c.i, c.j, count(*) AS k, min(n.nz) AS lo FROM fx_levels c JOIN o4 o ON true JOIN fx_levels n ON n.i = c.i + o.di AND n.j = c.j + o.dj WHERE n.nz > c.nz GROUP BY 1, 2)"


@query("p4_fill_minima", "WITH " + N4 + ", " + UP + " SELECT c.i, c.j, CASE WHEN h.k > 2 THEN h.lo ELSE c.nz END AS nz FROM fx_levels c LEFT JOIN h USING (i, j)")
def _(s, d):
    return st.fill_minima(L(s, d, "fx_levels")).select("i", "j", "nz")


@query("p4_fill_minima_all")
def _(s, d):
    return st.fill_minima_all(L(s, d, "fx_levels").select("id", "i", "j", "nz"))


@query("p5_fill_corners", "WITH " + N4 + ", " + UP + " SELECT c.i, c.j, CASE WHEN coalesce(h.k, 0) + (c.i = 0)::INT + (c.i = d.nx - 1)::INT + (c.j = 0)::INT + (c.j = d.nx - 1)::INT > 2 THEN h.lo ELSE c.nz END AS nz FROM fx_levels c LEFT JOIN h USING (i, j), fx_dom d")
def _(s, d):
    dom = D(s, d)
    return st.fill_corners(L(s, d, "fx_levels"), dom.nx, dom.ny).select("i", "j", "nz")


REG = "e AS (SELECT a.id AS a, b.id AS b FROM fx_levels a JOIN o4 o ON true JOIN fx_levels b ON b.i = a.i + o.di AND b.j = a.j + o.dj WHERE a.nz = b.nz), r AS (SELECT id AS node, id AS root FROM fx_levels UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node WHERE r.root < e.b), rg AS (SELECT node AS id, min(root) AS root FROM r GROUP BY node)"


@query("p6_connected_components", "WITH RECURSIVE_PLACE " + N4 + ", " + REG + " SELECT CAST(c.id AS BIGINT) AS id, c.nz, CAST(rg.root AS BIGINT) AS root FROM fx_levels c JOIN rg USING (id)")
def _(s, d):
    return st.level_regions(L(s, d, "fx_levels")).select("id", "nz", "root")


@query("p7_fill_small_basins", "WITH RECURSIVE_PLACE " + N4 + ", " + REG + ", nm AS (SELECT c.*, rg.root FROM fx_levels c JOIN rg USING (id)), rim AS (SELECT a.root, min(b.nz) AS rim FROM nm a JOIN o4 o ON true JOIN nm b ON b.i = a.i + o.di AND b.j = a.j + o.dj WHERE a.root <> b.root GROUP BY 1), sm AS (SELECT n.root, rim.rim FROM (SELECT root, count(*) AS k, min(nz) AS z FROM nm GROUP BY 1) n JOIN rim USING (root) WHERE n.k < 10 AND n.z < rim.rim) SELECT nm.id, nm.i, nm.j, coalesce(sm.rim, nm.nz) AS nz FROM nm LEFT JOIN sm USING (root)")
def _(s, d):
    return st.fill_small_basins(L(s, d, "fx_levels").select("id", "i", "j", "nz"))


@query("p7_fill_small_basins_all")
def _(s, d):
    return st.fill_small_basins_all(L(s, d, "fx_levels").select("id", "i", "j", "nz"))


def _border_sql(depth: int) -> str:
    out, last = [], "fx_levels"
    for r in reversed(range(depth)):
        for n, (cond, di, dj) in enumerate(((f"c.i = {r}", 1, 0), (f"c.i = d.nx - 1 - {r}", -1, 0), (f"c.j = {r}", 0, 1), (f"c.j = d.nx - 1 - {r}", 0, -1))):
            name = f"b{r}{n}"
            out.append(f"{name} AS (SELECT c.i, c.j, CASE WHEN {cond} THEN greatest(c.nz, n.nz) ELSE c.nz END AS nz FROM {last} c CROSS JOIN fx_dom d LEFT JOIN {last} n ON n.i = c.i + {di} AND n.j = c.j + {dj})")
            last = name
    return "WITH " + ", ".join(out) + f" SELECT i, j, nz FROM {last}"


@query("p9_boundary_fill_1", _border_sql(1))
def _(s, d):
    dom = D(s, d)
    return st.border_fill(L(s, d, "fx_levels").select("i", "j", "nz"), dom.nx, dom.ny)


@query("p10_boundary_fill_2", _border_sql(2))
def _(s, d):
    dom = D(s, d)
    return st.border_fill(L(s, d, "fx_levels").select("i", "j", "nz"), dom.nx, dom.ny, 2)


@query("p11_cyclic_boundary", "SELECT g.i, g.j, n.nz FROM fx_levels g CROSS JOIN fx_dom d JOIN fx_levels n ON n.i = CASE WHEN g.i < 3 OR g.i >= d.nx - 4 THEN 3 ELSE g.i END AND n.j = CASE WHEN g.j < 3 OR g.j >= d.nx - 4 THEN 3 ELSE g.j END")
def _(s, d):
    dom = D(s, d)
    return st.cyclic(L(s, d, "fx_levels").select("i", "j", "nz"), dom.nx, dom.ny, 3).select("i", "j", "nz")


TOP = ", tp AS (SELECT id, i, j, xcen, ycen, lid, CAST(round_even(coalesce(height, 10) / 5, 0) AS INT) AS top FROM bc)"


def tops(s, d) -> DataFrame:
    return building_cells(s, d).withColumn("top", gr.vertical_index(F.coalesce("height", F.lit(10.0)), 0.0, 5.0))


@query("p12_combined_surface", "WITH " + BC + TOP + " SELECT l.id, l.nz + coalesce(tp.top, 0) AS nz, tp.id IS NOT NULL AS building FROM fx_levels l LEFT JOIN tp USING (id)")
def _(s, d):
    t = tops(s, d).select("id", "top")
    return L(s, d, "fx_levels").join(t, "id", "left").select("id", (F.col("nz") + F.coalesce("top", F.lit(0))).alias("nz"), F.col("top").isNotNull().alias("building"))


@query("p13_sync_back", "WITH " + BC + TOP + " SELECT l.id, CASE WHEN tp.id IS NULL THEN l.nz + 1 ELSE l.nz END AS terrain, CASE WHEN tp.id IS NOT NULL THEN tp.top + 1 END AS building FROM fx_levels l LEFT JOIN tp USING (id)")
def _(s, d):
    t = tops(s, d).select("id", "top")
    c = L(s, d, "fx_levels").join(t, "id", "left").withColumn("surface", F.col("nz") + F.coalesce("top", F.lit(0)) + 1)
    return c.select("id", F.when(F.col("top").isNull(), F.col("surface")).otherwise(F.col("nz")).alias("terrain"), F.when(F.col("top").isNotNull(), F.col("surface") - F.col("nz")).alias("building"))


# buildings and surfaces


@query("b2_building_height", "WITH " + BC + " SELECT id, lid, height FROM bc")
def _(s, d):
    return building_cells(s, d).select("id", "lid", "height")


@query("b3_fill_from_neighbours")
def _(s, d):
    return bl.fill_heights(building_cells(s, d), 4).select("id", "lid", "height")


@query("b4_default_height", "WITH " + BC + " SELECT id, coalesce(height, CASE lid % 3 WHEN 0 THEN 6 WHEN 1 THEN 9 ELSE 12 END) AS height FROM bc")
def _(s, d):
    k = F.col("lid") % 3
    return building_cells(s, d).select("id", F.coalesce("height", F.when(k == 0, 6.0).when(k == 1, 9.0).otherwise(12.0)).alias("height"))


@query("b6_offsets", "WITH " + BC + " SELECT bc.lid, min(l.nz) AS low, max(l.nz) AS high, count(*) AS n FROM bc JOIN fx_levels l USING (id) GROUP BY bc.lid")
def _(s, d):
    c = building_cells(s, d).select("id", "lid").join(L(s, d, "fx_levels").select("id", "nz"), "id")
    return c.groupBy("lid").agg(F.min("nz").alias("low"), F.max("nz").alias("high"), F.count("*").alias("n"))


@query("b7_raise_and_flatten", "WITH " + BC + TOP + ", f AS (SELECT tp.lid, min(l.nz) AS low, max(l.nz) AS high FROM tp JOIN fx_levels l USING (id) GROUP BY 1) SELECT tp.id, f.low AS terrain, tp.top + f.high - f.low AS top FROM tp JOIN f USING (lid)")
def _(s, d):
    t = tops(s, d)
    f = t.select("id", "lid").join(L(s, d, "fx_levels").select("id", "nz"), "id").groupBy("lid").agg(F.min("nz").alias("low"), F.max("nz").alias("high"))
    return t.join(f, "lid").select("id", F.col("low").alias("terrain"), (F.col("top") + F.col("high") - F.col("low")).alias("top"))


@query("b8_overhangs", "SELECT g.id, min(x.gid) AS gid FROM fx_grid g JOIN fx_extras x ON g.xcen >= x.x0 AND g.xcen < x.x1 AND g.ycen >= x.y0 AND g.ycen < x.y1 WHERE x.class3d = 'overhang' GROUP BY g.id")
def _(s, d):
    e = ed.rectangle_edges(L(s, d, "fx_extras").filter("class3d = 'overhang'"), "gid")
    return sp.points_in_polygons(L(s, d, "fx_grid").select("id", F.col("xcen").alias("x"), F.col("ycen").alias("y")), e, D(s, d))


@query("b10_building_voxels", "WITH " + BC + TOP + " SELECT i, j, CAST(unnest(range(0, top + 1)) AS INT) AS k FROM tp")
def _(s, d):
    return bl.voxels(tops(s, d).withColumn("bottom", F.lit(0)))


WALLS = ", sd AS (SELECT * FROM (VALUES (1, 0.0::DOUBLE, 0, 1), (2, 90.0::DOUBLE, 1, 0), (3, 180.0::DOUBLE, 0, -1), (4, 270.0::DOUBLE, -1, 0)) t(direction, azimuth, di, dj)), wl AS (SELECT tp.id, sd.direction, sd.azimuth, tp.top, tp.xcen + sd.di * 5.0::DOUBLE AS xs, tp.ycen + sd.dj * 5.0::DOUBLE AS ys FROM tp CROSS JOIN sd WHERE NOT EXISTS (SELECT 1 FROM tp n WHERE n.i = tp.i + sd.di AND n.j = tp.j + sd.dj))"


@query("w2_outer_walls", "WITH " + BC + TOP + WALLS + " SELECT id, direction, azimuth, xs, ys FROM wl")
def w2(s, d):
    return bl.outer_walls(tops(s, d), 10.0, 10.0).select("id", "direction", "azimuth", "xs", "ys")


@query("w3_horizontal_surfaces", "WITH " + BC + TOP + " SELECT CAST(row_number() OVER (ORDER BY id) AS INT) AS sid, id, CAST(top * 5.0 AS DOUBLE) AS zs FROM tp")
def _(s, d):
    return nb.number_rows(tops(s, d).select("id", (F.col("top") * 5.0).alias("zs")), ["id"], "sid").select("sid", "id", "zs")


@query("w4_vertical_surfaces", "WITH " + BC + TOP + WALLS + ", f AS (SELECT id, direction, unnest(range(0, top)) AS level FROM wl) SELECT CAST(row_number() OVER (ORDER BY id, direction, level) AS INT) AS sid, id, direction, CAST(5 * (level + 0.5) AS DOUBLE) AS zs FROM f")
def _(s, d):
    return bl.vertical_surfaces(bl.outer_walls(tops(s, d), 10.0, 10.0), 5.0).select("sid", "id", "direction", "zs")


@query("w7_wall_lines", "SELECT CAST(wid AS INT) AS wid, xa, ya, xb, yb FROM fx_walls")
def _(s, d):
    return ed.rectangle_edges(L(s, d, "fx_street"), "osm_id").select((F.col("gid") * 4 + F.col("edge")).alias("wid"), "xa", "ya", "xb", "yb")


# trees


@query("t1_canopy_levels", "SELECT CAST(ceil(max(treeh) / 5) + 1 AS INT) AS nz FROM fx_trees")
def _(s, d):
    return cp.canopy_levels(L(s, d, "fx_trees"), 5.0)


@query("t2_tree_layers", "WITH l AS (SELECT *, unnest(range(CAST(floor(trunkh / 5) AS INT), CAST(ceil(treeh / 5) AS INT) + 1)) AS l FROM fx_trees), h AS (SELECT *, unnest(range(10)) AS s FROM l), v AS (SELECT gid, l, crownshp, crownr, trunkh, treeh, (l + (s + 0.5::DOUBLE) / 10) * 5 AS z FROM h), r AS (SELECT gid, l, CASE WHEN z < trunkh OR z > treeh THEN 0 WHEN crownshp = 4 THEN crownr * (treeh - z) / (treeh - trunkh) ELSE crownr * sqrt(greatest(0, 1 - ((z - trunkh - (treeh - trunkh) / 2) / ((treeh - trunkh) / 2)) ** 2)) END AS r FROM v) SELECT gid, CAST(l AS INT) AS l, round(avg(r), 6) AS r FROM r GROUP BY 1, 2 HAVING avg(r) > 0")
def _(s, d):
    return cp.tree_layers(L(s, d, "fx_trees"), 5.0).withColumn("r", F.round("r", 6))


@query("t3_tree_density")
def _(s, d):
    t = L(s, d, "fx_trees")
    return cp.tree_density(t, cp.tree_layers(t, 5.0), tops(s, d).select("i", "j", F.col("top").alias("nz")), D(s, d))


@query("t5_lad_from_lai", "WITH c AS (SELECT px AS i, py AS j, lai, canopy, unnest(range(1, CAST(ceil(canopy / 5) AS INT) + 1)) AS k FROM fx_block_raster WHERE canopy > 0 AND lai > 0) SELECT i, j, CAST(k AS INT) AS k, round(least(1.6, lai / canopy) * greatest(0, least(1, canopy / 5 - (k - 1))), 9) AS lad FROM c")
def _(s, d):
    c = L(s, d, "fx_block_raster").select(F.col("px").alias("i"), F.col("py").alias("j"), "lai", "canopy")
    return cp.lad_from_lai(c, 5.0).select("i", "j", "k", F.round("lad", 9).alias("lad"))


# street canyons

PIECES = "pc AS (SELECT sid, unnest(range(CAST(ceil((xb - xa) / 15) AS INT))) AS part, ya AS cy, xb - xa AS len, ceil((xb - xa) / 15) AS n FROM fx_lines WHERE xb - xa > 40), mid AS (SELECT sid, CAST(part AS INT) AS part, len * (part + 0.5::DOUBLE) / n AS cx, cy FROM pc)"


@query("u4_chop", "WITH " + PIECES + " SELECT sid, CAST(part AS INT) AS part, round(len * part / n, 6) AS sx, round(len * (part + 1) / n, 6) AS ex FROM pc")
def _(s, d):
    return cy.chop(L(s, d, "fx_lines"), 15.0).select("sid", "part", F.round("sx", 6).alias("sx"), F.round("ex", 6).alias("ex"))


@query("u5_transects", "WITH " + PIECES + " SELECT sid, part, side, round(cx, 6) AS tx, cy + side * 50 AS ty FROM mid, (VALUES (1), (-1)) t(side)")
def _(s, d):
    t = cy.transects(cy.chop(L(s, d, "fx_lines"), 15.0), 50.0)
    return t.select("sid", "part", "side", F.round("tx", 6).alias("tx"), F.round("ty", 6).alias("ty"))


HITS = ", h AS (SELECT m.sid, m.part, side, min(CASE WHEN side = 1 THEN CASE WHEN s.y0 >= m.cy THEN s.y0 - m.cy ELSE s.y1 - m.cy END ELSE CASE WHEN s.y1 <= m.cy THEN m.cy - s.y1 ELSE m.cy - s.y0 END END / 50) AS t FROM mid m CROSS JOIN (VALUES (1), (-1)) v(side) JOIN fx_street s ON m.cx BETWEEN s.x0 AND s.x1 AND ((side = 1 AND s.y1 >= m.cy AND (s.y0 >= m.cy OR s.y1 <= m.cy + 50) AND s.y0 <= m.cy + 50) OR (side = -1 AND s.y0 <= m.cy AND (s.y1 <= m.cy OR s.y0 >= m.cy - 50) AND s.y1 >= m.cy - 50)) GROUP BY 1, 2, 3)"


def rays(s, d) -> DataFrame:
    return cy.transects(cy.chop(L(s, d, "fx_lines"), 15.0), 50.0)


@query("u6_first_hit", "WITH " + PIECES + HITS + " SELECT sid, part, side, round(t, 6) AS t FROM h")
def _(s, d):
    return cy.first_hit(rays(s, d), ed.rectangle_edges(L(s, d, "fx_street"), "osm_id")).select("sid", "part", "side", F.round("t", 6).alias("t"))


@query("u7_canyon", "WITH " + PIECES + HITS + " SELECT sid, part, round(sum(t) * 50, 6) AS width FROM h GROUP BY 1, 2 HAVING count(*) = 2")
def _(s, d):
    r = rays(s, d)
    return cy.canyons(cy.first_hit(r, ed.rectangle_edges(L(s, d, "fx_street"), "osm_id")), r, 50.0).select("sid", "part", F.round("width", 6).alias("width"))


@query("u9_building_area", "SELECT s.osm_id, round(2 * ((s.x1 - s.x0) + (s.y1 - s.y0)) * 9 + (s.x1 - s.x0) * (s.y1 - s.y0), 6) AS area FROM fx_street s")
def _(s, d):
    e = ed.rectangle_edges(L(s, d, "fx_street"), "osm_id")
    wall = e.groupBy("gid").agg(F.sum(F.sqrt(F.pow(F.col("xb") - F.col("xa"), 2.0) + F.pow(F.col("yb") - F.col("ya"), 2.0)) * 9).alias("wall"))
    return wall.join(ed.areas(e), "gid").select(F.col("gid").alias("osm_id"), F.round(F.col("wall") + F.col("area"), 6).alias("area"))


@query("u10_plan_fraction", "WITH " + CV + " SELECT i, j, round(least(0.988, sum(area) / 100), 6) AS plan FROM cv WHERE area > 1e-9 GROUP BY 1, 2 HAVING sum(area) / 100 >= 0.05")
def _(s, d):
    c = sp.coverage(ed.rectangle_edges(L(s, d, "fx_street"), "osm_id"), D(s, d)).groupBy("i", "j").agg(F.round(F.sum("area"), 9).alias("a"))
    return c.filter("a / 100 >= 0.05").select("i", "j", F.round(F.least(F.lit(0.988), F.col("a") / 100), 6).alias("plan"))


@query("u12_canyon_stats", "WITH w AS (SELECT CAST(floor(xa / 10) AS INT) AS i, CAST(floor(ya / 10) AS INT) AS j, xb - xa + yb - ya AS width, (wid * 37 % 360)::DOUBLE AS orientation FROM fx_walls), a AS (SELECT i, j, avg(width) AS width, avg(sin(radians(orientation))) AS s, avg(cos(radians(orientation))) AS c FROM w GROUP BY 1, 2) SELECT i, j, round(width, 6) AS width, round((degrees(atan2(s, c)) + 360) % 360, 4) AS orientation FROM a WHERE s * s + c * c > 1e-6")
def _(s, d):
    w = L(s, d, "fx_walls").select(F.floor(F.col("xa") / 10).cast("int").alias("i"), F.floor(F.col("ya") / 10).cast("int").alias("j"), (F.col("xb") - F.col("xa") + F.col("yb") - F.col("ya")).alias("width"), (F.col("wid") * 37 % 360).cast("double").alias("orientation"))
    ok = w.groupBy("i", "j").agg(F.avg(F.sin(F.radians("orientation"))).alias("s"), F.avg(F.cos(F.radians("orientation"))).alias("c")).filter("s * s + c * c > 1e-6").select("i", "j")
    return cy.canyon_stats(w).join(ok, ["i", "j"]).select("i", "j", F.round("width", 6).alias("width"), F.round("orientation", 4).alias("orientation"))


# variables and checks

CUBE_CELLS = CL + ", " + BC + ", " + UC + ", cc AS (SELECT c.i, c.j, c.lid, c.type, l.nz, m.albedo, m.emissivity, m.roughness, m.capacity_surf FROM uc c JOIN fx_levels l USING (id) LEFT JOIN fx_material m ON m.code = c.catland)"
_RANGE = {"vegetation": "type >= 100 AND type < 200", "pavement": "type >= 200 AND type < 300", "water": "type >= 300 AND type < 400", "building": "type >= 900 AND type < 1000", None: "true"}
CUBE = CUBE_CELLS + ", cube AS (" + " UNION ALL ".join(f"SELECT '{n}' AS var, j, i, CAST({f} AS DOUBLE) AS value FROM cc WHERE {_RANGE[k]} AND ({f}) IS NOT NULL" for n, k, f in pr.SPEC) + ")"


def cube(s, d) -> DataFrame:
    m = F.broadcast(L(s, d, "fx_material").select(F.col("code").alias("catland"), "albedo", "emissivity", "roughness", "capacity_surf"))  # at most two rows a nation
    cells = urban_cells(s, d).join(L(s, d, "fx_levels").select("id", "nz"), "id").join(m, "catland", "left")
    return pr.variables(cells, pr.SPEC)


@query("v_parameter_variables", "WITH " + CUBE + " SELECT var, j, i, value FROM cube")
def _(s, d):
    return cube(s, d)


@query("v15_mask_buildings", "WITH " + CL + ", " + BC + " SELECT cl.id, CASE WHEN bc.id IS NOT NULL THEN 101 ELSE cl.type END AS type FROM cl LEFT JOIN bc USING (id)")
def _(s, d):
    b = building_cells(s, d).select("id", F.lit(True).alias("b"))
    return class_cells(s, d).join(b, "id", "left").select("id", F.when(F.col("b"), 101).otherwise(F.col("type")).alias("type"))


@query("q_a_repair_untyped", "WITH " + CL + " SELECT id, coalesce(type, 202) AS type FROM cl")
def _(s, d):
    return pr.repair_untyped(class_cells(s, d)).select("id", "type")


BOUNDS = [("zt", 0.0, 20.0), ("vegetation_type", 1.0, 18.0), ("albedo", 0.0, 1.0), ("emissivity", 0.0, 0.8)]


@query("q_b_bounds_report", "WITH " + CUBE + ", b AS (SELECT * FROM (VALUES " + ", ".join(map(str, BOUNDS)) + ") t(var, least, most)) SELECT var, min(value) AS lo, max(value) AS hi, min(value) >= min(least) AND max(value) <= min(most) AS ok FROM cube JOIN b USING (var) GROUP BY var")
def _(s, d):
    return pr.bounds_report(cube(s, d), s.createDataFrame(BOUNDS, "var string, least double, most double"))


@query("q_c_nan_report", "WITH " + CUBE + " SELECT var, count(*) FILTER (WHERE (i + j) % 13 = 0) AS n FROM cube GROUP BY var")
def _(s, d):
    broken = cube(s, d).withColumn("value", F.when((F.col("i") + F.col("j")) % 13 == 0, F.lit(float("nan"))).otherwise(F.col("value")))
    return broken.groupBy("var").agg(F.count_if(F.isnan("value")).alias("n"))


_EVERY = ["x", "y", "lat", "lon", "E_UTM", "N_UTM"]


@query("q_d_required_variables", "WITH " + CUBE + ", r AS (SELECT * FROM (VALUES " + ", ".join(f"('{v}')" for v in pr.REQUIRED + pr.REQUIRED_BUILDINGS) + ") t(var)), n AS (SELECT var, count(*) AS n FROM cube WHERE var NOT IN ('building_id', 'building_type') GROUP BY var UNION ALL SELECT unnest(" + str(_EVERY) + "), count(*) FROM fx_grid UNION ALL SELECT 'crs', 1 UNION ALL SELECT unnest(['building_id', 'buildings_2d']), count(*) FROM bc) SELECT r.var, coalesce(n.n, 0) AS n, coalesce(n.n, 0) > 0 AS ok FROM r LEFT JOIN n USING (var)")
def _(s, d):
    known = cube(s, d).filter("var not in ('building_id', 'building_type')")
    whole = known.unionByName(cb.coordinate_variables(L(s, d, "fx_grid"), placed(s, d), 33)).unionByName(cb.building_variables(urban_cells(s, d), tops(s, d), 5.0))
    return pr.required_variables(whole, buildings=True)


@query("q_e_compare_cubes", "WITH " + CUBE + " SELECT var, CAST(count(*) FILTER (WHERE i % 10 = 3) AS BIGINT) AS only_a, CAST(0 AS BIGINT) AS only_b, count(*) FILTER (WHERE i % 10 <> 3 AND j % 7 = 0) AS differing FROM cube GROUP BY var")
def _(s, d):
    c = cube(s, d)
    other = c.filter("i % 10 <> 3").withColumn("value", F.when(F.col("j") % 7 == 0, F.col("value") + 1).otherwise(F.col("value")))
    return pr.compare_cubes(c, other, 1e-6)


# cut cells


@query("k1_corner_lattice", "SELECT a.p_partkey::INT AS i, c.p_partkey::INT AS j, (a.p_partkey * 10)::DOUBLE AS x, (c.p_partkey * 10)::DOUBLE AS y FROM part a CROSS JOIN part c CROSS JOIN fx_dom d WHERE a.p_partkey <= d.nx AND c.p_partkey <= d.nx")
def _(s, d):
    return cc.corner_lattice(s, D(s, d))


@query("k2_smooth_corners", "WITH o AS (SELECT a.range - 1 AS a, b.range - 1 AS b FROM range(3) a, range(3) b) SELECT c.i, c.j, round(avg(n.nz), 6) AS nz FROM fx_levels c CROSS JOIN o JOIN fx_levels n ON n.i = c.i + o.a AND n.j = c.j + o.b GROUP BY 1, 2")
def _(s, d):
    return st.smooth(L(s, d, "fx_levels"), "nz").withColumn("nz", F.round("nz", 6))


@query("k4_saddle_filter", """WITH q AS (SELECT a.i, a.j, a.nz AS a, b.nz AS b, c.nz AS c, e.nz AS d FROM fx_levels a JOIN fx_levels b ON b.i = a.i + 1 AND b.j = a.j JOIN fx_levels c ON c.i = a.i AND c.j = a.j + 1 JOIN fx_levels e ON e.i = a.i + 1 AND e.j = a.j + 1),
u AS (SELECT i, j, least(b, c) AS z FROM q WHERE greatest(a, d) < least(b, c) UNION ALL SELECT i + 1, j + 1, least(b, c) FROM q WHERE greatest(a, d) < least(b, c) UNION ALL SELECT i + 1, j, least(a, d) FROM q WHERE greatest(b, c) < least(a, d) UNION ALL SELECT i, j + 1, least(a, d) FROM q WHERE greatest(b, c) < least(a, d)),
m AS (SELECT i, j, max(z) AS z FROM u GROUP BY 1, 2) SELECT l.i, l.j, coalesce(m.z, l.nz) AS nz FROM fx_levels l LEFT JOIN m USING (i, j)""")
def _(s, d):
    return st.saddles(L(s, d, "fx_levels"))


def quads(s, d) -> DataFrame:
    p = lambda x, y, z: F.struct(F.col(x).alias("x"), F.col(y).alias("y"), F.col(z).alias("z"))
    return L(s, d, "fx_faces").select("fid", F.array(p("x0", "y0", "z00"), p("x1", "y0", "z10"), p("x1", "y1", "z11"), p("x0", "y1", "z01")).alias("verts"))


@query("k19_face_normal_area", "WITH n AS (SELECT fid, -((y1 - y0) * (z10 + z11 - z00 - z01)) / 2 AS a, -((x1 - x0) * (z01 + z11 - z00 - z10)) / 2 AS b, (x1 - x0) * (y1 - y0) AS c FROM fx_faces) SELECT fid, round(a / sqrt(a * a + b * b + c * c), 6) + 0 AS nx, round(b / sqrt(a * a + b * b + c * c), 6) + 0 AS ny, round(c / sqrt(a * a + b * b + c * c), 6) AS nz, round(sqrt(a * a + b * b + c * c), 6) AS area FROM n")
def _(s, d):
    n = cc.normals(quads(s, d))
    return n.select("fid", *[(F.round(c, 6) + 0.0).alias(c) for c in ("nx", "ny", "nz", "area")])


@query("k22_vertex_index", "WITH v AS (SELECT fid, unnest([0, 1, 2, 3]) AS at, unnest([x0, x1, x1, x0]) AS x, unnest([y0, y0, y1, y1]) AS y, unnest([z00, z10, z11, z01]) AS z FROM fx_faces), u AS (SELECT x, y, z, row_number() OVER (ORDER BY x, y, z) AS vid FROM (SELECT DISTINCT x, y, z FROM v)) SELECT v.fid, CAST(v.at AS INT) AS at, CAST(u.vid AS INT) AS vid FROM v JOIN u USING (x, y, z)")
def _(s, d):
    return cc.vertex_index(quads(s, d))


for _name in ("p6_connected_components", "p7_fill_small_basins"):
    SQL[_name] = "WITH RECURSIVE " + SQL[_name].removeprefix("WITH ").replace("RECURSIVE_PLACE ", "")
