"""Registered queries of layers read from files, of the equal-area projection and of roofs, added to those of grid_queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cellweave.operators import buildings as bd
from cellweave.operators import edges as ed
from cellweave.operators import grid as gr
from cellweave.operators import spatial as sp
from cellweave.plans.grid_queries import BC, D, L, building_cells, query
from cellweave.session import shared_dir
from cellweave.sources import features as ft

E2, E = gr.GRS80 * (2 - gr.GRS80), (gr.GRS80 * (2 - gr.GRS80)) ** 0.5


def _term(s: str) -> str:
    return f"(1 - {E2!r}) * (({s}) / (1 - {E2!r} * ({s}) ** 2) - ln((1 - {E!r} * ({s})) / (1 + {E!r} * ({s}))) / (2 * {E!r}))"


#: The projection as its published text has it, with logarithms.
LAEA = f"""c AS (SELECT {_term('1.0::DOUBLE')} AS qp, {_term('sin(radians(52.0::DOUBLE))')} AS q0, sin(radians(52.0::DOUBLE)) AS s0, cos(radians(52.0::DOUBLE)) AS c0),
k AS (SELECT qp, asin(q0 / qp) AS b0, 6378137 * sqrt(qp / 2) AS rq, 6378137 * c0 / sqrt(1 - {E2!r} * s0 ** 2) / (6378137 * sqrt(qp / 2) * cos(asin(q0 / qp))) AS d FROM c),
p AS (SELECT id, radians(10 + xcen / 400 - 10) AS l, sin(radians(40 + ycen / 300)) AS s FROM fx_grid),
b AS (SELECT id, l, asin(({_term('s')}) / qp) AS b, b0, rq, d FROM p, k),
f AS (SELECT *, rq * sqrt(2 / (1 + sin(b0) * sin(b) + cos(b0) * cos(b) * cos(l))) AS g FROM b)"""


@query("g4_reproject_laea", f"WITH {LAEA} SELECT id, round(4321000 + g * d * cos(b) * sin(l), 3) AS e, round(3210000 + g / d * (cos(b0) * sin(b) - sin(b0) * cos(b) * cos(l)), 3) AS n FROM f")
def _(s, d):
    e, n = gr.lonlat_to_laea(10 + F.col("xcen") / 400, 40 + F.col("ycen") / 300)
    return L(s, d, "fx_grid").select("id", F.round(e, 3).alias("e"), F.round(n, 3).alias("n"))


@query("g4_laea_round_trip", "SELECT id, round(10 + xcen / 400, 7) AS lon, round(40 + ycen / 300, 7) AS lat FROM fx_grid")
def _(s, d):
    g = L(s, d, "fx_grid").withColumn("en", F.struct(*[c.alias(a) for c, a in zip(gr.lonlat_to_laea(10 + F.col("xcen") / 400, 40 + F.col("ycen") / 300), "en")]))
    lon, lat = gr.laea_to_lonlat(F.col("en.e"), F.col("en.n"))
    return g.select("id", F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"))


@query("s1_read_features", "SELECT osm_id, CAST(2 AS INT) AS n_rings, CAST(8 AS BIGINT) AS n_edges, (x1 - x0) * (y1 - y0) * 0.75::DOUBLE AS area FROM fx_street")
def _(s, d):
    """Footprints with a courtyard of half their size, written as GeoJSON in either direction and read back."""
    x, y = lambda t: F.col("x0") + (F.col("x1") - F.col("x0")) * t, lambda t: F.col("y0") + (F.col("y1") - F.col("y0")) * t
    ring = lambda a, b: F.array(*[F.array(x(u), y(v)) for u, v in ((a, a), (b, a), (b, b), (a, b), (a, a))])
    turned = lambda r: F.when(F.col("osm_id") % 2 == 0, r).otherwise(F.reverse(r))
    shape = F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(turned(ring(0.0, 1.0)), turned(ring(0.25, 0.75))).alias("coordinates")))
    path = f"{shared_dir(s)}/layer-{uuid.uuid4().hex}"
    L(s, d, "fx_street").select("osm_id", shape.alias("geom")).write.json(path)
    layer = ft.read_features(s, path, "json", encoding="geojson", schema="osm_id int, geom string")
    edges = ed.explode_rings(layer, "osm_id")
    size = edges.groupBy("gid").agg(F.count_distinct("ring").cast("int").alias("n_rings"), F.count("*").alias("n_edges"), F.round(F.sum(F.col("xa") * F.col("yb") - F.col("xb") * F.col("ya")) / 2, 6).alias("area"))
    return size.select(F.col("gid").alias("osm_id"), "n_rings", "n_edges", "area")


#: Roofs that are smaller than their buildings, and missing on each fifth.
ROOFS = "rf AS (SELECT rid, x0, y0, x1 - 6 AS x1, y1 - 4 AS y1 FROM fx_roofs WHERE rid % 5 <> 0)"


def _near(name: str, source: str, reach: int) -> str:
    best = f"SELECT a.id, min(ROW(greatest(abs(a.i - b.i), abs(a.j - b.j)), (a.i - b.i) ** 2 + (a.j - b.j) ** 2, b.rid)) AS n FROM {source} a JOIN {source} b ON b.rid IS NOT NULL AND a.rid IS NULL AND b.i BETWEEN a.i - {reach} AND a.i + {reach} AND b.j BETWEEN a.j - {reach} AND a.j + {reach} GROUP BY a.id"
    return f"{name} AS (SELECT s.id, s.i, s.j, coalesce(s.rid, q.n[3]) AS rid FROM {source} s LEFT JOIN ({best}) q USING (id))"


@query("w1_roof_of_cell", f"WITH {BC}, {ROOFS}, r0 AS (SELECT bc.id, bc.i, bc.j, min(rf.rid) AS rid FROM bc LEFT JOIN rf ON xcen >= x0 AND xcen < x1 AND ycen >= y0 AND ycen < y1 GROUP BY bc.id, bc.i, bc.j), {_near('r1', 'r0', 1)}, {_near('r2', 'r1', 2)}, {_near('r3', 'r2', 49)} SELECT id, i, j, rid FROM r3")
def _(s, d):
    cells = building_cells(s, d)
    roofs = L(s, d, "fx_roofs").filter("rid % 5 <> 0").select("rid", "x0", "y0", (F.col("x1") - 6).alias("x1"), (F.col("y1") - 4).alias("y1"))
    hits = sp.points_in_polygons(cells.select("id", F.col("xcen").alias("x"), F.col("ycen").alias("y")), ed.rectangle_edges(roofs.filter("x0 < x1 and y0 < y1"), "rid"), D(s, d))
    return bd.roof_of_cell(cells, hits.withColumnRenamed("gid", "rid")).select("id", "i", "j", "rid")
