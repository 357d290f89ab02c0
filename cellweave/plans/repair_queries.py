"""Registered queries of class repairs, outlines and wall points, added to those of grid_queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.operators import canyon as cy
from cellweave.operators import cutcell as cc
from cellweave.operators import edges as ed
from cellweave.operators import landcover as lc
from cellweave.operators import spatial as sp
from cellweave.plans import grid_queries as gq
from cellweave.plans.grid_queries import BC, CL, CV, D, L, query

#: Land cover in which most polygons are buildings: blocks with courtyards.
BLOCKS = "t AS (SELECT lid, x0, y0, x1, y1, CAST(CASE WHEN CAST(lid AS BIGINT) * lid % 17 = 4 OR lid % 23 = 5 THEN type ELSE 900 + lid % 7 END AS INT) AS type FROM lc)"


def blocks(s, d) -> DataFrame:
    open_ = (F.col("lid").cast("long") * F.col("lid") % 17 == 4) | (F.col("lid") % 23 == 5)
    return gq.typed(s, d).select(F.col("lid").alias("gid"), "x0", "y0", "x1", "y1", F.when(open_, F.col("type")).otherwise(900 + F.col("lid") % 7).cast("int").alias("type"))


@query("j7_reassign_low_cover", f"""WITH {CV}, {CL}, {BC},
low AS (SELECT bc.id, bc.lid, bc.xcen, bc.ycen FROM bc JOIN cv ON cv.i = bc.i AND cv.j = bc.j GROUP BY bc.id, bc.lid, bc.xcen, bc.ycen HAVING sum(cv.area) / 100 < 0.6),
f AS (SELECT low.id, low.lid AS old, l.lid, greatest(0, l.x0 - xcen, xcen - l.x1) ** 2 + greatest(0, l.y0 - ycen, ycen - l.y1) ** 2 AS d2 FROM low JOIN lc l ON l.x0 <= xcen + 2000 AND l.x1 >= xcen - 2000),
n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d2, lid) AS n FROM f)
SELECT id, old, lid FROM n WHERE n = 1""")
def _(s, d):
    dom = D(s, d)
    cover = sp.coverage(ed.rectangle_edges(L(s, d, "fx_street"), "osm_id"), dom).groupBy("i", "j").agg(F.sum("area").alias("area"))
    low = gq.building_cells(s, d).join(cover, ["i", "j"]).filter(F.col("area") / (dom.dx * dom.dy) < 0.6)
    low = low.select("id", F.col("lid").alias("old"), F.col("xcen").alias("x"), F.col("ycen").alias("y"))
    new = sp.nearest_polygon(low.select("id", "x", "y"), ed.rectangle_edges(gq.typed(s, d), "lid"), dom, 40.0)
    return low.join(new, "id").select("id", "old", F.col("gid").alias("lid"))


@query("j11_nearest_cell_same_class", f"""WITH {CL},
p AS (SELECT fid, (x0 + x1) / 2 AS x, (y0 + y1) / 2 AS y, 100 + 100 * (fid % 3) AS own FROM fx_faces),
f AS (SELECT p.fid, cl.i, cl.j, greatest(0, cl.xcen - 5 - p.x, p.x - cl.xcen - 5) AS gx, greatest(0, cl.ycen - 5 - p.y, p.y - cl.ycen - 5) AS gy FROM p JOIN cl ON cl.i BETWEEN floor(p.x / 10) - 6 AND floor(p.x / 10) + 6 AND cl.j BETWEEN floor(p.y / 10) - 6 AND floor(p.y / 10) + 6 WHERE abs(cl.type - p.own) < 50),
n AS (SELECT *, row_number() OVER (PARTITION BY fid ORDER BY gx * gx + gy * gy, i, j) AS n FROM f WHERE gx * gx + gy * gy <= 3600)
SELECT fid, i, j, round(sqrt(gx * gx + gy * gy), 6) AS dist FROM n WHERE n = 1""")
def _(s, d):
    p = L(s, d, "fx_faces").select("fid", ((F.col("x0") + F.col("x1")) / 2).alias("x"), ((F.col("y0") + F.col("y1")) / 2).alias("y"), (100 + 100 * (F.col("fid") % 3)).alias("type"))
    return sp.nearest_cell(p, gq.class_cells(s, d), D(s, d), 60.0, pid="fid").withColumn("dist", F.round("dist", 6))


@query("c6_fill_courtyards_by_cells", f"""WITH {CL}, {BLOCKS},
nb AS (SELECT DISTINCT a.lid FROM t a JOIN t b ON a.lid <> b.lid AND a.x0 <= b.x1 AND b.x0 <= a.x1 AND a.y0 <= b.y1 AND b.y0 <= a.y1 WHERE a.type < 900 AND b.type < 900),
few AS (SELECT lid FROM cl GROUP BY lid HAVING count(*) < 20),
iso AS (SELECT t.* FROM t JOIN few USING (lid) WHERE t.type < 900 AND NOT EXISTS (SELECT 1 FROM nb WHERE nb.lid = t.lid)),
f AS (SELECT a.lid, b.lid AS near, b.type, greatest(0, a.x0 - b.x1, b.x0 - a.x1) ** 2 + greatest(0, a.y0 - b.y1, b.y0 - a.y1) ** 2 AS d2 FROM iso a JOIN t b ON b.type >= 900),
n AS (SELECT *, row_number() OVER (PARTITION BY lid ORDER BY d2, near) AS n FROM f)
SELECT t.lid AS gid, coalesce(n.type, t.type) AS type, n.type IS NOT NULL AS filled FROM t LEFT JOIN n ON n.lid = t.lid AND n.n = 1""")
def _(s, d):
    return lc.fill_isolated(blocks(s, d), gq.class_cells(s, d), 20)


@query("w6_outer_boundary", f"""WITH {CL}, {BLOCKS},
e AS (SELECT 0 AS ax, x0 AS c, y0 AS lo, y1 AS hi, 1 AS s FROM t WHERE type >= 900 UNION ALL SELECT 0, x1, y0, y1, -1 FROM t WHERE type >= 900
 UNION ALL SELECT 1, y0, x0, x1, 1 FROM t WHERE type >= 900 UNION ALL SELECT 1, y1, x0, x1, -1 FROM t WHERE type >= 900),
ev AS (SELECT ax, c, p, sum(k) AS k FROM (SELECT ax, c, lo AS p, s AS k FROM e UNION ALL SELECT ax, c, hi, -s FROM e) GROUP BY ax, c, p HAVING sum(k) <> 0),
net AS (SELECT ax, c, p, lead(p) OVER (PARTITION BY ax, c ORDER BY p) AS q, sum(k) OVER (PARTITION BY ax, c ORDER BY p) AS n FROM ev)
SELECT CASE ax WHEN 0 THEN c ELSE p END AS xa, CASE ax WHEN 0 THEN p ELSE c END AS ya, CASE ax WHEN 0 THEN c ELSE q END AS xb, CASE ax WHEN 0 THEN q ELSE c END AS yb FROM net WHERE n <> 0""")
def _(s, d):
    return ed.outline(ed.rectangle_edges(blocks(s, d).filter(F.col("type") >= 900), "gid"))


@query("u8_wall_heights", """WITH w AS (SELECT wid, xa, ya, xb, yb, greatest(1, CAST(ceil(sqrt((xb - xa) ** 2 + (yb - ya) ** 2) / 15) AS INT)) AS n FROM fx_walls),
s AS (SELECT *, unnest(range(n)) AS k FROM w),
p AS (SELECT CAST(wid AS BIGINT) * 1000 + k AS id, ((xa + (xb - xa) * k / n) + (xa + (xb - xa) * (k + 1) / n)) / 2 AS x, ((ya + (yb - ya) * k / n) + (ya + (yb - ya) * (k + 1) / n)) / 2 AS y FROM s),
own AS (SELECT p.id, p.x, p.y, b.val FROM p LEFT JOIN fx_bheight b ON b.px = floor(p.x / 20) AND b.py = floor(p.y / 20)),
g AS (SELECT o.id, b.val, b.px, b.py, o.x - (b.px + 0.5) * 20 AS gx, o.y - (b.py + 0.5) * 20 AS gy FROM own o JOIN fx_bheight b ON b.px BETWEEN floor(o.x / 20) - 6 AND floor(o.x / 20) + 6 AND b.py BETWEEN floor(o.y / 20) - 6 AND floor(o.y / 20) + 6 WHERE o.val IS NULL AND b.val IS NOT NULL),
far AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY gx * gx + gy * gy, py, px) AS n FROM g WHERE gx * gx + gy * gy <= 10000)
SELECT own.id, coalesce(own.val, far.val, 10) AS height FROM own LEFT JOIN far ON far.id = own.id AND far.n = 1""")
def _(s, d):
    w = lc.wall_segments(ed.rectangle_edges(L(s, d, "fx_street"), "osm_id"), 15.0)
    p = w.select(((F.col("gid") * 4 + F.col("edge")).cast("long") * 1000 + F.col("part")).alias("id"), ((F.col("sx") + F.col("ex")) / 2).alias("x"), ((F.col("sy") + F.col("ey")) / 2).alias("y"))
    return cy.wall_heights(p, L(s, d, "fx_bheight"), 20.0, 10.0, tile=1)  # tiles of one pixel: the wider search has work


@query("k6_wall_grid_points", """WITH e AS (SELECT gid, 0 AS edge, cx + rx AS xa, cy AS ya, cx AS xb, cy + ry AS yb FROM fx_diamond UNION ALL SELECT gid, 1, cx, cy + ry, cx - rx, cy FROM fx_diamond
 UNION ALL SELECT gid, 2, cx - rx, cy, cx, cy - ry FROM fx_diamond UNION ALL SELECT gid, 3, cx, cy - ry, cx + rx, cy FROM fx_diamond),
xs AS (SELECT *, unnest(range(CAST(ceil(least(xa, xb) / 10) AS INT), CAST(floor(greatest(xa, xb) / 10) AS INT) + 1)) AS m FROM e),
ys AS (SELECT *, unnest(range(CAST(ceil(least(ya, yb) / 10) AS INT), CAST(floor(greatest(ya, yb) / 10) AS INT) + 1)) AS m FROM e),
met AS (SELECT gid, edge, 0 AS ax, m, (ya + (yb - ya) * (m * 10 - xa) / (xb - xa)) / 10 AS v FROM xs UNION ALL SELECT gid, edge, 1, m, (xa + (xb - xa) * (m * 10 - ya) / (yb - ya)) / 10 FROM ys),
q AS (SELECT *, floor(v) AS n, (floor(v) + greatest(0.001, least(0.999, v - floor(v)))) * 10 AS o FROM met),
c AS (SELECT gid, edge, CAST(CASE ax WHEN 0 THEN m - k.k ELSE n END AS INT) AS i, CAST(CASE ax WHEN 0 THEN n ELSE m - k.k END AS INT) AS j, CASE ax WHEN 0 THEN m * 10 ELSE o END AS x, CASE ax WHEN 0 THEN o ELSE m * 10 END AS y FROM q, (SELECT 0 AS k UNION ALL SELECT 1) k)
SELECT gid, edge, i, j, round(x, 6) AS x, round(y, 6) AS y FROM c, fx_dom WHERE i BETWEEN 0 AND nx - 1 AND j BETWEEN 0 AND nx - 1""")
def _(s, d):
    return cc.grid_points(gq.diamond_edges(s, d), D(s, d)).select("gid", "edge", "i", "j", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))
