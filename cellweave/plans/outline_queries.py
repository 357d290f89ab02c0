"""Registered queries of footprints, clipping, hulls and street lines, added to those of grid_queries."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.domain import DEFAULT_BUILDING, Domain
from cellweave.operators import arrange as ar
from cellweave.operators import canyon as cy
from cellweave.operators import cutcell as cc
from cellweave.operators import edges as ed
from cellweave.operators import landcover as lc
from cellweave.operators import lines as ln
from cellweave.operators import spatial as sp
from cellweave.plans import grid_queries as gq
from cellweave.plans.grid_queries import CL, LC, PAIRS, D, L, query

#: Footprints grown until many overlap or touch.
GROWN = "gr AS (SELECT osm_id AS gid, x0, y0, x1 + 20 AS x1, y1 + 18 AS y1 FROM fx_street)"
DIAMOND = """e AS (SELECT gid, cx + rx AS xa, cy AS ya, cx AS xb, cy + ry AS yb FROM fx_diamond UNION ALL SELECT gid, cx, cy + ry, cx - rx, cy FROM fx_diamond
 UNION ALL SELECT gid, cx - rx, cy, cx, cy - ry FROM fx_diamond UNION ALL SELECT gid, cx, cy - ry, cx + rx, cy FROM fx_diamond)"""


def grown(s, d) -> DataFrame:
    return L(s, d, "fx_street").select(F.col("osm_id").alias("gid"), "x0", "y0", (F.col("x1") + 20).alias("x1"), (F.col("y1") + 18).alias("y1"))


def by_root(polygons: DataFrame, boxes: DataFrame) -> DataFrame:
    """root (lowest member), area, length of the outline of each footprint."""
    p, q = F.col("points"), F.concat(F.slice("points", F.lit(2), F.size("points")), F.slice("points", 1, 1))
    side = F.zip_with(p, q, lambda a, b: F.sqrt((a["x"] - b["x"]) * (a["x"] - b["x"]) + (a["y"] - b["y"]) * (a["y"] - b["y"])))
    size = polygons.groupBy("gid").agg(F.sum("area").alias("area"), F.sum(F.aggregate(side, F.lit(0.0), lambda x, y: x + y)).alias("length"))
    middle = boxes.select(F.col("gid").alias("id"), ((F.col("x0") + F.col("x1")) / 2).alias("x"), ((F.col("y0") + F.col("y1")) / 2).alias("y"))
    own = ar.members(polygons, middle).groupBy("gid").agg(F.min("id").alias("root"))
    return size.join(own, "gid").select("root", F.round("area", 3).alias("area"), F.round("length", 3).alias("length"))


@query("l1_split_by_fishnet", f"""WITH {DIAMOND}, big AS (SELECT * FROM fx_diamond WHERE 2 * rx * ry > 300),
bi AS (SELECT *, unnest(range(CAST(floor((cx - rx + 40) / 16) AS INT), CAST(floor((cx + rx + 40) / 16) AS INT) + 1)) AS i FROM big),
bj AS (SELECT gid, i, unnest(range(CAST(floor((cy - ry + 40) / 16) AS INT), CAST(floor((cy + ry + 40) / 16) AS INT) + 1)) AS j FROM bi),
p AS (SELECT bj.gid, i, j, sign(xb - xa) AS s, (yb - ya) / (xb - xa) AS m, xa, ya, greatest(i * 16 - 40, least(xa, xb)) AS l, least(i * 16 - 24, greatest(xa, xb)) AS r FROM bj JOIN e USING (gid)),
q AS (SELECT *, ya + (l - xa) * m - (j * 16 - 40) AS u, ya + (r - xa) * m - (j * 16 - 40) AS v FROM p WHERE r > l),
a AS (SELECT gid, i, j, sum(s * (r - l) * ((CASE WHEN v < 0 THEN 0 WHEN v < 16 THEN v * v / 2 ELSE 128 + 16 * (v - 16) END) - (CASE WHEN u < 0 THEN 0 WHEN u < 16 THEN u * u / 2 ELSE 128 + 16 * (u - 16) END)) / (v - u)) AS area FROM q GROUP BY gid, i, j)
SELECT gid, CAST(i AS INT) AS i, CAST(j AS INT) AS j, round(abs(area), 3) AS area FROM a WHERE abs(area) > 1e-9 UNION ALL SELECT gid, NULL, NULL, round(2 * rx * ry, 3) FROM fx_diamond WHERE 2 * rx * ry <= 300""")
def _(s, d):
    dom = D(s, d)
    n = math.ceil((dom.nx * dom.dx + 80) / 16)
    cutting = ar.split_by_fishnet(gq.diamond_edges(s, d), Domain(n, n, 16.0, 16.0, 5.0, -40.0, -40.0), 300.0)
    return cutting.select("gid", "i", "j", F.round("area", 3).alias("area"))


@query("l9_union_buildings", f"""WITH {GROWN},
tp AS (SELECT a.gid AS a, b.gid AS b FROM gr a JOIN gr b ON a.gid <> b.gid AND a.x0 <= b.x1 AND b.x0 <= a.x1 AND a.y0 <= b.y1 AND b.y0 <= a.y1 WHERE least(a.x1, b.x1) - greatest(a.x0, b.x0) + least(a.y1, b.y1) - greatest(a.y0, b.y0) > 0),
rc AS (SELECT gid, gid AS root FROM gr UNION SELECT tp.b, rc.root FROM rc JOIN tp ON tp.a = rc.gid WHERE tp.b > rc.root),
rt AS (SELECT gid, min(root) AS root FROM rc GROUP BY gid),
sx AS (SELECT gid, y0, y1, unnest(range(CAST(x0 AS INT), CAST(x1 AS INT))) AS x FROM gr),
sq AS (SELECT DISTINCT rt.root, sx.x, sx.y FROM (SELECT gid, x, unnest(range(CAST(y0 AS INT), CAST(y1 AS INT))) AS y FROM sx) sx JOIN rt USING (gid)),
nb AS (SELECT root, count(*) AS n FROM sq a JOIN (SELECT root, x - 1 AS x, y FROM sq UNION ALL SELECT root, x, y - 1 FROM sq) b USING (root, x, y) GROUP BY root),
sz AS (SELECT root, count(*) AS n FROM sq GROUP BY root)
SELECT sz.root, CAST(sz.n AS DOUBLE) AS area, CAST(4 * sz.n - 2 * nb.n AS DOUBLE) AS length FROM sz JOIN nb USING (root)""")
def _(s, d):
    g = grown(s, d)
    return by_root(ar.union_buildings(ed.rectangle_edges(g, "gid")), g)


gq.SQL["l9_union_buildings"] = "WITH RECURSIVE " + gq.SQL["l9_union_buildings"].removeprefix("WITH ")


@query("l12_pair_hulls", f"""WITH {PAIRS},
c AS (SELECT osm_id, x0 AS x, y0 AS y FROM fx_street UNION ALL SELECT osm_id, x1, y0 FROM fx_street UNION ALL SELECT osm_id, x1, y1 FROM fx_street UNION ALL SELECT osm_id, x0, y1 FROM fx_street),
pp AS (SELECT DISTINCT pr.a, pr.b, c.x, c.y FROM pr JOIN c ON c.osm_id = pr.a OR c.osm_id = pr.b),
dp AS (SELECT p.a, p.b, p.x AS px, p.y AS py, q.x AS qx, q.y AS qy FROM pp p JOIN pp q USING (a, b) WHERE p.x <> q.x OR p.y <> q.y),
ck AS (SELECT dp.*, (qx - px) * (r.y - py) - (qy - py) * (r.x - px) AS k, r.x BETWEEN least(px, qx) AND greatest(px, qx) AND r.y BETWEEN least(py, qy) AND greatest(py, qy) AS mid FROM dp JOIN pp r USING (a, b)),
he AS (SELECT a, b, px, py, qx, qy FROM ck GROUP BY ALL HAVING bool_and(k > 0 OR (k = 0 AND mid)))
SELECT a, b, CAST(count(*) AS INT) AS corners, sum(px * qy - qx * py) / 2 AS area FROM he GROUP BY a, b""")
def _(s, d):
    h = ar.hull_edges(ar.pair_hulls(ed.rectangle_edges(L(s, d, "fx_street"), "osm_id"), gq.l10(s, d)), ["a", "b"])
    return h.groupBy("a", "b").agg(F.count("*").cast("int").alias("corners"), (F.sum(F.col("xa") * F.col("yb") - F.col("xb") * F.col("ya")) / 2).alias("area"))


@query("l13_final_footprints")
def _(s, d):
    dom, street = D(s, d), L(s, d, "fx_street").withColumnRenamed("osm_id", "gid")
    pairs = lc.adjacent_pairs(street, 8.0)
    return by_root(ar.final_footprints(ed.rectangle_edges(street, "gid"), pairs, 4 * dom.dx * dom.dy), street)


@query("l15_reintegrate", f"""WITH {LC},
o AS (SELECT l.lid, s.osm_id, (least(l.x1, s.x1) - greatest(l.x0, s.x0)) * (least(l.y1, s.y1) - greatest(l.y0, s.y0)) AS a FROM lc l JOIN fx_street s ON l.x0 < s.x1 AND s.x0 < l.x1 AND l.y0 < s.y1 AND s.y0 < l.y1)
SELECT 'building' AS part, CAST(osm_id AS BIGINT) AS gid, CAST(906 AS INT) AS type, sum(a) AS area FROM o GROUP BY osm_id UNION ALL
SELECT 'land', l.lid, l.type, (x1 - x0) * (y1 - y0) - coalesce(sum(o.a), 0) FROM lc l LEFT JOIN o USING (lid) GROUP BY l.lid, l.type, x0, y0, x1, y1 HAVING (x1 - x0) * (y1 - y0) > coalesce(sum(o.a), 0)""")
def _(s, d):
    land = gq.typed(s, d)
    e = ar.reintegrate(ed.rectangle_edges(land, "lid"), land.select(F.col("lid").alias("gid"), "type"), ed.rectangle_edges(L(s, d, "fx_street"), "osm_id"), DEFAULT_BUILDING)
    return e.groupBy("part", "gid", "type").agg(F.round(F.sum(F.col("xa") * F.col("yb") - F.col("xb") * F.col("ya")) / 2, 3).alias("area"))


def streets(s, d) -> DataFrame:
    """Cells, and whether they are of a street class (201 to 203)."""
    c = gq.class_cells(s, d)
    return c.select("i", "j", F.coalesce(F.col("type").between(201, 203), F.lit(False)).alias("street"))


@query("u1_street_medial", f"""WITH {CL}, st AS (SELECT i, j, coalesce(type BETWEEN 201 AND 203, false) AS street FROM cl),
rim AS (SELECT DISTINCT b.i, b.j FROM st b JOIN st a ON a.street AND NOT b.street AND abs(a.i - b.i) + abs(a.j - b.j) = 1 AND a.i BETWEEN b.i - 1 AND b.i + 1 AND a.j BETWEEN b.j - 1 AND b.j + 1),
f AS (SELECT a.i, a.j, min(ROW((a.i - r.i) ** 2 + (a.j - r.j) ** 2, r.i, r.j)) AS n FROM st a JOIN rim r ON a.street AND r.i BETWEEN a.i - 60 AND a.i + 60 AND r.j BETWEEN a.j - 60 AND a.j + 60 GROUP BY a.i, a.j),
dd AS (SELECT i, j, n[1] AS d2, n[2] AS fi, n[3] AS fj FROM f),
m AS (SELECT CASE WHEN q.d2 > p.d2 THEN q.i ELSE p.i END AS i, CASE WHEN q.d2 > p.d2 THEN q.j ELSE p.j END AS j, greatest(p.d2, q.d2) AS d2, (p.fi - q.fi) ** 2 + (p.fj - q.fj) ** 2 AS w FROM dd p JOIN dd q ON (q.i = p.i + 1 AND q.j = p.j) OR (q.i = p.i AND q.j = p.j + 1))
SELECT DISTINCT CAST(i AS INT) AS i, CAST(j AS INT) AS j, CAST(d2 AS INT) AS d2 FROM m WHERE sqrt(w) > sqrt(3.0 * d2) + 0.52 UNION SELECT a.i, a.j, 1 FROM st a WHERE a.street AND 2 IN (SELECT count(*) FROM st b WHERE NOT b.street AND ((b.i = a.i AND abs(b.j - a.j) = 1) OR (b.j = a.j AND abs(b.i - a.i) = 1)) GROUP BY b.i = a.i)""")
def _(s, d):
    return ln.medial(streets(s, d)).select("i", "j", F.col("d2").cast("int").alias("d2"))


@query("u2_merge_lines", "SELECT xa, ya, xb, yb FROM fx_lines")
def _(s, d):
    pieces = cy.chop(L(s, d, "fx_lines"), 15.0).select(F.col("ex").alias("xa"), F.col("ey").alias("ya"), F.col("sx").alias("xb"), F.col("sy").alias("yb"))
    made = ln.merge_lines(pieces).select(ln.simplify_points("points", F.lit(0.5), F.lit(False)).alias("p"))
    return made.select(F.col("p")[0]["x"].alias("xa"), F.col("p")[0]["y"].alias("ya"), F.col("p")[F.size("p") - 1]["x"].alias("xb"), F.col("p")[F.size("p") - 1]["y"].alias("yb"))


@query("u2_centre_lines")
def _(s, d):
    dom = D(s, d)
    made = ln.centre_lines(streets(s, d), dom.dx, dom.dy, 0.5)
    p = made.select("line", F.posexplode("points").alias("at", "p"))
    return p.select("at", "p.x", "p.y")


#: Diamonds of four fifths: they keep apart. Crossings of their edges with the cells' borders, as in k6_wall_grid_points.
APART = """fx AS (SELECT gid, cx, cy, rx * 0.8 AS rx, ry * 0.8 AS ry FROM fx_diamond), e AS (SELECT gid, 0 AS edge, cx + rx AS xa, cy AS ya, cx AS xb, cy + ry AS yb FROM fx UNION ALL SELECT gid, 1, cx, cy + ry, cx - rx, cy FROM fx
 UNION ALL SELECT gid, 2, cx - rx, cy, cx, cy - ry FROM fx UNION ALL SELECT gid, 3, cx, cy - ry, cx + rx, cy FROM fx),
xs AS (SELECT *, unnest(range(CAST(ceil(least(xa, xb) / 10) AS INT), CAST(floor(greatest(xa, xb) / 10) AS INT) + 1)) AS m FROM e),
ys AS (SELECT *, unnest(range(CAST(ceil(least(ya, yb) / 10) AS INT), CAST(floor(greatest(ya, yb) / 10) AS INT) + 1)) AS m FROM e),
met AS (SELECT gid, edge, 0 AS ax, m, (ya + (yb - ya) * (m * 10 - xa) / (xb - xa)) / 10 AS v FROM xs UNION ALL SELECT gid, edge, 1, m, (xa + (xb - xa) * (m * 10 - ya) / (yb - ya)) / 10 FROM ys),
q AS (SELECT *, floor(v) AS n, (floor(v) + greatest(0.001, least(0.999, v - floor(v)))) * 10 AS o FROM met),
c AS (SELECT gid, edge, CAST(CASE ax WHEN 0 THEN m - k.k ELSE n END AS INT) AS i, CAST(CASE ax WHEN 0 THEN n ELSE m - k.k END AS INT) AS j, CASE ax WHEN 0 THEN m * 10 ELSE o END AS x, CASE ax WHEN 0 THEN o ELSE m * 10 END AS y FROM q, (SELECT 0 AS k UNION ALL SELECT 1) k),
ch AS (SELECT gid, i, j, min(edge) AS edge, min(ROW(x, y)) AS p, max(ROW(x, y)) AS q, count(DISTINCT edge) AS edges, count(*) AS n FROM c, fx_dom WHERE i BETWEEN 0 AND nx - 1 AND j BETWEEN 0 AND nx - 1 GROUP BY gid, i, j)"""


def apart_edges(s, d) -> DataFrame:
    x, y, rx, ry = F.col("cx"), F.col("cy"), F.col("rx") * 0.8, F.col("ry") * 0.8
    # partitioned before they grow to edges and border points
    return ed.ring_edges(L(s, d, "fx_diamond").repartition(sp.tasks(s, D(s, d)), "gid"), "gid", [(x + rx, y), (x, y + ry), (x - rx, y), (x, y - ry)])


def halves(s, d) -> DataFrame:
    e, dom = apart_edges(s, d), D(s, d)
    return cc.split_cell(cc.chords(cc.grid_points(e, dom)), ar.dissolve(e), dom)


@query("k7_split_cell")
def _(s, d):
    return halves(s, d).select("gid", "i", "j", "side", F.round("area", 4).alias("area"), F.round("share", 4).alias("share"))


@query("k8_chord_normal", f"""WITH {APART}, v AS (SELECT ch.*, q[1] - p[1] AS vx, q[2] - p[2] AS vy, yb - ya AS ox, xa - xb AS oy FROM ch JOIN e USING (gid, edge) WHERE edges = 1 AND n = 2)
SELECT gid, i, j, round(sign(vy * ox - vx * oy) * vy / sqrt(vx ** 2 + vy ** 2), 6) AS nx, round(-sign(vy * ox - vx * oy) * vx / sqrt(vx ** 2 + vy ** 2), 6) AS ny FROM v""")
def _(s, d):
    return halves(s, d).filter("plain").select("gid", "i", "j", F.round("nx", 6).alias("nx"), F.round("ny", 6).alias("ny"))
