"""Fixture layers, derived from the given tables by SQL that Spark and DuckDB share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cellweave.domain import Domain
from cellweave.session import table

TABLES = ["part", "customer", "orders", "events", "lineitem", "nation"]

#: Layer name to its SQL; later ones may use earlier ones.
SQL: dict[str, str] = {
    "fx_dom": """
SELECT CAST(ceil(sqrt(CAST(count(*) AS DOUBLE))) AS INT) AS b,
       4 * CAST(ceil(sqrt(CAST(count(*) AS DOUBLE))) AS INT) AS nx FROM part
""",
    "fx_grid": """
SELECT CAST(a.p_partkey * d.nx + c.p_partkey + 1 AS INT) AS id,
       CAST(a.p_partkey AS INT) AS i, CAST(c.p_partkey AS INT) AS j,
       CAST(a.p_partkey * 10 + 5 AS DOUBLE) AS xcen, CAST(c.p_partkey * 10 + 5 AS DOUBLE) AS ycen
FROM part a CROSS JOIN part c CROSS JOIN fx_dom d
WHERE a.p_partkey < d.nx AND c.p_partkey < d.nx
""",
    "fx_codes": """
SELECT * FROM (VALUES (1,11100,203,901),(2,11210,203,902),(3,11220,203,903),(4,11230,203,902),
 (5,11240,203,903),(6,11300,203,903),(7,12100,203,906),(8,12210,201,906),(9,12220,202,906),
 (10,12230,209,906),(11,12300,203,906),(12,12400,103,906),(13,13100,101,906),(14,13300,101,906),
 (15,13400,108,906),(16,14100,118,906),(17,14200,103,906),(18,21000,102,906),(19,22000,101,906),
 (20,23000,103,906),(21,24000,102,906),(22,25000,102,906),(23,31000,117,906),(24,32000,110,906),
 (25,33000,112,906),(26,40000,110,906),(27,50000,301,906)) AS t(idx, code, type_land, type_street)
""",
    "fx_landcover": """
SELECT CAST(p_partkey AS INT) AS lid, k.code AS code,
       CAST((p_partkey % d.b) * 40 AS DOUBLE) AS x0,
       CAST(CAST(floor(p_partkey / CAST(d.b AS DOUBLE)) AS INT) * 40 AS DOUBLE) AS y0,
       CAST((p_partkey % d.b) * 40 + 40 AS DOUBLE) AS x1,
       CAST(CAST(floor(p_partkey / CAST(d.b AS DOUBLE)) AS INT) * 40 + 40 AS DOUBLE) AS y1,
       CAST(1 + p_size % 24 AS INT) AS catland
FROM part CROSS JOIN fx_dom d JOIN fx_codes k ON k.idx = 1 + p_partkey % 27
WHERE p_partkey % 37 <> 0
""",
    "fx_street": """
SELECT CAST(c_custkey AS INT) AS osm_id,
       CAST((c_custkey % d.b) * 40 + 4 + c_nationkey % 4 AS DOUBLE) AS x0,
       CAST(CAST(floor(c_custkey / CAST(d.b AS DOUBLE)) AS INT) * 40 + 3 + c_nationkey % 5 AS DOUBLE) AS y0,
       CAST((c_custkey % d.b) * 40 + 12 + c_nationkey % 4 + CAST(floor(abs(c_acctbal)) AS INT) % 20 AS DOUBLE) AS x1,
       CAST(CAST(floor(c_custkey / CAST(d.b AS DOUBLE)) AS INT) * 40 + 11 + c_nationkey % 5 + c_custkey % 19 AS DOUBLE) AS y1
FROM customer CROSS JOIN fx_dom d
""",
    "fx_diamond": """
SELECT CAST(c_custkey AS INT) AS gid,
       CAST((c_custkey % d.b) * 40 + 20 AS DOUBLE) AS cx,
       CAST(CAST(floor(c_custkey / CAST(d.b AS DOUBLE)) AS INT) * 40 + 20 AS DOUBLE) AS cy,
       CAST(8 + c_nationkey % 16 AS DOUBLE) AS rx, CAST(6 + c_custkey % 13 AS DOUBLE) AS ry
FROM customer CROSS JOIN fx_dom d
""",
    "fx_dem": """
SELECT CAST(o_orderkey % w.w AS INT) AS px, CAST(floor(o_orderkey / CAST(w.w AS DOUBLE)) AS INT) AS py,
       CASE WHEN o_orderkey % 50 = 7 THEN NULL ELSE CAST(190 AS DOUBLE) + o_totalprice / CAST(25000 AS DOUBLE) END AS val
FROM orders CROSS JOIN (SELECT CAST(ceil(b * 40 / CAST(25 AS DOUBLE)) AS INT) AS w FROM fx_dom) w
WHERE o_orderkey < w.w * w.w
""",
    "fx_bheight": """
SELECT CAST(event_id % (2 * d.b) AS INT) AS px, CAST(floor(event_id / CAST(2 * d.b AS DOUBLE)) AS INT) AS py,
       CASE WHEN event_type = 'error' THEN NULL ELSE CAST(6 + CAST(floor(value) AS INT) % 30 AS DOUBLE) END AS val
FROM events CROSS JOIN fx_dom d WHERE event_id < 4 * d.b * d.b
""",
    "fx_block_raster": """
SELECT CAST(p_partkey % d.b AS INT) AS px, CAST(floor(p_partkey / CAST(d.b AS DOUBLE)) AS INT) AS py,
       l.q * CAST(2 AS DOUBLE) AS imperv, p_size / CAST(10 AS DOUBLE) AS lai, p_size * CAST(0.5 AS DOUBLE) AS canopy
FROM part JOIN (SELECT l_partkey, avg(l_quantity) AS q FROM lineitem GROUP BY l_partkey) l ON l_partkey = p_partkey
CROSS JOIN fx_dom d
""",
    "fx_trees": """
SELECT CAST(o_orderkey AS INT) AS gid,
       CAST((o_orderkey * 7919) % (d.b * 400) AS DOUBLE) / CAST(10 AS DOUBLE) AS x,
       CAST((o_orderkey * 104729) % (d.b * 400) AS DOUBLE) / CAST(10 AS DOUBLE) AS y,
       CAST(4 + o_custkey % 20 AS DOUBLE) AS treeh, CAST(4 + o_custkey % 20 AS DOUBLE) * CAST(0.25 AS DOUBLE) AS trunkh,
       CAST(1 AS DOUBLE) + CAST(0.75 AS DOUBLE) * CAST(o_orderkey % 5 AS DOUBLE) AS crownr,
       CAST(o_orderkey % 6 AS INT) AS crownshp, CAST(o_orderkey % 3 AS INT) AS tree_type
FROM orders CROSS JOIN fx_dom d WHERE o_orderpriority = '2-HIGH'
""",
    "fx_material": """
SELECT CAST(n_nationkey + o.off AS INT) AS code,
       CAST(10 + n_regionkey * 3 AS DOUBLE) / CAST(100 AS DOUBLE) AS albedo,
       CAST(60 + n_nationkey AS DOUBLE) / CAST(100 AS DOUBLE) AS emissivity,
       CAST(1 + n_nationkey AS DOUBLE) / CAST(1000 AS DOUBLE) AS roughness,
       CAST(1840000 + n_nationkey * 1000 AS DOUBLE) AS capacity_surf,
       CAST(10 + n_nationkey AS DOUBLE) / CAST(10 AS DOUBLE) AS conductivity_surf
FROM nation CROSS JOIN (SELECT 0 AS off UNION ALL SELECT 200 AS off) o
""",
    "fx_roofs": """
SELECT osm_id AS rid, CAST(osm_id % 25 AS INT) AS material, CAST(20 + osm_id % 15 AS DOUBLE) AS thickness,
       CAST(10 + osm_id % 30 AS DOUBLE) / CAST(100 AS DOUBLE) AS albedo, x0, y0, x1, y1 FROM fx_street
""",
    "fx_walls": """
SELECT osm_id * 4 + s.k AS wid, CAST(osm_id % 25 AS INT) AS wallcatd, CAST((osm_id + 7) % 25 AS INT) AS wallcatu,
       CAST(osm_id % 10 AS DOUBLE) / CAST(10 AS DOUBLE) AS winfracu,
       CASE s.k WHEN 0 THEN x0 WHEN 1 THEN x1 WHEN 2 THEN x1 ELSE x0 END AS xa,
       CASE s.k WHEN 0 THEN y0 WHEN 1 THEN y0 WHEN 2 THEN y1 ELSE y1 END AS ya,
       CASE s.k WHEN 0 THEN x1 WHEN 1 THEN x1 WHEN 2 THEN x0 ELSE x0 END AS xb,
       CASE s.k WHEN 0 THEN y0 WHEN 1 THEN y1 WHEN 2 THEN y1 ELSE y0 END AS yb
FROM fx_street CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 AS k UNION ALL SELECT 2 AS k UNION ALL SELECT 3 AS k) s
""",
    "fx_extras": """
SELECT osm_id AS gid, CASE osm_id % 3 WHEN 0 THEN 'bridge' WHEN 1 THEN 'passage' ELSE 'overhang' END AS class3d,
       CAST(201 + osm_id % 3 AS INT) AS typed, CAST(5 + 5 * (osm_id % 2) AS DOUBLE) AS bottom, x0, y0, x1, y1
FROM fx_street WHERE osm_id % 7 = 0
""",
    "fx_levels": """
SELECT id, i, j, CAST((i * 7 + j * 13 + (i * j) % 11) % 6 AS INT) AS nz,
       (i * 3 + j * 5) % 4 = 0 AS is_building FROM fx_grid
""",
    "fx_lines": """
SELECT CAST(p_partkey AS INT) AS sid, CAST(0 AS DOUBLE) AS xa, CAST(p_partkey * 40 + 1 AS DOUBLE) AS ya,
       CAST(d.b * 40 AS DOUBLE) AS xb, CAST(p_partkey * 40 + 1 AS DOUBLE) AS yb
FROM part CROSS JOIN fx_dom d WHERE p_partkey < d.b
""",
    "fx_faces": """
SELECT osm_id AS fid, x0, y0, x1, y1, CAST(osm_id % 9 AS DOUBLE) AS z00, CAST(osm_id % 9 + osm_id % 4 AS DOUBLE) AS z10,
       CAST(osm_id % 9 + osm_id % 4 + osm_id % 3 AS DOUBLE) AS z11, CAST(osm_id % 9 + osm_id % 3 AS DOUBLE) AS z01
FROM fx_street
""",
}


def _with(last: str | None = None) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({s.strip()})" for n, s in SQL.items()) + "\n"


#: All layers as common table expressions, in front of every oracle.
PREFIX = _with()


def layer(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One fixture layer as a DataFrame; the grid is made by its operator, not by a product of tables."""
    if name == "fx_grid":
        from cellweave.operators.grid import make_grid

        return make_grid(spark, domain(spark, sf_dir)).select("id", "i", "j", "xcen", "ycen")
    for t in TABLES:
        table(spark, sf_dir, t).createOrReplaceTempView(t)
    if name == "fx_levels":
        layer(spark, sf_dir, "fx_grid").createOrReplaceTempView("fx_grid")
        return spark.sql(SQL[name])
    need, todo = [], [name]
    while todo:
        n = todo.pop()
        need.append(n)
        todo += [m for m in SQL if m != n and m not in need and m in SQL[n]]
    return spark.sql("WITH " + ", ".join(f"{n} AS ({s.strip()})" for n, s in SQL.items() if n in need) + f" SELECT * FROM {name}")


def domain(spark: SparkSession, sf_dir: str) -> Domain:
    b = layer(spark, sf_dir, "fx_dom").first()["b"]
    return Domain(nx=4 * b, ny=4 * b, dx=10.0, dy=10.0, dz=5.0, origin_x=0.0, origin_y=0.0)
