"""The output cube: coordinates, metadata, and variables with parameters or layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.domain import Domain
from cellweave.operators import grid as gr
from cellweave.operators.params import class_range


def verify_import(tables: dict[str, DataFrame]) -> DataFrame:
    """name, n, ok of imported layers; a layer without rows is not ok."""
    parts = [t.agg(F.lit(name).alias("name"), F.count("*").alias("n")) for name, t in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out.withColumn("ok", F.col("n") > 0)


def default_srid(layer: DataFrame, srid: int) -> DataFrame:
    """A missing reference system takes the configured one."""
    return layer.withColumn("srid", F.coalesce("srid", F.lit(srid)))


def coordinates(cells: DataFrame, dom: Domain, zone: int) -> DataFrame:
    """id, j, i, x, y (from the corner of the domain), E_UTM, N_UTM, lon, lat of cell centres."""
    e, n = F.lit(dom.origin_x) + (F.col("i") + 0.5) * dom.dx, F.lit(dom.origin_y) + (F.col("j") + 0.5) * dom.dy
    lon, lat = gr.utm_to_lonlat(F.col("E_UTM"), F.col("N_UTM"), zone)
    out = cells.select("id", "j", "i", ((F.col("i") + 0.5) * dom.dx).alias("x"), ((F.col("j") + 0.5) * dom.dy).alias("y"), e.alias("E_UTM"), n.alias("N_UTM"))
    return out.withColumns({"lon": lon, "lat": lat})


def coordinate_variables(cells: DataFrame, dom: Domain, zone: int) -> DataFrame:
    """The coordinates as rows (var, j, i, value) of the cube, with one row for the reference system."""
    names = ["x", "y", "E_UTM", "N_UTM", "lon", "lat"]
    c = coordinates(cells, dom, zone)
    rows = c.select("j", "i", F.explode(F.array(*[F.struct(F.lit(v).alias("var"), F.col(v).alias("value")) for v in names])).alias("v")).select("v.var", "j", "i", "v.value")
    return rows.unionAll(cells.sparkSession.createDataFrame([("crs", 0, 0, float(zone))], "var string, j int, i int, value double"))


def metadata(spark: SparkSession, dom: Domain, extra: dict[str, str] | None = None) -> DataFrame:
    """key, value of the cube's global attributes."""
    rows = {"Conventions": "CF-1.7", "origin_x": str(dom.origin_x), "origin_y": str(dom.origin_y), "nx": str(dom.nx), "ny": str(dom.ny), "dx": str(dom.dx), "dy": str(dom.dy), "dz": str(dom.dz)}
    return spark.createDataFrame(list((rows | (extra or {})).items()), "key string, value string")


def resample(cells: DataFrame, pixels: DataFrame, scale: float) -> DataFrame:
    """i, j, val: nearest pixel of a raster with pixel size ``scale`` for each cell of the snapped grid."""
    at = cells.select("i", "j", F.floor(F.col("xcen") / scale).cast("int").alias("px"), F.floor(F.col("ycen") / scale).cast("int").alias("py"))
    return at.join(pixels.select("px", "py", "val"), ["px", "py"]).select("i", "j", "val")


def surface_fraction(cells: DataFrame) -> DataFrame:
    """layer (0 vegetation, 1 pavement, 2 water), j, i, value: shares of typed cells that are no buildings."""
    kinds = [F.struct(F.lit(k).alias("layer"), F.when(class_range(kind), 1.0).otherwise(0.0).alias("value")) for k, kind in enumerate(("vegetation", "pavement", "water"))]
    some = class_range("vegetation") | class_range("pavement") | class_range("water")
    return cells.filter(some).select("j", "i", F.explode(F.array(*kinds)).alias("v")).select("v.layer", "j", "i", "v.value")


def by_class(cells: DataFrame, kind: str, first: int, table: DataFrame) -> DataFrame:
    """par, j, i, value from a short table (class, par, value) for cells of a kind."""
    own = cells.filter(class_range(kind)).select("j", "i", (F.col("type") - first).alias("class"))
    return own.join(F.broadcast(table), "class").select("par", "j", "i", "value")


def material_pars(cells: DataFrame, kind: str, columns: list[str]) -> DataFrame:
    """par, j, i, value: columns of the cell's material for cells of a kind, nulls left out."""
    items = [F.struct(F.lit(k).alias("par"), F.col(c).cast("double").alias("value")) for k, c in enumerate(columns)]
    return cells.filter(class_range(kind)).select("j", "i", F.explode(F.array(*items)).alias("v")).select("v.par", "j", "i", "v.value").filter("value is not null")


def subsurface_pars(cells: DataFrame, depths: list[float], upper: int, pars: list[tuple[float, float]]) -> DataFrame:
    """par, layer, zsoil, j, i, value: for pavement, the upper value in the first ``upper`` soil layers, else the lower; zsoil adds up the depths."""
    items, z = [], 0.0
    for layer, dz in enumerate(depths):
        z += dz
        for par, values in enumerate(pars):
            items.append(F.struct(F.lit(par).alias("par"), F.lit(layer).alias("layer"), F.lit(z).alias("zsoil"), F.lit(float(values[layer >= upper])).alias("value")))
    return cells.filter(class_range("pavement")).select("j", "i", F.explode(F.array(*items)).alias("v")).select("v.par", "v.layer", "v.zsoil", "j", "i", "v.value")


def building_variables(cells: DataFrame, tops: DataFrame, dz: float) -> DataFrame:
    """var, j, i, value of building_id, buildings_2d and building_type (1 where the class is none of a building)."""
    built = cells.filter(class_range("building")).select("id", "type")  # of the others no class is used
    b = tops.select("id", "i", "j", "lid", "top").hint("merge").join(built.hint("merge"), "id", "left")
    kind = F.when(class_range("building"), F.col("type") - 900).otherwise(1)
    items = [F.struct(F.lit(n).alias("var"), v.cast("double").alias("value")) for n, v in (("building_id", F.col("lid")), ("buildings_2d", F.col("top") * dz), ("building_type", kind))]
    return b.select("j", "i", F.explode(F.array(*items)).alias("v")).select("v.var", "j", "i", "v.value")


def cap_window_fraction(win: Column, wall: Column, limit: float = 0.95) -> tuple[Column, Column]:
    """Window and wall share; beyond the limit the window takes it and the wall the rest of 1."""
    return F.when(win > limit, limit).otherwise(win), F.when(win > limit, round(1 - limit, 2)).otherwise(wall)


def min_levels(tops: DataFrame, least: int) -> DataFrame:
    return tops.withColumn("top", F.greatest("top", F.lit(least)))


def type_under_structure(cells: DataFrame, lifted: DataFrame) -> DataFrame:
    """id, type: cells below a lifted structure (id, typed) take its surface class."""
    return cells.join(lifted, "id", "left").select("id", F.coalesce("typed", "type").alias("type"))


def canopy_cube(lad: DataFrame) -> DataFrame:
    """i, j, k, lad with level 0 of each column that has leaves, which holds none."""
    return lad.select("i", "j", "k", "lad").unionAll(lad.select("i", "j", F.lit(0).alias("k"), F.lit(0.0).alias("lad")).distinct())


def frontal_fraction(shares: DataFrame, surfaces: DataFrame, cell_area: float, most: float = 0.99) -> DataFrame:
    """i, j, value: sum over buildings (gid) of area in the cell over their own area, times wall and roof area over the cell's."""
    s = shares.join(surfaces, "gid")
    return s.groupBy("i", "j").agg(F.least(F.lit(most), F.sum(F.col("area") / F.col("plan") * F.col("surface")) / cell_area).alias("value"))


def layer_defaults(cells: DataFrame, layers: list[tuple[str, int, float]]) -> DataFrame:
    """var, layer, j, i, value: constant material layers for active cells."""
    items = [F.struct(F.lit(v).alias("var"), F.lit(k).alias("layer"), F.lit(x).alias("value")) for v, k, x in layers]
    return cells.select("j", "i", F.explode(F.array(*items)).alias("v")).select("v.var", "v.layer", "j", "i", "v.value")


def building_override(corners: DataFrame, inside: DataFrame, tops: DataFrame) -> DataFrame:
    """i, j, top: corners inside a building (i, j, lid) take the highest level of its cells.

    Only corners inside one look for its level: the others have no lid, and would all meet in one task.
    """
    high = tops.groupBy("lid").agg(F.max("top").alias("top"))
    held = inside.filter("lid is not null").hint("merge").join(high.hint("merge"), "lid").select("i", "j", "top")
    return corners.select("i", "j").hint("merge").join(held.hint("merge"), ["i", "j"], "left").select("i", "j", "top")


def dedupe_faces(faces: DataFrame, geometry: list[str], key: str) -> DataFrame:
    """Of faces of one geometry that of the smallest key."""
    return faces.groupBy(*geometry).agg(F.min(key).alias(key)).select(key, *geometry)


def face_classes(faces: DataFrame, cells: DataFrame, dom: Domain) -> DataFrame:
    """fid, kind (vegetation, pavement, water, building) and class of the cell below each face's centre."""
    i, j = gr.cell_of((F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2, dom)
    kind = F.coalesce(*[F.when(class_range(k), k) for k in ("vegetation", "pavement", "water", "building")])
    return faces.select("fid", i.alias("i"), j.alias("j")).join(cells.select("i", "j", "type"), ["i", "j"], "left").select("fid", kind.alias("kind"), (F.col("type") % 100).alias("class"))


def face_type_check(classes: DataFrame) -> DataFrame:
    """fid of faces without a fitting class."""
    return classes.filter("kind is null or class is null").select("fid")
