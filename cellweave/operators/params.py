"""Parameter variables of cells, all from one specification, and checks on the long cube (the variables of SPEC; Q-A to Q-E without the attributes of Q-D and the first mismatches of Q-E)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave import domain as dm


def class_range(kind: str) -> Column:
    """Cells of a surface kind; the upper bound is exclusive."""
    lo, hi = {"vegetation": (dm.VEGETATION, dm.PAVEMENT), "pavement": (dm.PAVEMENT, dm.WATER), "water": (dm.WATER, 400), "building": (dm.BUILDING, dm.END)}[kind]
    return (F.col("type") >= lo) & (F.col("type") < hi)


def variables(cells: DataFrame, spec: list[tuple[str, str | None, str]]) -> DataFrame:
    """var, j, i, value of every (name, kind or None, formula): one pass over the joined cells, nulls left out."""
    items = [F.struct(F.lit(n).alias("var"), (F.when(class_range(k), F.expr(f)) if k else F.expr(f)).cast("double").alias("value")) for n, k, f in spec]
    return cells.select("j", "i", F.explode(F.array(*items)).alias("v")).select("v.var", "j", "i", "v.value").filter("value is not null")


#: Name, surface kind, formula over cell, class and material columns.
SPEC = [
    ("zt", None, "nz * 5.0"),
    ("vegetation_type", "vegetation", "type - 100"),
    ("pavement_type", "pavement", "type - 200"),
    ("water_type", "water", "type - 300"),
    ("soil_type", None, "case when type >= 100 and type < 300 then 3 end"),
    ("building_type", "building", "type - 900"),
    ("building_id", "building", "lid"),
    ("albedo", None, "albedo"),
    ("emissivity", None, "emissivity"),
    ("roughness_pavement", "pavement", "roughness"),
    ("heat_capacity_building", "building", "capacity_surf"),
    ("window_fraction", "building", "least(0.95, lid % 11 / 10.0)"),
    ("wall_fraction", "building", "case when lid % 11 > 9 then 0.05 else (10 - lid % 11) / 10.0 end"),
]


def repair_untyped(cells: DataFrame) -> DataFrame:
    """Cells without any class get the default pavement."""
    return cells.withColumn("type", F.coalesce("type", F.lit(dm.SEALED)))


def bounds_report(cube: DataFrame, bounds: DataFrame) -> DataFrame:
    """var, lo, hi, ok: range of each variable against its limits (a short table)."""
    r = cube.groupBy("var").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    return r.join(F.broadcast(bounds), "var").select("var", "lo", "hi", ((F.col("lo") >= F.col("least")) & (F.col("hi") <= F.col("most"))).alias("ok"))


# Variables that every cube has to hold, and those that it holds besides where buildings are included.
REQUIRED = ["x", "y", "crs", "lat", "lon", "E_UTM", "N_UTM", "zt", "vegetation_type", "pavement_type", "water_type", "soil_type"]
REQUIRED_BUILDINGS = ["buildings_2d", "building_id"]


def required_variables(cube: DataFrame, buildings: bool = False) -> DataFrame:
    """var, n, ok: number of values of each required variable; without any it is missing and not ok."""
    names = REQUIRED + (REQUIRED_BUILDINGS if buildings else [])
    n = cube.filter(F.col("var").isin(names)).groupBy("var").agg(F.count("*").alias("n"))
    required = cube.sparkSession.createDataFrame([(v,) for v in names], "var string")
    out = required.join(n, "var", "left").select("var", F.coalesce("n", F.lit(0)).alias("n"))
    return out.withColumn("ok", F.col("n") > 0)


def compare_cubes(a: DataFrame, b: DataFrame, tol: float) -> DataFrame:
    """var, only_a, only_b, differing: presence and values of two cubes."""
    k = ["var", "j", "i"]
    m = a.withColumnRenamed("value", "x").join(b.withColumnRenamed("value", "y"), k, "full")
    return m.groupBy("var").agg(F.count_if(F.col("y").isNull()).alias("only_a"), F.count_if(F.col("x").isNull()).alias("only_b"), F.count_if(F.abs(F.col("x") - F.col("y")) > tol).alias("differing"))
