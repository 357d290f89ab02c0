"""The cube in files (S13): Parquet, one folder a variable, and attributes as JSON lines."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.session import cut, discard


def write_cube(cube: DataFrame, cells: DataFrame, names: list[str], path: str, attributes: dict[str, dict], fill: float = -9999.0) -> None:
    """Each variable whole over the grid (absent cells take ``fill``), one folder a variable, and attributes as JSON lines.

    The values of a cell meet in one row before they are shuffled; each variable is then written from its own column,
    so no task sorts rows of all variables.
    """
    spark = cube.sparkSession
    rows = cells.select("j", "i", F.lit(True).alias("own")).unionByName(cube.select("j", "i", "var", "value"), allowMissingColumns=True)
    values = [F.max(F.when(F.col("var") == v, F.col("value"))).alias(f"v{n}") for n, v in enumerate(names)]
    wide = cut(rows.groupBy("j", "i").agg(F.max("own").alias("own"), *values).filter("own").drop("own"))
    full = [wide.select("j", "i", F.coalesce(f"v{n}", F.lit(fill)).alias("value"), F.lit(v).alias("var")) for n, v in enumerate(names)]
    reduce(DataFrame.unionAll, full).write.mode("overwrite").partitionBy("var").parquet(f"{path}/values")
    discard(wide)
    rows = [(v, json.dumps({"_FillValue": fill, **attributes.get(v, {})}, sort_keys=True)) for v in names]
    spark.createDataFrame(rows, "var string, attributes string").coalesce(1).write.mode("overwrite").json(f"{path}/attributes")


def read_cube(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("j int, i int, value double, var string").parquet(f"{path}/values").select("var", "j", "i", "value")
