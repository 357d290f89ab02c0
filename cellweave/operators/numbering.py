"""Running numbers without gaps over a whole table, without one task seeing all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellweave.session import cut, shuffle_parts


def number_rows(df: DataFrame, keys: list[str], name: str, start: int = 1) -> DataFrame:
    """``df`` with ``name`` = place in the order of ``keys``; only a count for each range goes to the driver."""
    spark = df.sparkSession
    ranged = cut(df.repartitionByRange(shuffle_parts(spark), *keys).withColumn("_range", F.spark_partition_id()))
    counts = sorted((r["_range"], r["count"]) for r in ranged.groupBy("_range").count().collect())
    offsets, at = {}, start
    for k, n in counts:
        offsets[k], at = at, at + n
    offset = F.element_at(F.create_map(*[F.lit(x) for kv in offsets.items() for x in kv]), F.col("_range")) if offsets else F.lit(0)
    w = W.partitionBy("_range").orderBy(*keys)
    return ranged.withColumn(name, (F.row_number().over(w) - 1 + offset).cast("int")).drop("_range")


def ensure_unique_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``df`` with ``key`` made unique: if any repeats, all rows are numbered anew and the old key is kept as ``old_<key>``."""
    if df.groupBy(key).count().filter("count > 1").isEmpty():
        return df.withColumn("old_" + key, F.col(key))
    return number_rows(df.withColumnRenamed(key, "old_" + key), ["old_" + key, *order], key)
