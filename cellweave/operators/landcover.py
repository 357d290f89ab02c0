"""Land cover: classes, overlay by priority, corrections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellweave import domain as dm
from cellweave.operators.spatial import nearest_box
from cellweave.session import cut


def standardize_columns(df: DataFrame, mapping: dict[str, str], necessary: list[str]) -> DataFrame:
    """Rename by mapping; an absent necessary column is an error."""
    out = df.withColumnsRenamed({a: b for a, b in mapping.items() if a in df.columns})
    if missing := [c for c in necessary if c not in out.columns]:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    return out


def assert_inputs(tables: dict[str, DataFrame | None]) -> None:
    """Fail once, naming every table that is missing or empty."""
    if bad := [n for n, t in tables.items() if t is None or t.isEmpty()]:
        raise ValueError(f"missing or empty inputs: {', '.join(sorted(bad))}")


def load_lookup(df: DataFrame, key: str) -> DataFrame:
    """A lookup table, checked for unique keys."""
    if not df.groupBy(key).count().filter("count > 1").isEmpty():
        raise ValueError(f"{key} is not unique")
    return df


def extent(boxes: DataFrame) -> DataFrame:
    return boxes.agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


def clip_to_extent(boxes: DataFrame, x0: float, y0: float, x1: float, y1: float) -> DataFrame:
    """Features whose box meets the box."""
    return boxes.filter((F.col("x1") > x0) & (F.col("x0") < x1) & (F.col("y1") > y0) & (F.col("y0") < y1))


def map_types(df: DataFrame, codes: DataFrame, is_street: Column, default: int = dm.DEFAULT_TYPE) -> DataFrame:
    """``type`` by code, from the land or the street column; the code table has one row per class."""
    kind = F.coalesce(F.when(is_street, F.col("type_street")).otherwise(F.col("type_land")), F.lit(default))
    return df.join(F.broadcast(codes.select("code", "type_land", "type_street")), "code", "left").withColumn("type", kind.cast("int")).drop("type_land", "type_street")


def typed_landcover(type_: Column, is_street: Column) -> Column:
    """Class of land cover that comes with classes: kept; street-map polygons take the default building class, polygons without a class the default one."""
    return F.coalesce(F.when(is_street, F.lit(dm.DEFAULT_STREET)).otherwise(type_), F.lit(dm.DEFAULT_TYPE)).cast("int")


def overlay(layers: DataFrame) -> DataFrame:
    """i, j and the row of highest priority (then lowest lid) of each cell: one layer cut out of another."""
    return layers.withColumn("_n", F.row_number().over(W.partitionBy("i", "j").orderBy("priority", "lid"))).filter("_n = 1").drop("_n", "priority")


def impervious(type_: Column, value: Column, least: float = 50.0) -> Column:
    """Sealed class with a low sealed share becomes vegetation."""
    return F.when((type_ == dm.SEALED) & (value <= least), dm.VEGETATION + 3).otherwise(type_)


def adjacent_pairs(boxes: DataFrame, d: float) -> DataFrame:
    """a < b of boxes at most d apart; each box is put in all buckets that it touches when grown by d."""
    size = 40.0 + d
    keyed = boxes.select("gid", "x0", "y0", "x1", "y1")
    keyed = keyed.withColumn("bx", F.explode(F.sequence(F.floor((F.col("x0") - d) / size).cast("int"), F.floor((F.col("x1") + d) / size).cast("int"))))
    keyed = keyed.withColumn("by", F.explode(F.sequence(F.floor((F.col("y0") - d) / size).cast("int"), F.floor((F.col("y1") + d) / size).cast("int"))))
    a, b = keyed.alias("a"), keyed.alias("b")
    gap = lambda lo, hi: F.greatest(F.lit(0.0), F.col("a." + lo) - F.col("b." + hi), F.col("b." + lo) - F.col("a." + hi))
    near = gap("x0", "x1") * gap("x0", "x1") + gap("y0", "y1") * gap("y0", "y1") <= d * d
    pairs = a.join(b, (F.col("a.bx") == F.col("b.bx")) & (F.col("a.by") == F.col("b.by")) & (F.col("a.gid") < F.col("b.gid"))).filter(near)
    return pairs.select(F.col("a.gid").alias("a"), F.col("b.gid").alias("b")).distinct()


def wall_segments(edges: DataFrame, seg: float) -> DataFrame:
    """gid, edge, part and ends of the pieces of edges, each at most ``seg`` long."""
    length = F.sqrt(F.pow(F.col("xb") - F.col("xa"), 2.0) + F.pow(F.col("yb") - F.col("ya"), 2.0))
    e = edges.withColumn("n", F.greatest(F.lit(1), F.ceil(length / seg)).cast("int"))
    e = e.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    at = lambda a, b, k: F.col(a) + (F.col(b) - F.col(a)) * (F.col("part") + k) / F.col("n")
    return e.select("gid", "edge", "part", at("xa", "xb", 0).alias("sx"), at("ya", "yb", 0).alias("sy"), at("xa", "xb", 1).alias("ex"), at("ya", "yb", 1).alias("ey"))


def smooth_corners(points: DataFrame, low: float = 105.0, high: float = 245.0, least: float = 1.7) -> DataFrame:
    """gid, at, x, y of one pass: points whose inner angle lies between the bounds and whose neighbours are over ``least`` apart; rings left with fewer than 4 points go."""
    w = W.partitionBy("gid").orderBy("at")
    whole = W.partitionBy("gid")
    edge = lambda f, c, end: F.coalesce(f(c).over(w), end(F.struct("at", c)).over(whole)[c])
    p = points.select("gid", "at", "x", "y", edge(F.lag, "x", F.max).alias("px"), edge(F.lag, "y", F.max).alias("py"), edge(F.lead, "x", F.min).alias("nx"), edge(F.lead, "y", F.min).alias("ny"))
    turn = F.degrees(F.atan2(F.col("py") - F.col("y"), F.col("px") - F.col("x")) - F.atan2(F.col("ny") - F.col("y"), F.col("nx") - F.col("x")))
    angle = F.pmod(turn + 360.0, F.lit(360.0))
    far = F.sqrt(F.pow(F.col("nx") - F.col("px"), 2.0) + F.pow(F.col("ny") - F.col("py"), 2.0)) > least
    kept = p.filter((angle >= low) & (angle <= high) & far).select("gid", "at", "x", "y")
    return kept.withColumn("n", F.count("*").over(whole)).filter("n >= 4").drop("n")


def fill_courtyards(types: DataFrame, pairs: DataFrame, areas: DataFrame, most: float) -> DataFrame:
    """gid, type after one round: a small polygon whose neighbours are all buildings takes the lowest neighbour class."""
    both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    n = both.join(types.select(F.col("gid").alias("b"), F.col("type").alias("n_type")), "b").groupBy("a").agg(F.min("n_type").alias("to"), F.count_if(F.col("n_type") < dm.BUILDING).alias("open"))
    n = n.filter("open = 0").join(areas.filter(F.col("area") < most).select(F.col("gid").alias("a")), "a").select(F.col("a").alias("gid"), "to")
    return types.join(n, "gid", "left").select("gid", F.when(F.col("type") < dm.BUILDING, F.coalesce("to", "type")).otherwise(F.col("type")).alias("type"))


def fill_courtyards_all(types: DataFrame, pairs: DataFrame, areas: DataFrame, most: float, rounds: int = 100) -> DataFrame:
    """Rounds of ``fill_courtyards`` until nothing changes; polygons only become buildings, so it ends. An error if ``rounds`` are not enough."""
    for _ in range(rounds):
        new = cut(fill_courtyards(types, pairs, areas, most))
        if new.join(types.withColumnRenamed("type", "was"), "gid").filter("type <> was").isEmpty():
            return new
        types = new
    raise RuntimeError(f"not still after {rounds} rounds")


def fill_isolated(polys: DataFrame, cells: DataFrame, most: int, touch: float = 1e-5) -> DataFrame:
    """gid, type, filled: polygons of no building that touch no other such polygon and hold fewer than ``most`` cells take the type of the nearest building."""
    polys = cut(polys.select("gid", "type", "x0", "y0", "x1", "y1"))
    land, built = polys.filter(F.col("type") < dm.BUILDING), polys.filter(F.col("type") >= dm.BUILDING)
    pairs = adjacent_pairs(land, touch)
    alone = land.join(pairs.select(F.col("a").alias("gid")).unionByName(pairs.select(F.col("b").alias("gid"))), "gid", "left_anti")
    small = cells.groupBy(F.col("lid").alias("gid")).count().filter(F.col("count") < most)
    near = nearest_box(alone.join(small, "gid", "left_semi"), built, 40.0)
    new = near.join(built.select(F.col("gid").alias("near"), F.col("type").alias("new")), "near").select("gid", "new")
    return polys.join(new, "gid", "left").select("gid", F.coalesce("new", "type").alias("type"), F.col("new").isNotNull().alias("filled"))
