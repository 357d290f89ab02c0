"""Readers of vector layers: attributes beside geometry as WKB, GeoJSON or nested rings."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What a geometry is read into: kind, reference system (0: none), and its rings with the part that each belongs to.
POINT = T.StructType().add("x", "double").add("y", "double")
GEOMETRY = T.StructType().add("kind", "string").add("srid", "integer").add("parts", T.ArrayType(T.IntegerType())).add("rings", T.ArrayType(T.ArrayType(POINT)))
#: Geometry codes of the format.
KINDS = {1: "point", 2: "line", 3: "polygon", 4: "point", 5: "line", 6: "polygon"}


def _geometry(data: bytes, at: int, srid: int, out: list, part: int) -> tuple[int, int, int, str]:
    """Reads one geometry; (next byte, next part, srid, kind). Points of rings go to ``out`` as (part, xy)."""
    order = "<" if data[at] == 1 else ">"
    (code,) = struct.unpack_from(order + "I", data, at + 1)
    at += 5
    if code & 0x20000000:
        (srid,) = struct.unpack_from(order + "I", data, at)
        at += 4
    wide = 2 + bool(code & 0x80000000) + bool(code & 0x40000000)
    code &= 0x0FFFFFFF
    wide, code = wide + (0, 1, 1, 2)[code // 1000], code % 1000

    def count(at: int) -> tuple[int, int]:
        return at + 4, struct.unpack_from(order + "I", data, at)[0]

    def points(at: int, n: int) -> tuple[int, np.ndarray]:
        xy = np.frombuffer(data, order + "f8", n * wide, at).reshape(n, wide)[:, :2]
        return at + 8 * n * wide, xy

    if code == 1:
        at, xy = points(at, 1)
        if not np.isnan(xy).any():  # not-a-number stands for an empty point
            out.append((part, xy))
        return at, part + 1, srid, KINDS[1]
    if code == 2:
        at, n = count(at)
        at, xy = points(at, n)
        if n:
            out.append((part, xy))
        return at, part + 1, srid, KINDS[2]
    if code == 3:
        at, rings = count(at)
        for k in range(rings):
            at, n = count(at)
            at, xy = points(at, n)
            if n and (xy[0] == xy[-1]).all():
                xy = xy[:-1]
            if len(xy) >= 3:
                x, y = xy[:, 0] - xy[0, 0], xy[:, 1] - xy[0, 1]
                left = (x * np.roll(y, -1) - np.roll(x, -1) * y).sum() > 0
                out.append((part, xy if left == (k == 0) else xy[::-1]))
        return at, part + 1, srid, KINDS[3]
    if code in KINDS:
        at, n = count(at)
        for _ in range(n):
            at, part, srid, _ = _geometry(data, at, srid, out, part)
        return at, part, srid, KINDS[code]
    raise ValueError(f"geometry code {code}")


def read_wkb(data: bytes | None) -> tuple:
    """(kind, srid, parts, rings); bytes that are no point, line or polygon, or end early, are of kind ``invalid``."""
    if data is None:
        return None, None, None, None
    out: list = []
    try:
        _, _, srid, kind = _geometry(bytes(data), 0, 0, out, 0)
    except (ValueError, IndexError, struct.error):
        return "invalid", None, None, None
    return kind, srid, [p for p, _ in out], [[{"x": float(x), "y": float(y)} for x, y in xy] for _, xy in out]


@F.pandas_udf(GEOMETRY)
def _wkb(blobs: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for b in blobs:
        yield pd.DataFrame([read_wkb(v) for v in b], columns=["kind", "srid", "parts", "rings"])


def from_wkb(geom: Column) -> Column:
    """Well-known binary (either byte order, with or without heights, measures and reference system) as a struct of kind, srid, parts, rings."""
    return _wkb(geom)


def _ring(points: Column, outer: Column) -> Column:
    """A closed ring of [x, y, ...] as points without the closing one; outer rings to the left, holes to the right."""
    p = F.transform(points, lambda c: F.struct(F.get(c, F.lit(0)).alias("x"), F.get(c, F.lit(1)).alias("y")))
    p = F.when(F.element_at(p, 1) == F.element_at(p, -1), F.slice(p, F.lit(1), F.size(p) - 1)).otherwise(p)
    origin = lambda v: (v["x"] - F.element_at(p, 1)["x"], v["y"] - F.element_at(p, 1)["y"])

    def cross(a: Column, b: Column) -> Column:
        (ax, ay), (bx, by) = origin(a), origin(b)
        return ax * by - bx * ay

    turned = F.concat(F.slice(p, 2, F.size(p)), F.slice(p, 1, 1))
    left = F.aggregate(F.zip_with(p, turned, cross), F.lit(0.0), lambda t, v: t + v) > 0
    return F.when(left == outer, p).otherwise(F.reverse(p))


def from_geojson(geom: Column) -> Column:
    """A GeoJSON geometry (text) as a struct of kind, srid, parts, rings. Polygons and multipolygons; anything else is of kind ``invalid``."""
    kind, at = F.get_json_object(geom, "$.type"), F.get_json_object(geom, "$.coordinates")
    many = F.when(kind == "MultiPolygon", F.from_json(at, "array<array<array<array<double>>>>")).when(kind == "Polygon", F.array(F.from_json(at, "array<array<array<double>>>")))
    made = F.flatten(F.transform(many, lambda rings, part: F.transform(rings, lambda r, n: F.struct(part.cast("int").alias("part"), _ring(r, n == 0).alias("ring")))))
    made = F.filter(made, lambda r: F.size(r["ring"]) >= 3)
    ok = made.isNotNull()
    s = F.struct(F.when(ok, "polygon").otherwise("invalid").alias("kind"), F.when(ok, 4326).alias("srid"), F.transform(made, lambda r: r["part"]).alias("parts"), F.transform(made, lambda r: r["ring"]).alias("rings"))
    return F.when(geom.isNotNull(), s)


def read_features(spark: SparkSession, path: str, fmt: str = "parquet", geometry: str = "geom", encoding: str = "wkb", schema: str | None = None, **options: str) -> DataFrame:
    """A vector layer: its attributes, then kind, srid, parts and rings instead of the geometry column.

    ``encoding``: wkb, geojson or rings (nested arrays already). Null geometries keep their row with null rings. ``srid`` is
    what the geometry says (GeoJSON: 4326; nested arrays: none). Columns named like the four new ones are not allowed.
    """
    r = spark.read.format(fmt).options(**options)
    df = (r.schema(schema) if schema else r).load(path)
    if geometry not in df.columns:
        raise ValueError(f"no column {geometry} in {path}")
    if clash := {"kind", "srid", "parts", "rings"} & set(df.columns) - {geometry}:
        raise ValueError(f"columns {sorted(clash)} clash with the geometry's")
    if encoding == "rings":
        g = F.col(geometry)
        made = F.struct(F.when(g.isNotNull(), "polygon").alias("kind"), F.lit(0).alias("srid"), F.transform(g, lambda _: F.lit(0)).alias("parts"), g.alias("rings"))
    else:
        made = {"wkb": from_wkb, "geojson": from_geojson}[encoding](F.col(geometry))
    return df.withColumn("_g", made).select(*[c for c in df.columns if c != geometry], "_g.kind", "_g.srid", "_g.parts", "_g.rings")


def reproject_rings(df: DataFrame, to: Callable[[Column, Column], tuple[Column, Column]], rings: str = "rings") -> DataFrame:
    """Rings with each point moved by ``to(x, y)``."""

    def moved(p: Column) -> Column:
        x, y = to(p["x"], p["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    return df.withColumn(rings, F.transform(rings, lambda r: F.transform(r, moved)))
