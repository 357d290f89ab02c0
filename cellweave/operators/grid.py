"""Grid generation and projection."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.domain import Domain


def make_grid(spark: SparkSession, dom: Domain) -> DataFrame:
    """One row per cell, i outer and j inner, ids from 1; all from a distributed range."""
    n = F.col("n")
    g = spark.range(dom.nx * dom.ny).withColumnRenamed("id", "n")
    g = g.select((n + 1).cast("int").alias("id"), F.floor(n / dom.ny).cast("int").alias("i"), (n % dom.ny).cast("int").alias("j"))
    x, y = F.lit(dom.origin_x) + F.col("i") * dom.dx, F.lit(dom.origin_y) + F.col("j") * dom.dy
    return g.select("id", "i", "j", x.alias("xmi"), (x + dom.dx).alias("xma"), y.alias("ymi"), (y + dom.dy).alias("yma"), (x + dom.dx / 2).alias("xcen"), (y + dom.dy / 2).alias("ycen"))


def located(cells: DataFrame, dom: Domain) -> DataFrame:
    """Cells (i, j) with id, xcen and ycen as ``make_grid`` has them, computed and not joined."""
    x, y = F.lit(dom.origin_x) + F.col("i") * dom.dx, F.lit(dom.origin_y) + F.col("j") * dom.dy
    number = F.col("i").cast("long") * dom.ny + F.col("j") + 1
    return cells.withColumns({"id": number.cast("int"), "xcen": x + dom.dx / 2, "ycen": y + dom.dy / 2})


def make_fishnet(spark: SparkSession, x0: float, y0: float, x1: float, y1: float, dx: float, dy: float) -> DataFrame:
    """A coarse grid that covers a box."""
    return make_grid(spark, Domain(math.ceil((x1 - x0) / dx), math.ceil((y1 - y0) / dy), dx, dy, dx, x0, y0))


def cell_of(x: Column, y: Column, dom: Domain) -> tuple[Column, Column]:
    """Cell indices of a point."""
    return F.floor((x - dom.origin_x) / dom.dx).cast("int"), F.floor((y - dom.origin_y) / dom.dy).cast("int")


def vertical_index(height: Column, origin_z: Column | float, dz: float) -> Column:
    """Level of a height: nearest, halves to even."""
    return F.rint((height - origin_z) / dz).cast("int")


#: WGS84 semi-major axis and flattening, UTM scale and false easting.
A, FLAT, K0, EASTING = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0


def _series() -> tuple[float, float, list[float], list[float]]:
    """Rectifying radius, eccentricity and the third-order Krueger coefficients, forward and back."""
    n = FLAT / (2 - FLAT)
    radius = A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    forward = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240]
    back = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480]
    return radius, 2 * math.sqrt(n) / (1 + n), forward, back


def lonlat_to_utm(lon: Column, lat: Column, zone: int) -> tuple[Column, Column]:
    """Easting and northing (north of the equator) in a UTM zone, degrees in."""
    radius, e, alpha, _ = _series()
    phi, lam = F.radians(lat), F.radians(lon - (zone * 6 - 183))
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - e * F.atanh(e * s))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    east = eta + sum(a * F.cos(2 * k * xi) * F.sinh(2 * k * eta) for k, a in enumerate(alpha, 1))
    north = xi + sum(a * F.sin(2 * k * xi) * F.cosh(2 * k * eta) for k, a in enumerate(alpha, 1))
    return EASTING + K0 * radius * east, K0 * radius * north


def utm_to_lonlat(east: Column, north: Column, zone: int) -> tuple[Column, Column]:
    """Longitude and latitude in degrees."""
    radius, e, _, beta = _series()
    xi, eta = north / (K0 * radius), (east - EASTING) / (K0 * radius)
    x = xi - sum(b * F.sin(2 * k * xi) * F.cosh(2 * k * eta) for k, b in enumerate(beta, 1))
    y = eta - sum(b * F.cos(2 * k * xi) * F.sinh(2 * k * eta) for k, b in enumerate(beta, 1))
    chi = F.asin(F.sin(x) / F.cosh(y))
    q, s = F.atanh(F.sin(chi)), F.sin(chi)
    for _ in range(6):  # isometric latitude back to latitude
        s = F.tanh(q + e * F.atanh(e * s))
    return F.degrees(F.atan2(F.sinh(y), F.cos(x))) + (zone * 6 - 183), F.degrees(F.asin(s))


#: GRS80 flattening (its semi-major axis is A), centre of the European equal-area system in degrees, false easting and northing.
GRS80, LAEA_LON, LAEA_LAT, LAEA_E, LAEA_N = 1 / 298.257222101, 10.0, 52.0, 4321000.0, 3210000.0


def _laea() -> tuple[float, float, float, float, float, float]:
    """e, area term of the pole, radius of the equal-area sphere, sine and cosine of the authalic centre, and the stretch that makes the centre true."""
    e = math.sqrt(GRS80 * (2 - GRS80))
    term = lambda s: (1 - e * e) * (s / (1 - e * e * s * s) + math.atanh(e * s) / e)
    pole, s0 = term(1.0), math.sin(math.radians(LAEA_LAT))
    radius, sb = A * math.sqrt(pole / 2), term(s0) / pole
    cb = math.sqrt(1 - sb * sb)
    return e, pole, radius, sb, cb, A * math.cos(math.radians(LAEA_LAT)) / math.sqrt(1 - e * e * s0 * s0) / (radius * cb)


def lonlat_to_laea(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Easting and northing in the European equal-area system, degrees in."""
    e, pole, radius, sb0, cb0, d = _laea()
    s, lam = F.sin(F.radians(lat)), F.radians(lon - LAEA_LON)
    sb = (1 - e * e) * (s / (1 - e * e * s * s) + F.atanh(e * s) / e) / pole
    cb = F.sqrt(F.greatest(F.lit(0.0), 1 - sb * sb))
    b = radius * F.sqrt(2 / (1 + sb0 * sb + cb0 * cb * F.cos(lam)))
    return LAEA_E + b * d * cb * F.sin(lam), LAEA_N + b / d * (cb0 * sb - sb0 * cb * F.cos(lam))


def laea_to_lonlat(east: Column, north: Column) -> tuple[Column, Column]:
    """Longitude and latitude in degrees; the latitude of equal area is turned back by Newton's steps."""
    e, pole, radius, sb0, cb0, d = _laea()
    x, y = (east - LAEA_E) / d, (north - LAEA_N) * d
    rho = F.sqrt(x * x + y * y)
    far = F.when(rho == 0, 1.0).otherwise(rho)
    c = 2 * F.asin(rho / (2 * radius))
    sb = F.cos(c) * sb0 + y * F.sin(c) * cb0 / far
    lon = LAEA_LON + F.degrees(F.atan2(x * F.sin(c), far * cb0 * F.cos(c) - y * sb0 * F.sin(c)))
    q = sb * pole / (1 - e * e)
    phi = F.asin(sb)
    for _ in range(3):
        s = F.sin(phi)
        w = 1 - e * e * s * s
        phi = phi + w * w / (2 * F.cos(phi)) * (q - s / w - F.atanh(e * s) / e)
    return F.when(rho == 0, LAEA_LON).otherwise(lon), F.degrees(phi)
