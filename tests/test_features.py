"""Readers of vector layers, and the European equal-area projection."""

import json
import random
import struct

import pytest
from pyspark.sql import functions as F

from cellweave.operators import edges as ed
from cellweave.operators import grid
from cellweave.sources import features as ft

SQUARE = [(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (0.0, 9.0)]
HOLE = [(2.0, 2.0), (4.0, 2.0), (4.0, 5.0), (2.0, 5.0)]


def wkb(code, body, order="<", srid=None, extra=0, iso=0):
    flags = (0x20000000 if srid else 0) | extra
    return bytes([order == "<"]) + struct.pack(order + "I", (code + iso) | flags) + (struct.pack(order + "I", srid) if srid else b"") + body


def polygon(rings, order="<", width=2, **how):
    body = struct.pack(order + "I", len(rings))
    for r in rings:
        closed = r + r[:1]
        body += struct.pack(order + "I", len(closed)) + b"".join(struct.pack(order + f"{width}d", *p, *[7.0] * (width - 2)) for p in closed)
    return wkb(3, body, order, **how)


def many(code, parts, order="<"):
    return wkb(code, struct.pack(order + "I", len(parts)) + b"".join(parts), order)


def rings(row):
    return [[tuple(p) for p in r] for r in row["rings"]]


CASES = {
    1: polygon([SQUARE, HOLE]), 2: polygon([SQUARE[::-1], HOLE], ">"), 3: polygon([SQUARE, HOLE], srid=3035), 4: polygon([SQUARE, HOLE], width=3, extra=0x80000000),
    5: polygon([SQUARE, HOLE], width=3, iso=1000), 6: polygon([SQUARE, HOLE], ">", width=4, iso=3000), 7: many(6, [polygon([SQUARE]), polygon([HOLE], ">")]),
    8: wkb(1, struct.pack("<2d", 3, 4)), 9: wkb(2, struct.pack("<I4d", 2, 0, 0, 5, 5)), 10: None, 11: b"\x01\x03", 12: many(7, []), 13: many(6, []), 14: b"",
}


def test_wkb(spark, tmp_path):
    spark.createDataFrame([(k, bytearray(v) if v is not None else None) for k, v in CASES.items()], "id int, geom binary").write.parquet(str(tmp_path / "layer"))
    got = {r["id"]: r for r in ft.read_features(spark, str(tmp_path / "layer")).collect()}
    for k in range(1, 7):  # outer rings to the left, holes to the right, closing points gone
        outer, hole = rings(got[k])
        assert sorted(outer) == sorted(SQUARE) and sorted(hole) == sorted(HOLE) and got[k]["kind"] == "polygon"
        area = lambda r: sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:] + r[:1])) / 2
        assert (area(outer), area(hole)) == (81, -6)
    assert got[3]["srid"] == 3035 and got[1]["srid"] == 0
    assert got[7]["parts"] == [0, 1] and len(rings(got[7])) == 2
    assert (got[8]["kind"], rings(got[8])) == ("point", [[(3.0, 4.0)]]) and (got[9]["kind"], rings(got[9])) == ("line", [[(0.0, 0.0), (5.0, 5.0)]])
    assert got[10]["kind"] is None and got[10]["rings"] is None
    assert {got[k]["kind"] for k in (11, 12, 14)} == {"invalid"} and got[13]["rings"] == []


def test_geojson_equals_wkb(spark, tmp_path):
    closed = lambda r: [list(p) for p in r + r[:1]]
    shapes = [{"type": "Polygon", "coordinates": [closed(SQUARE), closed(HOLE)]}, {"type": "MultiPolygon", "coordinates": [[closed(SQUARE[::-1])], [closed(HOLE)]]}]
    rows = [(k, json.dumps(v)) for k, v in enumerate(shapes)] + [(2, None), (3, '{"type": "Point", "coordinates": [1, 2]}'), (4, "no json")]
    spark.createDataFrame(rows, "id int, geom string").write.json(str(tmp_path / "layer"))
    df = ft.read_features(spark, str(tmp_path / "layer"), "json", encoding="geojson", schema="id int, geom string")
    got = {r["id"]: r for r in df.collect()}
    area = {r["gid"]: r["area"] for r in ed.areas(ed.explode_rings(df.filter("kind = 'polygon'"), "id")).collect()}
    assert area == {0: 75.0, 1: 87.0}
    assert got[1]["parts"] == [0, 1] and got[2]["kind"] is None and got[3]["kind"] == got[4]["kind"] == "invalid"


def test_layers_that_cannot_be_read(spark, tmp_path):
    spark.createDataFrame([(1, 2, bytearray(b""))], "id int, kind int, geom binary").write.parquet(str(tmp_path / "layer"))
    with pytest.raises(ValueError, match="clash"):
        ft.read_features(spark, str(tmp_path / "layer"))
    with pytest.raises(ValueError, match="no column"):
        ft.read_features(spark, str(tmp_path / "layer"), geometry="shape")


def test_equal_area_projection(spark):
    at = lambda lon, lat: spark.range(1).select(*[c.alias(n) for c, n in zip(grid.lonlat_to_laea(F.lit(lon), F.lit(lat)), "en")]).first()
    known = at(5.0, 50.0)  # published example of the projection
    assert known["e"] == pytest.approx(3962799.45, abs=0.01) and known["n"] == pytest.approx(2999718.85, abs=0.01)
    assert tuple(at(10.0, 52.0)) == pytest.approx((4321000, 3210000), abs=1e-6)
    rnd = random.Random(1)
    pts = spark.createDataFrame([(rnd.uniform(-15, 40), rnd.uniform(34, 71)) for _ in range(500)] + [(10.0, 52.0), (10.0, 60.0), (25.0, 52.0)], "lon double, lat double")
    e, n = grid.lonlat_to_laea(F.col("lon"), F.col("lat"))
    lon, lat = grid.laea_to_lonlat(F.col("e"), F.col("n"))
    worst = pts.withColumn("e", e).withColumn("n", n).select(F.max(F.greatest(F.abs(lon - F.col("lon")), F.abs(lat - F.col("lat")))).alias("w")).first()["w"]
    assert worst < 1e-8


def test_rings_are_moved(spark):
    df = spark.createDataFrame([(1, [[(12.0, 50.0), (12.1, 50.0), (12.1, 50.1)]]), (2, None)], "id int, rings array<array<struct<x:double,y:double>>>")
    there = ft.reproject_rings(df, grid.lonlat_to_laea)
    back = {r["id"]: r["rings"] for r in ft.reproject_rings(there, grid.laea_to_lonlat).collect()}
    assert back[2] is None and [p["x"] for p in back[1][0]] == pytest.approx([12.0, 12.1, 12.1], abs=1e-9)
