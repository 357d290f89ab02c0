"""The check of closed surfaces by corners: one shuffle, the same rows as the check of a numbered index."""

import random

import pytest
from pyspark.sql import functions as F

from cellweave.domain import Domain
from cellweave.operators import faces as fc
from cellweave.plans.grid_queries import QUERIES

DOM = Domain(6, 5, 10.0, 8.0, 5.0, 100.0, -40.0)
SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def surface(spark, seed):
    """Faces of a rough terrain with corners on levels, some turned, bent, closed twice, pulled off the lattice or unknown."""
    rnd = random.Random(seed)
    z = {(i, j): rnd.choice([rnd.uniform(-7, 24), 5.0 * rnd.randrange(-1, 4)]) for i in range(DOM.nx + 1) for j in range(DOM.ny + 1)}
    corners = spark.createDataFrame([(i, j, v) for (i, j), v in z.items()], "i int, j int, z double")
    rows = fc.slice_faces(fc.terrain_faces(corners, DOM), DOM.dz).collect()
    made = []
    for n, r in enumerate(sorted(rows, key=lambda r: (r["i"], r["j"], r["k"]))):
        ring = [tuple(v) for v in r["verts"]]
        kind = rnd.randrange(12)
        if kind == 0:
            ring = ring[::-1]
        elif kind == 1:
            ring.append(ring[0])
        elif kind == 2:
            ring[1] = (ring[1][0] + 30.0, ring[1][1] + 16.0, ring[1][2])
        elif kind == 3:
            ring[0] = (ring[0][0] + 0.3, ring[0][1] + 0.3, ring[0][2] + 0.01)
        elif kind == 4:
            ring[2] = (ring[2][0], ring[2][1], None)
        elif kind == 5:
            ring = ring[:1]
        made.append((n, ring, rnd.random() < 0.8))
    return spark.createDataFrame([*made, (9001, None, True), (9002, [], True)], "fid int, verts array<struct<x: double, y: double, z: double>>, here boolean")


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_corners_tell_what_the_index_tells(spark, seed):
    f = surface(spark, seed).repartition(3, "fid").cache()
    vertices, refs = fc.keyed_index(fc.vertex_keys(f, DOM))
    refs = refs.join(f.filter("here").select("fid"), "fid", "left_semi")
    want = fc.watertight_check(refs, vertices, DOM).join(vertices, F.col("what") == F.col("vid").cast("string"), "left")
    want = want.select("rule", F.when(F.col("rule") != "faces", F.col("what")).alias("what"), *[F.when(F.col("rule") == "faces", F.col(c)).alias(c) for c in ("k", "j", "i", "dir")], "n")
    got = fc.closed_check(f, DOM, F.col("here"))
    got = got.withColumn("what", F.when(F.col("rule") != "faces", F.col("what")))
    key = lambda df: sorted(map(str, (tuple(r) for r in df.collect())))
    assert key(got) == key(want)
    assert {r["rule"] for r in got.collect()} == {"corner", "repeated", "edge", "faces"}


def test_check_of_a_terrain_is_one_shuffle(spark):
    """Corners meet once for the terrain and once for the check: no index, no window over faces, nothing joined."""
    p = plan(QUERIES["k25_watertight_check"](spark, SF))
    assert p.count("Exchange hashpartitioning") == 2 and "Window" not in p and "cut-" not in p
    assert "Join" not in p.split("MapInArrow")[0]
