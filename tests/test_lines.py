"""Centre lines and merged lines against known shapes and plain versions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.operators import lines as ln


def cells(spark, shape, n, dx=0):
    return spark.createDataFrame([(i + dx, j, bool(shape(i, j))) for i in range(n) for j in range(n)], "i int, j int, street boolean")


SHAPES = [  # shape, middle cells that must be met within a cell, where no middle may be
    (lambda i, j: 5 <= i < 45 and 20 <= j < 27, [(i, 23) for i in range(9, 41)]),  # a bar of odd width
    (lambda i, j: 5 <= i < 45 and 20 <= j < 26, [(i, 22) for i in range(9, 41)]),  # of even width
    (lambda i, j: (5 <= i < 12 and 5 <= j < 45) or (5 <= i < 45 and 5 <= j < 12), [(8, j) for j in range(16, 41)] + [(i, 8) for i in range(16, 41)]),  # L
    (lambda i, j: (5 <= i < 45 and 30 <= j < 37) or (20 <= i < 27 and 5 <= j < 37), [(i, 33) for i in range(9, 18)] + [(i, 33) for i in range(29, 41)] + [(23, j) for j in range(9, 27)]),  # T
]
SHAPES.append((lambda i, j: j == 7 and 3 <= i < 30, [(i, 7) for i in range(3, 30)]))  # one cell wide
SHAPES.append((lambda i, j: j in (7, 8, 9) and 3 <= i < 30, [(i, 8) for i in range(5, 28)]))


def test_medial_of_bars_and_corners(spark):
    for shape, middle in SHAPES:
        got = {(r["i"], r["j"]) for r in ln.medial(cells(spark, shape, 50)).collect()}
        assert all(any(abs(a - i) <= 1 and abs(b - j) <= 1 for a, b in got) for i, j in middle)
        # nothing but the middle, its crossing and the ends
        far = [c for c in got if all(max(abs(c[0] - i), abs(c[1] - j)) > 8 for i, j in middle)]
        side = [c for c in got if all(abs(c[0] - i) > 1 or abs(c[1] - j) > 1 for i, j in middle)]
        assert not far and len(side) <= 12


def test_distances_are_euclidean(spark):
    rnd = random.Random(2)
    solid = {(i, j): rnd.random() < 0.93 for i in range(25) for j in range(25)}
    got = {(r["i"], r["j"]): (r["d2"], r["fi"], r["fj"]) for r in ln.distances(cells(spark, lambda i, j: solid[i, j], 25)).collect()}
    other = [c for c, s in solid.items() if not s]
    assert got == {c: min(((c[0] - a) ** 2 + (c[1] - b) ** 2, a, b) for a, b in other) for c, s in solid.items() if s}


def test_merge(spark):
    rnd = random.Random(3)
    star = [((0, 0), (10, 0)), ((0, 0), (0, 10)), ((0, 0), (-10, 0)), ((10, 0), (20, 5)), ((20, 5), (30, 5))]  # a junction, one long arm
    loop = [((100, 0), (110, 0)), ((110, 0), (110, 10)), ((110, 10), (100, 0))]
    lasso = [((200, 0), (210, 0)), ((210, 0), (220, 5)), ((220, 5), (220, -5)), ((220, -5), (210, 0))]
    segments = [(*a, *b) if rnd.random() < 0.5 else (*b, *a) for a, b in star + loop + lasso] + [(0, 0, 10, 0), (5, 5, 5, 5)]
    rnd.shuffle(segments)
    df = spark.createDataFrame([tuple(map(float, s)) for s in segments], "xa double, ya double, xb double, yb double").repartition(3)
    got = sorted([(p["x"], p["y"]) for p in r["points"]] for r in ln.merge_lines(df).collect())
    closed = [g for g in got if g[0] == g[-1]]
    assert sorted(g for g in got if g[0] != g[-1]) == [[(-10, 0), (0, 0)], [(0, 0), (0, 10)], [(0, 0), (10, 0), (20, 5), (30, 5)], [(200, 0), (210, 0)]]
    assert sorted((g[0], set(g)) for g in closed) == [((100, 0), {(100, 0), (110, 0), (110, 10)}), ((210, 0), {(210, 0), (220, 5), (220, -5)})]


def plain_simplify(p, tolerance):
    if len(p) < 3:
        return p
    (ax, ay), (bx, by) = p[0], p[-1]

    def far(q):
        vx, vy = bx - ax, by - ay
        t = max(0, min(1, ((q[0] - ax) * vx + (q[1] - ay) * vy) / (vx * vx + vy * vy))) if vx or vy else 0
        return math.hypot(q[0] - ax - t * vx, q[1] - ay - t * vy)

    k = max(range(1, len(p) - 1), key=lambda k: far(p[k]))
    if far(p[k]) <= tolerance:
        return [p[0], p[-1]]
    return plain_simplify(p[: k + 1], tolerance)[:-1] + plain_simplify(p[k:], tolerance)


def test_simplify(spark):
    rnd = random.Random(5)
    lines = [[(float(k), rnd.uniform(0, 4)) for k in range(n)] for n in (1, 2, 3, 30, 200)]
    df = spark.createDataFrame([(k, [{"x": x, "y": y} for x, y in p]) for k, p in enumerate(lines)], "k int, points array<struct<x:double,y:double>>")
    for r in df.select("k", ln.simplify_points("points", F.lit(1.5), F.lit(False)).alias("p")).collect():
        assert [(q["x"], q["y"]) for q in r["p"]] == plain_simplify(lines[r["k"]], 1.5)


def test_a_long_line(spark):
    n = 100_000
    k = F.col("id").cast("double")
    y = lambda k: F.sin(k / 500) * 40
    s = spark.range(n).select(F.round(k, 6).alias("xa"), F.round(y(k), 6).alias("ya"), F.round(k + 1, 6).alias("xb"), F.round(y(k + 1), 6).alias("yb"))
    r = ln.merge_lines(s.repartition(5)).select("n", ln.simplify_points("points", F.lit(0.5), F.lit(False)).alias("p")).collect()
    assert len(r) == 1 and r[0]["n"] == n + 1 and 100 < len(r[0]["p"]) < 5000
    x, y = np.array([q["x"] for q in r[0]["p"]]), np.array([q["y"] for q in r[0]["p"]])
    at = np.arange(0, n, 7.0)
    assert np.abs(np.interp(at, x, y) - np.sin(at / 500) * 40).max() < 0.6


def test_nothing(spark):
    none = spark.createDataFrame([], "xa double, ya double, xb double, yb double")
    assert ln.merge_lines(none).count() == 0
    assert ln.medial(cells(spark, lambda i, j: False, 3)).count() == 0 and ln.medial(cells(spark, lambda i, j: True, 3)).count() == 0
