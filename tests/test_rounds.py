"""Corners and minima are filled in squares, many rounds to a shuffle: equal to rounds one by one over the whole table."""

import pytest
from pyspark.sql import functions as F

from cellweave.operators import stencil
from tests.test_limits import plan
from tests.test_tiles import as_cells, levels_of, rough


def plain_rounds(nz, frame, most):
    """Levels after the rounds, and how many of them changed any."""
    nz, turns = dict(nz), 0
    while turns < most:
        new = dict(nz)
        for (i, j), z in nz.items():
            near = [nz.get((i + a, j + b)) for a, b in stencil.FOUR]
            if frame:
                nx, ny, ghost = frame
                near += [ghost] * ((i == 0) + (i == nx - 1) + (j == 0) + (j == ny - 1))
            higher = [x for x in near if x is not None and z is not None and x > z]
            if len(higher) > 2:
                new[i, j] = min(higher)
        if new == nz:
            break
        nz, turns = new, turns + 1
    return nz, turns


def small_squares(monkeypatch, size):
    real, calls = stencil._in_tiles, []

    def made(*args, **kw):
        out = real(*args, **{"tile": size, **kw})
        calls.append(plan(out))
        return out

    monkeypatch.setattr(stencil, "_in_tiles", made)
    return calls


@pytest.mark.parametrize("most", [1, 2, 3, 4, 50])
def test_corners_across_squares(spark, monkeypatch, most):
    """Gaps, unknown levels, cells outside the frame, and a limit that ends in the middle of what is done at once."""
    nz = {k: v for k, v in rough(11, 26, 9).items()} | {(4, 4): None, (12, 9): None}
    calls = small_squares(monkeypatch, 6)
    got = stencil.fill_corners_all(as_cells(spark, nz).withColumn("tag", F.concat_ws(",", "i", "j")), 26, 24, most, at_once=3)
    want, turns = plain_rounds(nz, (26, 24, 9999), most)
    assert got.columns == ["id", "i", "j", "nz", "tag"] and got.filter("tag = concat_ws(',', i, j)").count() == len(nz)
    assert levels_of(got) == want != nz and (turns > 4 or turns == most)
    assert all(p.count("Exchange") == 1 and "Join" not in p for p in calls) and len(calls) <= turns // 3 + 1


def test_minima_end_or_are_an_error(spark, monkeypatch):
    nz = rough(12, 26, 9)
    small_squares(monkeypatch, 6)
    want, turns = plain_rounds(nz, None, 99)
    cells = as_cells(spark, nz)
    assert turns > 2
    for at_once in (1, 2, 25):
        assert levels_of(stencil.fill_minima_all(cells, at_once=at_once)) == want
    assert levels_of(stencil.fill_minima_all(cells, turns + 1, at_once=2)) == want
    with pytest.raises(RuntimeError):
        stencil.fill_minima_all(cells, turns, at_once=2)


def test_fixture_needs_one_shuffle(spark, monkeypatch):
    from cellweave.plans.grid_queries import QUERIES

    calls = small_squares(monkeypatch, 256)
    for name in ("p5_fill_corners_all", "p4_fill_minima_all"):
        assert QUERIES[name](spark, "/root/testdata/sf0.001").count() == 3600
    assert len(calls) == 2
