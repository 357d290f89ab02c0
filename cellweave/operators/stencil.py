"""Neighbourhood operators on cells keyed by (i, j): shifts are equi-joins on exploded offsets."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.operators.components import connected_components
from cellweave.session import cut, discard

FOUR = [(-1, 0), (1, 0), (0, -1), (0, 1)]
NINE = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1)]


def neighbours(cells: DataFrame, values: list[str], offsets: list[tuple[int, int]], prefix: str = "n_") -> DataFrame:
    """i, j of a cell with the values of each existing neighbour, and the offset (di, dj) to it."""
    off = F.array(*[F.struct(F.lit(a).alias("di"), F.lit(b).alias("dj")) for a, b in offsets])
    sent = cells.select("i", "j", *[F.col(v).alias(prefix + v) for v in values], F.explode(off).alias("o"))
    return sent.select((F.col("i") - F.col("o.di")).alias("i"), (F.col("j") - F.col("o.dj")).alias("j"), F.col("o.di").alias("di"), F.col("o.dj").alias("dj"), *[prefix + v for v in values])


def around(cells: DataFrame, value: str, offsets: list[tuple[int, int]]) -> DataFrame:
    """The cells with ``n_0``, ``n_1``, ...: ``value`` of the neighbour at each offset, null where there is none.

    One shuffle and no join: a cell meets what its neighbours sent in one group. A join of exploded rows would
    be planned by the size of the cells before they are sent, and broadcast where that looks small.
    """
    rest = [c for c in cells.columns if c not in ("i", "j")]
    off = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(a).alias("di"), F.lit(b).alias("dj")) for n, (a, b) in enumerate([(0, 0), *offsets], -1)])
    sent = cells.select("i", "j", *rest, F.explode(off).alias("o"))
    own = F.col("o.n") == -1
    sent = sent.select((F.col("i") - F.col("o.di")).alias("i"), (F.col("j") - F.col("o.dj")).alias("j"), F.col("o.n").alias("_n"), *[F.when(own, F.col(c)).alias(c) for c in rest], F.when(~own, F.col(value)).alias("_v"))
    here = [F.max(F.col("_n") == -1).alias("_own"), *[F.max(c).alias(c) for c in rest]]
    near = [F.max(F.when(F.col("_n") == n, F.col("_v"))).alias(f"n_{n}") for n in range(len(offsets))]
    return sent.groupBy("i", "j").agg(*here, *near).filter("_own").drop("_own").select(*cells.columns, *[f"n_{n}" for n in range(len(offsets))])


def until_still(state: DataFrame, step: Callable[[DataFrame], tuple[DataFrame, DataFrame]], most: int, must_end: bool = False) -> DataFrame:
    """Repeat ``step`` (new state, changed rows) until nothing changes or ``most`` rounds; each round is written. With ``must_end`` it is an error not to be still by then."""
    last = None
    for _ in range(most):
        state, changed = step(state)
        state = cut(state)
        discard(last)
        last = state
        if changed is None or state.filter("changed").isEmpty():
            break
        state = state.drop("changed")
    else:
        if must_end:
            raise RuntimeError(f"not still after {most} rounds")
    return state.drop("changed")


def _raised(cells: DataFrame, level: str, border: Column | None = None, ghost: int = 0) -> DataFrame:
    """The cells of ``around`` with FOUR: those with more than two higher neighbours take the lowest higher one's ``level``; ``border``: how many neighbours are ghosts."""
    nz, near = F.col(level), [F.col(f"n_{n}") for n in range(4)]
    higher = [F.when(n > nz, n) for n in near]
    k = sum(F.coalesce((n > nz).cast("int"), F.lit(0)) for n in near)
    if border is not None:
        k = k + F.when(F.lit(ghost) > nz, border).otherwise(0)
        higher.append(F.when((F.lit(ghost) > nz) & (border > 0), F.lit(ghost)))
    return cells.withColumn(level, F.when(k > 2, F.least(*higher)).otherwise(nz)).drop("n_0", "n_1", "n_2", "n_3")


def fill_minima(cells: DataFrame) -> DataFrame:
    """One round: a cell with more than two higher 4-neighbours takes the lowest higher one's level."""
    return _raised(around(cells, "nz", FOUR), "nz")


def fill_minima_all(cells: DataFrame, most: int = 100, at_once: int = 25) -> DataFrame:
    """Rounds of ``fill_minima`` to the fixpoint; levels only rise, so it ends. An error if ``most`` rounds are not enough."""
    return _raised_all(cells, most, at_once, must_end=True)


def fill_corners(cells: DataFrame, nx: int, ny: int, ghost: int = 9999) -> DataFrame:
    """One round of ``fill_minima`` inside a frame of ghost cells on all four sides."""
    edge = sum([(F.col("i") == a).cast("int") for a in (0, nx - 1)] + [(F.col("j") == b).cast("int") for b in (0, ny - 1)])
    return _raised(around(cells, "nz", FOUR), "nz", edge, ghost)


def _rounds(cells: DataFrame, column: str, round_: Callable[[DataFrame], DataFrame], most: int, must_end: bool = False) -> DataFrame:
    """``round_`` until ``column`` stays as it is, at most ``most`` times; the round keeps the other columns."""

    def step(s):
        new = round_(s.withColumn("was", F.col(column)))
        return new.withColumn("changed", ~F.col(column).eqNullSafe(F.col("was"))).drop("was"), True

    return until_still(cells, step, most, must_end)


def fill_corners_all(cells: DataFrame, nx: int, ny: int, most: int = 50, ghost: int = 9999, at_once: int = 25) -> DataFrame:
    """Rounds of ``fill_corners`` until nothing changes, at most ``most``."""
    return _raised_all(cells, most, at_once, frame=(nx, ny, ghost))


def _raised_all(cells: DataFrame, most: int, at_once: int, frame: tuple[int, int, int] | None = None, must_end: bool = False) -> DataFrame:
    """Rounds of ``_raised`` until nothing changes, at most ``most``; ``at_once`` of them for each time that the cells are sent. ``frame``: nx, ny and level of the ghosts around."""
    last, still = None, False
    for done in range(0, most, at_once):
        cells = cut(_in_tiles(cells, "nz", min(at_once, most - done), _raising(min(at_once, most - done), frame), mark="changed", placed=True))
        discard(last)
        last, still = cells, cells.filter("changed").isEmpty()
        cells = cells.drop("changed")
        if still:
            break
    if must_end and not still:
        raise RuntimeError(f"not still after {most} rounds")
    return cells


def _raising(rounds: int, frame: tuple[int, int, int] | None) -> Callable[..., tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Work of ``_in_tiles``: the rounds, and which cells the last of them still changed. A round reaches one cell far."""

    def work(z: np.ndarray, known: np.ndarray, i0: int, j0: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        z = z.astype("int64") if z.dtype.kind == "i" else z  # ghosts may be higher than the levels' type reaches
        far = np.iinfo(z.dtype).max if z.dtype.kind == "i" else np.inf
        sides = [(a, b, known[here] & known[there]) for here, there in _sides() for a, b in ((here, there), (there, here))]
        border = np.zeros(z.shape, "int8")
        if frame:
            nx, ny, ghost = frame
            for axis, first, n in ((0, i0, nx), (1, j0, ny)):
                at = np.arange(z.shape[axis]) + first
                border += np.expand_dims((at == 0).astype("int8") + (at == n - 1), 1 - axis)
        up = np.zeros(z.shape, bool)
        for _ in range(rounds):
            k, low = np.zeros(z.shape, "int8"), np.full(z.shape, far, z.dtype)
            for a, b, both in sides:
                higher = both & (z[b] > z[a])
                k[a] += higher
                low[a] = np.where(higher, np.minimum(low[a], z[b]), low[a])
            if frame:
                higher = (border > 0) & (ghost > z)
                k += np.where(higher, border, 0).astype("int8")
                low = np.where(higher, np.minimum(low, ghost), low).astype(z.dtype)
            up = known & (k > 2)
            if not up.any():
                break
            z = np.where(up, low, z)
        return z, known, up

    return work


def fill_building_holes(cells: DataFrame, nx: int, ny: int) -> DataFrame:
    """One round: i, j, lid of filled cells, from the rarest building neighbour (then lowest lid).

    A non-building cell is filled with more than two building 4-neighbours, each domain border it
    touches counting as one.
    """
    n = neighbours(cells.filter("is_building"), ["lid"], FOUR).groupBy("i", "j", "n_lid").agg(F.count("*").alias("k"))
    n = n.groupBy("i", "j").agg(F.sum("k").alias("k"), F.min(F.struct("k", "n_lid")).alias("rare"))
    edge = sum([(F.col("i") == a).cast("int") for a in (0, nx - 1)] + [(F.col("j") == b).cast("int") for b in (0, ny - 1)])
    open_ = cells.filter("not is_building").select("i", "j").join(n, ["i", "j"])
    return open_.filter(F.col("k") + edge > 2).select("i", "j", F.col("rare.n_lid").alias("lid"))


def fill_building_holes_all(cells: DataFrame, nx: int, ny: int, most: int = 21) -> DataFrame:
    """The cells with ``lid`` and ``is_building`` after rounds of ``fill_building_holes`` until nothing changes, at most ``most``."""

    def once(s):
        found = fill_building_holes(s, nx, ny).withColumnRenamed("lid", "to")
        return s.join(found, ["i", "j"], "left").withColumns({"lid": F.coalesce("to", "lid"), "is_building": F.col("is_building") | F.col("to").isNotNull()}).drop("to")

    return _rounds(cells, "is_building", once, most)


def fill_layer_pockets(cells: DataFrame, level: int, most: int) -> DataFrame:
    """One level: 4-connected regions of at most ``most`` cells at ``level`` with nothing lower among their 8-neighbours rise by one."""

    def work(z: np.ndarray, known: np.ndarray) -> np.ndarray:
        here = known & (z == level)
        lab, size, shut = _small_regions(z, here, most - 1)
        low = np.pad(known & (z < level), 1)
        n, m = z.shape
        beside = np.logical_or.reduce([low[1 + a : 1 + a + n, 1 + b : 1 + b + m] for a, b in NINE])
        shut[lab[here & beside]] = True
        return np.where(here & ((size <= most) & ~shut)[lab], z + z.dtype.type(1), z)

    return _in_tiles(cells, "nz", max(most, 1), work)


def fill_layer_pockets_all(cells: DataFrame, low: int, high: int, most: int) -> DataFrame:
    """``fill_layer_pockets`` from level ``low`` to ``high``, each on the outcome of the one below."""
    for level in range(low, high + 1):
        cells = cut(fill_layer_pockets(cells, level, most))
    return cells


def _in_tiles(cells: DataFrame, value: str, halo: int, work: Callable[..., np.ndarray | tuple[np.ndarray, ...]], tile: int = 256, also: tuple[str, ...] = (), mark: str | None = None, placed: bool = False) -> DataFrame:
    """The cells with ``work`` (values, which are known) of ``value`` done in squares of ``tile`` cells, each with the ``halo`` cells around it.

    Null stays null, unless ``work`` returns what is known as well. It is also given the ranks of the columns ``also``
    within the square (equal values one rank, from 1; 0 for null and where there is no cell), and the place of its first cell
    if it is ``placed``; with ``mark`` it also returns a flag of each cell, which becomes a column of that name.
    One shuffle and no join; a task holds one square at a time, whatever the regions in it look like.
    """
    names, schema = cells.columns, cells.schema
    if mark:
        schema = T.StructType([*schema.fields, T.StructField(mark, T.BooleanType())])
    to = lambda c: F.explode(F.sequence(F.floor((F.col(c) - halo) / tile).cast("int"), F.floor((F.col(c) + halo) / tile).cast("int")))
    own = (F.col("_ti") == F.floor(F.col("i") / tile)) & (F.col("_tj") == F.floor(F.col("j") / tile))
    sent = cells.withColumn("_ti", to("i")).withColumn("_tj", to("j")).withColumn("_own", own)
    sent = sent.select("_ti", "_tj", "_own", *[c if c in ("i", "j", value, *also) else F.when(F.col("_own"), F.col(c)).alias(c) for c in names])

    def one(t: pa.Table) -> pa.Table:
        i, j = t["i"].to_numpy().astype("int64"), t["j"].to_numpy().astype("int64")
        v, there = t[value].combine_chunks(), t[value].is_valid().to_numpy(zero_copy_only=False)
        place = (int(i.min()), int(j.min()))
        i, j = i - place[0], j - place[1]
        z, known = np.zeros((i.max() + 1, j.max() + 1), v.type.to_pandas_dtype()), np.zeros((i.max() + 1, j.max() + 1), bool)
        z[i, j], known[i, j] = v.fill_null(0).to_numpy(zero_copy_only=False), there
        ranks = []
        for c in also:
            col = t[c].combine_chunks()
            ranks.append(np.zeros(z.shape, "int64"))
            ranks[-1][i, j] = np.where(col.is_valid().to_numpy(zero_copy_only=False), pc.rank(col, tiebreaker="dense").to_numpy().astype("int64"), 0)
        done = work(z, known, *ranks, *(place if placed else ()))
        new, sure, *flag = done if isinstance(done, tuple) else (done, known)
        t = t.set_column(t.column_names.index(value), value, pa.array(new[i, j], v.type, mask=~sure[i, j]))
        if mark:
            t = t.append_column(mark, pa.array(flag[0][i, j]))
        return t.filter(t["_own"]).select([*names, mark] if mark else names)

    return sent.groupBy("_ti", "_tj").applyInArrow(one, schema)


def _sides() -> tuple:
    """Slices of the cells and of their neighbours above, and of the cells and of their neighbours to the right."""
    whole, head, tail = slice(None), slice(None, -1), slice(1, None)
    return ((whole, head), (whole, tail)), ((head, whole), (tail, whole))


def _small_regions(z: np.ndarray, known: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Name of each cell's 4-connected region of one level, size of each name, and whether a name holds only part of a region; regions of at most ``reach`` + 1 cells are whole."""
    lab = np.arange(z.size).reshape(z.shape)
    same = [(here, there, known[here] & known[there] & (z[here] == z[there])) for here, there in _sides()]
    for _ in range(reach):
        before = lab.copy()
        for here, there, like in same:
            lab[here] = np.where(like, np.minimum(lab[here], lab[there]), lab[here])
            lab[there] = np.where(like, np.minimum(lab[there], lab[here]), lab[there])
        if (before == lab).all():
            break
    part = np.zeros(z.size, bool)
    for here, there, like in same:
        cut_ = like & (lab[here] != lab[there])
        part[lab[here][cut_]] = part[lab[there][cut_]] = True
    return lab, np.bincount(lab.ravel(), minlength=z.size), part


def level_regions(cells: DataFrame) -> DataFrame:
    """id, nz, root: 4-connected regions of one level, named by their smallest id."""
    n = neighbours(cells, ["id", "nz"], [(1, 0), (0, 1)]).join(cells, ["i", "j"]).filter("nz = n_nz")
    roots = connected_components(n.select(F.col("id").cast("long").alias("a"), F.col("n_id").cast("long").alias("b")))
    return cells.select(F.col("id").cast("long").alias("node"), "nz").join(roots, "node", "left").select(F.col("node").alias("id"), "nz", F.coalesce("root", "node").alias("root"))


def fill_small_basins(cells: DataFrame, least: int = 10) -> DataFrame:
    """One round: regions of fewer than ``least`` cells that lie below all around rise to the lowest of them."""
    return _basin_rounds(cells, least, 1)


def fill_small_basins_all(cells: DataFrame, least: int = 10, most: int = 21, at_once: int = 7) -> DataFrame:
    """Rounds of ``fill_small_basins`` until nothing changes, at most ``most``; ``at_once`` of them for each time that the cells are sent."""
    for done in range(0, most, at_once):
        last, cells = cells, cut(_basin_rounds(cells.withColumn("was", F.col("nz")), least, min(at_once, most - done)))
        discard(last)
        still = cells.filter("nz <> was").isEmpty()
        cells, path = cells.drop("was"), cells._cut_path
        cells._cut_path = path
        if still:
            break
    return cells


def _basin_rounds(cells: DataFrame, least: int, rounds: int) -> DataFrame:
    """A round reaches as far as a region that may rise, and its rim: ``least`` - 1 cells."""

    def work(z: np.ndarray, known: np.ndarray) -> np.ndarray:
        for _ in range(rounds):
            lab, size, part = _small_regions(z, known, least - 1)
            far = np.iinfo(z.dtype).max if z.dtype.kind == "i" else np.inf
            near = np.full(z.shape, far, z.dtype)
            for here, there in _sides():
                differs = known[here] & known[there] & (z[here] != z[there])
                near[here] = np.where(differs, np.minimum(near[here], z[there]), near[here])
                near[there] = np.where(differs, np.minimum(near[there], z[here]), near[there])
            rim = np.full(size.size, far, z.dtype)
            np.minimum.at(rim, lab.ravel(), near.ravel())
            up = known & ((size < least) & ~part & (rim < far))[lab] & (rim[lab] > z)
            if not up.any():
                break
            z = np.where(up, rim[lab], z)
        return z

    return _in_tiles(cells, "nz", rounds * max(least - 1, 1), work)


def border_fill(cells: DataFrame, nx: int, ny: int, depth: int = 1) -> DataFrame:
    """Border cells lower than the cell ``depth`` rows further in take its level: west, east, south, north in turn."""
    for r in reversed(range(depth)):
        for at, di, dj in ((F.col("i") == r, 1, 0), (F.col("i") == nx - 1 - r, -1, 0), (F.col("j") == r, 0, 1), (F.col("j") == ny - 1 - r, 0, -1)):
            inner = cells.select((F.col("i") - di).alias("i"), (F.col("j") - dj).alias("j"), F.col("nz").alias("in_nz")).filter(at)
            cells = cells.join(inner, ["i", "j"], "left").withColumn("nz", F.greatest("nz", "in_nz")).drop("in_nz")
    return cells


def cyclic(cells: DataFrame, nx: int, ny: int, nc: int) -> DataFrame:
    """The outer ``nc`` rows and columns take the level of the reference row and column: j first, then i."""
    for axis, n in (("j", ny), ("i", nx)):
        other = "i" if axis == "j" else "j"
        ref = cells.filter(F.col(axis) == nc).select(other, F.col("nz").alias("ref"))
        out = (F.col(axis) < nc) | (F.col(axis) >= n - 1 - nc)
        cells = cells.join(ref, other).withColumn("nz", F.when(out, F.col("ref")).otherwise(F.col("nz"))).drop("ref")
    return cells


def smooth(cells: DataFrame, value: str) -> DataFrame:
    """i, j and the mean of the 3 by 3 cells around."""
    return neighbours(cells, [value], NINE).join(cells.select("i", "j"), ["i", "j"]).groupBy("i", "j").agg(F.avg("n_" + value).alias(value))


def saddles(cells: DataFrame) -> DataFrame:
    """i, j, nz after one round: in each 2 by 2 block whose diagonals stand apart, the low diagonal rises to the lower of the high one."""
    return _saddles(cells.select("i", "j", "nz"))


def _saddles(cells: DataFrame) -> DataFrame:
    """``saddles`` with the cells' other columns. Cells are sent to their four blocks, and blocks send what rises: two shuffles, no join."""
    corners = [("a", 0, 0), ("b", 1, 0), ("c", 0, 1), ("d", 1, 1)]
    to = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(di).alias("di"), F.lit(dj).alias("dj")) for n, di, dj in corners])
    sent = cells.select("i", "j", "nz", F.explode(to).alias("o")).select((F.col("i") - F.col("o.di")).alias("i"), (F.col("j") - F.col("o.dj")).alias("j"), F.col("o.n").alias("n"), "nz")
    block = sent.groupBy("i", "j").agg(F.count("*").alias("k"), *[F.max(F.when(F.col("n") == n, F.col("nz"))).alias(n) for n, _, _ in corners]).filter("k = 4")
    raise_ad, raise_bc = F.greatest("a", "d") < F.least("b", "c"), F.greatest("b", "c") < F.least("a", "d")
    ups = [F.struct((F.col("i") + di).alias("i"), (F.col("j") + dj).alias("j"), F.when(up, F.least(x, y)).alias("to")) for di, dj, up, x, y in ((0, 0, raise_ad, "b", "c"), (1, 1, raise_ad, "b", "c"), (1, 0, raise_bc, "a", "d"), (0, 1, raise_bc, "a", "d"))]
    up = block.filter(raise_ad | raise_bc).select(F.explode(F.array(*ups)).alias("u")).select("u.*").filter("to is not null")
    rest = [c for c in cells.columns if c not in ("i", "j")]
    both = cells.withColumns({"own": F.lit(True), "to": F.lit(None).cast("int")}).unionByName(up, allowMissingColumns=True)
    new = both.groupBy("i", "j").agg(F.max("own").alias("own"), F.max("to").alias("to"), *[F.max(c).alias(c) for c in rest]).filter("own")
    return new.select("i", "j", *[F.coalesce("to", "nz").alias("nz") if c == "nz" else F.col(c) for c in rest])


def saddles_all(cells: DataFrame, most: int = 100) -> DataFrame:
    """Rounds of ``saddles`` until nothing changes; levels only rise to levels that are there, so it ends. An error if ``most`` rounds are not enough."""
    return _rounds(cells.select("i", "j", "nz"), "nz", _saddles, most, must_end=True)
