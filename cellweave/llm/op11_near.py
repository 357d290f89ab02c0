"""Operator 11: near duplicates among embeddings, by PCA-ordered tiled comparison.

Unit vectors are turned into the axes of the whole table's second moments, leading axes first. Vectors
of a label are ordered by their leading coordinates and packed into blocks; blocks whose boxes on these
coordinates lie farther apart than linked vectors can are never brought together. The others meet in
pairs: products are summed over leading dimensions first, what remains is bounded by the product of the
suffix norms, and a pair (then a tile) is left as soon as the bound is under the threshold. Pairs that
reach the end are decided by the cosine of the given vectors in double precision.

Only sums and spanning links leave a pair of blocks: the number of links of each vector, and one link
from each linked vector to the least of its piece. So no list of pairs is ever built, and equal vectors
of a label are one class with a weight.

Defined results: one row per input row. Vectors that are null, zero (or of no components) or hold null or
non-finite components, and rows with a null label or id, have no links and are their own component (null
ids: null). Vectors of different lengths are not compared. Each row of a repeated id counts as a vector.
Components of finite doubles are scaled by their largest before they are squared. Other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm import text as tx
from cellweave.operators.components import connected_components
from cellweave.session import cut, discard, shuffle_parts

#: Vectors of a block, at most (also at most ``BLOCK_BYTES`` of components); tiles within it.
BLOCK, BLOCK_BYTES, TILE = 4096, 4 << 20, 512
#: Leading coordinates that order vectors and bound blocks.
LEAD = 8
SLACK = 1e-9


def valid(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """id, label, v (doubles), len, k1, k2: rows that can link; equal vectors have equal keys."""
    d = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    d = d.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fine, F.lit(False)))
    d = d.withColumn("v", F.transform("v", lambda x: x + 0.0))  # one zero
    return d.withColumn("len", F.size("v")).withColumn("k1", F.xxhash64(F.lit(1), "v")).withColumn("k2", F.xxhash64(F.lit(2), "v"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).reshape(-1, width)


def units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def by_length(lens: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    for n in np.unique(lens):
        yield int(n), np.flatnonzero(lens == n)


def axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """Principal axes of unit vectors for each length, most of the squares first: second moments summed in tasks, then by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for n, at in by_length(batch.column(0).to_numpy()):
                y = units(matrix(batch.column(1).take(pa.array(at)), n))
                total[n] = total.get(n, 0) + y.T @ y
        for n, m in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m.size, n), pa.int32()), pa.array(np.arange(m.size), pa.int64()), pa.array(m.ravel())], ["len", "at", "m"])

    sums = classes.select("len", "v").mapInArrow(tx.tidy(run), "len int, at long, m double").groupBy("len", "at").agg(F.sum("m").alias("m")).toArrow().sort_by([("len", "ascending"), ("at", "ascending")])
    lens, m = sums["len"].to_numpy(), sums["m"].to_numpy()
    out = {}
    for n in np.unique(lens):
        s = m[lens == n].reshape(n, n)
        _, q = np.linalg.eigh((s + s.T) / 2)
        out[int(n)] = q[:, ::-1].copy()
    return out


def blocks(classes: DataFrame, turn, width: float) -> DataFrame:
    """label, len, b, n, lo, hi, cids, weights, data: runs of vectors of a label in the order of their leading coordinates.

    Ranges of the order are dealt to tasks by Spark's sampling of keys, so a hot label is split; a block
    never leaves its task's range.
    """

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lens, v = batch.column(2).to_numpy(), batch.column(3)
            for n, at in by_length(lens):
                take = pa.array(at)
                x = matrix(v.take(take), n)
                lead = np.zeros((len(at), LEAD))
                k = min(n, LEAD)
                lead[:, :k] = units(x) @ turn.value[n][:, :k]
                cells = pa.FixedSizeListArray.from_arrays(pa.array(np.floor(lead / width).astype(np.int32).ravel()), LEAD).cast(pa.list_(pa.int32()))
                heads = pa.FixedSizeListArray.from_arrays(pa.array(lead.ravel()), LEAD).cast(pa.list_(pa.float64()))
                data = pa.array([r.tobytes() for r in x], pa.binary())
                yield pa.RecordBatch.from_arrays([*[batch.column(c).take(take) for c in (0, 1, 2, 4)], cells, heads, data], ["cid", "label", "len", "weight", "cells", "lead", "data"])

    kind = classes.schema["label"].dataType.simpleString()
    placed = classes.select("cid", "label", "len", "v", "weight").mapInArrow(tx.tidy(place), f"cid long, label {kind}, len int, weight long, cells array<int>, lead array<double>, data binary")
    keys = ["label", "len", *[F.col("cells")[k] for k in range(LEAD)], F.col("lead")[0]]
    ranged = placed.repartitionByRange(shuffle_parts(classes.sparkSession), *keys).sortWithinPartitions(*keys)
    ranged = ranged.select("label", "len", "cid", "weight", "lead", "data", F.spark_partition_id().cast("long").alias("task"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        room, key, number = 0, None, 0

        def flush():
            nonlocal held, room, number
            t = pa.concat_tables(held).combine_chunks()
            lead = matrix(t["lead"].combine_chunks(), LEAD)
            row = {"label": t["label"][:1], "len": t["len"][:1], "b": pa.array([(t["task"][0].as_py() << 32) + number], pa.int64()), "n": pa.array([len(t)], pa.int32())}
            row |= {"lo": pa.array([lead.min(0).tolist()]), "hi": pa.array([lead.max(0).tolist()])}
            row |= {c: pa.array([t[f].to_numpy().tobytes()], pa.binary()) for c, f in (("cids", "cid"), ("weights", "weight"))}
            row["data"] = pa.array([b"".join(t["data"].to_pylist())], pa.binary())
            held, room, number = [], 0, number + 1
            yield from pa.table(row).combine_chunks().to_batches()

        for batch in batches:
            label, lens = batch.column(0), batch.column(1).to_numpy()
            coded = label.dictionary_encode().indices.to_numpy()
            edge = [0, *(np.flatnonzero((coded[1:] != coded[:-1]) | (lens[1:] != lens[:-1])) + 1).tolist(), len(lens)]
            for a, b in zip(edge, edge[1:], strict=False):
                if a == b:
                    continue
                now = (label[a].as_py(), int(lens[a]))
                if held and now != key:
                    yield from flush()
                key = now
                most = max(1, min(BLOCK, BLOCK_BYTES // (8 * now[1])))
                while a < b:
                    k = min(b - a, most - room)
                    held.append(pa.table(batch[a : a + k]))
                    room, a = room + k, a + k
                    if room == most:
                        yield from flush()
        if held:
            yield from flush()

    return cut(ranged.mapInArrow(tx.tidy(pack), f"label {kind}, len int, b long, n int, lo array<double>, hi array<double>, cids binary, weights binary, data binary"))


def block_pairs(made: DataFrame, width: float) -> DataFrame:
    """a <= b: blocks of a label and length whose boxes come within ``width`` of each other.

    Blocks meet in the cells of the first two coordinates that their boxes, grown by half the width, touch.
    """
    f = lambda c, k, grow: F.floor((F.col(c)[k] + grow) / width).cast("int")
    keyed = made.select("label", "len", "b", "lo", "hi", *[F.explode(F.sequence(f("lo", 0, -width / 2), f("hi", 0, width / 2))).alias("x")])
    keyed = keyed.select("*", F.explode(F.sequence(f("lo", 1, -width / 2), f("hi", 1, width / 2))).alias("y"))
    p, q = keyed.alias("p"), keyed.alias("q")
    gap = lambda k: F.greatest(F.lit(0.0), F.col("p.lo")[k] - F.col("q.hi")[k], F.col("q.lo")[k] - F.col("p.hi")[k])
    near = sum(gap(k) * gap(k) for k in range(LEAD)) <= width * width
    same = [F.col("p." + c) == F.col("q." + c) for c in ("label", "len", "x", "y")]
    on = same[0] & same[1] & same[2] & same[3] & (F.col("p.b") <= F.col("q.b"))
    return p.join(q, on).filter(near).select(F.col("p.b").alias("a"), F.col("q.b").alias("b")).distinct()


def tile_links(xa: np.ndarray, xb: np.ndarray, ya: np.ndarray, yb: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``xa`` and ``xb`` whose cosine is at least ``least``; ``ya``, ``yb`` are their turned unit vectors."""
    n = ya.shape[1]
    steps = [s for s in (8, 16, 24, 32, 48, 64, 96, 128, 192, 256, 384, 512) if s < n] + [n]
    tail_a, tail_b = [np.sqrt(np.maximum(0, 1 - np.cumsum(y * y, 1)[:, [s - 1 for s in steps]])) for y in (ya, yb)]
    sums, i, j, at = np.zeros((len(ya), len(yb))), None, None, 0
    for k, s in enumerate(steps):
        if i is None:
            sums += ya[:, at:s] @ yb[:, at:s].T
            ok = sums + tail_a[:, k][:, None] * tail_b[:, k] >= least - SLACK
            found = int(ok.sum())
            if not found:
                return np.empty(0, np.int64), np.empty(0, np.int64)
            if found * 16 < ok.size:  # few: go on with these alone
                i, j = np.nonzero(ok)
                sums = sums[i, j]
        else:
            sums = sums + np.einsum("ij,ij->i", ya[i, at:s], yb[j, at:s])
            ok = sums + tail_a[i, k] * tail_b[j, k] >= least - SLACK
            i, j, sums = i[ok], j[ok], sums[ok]
            if not len(i):
                break
        at = s
    if i is None:
        i, j = np.nonzero(ok)
    out = []
    norm_a, norm_b = np.sqrt((xa * xa).sum(1)), np.sqrt((xb * xb).sum(1))
    for k in range(0, len(i), 1 << 14):
        p, q = i[k : k + (1 << 14)], j[k : k + (1 << 14)]
        out.append(np.einsum("ij,ij->i", xa[p], xb[q]) / (norm_a[p] * norm_b[q]) >= least)
    ok = np.concatenate(out) if out else np.empty(0, bool)
    return i[ok], j[ok]


def roots(n: int, links: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Least place in the component of each of n places: labels fall along links, then along themselves."""
    root = np.arange(n)
    while True:
        before = root.copy()
        for i, j in links:
            low = np.minimum(root[i], root[j])
            np.minimum.at(root, i, low)
            np.minimum.at(root, j, low)
        root = root[root]
        if (root == before).all():
            return root


def pair_links(a: dict, b: dict | None, q: np.ndarray, n: int, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """cid, partners (by weight) and least cid of its piece, for the linked vectors of two blocks (``b`` None: within one)."""
    sides = [a] if b is None else [a, b]
    x = [np.frombuffer(s["data"]).reshape(-1, n) for s in sides]
    x = [v / np.abs(v).max(1, keepdims=True) for v in x]
    y = [v / np.sqrt((v * v).sum(1, keepdims=True)) @ q for v in x]
    cid, weight = (np.concatenate([np.frombuffer(s[c], np.int64) for s in sides]) for c in ("cids", "weights"))
    order = np.argsort(cid, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))  # by cid, so that the least place is the least cid
    partners, links = np.zeros(len(cid), np.int64), []
    second = len(sides) - 1
    shift = len(x[0]) if second else 0
    for r in range(0, len(x[0]), TILE):
        for c in range(0 if second else r, len(x[second]), TILE):
            i, j = tile_links(x[0][r : r + TILE], x[second][c : c + TILE], y[0][r : r + TILE], y[second][c : c + TILE], least)
            i, j = i + r, j + c + shift
            if not second:
                up = i < j
                i, j = i[up], j[up]
            if not len(i):
                continue
            partners += np.bincount(i, weight[j], len(cid)).astype(np.int64) + np.bincount(j, weight[i], len(cid)).astype(np.int64)
            links.append(forest(place[i], place[j]))
    hit = np.flatnonzero(partners)
    root = roots(len(cid), links)
    return cid[hit], partners[hit], cid[order][root[place[hit]]]


def forest(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of the same components, one for each place but the least: so tiles of a dense group keep few."""
    names, at = np.unique(np.concatenate([i, j]), return_inverse=True)
    root = roots(len(names), [(at[: len(i)], at[len(i) :])])
    return names, names[root]


def links(classes: DataFrame, least: float) -> DataFrame:
    """cid, partners, root: for each pair of blocks in which a class links, its weight of partners and the least class of its piece."""
    spark = classes.sparkSession
    turn = spark.sparkContext.broadcast(axes(classes))
    width = math.sqrt(2 - 2 * least) + SLACK
    made = blocks(classes, turn, width)
    pairs = cut(block_pairs(made, width))
    both = pairs.select(F.struct("a", "b").alias("pair"), F.explode(F.array_distinct(F.array("a", "b"))).alias("b"))
    dealt = made.select("b", "len", "cids", "weights", "data").join(both, "b")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, key = None, None
        for batch in batches:
            for r in batch.to_pylist():
                one = r["a"] == r["z"]
                if a is None and not one:
                    a, key = r, (r["a"], r["z"])
                    continue
                if not one and key != (r["a"], r["z"]):
                    raise RuntimeError("a block's partner is missing")
                got = pair_links(r if one else a, None if one else r, turn.value[r["len"]], r["len"], least)
                a = None
                if len(got[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in got], ["cid", "partners", "root"])

    rows = dealt.select(F.col("pair.a").alias("a"), F.col("pair.b").alias("z"), "b", "len", "cids", "weights", "data").repartition(shuffle_parts(spark), "a", "z").sortWithinPartitions("a", "z", "b")
    found = cut(rows.mapInArrow(tx.tidy(meet), "cid long, partners long, root long"))
    discard(made, pairs)
    return found


def score(vectors: DataFrame, least: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """id, n_links, component_id, kept of every row; links are between vectors of one label with cosine of at least ``least``."""
    keys = ["label", "len", "k1", "k2"]
    able = valid(vectors, id_col, vec_col, label_col)
    classes = able.groupBy(*keys).agg(F.first("v").alias("v"), F.count("*").alias("weight"), F.min("id").alias("low"))
    classes = cut(classes.withColumn("cid", F.monotonically_increasing_id()))
    found = links(classes, least)
    n = found.groupBy("cid").agg(F.sum("partners").alias("partners"))
    parts = connected_components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    own = classes.select("cid", *keys, "weight", "low").join(n, "cid", "left").join(parts.withColumnRenamed("node", "cid"), "cid", "left")
    own = cut(own.withColumn("root", F.coalesce("root", "cid")))
    lowest = own.groupBy("root").agg(F.min("low").alias("component_id"))
    own = own.join(lowest.hint("merge"), "root").select(*keys, (F.col("weight") - 1 + F.coalesce("partners", F.lit(0))).alias("n_links"), "component_id")
    named = able.select("id", *keys).join(own.hint("merge"), keys).select("id", "n_links", "component_id")
    d = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rest = d.filter(F.col("id").isNull() | F.col("label").isNull() | ~F.coalesce(fine, F.lit(False))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = named.unionByName(rest)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
