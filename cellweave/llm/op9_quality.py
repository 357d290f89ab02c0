"""Operator 9: quality classifier, histogram gradient-boosted trees over document statistics.

Statistics come from whole texts in one scan. Trees are grown on at most TRAIN_ROWS labelled rows
(those of smallest id hash, the same at any size of input), flattened into arrays, and every
document walks all trees at once in numpy. A count of the labelled rows sets a bound on the hash, so
that little more than the sample leaves the executors.

Defined results: a null text is empty and is scored like any other; labels that are null are not
learnt from, of several labels for one id the smallest counts; without labels of both kinds every
score is 0.5. Each input row gives one output row; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm import text as tx
from cellweave.session import cut

#: Bound on labelled rows that the trees are grown on.
TRAIN_ROWS = 20_000
TREES, DEPTH, BINS, RATE, L2, LEAST = 80, 4, 64, 0.15, 1.0, 20.0
NAMES = ["size", "upper", "lower", "digit", "blank", "line", "period", "comma", "shout", "bar", "symbol", "other_ascii", "high", "control", "word_len", "distinct", "again", "period2", "longest", "upper_words"]

_CLASS = np.full(256, 10, np.int64)  # other ASCII
_CLASS[0:32] = 12
_CLASS[127] = 12
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58] = 0, 1, 2
_CLASS[[32, 9]] = 3
_CLASS[[10, 13]] = 4
_CLASS[ord(".")], _CLASS[ord(",")], _CLASS[ord("!")], _CLASS[ord("|")] = 5, 6, 7, 8
_CLASS[[ord(c) for c in "#$%&*@^~<>{}[]\\_="]] = 9
_CLASS[128:] = 11


def statistics(offs: np.ndarray, data: np.ndarray) -> np.ndarray:
    """A row of NAMES for each text of a slice."""
    n, size = len(offs) - 1, np.diff(offs)
    doc = np.repeat(np.arange(n), size)
    share = np.bincount(doc * 13 + _CLASS[data], minlength=n * 13).reshape(n, 13) / np.maximum(size, 1)[:, None]
    s, e, d = tx.words(data, offs)
    count = np.bincount(d, minlength=n)
    h = tx.span_hashes(data, s, e)
    some = np.maximum(count, 1)
    order = np.lexsort((h, d))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (d[order][1:] != d[order][:-1])
    distinct = np.bincount(d[order][new], minlength=n)
    again = np.bincount(d[1:][(h[1:] == h[:-1]) & (d[1:] == d[:-1])], minlength=n)
    again2 = np.bincount(d[2:][(h[2:] == h[:-2]) & (d[2:] == d[:-2])], minlength=n)
    longest = np.zeros(n)
    np.maximum.at(longest, d, (e - s).astype(float))
    capital = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_CLASS[data] == 0, out=capital[1:])
    loud = np.bincount(d[(capital[e] - capital[s]) * 2 > e - s], minlength=n)
    return np.column_stack([np.log1p(size), share, size / some, distinct / some, again / some, again2 / some, np.log1p(longest), loud / some]).astype(np.float64)


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and its statistics, for every row."""

    def run(batches):
        for b in batches:
            x = [statistics(o, d) for _, _, o, d in tx.slices(b, "text")]
            x = np.concatenate(x) if x else np.empty((0, len(NAMES)))
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, x.T.copy())], ["doc_id", *NAMES])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tx.tidy(run), f"doc_id {kind}, " + ", ".join(f"{n} double" for n in NAMES))


def grow(x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Trees of fixed depth as arrays: feature and cut of each inner node (heap order), value of each leaf."""
    n, width = x.shape
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    out = {"feature": np.zeros((TREES, inner), np.int64), "cut": np.full((TREES, inner), np.inf), "value": np.zeros((TREES, leaves)), "start": np.zeros(1)}
    if n == 0 or y.min() == y.max():
        return out
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(c, col, "left") for c, col in zip(cuts, x.T)])
    raw = np.full(n, np.log(y.mean() / (1 - y.mean())))
    out["start"][0] = raw[0]
    for t in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(DEPTH):
            many, base = 2**level, 2**level - 1
            best, best_f, best_b = np.full(many, 1e-6), np.zeros(many, np.int64), np.full(many, BINS)
            for f in range(width):
                code = node * BINS + binned[:, f]
                gs = np.bincount(code, g, many * BINS).reshape(many, BINS).cumsum(1)
                hs = np.bincount(code, h, many * BINS).reshape(many, BINS).cumsum(1)
                gr, hr = gs[:, -1:] - gs, hs[:, -1:] - hs
                gain = gs**2 / (hs + L2) + gr**2 / (hr + L2) - gs[:, -1:] ** 2 / (hs[:, -1:] + L2)
                gain[(hs < LEAST / 4) | (hr < LEAST / 4)] = -1
                k = gain.argmax(1)
                top = gain[np.arange(many), k]
                better = top > best
                best[better], best_f[better], best_b[better] = top[better], f, k[better]
            for j in range(many):
                if best_b[j] < BINS:
                    out["feature"][t, base + j], out["cut"][t, base + j] = best_f[j], cuts[best_f[j]][min(best_b[j], len(cuts[best_f[j]]) - 1)]
            node = node * 2 + (binned[np.arange(n), best_f[node]] > best_b[node])
        v = np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + L2) * RATE
        out["value"][t] = v
        raw += v[node]
    return out


def walk(trees: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Score of each row, all trees together, level by level."""
    t = np.arange(TREES)[None, :]
    node = np.zeros((len(x), TREES), np.int64)
    for _ in range(DEPTH):
        f, c = trees["feature"][t, node], trees["cut"][t, node]
        node = node * 2 + 1 + (np.take_along_axis(x, f, 1) > c)
    return 1 / (1 + np.exp(-(trees["start"][0] + trees["value"][t, node - (2**DEPTH - 1)].sum(1))))


def fit(feats: DataFrame, ids: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", fold: int = 5) -> dict[str, np.ndarray]:
    """Trees from labelled rows whose crc32(id as text) mod ``fold`` is not 0; ``ids`` is the id column of the documents."""
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("label")).dropna().groupBy("doc_id").agg(F.min("label").alias("label"))
    known = known.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % fold != 0)
    rows = feats.join(known, "doc_id")
    many = known.join(ids, "doc_id", "left_semi").count()
    if many > 2 * TRAIN_ROWS:
        # Hashes spread evenly, so a bound for 1.2 times the sample (26 deviations more than it) keeps all of its rows.
        rows = rows.filter(F.xxhash64("doc_id") < F.lit(int(2**64 * (1.2 * TRAIN_ROWS / many)) - 2**63))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", *NAMES).limit(TRAIN_ROWS).select(*NAMES, "label").toPandas()
    return grow(rows[NAMES].to_numpy(float), rows["label"].to_numpy(float))


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted."""
    kind = docs.schema[id_col].dataType.simpleString()
    feats = cut(features(docs, id_col, text_col))
    trees = fit(feats, feats.select("doc_id"), labels, id_col)

    def run(batches):
        for b in batches:
            x = np.column_stack([b.column(k + 1).to_numpy(zero_copy_only=False) for k in range(len(NAMES))])
            s = walk(trees, x)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    out = feats.select("doc_id", *NAMES).mapInArrow(tx.tidy(run), f"doc_id {kind}, score double, predicted int")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", "predicted")


def keep(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, all columns; the second scan scores each row where it is."""
    trees = fit(features(docs, id_col, text_col), docs.select(F.col(id_col).alias("doc_id")), labels, id_col)

    def run(batches):
        for b in batches:
            x = [statistics(o, d) for _, _, o, d in tx.slices(b, text_col)]
            yield b.filter(pa.array(walk(trees, np.concatenate(x)) >= threshold)) if x else b

    return docs.mapInArrow(tx.tidy(run), docs.schema)
