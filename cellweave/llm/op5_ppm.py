"""Operator 5: language-model scoring by prediction by partial matching, beside a word-count base score.

PPM: contexts of up to ORDER bytes form a trie of counts over all training texts. A byte is coded in
the longest context that has been seen; if it was not seen there, an escape (distinct / (total +
distinct)) leads to the context one shorter, whose counts leave out all symbols of the longer one
(symbol exclusion). The model is pretrained and then fixed, so each byte string of ORDER + 1 bytes
has one code length, and documents add up lookups.

The trie is a table at every size, and nothing of it is collected but its two lowest orders, of
which 2**16 strings exist:

1. Texts are packed into units of about UNIT bytes; each unit lists its distinct byte strings and
   its distinct words with their training counts, and Spark adds these up.
2. Strings whose last two context bytes are equal (at most 2**24) hold all their contexts of order
   two and more, so each such branch of the trie is built in one group, and gives every string of
   the corpus its code length. Words get log10(count + 1).
3. Strings and words that make up 1/2**18 or more of all (so at most 2**18 of each) are sent to all
   tasks; units join the rest of what they list with the table, and score their texts.

Defined results: a null or empty text has the end token only; a null id is a training row; ids of
any type are kept; each input row gives one output row, repeated ids included; without training rows
c = N = V = 0 (base score is then log10(1 / 1) a token); an empty table gives no rows. Words are told
apart by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm import text as tx
from cellweave.session import cut, discard

ORDER, UNIT, COMMON = 4, 8 << 20, 1 << 18
LEVEL = 5  # of compression of the units
PAD, END, SYMBOLS = 0xFE, 0xFF, 256
FOLD, HELD = 7, 2
GRAM, WORD = 0, 1


def units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """unit, ids, held, sizes, z: texts of about UNIT bytes, compressed, with their ids and fold."""
    kind = docs.schema[id_col].dataType.simpleString()
    held = F.coalesce(F.crc32(docs[id_col].cast("string").cast("binary")) % FOLD == HELD, F.lit(False))
    names = ["unit", "ids", "held", "sizes", "z"]

    def run(batches):
        part, number, pack = TaskContext.get().partitionId(), 0, zstandard.ZstdCompressor(LEVEL)
        ids, held, sizes, data, size = [], [], [], [], 0

        def one(n):
            whole = [pa.concat_arrays(ids), pa.concat_arrays(held), pa.array(np.concatenate(sizes))]
            return pa.RecordBatch.from_arrays([pa.array([part << 32 | n]), *[pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in whole], pa.array([pack.compress(b"".join(data))], pa.binary())], names)

        for b in batches:
            for lo, hi, o, d in tx.slices(b, "text"):
                ids.append(b.column(0).slice(lo, hi - lo))
                held.append(b.column(2).slice(lo, hi - lo))
                sizes.append(np.diff(o))
                data.append(d.tobytes())
                size += len(d)
                if size >= UNIT:
                    yield one(number)
                    number += 1
                    ids, held, sizes, data, size = [], [], [], [], 0
        if ids:
            yield one(number)

    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), held.alias("held"))
    return rows.mapInArrow(tx.tidy(run), f"unit long, ids array<{kind}>, held array<boolean>, sizes array<long>, z binary")


def _slices(sizes: np.ndarray, z: bytes):
    """(first row, end row, offsets, bytes) of a unit's texts, about tx.SLICE bytes at a time."""
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(z), np.uint8)
    offs = np.append(0, np.cumsum(sizes))
    a = 0
    while a < len(sizes):
        b = min(len(sizes), max(a + 1, int(np.searchsorted(offs, offs[a] + tx.SLICE, "right")) - 1))
        yield a, b, offs[a : b + 1] - offs[a], data[offs[a] : offs[b]]
        a = b


def grams(offs: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each byte and end with its ORDER bytes of context, as a number, and its document."""
    n, size = len(offs) - 1, np.diff(offs)
    begin = offs[:-1] + np.arange(n) * (ORDER + 1)
    stream = np.full(len(data) + n * (ORDER + 1), PAD, np.uint8)
    doc = np.repeat(np.arange(n), size)
    stream[np.arange(len(data)) + (doc + 1) * (ORDER + 1) - 1] = tx.LOWER[data]
    stream[begin + ORDER + size] = END
    wide = stream.astype(np.uint64)
    code = wide[ORDER:].copy()
    for k in range(1, ORDER + 1):
        code |= wide[ORDER - k : len(wide) - k] << np.uint64(8 * k)
    real = stream[ORDER:] != PAD
    return code[real], np.repeat(np.arange(n), size + 1)


def _words(o: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s, e, doc = tx.words(d, o)
    return tx.span_hashes(tx.LOWER[d], s, e), doc


def listed(of: DataFrame) -> DataFrame:
    """unit, kind, code, n: the distinct byte strings and words of each unit, with their counts in training rows."""

    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                held = b.column("held")[k].values.to_numpy(zero_copy_only=False).astype(bool)
                found = {GRAM: [], WORD: []}
                for lo, hi, o, d in _slices(b.column("sizes")[k].values.to_numpy(), b.column("z")[k].as_py()):
                    train = ~held[lo:hi]
                    for kind, (code, doc) in ((GRAM, grams(o, d)), (WORD, _words(o, d))):
                        u, at = np.unique(code, return_inverse=True)
                        found[kind].append((u, np.bincount(at, train[doc], minlength=len(u))))
                for kind, parts in found.items():
                    code, n = (np.concatenate(x) for x in zip(*parts)) if parts else (np.empty(0, np.uint64), np.empty(0))
                    u, at = np.unique(code, return_inverse=True)
                    n = np.bincount(at, n, minlength=len(u)).astype(np.int64)
                    for a in range(0, len(u), 1 << 16):
                        c = u[a : a + (1 << 16)].view(np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(c), b.column("unit")[k].as_py())), pa.array(np.full(len(c), kind, np.int8)), pa.array(c), pa.array(n[a : a + (1 << 16)])], ["unit", "kind", "code", "n"])

    return of.mapInArrow(tx.tidy(run), "unit long, kind byte, code long, n long")


class Trie:
    """A branch of the context trie as sorted arrays for each order: contexts, and contexts with a symbol.

    ``low`` gives the orders from 0 on that the branch shares with others.
    """

    def __init__(self, code: np.ndarray, n: np.ndarray, order: int = ORDER, low: tuple = ()):
        self.order, self.levels = order, list(low)
        for k in range(len(low), order + 1):
            g, inverse = np.unique(code & np.uint64((1 << (8 * (k + 1))) - 1), return_inverse=True)
            c = np.bincount(inverse, n, minlength=len(g))
            ctx, first = np.unique(g >> np.uint64(8), return_index=True)
            at = np.searchsorted(ctx, g >> np.uint64(8))
            total, kinds = np.bincount(at, c, minlength=len(ctx)), np.bincount(at, minlength=len(ctx)).astype(float)
            left_out = np.zeros(len(ctx))
            if k:  # what the symbols of each context count for in the context one shorter
                below = self.levels[k - 1]
                same = np.searchsorted(below["gram"], g & np.uint64((1 << (8 * k)) - 1))
                left_out = np.bincount(at, below["count"][same], minlength=len(ctx))
            self.levels.append({"gram": g, "count": c, "ctx": ctx, "total": total, "kinds": kinds, "left_out": left_out})

    def log10(self, code: np.ndarray) -> np.ndarray:
        """log10 probability of each symbol by escapes from the longest seen context down."""
        out, open_ = np.zeros(len(code)), np.ones(len(code), bool)
        gone_n, gone_k = np.zeros(len(code)), np.zeros(len(code))  # excluded counts and symbols
        for k in range(self.order, -1, -1):
            v = self.levels[k]
            if not len(v["ctx"]):
                continue
            g = code & np.uint64((1 << (8 * (k + 1))) - 1)
            c = g >> np.uint64(8)
            at = np.minimum(np.searchsorted(v["ctx"], c), len(v["ctx"]) - 1)
            seen = open_ & (v["ctx"][at] == c)
            total, kinds = v["total"][at] - gone_n, v["kinds"][at] - gone_k
            some = seen & (kinds > 0)
            i = np.minimum(np.searchsorted(v["gram"], g), len(v["gram"]) - 1)
            hit = some & (v["gram"][i] == g)
            whole = np.where(some, total + kinds, 1)
            out[hit] += np.log10(v["count"][i[hit]] / whole[hit])
            miss = some & ~hit
            out[miss] += np.log10(kinds[miss] / whole[miss])
            open_ &= ~hit
            gone_n[seen], gone_k[seen] = v["left_out"][at[seen]], v["kinds"][at[seen]]
        out[open_] -= np.log10(np.maximum(SYMBOLS - gone_k[open_], 1))
        return out


def code_lengths(counts: DataFrame) -> DataFrame:
    """code, n, value: log10 probability of each byte string (code, n), those not in training rows (n = 0) included."""
    code = F.col("code")
    # At most 2**16 strings of two bytes.
    two = counts.filter("n > 0").groupBy(code.bitwiseAND(0xFFFF).alias("code")).agg(F.sum("n").alias("n")).toArrow()
    low = Trie(two["code"].to_numpy().astype(np.uint64), two["n"].to_numpy().astype(float), 1).levels

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        g, n = pdf["code"].to_numpy().view(np.uint64), pdf["n"].to_numpy()
        seen = n > 0
        return pd.DataFrame({"code": pdf["code"], "n": n, "value": Trie(g[seen], n[seen].astype(float), ORDER, low).log10(g)})

    branch = F.shiftright(code, 8).bitwiseAND(0xFFFF)
    return counts.select("code", "n").groupBy(branch.alias("branch")).applyInPandas(run, "code long, n long, value double")


def _looked_up(tables: list[tuple[np.ndarray, np.ndarray]], code: np.ndarray) -> np.ndarray:
    """Values of codes, each of which stands in one of the sorted tables."""
    u, inverse = np.unique(code, return_inverse=True)
    out = np.zeros(len(u))
    for keys, values in tables:
        if len(keys):
            at = np.minimum(np.searchsorted(keys, u), len(keys) - 1)
            hit = keys[at] == u
            out[hit] = values[at[hit]]
    return out[inverse]


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    packed = cut(units(docs, id_col, text_col))
    asked = cut(listed(packed))
    counts = cut(asked.groupBy("kind", "code").agg(F.sum("n").alias("n")))
    known = {r["kind"]: (r["n"], r["v"]) for r in counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("v")).collect()}
    ends = packed.agg(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0
    n, v = known.get(WORD, (0, 0))
    n, v = n + ends, v + bool(ends)
    strings = code_lengths(counts.filter(F.col("kind") == GRAM)).select(F.lit(GRAM).cast("byte").alias("kind"), "code", "n", "value")
    words = counts.filter(F.col("kind") == WORD).select("kind", "code", "n", F.log10(F.col("n") + 1.0).alias("value"))
    values = cut(strings.unionAll(words))
    least = F.when(F.col("kind") == GRAM, max(2, known.get(GRAM, (0, 0))[0] / COMMON)).otherwise(max(2, n / COMMON))
    common = values.filter(F.col("n") >= least).select("kind", "code", "value").toArrow()
    tables = {}
    for kind in (GRAM, WORD):
        mine = common.filter(pc.equal(common["kind"], kind))
        code = mine["code"].to_numpy().view(np.uint64)
        order = np.argsort(code)
        tables[kind] = code[order], mine["value"].to_numpy()[order]
    sent = spark.sparkContext.broadcast(tables)
    rare = values.filter(F.col("n") < least).select("kind", "code", "value")
    # What is sent need not be shuffled: at most COMMON keys of each kind.
    sought = asked.select("unit", "kind", "code").join(F.broadcast(values.filter(F.col("n") >= least).select("kind", "code")), ["kind", "code"], "left_anti")
    lists = [F.collect_list(F.when(F.col("kind") == kind, F.col(c))).alias(f"{c}_{kind}") for kind in (GRAM, WORD) for c in ("code", "value")]
    own = sought.join(rare, ["kind", "code"]).groupBy("unit").agg(*lists)
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                ids, held = b.column("ids")[k].values, b.column("held")[k].values
                mine = {GRAM: [sent.value[GRAM]], WORD: [sent.value[WORD]]}
                for t in mine:
                    if b.column(f"code_{t}")[k].is_valid:
                        c, y = b.column(f"code_{t}")[k].values.to_numpy().view(np.uint64), b.column(f"value_{t}")[k].values.to_numpy()
                        order = np.argsort(c)
                        mine[t].append((c[order], y[order]))
                for lo, hi, o, d in _slices(b.column("sizes")[k].values.to_numpy(), b.column("z")[k].as_py()):
                    m = hi - lo
                    code, doc = grams(o, d)
                    ppm = np.bincount(doc, _looked_up(mine[GRAM], code), minlength=m)
                    code, doc = _words(o, d)
                    logs = _looked_up(mine[WORD], code)
                    tokens = np.bincount(doc, minlength=m) + 1
                    base = np.bincount(doc, logs, minlength=m) + np.log10(ends + 1.0) - tokens * np.log10(n + v + 1.0)
                    seen = np.bincount(doc, logs > 0, minlength=m).astype(np.int64) + int(ends > 0)
                    yield pa.RecordBatch.from_arrays([ids.slice(lo, m), held.slice(lo, m), pa.array(tokens.astype(np.int64)), pa.array(seen), pa.array(np.full(m, n, np.int64)), pa.array(base), pa.array(ppm)], names)

    out = cut(packed.join(own, "unit", "left").mapInArrow(tx.tidy(run), f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))
    discard(packed, asked, counts, values)
    return out
