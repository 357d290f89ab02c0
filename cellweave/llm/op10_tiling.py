"""Operator 10: benchmark decontamination by greedy string tiling.

Benchmark items come in blocks of at most BLOCK_WORDS words (a stated query set against all rows).
Of each text the word SEED-grams that an item of the block has are the seeds; texts without a seed
are done, and so are pairs whose seeds cannot cover SHARE of the item. For each other (text, item)
the longest common run of words that is not yet marked is marked, again and again, down to SEED
words: its length is found by running Karp-Rabin hashes of both sides (a common run of one length
means common runs of all shorter ones, so the length is halved in on), and equal hashes are compared
word by word. Memory and time follow the lengths of the two sides, not the number of their equal
seeds. An item counts as leaked if tiles cover at least SHARE of its words, in any order.

Defined results: a null or empty text or item matches nothing; items shorter than SEED words match
as one run of all their words; every pair is reported once for each input row; repeated items with
one id count as one item if their text is equal, else each for itself.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cellweave.llm import text as tx

SEED, SHARE, BLOCK_WORDS = 5, 0.5, 1_000_000


class _Side:
    """Words of one side with running hashes of their runs, and which words are marked."""

    def __init__(self, words: np.ndarray, marked: np.ndarray):
        n = len(words)
        self.words, self.marked, self.n = words, marked, n
        self.power, self.inverse = tx.powers(n + 1)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(words * self.power[:n], out=self.total[1:])

    def runs(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the unmarked runs of ``size`` words."""
        if size > self.n:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        gone = np.zeros(self.n + 1, np.int64)
        np.cumsum(self.marked, out=gone[1:])
        at = np.flatnonzero(gone[size:] == gone[:-size])
        return at, (self.total[at + size] - self.total[at]) * self.inverse[at]


def tiles(text: np.ndarray, item: np.ndarray, seeds: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(text start, item start, length) of the greedy tiling; ``seeds`` are the starts in the text, ascending,
    of all runs of ``least`` words that the item has too. Longest first, ties by place in the text, then in the item."""
    if not len(seeds):
        return []
    # Only words of seeds can match: these stretches, each set off by one marked word.
    first = np.flatnonzero(np.append(True, np.diff(seeds) >= least))
    begin, size = seeds[first], seeds[np.append(first[1:], len(seeds)) - 1] + least - seeds[first]
    step = size + 1
    offset = np.cumsum(step) - step
    at = np.repeat(begin - offset, step) + np.arange(int(step.sum()))
    edge = np.zeros(len(at), bool)
    edge[offset + size] = True
    t, i = _Side(text[np.minimum(at, len(text) - 1)], edge), _Side(item, np.zeros(len(item), bool))
    longest, out = int(min(size.max(), len(item))), []

    def common(n: int) -> bool:
        return bool(np.isin(t.runs(n)[1], i.runs(n)[1]).any())

    while longest >= least:
        if not common(longest):
            low, high = least - 1, longest  # common(low), not common(high)
            while high - low > 1:
                mid = (low + high) // 2
                low, high = (mid, high) if common(mid) else (low, mid)
            longest = low
            if longest < least:
                break
        at_t, hash_t = t.runs(longest)
        at_i, hash_i = i.runs(longest)
        places = defaultdict(list)
        for p, h in zip(at_i[::-1].tolist(), hash_i[::-1].tolist()):
            places[h].append(p)  # the first place last
        match, end = np.isin(hash_t, hash_i), 0
        for p, h in zip(at_t[match].tolist(), hash_t[match].tolist()):
            free = places[h]
            while free and i.marked[free[-1] : free[-1] + longest].any():
                free.pop()
            if p < end or not free:
                continue
            q = free.pop()
            if (t.words[p : p + longest] == item[q : q + longest]).all():
                t.marked[p : p + longest] = i.marked[q : q + longest] = True
                out.append((int(at[p]), q, longest))
                end = p + longest
        longest -= 1  # every run of this length is taken or cut
    return out


class Finder:
    """Search of one block of items in batches of texts."""

    def __init__(self, items: list[tuple[object, str]], share: float):
        self.items, self.share = items, share
        data = [(t or "").encode() for _, t in items]
        offs = np.cumsum([0, *map(len, data)])
        raw = np.frombuffer(b"".join(data), np.uint8)
        s, e, doc = tx.words(raw, offs)
        h = tx.span_hashes(tx.LOWER[raw], s, e)
        self.words = np.split(h, np.searchsorted(doc, np.arange(1, len(items))))
        self.grams: dict[int, np.ndarray] = {}  # of each item, all its seeds
        self.known: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}  # by seed size: seeds, and the items of each
        for size in sorted({min(SEED, len(w)) for w in self.words if len(w)}):
            g, of, _ = tx.shingles(raw, offs, size, short=False)
            mine = np.array([min(SEED, len(w)) == size for w in self.words])[of] if len(of) else np.empty(0, bool)
            g, of = g[mine], of[mine]
            edge = np.flatnonzero(np.append(True, of[1:] != of[:-1])[: len(of)])
            self.grams |= dict(zip(of[edge].tolist(), np.split(g, edge[1:])))
            pair = np.unique(np.column_stack([g, of.astype(np.uint64)]), axis=0)
            seeds, begin = np.unique(pair[:, 0], return_index=True)
            self.known[size] = seeds, np.append(begin, len(pair)), pair[:, 1].astype(np.int64)

    def __call__(self, batch: pa.RecordBatch, column: str):
        """(row, item, covered, item words, tiles) of leaked items."""
        for lo, _, o, d in tx.slices(batch, column):
            words = None
            for size, (seeds, begin, items) in self.known.items():
                g, doc, at = tx.shingles(d, o, size, short=False)
                k = np.flatnonzero(seeds[np.minimum(np.searchsorted(seeds, g), len(seeds) - 1)] == g)
                if not len(k):
                    continue
                if words is None:
                    s, e, of = tx.words(d, o)
                    words, first = tx.span_hashes(tx.LOWER[d], s, e), np.searchsorted(of, np.arange(len(o)))
                # One row for each seed in the text and item that has it; items apart, places ascending.
                seed = np.searchsorted(seeds, g[k])
                many = begin[seed + 1] - begin[seed]
                item = items[np.repeat(begin[seed] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))]
                k = np.repeat(k, many)
                order = np.lexsort((at[k], item, doc[k]))
                k, item = k[order], item[order]
                edge = np.flatnonzero(np.append(True, (item[1:] != item[:-1]) | (doc[k[1:]] != doc[k[:-1]])))
                for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(k)]):
                    which, dd = int(item[a]), int(doc[k[a]])
                    w, grams = self.words[which], self.grams[which]
                    there = np.flatnonzero(np.isin(grams, g[k[a:b]]))
                    reach = np.minimum(np.diff(there, append=there[-1] + size), size).sum()
                    if reach < self.share * len(w):
                        continue
                    found = tiles(words[first[dd] : first[dd + 1]], w, at[k[a:b]] - first[dd], size)
                    covered = sum(x[2] for x in found)
                    if covered and covered >= self.share * len(w):
                        yield lo + dd, self.items[which][0], covered, len(w), len(found)


def _blocks(benchmark: DataFrame, item_col: str, item_text: str):
    """The items in blocks of about BLOCK_WORDS words, one block in memory at a time; at least one block."""
    block, size, any_ = [], 0, False
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text")).distinct()
    for item in items.toLocalIterator():
        n = len((item["text"] or "").split())
        if n:
            block.append((item["item_id"], item["text"]))
            size += n
        if size >= BLOCK_WORDS:
            yield block
            block, size, any_ = [], 0, True
    if block or not any_:
        yield block


def leaks(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, covered, item_words, n_tiles, coverage of every pair at or over ``share``."""
    spark = docs.sparkSession
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    item_arrow = to_arrow_type(benchmark.schema[item_col].dataType)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    names = ["doc_id", "item_id", "covered", "item_words", "n_tiles", "coverage"]

    def search(block):
        sent = spark.sparkContext.broadcast(block)

        def run(batches):
            find = Finder(sent.value, share)
            for b in batches:
                if out := list(find(b, "text")):
                    at, item, covered, whole, n = zip(*out)
                    cover = [c / w for c, w in zip(covered, whole)]
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array(item, item_arrow), *[pa.array(c, pa.int64()) for c in (covered, whole, n)], pa.array(cover)], names)

        return rows.mapInArrow(tx.tidy(run), f"doc_id {kind}, item_id {item_kind}, covered long, item_words long, n_tiles long, coverage double")

    parts = [search(block) for block in _blocks(benchmark, item_col, item_text)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that leak no item, each judged by its own text; no shuffle."""
    spark = docs.sparkSession
    for block in _blocks(benchmark, item_col, item_text):
        sent = spark.sparkContext.broadcast(block)

        def run(batches, sent=sent):
            find = Finder(sent.value, share)
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                keep[[x[0] for x in find(b, text_col)]] = False
                yield b.filter(pa.array(keep))

        docs = docs.mapInArrow(tx.tidy(run), docs.schema)
    return docs

