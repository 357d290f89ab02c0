"""Operator 2: n-gram Jaccard join with prefix trees.

1. Every text's set of K-word shingles; texts of equal sets are one class, named by a 64-bit hash
   of the set. A second hash shows whether two sets took one name; then all are named anew.
2. Each shingle's number of classes is counted in hash buckets of about BUCKET shingles (packed
   arrays, one shuffle). Shingles that are common within single tasks already are summed up first;
   those of HOT sets or more (and no more than one in 2**20 of all shingles) skip the buckets with
   that sum as their number. Only shingles of two or more classes can be common to two sets, so
   only they go on.
3. In the global order (rarest first) a set of n has to share one of its first
   n - ceil(0.75 n) + 1 shingles with any partner. A set whose shingles of its own alone fill
   these places has no partner and is done; the others post their remaining places.
4. The sets that post one shingle meet under the most central of them (the one whose shingles are
   most widely shared), so that a family of near copies meets in few places however many shingles
   it shares, and every similar pair meets somewhere. A meeting is dealt into blocks of about
   BLOCK shingles, its centre into each.
5. A block is joined with itself in one trie of its sets, commonest shingle first, so that near
   copies share paths. The walk of a set carries the overlap along shared paths, and cuts subtrees
   which the remaining lengths cannot lift to the needed overlap, or whose sets are all in its own
   component already. Links become components by alternating stars.
6. Of a meeting in several blocks only sets that are not in the centre's component may still miss a
   link: they are walked through the tries of those other blocks whose sizes and largest shared
   lengths leave room for a partner. Texts with one passage in common and more of their own than a
   link allows are sent nowhere.

Defined results: null and empty texts and texts without words have no shingles and are alone; a
text with fewer than K words is one shingle; equal rows, repeated ids included, are linked; a null
id is never a component's name if another id is there. Shingles are told apart by 64 bits of hash.
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm import text as tx
from cellweave.operators.components import connected_components
from cellweave.session import cut, discard

K, HOT, OFTEN, BUCKET, FLUSH, BLOCK = 5, 5_000, 16, 1 << 20, 3 << 18, 50_000
#: Similarity of at least 75/100, in integers: 100 i >= 75 (n + m - i), that is 7 i >= 3 (n + m).


def _sets(o: np.ndarray, d: np.ndarray, salt: int):
    """Distinct shingles of each text of a slice, in text order: hashes, texts, set sizes, set names, second names."""
    h, doc, _ = tx.shingles(d, o, K)
    n_docs = len(o) - 1
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    n = np.bincount(doc, minlength=n_docs)
    end = np.cumsum(n)
    names = []
    for k in (2 * salt, 2 * salt + 1):
        total = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(tx.mix(h ^ np.uint64(0x9E3779B97F4A7C15 * k & (1 << 64) - 1)), out=total[1:])
        names.append(tx.mix(total[end] - total[end - n] + n.astype(np.uint64)).view(np.int64))
    return h, doc, n, *names


class _Flush:
    """Shingles with their set's name and size, of the different sets of about FLUSH shingles at a time."""

    def __init__(self):
        self.held, self.size, self.names = [], 0, set()

    def add(self, h: np.ndarray, doc: np.ndarray, n: np.ndarray, name: np.ndarray) -> bool:
        """Whether it is time to take them."""
        keep = np.zeros(len(n), bool)
        for k, x in enumerate(name.tolist()):
            if x not in self.names:
                self.names.add(x)
                keep[k] = True
        keep = keep[doc]
        doc = doc[keep]
        self.held.append((h[keep], name[doc], n[doc].astype(np.uint32)))
        self.size += len(doc)
        return self.size >= FLUSH

    def take(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        out = tuple(np.concatenate(x) for x in zip(*self.held))
        self.__init__()
        return out


def _known(docs: DataFrame, id_col: str, text_col: str, salt: int) -> DataFrame:
    """A row for each text (doc_id, text_key, n_shingles, set, check), and rows (token, seen) of shingles that a task met often."""
    names = ["doc_id", "text_key", "n_shingles", "set", "check", "token", "seen"]

    def run(batches):
        none = lambda n: pa.nulls(n, pa.int64())
        flush = _Flush()

        def often(kind):
            u, times = np.unique(flush.take()[0], return_counts=True)
            u, times = u[times >= OFTEN], times[times >= OFTEN]
            return pa.RecordBatch.from_arrays([pa.nulls(len(u), kind), *[none(len(u))] * 4, pa.array(u.view(np.int64)), pa.array(times.astype(np.int64))], names)

        for b in batches:
            kind = b.schema.field(0).type
            for lo, hi, o, d in tx.slices(b, "text"):
                h, doc, n, name, check = _sets(o, d, salt)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), pa.array(n.astype(np.int64)), pa.array(name), pa.array(check), none(hi - lo), none(hi - lo)], names)
                if flush.add(h, doc, n, name):
                    yield often(kind)
        if flush.size:
            yield often(kind)

    kind = docs.schema[id_col].dataType.simpleString()
    text = docs[text_col]
    rows = docs.select(docs[id_col].alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_key"), text.alias("text"))
    return rows.mapInArrow(tx.tidy(run), f"doc_id {kind}, text_key long, n_shingles long, set long, check long, token long, seen long")


def keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, int]:
    """Rows of the texts, rows of often met shingles, and the salt with which no two sets have one name."""
    for salt in count():
        found = cut(_known(docs, id_col, text_col, salt))
        known = found.filter("seen is null").select("doc_id", "text_key", "n_shingles", "set", "check")
        twice = known.groupBy("set").agg(F.min("check").alias("a"), F.max("check").alias("b"), F.min("n_shingles").alias("x"), F.max("n_shingles").alias("y"))
        if twice.filter("a <> b or x <> y").isEmpty():
            return known, found.filter("seen is not null").select("token", "seen"), salt
        discard(found)


def _bytes(x: np.ndarray, edge: np.ndarray) -> list[bytes]:
    return [x[a:b].tobytes() for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]


def _packed(docs: DataFrame, text_col: str, salt: int, buckets: int, hot: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Shingles with their set's name and size for each bucket; hot ones, with their number, go to bucket -1 - (bucket of the set)."""
    sent = docs.sparkSession.sparkContext.broadcast(hot)
    names, kinds = ["bucket", "token", "set", "n", "df"], [pa.int32(), *[pa.binary()] * 4]

    def deal(h, s, n):
        hot_token, hot_df = sent.value
        to, df = (h % np.uint64(buckets)).astype(np.int64), None
        if len(hot_token):
            at = np.minimum(np.searchsorted(hot_token, h), len(hot_token) - 1)
            is_hot = hot_token[at] == h
            to[is_hot] = -1 - (s[is_hot].view(np.uint64) % np.uint64(buckets)).astype(np.int64)
            df = hot_df[at].astype(np.uint32)
        order = np.argsort(to, kind="stable")
        to, h, s, n = to[order], h[order], s[order], n[order]
        begin = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
        edge = np.append(begin, len(to))
        dfs = [None] * len(begin)
        if df is not None:
            df = df[order]
            dfs = [df[a:b].tobytes() if k < 0 else None for k, a, b in zip(to[begin].tolist(), begin.tolist(), edge[1:].tolist())]
        cols = [to[begin].astype(np.int32), _bytes(h, edge), _bytes(s, edge), _bytes(n, edge), dfs]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    def run(batches):
        flush = _Flush()
        for b in batches:
            for _, _, o, d in tx.slices(b, "text"):
                if flush.add(*_sets(o, d, salt)[:4]):
                    yield deal(*flush.take())
        if flush.size:
            yield deal(*flush.take())

    return docs.select(docs[text_col].alias("text")).mapInArrow(tx.tidy(run), "bucket int, token binary, set binary, n binary, df binary")


def _shared(buckets: int):
    """In one bucket: shingles of two or more sets, dealt out by set."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        bucket = int(pdf["bucket"].iloc[0])
        if bucket < 0:
            return pdf.rename(columns={"bucket": "to"})[["to", "set", "n", "token", "df"]].assign(to=np.int32(-1 - bucket))
        token, name, n = (np.frombuffer(b"".join(pdf[c]), k) for c, k in (("token", np.uint64), ("set", np.int64), ("n", np.uint32)))
        order = np.argsort(token, kind="stable")
        t = token[order]
        same = np.zeros(len(t) + 1, bool)
        same[1:-1] = t[1:] == t[:-1]
        order = order[same[1:] | same[:-1]]  # shingles that stand more than once
        order = order[np.lexsort((name[order], token[order]))]
        t, s = token[order], name[order]
        new = np.ones(len(t), bool)
        new[1:] = (t[1:] != t[:-1]) | (s[1:] != s[:-1])
        order, t = order[new], t[new]  # each once for each set
        first = np.flatnonzero(np.append(True, t[1:] != t[:-1])[: len(t)])
        df = np.diff(np.append(first, len(t)))
        df = np.repeat(df, df)
        keep = df > 1
        order, t, df = order[keep], t[keep], df[keep].astype(np.uint32)
        if not len(t):
            return pd.DataFrame({"to": pd.Series(dtype="int32"), "set": [], "n": [], "token": [], "df": []})
        s, n = name[order], n[order]
        to = (s.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
        by = np.lexsort((s, to))
        to, s, n, t, df = to[by], s[by], n[by], t[by], df[by]
        begin = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
        edge = np.append(begin, len(to))
        del token, name, order, same, first, keep, new, by
        tx.trim()
        return pd.DataFrame({"to": to[begin].astype(np.int32), "set": _bytes(s, edge), "n": _bytes(n, edge), "token": _bytes(t, edge), "df": _bytes(df, edge)})

    return run


def _candidates(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sets that may have a partner: size, shared shingles in the global order, places to post, and how widely shared the set is."""
    s, n, t, df = (np.frombuffer(b"".join(pdf[c]), k) for c, k in (("set", np.int64), ("n", np.uint32), ("token", np.int64), ("df", np.uint32)))
    order = np.lexsort((t, df, s))
    s, t, df, n = s[order], t[order], df[order], n[order].astype(np.int64)
    new = np.append(True, (s[1:] != s[:-1]) | (t[1:] != t[:-1]))[: len(s)]  # hot shingles come once for each flush
    s, t, df, n = s[new], t[new], df[new], n[new]
    begin = np.flatnonzero(np.append(True, s[1:] != s[:-1])[: len(s)])
    size = np.diff(np.append(begin, len(s)))
    n = n[begin]
    post = (n - (3 * n + 3) // 4 + 1) - (n - size)
    heart = np.add.reduceat(np.log(df), begin) / n if len(begin) else n
    rows = [(int(s[b]), int(m), t[b : b + k], int(min(p, k)), float(w)) for b, k, m, p, w in zip(begin, size, n, post, heart) if p > 0]
    return pd.DataFrame(rows, columns=["set", "n", "tokens", "post", "heart"])


class Trie:
    """Sets under their shingles, commonest first, with what the walk needs to cut: longest rest, least size, and the one component below, if it is one."""

    def __init__(self):
        self.root = self._node(0, 1 << 60, None)
        self.up: dict[int, int] = {}

    @staticmethod
    def _node(rest, least, member):
        return [{}, rest, least, member, False, []]  # children, longest rest, least size, a set below, several components, sets that end here

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    def join(self, a: int, b: int) -> None:
        self.up[self.find(a)] = self.find(b)

    def insert(self, name: int, n: int, tokens: list[int]) -> None:
        """``tokens``: shared shingles in the trie's order."""
        node, rest, own = self.root, len(tokens), self.find(name)
        last = -1
        while True:
            if rest > node[1]:
                node[1] = rest
            if n < node[2]:
                node[2] = n
            if node[3] is None:
                node[3] = name
            elif not node[4] and self.find(node[3]) != own:
                node[4] = True
            last += 1
            if not rest:
                break
            rest -= 1
            t = tokens[last]
            nxt = node[0].get(t)
            if nxt is None:
                nxt = node[0][t] = self._node(rest, n, name)
            node = nxt
        node[5].append((name, n))

    def links(self, name: int, n: int, tokens: list[int]) -> list[int]:
        """Similar sets that were not in the component of set ``name``; they join it."""
        member, out = set(tokens), []
        most, find = len(tokens), self.find
        stack = [(self.root, 0)]
        while stack:
            node, common = stack.pop()
            if not node[4] and node[3] is not None and find(node[3]) == find(name):
                continue
            for other, m in node[5]:
                if 7 * common >= 3 * (n + m) and find(other) != find(name):
                    out.append(other)
                    self.join(other, name)
            near = []
            for t, child in node[0].items():
                c = common + (t in member)
                if 7 * (c + min(child[1], most - c)) >= 3 * (n + child[2]):
                    (near if c > common else stack).append((child, c))
            stack += near
        return out


def _joined(batches):
    """Links of blocks: rows sorted by (centre, sub, query). Sets of query -1 go into the trie, of 0 walk it first, of 1 only walk it."""
    key, trie, out = None, None, []
    for b in batches:
        tokens = b.column("tokens")
        offs, flat = tokens.offsets.to_numpy(), tokens.values.to_numpy()
        for k, (centre, sub, query, name, n, root) in enumerate(zip(*(b.column(c).to_pylist() for c in ("centre", "sub", "query", "set", "n", "root")))):
            if (centre, sub) != key:
                key, trie = (centre, sub), Trie()
            for x in (name, root):
                trie.up.setdefault(x, x)
            trie.join(name, root)
            mine = flat[offs[k] : offs[k + 1]][::-1].tolist()
            if query >= 0:
                out += [(name, other) for other in trie.links(name, n, mine)]
            if query <= 0:
                trie.insert(name, n, mine)
        if len(out) > 10_000:
            yield _pairs(out)
            out = []
    if out:
        yield _pairs(out)


def _pairs(out: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*out)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _links(dealt: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b of similar sets of each block; ``dealt`` has centre, sub, query, set, root."""
    # By merge at every size: the rows grow with the input, so they are never sent whole to all tasks.
    rows = dealt.hint("merge").join(sets.select("set", "n", "tokens"), "set").repartition("centre", "sub")
    rows = rows.sortWithinPartitions("centre", "sub", "query", F.col("set") != F.col("centre"), "set")
    return rows.select("centre", "sub", "query", "set", "n", "root", "tokens").mapInArrow(tx.tidy(_joined), "a long, b long")


def candidates(docs: DataFrame, known: DataFrame, often: DataFrame, salt: int, text_col: str = "text") -> DataFrame:
    """set, n, tokens, post, heart of the sets that may have a partner."""
    total = known.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(1, -(-total // BUCKET))
    # At most total / HOT and at most 2**20 shingles reach the bound, as the sums of all are at most ``total``.
    hot = often.groupBy("token").agg(F.sum("seen").alias("df")).filter(F.col("df") >= max(HOT, total >> 20)).toArrow()
    token = hot["token"].to_numpy().view(np.uint64)
    order = np.argsort(token)
    packed = _packed(docs, text_col, salt, buckets, (token[order], hot["df"].to_numpy()[order]))
    shared = packed.groupBy("bucket").applyInPandas(_shared(buckets), "to int, set binary, n binary, token binary, df binary")
    return cut(shared.groupBy("to").applyInPandas(_candidates, "set long, n long, tokens array<long>, post int, heart double"))


def meetings(sets: DataFrame) -> DataFrame:
    """centre, set, n, own, rest: each set under the centres of the shingles that it posts; no partner met there shares more than ``rest``."""
    posts = sets.select("set", "n", "heart", F.posexplode(F.slice("tokens", 1, F.col("post"))).alias("at", "token"), F.size("tokens").alias("own"))
    posts = posts.withColumn("place", F.col("n") - F.col("own") + F.col("at"))
    # A place lets in partners of 3/4 the size at least only if enough of the set follows it.
    posts = posts.filter("7 * (n - place) >= 3 * n + ceil(9 * n / 4)")
    centres = posts.groupBy("token").agg(F.max_by("set", F.struct("heart", "set")).alias("centre"), F.count("*").alias("many")).filter("many > 1")
    met = posts.select("token", "set", "n", "own", "place").join(centres.select("token", "centre"), "token")
    return met.groupBy("centre", "set").agg(F.first("n").alias("n"), F.first("own").alias("own"), F.max(F.col("n") - F.col("place")).alias("rest"))


def blocks_of(met: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of small meetings, rows (with sub) of large ones, and the number of blocks (subs) of each kind in a large one.

    A kind is a range of sizes (a factor of 4/3) and whether sets of its own size come into
    question: of two similar sets the smaller one always shares enough for that, so two sets that
    don't are never similar.
    """
    large = cut(met.groupBy("centre").agg(F.sum("own").alias("total")).filter(F.col("total") > BLOCK))
    level = F.floor(F.log(F.col("n").cast("double")) / float(np.log(4 / 3))).cast("long")
    kind = 2 * level + (7 * F.col("rest") >= 6 * F.col("n")).cast("long")
    big = met.join(large.select("centre"), "centre").withColumn("kind", kind)
    blocks = cut(big.groupBy("centre", "kind").agg(F.ceil(F.sum("own") / BLOCK).cast("long").alias("subs")))
    big = big.join(blocks, ["centre", "kind"]).withColumn("sub", F.shiftleft("kind", 32) + F.pmod(F.xxhash64("set"), F.col("subs")))
    return met.join(large.select("centre"), "centre", "left_anti"), cut(big.select("centre", "sub", "set", "n", "rest")), blocks


def open_walks(big: DataFrame, roots: DataFrame) -> DataFrame:
    """centre, sub, set, root: sets outside their centre's component, once for each other block that can hold a partner."""
    rows = big.join(roots, "set", "left").withColumn("root", F.coalesce("root", "set"))
    heart = rows.filter("set = centre").select("centre", F.col("root").alias("heart"))
    reach = F.max(7 * F.col("rest") - 3 * F.col("n"))
    summary = big.groupBy("centre", F.col("sub").alias("to")).agg(F.min("n").alias("least"), F.max("n").alias("most"), reach.alias("reach"))
    met = rows.join(heart, "centre").filter("root <> heart").join(summary, "centre")
    able = "sub <> to and 3 * least <= 7 * rest - 3 * n and 3 * n <= reach and 3 * n <= 4 * most and 3 * least <= 4 * n"
    # Of two kinds that don't reach their own size no pair is similar.
    return met.filter(able).filter("shiftright(sub, 32) & 1 = 1 or shiftright(to, 32) & 1 = 1").select("centre", F.col("to").alias("sub"), "set", "root")


def set_components(docs: DataFrame, known: DataFrame, often: DataFrame, salt: int, text_col: str = "text") -> DataFrame:
    """set, root of sets that link with others."""
    sets = candidates(docs, known, often, salt, text_col)
    met = cut(meetings(sets))
    small, big, blocks = blocks_of(met)
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("subs") - 1)).alias("k")
    centres = blocks.select("centre", "kind", every).select("centre", (F.shiftleft("kind", 32) + F.col("k")).alias("sub"), F.col("centre").alias("set"))
    first = small.select("centre", F.lit(-1).cast("long").alias("sub"), "set").unionAll(big.filter("set <> centre").select("centre", "sub", "set")).unionAll(centres)
    links = cut(_links(first.select("centre", "sub", F.lit(0).alias("query"), "set", F.col("set").alias("root")), sets))
    roots = cut(connected_components(links).select(F.col("node").alias("set"), "root"))
    again = cut(open_walks(big, roots))
    if not again.isEmpty():
        there = big.join(again.select("centre", "sub").distinct(), ["centre", "sub"], "left_semi").join(roots, "set", "left")
        there = there.select("centre", "sub", F.lit(-1).alias("query"), "set", F.coalesce("root", "set").alias("root"))
        more = cut(_links(again.select("centre", "sub", F.lit(1).alias("query"), "set", "root").unionAll(there), sets))
        found = links.unionAll(more)
        discard(roots)
        roots = cut(connected_components(found).select(F.col("node").alias("set"), "root"))
        discard(more)
    discard(sets, met, big, blocks, links, again)
    return roots


def _classes(known: DataFrame, roots: DataFrame) -> DataFrame:
    """For each set of a component of several rows: set, and the component's first row (by id, null last, then text)."""
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    classes = known.filter("n_shingles > 0").groupBy("set").agg(F.min(row).alias("least"), F.count("*").alias("rows"))
    named = classes.join(roots, "set", "left").withColumn("root", F.coalesce("root", "set"))
    whole = named.groupBy("root").agg(F.min("least").alias("first"), F.sum("rows").alias("rows")).filter("rows > 1")
    return named.join(whole.select("root", "first"), "root").select("set", "first")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_key, n_shingles, set of every row, and ``first`` of rows in components of several."""
    known, often, salt = keys(docs, id_col, text_col)
    roots = set_components(docs, known, often, salt, text_col)
    return known.join(_classes(known, roots), "set", "left")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest id that similar sets lead to."""
    return _rows(docs, id_col, text_col).select("doc_id", "n_shingles", F.coalesce("first.doc_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component: that of the smallest id (null ids last; of one id, one text).

    Rows without shingles all stay, repeated or not; of rows equal in id and text one stays, if they
    have shingles. Whole rows are kept with all their columns, whatever these are called.
    """
    rows = cut(_rows(docs, id_col, text_col).filter("first is not null"))
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))

    # By merge at every size: these rows grow with the input, so they are never sent whole to all tasks.
    def these(found: DataFrame, how: str, of: DataFrame) -> DataFrame:
        x = found.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct().hint("merge")
        return of.join(x, of[id_col].eqNullSafe(x["__id"]) & (F.xxhash64(F.coalesce(of[text_col], F.lit(""))) == x["__key"]), how)

    kept = these(rows.filter(~same), "left_anti", docs)
    again = rows.filter(same).groupBy("doc_id", "text_key").count().filter("count > 1")
    if again.isEmpty():
        return kept
    return these(again, "left_anti", kept).unionAll(these(again, "left_semi", kept).dropDuplicates([id_col, text_col]))
