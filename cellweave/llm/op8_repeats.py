"""Operator 8: suffix-array dedup by column-wise multi-document construction.

A byte is removed if it lies in a string of SPAN bytes that starts at another place too. Comparing
every suffix of a collection is not needed for that:

1. Equal texts are one class; of a class of two or more, all strings of SPAN bytes repeat. Classes
   have 64-bit names; a second hash shows whether two texts took one name, and then all are named anew.
2. Each string of SPAN bytes names the place of the smallest hash among its GRAM-byte grams, ties
   to the left (its anchor). Equal strings name anchors of equal hash at equal offsets, so strings
   are compared only where their anchors' hashes are equal, and only anchor hashes that stand at
   two places go on. The strings of an anchor start in one run [first, last] of places.
3. In a bucket of anchors the pieces [first, last + SPAN) are laid one on another with the anchors
   in one column. The collection's suffix order is then built from the right: each round inserts
   one symbol of each piece, moves the order by a stable sort on it (the column is the newest part
   of the transform), and makes the common prefixes anew as one more than the least between
   neighbours of one symbol. A start whose common prefix with a neighbour is SPAN or more repeats.
4. Anchors at more than HOT places are not laid together: their strings' hashes (128 bits) are
   counted by an ordinary aggregation instead, which splits and combines before the shuffle.
5. Runs of one short period, where every place would be an anchor, are decided by comparing the
   text with itself shifted by the period; one period stays as a sample for the others.

Pieces pass between steps as compressed blocks in shuffle files, which are the sequential external
files of the construction. Candidate places rest on 64-bit hashes (a collision only costs work);
steps 3 and 5 compare bytes.

Defined results: a null or empty text has 0 bytes, nothing removed and the digest of nothing; texts
shorter than SPAN lose nothing; repeated rows are separate documents; null ids are allowed.

``strip`` can also judge by words: the construction then runs over texts in which each word is
SYMBOL bytes of its hash (7 bits each, so 42 bits), and a span is so many symbols. ``removed``
counts such passages of PASSAGE words or more beside the bytes, as many are shorter than SPAN bytes. Whitespace is
not compared. A run of over UNBROKEN bytes without a separator is no word of a language with
spaces; its bytes stand for themselves, so that SYMBOL of them count as a word.
"""

from __future__ import annotations

import hashlib
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cellweave.llm import text as tx
from cellweave.session import cut, discard

SPAN, GRAM, HOT = 400, 32, 50_000
SYMBOL, UNBROKEN, PASSAGE = 6, 64, 51
#: Bytes of pieces in a bucket, about.
BUCKET = 16 << 20
# An anchor lies at most span - GRAM behind the start of its string.


def _gram_hashes(d: np.ndarray) -> np.ndarray:
    h, base, k = d.astype(np.uint64) + np.uint64(1), 0x9E3779B97F4A7C15, 1
    while k < GRAM:
        h = h[:-k] * np.uint64(pow(base, k, 1 << 64)) + h[k:]
        k *= 2
    return tx.mix(h)


def _anchors(d: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, place, first and last start of each anchor of one text of ``span`` bytes or more."""
    h, near = _gram_hashes(d), span - GRAM
    w = near + 1
    starts = len(d) - span + 1
    n = -(-len(h) // w) * w
    x = np.full(n, np.uint64(2**64 - 1))
    x[: len(h)] = h
    x = x.reshape(-1, w)
    ahead = np.minimum.accumulate(x, 1).ravel()
    back = np.minimum.accumulate(x[:, ::-1], 1)[:, ::-1].ravel()
    low = np.minimum(back[:starts], ahead[w - 1 : w - 1 + starts])  # least hash of each start's window
    # Starts with one anchor: same least hash, and the leftmost such gram at or behind the start is the same.
    change = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
    size = np.diff(np.append(change, starts))
    out = []
    for a, m, v in zip(change.tolist(), size.tolist(), low[change].tolist()):
        at = a + np.flatnonzero(h[a : a + m + near] == np.uint64(v))
        if len(at) == 1:
            out.append((v, at[0], a, a + m - 1))
            continue
        first = a
        for p in at.tolist():
            last = min(p, a + m - 1)
            if last >= first:
                out.append((v, p, first, last))
                first = last + 1
            if first >= a + m:
                break
    v, p, a, b = zip(*out)
    return np.array(v, np.uint64), np.array(p), np.array(a), np.array(b)


def _periodic(d: np.ndarray, h: np.ndarray, p: np.ndarray, a: np.ndarray, b: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Which anchors still need comparing, and the spans [start, end) decided here."""
    need, spans = np.ones(len(p), bool), []
    tie = np.flatnonzero((h[1:] == h[:-1]) & (p[1:] - p[:-1] <= GRAM * 4))
    done = -1
    for k in tie.tolist():
        if p[k] < done:
            continue
        q = int(p[k + 1] - p[k])
        lo = int(p[k])
        # the maximal run around it in which the text equals itself shifted by q
        step = 4096
        s = lo
        while s > 0:
            c = max(0, s - step)
            bad = np.flatnonzero(d[c:s] != d[c + q : s + q])
            s = c + int(bad[-1]) + 1 if len(bad) else c
            if len(bad):
                break
        e, limit = lo, len(d) - q
        while e < limit:
            c = min(limit, e + step)
            bad = np.flatnonzero(d[e:c] != d[e + q : c + q])
            e = e + int(bad[0]) if len(bad) else c
            if len(bad):
                break
        if e - s >= span:
            spans.append((s, e + q))
            need &= ~((a >= s + q) & (b <= e - span + q))
            done = e
    return need, spans


def _find(docs: DataFrame, span: int) -> DataFrame:
    """Rows of (hash, key, place, first, last) for anchors, hash null for decided spans [first, last)."""

    def run(batches):
        for b in batches:
            keys = b.column(0).to_numpy()
            parts, spans = [], []
            for lo, _, o, d in tx.slices(b, "text"):
                for k in np.flatnonzero(np.diff(o) >= span).tolist():
                    one = d[o[k] : o[k + 1]]
                    h, p, s, e = _anchors(one, span)
                    if (h[1:] == h[:-1]).any():
                        need, own = _periodic(one, h, p, s, e, span)
                        spans += [(int(keys[lo + k]), x, y) for x, y in own]
                        h, p, s, e = h[need], p[need], s[need], e[need]
                    parts.append((h.view(np.int64), np.full(len(h), keys[lo + k]), p, s, e))
            cols = [np.concatenate(c) for c in zip(*parts)] if parts else [np.empty(0, np.int64)] * 5
            k, x, y = zip(*spans) if spans else ((), (), ())
            names = ["hash", "key", "place", "first", "last"]
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names)
            if spans:
                yield pa.RecordBatch.from_arrays([pa.array([None] * len(k), pa.int64()), pa.array(k), pa.array([0] * len(k)), pa.array(x), pa.array(y)], names)

    return docs.select("key", "text").mapInArrow(tx.tidy(run), "hash long, key long, place long, first long, last long")


def _packed_text(docs: DataFrame) -> DataFrame:
    """id, key, z: texts compressed for the shuffle."""

    def run(batches):
        z = zstandard.ZstdCompressor(1)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([z.compress(t.as_buffer()) if t.is_valid else z.compress(b"") for t in b.column(2)], pa.binary())], ["id", "key", "z"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "key", "text").mapInArrow(tx.tidy(run), f"id {kind}, key long, z binary")


def _pieces(rows: DataFrame, buckets: int, span: int) -> DataFrame:
    """Texts with their anchors to packed pieces for each bucket."""

    def run(batches):
        unpack, pack = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(3)
        for b in batches:
            out, size = {}, 0

            def flush():
                cols = [(k, np.concatenate(m).tobytes(), pack.compress(b"".join(t))) for k, (m, t) in out.items()]
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*cols), [pa.int32(), pa.binary(), pa.binary()])], ["bucket", "about", "bytes"])

            for key, z, found in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                d = unpack.decompress(z.as_buffer())
                f = np.array([(x["hash"], key, x["place"], x["first"], x["last"]) for x in found.as_py()], np.int64)
                to = (f[:, 0].view(np.uint64) % np.uint64(buckets)).astype(np.int64)
                for k, row in zip(to.tolist(), f):
                    meta, data = out.setdefault(k, ([], []))
                    meta.append(row)
                    data.append(d[row[3] : row[4] + span])
                    size += row[4] + span - row[3]
                if size > 16 << 20:
                    yield flush()
                    out, size = {}, 0
            if out:
                yield flush()

    return rows.mapInArrow(tx.tidy(run), "bucket int, about binary, bytes binary")


def column_wise(group: np.ndarray, first: np.ndarray, length: np.ndarray, data: np.ndarray, span: int = SPAN) -> np.ndarray:
    """Starts that repeat, as marks over ``data``.

    Piece k is data[sum(length[:k]):][:length[k]], its first byte ``first[k]`` columns left of its
    anchor; pieces of one group (ascending) are compared.
    """
    n, near_most = len(group), span - GRAM
    width = near_most + span
    begin = np.cumsum(length) - length
    left = near_most - first  # column of the first byte
    grid = np.full((n, width), 256, np.int16)
    flat = np.repeat(np.arange(n) * width + left - begin, length) + np.arange(len(data))
    grid.ravel()[flat] = data
    grid = np.ascontiguousarray(grid.T)
    order, common = np.arange(n), np.zeros(n + 1, np.int32)
    base = group.astype(np.int64) * 512
    marks = np.zeros(len(data), bool)
    for col in range(width - 1, -1, -1):
        c = grid[col][order]
        key = base[order] + c
        if (key[1:] >= key[:-1]).all():
            at = None
            nxt = common[:n] + 1
        else:
            at = np.argsort(key, kind="stable")
            order, key, c = order[at], key[at], c[at]
            nxt = np.ones(n, np.int32)
            near = at[1:] == at[:-1] + 1
            nxt[1:][near] += common[at[1:][near]]
            far = np.flatnonzero(~near & (key[1:] == key[:-1]) & (c[1:] != 256)) + 1
            if len(far):
                ends = np.empty(2 * len(far), np.int64)
                ends[0::2], ends[1::2] = at[far - 1] + 1, at[far] + 1
                nxt[far] = np.minimum.reduceat(common, ends)[0::2] + 1
        nxt[0] = 0
        nxt[1:][(key[1:] != key[:-1]) | (c[1:] == 256)] = 0
        common[:n] = nxt
        if col <= near_most:
            twice = common[:n] >= span
            twice[:-1] |= common[1:n] >= span
            k = order[twice]
            if len(k):
                marks[begin[k] + col - left[k]] = True
    return marks


def _construct(span: int):
    """Repeated spans of a bucket of anchors."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        unpack = zstandard.ZstdDecompressor()
        meta = np.concatenate([np.frombuffer(x, np.int64).reshape(-1, 5) for x in pdf["about"]])
        data = np.frombuffer(b"".join(unpack.decompress(x) for x in pdf["bytes"]), np.uint8)
        length = meta[:, 4] + span - meta[:, 3]
        begin = np.cumsum(length) - length
        by = np.argsort(meta[:, 0], kind="stable")
        keys, starts, ends = [], [], []
        at = 0
        while at < len(by):  # whole anchors, so many at once
            to = min(len(by), at + 20_000)
            while to < len(by) and meta[by[to], 0] == meta[by[to - 1], 0]:
                to += 1
            own = by[at:to]
            m, size = meta[own], length[own]
            place = np.cumsum(size) - size
            part = data[np.repeat(begin[own] - place, size) + np.arange(size.sum())]
            _, group = np.unique(m[:, 0], return_inverse=True)
            marks = column_wise(group, m[:, 2] - m[:, 3], size, part, span)
            edge = np.diff(np.concatenate([[0], marks.astype(np.int8), [0]]))
            a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            k = np.searchsorted(place, a, "right") - 1
            # a run never goes over a piece's end, as the last span - 1 places of a piece are no starts
            keys.append(m[k, 1])
            starts.append(m[k, 3] + a - place[k])
            ends.append(m[k, 3] + b - 1 - place[k] + span)
            at = to
        tx.trim()
        return pd.DataFrame({"key": np.concatenate(keys), "first": np.concatenate(starts), "last": np.concatenate(ends)})

    return run


def _windows(rows: DataFrame, span: int) -> DataFrame:
    """For hot anchors: hashes of all their strings (key, start, x, y)."""

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            for key, z, found in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                d = unpack.decompress(z.as_buffer())
                starts = np.concatenate([np.arange(f["first"], f["last"] + 1) for f in found.as_py()])
                x = [hashlib.blake2b(d[s : s + span], digest_size=16).digest() for s in starts.tolist()]
                xy = np.frombuffer(b"".join(x), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(starts), key)), pa.array(starts), pa.array(xy[:, 0].copy()), pa.array(xy[:, 1].copy())], ["key", "start", "x", "y"])

    return rows.mapInArrow(tx.tidy(run), "key long, start long, x long, y long")


def _key(text, salt: int):
    return F.xxhash64(F.lit(salt), text, F.octet_length(text))


def _classes(docs: DataFrame, id_col: str, text, span: int) -> tuple[DataFrame, int]:
    """key, id, rows, size of each different text of ``span`` bytes or more, and the salt with which no two have one key."""
    for salt in count():
        known = docs.select(docs[id_col].alias("id"), _key(text, salt).alias("key"), F.xxhash64(F.lit(-1 - salt), text).alias("check"), F.octet_length(text).alias("size")).filter(F.col("size") >= span)
        classes = cut(known.groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("rows"), F.first("size").alias("size"), F.min("check").alias("a"), F.max("check").alias("b")))
        if classes.filter("a <> b").isEmpty():
            return classes, salt
        discard(classes)


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, *, span: int = SPAN) -> tuple[DataFrame, int]:
    """id, key, spans: sorted byte ranges [first, last) to remove, for texts that have any; and the salt of the keys."""
    text = F.coalesce(docs[text_col], F.lit(""))
    classes, salt = _classes(docs, id_col, text, span)
    rows = docs.select(docs[id_col].alias("id"), _key(text, salt).alias("key"), text.alias("text"))
    known = rows.select("id", "key", F.octet_length("text").alias("size")).filter(F.col("size") >= span)
    found = cut(_find(rows, span))
    anchors = found.filter("hash is not null")
    twice = anchors.groupBy("hash").agg(F.min(F.struct("key", "place")).alias("lo"), F.max(F.struct("key", "place")).alias("hi"), F.count("*").alias("n")).filter("lo <> hi")
    twice = cut(twice.select("hash", "n", (F.col("n") > hot).alias("hot")))
    many, any_hot = twice.agg(F.sum(F.when(~F.col("hot"), F.col("n"))), F.coalesce(F.max("hot"), F.lit(False))).first()
    buckets = max(1, -(-(many or 0) * span * 3 // 2 // BUCKET))
    need = anchors.join(twice.select("hash", "hot"), "hash").groupBy("key").agg(F.collect_set(F.struct("hash", "place", "first", "last", "hot")).alias("found"))
    need = need.join(classes.select("key", "id"), "key").select(F.col("key").alias("n_key"), F.col("id").alias("n_id"), "found").hint("merge")
    z = _packed_text(rows.filter(F.octet_length("text") >= span))
    with_text = z.join(need, F.expr("key = n_key and id <=> n_id")).select("key", "z", "found")
    with_text = cut(with_text) if any_hot else with_text
    cold = with_text.select("key", "z", F.filter("found", lambda f: ~f["hot"]).alias("found")).filter(F.size("found") > 0)
    repeats = _pieces(cold, buckets, span).groupBy("bucket").applyInPandas(_construct(span), "key long, first long, last long")
    w = None
    if any_hot:
        w = cut(_windows(with_text.select("key", "z", F.filter("found", lambda f: f["hot"]).alias("found")).filter(F.size("found") > 0), span).distinct())
        more = w.groupBy("x", "y").count().filter("count > 1").select("x", "y")
        repeats = repeats.unionAll(w.join(more, ["x", "y"], "left_semi").selectExpr("key", "start as first", f"start + {span} as last"))
    repeats = repeats.unionAll(found.filter("hash is null").select("key", "first", "last"))
    single = classes.filter("rows = 1").select("key", "id")
    lists = repeats.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("spans"))
    own = single.join(lists, "key").select("id", "key", "spans")
    whole = known.join(classes.filter("rows > 1").select("key"), "key", "left_semi").select("id", "key", F.array(F.struct(F.lit(0).cast("long").alias("first"), F.col("size").cast("long").alias("last"))).alias("spans")).distinct()
    out = cut(own.unionAll(whole))
    discard(classes, found, twice, w, with_text)
    return out, salt


def _merged(found) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s in found or ():
        if out and s["first"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s["last"])
        else:
            out.append([s["first"], s["last"]])
    return [(a, b) for a, b in out]


def _kept(data: bytes, found: list[tuple[int, int]]) -> bytes:
    if not found:
        return data
    at, out = 0, []
    for a, b in found:
        out.append(data[at:a])
        at = b
    out.append(data[at:])
    return b"".join(out)


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 by SPAN bytes; passages, passage_words: repeated passages of PASSAGE words or more."""
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(docs[id_col].alias("id"), text.alias("text"))
    cuts, salt = spans(rows, "id", "text")
    keyed = rows.select("id", _key(F.col("text"), salt).alias("key"), "text")
    said = passages(rows, "id", "text", PASSAGE, salt).select(F.col("id").alias("s_id"), F.col("key").alias("s_key"), F.col("spans").alias("said"))
    found = cuts.select(F.col("id").alias("c_id"), F.col("key").alias("c_key"), "spans").join(said, F.expr("c_id <=> s_id and c_key = s_key"), "full")
    found = found.select(F.when(F.col("c_key").isNull(), F.col("s_id")).otherwise(F.col("c_id")).alias("c_id"), F.coalesce("c_key", "s_key").alias("c_key"), "spans", "said").hint("merge")
    joined = _packed_text(keyed).join(found, F.expr("id <=> c_id and key = c_key"), "left").select("id", "z", "spans", "said")

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            out = []
            for z, found, said in zip(b.column(1), b.column(2).to_pylist(), b.column(3).to_pylist()):
                d = unpack.decompress(z.as_buffer())
                s, p = _merged(found), _in_text(d, _merged(said)) if said else []
                out.append((len(d), sum(y - x for x, y in s), len(s), len(p), sum(n for _, _, n in p), hashlib.sha256(_kept(d, s)).hexdigest()))
            cols = list(zip(*out)) if out else [()] * 6
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.int64()) for c in cols[:5]], pa.array(cols[5], pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "passages", "passage_words", "kept_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(tx.tidy(run), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, passages long, passage_words long, kept_sha256 string")


def symbols(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of the texts in order: start and end in ``data``, text, size (SYMBOL or, of an unbroken run, 1), and all bytes."""
    s, e, doc = tx.words(data, offs)
    h = tx.span_hashes(data, s, e)
    times = np.where(e - s > UNBROKEN, e - s, 1)
    of = np.repeat(np.arange(len(s)), times)
    loose = (times > 1)[of]
    start = s[of] + np.where(loose, np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times), 0)
    end = np.where(loose, start + 1, e[of])
    size = np.where(loose, 1, SYMBOL)
    begin = np.cumsum(size) - size
    out = np.empty(int(size.sum()), np.uint8)
    out[begin[loose]] = data[start[loose]]
    for k in range(SYMBOL):
        out[begin[~loose] + k] = (h[of[~loose]] >> np.uint64(7 * k)) & np.uint64(127)
    return start, end, doc[of], size, out


def passages(docs: DataFrame, id_col: str, text_col: str, words: int, salt: int = 0) -> DataFrame:
    """id, key, spans: as ``spans``, over the texts' symbols, for passages of ``words`` words or more; the key is that of the text."""

    def run(batches):
        for b in batches:
            out = []
            for lo, hi, o, d in tx.slices(b, "text"):
                _, _, doc, size, data = symbols(d, o)
                to = np.append(0, np.cumsum(np.bincount(doc, size, minlength=hi - lo).astype(np.int64)))
                data = data.tobytes()
                out += [data[x:y].decode() for x, y in zip(to[:-1].tolist(), to[1:].tolist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], ["id", "symbols"])

    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(F.struct(docs[id_col].alias("id"), _key(text, salt).alias("key")).alias("id"), text.alias("text"))
    coded = cut(rows.mapInArrow(tx.tidy(run), StructType([rows.schema["id"], StructField("symbols", StringType())])))
    found, _ = spans(coded, "id", "symbols", span=words * SYMBOL)
    discard(coded)
    return found.select("id.id", "id.key", "spans")


def _in_text(data: bytes, found: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Byte ranges of the symbols that lie wholly in ranges over symbols, and the number of symbols of each."""
    d = np.frombuffer(data, np.uint8)
    start, end, _, size, _ = symbols(d, np.array([0, len(d)]))
    to = np.cumsum(size)
    begin = to - size
    out = []
    for a, b in found:
        x, y = int(np.searchsorted(begin, a)), int(np.searchsorted(to, b, "right")) - 1
        if x <= y:
            out.append((int(start[x]), int(end[y]), y - x + 1))
    return out


def strip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, words: int | None = None) -> DataFrame:
    """``docs`` with repeated bytes taken out of the texts; code points cut in two are dropped.

    With ``words``, passages of at least so many words that stand at another place too go instead.
    Rows, columns and their order stay; null texts stay null.
    """
    taken, names = {c.lower() for c in docs.columns}, []
    for k in count():  # names that no column has
        if f"_{k}" not in taken:
            names.append(f"_{k}")
        if len(names) == 3:
            break
    cuts, salt = spans(docs, id_col, text_col) if words is None else (passages(docs, id_col, text_col, words), 0)
    cuts = cuts.select(F.col("id").alias(names[0]), F.col("key").alias(names[1]), F.col("spans").alias(names[2])).hint("merge")  # these grow with the input, so they are never sent whole to all tasks
    same = docs[id_col].eqNullSafe(cuts[names[0]]) & (_key(F.coalesce(docs[text_col], F.lit("")), salt) == cuts[names[1]])
    joined = docs.join(cuts, same, "left").select(*[docs[c] for c in docs.columns], names[2])
    at = docs.columns.index(text_col)

    def left(data: bytes, found: list[tuple[int, int]]) -> str:
        return _kept(data, found if words is None else [x[:2] for x in _in_text(data, found)]).decode("utf-8", "ignore")

    def run(batches):
        for b in (b.slice(k, 512) for b in batches for k in range(0, b.num_rows, 512)):
            t, found = b.column(at), b.column(b.num_columns - 1)
            out = [x if not s or x is None else left(x.encode(), _merged(s)) for x, s in zip(t.to_pylist(), found.to_pylist())]
            cols = [pa.array(out, t.type) if k == at else b.column(k) for k in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(cols, b.schema.names[:-1])

    return joined.mapInArrow(tx.tidy(run), docs.schema)
