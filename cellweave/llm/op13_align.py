"""Operator 13: alignment of two tokenizers' tokens, with corpus counts of linked ids.

Each text is encoded by a byte-level BPE (A, of a space and the text) and by a piece model (B, which
adds the space). Work on a slice of texts is columnar: token lists are flattened beside the index of
their parent document, ends are segmented cumulative sums of token lengths, ends that both sides share
come from a hash join on (document, end), the links of a group from a hash join on the group, and
``Table.group_by`` counts. Spark merges the counts, and gives each document the counts of its own pairs:
the commonest pairs (at most ``SENT``, a fixed bound) are sent to all tasks, the others are joined.

Defined results: texts that are null or empty, or whose tokens of either side do not spell a space and
the text, have no tokens: zeros and an empty digest. Every input row gives one output row, repeated and
null ids too. Special strings are plain text. Columns other than the id and the text are ignored; an
empty table gives no rows. Texts are encoded in units that no token can cross (words of the pattern;
stretches that begin at a space after another character), so memory follows the slice, and a very long
text costs what its own tokens need.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.llm import text as tx
from cellweave.session import cut

#: Pairs sent to every task at most (about 17 bytes each).
SENT = 1 << 19
#: Bytes of text that are aligned at once.
SLICE = 2 << 20
#: Units that a worker remembers, at most, besides those of a slice.
KNOWN = 1 << 18
SIDES = ["n_a", "n_b", "n_groups", "n_links"]

_made: dict[tuple[str, str, str], tuple[Side, Side]] = {}


def unmap() -> dict[str, int]:
    """The bytes that the characters of byte-level entries stand for: printable ones for themselves, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    out |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    return out


class Side:
    """One tokenizer: the units of texts, the ids of a unit, the bytes of an id."""

    def __init__(self, units, encode, entries: list[bytes], seps: str):
        self.units, self.encode, self.known = units, encode, {}
        self.lengths = np.array([len(e) for e in entries], np.int64)
        self.entries = pa.array(entries, pa.large_binary())
        self.names = pa.array([f"{k}{s}" for k in range(len(entries)) for s in (*seps, "")], pa.large_string())

    def tokens(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the parent index of each; a unit is encoded once while it is remembered."""
        units = self.units(texts)
        parent = pc.list_parent_indices(units).to_numpy()
        coded = pc.list_flatten(units).dictionary_encode()
        names = coded.dictionary.to_pylist()
        if len(self.known) > KNOWN:
            self.known = {}
        new = [u for u in names if u not in self.known]
        self.known.update(zip(new, self.encode(new), strict=True))
        taken = pa.array([self.known[u] for u in names], pa.large_list(pa.int32())).take(coded.indices)
        return pc.list_flatten(taken).to_numpy(), parent[pc.list_parent_indices(taken).to_numpy()]


def in_order(texts: pa.LargeStringArray, plain: pa.BooleanArray, quick, careful) -> pa.LargeListArray:
    """Unit lists of all texts: ``quick`` on the column of plain ones, ``careful`` on each other one."""
    kind = pa.large_list(pa.large_string())
    some, rest = quick(texts.filter(plain)).cast(kind), pa.array([careful(t) for t in texts.filter(pc.invert(plain)).to_pylist()], kind)
    is_plain = plain.to_numpy(zero_copy_only=False)
    at = np.where(is_plain, np.cumsum(is_plain) - 1, len(some) + np.cumsum(~is_plain) - 1)
    return pa.concat_arrays([some, rest]).take(pa.array(at))


#: The white space of Unicode, as members of a character class.
SPACE = r"\t-\r \x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
MARK = "\x01"


def word_units(pattern: str):
    """Texts to the matches of ``pattern`` in a space and the text.

    The pattern looks ahead only where spaces follow each other; texts without such a place are split as
    a column by the pattern without the lookahead, the others one by one.
    """
    find = regex.compile(pattern).findall
    ahead = r"\s+(?!\S)|"
    column = pattern.replace(ahead, "").replace(r"[^\s", "[^" + SPACE).replace(r"\s+", f"[{SPACE}]+")
    able = ahead in pattern and not any(x in column for x in ("(?", r"\s", r"\S"))

    def quick(texts):
        marked = pc.replace_substring_regex(texts, column, MARK + r"\0")
        return pc.split_pattern(pc.utf8_ltrim(marked, MARK), MARK)

    def units(texts):
        texts = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string()))
        plain = pc.invert(pc.match_substring_regex(texts, f"[{SPACE}][{SPACE}]|{MARK}")) if able else pa.array(np.zeros(len(texts), bool))
        return in_order(texts, plain, quick, find)

    return units


def stretch_units(whole: bool):
    """Texts to stretches that begin after a space that another character precedes (the model adds that space again); ``whole`` leaves texts in one piece."""
    split = re.compile("(?<=[^ ]) ").split

    def units(texts):
        plain = pc.invert(pc.match_substring_regex(texts, "^ |  "))
        if whole:
            return pa.array([[t] for t in texts.to_pylist()], pa.large_list(pa.large_string()))
        return in_order(texts, plain, lambda t: pc.split_pattern(t, " "), split)

    return units


def sides(json_path: str, pattern: str, model_path: str) -> tuple[Side, Side]:
    """Both tokenizers of this worker process."""
    key = (json_path, pattern, model_path)
    if key not in _made:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(json_path)
        tok.encode_special_tokens = True
        back = unmap()
        entries = []
        for k in range(tok.get_vocab_size()):
            e = tok.id_to_token(k)
            entries.append(bytes(back[c] for c in e) if all(c in back for c in e) else e.encode())
        with open(json_path, encoding="utf-8") as f:
            file = json.load(f)
        model, added = file["model"], {t["id"] for t in file["added_tokens"]}
        made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        ranked = all(x < y for x, y in zip(made, made[1:], strict=False)) and not model.get("ignore_merges")
        ranks = {entries[k]: k for k in model["vocab"].values() if k not in added}
        one = tiktoken.Encoding("units", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

        def encode_words(units: list[str]) -> list[list[int]]:
            """Merges in the order of ids are merges by rank; very long units go to the library of the file, whose merging stays near linear."""
            out = [one(u) if ranked and len(u) < 512 else None for u in units]
            rest = [k for k, ids in enumerate(out) if ids is None]
            for k in range(0, len(rest), 1024):
                for at, e in zip(rest[k : k + 1024], tok.encode_batch([units[x] for x in rest[k : k + 1024]], add_special_tokens=False), strict=True):
                    out[at] = e.ids
            return out

        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        named = [sp.id_to_piece(k) for k in range(sp.get_piece_size())]
        inner = any("▁" in p.lstrip("▁") for p in named)
        pieces = [bytes([int(p[3:5], 16)]) if sp.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(named)]
        space = [sp.piece_to_id("▁")]  # of an empty stretch: the space before it

        def encode_stretches(units: list[str]) -> list[list[int]]:
            return [ids if u else space for u, ids in zip(units, sp.encode(units, num_threads=1), strict=True)]

        _made[key] = Side(word_units(pattern), encode_words, entries, ",|"), Side(stretch_units(inner), encode_stretches, pieces, ",;")
    return _made[key]


def spelled(side: Side, ids: np.ndarray, parent: np.ndarray, raw: list[bytes]) -> np.ndarray:
    """Which texts the tokens spell."""
    size = np.bincount(parent, side.lengths[ids], len(raw)).astype(np.int64)
    joined = side.entries.take(pa.array(ids)).buffers()[2]
    at, ok = 0, np.zeros(len(raw), bool)
    data = memoryview(joined) if joined is not None else memoryview(b"")
    for k, r in enumerate(raw):
        ok[k] = size[k] == len(r) and bytes(data[at : at + len(r)]) == r
        at += int(size[k])
    return ok


def ends(side: Side, ids: np.ndarray) -> np.ndarray:
    """Document and end of each token as one number: lengths summed over the slice; both sides spell the same texts, so a document's part of the sum is its own."""
    return pc.cumulative_sum(pa.array(side.lengths[ids])).to_numpy()


def shared_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens of either side end where one of the other ends: a hash join on keys of document and end."""
    both = pa.table({"end": a, "at": np.arange(len(a))}).join(pa.table({"end": b, "bt": np.arange(len(b))}), "end", join_type="inner", use_threads=False)
    last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    last_a[both["at"].to_numpy()] = True
    last_b[both["bt"].to_numpy()] = True
    return last_a, last_b


def distinct(group: np.ndarray, ids: np.ndarray, large: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, id and weight of tokens in order of groups; in ``large`` groups each id once."""
    pick = large[group]
    if not pick.any():
        return group, ids.astype(np.int64), np.ones(len(ids), np.int64)
    t = pa.table({"g": group[pick], "x": ids[pick].astype(np.int64)}).group_by(["g", "x"], use_threads=False).aggregate([([], "count_all")])
    g = np.concatenate([group[~pick], t["g"].to_numpy()])
    order = np.argsort(g, kind="stable")
    return g[order], np.concatenate([ids[~pick], t["x"].to_numpy()])[order].astype(np.int64), np.concatenate([np.ones(int((~pick).sum()), np.int64), t["count_all"].to_numpy()])[order]


def linked(ga: np.ndarray, ida: np.ndarray, gb: np.ndarray, idb: np.ndarray, groups: int, wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, id pair and number of the links of each group."""
    large = np.bincount(ga, minlength=groups) * np.bincount(gb, minlength=groups) > 64
    (ga, ida, wa), (gb, idb, wb) = distinct(ga, ida, large), distinct(gb, idb, large)
    nb = np.bincount(gb, minlength=groups)
    times = nb[ga]  # each A meets all B of its group
    first = (np.cumsum(nb) - nb)[ga]
    a_at = np.repeat(np.arange(len(ga)), times)
    b_at = np.arange(len(a_at)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first, times)
    return ga[a_at], ida[a_at] * wide + idb[b_at], wa[a_at] * wb[b_at]


def align(a: Side, b: Side, texts: pa.LargeStringArray, wide: int) -> dict[str, object]:
    """Columns of a slice of texts: counts, digest, pairs of ids (as a * wide + b) and how often each is linked."""
    n = len(texts)
    texts = pc.fill_null(texts, "")
    raw = [b" " + t.encode() if t else b"" for t in texts.to_pylist()]
    ida, da = a.tokens(texts)
    idb, db = b.tokens(texts)
    good = spelled(a, ida, da, raw) & spelled(b, idb, db, raw) & np.array([bool(r) for r in raw], bool)
    if not good.all():
        ida, da, idb, db = ida[good[da]], da[good[da]], idb[good[db]], db[good[db]]
    last_a, last_b = shared_ends(ends(a, ida), ends(b, idb))
    ga, gb = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b  # the group of each token
    groups = int(last_a.sum())
    doc_of = da[last_a]
    na, nb = np.bincount(ga, minlength=groups), np.bincount(gb, minlength=groups)
    out: dict[str, object] = {"n_a": np.bincount(da, minlength=n), "n_b": np.bincount(db, minlength=n), "n_groups": np.bincount(doc_of, minlength=n)}
    out["n_links"] = np.bincount(doc_of, na * nb, n).astype(np.int64)
    out["groups_sha256"] = digests(a, b, (ida, da, ga, last_a, na), (idb, db, gb, last_b, nb), good)
    g, pair, m = linked(ga, ida, gb, idb, groups, wide)
    key = (doc_of[g] << 32) + pair if n < 1 << 31 and len(a.lengths) * wide <= 1 << 32 else None
    order = np.argsort(key, kind="stable") if key is not None else np.lexsort((pair, doc_of[g]))
    doc, pair, m = doc_of[g][order], pair[order], m[order]
    new = np.append(True, (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1]))[: len(pair)]
    at = np.flatnonzero(new)
    offs = np.concatenate([[0], np.cumsum(np.bincount(doc[at], minlength=n))])
    out["pairs"], out["times"] = (offs, pair[at]), (offs, np.add.reduceat(m, at) if len(at) else m)
    return out


def digests(a: Side, b: Side, left: tuple, right: tuple, good: np.ndarray) -> list[str]:
    """SHA-256 of the groups of each text, written ``a,a|b;a|b,b``."""
    (ida, da, ga, last_a, na), (idb, db, gb, last_b, nb) = left, right
    cum_a, cum_b = np.cumsum(na), np.cumsum(nb)
    names = pa.chunked_array([a.names, b.names]).combine_chunks()
    index = np.empty(len(ida) + len(idb), np.int64)
    docs = np.empty(len(index), np.int64)
    at_a, at_b = np.arange(len(ida)) + (cum_b - nb)[ga], np.arange(len(idb)) + cum_a[gb]
    index[at_a], docs[at_a] = ida * 3 + last_a, da
    final = last_b & np.append(db[1:] != db[:-1], True) if len(db) else last_b
    index[at_b], docs[at_b] = len(a.names) + idb * 3 + last_b + final, db
    text = names.take(pa.array(index))
    offs = np.frombuffer(text.buffers()[1], np.int64)[: len(text) + 1] if len(text) else np.zeros(1, np.int64)
    data = memoryview(text.buffers()[2]) if len(text) and text.buffers()[2] is not None else memoryview(b"")
    edge = np.searchsorted(docs, np.arange(len(good) + 1))
    return [hashlib.sha256(data[offs[edge[k]] : offs[edge[k + 1]]]).hexdigest() if good[k] else "" for k in range(len(good))]


def aligned(docs: DataFrame, json_path: str, pattern: str, model_path: str, id_col: str = "doc_id", text_col: str = "text", long_pairs: bool = False) -> DataFrame:
    """id, counts, digest, and the linked id pairs of each document with how often it links them."""
    kind = docs.schema[id_col].dataType
    item = T.LongType() if long_pairs else T.IntegerType()
    fields = [T.StructField("id", kind), *[T.StructField(c, T.LongType()) for c in SIDES], T.StructField("groups_sha256", T.StringType()), T.StructField("pairs", T.ArrayType(item)), T.StructField("times", T.ArrayType(T.IntegerType()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = sides(json_path, pattern, model_path)
        wide, item_type = len(b.lengths), pa.int64() if long_pairs else pa.int32()
        if not long_pairs and len(a.lengths) * wide > 1 << 31:
            raise ValueError("id pairs of these vocabularies need long_pairs=True")
        for batch in batches:
            texts = batch.column(1).cast(pa.large_string())
            size = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))])
            at = 0
            while at < len(texts):
                end = max(at + 1, int(np.searchsorted(size, size[at] + SLICE, "right")) - 1)
                got = align(a, b, texts[at:end], wide)
                lists = [pa.ListArray.from_arrays(pa.array(o, pa.int32()), pa.array(v, t)) for (o, v), t in ((got["pairs"], item_type), (got["times"], pa.int32()))]
                yield pa.RecordBatch.from_arrays([batch.column(0)[at:end], *[pa.array(got[c], pa.int64()) for c in SIDES], pa.array(got["groups_sha256"], pa.string()), *lists], [f.name for f in fields])
                at = end

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(tx.tidy(run), T.StructType(fields))


def pair_counts(made: DataFrame) -> DataFrame:
    """pair, n: how many documents hold each pair linked; counts of a batch by ``Table.group_by``, merged by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = pa.table({"pair": pc.list_flatten(batch.column(0))}).group_by("pair", use_threads=False).aggregate([([], "count_all")])
            yield from pa.table({"pair": t["pair"].cast(pa.int64()), "n": t["count_all"]}).combine_chunks().to_batches()

    return made.select("pairs").mapInArrow(tx.tidy(run), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def least_sent(counts: DataFrame, most: int) -> float:
    """The least count from which on at most ``most`` pairs are held: by a histogram of counts, in eighths of powers of two."""
    step = F.ceil(F.log2("n") * 8).cast("int")
    found = 0
    for r in counts.groupBy(step.alias("s")).agg(F.count("*").alias("k"), F.min("n").alias("least")).orderBy(F.desc("s")).collect():
        found += r["k"]
        if found > most:
            break
        low = r["least"]
    else:
        return 0
    return low if found > r["k"] else float("inf")


def with_counts(made: DataFrame, wide: int, most: int) -> DataFrame:
    """rid, n_best, count_sum: over the links of each document, by the counts of their pairs in all documents."""
    spark = made.sparkSession
    counts = pair_counts(made).withColumn("a", F.floor(F.col("pair") / wide))
    counts = cut(counts)
    top = counts.groupBy("a").agg(F.max("n").alias("top"))
    counts = cut(counts.join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best")))
    low = least_sent(counts, most)
    sent = counts.filter(F.col("n") >= low).toArrow().sort_by("pair")
    keys, held, best = (sent[c].combine_chunks().to_numpy(zero_copy_only=False) for c in ("pair", "n", "best"))
    shared = spark.sparkContext.broadcast((keys, held, best))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, held, best = shared.value
        for batch in batches:
            rid, lists = batch.column(0).to_numpy(), batch.column(1)
            parent, pair, m = pc.list_parent_indices(lists).to_numpy(), pc.list_flatten(lists).to_numpy().astype(np.int64), pc.list_flatten(batch.column(2)).to_numpy()
            at = np.minimum(np.searchsorted(keys, pair), max(len(keys) - 1, 0))
            hit = keys[at] == pair if len(keys) else np.zeros(len(pair), bool)
            p, m_hit, at = parent[hit], m[hit].astype(np.int64), at[hit]
            sums, n_best = np.zeros(len(rid), np.int64), np.zeros(len(rid), np.int64)
            np.add.at(sums, p, m_hit * held[at])
            np.add.at(n_best, p, m_hit * best[at])
            yield pa.RecordBatch.from_arrays([pa.array(rid), pa.array([None] * len(rid), pa.int64()), pa.array(n_best), pa.array(sums)], ["rid", "pair", "m", "s"])
            rest = ~hit
            if rest.any():
                yield pa.RecordBatch.from_arrays([pa.array(rid[parent[rest]]), pa.array(pair[rest]), pa.array(m[rest].astype(np.int64)), pa.nulls(int(rest.sum()), pa.int64())], ["rid", "pair", "m", "s"])

    found = made.select("rid", "pairs", "times").mapInArrow(tx.tidy(run), "rid long, pair long, m long, s long")
    # null pairs are sums already; they pass the join without a partner
    known = counts.filter(F.col("n") < low).hint("merge")
    j = found.join(known, "pair", "left").select("rid", F.when(F.col("s").isNotNull(), F.col("m")).otherwise(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("n_best"), F.coalesce("s", F.col("m") * F.col("n")).alias("count_sum"))
    return j.groupBy("rid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def score(docs: DataFrame, json_path: str, pattern: str, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each document."""
    a, b = sides(json_path, pattern, model_path)
    wide = len(b.lengths)
    made = aligned(docs, json_path, pattern, model_path, id_col, text_col, len(a.lengths) * wide > 1 << 31)
    made = cut(made.withColumn("rid", F.monotonically_increasing_id()))
    sums = with_counts(made, wide, SENT)
    out = made.select("rid", "id", *SIDES, "groups_sha256").join(sums, "rid")
    return out.select(F.col("id").alias(id_col), *SIDES, "n_best", "count_sum", "groups_sha256")
