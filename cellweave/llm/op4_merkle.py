"""Operator 4: document fingerprints, Merkle trees over paragraphs and sections.

Leaves are paragraphs (sentences and lines, long ones cut every LEAF code points), sections are
runs of leaves that end where a leaf's digest says so, the root covers the sections. Equal roots
mean equal texts; differing sections and then leaves locate edits. A fingerprint is the tree in
text form, ``root:section/leaf leaf ...|section/leaf ...``, and likeness is read from two of them.

The neighbour in descending order comes from one shuffle into ranges of (id, hash of the text), so
that the rows of one id, or of no id, spread over tasks too; a copy of each range's first row goes
to the range above it.

Defined results: ids are of any type that Spark orders; a null text is empty; null ids come last in
descending order; rows of one id are ordered by the hash of their text (xxhash64), then the text,
descending; a single row is its own neighbour; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.session import shuffle_parts

LEAF, SECTION = 160, 8
_leaves = re.compile(r"[^\n.!?]{1,%d}[\n.!?]*|[\n.!?]+" % LEAF).findall
#: Rows looked at for the bounds of the ranges: they balance tasks only, every row is dealt.
SAMPLE = 20_000


def fingerprint(text: str) -> str:
    sections, leaves, root = [], [], hashlib.blake2b(digest_size=16)

    def close() -> None:
        digest = hashlib.blake2b(b"".join(leaves), digest_size=8).digest()
        root.update(digest)
        sections.append(digest[:4].hex() + "/" + " ".join([x[:4].hex() for x in leaves]))
        leaves.clear()

    for part in _leaves(text):
        d = hashlib.blake2b(part.encode(), digest_size=16).digest()
        leaves.append(d)
        if d[0] % SECTION == 0:
            close()
    if leaves:
        close()
    return root.hexdigest() + ":" + "|".join(sections)


def _tree(print_: str) -> tuple[str, list[tuple[str, list[str]]]]:
    root, _, rest = print_.partition(":")
    return root, [(s.partition("/")[0], s.partition("/")[2].split(" ")) for s in rest.split("|")] if rest else []


def _differing(x: list, y: list) -> tuple[int, list, list]:
    """Leaves of sections that both trees hold (repeated ones as often as both do), and each tree's other sections."""
    both = Counter(d for d, _ in x) & Counter(d for d, _ in y)
    shared, rest = 0, ([], [])
    for k, tree in enumerate((x, y)):
        left = Counter(both)
        for d, leaves in tree:
            if left[d]:
                left[d] -= 1
                shared += len(leaves) if not k else 0
            else:
                rest[k].append((d, leaves))
    return shared, *rest


def likeness(a: str, b: str) -> float:
    """1 for equal roots, else twice the common leaves over all leaves; only below sections that differ are leaves compared."""
    (root_a, x), (root_b, y) = _tree(a), _tree(b)
    if root_a == root_b:
        return 1.0
    shared, p, q = _differing(x, y)
    p, q = (Counter(l for _, leaves in t for l in leaves) for t in (p, q))
    whole = 2 * shared + p.total() + q.total()
    return 2 * (shared + (p & q).total()) / whole if whole else 0.0


def edits(a: str, b: str) -> list[tuple[int, int]]:
    """(section, leaf) of a that b lacks, descending only into sections that b lacks."""
    (root_a, x), (root_b, y) = _tree(a), _tree(b)
    if root_a == root_b:
        return []
    same, leaves = {s for s, _ in y}, {l for _, ls in y for l in ls}
    return [(i, j) for i, (s, ls) in enumerate(x) if s not in same for j, l in enumerate(ls) if l not in leaves]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint."""

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([fingerprint(t.as_py() or "") for t in b.column(1)], pa.string())], ["doc_id", "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, fingerprint string")


def neighbours_compared(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("mix", F.xxhash64("text"))
    id_kind = docs.schema[id_col].dataType.simpleString()
    parts = shuffle_parts(spark)
    key = F.struct("id", "mix")
    # A bounded sample by hash, the same in each run; ids equal in hash are ordered by their own value.
    some = rows.select("id", "mix").orderBy(F.xxhash64("id", "mix"), "id", "mix").limit(SAMPLE).orderBy("id", "mix").collect() if parts > 1 else []
    place = lambda i, mix: (0, 0, mix) if i is None else (1, i, mix)  # noqa: E731  null ids first in ascending order, as in Spark
    bounds = sorted({place(*some[len(some) * k // parts]) for k in range(1, parts)}) if some else []

    def with_bucket(batches, head):
        for b in batches:
            to = [bisect_left(bounds, place(i, m)) for i, m in zip(b.column("id").to_pylist(), b.column("mix").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), *[b.column(c) for c in head]], ["bucket", *head])

    # The largest key of each range: as many rows as shuffle partitions.
    tops = rows.select("id", "mix").mapInArrow(lambda batches: with_bucket(batches, ["id", "mix"]), f"bucket int, id {id_kind}, mix long")
    top = {r["bucket"]: place(*r["top"]) for r in tops.groupBy("bucket").agg(F.max(key).alias("top")).collect()}
    order = sorted(top, reverse=True)
    ahead: dict[tuple, list[int]] = {}
    for n, bucket in enumerate(order):
        ahead.setdefault(top[order[(n + 1) % len(order)]], []).append(bucket)
    names = ["bucket", "extra", "id", "mix", "text"]

    def deal(batches):
        sent = set()
        for b in batches:
            keys = [place(i, m) for i, m in zip(b.column("id").to_pylist(), b.column("mix").to_pylist())]
            to = [bisect_left(bounds, k) for k in keys]
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array([False] * len(to)), b.column("id"), b.column("mix"), b.column("text")], names)
            for k, x in enumerate(keys):
                if x in ahead and (x, b.column("text")[k].as_py()) not in sent:
                    sent.add((x, b.column("text")[k].as_py()))  # a repeated row goes once from each task
                    more = ahead[x]
                    same = pa.array([k] * len(more))
                    yield pa.RecordBatch.from_arrays([pa.array(more, pa.int32()), pa.array([True] * len(more)), *[b.column(c).take(same) for c in ("id", "mix", "text")]], names)

    def compare(batches):
        out_names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        kinds = [None, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        held, out, size = None, [], 0
        for b in batches:
            kinds[0] = b.column("id").type
            for extra, i, text in zip(b.column("extra").to_pylist(), b.column("id"), b.column("text")):
                if extra and held is None:
                    continue  # a further row of the key that was looked ahead to
                text = text.as_py()
                mine = fingerprint(text)
                if held:
                    h_id, h_text, h_print = held
                    n = len(h_text)
                    edited = h_text[: n - n // 3] + text[: n // 3]
                    e_print = fingerprint(edited)
                    out.append((h_id.as_py(), n, hashlib.sha256(edited.encode()).hexdigest(), h_print, e_print, likeness(h_print, e_print), likeness(h_print, mine)))
                    size += len(h_print) + len(e_print)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], out_names)
                        out, size = [], 0
                held = None if extra else (i, text, mine)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], out_names)

    dealt = rows.mapInArrow(deal, f"bucket int, extra boolean, id {id_kind}, mix long, text string").repartition(parts, "bucket")
    dealt = dealt.sortWithinPartitions("bucket", "extra", F.desc("id"), F.desc("mix"), F.desc("text"))
    return dealt.mapInArrow(compare, f"doc_id {id_kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
