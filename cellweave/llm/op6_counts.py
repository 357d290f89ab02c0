"""Operator 6: token counts by prefix dynamic programming.

For every prefix of a text the exact number of tokens is stored (``bpe.PrefixCounter``), so a
length limit, a cut to a budget or a count is read off without encoding again. One scan, no shuffle.

Defined results: a null or empty text has 0 tokens and no prefixes; every input row gives one
output row; other columns are ignored; an empty table gives no rows. The added tokens of the
file are matched in texts and count as one token each, as its library does by default.
"""

from __future__ import annotations

from bisect import bisect_right

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm import bpe
from cellweave.llm import text as tx

_made: dict[tuple[str, str], tuple[bpe.PrefixCounter, object]] = {}


def counter(path: str, pattern: str):
    """The counter of this worker process, and the splitter at added tokens."""
    if (path, pattern) not in _made:
        merges, added = bpe.Merges.model_json(path)
        split = regex.compile("(" + "|".join(regex.escape(a) for a in sorted(added, key=len, reverse=True)) + ")").split if added else (lambda t: [t])
        _made[path, pattern] = bpe.PrefixCounter(merges, pattern), split
    return _made[path, pattern]


def prefix_table(text: str, path: str, pattern: str) -> list[int]:
    """Tokens of text[:1], text[:2], ... An added token counts from its last character on; before, its part is plain text."""
    c, split = counter(path, pattern)
    out: list[int] = []
    base, parts = 0, split(text)
    for n, part in enumerate(parts):
        if n % 2:
            out.extend([base + k for k in c.prefixes(part)[:-1]])
            base += 1
            out.append(base)
        elif part:
            mine = c.prefixes(part)
            out.extend([base + k for k in mine])
            base += mine[-1]
    at = 0
    for n, part in enumerate(parts):
        if n % 2 and len(part) > 1:  # a begun added token continues the text before it
            before = parts[n - 1]
            floor = out[at - len(before) - 1] if at > len(before) else 0
            out[at : at + len(part) - 1] = [floor + k for k in c.prefixes(before + part[:-1])[len(before) :]]
        at += len(part)
    return out


def prefix_counts(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts: exact token count of every code-point prefix."""

    def run(batches):
        for b in batches:
            rows = [prefix_table(t or "", path, pattern) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.int32()))], ["doc_id", "counts"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tx.tidy(run), f"doc_id {kind}, counts array<int>")


def truncate(docs: DataFrame, path: str, pattern: str, budget: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, n_tokens: the longest prefix of each text with at most ``budget`` tokens."""

    def run(batches):
        for b in batches:
            texts, n = [], []
            for t in b.column(1).to_pylist():
                t = t or ""
                counts = prefix_table(t, path, pattern)
                top = len(counts)
                if counts and max(counts) > budget:  # counts may fall by one where pieces join
                    top = bisect_right(counts, budget) if counts == sorted(counts) else max((k + 1 for k, c in enumerate(counts) if c <= budget), default=0)
                texts.append(t[:top])
                n.append(counts[top - 1] if top else 0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array(n, pa.int64())], ["doc_id", "text", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tx.tidy(run), f"doc_id {kind}, text string, n_tokens long")


def counts(docs: DataFrame, path: str, pattern: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: the last entry of each text's prefix table, piece by piece."""

    def run(batches):
        c, split = counter(path, pattern)
        for b in batches:
            size, n = [], []
            for text in b.column(1):
                t = text.as_py() or ""
                total = 0
                for k, part in enumerate(split(t)):
                    total += 1 if k % 2 else sum([c[x][-1] for x in c.find(part)])
                size.append(len(t.encode()))
                n.append(total)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tx.tidy(run), f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
