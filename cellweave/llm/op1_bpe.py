"""Operator 1: byte-level BPE encoding and decoding.

Text is cut by the tokenizer's pattern; each piece runs through a transducer compiled from the
merges (``bpe.Transducer``), and a bounded memo keeps pieces already met. One scan, no shuffle.

Defined results: a null or empty text has no ids; every input row gives one output row (repeated
and null doc_ids included); other columns of the input are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm import bpe
from cellweave.llm import text as tx

#: Rows in a batch that is passed on.
ROWS = 512
_made: dict[tuple[str, str], bpe.Encoder] = {}


def encoder(path: str, pattern: str) -> bpe.Encoder:
    """One encoder for each worker process."""
    if (path, pattern) not in _made:
        _made[path, pattern] = bpe.Encoder(bpe.Merges.ranks(path), pattern)
    return _made[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids: the token ids of every whole text."""

    def run(batches):
        e = encoder(path, pattern)
        for b in batches:
            ids = [e.encode(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tx.tidy(run), f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str, chunk: int = 4096) -> DataFrame:
    """doc_id, text: ids decoded by the incremental decoder, ``chunk`` ids at a time."""

    def run(batches):
        tokens = encoder(path, pattern).fst.m.tokens
        for b in batches:
            out = []
            for ids in b.column(1).to_pylist():
                d = bpe.StreamDecoder(tokens)
                ids = ids or []
                out.append("".join([d.feed(ids[k : k + chunk]) for k in range(0, len(ids), chunk)]) + d.close())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(tx.tidy(run), f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = 4096, with_ids: bool = False, small: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: digests of the ids and of the bytes decoded from them, in one pass; on demand the ids too.

    With ``small`` a worker keeps a quarter of the usual tables, and drops them when its task ends: less memory, more time.
    """

    def run(batches):
        e = encoder(path, pattern)
        e.fst.most = bpe.MEMO_STATES // 4 if small else bpe.MEMO_STATES
        tokens = e.fst.m.tokens
        decimal = [str(i) for i in range(len(tokens))]
        for b in (b.slice(k, ROWS) for b in batches for k in range(0, b.num_rows, ROWS)):
            n, ids_sha, text_sha, all_ids = [], [], [], []
            for text in b.column(1):
                ids = e.encode(text.as_py() or "")
                n.append(len(ids))
                if with_ids:
                    all_ids.append(np.array(ids, np.int32))
                ids_sha.append(hashlib.sha256(",".join([decimal[i] for i in ids]).encode()).hexdigest())
                h, d = hashlib.sha256(), bpe.StreamDecoder(tokens)
                for k in range(0, len(ids), chunk):
                    h.update(d.feed(ids[k : k + chunk]).encode())
                h.update(d.close().encode())
                text_sha.append(h.hexdigest())
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            if with_ids:
                flat = np.concatenate(all_ids) if all_ids else np.empty(0, np.int32)
                cols.append(pa.ListArray.from_arrays(np.cumsum([0, *n]).astype(np.int32), pa.array(flat)))
            yield pa.RecordBatch.from_arrays(cols, names)
        if small:
            _made.clear()

    kind = docs.schema[id_col].dataType.simpleString()
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tx.tidy(run), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
