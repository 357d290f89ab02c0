"""Vectorised text helpers that run inside Arrow tasks.

A batch of texts is handled as one byte array with document offsets, in slices of bounded size,
so memory per task depends on the slice limit and on the longest single text only.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_POW = {"n": 0, "p": None, "i": None}


def trim() -> None:
    """Give memory that is free in this worker back: workers live on, and several share an executor's memory."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidy(run: Callable) -> Callable:
    """``run`` over batches, with ``trim`` when its task ends."""

    def tidied(batches):
        yield from run(batches)
        trim()

    return tidied


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse for i < n, modulo 2**64."""
    if _POW["n"] < n:
        size = max(n, SLICE + (1 << 16))
        for name, base in (("p", _BASE), ("i", pow(_BASE, -1, 1 << 64))):
            out = np.empty(size, np.uint64)
            out[0] = 1
            k = 1
            while k < size:  # doubling
                m = min(k, size - k)
                out[k : k + m] = out[:m] * np.uint64(pow(base, k, 1 << 64))
                k += m
            _POW[name] = out
        _POW["n"] = size
    return _POW["p"][:n], _POW["i"][:n]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, offsets from 0, bytes) for runs of rows of about ``limit`` bytes; null is empty."""
    texts = pc.fill_null(batch.column(batch.schema.get_field_index(column)), pa.scalar("", batch.schema.field(column).type))
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    _, offs, data = texts.buffers()
    n = len(texts)
    if not n:
        return
    offs = np.frombuffer(offs, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + limit, "right")) - 1)
        b = min(b, n)
        yield a, b, offs[a : b + 1] - offs[a], data[offs[a] : offs[b]]
        a = b


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document (row of ``offs``) of every word, words being runs of non-separators."""
    n = len(data)
    if not n:
        e = np.empty(0, np.int64)
        return e, e, e
    inside = ~SEPARATOR[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    return start, end, np.searchsorted(offs, start, "right") - 1


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans."""
    p, inv = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    part = total[1:]  # in place: the text's bytes times eight are held once
    part[:] = data
    part += np.uint64(1)
    part *= p[: len(data)]
    np.cumsum(part, out=part)
    return mix((total[end] - total[start]) * inv[start] + (end - start).astype(np.uint64))


def shingles(data: np.ndarray, offs: np.ndarray, k: int = 5, short: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, document and first word's number (within the slice) of each k-word shingle of lower-cased text.

    With ``short`` a text of 1 to k-1 words gives its whole sequence as one shingle.
    """
    s, e, doc = words(data, offs)
    h = span_hashes(LOWER[data], s, e)
    m = len(h)
    at = np.flatnonzero(doc[: m - k + 1] == doc[k - 1 :]) if m >= k else np.empty(0, np.int64)
    x = np.zeros(len(at), np.uint64)
    for j in range(k):
        x = x * np.uint64(0xD1342543DE82EF95) + h[at + j]
    out, docs = mix(x), doc[at]
    if short and m:
        n = np.bincount(doc, minlength=len(offs) - 1)
        first = np.cumsum(n) - n
        few = np.flatnonzero((n > 0) & (n < k))
        if len(few):
            y = n[few].astype(np.uint64)
            for j in range(k - 1):
                has = n[few] > j
                y[has] = y[has] * np.uint64(0xD1342543DE82EF95) + h[first[few][has] + j]
            out, docs, at = np.concatenate([out, mix(y + np.uint64(1))]), np.concatenate([docs, few]), np.concatenate([at, first[few]])
            order = np.argsort(docs, kind="stable")
            out, docs, at = out[order], docs[order], at[order]
    return out, docs, at
