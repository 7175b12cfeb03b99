"""Whole texts as numpy arrays, inside tasks.

The operators of this folder read texts as Arrow buffers (UTF-8 bytes plus offsets) and work
on blocks of whole texts of a few megabytes, so that the memory of a task is bounded by the
block (or by its longest single text), never by its partition.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 20

_KEPT: dict = {}


def kept(key: Hashable, make: Callable):
    """The one large object (model, memo) that a worker process keeps from task to task; an
    object of another key takes its place."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def release() -> None:
    """Give up the kept object and hand freed memory back to the system: workers are used
    again by later stages, next to each other."""
    _KEPT.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


#: Bytes that separate words for "[^\x20\x09-\x0D]+".
SPACES = [0x20, *range(0x09, 0x0E)]


def space_words() -> np.ndarray:
    """Byte class of the words [^\\x20\\x09-\\x0D]+ (256 booleans)."""
    t = np.ones(256, bool)
    t[SPACES] = False
    return t


def alnum_words() -> np.ndarray:
    """Byte class of the words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of texts whose A-Z are
    lower-cased (so A-Z are word bytes here)."""
    t = np.zeros(256, bool)
    t[0x30:0x3A] = t[0x41:0x5B] = t[0x61:0x7B] = True
    t[0x80:] = True
    return t


def docs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) of a documents table with any extra columns; ids as long, texts as string."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def blocks(batch: pa.RecordBatch, col: str = "text", most: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of whole texts of about ``most`` bytes;
    a null text has no bytes; offsets are relative to the block."""
    arr = batch.column(batch.schema.get_field_index(col)).cast(pa.large_string())
    n = len(arr)
    if not n:
        return
    _, off, data = arr.buffers()
    offs = np.frombuffer(off, np.int64, n + 1, arr.offset * 8)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if arr.null_count:  # the bytes behind a null are undefined: pack the others anew
        lens = np.where(np.asarray(arr.is_null()), 0, np.diff(offs))
        parts = [buf[a:a + k] for a, k in zip(offs[:-1].tolist(), lens.tolist()) if k]
        buf = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
        offs = np.concatenate([[0], np.cumsum(lens)])
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + most, "right")) - 1)
        yield lo, hi, buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h = h * _M1
    h ^= h >> np.uint64(27)
    h *= _M2
    h ^= h >> np.uint64(31)
    return h


def odd_constants(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit constants."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


class Words:
    """Word bounds and 64-bit word hashes of a block of texts."""

    def __init__(self, cls: np.ndarray, lower: bool, seed: int = 1):
        self.cls = cls
        v = odd_constants(256, seed)
        if lower:
            v = v.copy()
            v[0x41:0x5B] = v[0x61:0x7B]
        self.value = v
        self.power = np.ones(1, np.uint64)

    def _powers(self, n: int) -> np.ndarray:
        if len(self.power) < n:
            p = np.full(max(64, 2 * n), 0x9E3779B97F4A7C15 | 1, np.uint64)
            p[0] = 1
            self.power = np.multiply.accumulate(p)
        return self.power

    def bounds(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, text) of every word; words never span two texts."""
        m = self.cls[buf]
        edge = np.empty(len(buf) + 1, bool)
        edge[0] = True
        edge[1:-1] = ~m[:-1]
        edge[-1] = True
        first = offs[:-1]
        edge[first] = True  # the start of a text opens a word
        if not len(buf):
            z = np.zeros(0, np.int64)
            return z, z, z
        start = np.flatnonzero(m & edge[:-1])
        close = np.empty(len(buf), bool)
        close[:-1] = ~m[1:]
        close[-1] = True
        last = offs[1:] - 1
        close[last[last >= 0]] = True
        end = np.flatnonzero(m & close) + 1
        return start, end, np.searchsorted(offs, start, "right") - 1

    def hashes(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        if not len(start):
            return np.zeros(0, np.uint64)
        lens = end - start
        first = np.concatenate([[0], np.cumsum(lens)])
        within = np.arange(first[-1]) - np.repeat(first[:-1], lens)
        take = within + np.repeat(start, lens)
        h = self.value[buf[take]] * self._powers(int(lens.max()))[within]
        return mix(np.add.reduceat(h, first[:-1]) + lens.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def gram_hashes(h: np.ndarray, k: int, seed: int = 7) -> np.ndarray:
    """Hash of every run of k consecutive hashes (order matters); len(h) - k + 1 of them."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j, c in enumerate(odd_constants(k, seed)):
        out += mix(h[j:j + n] ^ c) * c
    return mix(out)


def lists(offsets: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)
