"""Substring dedup on words by prefix-partitioned suffix trees.

``repeats`` brings all contents that may share a 13-word window to one shard; this module
builds the suffix trees of a shard.

* **Prefix partition.**  The suffixes that begin a window are split by their first word; a
  group of more than ``GROUP`` suffixes is split by the next word, and so on, so prefixes have
  the length their frequency asks for (at most a window).  Groups are packed into batches of
  about ``GROUP`` suffixes; only one batch is in work at a time.
* **Subtrees.**  A batch grows its subtrees top-down, one level of words a step, all nodes of
  a level at once.  A node with one leaf needs no deeper level.  The nodes of depth 13 with
  two leaves or more lie on the paths to the maximal repeats; each gives the smallest document
  that holds its string, and every leaf from another document is a repeat.

Words are compared by 64-bit hashes of their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bitmap import plain_names
from .repeats import Shard, Spec, apply_ranges, ranges_of, repeated_ranges
from .textnum import Words, space_words

GROUP = 500_000
SPEC = Spec("words", 13, 4)


def _split(sym: np.ndarray, at: np.ndarray, node: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One level down: (order, node, leaves per node) by (node, word at the given depth)."""
    word = sym[at + depth]
    order = np.lexsort((word, node))
    n, w = node[order], word[order]
    new = np.ones(len(order), bool)
    new[1:] = (n[1:] != n[:-1]) | (w[1:] != w[:-1])
    ids = np.cumsum(new) - 1
    return order, ids, np.bincount(ids)


def prefix_groups(sym: np.ndarray, at: np.ndarray, window: int, group: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Batches (suffix, node, depth) of groups that share a prefix of ``depth`` words; a group
    has at most ``group`` suffixes unless its prefix is a whole window."""
    batch: list[tuple[np.ndarray, int]] = []
    held = 0
    todo = [(np.arange(len(at)), 0)]
    while todo:
        idx, depth = todo.pop()
        if len(idx) > group and depth < window:
            order, ids, size = _split(sym, at[idx], np.zeros(len(idx), np.int64), np.full(len(idx), depth))
            some = np.split(idx[order], np.cumsum(size)[:-1])
            small = [x for x in some if len(x) <= group]
            todo += [(x, depth + 1) for x in some if len(x) > group]
        else:
            small, depth = [idx], depth - 1
        for x in small:
            if len(x) > 1:
                batch.append((x, depth + 1))
                held += len(x)
                if held > group:
                    yield _packed(batch)
                    batch, held = [], 0
    if batch:
        yield _packed(batch)


def _packed(batch: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = [len(x) for x, _ in batch]
    return np.concatenate([x for x, _ in batch]), np.repeat(np.arange(len(batch)), size), np.repeat([d for _, d in batch], size)


def deep_nodes(sym: np.ndarray, at: np.ndarray, node: np.ndarray, depth: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the leaf, node) of all nodes at depth ``window`` with two leaves or more."""
    idx = np.arange(len(at))
    while len(idx) and depth.min() < window:
        down = np.minimum(depth, window - 1)  # a finished group repeats its last word
        order, ids, size = _split(sym, at[idx], node, down)
        idx, depth = idx[order], np.minimum(depth[order] + 1, window)
        keep = size[ids] > 1
        idx, node, depth = idx[keep], ids[keep], depth[keep]
    return idx, node


def repeated_windows(shard: Shard) -> np.ndarray:
    """For every window of the shard: is its string also in a document of smaller id than the
    first that has the window's content?"""
    at, owner = shard.windows()
    out = np.zeros(len(at), bool)
    first_id = shard.place[:, 0][owner]
    for idx, node, depth in prefix_groups(shard.data, at, SPEC.window, GROUP):
        leaf, node = deep_nodes(shard.data, at[idx], node, depth, SPEC.window)
        if len(leaf):
            ids = first_id[idx[leaf]]
            order = np.argsort(node, kind="stable")
            start = np.flatnonzero(np.concatenate([[True], np.diff(node[order]) != 0]))
            least = np.minimum.reduceat(ids[order], start)
            low = np.repeat(least, np.diff(np.concatenate([start, [len(order)]])))
            out[idx[leaf[order]]] = ids[order] > low
    return out


def duplicate_ranges(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, froms, tos): word ranges of every text whose windows also start in a document
    of smaller id."""
    return repeated_ranges(documents, SPEC, repeated_windows, by_text=True, id_col=id_col, text_col=text_col)


def _kept(batch: pa.RecordBatch, text_col: str, words: Words):
    """(words, words removed, kept words) of every row."""
    for i, t in enumerate(batch.column(batch.schema.get_field_index(text_col))):
        raw = (t.as_py() or "").encode()
        buf = np.frombuffer(raw, np.uint8)
        start, end, _ = words.bounds(buf, np.array([0, len(raw)]))
        keep = np.ones(len(start), bool)
        a, b = ranges_of(batch, i)
        for x, y in zip(a.tolist(), b.tolist()):
            keep[x:y] = False
        yield len(start), int((~keep).sum()), b" ".join(raw[x:y] for x, y in zip(start[keep].tolist(), end[keep].tolist()))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = Words(space_words(), lower=False)
    for batch in batches:
        rows = list(_kept(batch, "text", words))
        yield pa.RecordBatch.from_arrays(
            [batch.column(batch.schema.get_field_index("doc_id")), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([hashlib.sha256(r[2]).hexdigest() for r in rows], pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])


def _rewritten(text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(space_words(), lower=False)
        for batch in batches:
            k = batch.schema.get_field_index(text_col)
            old = batch.column(k).to_pylist()
            new = [kept.decode() if removed else was for was, (_, removed, kept) in zip(old, _kept(batch, text_col, words))]
            cols = list(batch.columns[:-2])
            cols[k] = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays(cols, batch.schema.names[:-2])
    return run


def remove_duplicates(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``documents``; texts that lose words are rebuilt from the kept
    words, joined by one space."""
    plain, (id_col, text_col) = plain_names(documents, id_col, text_col)
    plain = plain.withColumn(text_col, F.col(text_col).cast("string"))
    ranges = duplicate_ranges(plain, id_col=id_col, text_col=text_col)
    return apply_ranges(plain, ranges, _rewritten(text_col), plain.schema, id_col=id_col, text_col=text_col).toDF(*documents.columns)


def dedup_digests(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return apply_ranges(docs, duplicate_ranges(docs), _digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def op8_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
