"""Suffix-array dedup of byte strings by external induced sorting.

``repeats`` brings all contents that may share a 100-byte string to one shard; this module sorts
the suffixes of a shard and reads the repeats off neighbouring suffixes.

**Induced sorting.**  The suffixes are classed L and S; the leftmost S of each run (LMS) are
sorted first, recursively, on the text of their names; all L suffixes follow from them in one
ascending pass, all S suffixes in one descending pass.  The queue of both passes is a priority
queue keyed by the first symbol.  Keys only grow (or only fall) during a pass, so it is kept as
one run per symbol; runs beyond ``ITEMS`` queued positions go to a temporary file and come back
when their symbol is due.  Results are such runs too, and the text is a memory-mapped file when
it is large, so a shard may exceed the memory of its task.  All suffixes of a run that are due
together are induced by one numpy step.  Names of the recursion form large alphabets with runs
of a few suffixes each, where such steps do nearly nothing: that text, half of the shard at
most, is sorted by prefix doubling (``_doubled``), a sort of all suffixes not yet told apart a
step.

**Common prefixes.**  Equal windows are neighbours among the sorted window positions; neighbours
are compared up to the window length, four symbols a step.

A shard's contents are already distinct (``repeats`` collapses equal ones to their earliest
occurrence), so copies in any number cost one content.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bitmap import plain_names
from .repeats import Shard, Spec, apply_ranges, ranges_of, repeated_ranges
from .textnum import mix, odd_constants

ITEMS = 8_000_000
WIDE = 4096
WINDOW = 100
SPEC = Spec("bytes", WINDOW, 32)


class RunQueue:
    """Monotone priority queue of positions: one run per key, in the order of arrival; runs
    are written to a temporary file when more than ``items`` positions are held."""

    def __init__(self, keys: int, items: int):
        self.items, self.held, self.file = items, 0, None
        self.memory: list[list[np.ndarray]] = [[] for _ in range(keys)]
        self.disk: list[list[tuple[int, int]]] = [[] for _ in range(keys)]

    def push(self, key: int, positions: np.ndarray) -> None:
        self.memory[key].append(positions)
        self.held += len(positions)
        if self.held > self.items:
            self._spill()

    def deal(self, keys: np.ndarray, positions: np.ndarray) -> None:
        """Push each position to the run of its key, keeping the order within runs."""
        order = np.argsort(keys, kind="stable")
        k, p = keys[order], positions[order]
        cut = np.flatnonzero(np.diff(k)) + 1
        for key, part in zip(k[np.concatenate([[0], cut])].tolist(), np.split(p, cut)):
            self.push(key, part)

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for key, parts in enumerate(self.memory):
            if parts:
                whole = np.concatenate(parts)
                self.disk[key].append((self.file.tell(), len(whole)))
                whole.tofile(self.file)
                self.memory[key] = []
        self.held = 0

    def _joined(self, key: int) -> list[np.ndarray]:
        if len(self.memory[key]) > 1:
            self.memory[key] = [np.concatenate(self.memory[key])]
        return self.memory[key]

    def parts(self, key: int, reverse: bool = False) -> Iterator[np.ndarray]:
        """The parts of a run (backwards, each part reversed too)."""
        if reverse:
            for part in self._joined(key):
                yield part[::-1]
            for at, n in reversed(self.disk[key]):
                yield self._read(at, n)[::-1]
        else:
            for at, n in self.disk[key]:
                yield self._read(at, n)
            yield from self._joined(key)

    def _read(self, at: int, n: int) -> np.ndarray:
        self.file.seek(at)
        return np.fromfile(self.file, np.int64, n)

    def take(self, key: int) -> Iterator[np.ndarray]:
        """Remove and yield the parts of a run, those that arrive meanwhile included."""
        while self.disk[key] or self.memory[key]:
            disk, memory = self.disk[key], self._joined(key)
            self.disk[key], self.memory[key] = [], []
            self.held -= sum(map(len, memory))
            for at, n in disk:
                yield self._read(at, n)
            yield from memory

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def _types(text: np.ndarray) -> np.ndarray:
    """True where the suffix is S; the last symbol is the smallest and only one of its kind."""
    step = np.sign(np.diff(text.astype(np.int64)))
    up = np.zeros(len(text), bool)
    up[-1] = True
    at = np.where(step != 0, np.arange(len(step)), len(step))
    nearest = np.minimum.accumulate(at[::-1])[::-1]  # first change at or after each place
    inside = nearest < len(step)
    up[:-1][inside] = step[nearest[inside]] > 0
    return up


def _induce_runs(text: np.ndarray, is_s: np.ndarray, lms: np.ndarray, keys: int, items: int) -> Iterator[np.ndarray]:
    """Positions of all suffixes in order, in parts, from LMS positions ordered by (at least)
    their first symbol."""
    queue, low, high = RunQueue(keys, items), RunQueue(keys, items), RunQueue(keys, items)
    first = text[lms]
    cut = np.searchsorted(first, np.arange(keys + 1))

    def before(part: np.ndarray, want_s: bool) -> None:
        j = part[part > 0] - 1
        j = j[is_s[j] == want_s]
        if len(j):
            queue.deal(text[j], j)
    for c in range(keys):
        for part in queue.take(c):
            low.push(c, part)
            before(part, False)
        if cut[c] < cut[c + 1]:
            before(lms[cut[c]:cut[c + 1]], False)
    for c in range(keys - 1, -1, -1):
        for part in queue.take(c):
            high.push(c, part)
            before(part, True)
        for part in low.parts(c, reverse=True):
            before(part, True)
    yield np.array([len(text) - 1])
    for c in range(keys):
        yield from low.parts(c)
        yield from high.parts(c, reverse=True)
    for q in (queue, low, high):
        q.close()


def _doubled(text: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in order, by prefix doubling, for alphabets with small runs.  A
    suffix is ranked by the place of the last of those not yet told apart from it."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    rank = np.empty(n, np.int64)
    at, span, value = np.arange(n), 1, text[order].astype(np.int64)  # places in ``order`` still to settle, in groups of equal rank
    while True:
        new = np.ones(len(at), bool)
        new[1:] = value[1:] != value[:-1]
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(at)))
        rank[order[at]] = at[np.repeat(first + size - 1, size)]
        some = np.repeat(size > 1, size)
        at = at[some]
        if not len(at):
            return order
        who = order[at]
        # the last symbol is the smallest and only one of its kind: no suffix in a group ends within span
        pair = rank[who] * n + rank[who + span]
        by = np.argsort(pair, kind="stable")
        order[at], value = who[by], pair[by]
        span *= 2


def sorted_suffixes(text: np.ndarray, keys: int, items: int | None = None) -> Iterator[np.ndarray]:
    """Suffix array in parts.  ``text``: symbols 0 .. keys - 1, ended by the only 0."""
    items = items or ITEMS
    if len(text) == 1:
        yield np.array([0])
        return
    if keys > WIDE:
        yield _doubled(text)
        return
    is_s = _types(text)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    star = np.zeros(len(text), bool)
    star[lms] = True
    some = np.concatenate([p[star[p]] for p in _induce_runs(text, is_s, lms[np.argsort(text[lms], kind="stable")], keys, items)])
    # names of the LMS substrings (up to and with the next LMS): hashes, compared in order
    rank = np.zeros(len(text), np.int64)
    rank[lms] = np.arange(len(lms))
    lens = np.diff(np.concatenate([lms, [len(text)]]))
    body = text[lms[0]:] if len(lms) else text
    within = np.arange(len(body)) - np.repeat(lms - lms[0], lens)
    power = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(int(lens.max()), odd_constants(1, 17)[0])]))
    code = np.add.reduceat(mix(body.astype(np.uint64) + np.uint64(1)) * power[within], lms - lms[0])
    after = np.concatenate([text[lms[1:]], [0]]).astype(np.uint64)
    code = mix(code + mix(lens.astype(np.uint64) * np.uint64(65599) + after))
    order = rank[some]
    differs = np.concatenate([[0], code[order][1:] != code[order][:-1]])
    name = np.zeros(len(lms), np.int64)
    name[order] = np.cumsum(differs)
    count = int(name.max()) + 1
    if count < len(lms):
        some = lms[np.concatenate(list(sorted_suffixes(name, count, items)))]
    yield from _induce_runs(text, is_s, some, keys, items)


def repeated_windows(shard: Shard) -> np.ndarray:
    """For every window of the shard: does its string start earlier than the earliest
    occurrence of the window's content?"""
    at, owner = shard.windows()
    n = len(shard.data)
    big = n > ITEMS
    with tempfile.TemporaryFile() as f:
        text = np.memmap(f, np.uint16, "w+", shape=(n + 1,)) if big else np.empty(n + 1, np.uint16)
        text[:n] = shard.data
        text[:n] += 2
        text[shard.base + shard.n + SPEC.window - 1] = 1  # the padding ends a content
        text[n] = 0
        window_of = np.full(n + 1, -1, np.int64)
        window_of[at] = np.arange(len(at))
        out = np.zeros(len(at), bool)
        place = shard.place[owner]
        place_at = place[:, 2] + (at - shard.base[owner])

        def settle(group: np.ndarray, size: np.ndarray) -> None:
            """Windows of equal strings, one group after another."""
            g = np.repeat(np.arange(len(size)), size)
            o = np.lexsort((place_at[group], place[group, 1], place[group, 0], g))
            out[group[o]] = True
            out[group[o[np.concatenate([[0], np.cumsum(size)[:-1]])]]] = False
        held = np.zeros(0, np.int64)
        for part in sorted_suffixes(text, 258):
            w = window_of[part]
            held = np.concatenate([held, w[w >= 0]])
            if len(held) > ITEMS:
                held = _grouped(text, at, held, settle, False)
        _grouped(text, at, held, settle, True)
    return out


def _grouped(text: np.ndarray, at: np.ndarray, windows: np.ndarray, settle, last: bool) -> np.ndarray:
    """Settle the groups of neighbours whose common prefix reaches the window length; returns
    the windows of the group that may go on."""
    if not len(windows):
        return windows
    pos = at[windows]
    same = np.arange(len(pos) - 1)
    word = np.ndarray((len(text) - 3,), np.uint64, text, strides=(2,))  # the four symbols from each place
    for k in range(0, SPEC.window, 4):  # common prefixes, counted up to the window
        same = same[word[pos[same] + k] == word[pos[same + 1] + k]]
        if not len(same):
            break
    joined = np.zeros(len(pos), bool)
    joined[same + 1] = True
    start = np.flatnonzero(~joined)
    if not last:
        windows, rest, start = windows[:start[-1]], windows[start[-1]:], start[:-1]
    else:
        rest = windows[:0]
    size = np.diff(np.concatenate([start, [len(windows)]]))
    many = np.repeat(size > 1, size)
    if many.any():
        settle(windows[many], size[size > 1])
    return rest


def duplicate_ranges(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, froms, tos): byte ranges of every text that repeat an earlier 100-byte string."""
    return repeated_ranges(documents, SPEC, repeated_windows, by_text=False, id_col=id_col, text_col=text_col)


def _without(raw: bytes, froms: np.ndarray, tos: np.ndarray) -> bytes:
    parts, last = [], 0
    for a, b in zip(froms.tolist(), tos.tolist()):
        parts.append(raw[last:a])
        last = b
    parts.append(raw[last:])
    return b"".join(parts)


def _digest(id_col: str, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(batch.schema.get_field_index(id_col)), batch.column(batch.schema.get_field_index(text_col))
            out: list[list] = [[], [], [], []]
            for i, t in enumerate(texts):
                raw = (t.as_py() or "").encode()
                a, b = ranges_of(batch, i)
                out[0].append(len(raw))
                out[1].append(int((b - a).sum()))
                out[2].append(len(a))
                out[3].append(hashlib.sha256(_without(raw, a, b)).hexdigest())
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.string())],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return run


def _rewritten(text_col: str, length_col: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.schema.get_field_index(text_col)
            texts, chars = [], []
            for i, t in enumerate(batch.column(k)):
                x = t.as_py()
                a, b = ranges_of(batch, i)
                if len(a):  # a character that lost some of its bytes goes as a whole
                    x = _without(x.encode(), a, b).decode("utf-8", "ignore")
                texts.append(x)
                chars.append(None if x is None else len(x))
            cols = list(batch.columns[:-2])
            cols[k] = pa.array(texts, pa.string())
            if length_col:
                j = batch.schema.get_field_index(length_col)
                changed = [old if new == was else c for old, new, was, c in zip(cols[j].to_pylist(), texts, batch.column(k).to_pylist(), chars)]
                cols[j] = pa.array(changed, cols[j].type)
            yield pa.RecordBatch.from_arrays(cols, batch.schema.names[:-2])
    return run


def remove_duplicates(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """All rows and columns of ``documents`` with the repeated bytes cut out of the text;
    ``length_col``, if given, gets the new length in characters where the text changed."""
    plain, (id_col, text_col, length_col) = plain_names(documents, id_col, text_col, length_col)
    plain = plain.withColumn(text_col, F.col(text_col).cast("string"))
    ranges = duplicate_ranges(plain, id_col=id_col, text_col=text_col)
    return apply_ranges(plain, ranges, _rewritten(text_col, length_col), plain.schema, id_col=id_col, text_col=text_col).toDF(*documents.columns)


def dedup_digests(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return apply_ranges(docs, duplicate_ranges(docs), _digest("doc_id", "text"),
                        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op4_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
