"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

**Pieces.**  A document is its ids and one end id.  One longer than the capacity is cut into
pieces of full capacity, the first of which may be shorter.

**Large-item matching.**  Pieces above a third of the capacity fit at most twice in a
sequence: in descending order of length each goes to the fullest sequence with one large piece
that still has room (greedy matching, which is optimal for such pieces), else to a new one.
Smaller pieces, in descending order, go to the smallest gap that holds them (best fit).

**Scale.**  Pieces of one length are interchangeable, so the packing is worked out on the
histogram of lengths (at most ``capacity`` counts reach the driver, however many documents
there are): ``pack_histogram`` gives runs "pieces number r .. of length s go to the sequences
from b on, q in each".  The number of runs depends on the capacity, not on the documents; they
are broadcast.  A piece finds its number among the pieces of its length from the count inside
its task and the totals of the tasks before, so a length that a third of all rows share is
numbered by all tasks.  Texts are read and tokenised once, map-side.

**Ids** are those of the tokenizers library.  A text is cut at single blanks between two
other characters, and before a mark between a letter and a blank, where no pre-token
can cross; the words of a block are told apart first, and
their ids are kept in a bounded memo.  Unknown words go through the pre-token pattern, unknown
pre-tokens through the merges of the file (``bpe.Merger``; held against the library in the
tests).  A word that holds a special token's string goes to the library itself.

Null and empty texts are one piece with the end id alone.  Rows with equal ids or texts stay
separate rows, null ids stay null, extra columns are left out, an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship_package, stage_table
from .bpe import _share
from .textnum import docs, kept, lists
from .token_counts import merger_of

CAPACITY, END_ID = 1024, 2
MEMO = 700_000
LONG_WORD = 256  # longer words are not remembered
BLOCK_BYTES = 1 << 21
LETTERS = r"[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}]"
CUT = "\x01"  # stands before a mark that is cut off the word before it
#: What separates words for any of the regular expression engines in use.
WHITE = r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{180E}\x{2000}-\x{200B}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
RANK_BITS = 44


class Pool:
    """Runs of ids, one after the other; row i is ``ids[first[i]:first[i] + size[i]]``."""

    def __init__(self):
        self.ids, self.first, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.size)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the rows in order, how many each has)."""
        size = self.size[rows]
        end = np.cumsum(size)
        return self.ids[np.repeat(self.first[rows] - end + size, size) + np.arange(int(end[-1]) if len(end) else 0)], size

    def add(self, ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Numbers of the rows added."""
        row = len(self)
        self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(size) - size])
        self.size, self.ids = np.concatenate([self.size, size]), np.concatenate([self.ids, ids.astype(np.uint32)])
        return np.arange(row, row + len(size))

    def add_lists(self, lists_: list) -> np.ndarray:
        size = np.fromiter(map(len, lists_), np.int64, len(lists_))
        return self.add(np.fromiter(chain.from_iterable(lists_), np.uint32, int(size.sum())), size)


class Ids:
    """Ids of whole texts by a tokenizers file, with bounded memos of words and pre-tokens."""

    def __init__(self, data: bytes, pattern: str):
        import os
        import regex
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_str(data.decode())
        self.merger = merger_of(json.loads(data))
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.split = regex.compile(pattern).findall
        self.cut = re.compile(r"(?<=\S) (?=\S)").split
        self.clear()

    def clear(self) -> None:
        self.words: dict[str, int] = {}  # word (without its blank) -> row of the pool
        self.heads: dict[str, int] = {}  # the same for words that open a text
        self.pool = Pool()
        self.clear_parts()

    def clear_parts(self) -> None:
        self.parts: dict[str, int] = {}  # pre-token -> row of its pool
        self.part_pool = Pool()

    def _learn(self, texts: list[str], special: bool) -> np.ndarray:
        """Rows of the pool that hold the ids of new words (with their blanks)."""
        rows = np.empty(len(texts), np.int64)
        plain = pc.match_substring_regex(pa.array(texts, pa.string()), f"^ ?{LETTERS}+$").to_numpy(zero_copy_only=False)
        one = np.flatnonzero(plain)  # a single pre-token
        rows[one] = self.pool.add_lists(self.merger.encode_many([texts[i].encode() for i in one.tolist()]))
        rest = np.flatnonzero(~plain).tolist()
        for i in [i for i in rest if special and any(x in texts[i] for x in self.special)]:  # special tokens are the library's work
            rows[i] = self.pool.add_lists([self.library.encode(texts[i], add_special_tokens=False).ids])[0]
            rest.remove(i)
        split = [self.split(texts[i]) for i in rest]
        count = np.fromiter(map(len, split), np.int64, len(split))
        flat = list(chain.from_iterable(split))
        if len(self.parts) > MEMO:
            self.clear_parts()
        new = list(set(flat).difference(self.parts))
        self.parts.update(zip(new, self.part_pool.add_lists(self.merger.encode_many([p.encode() for p in new])).tolist()))
        ids, size = self.part_pool.take(np.fromiter(map(self.parts.__getitem__, flat), np.int64, len(flat)))
        total = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(count)])]
        rows[rest] = self.pool.add(ids, np.diff(total))
        for p in [p for p in new if len(p) > LONG_WORD]:
            del self.parts[p]
        return rows

    def _rows(self, memo: dict[str, int], named: pa.Array, blank: str, special: bool) -> np.ndarray:
        words = named.to_numpy(zero_copy_only=False).tolist()
        rows = np.fromiter((memo.get(w, -1) for w in words), np.int64, len(words))
        new = np.flatnonzero(rows < 0)
        if len(new):
            fresh = [words[i] for i in new.tolist()]
            rows[new] = self._learn([w[1:] if blank and w[:1] == CUT else blank + w for w in fresh], special)
            memo.update((w, r) for w, r in zip(fresh, rows[new].tolist()) if len(w) <= LONG_WORD)
        return rows

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, first id of each text and the end); null: empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        special = any(pc.any(pc.match_substring(texts, x)).as_py() for x in self.special)
        odd = pc.match_substring_regex(texts, f" {WHITE}|{WHITE} |{CUT}").to_numpy(zero_copy_only=False)
        split = pc.split_pattern(pc.replace_substring_regex(texts, f"({LETTERS})([.,;:!?])( |$)", f"\\1 {CUT}\\2\\3"), " ")
        if odd.any():
            cut = pa.array([[t] if CUT in t else self.cut(t) for t in texts.filter(pa.array(odd)).to_pylist()], split.type)
            place = np.where(odd, len(texts) + np.cumsum(odd) - 1, np.arange(len(texts)))
            split = pa.concat_arrays([split, cut]).take(pa.array(place))
        if len(self.words) + len(self.heads) > MEMO:
            self.clear()
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        code, named = coded.indices.to_numpy().copy(), coded.dictionary
        head = code[bounds[:-1]]
        rows = np.full(len(named), -1, np.int64)
        inner = np.ones(len(code), bool)
        inner[bounds[:-1]] = False
        used = np.unique(code[inner])
        rows[used] = self._rows(self.words, named.take(pa.array(used)), " ", special)
        row = rows[code]
        opens, place = np.unique(head, return_inverse=True)
        row[bounds[:-1]] = self._rows(self.heads, named.take(pa.array(opens)), "", special)[place]
        ids, size = self.pool.take(row)
        return ids, np.concatenate([[0], np.cumsum(size)])[bounds]


def _text_blocks(col: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) for runs of whole texts of about BLOCK_BYTES bytes."""
    size = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64))])
    lo = 0
    while lo < len(col):
        hi = max(lo + 1, int(np.searchsorted(size, size[lo] + BLOCK_BYTES, "right")) - 1)
        yield lo, col.slice(lo, hi - lo)
        lo = hi


def _pieces(shared, pattern: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = shared.value
        ids_of = kept(("ids", hashlib.sha256(data).digest(), pattern), lambda: Ids(data, pattern))
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for lo, texts in _text_blocks(batch.column(1)):
                flat, bounds = ids_of(texts)
                n = np.diff(bounds) + 1
                flat = np.insert(flat, bounds[1:], end_id).astype("<u4")
                first = np.concatenate([[0], np.cumsum(n)])
                many = -(-n // capacity)  # pieces of each document
                doc = np.repeat(np.arange(len(texts)), many)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
                head = n - (many - 1) * capacity
                start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
                length = np.where(piece == 0, head[doc], capacity)
                at = first[doc] + start
                crc = [zlib.crc32(flat[a:a + k]) for a, k in zip(at.tolist(), length.tolist())]
                # number of each piece among those of its length in this task
                order = np.argsort(length, kind="stable")
                runs = np.flatnonzero(np.concatenate([[True], np.diff(length[order]) != 0]))
                local = np.empty(len(doc), np.int64)
                local[order] = np.arange(len(doc)) - np.repeat(runs, np.diff(np.append(runs, len(doc)))) + seen[length[order]]
                seen += np.bincount(length, minlength=capacity + 1)
                cols = {"doc_id": batch.column(0).slice(lo, len(texts)).take(pa.array(doc)), "piece": pa.array(piece.astype(np.int32)),
                        "start": pa.array(start), "length": pa.array(length), "ids_crc32": pa.array(crc, pa.int64()),
                        "task": pa.array(np.full(len(doc), task, np.int32)), "local": pa.array(local)}
                if with_ids:  # pieces follow each other in the order of the ids
                    cols["ids"] = lists(np.append(at, len(flat)), pa.array(flat.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))
    return run


class Runs:
    """Where the pieces go: row i says that the pieces of length ``size[i]`` from number
    ``rank[i]`` on fill the sequences from ``bin[i]``, ``each[i]`` in one, from ``base[i]`` on."""

    def __init__(self, rows: list[tuple[int, int, int, int, int]]):
        rows = sorted(rows) or [(0, 0, 0, 1, 0)]
        self.size, self.rank, self.bin, self.each, self.base = (np.array(c, np.int64) for c in zip(*rows))
        self.key = (self.size << RANK_BITS) + self.rank

    def place(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the pieces of these lengths and numbers."""
        i = np.searchsorted(self.key, (size << RANK_BITS) + rank, "right") - 1
        k = rank - self.rank[i]
        return self.bin[i] + k // self.each[i], self.base[i] + k % self.each[i] * size


class _Gaps:
    """Sequences by the room that is left: stretches (first sequence, how many)."""

    def __init__(self, capacity: int):
        self.of: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def smallest(self, size: int) -> int | None:
        return next((g for g in range(size, len(self.of)) if self.of[g]), None)

    def put(self, gap: int, first: int, many: int) -> None:
        if many:
            self.of[gap].append((first, many))


def pack_histogram(count: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """(rows for ``Runs``, number of sequences) for ``count[length]`` pieces of each length."""
    rows: list[tuple[int, int, int, int, int]] = []
    one, gaps, bins = _Gaps(capacity), _Gaps(capacity), 0  # sequences with one large piece; the others
    for size in sorted((s for s in count if count[s] > 0), reverse=True):
        left, rank, large = count[size], 0, 3 * size > capacity
        room = one if large else gaps
        while left:
            gap = room.smallest(size)
            if gap is None:
                first, many, gap = bins, None, capacity
            else:
                first, many = room.of[gap].pop()
            each = gap // size if not large else 1 if many else min(2, gap // size)
            full, rest = divmod(left, each)
            used = full + (rest > 0)
            if many is None:
                bins += used
            elif used > many:
                full, rest, used = many, 0, many
            else:
                room.put(gap, first + used, many - used)
            rows.append((size, rank, first, each, capacity - gap))
            done = full * each + rest
            left, rank = left - done, rank + done
            # where a large piece may still join, the sequence stays open for one
            paired = gaps if not large or many is not None or each == 2 else one
            paired.put(gap - each * size, first, full)
            if rest:
                (one if large else gaps).put(gap - rest * size, first + full, 1)
        if large and not any(3 * s > capacity for s in count if s < size and count[s] > 0):
            for g, stretches in enumerate(one.of):  # matching is over: all gaps are open to the small ones
                for first, many in stretches:
                    gaps.put(g, first, many)
            one = _Gaps(capacity)
    return rows, bins


def _placed(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: Runs = shared.value
        for batch in batches:
            size, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            sequence, offset = runs.place(size, rank)
            keep = [i for i, c in enumerate(batch.schema.names) if c != "rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(sequence), pa.array(offset)],
                                             [*(batch.schema.names[i] for i in keep), "sequence_id", "offset"])
    return run


def pack(documents: DataFrame, path: str, pattern: str, *, capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = False,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece; with ``ids``
    also its ids.  ``path``: tokenizers file, read on the driver; ``pattern``: its pre-tokens."""
    spark = documents.sparkSession
    ship_package(spark)
    shared = _share(spark, path)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, local long" + (", ids array<int>" if ids else "")
    rows = stage_table(docs(documents, id_col, text_col).mapInArrow(_pieces(shared, pattern, capacity, end_id, ids), schema))
    per_task = rows.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    count = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    runs = spark.sparkContext.broadcast(Runs(pack_histogram(count, capacity)[0]))
    w = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # one row a task
    before = per_task.select("task", "length", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
    ranked = rows.join(before, ["task", "length"])
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"] + (["ids"] if ids else [])
    ranked = ranked.select(*cols, (F.col("before") + F.col("local")).alias("rank"))
    out = schema.replace(", task int, local long", "") + ", sequence_id long, offset long"
    return ranked.mapInArrow(_placed(runs), out)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, doc_ids, ids of every sequence of a table that ``pack(..., ids=True)`` made."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    got = packed.groupBy("sequence_id").agg(inside.alias("p"))
    return got.select("sequence_id", F.col("p.doc_id").alias("doc_ids"), F.flatten("p.ids").alias("ids"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
