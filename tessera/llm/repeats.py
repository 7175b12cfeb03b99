"""Finding repeated windows across a corpus: the part that suffix arrays and suffix trees share.

A *window* is W consecutive symbols (bytes or words) of one text.  Equal windows must meet in
one shard without shipping all suffixes:

1. **Keys.**  Every window is keyed by its smallest m-gram hash.  Equal windows have equal
   keys, and neighbouring windows mostly share one, so a text falls into *stretches*: maximal
   runs of windows with one key.  m-grams that occur in a large share of the texts (found by
   a counting pass without shuffle, at most ``stretches per text / HOT`` of them) are passed
   over where a window has another, so a common line does not become a hot key.
2. **Candidates.**  Keys are counted (summed per block of text before the shuffle); keys seen
   once cannot hold a repeat.  The others go back to the tasks as a bitmap of bounded size
   (at most ``2**FILTER_BITS`` bits, 16 MB): a false positive costs a row, never a result.
3. **Contents.**  Candidate stretches are stored (hashes and places only).  Equal contents
   collapse (map-side) to their earliest occurrence.  A window that holds its key's m-gram
   also holds one of the two half windows beside it, so only contents that share a half
   window with another one (again a bitmap), or in which the m-gram recurs, are shipped to the
   shards, keyed by the m-gram.  Where it recurs, the half windows of every place count.
   A shard finds the repeated windows among its distinct contents (suffix array or suffix
   trees) and returns, for the earliest occurrence of each, which windows it must lose.
4. **Ranges.**  Every other occurrence of a content is repeated as a whole; ranges are gathered
   per text and applied.  Only texts that may hold a repeat are shuffled for that; the others
   are finished in the scan.

A text is identified by (id, 64-bit hash of the text): repeated rows of the same id and text
are one text and get one result.  Null ids come before all others.  Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import forget, free, ship_package, stage_table
from .bitmap import LEAST_ID, identified, in_bitmap, make_bitmap, marked, only_marked
from .textnum import Words, blocks, lists, mix, odd_constants, release, space_words

FILTER_BITS = 27
HOT = 0.0025
PIECE = 1 << 22
BLOCK = 1 << 19


@dataclass(frozen=True)
class Spec:
    """``symbols``: "bytes" or "words"; windows of ``window`` symbols keyed by ``gram``-grams (a
    power of two)."""
    symbols: str
    window: int
    gram: int

    @property
    def span(self) -> int:
        return self.window - self.gram + 1


class Scanner:
    """Symbols and stretches of blocks of texts."""

    def __init__(self, spec: Spec, hot: np.ndarray | None = None):
        self.spec = spec
        self.words = Words(space_words(), lower=False) if spec.symbols == "words" else None
        self.value = odd_constants(256, 11)
        self.hot = np.sort(hot) if hot is not None and len(hot) else None
        if self.hot is not None:
            self.near = np.zeros(1 << 16, bool)
            self.near[(self.hot >> np.uint64(47)).astype(np.int64)] = True
        self.factors = odd_constants(64, 13)

    def symbols(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(64-bit symbols, offsets of the texts in symbols)."""
        if self.words is None:
            return self.value[buf], offs
        start, end, owner = self.words.bounds(buf, offs)
        return self.words.hashes(buf, start, end), np.searchsorted(owner, np.arange(len(offs)))

    def _grams(self, sym: np.ndarray) -> np.ndarray:
        """Order value of every m-gram."""
        h, k, level = sym, 1, 0
        while k < self.spec.gram:
            h = h[:-k] * self.factors[level] + h[k:]
            k, level = 2 * k, level + 1
        v = mix(h) >> np.uint64(1)
        if self.hot is not None:
            some = np.flatnonzero(self.near[(v >> np.uint64(47)).astype(np.int64)])
            x = v[some]
            at = np.minimum(np.searchsorted(self.hot, x), len(self.hot) - 1)
            v[some[self.hot[at] == x]] |= np.uint64(1 << 63)
        return v

    def _slide(self, v: np.ndarray, best) -> np.ndarray:
        """Smallest or largest of every ``span`` values."""
        done, span = 1, self.spec.span
        while done < span:
            step = min(done, span - done)
            v = best(v[:-step], v[step:])
            done += step
        return v

    def _anchors(self, grams: np.ndarray, least: np.ndarray, start: np.ndarray, count: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places of m-grams that are the smallest of some window, which of them is the first of
        the key m-gram in each stretch, does it recur there).  Only stretches in which it recurs
        can hold equal windows.  An m-gram is the smallest of some window if and only if the
        largest of the minima of its windows is its own value; recurrences in a stretch are then
        neighbours."""
        span = self.spec.span
        pad = np.zeros(span - 1, np.uint64)
        top = self._slide(np.concatenate([pad, least, pad]), np.maximum)
        at = np.flatnonzero(top == grams)
        v = grams[at]
        i = np.searchsorted(at, start)
        todo = np.arange(len(start))
        while len(todo):
            todo = todo[v[i[todo]] != key[todo]]
            i[todo] += 1
        nxt = np.minimum(i + 1, len(at) - 1)
        return at, i, (i + 1 < len(at)) & (v[nxt] == key) & (at[nxt] < start + count - 1 + span)

    def _further(self, grams: np.ndarray, start: np.ndarray, count: np.ndarray, key: np.ndarray,
                 at: np.ndarray, i: np.ndarray, recurs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(how many in each stretch, hashes) of the half windows around the recurrences of the
        key m-gram in a stretch; each hash once a stretch."""
        who = np.flatnonzero(recurs)
        stop = np.searchsorted(at, start[who] + count[who] - 1 + self.spec.span)
        more = stop - i[who] - 1
        who = np.repeat(who, more)
        place = at[np.arange(len(who)) - np.repeat(np.cumsum(more) - more, more) + i[who] + 1]
        same = grams[place] == key[who]
        who, place = who[same], place[same]
        h = np.concatenate(self.flanks(grams, start[who], count[who], place))
        who = np.concatenate([who, who])[h != 0]
        h = h[h != 0]
        order = np.lexsort((h, who))
        who, h = who[order], h[order]
        once = np.ones(len(h), bool)
        once[1:] = (h[1:] != h[:-1]) | (who[1:] != who[:-1])
        return np.bincount(who[once], minlength=len(start)), h[once]

    def flanks(self, grams: np.ndarray, start: np.ndarray, count: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the half windows before and after the anchor, each with the anchor itself;
        0 where the stretch does not hold one.  A window that holds the anchor holds one of
        them, so contents of one key that share no half window around any of its places share no
        window."""
        m, half = self.spec.gram, -(-(self.spec.window - self.spec.gram) // 2)
        out = []
        for lo in (anchor - half, anchor):
            inside = (lo >= start) & (lo + half <= start + count - 1 + self.spec.window - m)
            h = np.zeros(len(anchor), np.uint64)
            x = lo[inside]
            for step, c in zip([*range(0, half, m), half], self.factors[20:]):
                h[inside] = mix(h[inside] * c + grams[x + step])
            out.append(h)
        return out[0], out[1]

    def window_hashes(self, grams: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Hash of the whole window that begins at each place."""
        m, last = self.spec.gram, self.spec.window - self.spec.gram
        h = np.zeros(len(at), np.uint64)
        for step, c in zip([*range(0, last, m), last], self.factors[30:]):
            h = mix(h * c + grams[at + step])
        return h

    def contents(self, grams: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Hash of the content of each stretch."""
        if not len(start):
            return start.view(np.uint64)
        first = np.concatenate([[0], np.cumsum(count)[:-1]])
        within = np.arange(int(count.sum())) - np.repeat(first, count)
        power = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(int(count.max()), self.factors[40])]))
        return mix(np.add.reduceat(self.window_hashes(grams, within + np.repeat(start, count)) * power[within], first) + count.astype(np.uint64))

    def stretches(self, sym: np.ndarray, offs: np.ndarray, keep=None, recurring: bool = False, every: bool = False, live=None) -> tuple[np.ndarray, ...]:
        """(first window, windows, key, text) of every stretch; windows by their first symbol.
        ``recurring`` adds: does the key recur in it.  With ``keep`` (a test of keys) only those
        that pass, and also the hashes of the half windows before and after the first place of the key
        and of the content.  ``live`` (a test of keys, recurrences and these two hashes) picks once more
        before contents are hashed.  ``every`` adds to these: the number of hashes of half windows around
        its further places, and these hashes, one stretch after another."""
        w = self.spec.window
        n = len(sym) - w + 1
        empty = np.zeros(0, np.int64)
        if n <= 0:
            none = (empty, empty, empty.view(np.uint64), empty)
            more = (empty.astype(bool), *[empty.view(np.uint64)] * 3, *(empty, empty.view(np.uint64))[:2 * every])
            return (*none, *more) if keep is not None else (*none, *more[:recurring])
        if n > PIECE:  # a very long block: pieces that overlap by a window
            parts = []
            for a in range(0, n, PIECE):
                cut = np.clip(offs, a, min(len(sym), a + PIECE + w - 1)) - a
                found = self.stretches(sym[a:a + PIECE + w - 1], cut, keep, recurring, every, live)
                parts.append((found[0] + a, *found[1:]))
            return tuple(np.concatenate(x) for x in zip(*parts))
        grams = self._grams(sym)
        least = self._slide(grams, np.minimum)
        edge = np.zeros(n + 1, np.int32)
        a, b = offs[:-1], offs[1:]
        long = b - a >= w
        np.add.at(edge, a[long], 1)
        np.add.at(edge, b[long] - w + 1, -1)
        valid = np.cumsum(edge[:-1]) > 0
        new = np.ones(n, bool)
        new[1:] = (least[1:] != least[:-1]) | ~valid[:-1]
        new &= valid
        start = np.flatnonzero(new)
        last = np.ones(n, bool)
        last[:-1] = new[1:] | ~valid[1:]
        count = np.flatnonzero(last & valid) - start + 1
        key = least[start]
        text = np.searchsorted(offs, start, "right") - 1
        if keep is None:
            more = (self._anchors(grams, least, start, count, key)[2] if len(start) else np.zeros(0, bool),) if recurring else ()
            return start, count, key, text, *more
        some = keep(key)
        start, count, key, text = start[some], count[some], key[some], text[some]
        if not len(start):
            return start, count, key, text, some[:0], key, key, key, *(count, key)[:2 * every]
        at, i, recurs = self._anchors(grams, least, start, count, key)
        more = self._further(grams, start, count, key, at, i, recurs) if every else ()
        found = (start, count, key, text, recurs, *self.flanks(grams, start, count, at[i]))
        if live is not None:
            some = live(key, recurs, *found[5:])
            found = tuple(x[some] for x in found)
        return *found, self.contents(grams, *found[:2]), *more


def _summed(keys: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    u, at = np.unique(k, return_inverse=True)
    return u, np.bincount(at, weights=c, minlength=len(u)).astype(np.int64)


def _frequent(spec: Spec):
    """Keys that stand out in a task: (key, n) with n at least HOT of its texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        scan, keys, counts, texts, held = Scanner(spec), [], [], 0, 0
        for batch in batches:
            texts += batch.num_rows
            for _, _, buf, offs in blocks(batch, most=BLOCK):
                key = scan.stretches(*scan.symbols(buf, offs))[2]
                u, c = np.unique(key, return_counts=True)
                keys.append(u)
                counts.append(c)
                held += len(u)
                if held > 4_000_000:
                    k, c = _summed(keys, counts)
                    keys, counts = [k[c > 1]], [c[c > 1]]
                    held = len(keys[0])
        if keys:
            k, c = _summed(keys, counts)
            top = c >= max(8, HOT * texts)
            yield pa.RecordBatch.from_arrays([pa.array(k[top].view(np.int64)), pa.array(c[top])], ["key", "n"])
    return run


def _keys(spec: Spec, hot):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        scan = Scanner(spec, hot.value)
        for batch in batches:
            for _, _, buf, offs in blocks(batch, most=BLOCK):
                _, count, key, _, recurs = scan.stretches(*scan.symbols(buf, offs), recurring=True)
                # a stretch whose key recurs can hold repeats by itself
                u, c = _summed([key], [1 + recurs]) if len(key) else (key, count)
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(c.astype(np.int32))], ["key", "n"])
    return run


STRETCH = "id long, th long, key long, c long, start long, n long, recurs boolean, before long, after long, more array<long>"


def _candidates(spec: Spec, hot, bitmap):
    """Stretches whose key is in the bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        scan, bits = Scanner(spec, hot.value), bitmap.value
        for batch in batches:
            ids, th = batch.column(0), batch.column(1)
            for lo, _, buf, offs in blocks(batch, most=BLOCK):
                sym, at = scan.symbols(buf, offs)
                start, count, key, text, recurs, before, after, code, size, more = scan.stretches(sym, at, lambda k: in_bitmap(bits, k), every=True)
                rows = pa.array(lo + text)
                b, a = (np.where(x == 0, x, mix(x ^ key)) for x in (before, after))
                more = lists(np.concatenate([[0], np.cumsum(size)]), pa.array(mix(more ^ np.repeat(key, size)).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(rows), th.take(rows), pa.array(key.view(np.int64)), pa.array(code.view(np.int64)), pa.array(start - at[text]),
                     pa.array(count), pa.array(recurs), pa.array(b.view(np.int64)), pa.array(a.view(np.int64)), more],
                    ["id", "th", "key", "c", "start", "n", "recurs", "before", "after", "more"])
    return run


CONTENT = "id long, th long, key long, c long, start long, n long, recurs boolean, content binary"


def _contents(spec: Spec, hot, bitmap, halves):
    """Stretches that share a half window with another content, or may hold repeats by
    themselves, with their content (once per block)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        scan, bits, half_bits = Scanner(spec, hot.value), bitmap.value, halves.value

        def live(key: np.ndarray, recurs: np.ndarray, *flanks: np.ndarray) -> np.ndarray:
            some = recurs.copy()
            for x in flanks:
                some |= (x != 0) & in_bitmap(half_bits, mix(x ^ key))
            return some
        for batch in batches:
            ids, th = batch.column(0), batch.column(1)
            for lo, _, buf, offs in blocks(batch, most=BLOCK):
                sym, at = scan.symbols(buf, offs)
                start, count, key, text, recurs, _, _, code = scan.stretches(sym, at, lambda k: in_bitmap(bits, k), live=live)
                raw = buf if spec.symbols == "bytes" else sym
                _, once = np.unique(code, return_index=True)
                send = np.zeros(len(code), bool)
                send[once] = True
                contents = [raw[s:s + c - 1 + spec.window].tobytes() if y else None for s, c, y in zip(start.tolist(), count.tolist(), send.tolist())]
                rows = pa.array(lo + text)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(rows), th.take(rows), pa.array(key.view(np.int64)), pa.array(code.view(np.int64)), pa.array(start - at[text]),
                     pa.array(count), pa.array(recurs), pa.array(contents, pa.binary())], ["id", "th", "key", "c", "start", "n", "recurs", "content"])
    return run


class Shard:
    """The distinct contents of a shard that may hold repeats.

    ``data``: their symbols end to end (from a disk-backed file), each content followed by one
    symbol of padding; ``base``: where each begins; ``n``: its windows; ``place``: (id, text hash,
    position) of the earliest occurrence, one column each."""

    def __init__(self, data: np.ndarray, base: np.ndarray, n: np.ndarray, place: np.ndarray):
        self.data, self.base, self.n, self.place = data, base, n, place

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``data``, content) of every window."""
        owner = np.repeat(np.arange(len(self.n)), self.n)
        first = np.concatenate([[0], np.cumsum(self.n)[:-1]]) if len(self.n) else np.zeros(0, np.int64)
        return np.arange(len(owner)) - np.repeat(first, self.n) + np.repeat(self.base, self.n), owner


SHARD_OUT = "key long, c long, offs array<int>, lens array<int>"


def _sharded(spec: Spec, repeated: Callable[[Shard], np.ndarray]):
    """One shard: ``repeated`` tells for every window of ``Shard.windows()`` whether the earliest
    occurrence of its content must lose it.  Returns the contents that lose some, with the runs."""
    import tempfile

    size = 1 if spec.symbols == "bytes" else 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        cols: list[list] = [[] for _ in range(7)]
        with tempfile.TemporaryFile() as f:
            for batch in batches:
                for i, name in enumerate(("key", "c", "fid", "fth", "fstart", "n", "recurs")):
                    x = batch.column(name)
                    cols[i].append((x.fill_null(LEAST_ID) if name == "fid" else x).to_numpy(zero_copy_only=False))
                for x in batch.column("content"):
                    f.write(x.as_buffer())
                    f.write(b"\0" * size)
            f.flush()
            if not cols[0]:
                return
            key, c, fid, fth, fstart, n, recurs = (np.concatenate(x) for x in cols)
            base = np.concatenate([[0], np.cumsum(n + spec.window)[:-1]])  # n - 1 + window symbols and the padding
            _, at, mates = np.unique(key, return_inverse=True, return_counts=True)
            live = np.flatnonzero((mates[at] > 1) | recurs)
            runs: dict[int, tuple[list, list]] = {}
            if len(live):
                whole = np.memmap(f, np.uint8 if size == 1 else np.uint64, "r")
                cut = n[live] + spec.window
                if cut.sum() < len(whole) // 2:
                    data = np.concatenate([whole[b:b + k] for b, k in zip(base[live].tolist(), cut.tolist())])
                    place_of = np.concatenate([[0], np.cumsum(cut)[:-1]])
                else:
                    data, place_of = whole, base[live]
                shard = Shard(data, place_of, n[live], np.stack([fid[live], fth[live], fstart[live]], 1))
                hit = repeated(shard)
                _, owner = shard.windows()
                first = np.concatenate([[0], np.cumsum(n[live])[:-1]])
                edge = np.flatnonzero(hit & np.concatenate([[True], ~hit[:-1] | (owner[1:] != owner[:-1])]))
                stop = np.flatnonzero(hit & np.concatenate([~hit[1:] | (owner[1:] != owner[:-1]), [True]]))
                for s, e in zip(edge.tolist(), stop.tolist()):
                    o, l = runs.setdefault(int(live[owner[s]]), ([], []))
                    o.append(s - int(first[owner[s]]))
                    l.append(e - s + 1)
        keep = np.array(sorted(runs), np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(key[keep]), pa.array(c[keep]), pa.array([runs[i][0] for i in keep.tolist()], pa.list_(pa.int32())),
             pa.array([runs[i][1] for i in keep.tolist()], pa.list_(pa.int32()))], ["key", "c", "offs", "lens"])
    return run


def repeated_ranges(documents: DataFrame, spec: Spec, repeated: Callable[[Shard], np.ndarray], *, by_text: bool,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored (id, th, ranges): the symbol ranges [from, to) covered by windows that also occur
    earlier.  ``by_text``: only in texts of smaller id; else also earlier in the same text."""
    spark = documents.sparkSession
    ship_package(spark)
    rows = identified(documents, id_col, text_col)
    texts = rows.count()
    often = (rows.mapInArrow(_frequent(spec), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
             .filter(F.col("n") >= max(8, HOT * texts)).select("key").toArrow())
    hot = spark.sparkContext.broadcast(often["key"].to_numpy().view(np.uint64))
    twice = rows.mapInArrow(_keys(spec, hot), "key long, n int").groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1")
    bitmap = spark.sparkContext.broadcast(make_bitmap(twice.select(F.col("key").alias("term")), FILTER_BITS))
    found = stage_table(rows.mapInArrow(_candidates(spec, hot, bitmap), STRETCH))
    firsts = found.groupBy("key", "c").agg(F.min(F.struct("id", "th", "start")).alias("f"), F.count(F.lit(1)).alias("seen"))
    half = found.select("c", F.explode(F.concat(F.array("before", "after"), "more")).alias("term")).filter("term != 0")
    half = half.groupBy("term").agg(F.min("c").alias("x"), F.max("c").alias("y")).filter("x != y")
    halves = spark.sparkContext.broadcast(make_bitmap(half.select("term"), FILTER_BITS))
    contents = (rows.mapInArrow(_contents(spec, hot, bitmap, halves), CONTENT).groupBy("key", "c").agg(
        F.min(F.struct("id", "th", "start")).alias("f"), F.max("n").alias("n"), F.max("recurs").alias("recurs"), F.max("content").alias("content")))
    contents = contents.select("key", "c", F.col("f.id").alias("fid"), F.col("f.th").alias("fth"), F.col("f.start").alias("fstart"), "n", "recurs", "content")
    parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    lost = contents.repartition(parts, "key").mapInArrow(_sharded(spec, repeated), SHARD_OUT)
    kept = firsts.join(lost, ["key", "c"], "left").filter("seen > 1 or offs is not null").select(
        "key", "c", F.coalesce("f.id", F.lit(LEAST_ID)).alias("fid"), F.col("f.th").alias("fth"), F.col("f.start").alias("fstart"), "offs", "lens")
    every = F.coalesce("id", F.lit(LEAST_ID))
    first = every == F.col("fid")
    if not by_text:
        first = first & (F.col("th") == F.col("fth")) & (F.col("start") == F.col("fstart"))
    runs = F.when(first, F.arrays_zip("offs", "lens")).otherwise(
        F.array(F.struct(F.lit(0).alias("offs"), F.col("n").cast("int").alias("lens"))))
    hits = (found.select("id", "th", "key", "c", "start", "n").join(kept, ["key", "c"])
            .select("id", "th", "start", F.explode(runs).alias("r"))
            .select("id", "th", F.struct((F.col("start") + F.col("r.offs")).alias("a"), (F.col("start") + F.col("r.offs") + F.col("r.lens") + (spec.window - 1)).alias("b")).alias("x")))
    ranges = stage_table(hits.groupBy("id", "th").agg(F.array_sort(F.collect_list("x")).alias("ranges"))
                         .select("id", "th", F.transform("ranges", lambda x: x["a"]).alias("froms"), F.transform("ranges", lambda x: x["b"]).alias("tos")))
    free(found)
    forget(hot, bitmap, halves)
    return ranges


def united(froms: np.ndarray, tos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint ranges from ranges sorted by start; touching ones are joined."""
    if not len(froms):
        return froms, tos
    reach = np.maximum.accumulate(tos)
    new = np.concatenate([[True], froms[1:] > reach[:-1]])
    at = np.flatnonzero(new)
    return froms[at], reach[np.concatenate([at[1:] - 1, [len(tos) - 1]])]


def apply_ranges(documents: DataFrame, ranges: DataFrame, make: Callable, schema: T.StructType | str, *,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``make(batches)`` over the rows of ``documents`` (all columns, then the lists __froms and
    __tos), for every row once.  Rows that have no ranges are not shuffled."""
    shared, rows, keys = marked(documents, ranges, id_col, text_col, FILTER_BITS)
    cols, none = [F.col(f"`{c}`") for c in documents.columns], F.array().cast("array<long>")
    rest = rows.mapInArrow(only_marked(shared, True), rows.schema).join(keys, ["__id", "__th"], "left")
    rest = rest.select(*cols, F.coalesce("froms", none).alias("__froms"), F.coalesce("tos", none).alias("__tos"))
    return rows.mapInArrow(_whole(shared, make), schema).unionAll(rest.mapInArrow(make, schema))


def _whole(shared, make: Callable):
    """``make`` over the rows that surely have no ranges, in the worker that reads them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()

        def plain() -> Iterator[pa.RecordBatch]:
            for batch in only_marked(shared, False)(batches):
                n, none = batch.num_rows, pa.array([], pa.int64())
                empty = pa.ListArray.from_arrays(pa.array(np.zeros(n + 1, np.int32)), none)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-3], empty, empty], [*batch.schema.names[:-3], "__froms", "__tos"])
        yield from make(plain())
    return run


def ranges_of(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray]:
    n = batch.num_columns
    f, t = batch.column(n - 2)[row].values, batch.column(n - 1)[row].values
    return united(f.to_numpy(zero_copy_only=False), t.to_numpy(zero_copy_only=False))
