"""N-gram Jaccard join by vertical partitioning.

A document's set holds the 64-bit hashes of its distinct word n-grams.  The global n-gram
order is the order of these hashes; it is cut into contiguous **fragments**.

* **Equal sets** collapse first (pre-aggregated by a 128-bit set signature): one vertex per
  distinct set, plus membership.  Copies are never expanded into pairs.
* **Candidates.**  Two sets of sizes a <= b that link have a symmetric difference of at most
  H = floor((1 - t) / (1 + t) * (a + b)) n-grams.  The order is cut into more than H fragments,
  and the hash of each fragment *with content* is a key; an empty fragment is none.  Proof: the
  difference touches at most H fragments, so if one of the two sets has content in more than H
  fragments, one of these is untouched, has the same content in the other set, and both write
  its key.  A set with content in at most H fragments is *thin* and also writes its first
  a - ceil(t * a) + 1 n-grams as keys: two thin sets that link share one of these (prefix
  filter).  ``Levels`` cuts as many spare fragments as make thin sets rare.  H depends on the
  size class; a set of class c writes keys for the levels c and c - 1, the only ones at which a
  link can be.  No n-gram frequency and no cap is needed.
* **Rarest keys.**  A set with content in f fragments of a level shares at least f - H of their
  keys with every set that it links with there, so by the prefix filter the two share one of
  the H + 1 rarest of each (by number of sets, ties by key).  The others go: a common passage is
  a key only of sets that have hardly any other, and groups are families, not neighbours by chance.
* **Screening.**  Most candidates share a fragment of one or two common n-grams and nothing else.
  Each set therefore has a sketch, the parities of its hashes in as many bits as it has n-grams:
  two sketches differ in no more bits than the sets in n-grams, so more than H bits prove that
  there is no link.  Only sketches, 1/64 of a set or 1/32, move for the pairs that fail.
* **Counting.**  Each other pair's overlap is counted per vertical fragment (``SEGMENTS`` of them)
  and the partial counts are summed per pair.
* **No all-pairs output.**  Within a key group only star pairs are tried first: the member
  with the most support (the likely original of a family) against the others.  Groups that
  the links found so far already join need nothing more.  Of the others, those of at most
  ``SMALL`` sets are tried pair by pair, no more than ``SMALL`` / 2 pairs a member.  Larger ones
  are screened block by block (``SCREEN`` sets a side), which leaves small clusters; these are
  checked block by block (``BLOCK`` sets a side): partial overlaps as one matrix per fragment,
  summed.  A block returns only the pairs that join parts not yet joined, never all its pairs.
* Components come from large-star/small-star on the links; each round's on the parts that the
  rounds before have joined.

Null, empty and word-free texts have an empty set and link with nothing.  Rows with equal ids
stay separate rows; ``component_id`` is the smallest id in the component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.components import connected_components
from ..session import forget, free, ship_package, stage_observed, stage_table
from .bitmap import LEAST_ID, drop_rows, identified, in_bitmap, make_bitmap, only_marked
from .textnum import Words, blocks, gram_hashes, mix, release, space_words

SEGMENTS = 8
BLOCK = 512
SCREEN = 2048
SMALL = 64


class Sets:
    """Distinct n-gram hashes of each text of a block, ascending inside a text."""

    def __init__(self, n: int):
        self.n, self.words = n, Words(space_words(), lower=True)

    def __call__(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(owner, hash) sorted by both, without repeats."""
        start, end, owner = self.words.bounds(buf, offs)
        h = self.words.hashes(buf, start, end)
        n, texts = self.n, len(offs) - 1
        count = np.bincount(owner, minlength=texts)
        g = gram_hashes(h, n)
        ok = owner[:len(g)] == owner[n - 1:] if len(g) else np.zeros(0, bool)
        tok, own = g[ok], owner[:len(g)][ok]
        short = np.flatnonzero((count > 0) & (count < n))  # fewer words: the whole sequence
        if len(short):
            first = np.concatenate([[0], np.cumsum(count)])
            whole = np.array([gram_hashes(h[first[d]:first[d + 1]], int(count[d]), 100 + int(count[d]))[0] for d in short], np.uint64)
            tok, own = np.concatenate([tok, whole]), np.concatenate([own, short])
        order = np.lexsort((tok, own))
        tok, own = tok[order], own[order]
        keep = np.ones(len(tok), bool)
        keep[1:] = (tok[1:] != tok[:-1]) | (own[1:] != own[:-1])
        return own[keep], tok[keep]


class Levels:
    """Size classes for similarity num / den: class c holds sizes up to ``high[c]``; a link
    joins sizes of one class or of neighbours.  At level c it has at most ``most[c]``
    differences, and the order is cut into ``cuts[c]`` fragments."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.high, self.most, self.cuts = [0], [0], [1]

    def _extend(self, size: int) -> None:
        while self.high[-1] < size:
            low = self.high[-1] + 1
            hi = low * self.den // self.num
            most = (self.den - self.num) * (hi + hi * self.den // self.num) // (self.den + self.num)
            empty = (most + 1) * math.exp(-low / (most + 1))  # to be expected among most + 1
            self.high.append(hi)
            self.most.append(most)
            self.cuts.append(most + 1 + (min(most + 1, math.ceil(empty + 4 * math.sqrt(empty))) if most else 0))

    def of(self, size: np.ndarray) -> np.ndarray:
        self._extend(int(size.max()) + 1 if len(size) else 1)
        return np.searchsorted(np.array(self.high), size, "left")

    def keys(self, own: np.ndarray, tok: np.ndarray, size: np.ndarray, ranked: bool = False) -> tuple[np.ndarray, ...]:
        """(set, key) of the keys of all sets; ``ranked`` adds the kind of each key (0 and 1:
        fragments of the two levels, 2: n-grams) and how many of the set's rarest keys of that
        kind are enough."""
        cls = self.of(size)
        most, cuts = np.array(self.most), np.array(self.cuts)
        first = np.concatenate([[0], np.cumsum(size)])
        head = size - -(-size * self.num // self.den) + 1
        who, keys, kinds, rooms = [], [], [], []
        for lower in (0, 1):
            level = np.maximum(cls - lower, 0)
            live = most[level] > 0  # without differences: equal sets only
            use = live[own]
            o, t = own[use], tok[use]
            if not len(o):
                continue
            salt = mix((level.astype(np.uint64) << np.uint64(32)) + np.uint64(1))
            frag = ((t >> np.uint64(32)) * cuts[level][o].astype(np.uint64)) >> np.uint64(32)
            at = np.flatnonzero(np.concatenate([[True], (o[1:] != o[:-1]) | (frag[1:] != frag[:-1])]))
            holder = o[at]
            who.append(holder)
            keys.append(mix(np.add.reduceat(mix(t ^ np.uint64(5)), at) + mix(salt[holder] + frag[at])))
            thin = live & (np.bincount(holder, minlength=len(size)) <= most[level])
            place = np.arange(len(tok)) - first[own]
            pick = thin[own] & (place < head[own])
            who.append(own[pick])
            keys.append(mix(tok[pick] + mix(salt[own[pick]] ^ np.uint64(9))))
            kinds += [np.full(len(holder), lower), np.full(len(who[-1]), 2)]
            rooms += [most[level][holder] + 1, np.full(len(who[-1]), 1 << 40)]
        if not who:
            return (np.zeros(0, np.int64), np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 2)[:2 + 2 * ranked]
        return tuple(np.concatenate(x) for x in (who, keys, kinds, rooms)[:2 + 2 * ranked])


def _signed(n: int):
    """Size and signature of each text's set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        sets = Sets(n)
        for batch in batches:
            ids, th = batch.column(0), batch.column(1)
            for lo, hi, buf, offs in blocks(batch):
                own, tok = sets(buf, offs)
                size = np.bincount(own, minlength=hi - lo)
                sigs = _sums(tok, np.concatenate([[0], np.cumsum(size)]), (3, 4))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), th.slice(lo, hi - lo), pa.array(size.astype(np.int64)), pa.array(sigs[0].view(np.int64)), pa.array(sigs[1].view(np.int64))],
                    ["id", "th", "n", "s1", "s2"])
    return run


def _keyed(n: int, num: int, den: int, shared=None):
    """(key, s1) of every set.  With a bitmap of the keys of several sets: (key, s1, s2, kind,
    room) of those that may be in it; ``room`` is what the set's other keys, which are rarer,
    leave of the number that is enough, and keys without any go."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        sets, levels = Sets(n), Levels(num, den)
        for batch in batches:
            for lo, hi, buf, offs in blocks(batch):
                own, tok = sets(buf, offs)
                size = np.bincount(own, minlength=hi - lo)
                sigs = _sums(tok, np.concatenate([[0], np.cumsum(size)]), (3, 4))
                if shared is None:
                    who, key = levels.keys(own, tok, size)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(sigs[0].view(np.int64)[who])], ["key", "s1"])
                    continue
                who, key, kind, room = levels.keys(own, tok, size, ranked=True)
                hit = in_bitmap(shared.value, key)
                cell = who * 3 + kind
                room = np.where(kind < 2, room - np.bincount(cell[~hit], minlength=3 * (hi - lo))[cell], room)
                hit &= room > 0
                who = who[hit]
                cols = [key[hit].view(np.int64), sigs[0].view(np.int64)[who], sigs[1].view(np.int64)[who], kind[hit].astype(np.int32), room[hit]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], ["key", "s1", "s2", "kind", "room"])
    return run


def _sums(tok: np.ndarray, first: np.ndarray, salts) -> list[np.ndarray]:
    """Order-free hashes of each text's set."""
    out = []
    for salt in salts:
        m = np.concatenate([mix(tok * np.uint64(2 * salt + 1) + np.uint64(salt)), np.zeros(1, np.uint64)])
        s = np.add.reduceat(m, first[:-1]) if len(first) > 1 else np.zeros(0, np.uint64)
        s[np.diff(first) == 0] = 0
        out.append(mix(s))
    return out


def _sketch(tok: np.ndarray) -> bytes:
    """Parities of the hashes of one set, in the next power of two of its size (64 bits at least)."""
    m = 1 << max(6, (len(tok) - 1).bit_length())
    odd = np.bincount((tok & np.uint64(m - 1)).astype(np.int64), minlength=m) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _folded(words: np.ndarray, width: int) -> np.ndarray:
    """Sketches (a row each) in fewer words: the parities of the hashes in so many bits."""
    while words.shape[1] > width:
        half = words.shape[1] // 2
        words = words[:, :half] ^ words[:, half:]
    return words


def _differing(left: pd.Series, right: pd.Series) -> pd.Series:
    """Bits in which the sketches of each pair differ, at the smaller one's width."""
    out = np.zeros(len(left), np.int64)
    wide = left.str.len().to_numpy(), right.str.len().to_numpy()
    for a, b in set(zip(*wide)):
        at = np.flatnonzero((wide[0] == a) & (wide[1] == b))
        x, y = (_folded(np.frombuffer(b"".join(s.iloc[at]), np.uint64).reshape(len(at), -1), min(a, b) // 8) for s in (left, right))
        out[at] = np.bitwise_count(x ^ y).sum(axis=1)
    return pd.Series(out)


def _screened(num: int, den: int):
    """applyInPandas over one pair of blocks: pairs that may be links, as many as join what they join."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates(["vid", "side"])
        vids, name = np.unique(pdf.vid.to_numpy(), return_inverse=True)
        part, side, width = np.arange(len(vids)), pdf.side.to_numpy(), pdf.sketch.str.len().to_numpy()
        size, comp = pdf.n.to_numpy(), pdf.comp.to_numpy()
        out = []
        for a in np.unique(width[side == 0]):
            for b in np.unique(width[side == 1]):
                left, right = np.flatnonzero((side == 0) & (width == a)), np.flatnonzero((side == 1) & (width == b))
                if max(size[left].min(), size[right].min()) * num > min(size[left].max(), size[right].max()) * den:
                    continue
                x, y = (_folded(np.frombuffer(b"".join(pdf.sketch.iloc[at]), np.uint64).reshape(len(at), -1), min(a, b) // 8)
                        for at in (left, right))
                for s in range(0, len(left), 64):
                    some = left[s:s + 64]
                    bits = np.zeros((len(some), len(right)), np.int64)
                    for w in range(x.shape[1]):
                        bits += np.bitwise_count(x[s:s + 64, w, None] ^ y[None, :, w])
                    both = size[some][:, None] + size[right][None, :]
                    ok = (bits * (den + num) <= both * (den - num)) & (comp[some][:, None] != comp[right][None, :])
                    for i in np.flatnonzero(ok.any(axis=1)):
                        me, others = name[some[i]], name[right[ok[i]]]
                        for p, j in zip(*np.unique(part[others], return_index=True)):
                            if p != part[me]:
                                part[part == p] = part[me]
                                out.append((vids[me], vids[others[j]]))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")
    return run


def _tokens(shared, n: int):
    """The sets of the texts whose signature is in the bitmap, cut into vertical segments, and
    their sketches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        sets, bitmap = Sets(n), shared.value
        for batch in batches:
            for lo, hi, buf, offs in blocks(batch):
                own, tok = sets(buf, offs)
                first = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=hi - lo))])
                s1, s2 = _sums(tok, first, (3, 4))
                want = np.flatnonzero((np.diff(first) > 0) & in_bitmap(bitmap, s1))
                seg = (tok >> np.uint64(32)) * np.uint64(SEGMENTS) >> np.uint64(32)
                cells, rows, sketches = [], [], []
                for d in want:
                    t = tok[first[d]:first[d + 1]].view(np.int64)
                    sketches.append(_sketch(tok[first[d]:first[d + 1]]))
                    cut = np.searchsorted(seg[first[d]:first[d + 1]], np.arange(SEGMENTS + 1))
                    rows.append([t[a:b] for a, b in zip(cut[:-1], cut[1:])])
                    cells.append(d)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s1[cells].view(np.int64)), pa.array(s2[cells].view(np.int64)),
                     pa.array([[x.tolist() for x in r] for r in rows], pa.list_(pa.list_(pa.int64()))), pa.array(sketches, pa.binary())],
                    ["s1", "s2", "segments", "sketch"])
    return run


def _joined(num: int, den: int):
    """applyInPandas over one pair of blocks: the parts not yet joined that links join."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates(["vid", "side"])
        left, right = pdf[pdf.side == 0].reset_index(drop=True), pdf[pdf.side == 1].reset_index(drop=True)
        overlap = np.zeros((len(left), len(right)), np.int64)
        for g in range(SEGMENTS):
            a, b = [s[g] for s in left.segments], [s[g] for s in right.segments]
            la, lb = [len(x) for x in a], [len(x) for x in b]
            if not sum(la) or not sum(lb):
                continue
            ta, tb = np.concatenate(a), np.concatenate(b)
            voc = np.intersect1d(ta, tb)
            ra, rb = np.repeat(np.arange(len(a)), la), np.repeat(np.arange(len(b)), lb)
            for s in range(0, len(voc), 4096):  # partial overlaps, a slice of the order at a time
                part = voc[s:s + 4096]
                m = []
                for t, r, k in ((ta, ra, len(a)), (tb, rb, len(b))):
                    i = np.minimum(np.searchsorted(part, t), len(part) - 1)
                    hit = part[i] == t
                    x = np.zeros((k, len(part)), np.float32)
                    x[r[hit], i[hit]] = 1
                    m.append(x)
                overlap += (m[0] @ m[1].T).astype(np.int64)
        union = left.n.to_numpy()[:, None] + right.n.to_numpy()[None, :] - overlap
        ia, ib = np.nonzero(den * overlap >= num * union)
        part: dict = {}

        def root(x):
            while part.setdefault(x, x) != x:
                part[x] = x = part[part[x]]
            return x
        out = []
        ca, cb = left.comp.tolist(), right.comp.tolist()
        for i, j in zip(ia.tolist(), ib.tolist()):
            x, y = root(ca[i]), root(cb[j])
            if x != y:
                part[x] = y
                out.append((ca[i], cb[j]))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")
    return run


def _possible(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The candidate pairs (a, b, ca, cb) whose sketches do not rule a link out."""
    bits = F.pandas_udf(_differing, "long")
    l = sets.select(F.col("vid").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("x"))
    r = sets.select(F.col("vid").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("y"))
    both = pairs.join(l, "a").join(r, "b").withColumn("bits", bits("x", "y"))
    return both.filter(F.col("bits") * (den + num) <= (F.col("na") + F.col("nb")) * (den - num)).select("a", "b", "ca", "cb")


def _among(sets: DataFrame, vids: DataFrame, used: list) -> DataFrame:
    """The sets of ``vids`` (and few others): a bitmap keeps the rest out of the shuffles.  Its
    broadcast is added to ``used``."""
    shared = sets.sparkSession.sparkContext.broadcast(make_bitmap(vids.select(F.xxhash64("vid").alias("term"))))
    used.append(shared)
    rows = sets.withColumn("__mark", F.xxhash64("vid"))
    return rows.mapInArrow(only_marked(shared, True), rows.schema).drop("__mark")


def _blocks(rest: DataFrame, block: int) -> DataFrame:
    """(cluster, i, j, side, vid, n, comp): the members of each cluster in blocks, each pair of blocks once."""
    sized = rest.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
    rest = rest.join(sized, "cluster").withColumn("part", F.pmod(F.xxhash64("vid"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("o")
    sides = rest.select("*", other).select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
    i = F.when(F.col("side") == 0, F.col("part")).otherwise(F.col("o"))
    j = F.when(F.col("side") == 0, F.col("o")).otherwise(F.col("part"))
    return sides.withColumns({"i": i, "j": j}).filter(F.col("i") <= F.col("j")).select("cluster", "i", "j", "side", "vid", "n", "comp")


def _clusters(edges: DataFrame) -> DataFrame:
    return connected_components(edges).select(F.col("id").alias("vid"), F.col("component").alias("cluster"))


def _counted(pairs: DataFrame, sets: DataFrame, num: int, den: int, used: list) -> DataFrame:
    """The parts (a, b) that links among the candidate pairs join: partial overlaps per fragment,
    summed per pair."""
    cut = _among(sets, pairs.select(F.explode(F.array("a", "b")).alias("vid")), used).select("vid", "n", F.posexplode("segments").alias("seg", "t"))
    l = cut.select(F.col("vid").alias("a"), F.col("n").alias("na"), "seg", F.col("t").alias("ta"))
    r = cut.select(F.col("vid").alias("b"), F.col("n").alias("nb"), "seg", F.col("t").alias("tb"))
    part = pairs.join(l, "a").join(r, ["b", "seg"]).select("a", "b", "ca", "cb", "na", "nb", F.size(F.array_intersect("ta", "tb")).alias("c"))
    total = part.groupBy("a", "b", "ca", "cb", "na", "nb").agg(F.sum("c").alias("c"))
    linked = total.filter(den * F.col("c") >= num * (F.col("na") + F.col("nb") - F.col("c")))
    return linked.select(F.col("ca").alias("a"), F.col("cb").alias("b"))


def _relabelled(m: DataFrame, joins: DataFrame) -> DataFrame:
    """``m`` with the smallest label of the parts that ``joins`` joins in the column comp."""
    now = connected_components(joins).select(F.col("id").alias("comp"), F.col("component").alias("now"))
    return m.join(now, "comp", "left").withColumn("comp", F.coalesce("now", "comp")).drop("now")


def _open(members: DataFrame) -> DataFrame:
    """The groups (key) with parts not yet joined."""
    return members.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.min("vid").alias("anchor")).filter("x != y").select("key", "anchor")


def _star_pairs(members: DataFrame, tried: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """The best supported member not yet tried of each open group against the rest, and these members."""
    left = members.join(tried, (members["key"] == tried["key"]) & (members["vid"] == tried["hub"]), "left_anti")
    hub = (left.join(_open(members), "key").groupBy("key").agg(F.max(F.struct("support", (-F.col("vid")).alias("v"), "comp", "n")).alias("h"))
           .select("key", (-F.col("h.v")).alias("hub"), F.col("h.comp").alias("hc"), F.col("h.n").alias("hn")))
    near = (F.greatest("n", "hn") * num) <= (F.least("n", "hn") * den)
    pairs = members.join(hub, "key").filter((F.col("comp") != F.col("hc")) & near)
    return pairs.select(F.col("hub").alias("a"), F.col("vid").alias("b"), F.col("hc").alias("ca"), F.col("comp").alias("cb")).distinct(), hub.select("key", "hub")


def _small_pairs(members: DataFrame, num: int, den: int) -> DataFrame:
    """All pairs of parts not yet joined within each open group of at most ``SMALL`` sets."""
    few = members.filter(F.col("members") <= SMALL).join(_open(members).select("key"), "key").select("key", "vid", "n", "comp")
    other = few.select("key", F.col("vid").alias("b"), F.col("n").alias("nb"), F.col("comp").alias("cb"))
    near = (F.greatest("n", "nb") * num) <= (F.least("n", "nb") * den)
    pairs = few.join(other, "key").filter((F.col("vid") < F.col("b")) & (F.col("comp") != F.col("cb")) & near)
    return pairs.select(F.col("vid").alias("a"), "b", F.col("comp").alias("ca"), "cb").distinct()


def components(documents: DataFrame, *, n: int = 3, num: int = 90, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, n, component, component_id) of every row: text hash, size of the set, a label
    that the rows of a component share (null for empty sets) and its smallest id.  Documents
    link when den * |A and B| >= num * |A or B|."""
    spark = documents.sparkSession
    ship_package(spark)
    text = identified(documents, id_col, text_col)
    rows = stage_table(text.mapInArrow(_signed(n), "id long, th long, n long, s1 long, s2 long").withColumn("uid", F.monotonically_increasing_id()))
    vertex = stage_table(rows.filter("n > 0").groupBy("s1", "s2", "n").agg(F.min("uid").alias("vid"), F.min("id").alias("first_id")))
    # keys of several sets; the bitmap keeps all others out of the second shuffle
    several = stage_table(text.mapInArrow(_keyed(n, num, den), "key long, s1 long").groupBy("key")
                          .agg(F.min("s1").alias("x"), F.max("s1").alias("y")).filter("x != y").select("key"))
    few = spark.sparkContext.broadcast(make_bitmap(several.select(F.col("key").alias("term"))))
    holders = text.mapInArrow(_keyed(n, num, den, few), "key long, s1 long, s2 long, kind int, room long").distinct().join(several, "key", "left_semi")
    holders = stage_table(holders.join(vertex.select("s1", "s2", "vid", "n"), ["s1", "s2"]).select("key", "vid", "n", "kind", "room"))
    free(several)
    forget(few)
    # of each set and kind its rarest keys, as many as are enough
    shared = holders.groupBy("key").agg(F.count(F.lit(1)).alias("members"))
    rarest = F.row_number().over(Window.partitionBy("vid", "kind").orderBy("members", "key"))
    grouped = stage_table(holders.join(shared, "key").withColumn("rank", rarest).filter("rank <= room and members > 1").select("key", "vid", "n"))
    shared = grouped.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    support = F.sum("members").over(Window.partitionBy("vid"))
    members = stage_table(grouped.join(shared, "key").withColumns({"support": support, "comp": F.col("vid")}))
    free(holders, grouped)

    want = members.select("vid").distinct().join(vertex, "vid")
    shared_sigs = spark.sparkContext.broadcast(make_bitmap(want.select(F.col("s1").alias("term"))))
    sets = (text.mapInArrow(_tokens(shared_sigs, n), "s1 long, s2 long, segments array<array<long>>, sketch binary")
            .groupBy("s1", "s2").agg(F.first(F.struct("segments", "sketch")).alias("set")))
    sets = stage_table(want.select("vid", "n", "s1", "s2").join(sets, ["s1", "s2"]).select("vid", "n", "set.segments", "set.sketch"))
    forget(shared_sigs)

    # star pairs of all groups, then all pairs of small ones
    done, used = [], []  # ``tried`` still reads the members of the round before
    tried = members.limit(0).select("key", F.col("vid").alias("hub"))
    for small in (False, False, True):
        if small:
            pairs = _small_pairs(members, num, den)
        else:
            pairs, tried = _star_pairs(members, tried, num, den)
        pairs, some = stage_observed(_possible(pairs, sets, num, den), F.count(F.lit(1)).alias("n"))
        if some["n"]:
            joins = stage_table(_counted(pairs, sets, num, den, used))
            done.append(members)
            members = stage_table(_relabelled(members, joins))
            free(joins)
        free(pairs)
    free(*done)

    # larger groups still in parts: clusters of them, block against block
    rest, some = stage_observed(members.filter(F.col("members") > SMALL).join(_open(members), "key").select("vid", "n", "comp", "anchor").distinct(),
                                F.count(F.lit(1)).alias("n"))
    comp = members.select("vid", "comp").distinct()
    if some["n"]:
        parts = rest.select("vid", "n", "comp").distinct()
        screen = _blocks(parts.join(_clusters(rest.select(F.col("vid").alias("a"), F.col("anchor").alias("b"))), "vid"), SCREEN)
        maybe = stage_table(screen.join(sets.select("vid", "sketch"), "vid").groupBy("cluster", "i", "j")
                            .applyInPandas(_screened(num, den), "a long, b long"))
        block = stage_table(_blocks(parts.join(_clusters(maybe), "vid"), BLOCK))
        joins = stage_table(block.join(_among(sets, block.select("vid"), used).select("vid", "segments"), "vid").groupBy("cluster", "i", "j")
                            .applyInPandas(_joined(num, den), "a long, b long"))
        free(maybe, block)
        comp = _relabelled(comp, joins)
    free(sets, rest)
    forget(*used)

    whole = vertex.join(comp.select("vid", F.col("comp").alias("component")), "vid", "left").withColumn("component", F.coalesce("component", "vid"))
    named = whole.join(whole.groupBy("component").agg(F.min("first_id").alias("component_id")), "component").select("s1", "s2", F.col("n").alias("size"), "component", "component_id")
    full = rows.select("id", "th", "n", "s1", "s2")
    out = full.join(named, (full["s1"] == named["s1"]) & (full["s2"] == named["s2"]) & (full["n"] == named["size"]), "left")
    return out.select("id", "th", "n", "component", F.coalesce("component_id", "id").alias("component_id"))


def jaccard_components(documents: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles, component_id of every row; options as in ``components``."""
    return components(documents, **options).select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


def drop_near_duplicates(documents: DataFrame, **options) -> DataFrame:
    """``documents``, all columns, with one row of each component: the one of smallest id (null
    ids first; ties by text hash).  Rows with an empty set all stay."""
    ids = {k: v for k, v in options.items() if k in ("id_col", "text_col")}
    rows = stage_table(components(documents, **options).filter("component is not null")
                       .select("id", "th", "component", F.struct(F.coalesce("id", F.lit(LEAST_ID)).alias("i"), "th").alias("name")))
    first = rows.groupBy("component").agg(F.min("name").alias("first"), F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    named = rows.join(first, "component").select("id", "th", (F.col("name") == F.col("first")).alias("keep")).distinct()
    return drop_rows(documents, stage_table(named), **ids)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
