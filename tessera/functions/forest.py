"""Random forests of full-depth trees, grown and scored in tasks.

``pyspark.ml`` grows all trees of a forest on the driver, node by node: its memory grows with the
nodes of the forest (rows times trees), and every level is a job.  Here only the cut points (at most
``BINS`` - 1 doubles a feature) and one importance vector a tree reach the driver.

* **Cut points** as in ``pyspark.ml``: midpoints between all values of a feature with at most
  ``BINS`` of them, else between values about equally many rows apart; from summaries of
  ``SUMMARY`` values a partition.
* **Rows** become one byte a feature, in blocks, written once.  Every growing task reads all blocks and
  grows some of the trees of all forests of the call, one after the other: level by level, class
  counts per (node, feature, bin), a seeded choice of ceil(sqrt(features)) features a node, Gini gain,
  Poisson(1) weights from a hash of (seed, tree, row), children of one prediction merged.  A
  task holds features + 1 bytes a row, and about 30 bytes for each row of the tree that it grows.
* **Scores** are the mean of the trees' leaf shares, summed as integers (2^-40 units), so that they do
  not depend on the order of the tasks.  Held rows of a forest are scored where its trees grow;
  other rows in groups, through which the trees are streamed.

Missing values (null or NaN) go right of every cut.  Labels are 0 and 1.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import free, ship_package, stage_table
from .kinds import q

BINS = 32
SUMMARY = 4096
UNIT = 1 << 40  # of scores
CELLS = 1 << 21  # class counts held at a time
ROWS = 1 << 20  # rows counted at a time
GROUP_VALUES = 1 << 24  # scores held by a task
NO_PART = 255
#: cumulative Poisson(1) probabilities, up to the 12th
POISSON = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1, k + 1), dtype=float) for k in range(13)])


class Grown(NamedTuple):
    """A forest to grow: places of its features, and the part of the rows that it does not see
    but scores (``NO_PART``: none)."""

    features: tuple[int, ...]
    held: int = NO_PART


# ----------------------------------------------------------------------------- cut points
def _summary(v: np.ndarray, w: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, ascending, and their weights; of more than ``most``, the values at evenly
    spaced ranks."""
    v, at = np.unique(v, return_inverse=True)
    w = np.bincount(at, w, len(v)).astype(np.int64)
    if len(v) > most:
        c = np.cumsum(w)
        pick = np.unique(np.searchsorted(c, np.linspace(0, c[-1], most)[1:], "left").clip(max=len(v) - 1))
        w = np.diff(np.concatenate([[0], c[pick]]))
        v = v[pick]
    return v, w


def _summaries(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.zeros(0), np.zeros(0, np.int64))] * width
        for batch in batches:
            X = _matrix(batch.column(0), width)
            for j in range(width):
                x = X[:, j][~np.isnan(X[:, j])] + 0.0  # no negative zero
                v, w = held[j]
                held[j] = _summary(np.concatenate([v, x]), np.concatenate([w, np.ones(len(x), np.int64)]), 4 * SUMMARY)
        held = [_summary(v, w, SUMMARY) for v, w in held]
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([v.tolist() for v, _ in held], pa.list_(pa.float64())),
                                          pa.array([w.tolist() for _, w in held], pa.list_(pa.int64()))], ["f", "v", "w"])
    return run


def _cuts(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Cut points of a feature from its values and their weights."""
    between = (v[:-1] + v[1:]) / 2
    if len(between) < BINS:
        return between
    done = np.cumsum(w).tolist()
    stride = target = done[-1] / BINS
    out = []
    for i in range(1, len(v)):
        if abs(done[i - 1] - target) < abs(done[i] - target):
            out.append(between[i - 1])
            target += stride
    return np.array(out[:BINS - 1])


def _merged(pdf: pd.DataFrame) -> pd.DataFrame:
    v, w = _summary(np.concatenate(pdf["v"].tolist()), np.concatenate(pdf["w"].tolist()), 1 << 62)
    return pd.DataFrame({"f": pdf["f"].iloc[:1].to_numpy(), "cuts": [_cuts(v, w).tolist() if len(v) else []]})


def _matrix(col: pa.Array, width: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), width)


def vector(features: Sequence[str]) -> Column:
    """The features as an array of doubles, nulls as NaN."""
    return F.array(*[F.coalesce(q(c).cast("double"), F.lit(float("nan"))) for c in features])


def cut_points(rows: DataFrame, width: int) -> list[np.ndarray]:
    """Cut points of each place of the array column ``x``."""
    got = rows.select("x").mapInArrow(_summaries(width), "f int, v array<double>, w array<long>").groupBy("f").applyInPandas(_merged, "f int, cuts array<double>").collect()
    cuts = {r["f"]: np.array(r["cuts"], float) for r in got}
    return [cuts.get(j, np.zeros(0)) for j in range(width)]


def binned(X: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """A row of bytes a feature: how many cut points lie below each value."""
    return np.stack([np.searchsorted(c, X[:, j], "left") for j, c in enumerate(cuts)]).astype(np.uint8) if len(cuts) else np.zeros((0, len(X)), np.uint8)


# ----------------------------------------------------------------------------- one tree
class Tree(NamedTuple):
    feature: np.ndarray  # -1: leaf
    bin: np.ndarray  # up to this bin: left
    left: np.ndarray  # its right sister is the next node
    share: np.ndarray  # of class 1, in UNIT

    def pack(self) -> bytes:
        head = np.array([len(self.feature)], np.int64).tobytes()
        return zlib.compress(head + b"".join(x.astype(t).tobytes() for x, t in zip(self, _TYPES)), 1)

    @staticmethod
    def unpack(data: bytes) -> Tree:
        raw = zlib.decompress(data)
        n, at, out = int(np.frombuffer(raw, np.int64, 1)[0]), 8, []
        for t in _TYPES:
            out.append(np.frombuffer(raw, t, n, at))
            at += n * np.dtype(t).itemsize
        return Tree(*out)

    def scores(self, X: np.ndarray) -> np.ndarray:
        """The leaf share of each column of ``X`` (a row a feature)."""
        out = np.empty(X.shape[1], np.int64)
        for s in range(0, X.shape[1], ROWS):
            rows = np.arange(s, min(s + ROWS, X.shape[1]))
            node = np.zeros(len(rows), np.int64)
            while len(rows):
                f = self.feature[node]
                live = f >= 0
                if not live.all():
                    out[rows[~live]] = self.share[node[~live]]
                    rows, node, f = rows[live], node[live], f[live]
                node = self.left[node] + (X[f, rows] > self.bin[node])
        return out


_TYPES = (np.int32, np.uint8, np.int64, np.int64)


def bag(row: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is drawn: Poisson(1) from a hash."""
    with np.errstate(over="ignore"):
        h = row.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (tree + 1) + 0xD1B54A32D192ED03 * (seed + 1)) % (1 << 64))
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(by)
        h ^= h >> np.uint64(31)
    return np.searchsorted(POISSON, (h >> np.uint64(11)).astype(np.float64) / (1 << 53), "right").astype(np.uint8)


def _best(X, y, w, rows, start, feats, n0, n1, min_leaf):
    """(gain, place among its features, bin) of the best split of each node; ``rows`` are sorted by
    node, those of node i begin at ``start[i]``.  Gain 0: none."""
    k, m = feats.shape
    hist = np.zeros(k * m * BINS * 2)
    node = np.repeat(np.arange(k), np.diff(start))
    step = max(1, ROWS // m)
    for s in range(0, len(rows), step):
        r, at = rows[s:s + step], node[s:s + step]
        cell = ((at * m + np.arange(m)[:, None]) * BINS + X[feats[at].T, r]) * 2 + y[r]
        hist += np.bincount(cell.ravel(), np.tile(w[r].astype(float), m), len(hist))
    left = hist.reshape(k, m, BINS, 2).cumsum(2)
    l0, l1 = left[..., 0], left[..., 1]
    t0, t1 = n0[:, None, None], n1[:, None, None]
    nl, n = l0 + l1, t0 + t1
    nr = n - nl
    ok = (nl >= min_leaf) & (nr >= min_leaf) & (nl > 0) & (nr > 0) & (l1 * n != t1 * nl)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = ((l0 * l0 + l1 * l1) / nl + ((t0 - l0) ** 2 + (t1 - l1) ** 2) / nr) / n - (t0 * t0 + t1 * t1) / (n * n)
    gain = np.where(ok, gain, 0.0).reshape(k, -1)
    best = gain.argmax(1)
    return gain[np.arange(k), best], best // BINS, best % BINS


def _drawn(rng: np.random.Generator, nodes: int, width: int, pick: int) -> np.ndarray:
    """``pick`` of ``width`` places for each node, by a reservoir; of equal gains the first place wins, as
    in ``pyspark.ml``."""
    out = np.tile(np.arange(pick), (nodes, 1))
    for i in range(pick, width):
        at = (rng.random(nodes) * (i + 1)).astype(np.int64)
        hit = np.flatnonzero(at < pick)
        out[hit, at[hit]] = i
    return out


def grow(X: np.ndarray, y: np.ndarray, w: np.ndarray, features: Sequence[int], rng: np.random.Generator,
         pick: int, max_depth: int, min_leaf: int) -> tuple[Tree, np.ndarray]:
    """A tree over the columns of ``X`` with a weight, and its importances (a place a feature of
    ``features``; they sum to 1, or are 0 without a split)."""
    features = np.asarray(features, np.int64)
    rows = np.flatnonzero(w).astype(np.int64)
    size = np.array([len(rows)])
    n1 = np.array([float(w[rows][y[rows] == 1].sum(dtype=np.int64))])
    n0 = np.array([float(w[rows].sum(dtype=np.int64))]) - n1
    cols: list[list[np.ndarray]] = [[], [], [], [], [], []]  # place of the feature, bin, left, n0, n1, gain: a level each
    born, depth = 1, 0
    while len(size):
        k = len(size)
        place, cut, gain = np.full(k, -1), np.zeros(k, np.int64), np.zeros(k)
        start = np.concatenate([[0], np.cumsum(size)])
        can = np.flatnonzero((n0 > 0) & (n1 > 0)) if depth < max_depth and len(features) else np.zeros(0, np.int64)
        step = max(1, CELLS // (pick * BINS * 2))
        for s in range(0, len(can), step):
            some = can[s:s + step]
            held = np.concatenate([[0], np.cumsum(size[some])])
            mine = rows[np.repeat(start[some] - held[:-1], size[some]) + np.arange(held[-1])]
            drawn = _drawn(rng, len(some), len(features), pick)
            g, j, b = _best(X, y, w, mine, held, features[drawn], n0[some], n1[some], min_leaf)
            hit = g > 0
            place[some[hit]], cut[some[hit]], gain[some[hit]] = drawn[np.arange(len(some)), j][hit], b[hit], g[hit]
        split = np.flatnonzero(place >= 0)
        left = np.zeros(k, np.int64)
        left[split] = born + 2 * np.arange(len(split))
        born += 2 * len(split)
        for c, v in zip(cols, (place, cut, left, n0, n1, gain)):
            c.append(v)
        # the rows of split nodes by child, in their order
        held = np.concatenate([[0], np.cumsum(size[split])])
        rows = rows[np.repeat(start[split] - held[:-1], size[split]) + np.arange(held[-1])]
        node = np.repeat(np.arange(len(split)), size[split])
        child = 2 * node + (X[features[place[split]][node], rows] > cut[split][node])
        rows = rows[np.argsort(child, kind="stable")]
        size = np.bincount(child, minlength=2 * len(split))
        child.sort()
        yw = w[rows].astype(float)
        n1 = np.bincount(child, yw * y[rows], 2 * len(split))
        n0 = np.bincount(child, yw, 2 * len(split)) - n1
        depth += 1
    level = np.concatenate([[0], np.cumsum([len(x) for x in cols[0]])])
    place, cut, left, n0, n1, gain = (np.concatenate(c) for c in cols)
    for a, b in zip(level[-3::-1], level[-2:0:-1]):  # children of one prediction are merged
        at = np.arange(a, b)[place[a:b] >= 0]
        lo = left[at]
        same = (place[lo] < 0) & (place[lo + 1] < 0) & ((n1[lo] > n0[lo]) == (n1[lo + 1] > n0[lo + 1]))
        place[at[same]] = -1
    inner = place >= 0
    importance = np.bincount(place[inner], (gain * (n0 + n1))[inner], len(features))
    importance = importance / (importance.sum() or 1.0)
    alive = np.zeros(len(place), bool)
    alive[0] = True
    for a, b in zip(level[:-1], level[1:]):
        lo = left[a:b][alive[a:b] & inner[a:b]]
        alive[lo] = alive[lo + 1] = True
    name = np.cumsum(alive) - 1
    inner = inner[alive]
    share = np.rint(n1[alive] / np.maximum(n0[alive] + n1[alive], 1.0) * UNIT).astype(np.int64)
    feature = np.full(len(inner), -1)
    feature[inner] = features[place[alive][inner]]
    where = np.zeros(len(inner), np.int64)
    where[inner] = name[left[alive][inner]]
    return Tree(feature, np.where(inner, cut[alive], 0), where, np.where(inner, 0, share)), importance


# ----------------------------------------------------------------------------- jobs
def _blocks(cuts: Sequence[np.ndarray], width: int):
    """Blocks (block, n, x, y, part) of the rows (x, y, part)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            if not batch.num_rows:
                continue
            x = binned(_matrix(batch.column(0), width), cuts)
            y, part = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.uint8) for i in (1, 2))
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([batch.num_rows], pa.int64()), pa.array([x.tobytes()], pa.binary()),
                                              pa.array([y.tobytes()], pa.binary()), pa.array([part.tobytes()], pa.binary())], ["block", "n", "x", "y", "part"])
            block += 1
    return run


BLOCK_SCHEMA = "block long, n long, x binary, y binary, part binary"
TREE_SCHEMA = "forest int, tree int, block long, importance array<double>, data binary, y binary"


def _bytes(x) -> np.ndarray:
    return np.frombuffer(x.as_buffer() if x.is_valid else b"", np.uint8)


def _growing(width: int, forests: Sequence[Grown], trees: int, tasks: int, seed: int, max_depth: int, min_leaf: int, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, blocks = -1, []
        for batch in batches:
            for i in range(batch.num_rows):
                task = batch.column(0)[i].as_py()
                blocks.append((batch.column(1)[i].as_py(), *[_bytes(batch.column(c)[i]) for c in (3, 4, 5)]))
        if not blocks:
            return
        blocks.sort(key=lambda b: b[0])
        first = np.concatenate([[0], np.cumsum([len(b[2]) for b in blocks])])
        X = np.empty((width, first[-1]), np.uint8)
        row = np.empty(first[-1], np.int64)
        y, part = np.concatenate([b[2] for b in blocks]), np.concatenate([b[3] for b in blocks])
        for (name, x, _, _), a, b in zip(blocks, first[:-1], first[1:]):
            X[:, a:b] = x.reshape(width, b - a)
            row[a:b] = (name << 14) + np.arange(b - a)
        names = [b[0] for b in blocks]
        del blocks
        schema = ["forest", "tree", "block", "importance", "data", "y"]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.binary(), pa.binary()]
        for f, spec in enumerate(forests):
            held = np.flatnonzero(part == spec.held)
            total = np.zeros(len(held), np.int64)
            mine = [t for t in range(trees) if (f * trees + t) % tasks == task]
            pick = int(np.ceil(np.sqrt(len(spec.features)))) if trees > 1 else len(spec.features)
            some = np.ascontiguousarray(X[:, held]) if mine and len(held) else None
            for t in mine:
                w = bag(row, t, seed)
                w[part == spec.held] = 0
                tree, importance = grow(X, y, w, spec.features, np.random.default_rng([seed, t]), pick, max_depth, min_leaf)
                if some is not None:
                    total += tree.scores(some)
                one = ([f], [t], [0], [importance.tolist()], [tree.pack() if keep else None], [None])
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(one, kinds)], schema)
            if some is None:
                continue
            at = np.searchsorted(held, first)
            for name, a, b in zip(names, at[:-1], at[1:]):
                if b > a:
                    one = ([f], [-1], [name], [None], [total[a:b].tobytes()], [y[held[a:b]].tobytes()])
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(one, kinds)], schema)
    return run


def _summed(trees: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(d, np.int64) for d in pdf["data"])
        return pd.DataFrame({"forest": np.full(len(total), pdf["forest"].iloc[0], np.int32), "y": np.frombuffer(pdf["y"].iloc[0], np.uint8).astype(np.int32),
                             "score": total / (trees * UNIT)})
    return run


def _to_each(rows: DataFrame, groups: int) -> DataFrame:
    """Every row to each of ``groups`` partitions."""
    each = rows.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("task"), "*")
    return each.repartitionById(groups, F.col("task"))


def labelled(df: DataFrame, label: str, features: Sequence[str], part: Column | None = None) -> DataFrame:
    """(x, y, part) of the rows."""
    y = q(label).cast("double")
    y = F.when(y.isin(0.0, 1.0), y.cast("int")).otherwise(F.raise_error(F.lit("labels of a forest are 0 and 1")).cast("int"))
    return df.select(vector(features).alias("x"), y.alias("y"), (F.lit(0) if part is None else part).cast("int").alias("part"))


def fit_forests(df: DataFrame, label: str, features: Sequence[str], forests: Sequence[Grown], num_trees: int, seed: int,
                max_depth: int, min_leaf: int = 1, part: Column | None = None, keep: bool = False) -> tuple[list[np.ndarray], DataFrame, list[np.ndarray]]:
    """Grow the forests over rows of df: (importances of each, table of ``TREE_SCHEMA``, cut points).
    ``keep``: the table also holds the trees."""
    spark = df.sparkSession
    ship_package(spark)
    rows = stage_table(labelled(df, label, features, part))
    cuts = cut_points(rows, len(features))
    blocks = stage_table(rows.mapInArrow(_blocks(cuts, len(features)), BLOCK_SCHEMA))
    free(rows)
    tasks = max(1, min(num_trees * len(forests), 2 * spark.sparkContext.defaultParallelism))
    table = stage_table(_to_each(blocks, tasks).mapInArrow(_growing(len(features), forests, num_trees, tasks, seed, max_depth, min_leaf, keep), TREE_SCHEMA))
    free(blocks)
    importances = [np.zeros(len(f.features)) for f in forests]
    for r in table.filter("tree >= 0").select("forest", "tree", "importance").orderBy("forest", "tree").collect():
        importances[r["forest"]] += np.array(r["importance"], float)
    return [v / (v.sum() or 1.0) for v in importances], table, cuts


def held_scores(table: DataFrame, num_trees: int) -> DataFrame:
    """(forest, y, score) of the rows that each forest held out."""
    return table.filter("tree < 0").select("forest", "block", "data", "y").groupBy("forest", "block").applyInPandas(_summed(num_trees), "forest int, y int, score double")


# ----------------------------------------------------------------------------- a kept forest
class Forest:
    """A grown forest: its trees lie in the shared folder, ``transform`` adds ``probability`` and
    ``prediction``."""

    def __init__(self, trees: DataFrame, cuts: list[np.ndarray], features: Sequence[str], num_trees: int):
        self.trees, self.cuts, self.features, self.num_trees = trees, cuts, list(features), num_trees

    def _through(self, rows: DataFrame, score, schema: str, values: int) -> DataFrame:
        """``score(blocks, trees)`` in groups of the rows (data binary) and all trees; ``values``: how many
        scores all rows have."""
        spark = rows.sparkSession
        groups = max(1, min(2 * spark.sparkContext.defaultParallelism, -(-values // 10_000)), -(-values // GROUP_VALUES))
        blocks = rows.select(F.lit(-1).alias("tree"), "data", F.pmod(F.xxhash64("name"), F.lit(groups)).cast("int").alias("task"))
        trees = self.trees.select("tree", "data", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("task"))
        both = blocks.unionByName(trees).repartitionById(groups, F.col("task")).sortWithinPartitions("tree").select("tree", "data")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def each():
                for batch in batches:
                    for i in range(batch.num_rows):
                        yield batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            yield from score(each())
        return both.mapInArrow(run, schema)

    def transform(self, df: DataFrame) -> DataFrame:
        spark = df.sparkSession
        ship_package(spark)
        kept = stage_table(df.withColumn("__row", F.monotonically_increasing_id()))
        width, cuts, num = len(self.features), self.cuts, self.num_trees

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    ids = batch.column(1).to_numpy().astype(np.int64)
                    data = ids.tobytes() + binned(_matrix(batch.column(0), width), cuts).tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array(ids[:1]), pa.array([data], pa.binary())], ["name", "data"])

        def score(each) -> Iterator[pa.RecordBatch]:
            ids, X, total = [], [], None
            for tree, data in each:
                if tree < 0:
                    n = len(data) // (8 + width)
                    ids.append(np.frombuffer(data, np.int64, n))
                    X.append(np.frombuffer(data, np.uint8, n * width, 8 * n).reshape(width, n))
                    continue
                if total is None and not ids:
                    return
                if total is None:
                    X = np.concatenate(X, axis=1)
                    total = np.zeros(X.shape[1], np.int64)
                total += Tree.unpack(data).scores(X)
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(total / (num * UNIT))], ["__row", "__p"])
        rows = kept.select(vector(self.features).alias("x"), "__row").mapInArrow(pack, "name long, data binary")
        scored = self._through(rows, score, "__row long, __p double", kept.count())
        p = F.col("__p")
        return (kept.join(scored, "__row").withColumn("probability", array_to_vector(F.array(1 - p, p)))
                .withColumn("prediction", (p > 0.5).cast("double")).drop("__row", "__p"))

    def score_counts(self, rows: DataFrame, n: int, feats: Sequence[str], repeats: int) -> DataFrame:
        """(f, rep, s, pos, neg): how often each score comes among the rows (y, x, donors) with the value of
        feature ``feats[f]`` from the donor of repeat ``rep``; f = -1: the rows as they are."""
        ship_package(rows.sparkSession)
        width, cuts, num = len(self.features), self.cuts, self.num_trees
        places = [self.features.index(c) for c in feats]

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                m = batch.num_rows
                if m:
                    own = binned(_matrix(batch.column(1), width), cuts)
                    given = _matrix(batch.column(2).flatten(), width).reshape(m, repeats, width)
                    data = batch.column(0).to_numpy().astype(np.uint8).tobytes() + own.tobytes() + b"".join(binned(given[:, r], cuts).tobytes() for r in range(repeats))
                    yield pa.RecordBatch.from_arrays([pa.array([zlib.crc32(data)], pa.int64()), pa.array([data], pa.binary())], ["name", "data"])

        def score(each) -> Iterator[pa.RecordBatch]:
            y, X, D, total = [], [], [], None
            for tree, data in each:
                if tree < 0:
                    m = len(data) // (1 + width * (1 + repeats))
                    y.append(np.frombuffer(data, np.uint8, m))
                    X.append(np.frombuffer(data, np.uint8, m * width, m).reshape(width, m))
                    D.append(np.frombuffer(data, np.uint8, m * width * repeats, m * (1 + width)).reshape(repeats, width, m))
                    continue
                if total is None and not y:
                    return
                if total is None:
                    y, X, D = np.concatenate(y), np.concatenate(X, axis=1), np.concatenate(D, axis=2)
                    total = np.zeros((1 + len(places) * repeats, X.shape[1]), np.int64)
                one = Tree.unpack(data)
                plain = one.scores(X)
                total[0] += plain
                used = set(np.unique(one.feature).tolist())
                for j, i in enumerate(places):
                    for r in range(repeats):
                        into = total[1 + j * repeats + r]
                        into += plain
                        moved = np.flatnonzero(D[r, i] != X[i]) if i in used else []
                        if len(moved):
                            Z = X[:, moved]
                            Z[i] = D[r, i, moved]
                            into[moved] += one.scores(Z) - plain[moved]
            if total is None:
                return
            for k, t in enumerate(total):
                s, at = np.unique(t, return_inverse=True)
                pos = np.bincount(at, y == 1, len(s)).astype(np.int64)
                f, rep = (-1, -1) if k == 0 else divmod(k - 1, repeats)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), f, np.int32)), pa.array(np.full(len(s), rep, np.int32)), pa.array(s / (num * UNIT)),
                                                  pa.array(pos), pa.array(np.bincount(at, minlength=len(s)) - pos)], ["f", "rep", "s", "pos", "neg"])
        packed = rows.select("y", "x", "donors").mapInArrow(pack, "name long, data binary")
        return self._through(packed, score, "f int, rep int, s double, pos long, neg long", n * (1 + len(places) * repeats))
