"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear support vector machine.

**Kernel.**  Units are words (letters and digits, lower-cased, with a mark for the word start;
inner punctuation is dropped, so ``id*iot`` is one unit; runs of three or more single letters
are joined; units longer than ``LONGEST`` go in overlapping pieces).  Two units are compared by
the normalised gap-weighted subsequence kernel of length ``LENGTH`` with decay ``DECAY`` per
character spanned, raised to the power ``POWER`` (a product of kernels is a kernel): inserted
characters and gaps lower the value, foreign words have almost none.  Values below ``FLOOR``,
and those of units that lack ``SHARE`` of a landmark's character pairs, count as 0.

**Landmarks** are the units that tell the labelled classes apart best (likelihood ratio of
their document frequencies), taken from a bounded sample of the labelled training texts.  A
text's kernel vector sums its distinct units per landmark, at most ``MOST`` each; K_mm^(-1/2)
maps it to Nyström features; a linear SVM (squared hinge) and a Platt sigmoid give the score.

**Data flow.**  The sample (at most ``sample`` labelled rows, taken by hash order) is small by
construction and is broadcast to the scan, so texts are never shuffled.  Scoring is one
map-side pass over the whole texts; distinct units are scored once per worker (bounded memo).

Null and empty texts have no units: the kernel vector is zero, and they get the bias score.
Rows with equal ids stay separate.  With fewer than one row of either class every score is the
share of positives.  Labels that are null are left out.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from .bitmap import free_name
from .bpe import text_blocks
from .textnum import kept

LENGTH, DECAY, POWER = 3, 0.8, 3
SHARE, FLOOR, MOST, LONGEST = 0.6, 0.1, 3.0, 24
MARK = "^"
ROWS = 2048
MEMO = 600_000
INNER = re.compile(r"[\W_]+")


def _pieces(c: str) -> Iterator[str]:
    c = MARK + INNER.sub("", c) if not c.isalnum() else MARK + c
    if len(c) <= LONGEST:
        yield c
    else:
        yield from (c[i:i + LONGEST] for i in range(0, len(c) - LONGEST // 2, LONGEST // 2))


def units_of(text: str) -> set[str]:
    """Distinct units of a whole text."""
    words = text.lower().split()
    every = set(words)
    plain = {w for w in every if len(w) < LONGEST and w.isalnum()}
    out = {MARK + w for w in plain}
    for c in every.difference(plain):
        out.update(_pieces(c))
    single = [i for i, w in enumerate(words) if len(w) == 1 and (w.isalnum() or w == "_")]
    if len(single) > 2:  # runs of three or more are words with blanks between their letters
        ends = [k for k in range(1, len(single)) if single[k] != single[k - 1] + 1] + [len(single)]
        for k, e in zip([0, *ends], ends):
            if e - k > 2:
                out.update(_pieces(" ".join(words[single[k]:single[e - 1] + 1])))
    out.discard(MARK)
    return out


def _codes(units: list[str], width: int = 0) -> np.ndarray:
    """Code points padded with -1."""
    lens = np.fromiter(map(len, units), np.int64, len(units))
    flat = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    out = np.full((len(units), max(width, int(lens.max(initial=1)))), -1, np.int64)
    out[np.arange(out.shape[1]) < lens[:, None]] = flat
    return out


def _pair_masks(codes: np.ndarray) -> np.ndarray:
    """64-bit mask of the (hashed) neighbouring character pairs of each unit."""
    a, b = codes[:, :-1].astype(np.uint64), codes[:, 1:].astype(np.uint64)
    h = (a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(58)
    return np.bitwise_or.reduce(np.where(codes[:, 1:] >= 0, np.uint64(1) << h, np.uint64(0)), axis=1)


def subsequence_kernel(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Gap-weighted subsequence kernel of the rows of s and t (code points, padded with
    negative values; t has one row or as many as s)."""
    s, t = np.atleast_2d(s), np.atleast_2d(t)
    n = max(len(s), len(t))
    if n > ROWS:  # pieces that stay in the processor's cache
        return np.concatenate([subsequence_kernel(s[i:i + ROWS], t[i:i + ROWS] if len(t) == n else t) for i in range(0, n, ROWS)])
    a_len, b_len = s.shape[1], t.shape[1]
    if len(s) < n:  # one row of s against many of t
        s = np.broadcast_to(s, (n, a_len))
    s, t, real = np.ascontiguousarray(s.T), np.ascontiguousarray(t.T), s.T >= 0
    match = [[(s[a] == t[b]) & real[a] for b in range(b_len)] for a in range(a_len)]
    prev = [[np.ones(n)] * (b_len + 1) for _ in range(a_len + 1)]
    zero = np.zeros(n)
    for _ in range(LENGTH - 1):
        cur = [[zero] * (b_len + 1) for _ in range(a_len + 1)]
        for a in range(1, a_len + 1):
            run = zero
            for b in range(1, b_len + 1):
                run = DECAY * run + match[a - 1][b - 1] * (DECAY * DECAY * prev[a - 1][b - 1])
                cur[a][b] = DECAY * cur[a - 1][b] + run
        prev = cur
    total = np.zeros(n)
    for a in range(1, a_len + 1):
        for b in range(1, b_len + 1):
            total += match[a - 1][b - 1] * (DECAY * DECAY * prev[a - 1][b - 1])
    return total


def _width(unit: str) -> int:
    return -(-len(unit) // 4) * 4


def _by_width(units: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(indices, codes) of the units of each padded width."""
    by: dict[int, list[int]] = {}
    for i, u in enumerate(units):
        if len(u) >= LENGTH:
            by.setdefault(_width(u), []).append(i)
    for width, idx in by.items():
        yield np.array(idx), _codes([units[i] for i in idx], width)


class Landmarks:
    """Kernel values against a fixed list of units."""

    def __init__(self, units: list[str]):
        self.units = units
        self.groups = []  # (landmarks, codes, pair masks, pairs needed, own kernel) by width
        for idx, codes in _by_width(units):
            masks = _pair_masks(codes)
            need = np.ceil(SHARE * np.bitwise_count(masks)).astype(np.int64)
            self.groups.append((idx, codes, masks, need, subsequence_kernel(codes, codes)))

    def values(self, units: list[str]) -> np.ndarray:
        """Normalised kernel of every unit with every landmark, to the power POWER."""
        out = np.zeros((len(units), len(self.units)), np.float32)
        for idx, codes in _by_width(units):
            masks = _pair_masks(codes)
            own = np.zeros(len(idx))
            for marks, mark_codes, mark_masks, need, mark_own in self.groups:
                near = [np.flatnonzero(np.bitwise_count(masks & m) >= k) for m, k in zip(mark_masks, need)]
                u = np.concatenate(near)
                if not len(u):
                    continue
                m = np.repeat(np.arange(len(marks)), [len(x) for x in near])
                new = np.unique(u[own[u] == 0])
                own[new] = subsequence_kernel(codes[new], codes[new])
                scale = np.sqrt(own[u] * mark_own[m])
                value = subsequence_kernel(codes[u], mark_codes[m]) / np.where(scale > 0, scale, 1)
                value = np.where(scale > 0, value, 0) ** POWER
                out[idx[u], marks[m]] = np.where(value >= FLOOR, value, 0)
        return out


class TextKernel:
    """Kernel vectors of whole texts, with a bounded memo of unit rows."""

    def __init__(self, landmarks: list[str]):
        self.marks = Landmarks(landmarks)
        self.memo: dict[str, int] = {}
        self.rows = np.zeros((1, len(landmarks)), np.float32)

    def __call__(self, texts: list[str]) -> np.ndarray:
        split = [units_of(t) for t in texts]
        every = set().union(*split)
        new = every.difference(self.memo)
        if len(self.memo) + len(new) > MEMO:
            self.memo, self.rows, new = {}, self.rows[:1], every
        if new:
            fresh = sorted(new)
            values = self.marks.values(fresh)
            live = values.any(axis=1)  # most units are far from all landmarks: row 0
            row = np.zeros(len(fresh), np.int64)
            row[live] = len(self.rows) + np.arange(int(live.sum()))
            self.rows = np.concatenate([self.rows, values[live]])
            self.memo.update(zip(fresh, row.tolist()))
        out = np.zeros((len(texts), self.rows.shape[1]))
        for i, s in enumerate(split):
            at = [r for r in map(self.memo.__getitem__, s) if r]
            if at:
                out[i] = np.minimum(self.rows[at].sum(axis=0), MOST)
        return out


class Classifier:
    """Nyström map, linear SVM and Platt sigmoid."""

    def __init__(self, landmarks: list[str], k: np.ndarray, y: np.ndarray):
        self.landmarks = landmarks
        m = len(landmarks)
        self.rate = float(y.mean()) if len(y) else 0.0
        self.flat = not m or self.rate in (0.0, 1.0)
        if self.flat:
            return
        kmm = Landmarks(landmarks).values(landmarks).astype(float)
        kmm = (kmm + kmm.T) / 2 + 1e-6 * np.eye(m)
        w, v = np.linalg.eigh(kmm)
        self.map = v @ np.diag(1 / np.sqrt(np.maximum(w, 1e-6))) @ v.T
        self.map = self.map.real
        x = k @ self.map
        self.weights, self.bias = _svm(x, y)
        self.a, self.b = _platt(x @ self.weights + self.bias, y)

    def score(self, k: np.ndarray) -> np.ndarray:
        if self.flat:
            return np.full(len(k), self.rate)
        f = (k @ self.map) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(self.a * f + self.b, -40, 40)))


def _svm(x: np.ndarray, y: np.ndarray, c: float = 0.1, steps: int = 50) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss, classes weighted equally, by Newton steps."""
    z = np.hstack([x, np.ones((len(x), 1))])
    t = np.where(y > 0, 1.0, -1.0)
    weight = c * np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y <= 0).sum())))
    reg = np.eye(z.shape[1])
    reg[-1, -1] = 1e-3
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        active = t * (z @ w) < 1
        za, wa = z[active], weight[active]
        new = np.linalg.solve(reg + (za * wa[:, None]).T @ za, (za * wa[:, None]).T @ t[active])
        if np.abs(new - w).max() < 1e-9:
            break
        w = 0.5 * w + 0.5 * new if _ > 20 else new
    return w[:-1], float(w[-1])


def _platt(f: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Sigmoid on the margins with Platt's smoothed targets, by Newton steps."""
    pos, neg = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    z = np.stack([f, np.ones(len(f))], 1)
    w = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        grad = z.T @ (p - target) + 1e-6 * w
        hess = (z * (p * (1 - p))[:, None]).T @ z + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 2 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        label = batch.column(1).to_pylist()
        for lo, texts in text_blocks(batch.column(0)):
            split = [sorted(units_of(t)) for t in texts]
            flat = [u for s in split for u in s]
            yield pa.RecordBatch.from_arrays([pa.array(flat, pa.string()), pa.array([y for y, s in zip(label[lo:], split) for _ in s], pa.int32())], ["unit", "y"])


def _kernel_of(landmarks: list[str]) -> TextKernel:
    return kept(("kernel", hashlib.sha256("\n".join(landmarks).encode()).digest()), lambda: TextKernel(landmarks))


def _vectors(landmarks: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = _kernel_of(landmarks)
        for batch in batches:
            for lo, texts in text_blocks(batch.column(0)):
                k = kernel(texts)
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(lo, len(texts)), pa.array(k.tolist(), pa.list_(pa.float64()))], ["y", "k"])
    return run


def _scores(shared, out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Classifier = pickle.loads(shared.value)
        kernel = _kernel_of(model.landmarks)
        for batch in batches:
            for lo, texts in text_blocks(batch.column(batch.num_columns - 1)):
                score = model.score(kernel(texts))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(lo, len(texts)) for i in range(batch.num_columns - 1)), pa.array(score)],
                    [*batch.schema.names[:-1], out])
    return run


def _ratio(pos: int, neg: int):
    """Log likelihood ratio of document frequencies a of pos and b of neg texts."""
    a, b, n = F.col("a"), F.col("b"), pos + neg

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    both = a + b
    return (part(a, both * pos / n) + part(b, both * neg / n) + part(pos - a, (n - both) * pos / n) + part(neg - b, (n - both) * neg / n))


def train(documents: DataFrame, labels: DataFrame, *, sample: int = 20_000, landmarks: int = 192, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic") -> Classifier:
    """Classifier from the labelled rows of ``documents``; at most ``sample`` labelled ids are
    used (by hash order) and exact copies of a text count once."""
    ship_package(documents.sparkSession)
    marked = (labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y"))
              .filter("id is not null and y is not null").groupBy("id").agg(F.max("y").alias("y"))
              .orderBy(F.xxhash64("id"), "id").limit(sample))
    text = documents.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    chosen = text.join(F.broadcast(marked), "id").select(F.coalesce("text", F.lit("")).alias("text"), "y")
    chosen = chosen.groupBy("text").agg(F.max("y").alias("y")).persist()
    try:
        size = {r["y"]: r["n"] for r in chosen.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
        pos, neg = size.get(1, 0), size.get(0, 0)
        if not pos or not neg:
            return Classifier([], np.zeros((0, 0)), np.ones(pos) if pos else np.zeros(neg))
        seen = chosen.mapInArrow(_units, "unit string, y int").groupBy("unit").agg(
            F.sum("y").cast("double").alias("a"), F.sum(1 - F.col("y")).cast("double").alias("b"))
        enough = max(3.0, 0.002 * pos)
        marks = [r["unit"] for r in seen.filter((F.col("a") >= enough) & (F.length("unit") > LENGTH) & (F.col("a") / pos > 3 * (F.col("b") + 0.5) / neg))
                 .orderBy(F.desc(_ratio(pos, neg)), "unit").limit(landmarks).collect()]
        got = chosen.select("text", "y").mapInArrow(_vectors(marks), "y int, k array<double>").toArrow().to_pandas()
    finally:
        chosen.unpersist()
    k = np.array(got["k"].tolist()).reshape(len(got), len(marks))
    return Classifier(marks, k, got["y"].to_numpy())


def score(documents: DataFrame, model: Classifier, *, text_col: str = "text", keep: list[str] | None = None, out: str = "score") -> DataFrame:
    """The columns ``keep`` of every row (default: all but the text) and its score, named ``out``."""
    spark = documents.sparkSession
    ship_package(spark)
    names = keep if keep is not None else [c for c in documents.columns if c not in (text_col, out)]
    rows = documents.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text_col}`").cast("string").alias(free_name(documents, "text_")))
    shared = spark.sparkContext.broadcast(pickle.dumps(model))
    from pyspark.sql import types as T
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField(out, T.DoubleType())])
    return rows.mapInArrow(_scores(shared, out), schema)


def held_out(id_col: str = "doc_id"):
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 4 == 2, F.lit(False))


THRESHOLD = 0.3


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(documents, labels.filter(~held_out()))
    out = score(documents, model, keep=["doc_id"])
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
