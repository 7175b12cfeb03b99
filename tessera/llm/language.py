"""Language identification by interpolated Kneser-Ney character models.

**Training** counts the character ``ORDER``-grams of padded words over all training texts, per
language (pre-aggregated in each task, then summed by one shuffle).  Lower orders use
continuation counts; each order has its own discount n1 / (n1 + 2 n2).  The interpolated
model of a language is

    p_k(c | h) = max(count(hc) - D_k, 0) / count(h) + D_k * types(h) / count(h) * p_{k-1}(c | h')

and ends in a uniform distribution.  Its parts are stored in **sorted hash arrays**: one for
grams and one for histories per order, keyed by a ``SLOT_BITS``-bit hash, with one column per
language.  Their size is bounded by 2^SLOT_BITS rows an array, whatever the corpus, which is
what makes them safe to broadcast.

**Prediction** sums the log probabilities of all words of a text under each language and takes
the lowest cross-entropy per character.  Words are scored once per worker (bounded memo).
**Rejection** is calibrated on the training rows: a text whose cross-entropy lies above the
``quantile`` of its language's training texts is marked ``rejected``.

A text that is null or has no letter is ``und`` with score 0.  Null languages teach nothing.
With no training rows every text is ``und``.  Rows with equal ids stay separate.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package, stage_table
from .bpe import text_blocks
from .textnum import kept

ORDER = 4
SLOT_BITS = 22
SLOTS = 1 << SLOT_BITS
MEMO = 300_000
START, END = "\x02", "\x03"
WORDS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def grams_of(word: str) -> list[str]:
    p = START * (ORDER - 1) + word + END
    return [p[i:i + ORDER] for i in range(len(word) + 1)]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gram counts of a task's texts, by language; words are counted first."""
    words: dict[str, Counter] = {}
    grams: dict[str, Counter] = {}

    def pour() -> None:
        for lang, seen in words.items():
            g = grams.setdefault(lang, Counter())
            for w, n in seen.items():
                for x in grams_of(w):
                    g[x] += n
        words.clear()

    def out():
        for lang, g in grams.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g)), pa.array(list(g)), pa.array(list(g.values()), pa.int64())], ["lang", "gram", "n"])
        grams.clear()
    for batch in batches:
        langs = batch.column(1).to_pylist()
        for lo, texts in text_blocks(batch.column(0)):
            for lang, t in zip(langs[lo:lo + len(texts)], texts):
                words.setdefault(lang, Counter()).update(words_of(t))
            if sum(map(len, words.values())) > MEMO:
                pour()
                if sum(map(len, grams.values())) > MEMO:
                    yield from out()
    pour()
    yield from out()


def _slot(col) -> F.Column:
    return F.crc32(col.cast("binary")).bitwiseAND(F.lit(SLOTS - 1))


class Model:
    """Sorted hash arrays of all languages.  ``grams[k]`` / ``histories[k]``: (slots, values)
    with one value column per language; ``discount[k]``: by language."""

    def __init__(self, langs: list[str], grams: dict, histories: dict, discount: dict, letters: int):
        self.langs, self.grams, self.histories, self.discount, self.letters = langs, grams, histories, discount, letters

    def _rows(self, table, keys: np.ndarray) -> np.ndarray:
        slots, values = table
        out = np.zeros((len(keys), *values.shape[1:]))
        if len(slots):
            i = np.minimum(np.searchsorted(slots, keys), len(slots) - 1)
            hit = slots[i] == keys
            out[hit] = values[i[hit]]
        return out

    def log_prob(self, grams: list[str]) -> np.ndarray:
        """Interpolated log probability of the last character of each gram, per language."""
        p = np.full((len(grams), len(self.langs)), 1.0 / (self.letters + 1))
        for k in range(1, ORDER + 1):
            part = [g[ORDER - k:] for g in grams]
            n = self._rows(self.grams[k], _slots(part))
            h = self._rows(self.histories[k], _slots([x[:-1] for x in part]))
            total, types = h[..., 0], h[..., 1]
            d = self.discount[k]
            known = total > 0
            safe = np.where(known, total, 1)
            p = np.where(known, np.maximum(n - d, 0) / safe + np.maximum(d * types / safe, 1e-9) * p, p)
        return np.log(np.maximum(p, 1e-300))


def _slots(parts: list[str]) -> np.ndarray:
    return np.fromiter((zlib.crc32(x.encode()) & (SLOTS - 1) for x in parts), np.int64, len(parts))


def train(documents: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Model of all rows of ``documents`` with a language and a text."""
    spark = documents.sparkSession
    ship_package(spark)
    rows = documents.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    counts = rows.filter("text is not null and lang is not null").mapInArrow(_counted, "lang string, gram string, n long")
    at = {ORDER: stage_table(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")))}
    for k in range(ORDER - 1, 0, -1):  # continuation counts: distinct characters before
        at[k] = stage_table(at[k + 1].groupBy("lang", F.substring("gram", 2, k).alias("gram")).agg(F.count(F.lit(1)).alias("n")))
    langs = sorted(r["lang"] for r in at[1].select("lang").distinct().collect())
    letters = at[1].select("gram").distinct().count()
    column = {x: i for i, x in enumerate(langs)}
    grams, histories, discount = {}, {}, {}
    for k, t in at.items():
        n1, n2 = np.zeros(len(langs)), np.zeros(len(langs))
        for r in t.groupBy("lang").agg(F.sum((F.col("n") == 1).cast("long")).alias("a"), F.sum((F.col("n") == 2).cast("long")).alias("b")).collect():
            n1[column[r["lang"]]], n2[column[r["lang"]]] = r["a"], r["b"]
        discount[k] = np.where(n1 > 0, np.maximum(n1, 1) / np.maximum(n1 + 2 * n2, 1), 0.5)
        discount[k] = np.minimum(discount[k], 0.95)
        g = t.groupBy("lang", _slot(F.col("gram")).alias("slot")).agg(F.sum("n").alias("n")).toArrow().to_pandas()
        h = (t.groupBy("lang", _slot(F.substring("gram", 1, k - 1)).alias("slot")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types")).toArrow().to_pandas())
        grams[k] = _array(g, column, ["n"])
        grams[k] = (grams[k][0], grams[k][1][..., 0])
        histories[k] = _array(h, column, ["n", "types"])
    return Model(langs, grams, histories, discount, letters)


def _array(pdf, column: dict, names: list[str]):
    slots, at = np.unique(pdf["slot"].to_numpy(np.int64), return_inverse=True)
    values = np.zeros((len(slots), len(column), len(names)), np.float32)
    lang = pdf["lang"].map(column).to_numpy(np.int64) if len(pdf) else np.zeros(0, np.int64)
    for i, x in enumerate(names):
        values[at, lang, i] = pdf[x].to_numpy(np.float32)
    return slots, values


class Scorer:
    """Word scores with bounded memos (per worker)."""

    def __init__(self, model: Model):
        self.model, self.width = model, len(model.langs)
        self.clear()

    def clear(self) -> None:
        self.word, self.gram = {}, {}
        self.word_rows, self.gram_rows = np.zeros((0, self.width)), np.zeros((0, self.width))

    def learn(self, words: list[str]) -> None:
        split = [grams_of(w) for w in words]
        new = list({g for s in split for g in s}.difference(self.gram))
        if new:
            self.gram.update(zip(new, range(len(self.gram), len(self.gram) + len(new))))
            self.gram_rows = np.concatenate([self.gram_rows, self.model.log_prob(new)])
        flat = np.fromiter((self.gram[g] for s in split for g in s), np.int64)
        cuts = np.concatenate([[0], np.cumsum([len(s) for s in split])[:-1]])
        rows = np.add.reduceat(self.gram_rows[flat], cuts, axis=0)
        self.word.update(zip(words, range(len(self.word), len(self.word) + len(words))))
        self.word_rows = np.concatenate([self.word_rows, rows])

    def totals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(summed log probabilities per text and language, characters with word ends)."""
        split = [words_of(t) for t in texts]
        every = set().union(*split)
        new = every.difference(self.word)
        if len(self.word) + len(new) > MEMO:
            self.clear()
            new = every
        if new:
            self.learn(sorted(new))
        out, chars = np.zeros((len(texts), self.width)), np.zeros(len(texts))
        for i, s in enumerate(split):
            if any(c.isalpha() for w in s for c in w):
                at = np.fromiter(map(self.word.__getitem__, s), np.int64, len(s))
                out[i] = self.word_rows[at].sum(0)
                chars[i] = sum(map(len, s)) + len(s)
        return out, chars


def _scored(shared, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = kept(("language", key), lambda: Scorer(shared.value))
        langs = scorer.model.langs
        for batch in batches:
            for lo, texts in text_blocks(batch.column(1)):
                pred, entropy, score = ["und"] * len(texts), [None] * len(texts), [0.0] * len(texts)
                if langs:
                    total, chars = scorer.totals(texts)
                    for i in np.flatnonzero(chars):
                        ce = -total[i] / chars[i]
                        j = int(np.argmin(ce))
                        pred[i], entropy[i] = langs[j], float(ce[j])
                        score[i] = float(1 / np.exp(np.minimum(8 * (ce[j] - ce), 0)).sum())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(texts)), batch.column(2).slice(lo, len(texts)), pa.array(pred), pa.array(entropy, pa.float64()), pa.array(score)],
                    ["id", "fit", "lang_pred", "entropy", "score"])
    return run


def identify(documents: DataFrame, model: Model, fit=None, *, quantile: float = 0.999, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fit, lang_pred, score, entropy (per character, natural log), rejected.  ``fit``
    marks the rows that calibrate the rejection (default: all)."""
    spark = documents.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)
    cols = documents.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                            F.coalesce(fit if fit is not None else F.lit(True), F.lit(False)).alias("fit"))
    rows = stage_table(cols.mapInArrow(_scored(shared, str(shared._jbroadcast.id()) if shared._jbroadcast is not None else str(id(shared))),
                                       "id long, fit boolean, lang_pred string, entropy double, score double"))
    limit = rows.filter("fit and entropy is not null").groupBy("lang_pred").agg(F.percentile_approx("entropy", quantile, 10000).alias("limit"))
    out = rows.join(F.broadcast(limit), "lang_pred", "left")  # one row per language
    return out.select(F.col("id").alias("doc_id"), "fit", "lang_pred", "score", "entropy",
                      F.coalesce(F.col("entropy") > F.col("limit"), F.lit(False)).alias("rejected"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    model = train(documents.filter(~held))
    out = identify(documents, model, ~held)
    return out.select("doc_id", (~F.col("fit")).alias("held_out"), "lang_pred", "score", "entropy", "rejected")
