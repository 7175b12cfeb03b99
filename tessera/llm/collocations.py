"""Phrase collocations by Rabin-Karp fingerprints.

**Fingerprints.**  Words and n-grams are hashed by prefix polynomials (numpy, one pass over a
block of texts): the hash of any stretch is the difference of two prefixes, shifted to the
origin.  The key is a polynomial modulo 2^64, the check an independent one modulo the prime
2^31 - 1; both take in the language, the key also the number of words.

**Counting.**  For n = 1, 2, ... one scan counts the n-grams whose two (n - 1)-grams are frequent
(every candidate's are: an n-gram is no more frequent than its parts, so nothing is lost).
Frequent keys go to the scan as a bitmap of fixed size.  A block adds up its own n-grams first;
the shuffle then adds up (key, count, least and largest check, occurrence pointer: a hash that
names the document).  A frequent word costs one row per block, so no key is hot.

**Verification against the text.**  Only frequent fingerprints are turned into phrases: the
documents that their pointers name are read once more, and the words found there must give
the key and the check.  A key whose least and largest check differ stands for several phrases:
such keys are counted again by text, in one more scan, and their phrases stay apart.

**Scores** are exact: products are decimals of 38 digits and the quotient is integral.  For each
language the best rows are taken in two levels (``top_k_per_group``), never in one task.

Null texts are empty, null languages ``und``.  Rows with equal ids or texts all count; ids may be
null; extra columns are left out; an empty table, or one without frequent phrases, gives no rows.
Words are not bounded in length.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dictionary import top_k_per_group
from ..session import forget, ship_package, stage_table
from .bitmap import in_bitmap, make_bitmap
from .textnum import blocks, lists, mix, odd_constants

PRIME = np.uint64((1 << 31) - 1)
BASE, CHECK_BASE = 0x9E3779B97F4A7C15, 1_283_507_911
TOTAL = 0x5D1E5EED  # key of a language's word count: hash of the language, xor this
MOST_BITS = 64


class Powers:
    """Powers of a base and of its inverse, modulo 2^64 or modulo PRIME."""

    def __init__(self, base: int, modulus: int):
        self.mod = None if modulus == 1 << 64 else np.uint64(modulus)
        self.step = [np.uint64(base), np.uint64(pow(base, -1, modulus))]
        self.known = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def _to(self, n: int, inverse: int) -> np.ndarray:
        p = self.known[inverse]
        while len(p) < n:
            step = p[-1:] * self.step[inverse]
            q = p * (step if self.mod is None else step % self.mod)
            p = np.concatenate([p, q if self.mod is None else q % self.mod])
        self.known[inverse] = p
        return p[:n]

    def prefix(self, x: np.ndarray) -> np.ndarray:
        """Prefix polynomial: element i is the sum of x[j] * base^j over j < i."""
        t = x * self._to(len(x), 0)
        out = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(t if self.mod is None else t % self.mod, out=out[1:])
        return out

    def stretch(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Polynomial of the elements start .. end - 1, as if they stood at the origin."""
        back = self._to(len(prefix), 1)[start]
        d = prefix[end] - prefix[start]
        return d * back if self.mod is None else d % self.mod * back % self.mod


def _bytes(of: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(of.encode())] = True
    return t


PIECE_ENDS, BLANKS = _bytes(".,;:!?\n\x0b\x0c\r"), _bytes(" \t")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


class Grams:
    """Fingerprints of the word n-grams of blocks of texts."""

    def __init__(self, bits: int = MOST_BITS):
        self.mask = np.uint64((1 << bits) - 1)
        self.wide, self.narrow = Powers(BASE, 1 << 64), Powers(CHECK_BASE, int(PRIME))
        self.value = odd_constants(256, 11)[LOWER]
        self.small = (odd_constants(256, 23) % PRIME)[LOWER]
        self.salt = odd_constants(64, 31)

    def load(self, buf: np.ndarray, offs: np.ndarray, lang: np.ndarray) -> "Grams":
        """Words of a block; ``lang``: hash of the language of each text."""
        self.buf = LOWER[buf]
        ends = PIECE_ENDS[buf]
        word = ~(ends | BLANKS[buf])
        opens, closes = word.copy(), word.copy()
        opens[1:] &= ~word[:-1]
        closes[:-1] &= ~word[1:]
        first = offs[:-1][offs[:-1] < len(buf)]
        opens[first] |= word[first]
        last = offs[1:][offs[1:] > 0] - 1
        closes[last] |= word[last]
        self.start, self.end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.owner = np.searchsorted(offs, self.start, "right") - 1
        self.piece = np.cumsum(ends)[self.start] if len(buf) else np.zeros(0, np.int64)
        self.lang = lang.view(np.uint64)
        size = (self.end - self.start).astype(np.uint64)
        x = mix(self.wide.stretch(self.wide.prefix(self.value[buf]), self.start, self.end) + mix(size))
        y = (self.narrow.stretch(self.narrow.prefix(self.small[buf]), self.start, self.end) + size) % PRIME
        self.words, self.checks = self.wide.prefix(x), self.narrow.prefix(y)
        return self

    def valid(self, n: int) -> np.ndarray:
        """Is there an n-gram at each word (inside its piece)?"""
        out = np.zeros(len(self.start), bool)
        m = len(out) - n + 1
        if m > 0:
            out[:m] = (self.piece[:m] == self.piece[n - 1:]) & (self.owner[:m] == self.owner[n - 1:])
        return out

    def keys(self, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(key, check) of the n-grams that start at the words ``at``."""
        lang = mix(self.lang[self.owner[at]] + self.salt[n % 64])
        key = mix(self.wide.stretch(self.words, at, at + n) ^ lang) & self.mask
        check = (self.narrow.stretch(self.checks, at, at + n) + lang % PRIME) % PRIME
        return key, check

    def text(self, i: int, n: int) -> str:
        return b" ".join(self.buf[a:b].tobytes() for a, b in zip(self.start[i:i + n].tolist(), self.end[i:i + n].tolist())).decode()

    def parts(self, at: np.ndarray, n: int) -> list[pa.Array]:
        """Keys and checks of the first k words and of the rest, k = 1 .. n - 1, per n-gram."""
        cols = []
        for left in (True, False):
            both = [self.keys(at if left else at + k, k if left else n - k) for k in range(1, n)]
            for c in (0, 1):
                flat = np.stack([b[c] for b in both], 1).ravel() if both else np.zeros(0, np.uint64)
                cols.append(lists(np.arange(len(at) + 1) * (n - 1), pa.array(flat.view(np.int64))))
        return cols


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def _counted(n: int, shared, bits: int):
    """Counts of the n-grams of each block whose (n - 1)-grams may be in the bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, known = Grams(bits), None if shared is None else shared.value
        for batch in batches:
            langs, marks = _column(batch, "lang_hash"), _column(batch, "mark")
            for lo, hi, buf, offs in blocks(batch):
                g = grams.load(buf, offs, langs[lo:hi])
                ok = g.valid(n)
                if known is not None:
                    part = np.flatnonzero(g.valid(n - 1))
                    frequent = np.zeros(len(ok) + 1, bool)
                    frequent[part] = in_bitmap(known, g.keys(part, n - 1)[0])
                    ok &= frequent[:-1] & frequent[1:]
                at = np.flatnonzero(ok)
                key, check = g.keys(at, n)
                mark = marks[lo:hi][g.owner[at]]
                if n == 1:  # every word counts for its language as well
                    key = np.concatenate([key, g.lang[g.owner] ^ np.uint64(TOTAL)])
                    check, mark = np.concatenate([check, np.zeros(len(at), np.uint64)]), np.concatenate([mark, mark])
                if not len(key):
                    continue
                order = np.argsort(key, kind="stable")
                key = key[order]
                new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                check = check[order].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[new].view(np.int64)), pa.array(np.diff(np.append(new, len(key)))), pa.array(np.minimum.reduceat(check, new)),
                     pa.array(np.maximum.reduceat(check, new)), pa.array(np.minimum.reduceat(mark[order], new))], ["key", "n", "low", "high", "mark"])
    return run


PHRASES = ("key long, check int, lang string, phrase string, words int, n long, "
           "left_key array<long>, left_check array<long>, right_key array<long>, right_check array<long>")


def _phrase_batch(g: Grams, at: np.ndarray, n: int, key, check, lang: pa.Array, count) -> pa.RecordBatch:
    cols = [pa.array(key.view(np.int64)), pa.array(check.astype(np.int32)), lang.take(pa.array(g.owner[at])), pa.array([g.text(i, n) for i in at.tolist()], pa.string()),
            pa.array(np.full(len(at), n, np.int32)), pa.array(count), *g.parts(at, n)]
    return pa.RecordBatch.from_arrays(cols, [c.split()[0] for c in PHRASES.split(", ")])


def _pointed(shared):
    """The rows whose mark may be in the bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(shared.value, _column(batch, "mark").view(np.uint64))))
    return run


def _read(most: int, bits: int):
    """The phrases that the keys of each row's ``wanted`` stand for in its text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(bits)
        for batch in batches:
            langs, lang = _column(batch, "lang_hash"), batch.column(batch.schema.get_field_index("lang"))
            wanted = batch.column(batch.schema.get_field_index("wanted"))
            for lo, hi, buf, offs in blocks(batch):
                g = grams.load(buf, offs, langs[lo:hi])
                want = wanted.slice(lo, hi - lo)
                size = np.diff(want.offsets.to_numpy())
                pairs = np.rec.fromarrays([np.repeat(np.arange(hi - lo), size), want.flatten().to_numpy().view(np.uint64)], names="owner,key")
                pairs.sort()
                for n in range(2, most + 1):
                    at = np.flatnonzero(g.valid(n))
                    key, check = g.keys(at, n)
                    found = np.rec.fromarrays([g.owner[at], key], names="owner,key")
                    place = np.minimum(np.searchsorted(pairs, found), max(0, len(pairs) - 1))
                    hit = pairs[place] == found if len(pairs) and len(found) else np.zeros(len(at), bool)
                    _, one = np.unique(place[hit], return_index=True)  # the first place of each
                    i = np.flatnonzero(hit)[one]
                    yield _phrase_batch(g, at[i], n, key[i], check[i], lang.slice(lo, hi - lo), np.zeros(len(i), np.int64))
    return run


def _by_text(most: int, shared, bits: int):
    """Counts by text of the n-grams whose keys may be in the bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(bits)
        for batch in batches:
            langs, lang = _column(batch, "lang_hash"), batch.column(batch.schema.get_field_index("lang"))
            for lo, hi, buf, offs in blocks(batch):
                g = grams.load(buf, offs, langs[lo:hi])
                for n in range(1, most + 1):
                    at = np.flatnonzero(g.valid(n))
                    key, check = g.keys(at, n)
                    hit = in_bitmap(shared.value, key)
                    at, key, check = at[hit], key[hit], check[hit]
                    seen: dict = {}
                    for j, i in enumerate(at.tolist()):
                        seen.setdefault((langs[lo + g.owner[i]], g.text(i, n)), []).append(j)
                    one = np.array([v[0] for v in seen.values()], np.int64)
                    yield _phrase_batch(g, at[one], n, key[one], check[one], lang.slice(lo, hi - lo), np.array([len(v) for v in seen.values()], np.int64))
    return run


def collocations(documents: DataFrame, *, max_words: int = 3, min_count: int = 10, inside: tuple[int, int] = (50, 100), best: int = 2000,
                 text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", bits: int = MOST_BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: for each language the ``best`` phrases of 2 to
    ``max_words`` words.  A phrase goes where a longer candidate holds it and has at least
    inside[0] / inside[1] of its count.  ``bits``: width of the keys."""
    spark = documents.sparkSession
    ship_package(spark)
    text, lang = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und"))
    rows = documents.select(F.xxhash64(F.col(f"`{id_col}`").cast("string"), lang, text).alias("mark"), F.xxhash64(lang).alias("lang_hash"), lang.alias("lang"), text.alias("text"))

    counts, known, shared = [], None, []
    for n in range(1, max_words + 1):
        seen = rows.drop("lang").mapInArrow(_counted(n, known, bits), "key long, n long, low int, high int, mark long")
        total = seen.groupBy("key").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.min("mark").alias("mark"))
        counts.append(stage_table(total.filter(F.col("n") >= min_count)))
        if n < max_words:
            known = spark.sparkContext.broadcast(make_bitmap(counts[-1].select(F.col("key").alias("term"))))
            shared.append(known)
    frequent = reduce(DataFrame.unionAll, counts)
    # keys of one length and of different lengths may meet
    mixed = stage_table(frequent.groupBy("key").agg(F.count(F.lit(1)).alias("lengths"), F.min("low").alias("low"), F.max("high").alias("high"))
                        .filter("lengths > 1 or low != high").select("key"))
    clean = frequent.join(mixed, "key", "left_anti")

    wanted = reduce(DataFrame.unionAll, counts[1:])
    wanted = clean.join(wanted.select("key"), "key", "left_semi")
    pointed = spark.sparkContext.broadcast(make_bitmap(wanted.select(F.col("mark").alias("term"))))
    shared.append(pointed)
    named = rows.mapInArrow(_pointed(pointed), rows.schema).join(wanted.groupBy("mark").agg(F.collect_list("key").alias("wanted")), "mark")
    phrases = (named.select("text", "lang", "lang_hash", "wanted").mapInArrow(_read(max_words, bits), PHRASES).dropDuplicates(["key"]).drop("n")
               .join(clean.select("key", "n", F.col("low")), "key").filter("check = low").drop("low"))
    by_key = clean.select("key", F.col("low").cast("long").alias("check"), F.lit(None).cast("string").alias("phrase"), "n")
    if not mixed.isEmpty():
        met = spark.sparkContext.broadcast(make_bitmap(mixed.select(F.col("key").alias("term"))))
        shared.append(met)
        first = [F.first(c).alias(c) for c in ("check", "left_key", "left_check", "right_key", "right_check")]
        apart = stage_table(rows.mapInArrow(_by_text(max_words, met, bits), PHRASES).join(mixed, "key", "left_semi")
                            .groupBy("key", "lang", "phrase", "words").agg(F.sum("n").alias("n"), *first).filter(F.col("n") >= min_count))
        phrases = phrases.unionByName(apart.filter("words > 1"))
        by_key = by_key.unionAll(apart.select("key", F.col("check").cast("long"), "phrase", "n"))
    phrases, by_key = stage_table(phrases), stage_table(by_key)
    forget(*shared)
    return _ranked(phrases, by_key, counts[0], max_words, inside, best)


def _ranked(phrases: DataFrame, by_key: DataFrame, totals: DataFrame, max_words: int, inside: tuple[int, int], best: int) -> DataFrame:
    """Scores of the candidates, without those that a longer one holds, ranked per language."""
    words = F.split("phrase", " ")
    cuts = F.explode(F.arrays_zip("left_key", "left_check", "right_key", "right_check", F.sequence(F.lit(1), F.size("left_key")).alias("k"))).alias("cut")
    cut = phrases.select("lang", "phrase", "words", F.col("n").alias("a"), cuts).select("lang", "phrase", "words", "a", "cut.*")
    cut = cut.withColumns({"left": F.array_join(F.slice(words, F.lit(1), F.col("k")), " "), "right": F.array_join(F.slice(words, F.col("k") + 1, F.col("words")), " ")})
    for side, name in (("left", "l"), ("right", "r")):
        part = by_key.select(F.col("key").alias(f"{side}_key"), F.col("check").alias(f"{side}_check"), F.col("phrase").alias("of"), F.col("n").alias(name))
        cut = cut.join(part, [f"{side}_key", f"{side}_check"]).filter(F.col("of").isNull() | (F.col("of") == F.col(side))).drop("of")

    def big(c):
        return F.col(c).cast("decimal(38,0)")
    million = F.lit(1_000_000).cast("decimal(38,0)")
    cut = cut.withColumns({"up": (million * big("a") * big("a")).cast("decimal(38,0)"), "down": (big("l") * big("r")).cast("decimal(38,0)")})
    cut = cut.withColumn("score", F.expr("up div down"))
    scored = cut.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("s")).select("lang", "phrase", "words", "a", "s.*")

    parts = [F.array_join(F.slice(words, i + 1, n), " ") for n in range(2, max_words) for i in range(max_words)]
    sizes = [(n, i) for n in range(2, max_words) for i in range(max_words)]
    if parts:
        held = F.array(*[F.when((F.col("words") > n) & (F.col("words") >= n + i), p) for p, (n, i) in zip(parts, sizes)])
        longer = (phrases.select("lang", F.explode(held).alias("phrase"), F.col("n").alias("most")).filter("phrase is not null")
                  .groupBy("lang", "phrase").agg(F.max("most").alias("most")))
        scored = scored.join(longer, ["lang", "phrase"], "left").filter(F.col("most").isNull() | (inside[1] * F.col("most") < inside[0] * F.col("a")))
    top = top_k_per_group(scored, "lang", [F.desc("score"), F.desc("a"), F.asc("phrase")], best, ["phrase"])
    n = totals.select(F.col("key").alias("total_key"), F.col("n"))
    top = top.withColumn("total_key", F.xxhash64("lang").bitwiseXOR(F.lit(TOTAL))).join(n, "total_key")
    return top.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
f1 AS (SELECT lang, x AS phrase, count(*) AS f FROM (SELECT lang, unnest(w) AS x FROM w) GROUP BY ALL),
f2 AS (SELECT lang, x AS phrase, count(*) AS f FROM (
         SELECT lang, unnest([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS x FROM w) GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, x AS phrase, count(*) AS f FROM (
         SELECT lang, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]) AS x FROM w) GROUP BY ALL HAVING count(*) >= 10),
c AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS s FROM (SELECT * FROM f2 UNION ALL SELECT * FROM f3)),
cut AS (SELECT lang, phrase, a, len(s) AS m, unnest(range(1, len(s))) AS k, s FROM c),
f AS (SELECT * FROM f1 UNION ALL SELECT * FROM f2),
scored AS (SELECT cut.lang, cut.phrase, a, k, l.f AS l, r.f AS r,
                  CAST((1000000 * CAST(a AS HUGEINT) * a) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
           FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = array_to_string(s[1:k], ' ')
                    JOIN f r ON r.lang = cut.lang AND r.phrase = array_to_string(s[k + 1:m], ' ')),
one AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
held AS (SELECT lang, phrase, max(f) AS most FROM (
           SELECT lang, f, unnest([string_split(phrase, ' ')[1] || ' ' || string_split(phrase, ' ')[2],
                                   string_split(phrase, ' ')[2] || ' ' || string_split(phrase, ' ')[3]]) AS phrase FROM f3) GROUP BY ALL),
kept AS (SELECT one.* FROM one LEFT JOIN held USING (lang, phrase) WHERE most IS NULL OR 100 * most < 50 * a)
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS BIGINT) AS rank,
       phrase, a, l, r, n, score
FROM kept JOIN total USING (lang) QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""
