"""Collocations against a brute-force version."""
import random
import re
from collections import Counter

import numpy as np
import pytest

from tessera.llm.collocations import PRIME, Powers, collocations, op13_collocations

from .conftest import SF

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(docs, max_words=3, min_count=10, best=2000):
    f, total = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for n in range(1, max_words + 1):
                f.update((lang, tuple(w[i:i + n])) for i in range(len(w) - n + 1))
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    longest = Counter()
    for (lang, w), a in cand.items():
        for n in range(2, len(w)):
            for i in range(len(w) - n + 1):
                longest[lang, w[i:i + n]] = max(longest[lang, w[i:i + n]], a)
    rows = {}
    for (lang, w), a in cand.items():
        if 100 * longest[lang, w] >= 50 * a:
            continue
        cuts = [(10**6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        rows.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for lang, x in rows.items() for i, (s, a, p, l, r) in enumerate(sorted(x)[:best]))


def rows_of(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def table(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, l, "x", 1, 2, "y") for i, (l, t) in enumerate(rows)],
                                     "doc_id long, text string, lang string, key string, n long, mark long, phrase string").repartition(3)
    return make


def test_polynomials():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**31 - 1, 300, dtype=np.uint64)
    for p, m in ((Powers(0x9E3779B97F4A7C15, 1 << 64), 1 << 64), (Powers(1283507911, int(PRIME)), int(PRIME))):
        pre = p.prefix(x)
        for a, b in rng.integers(0, 300, (50, 2)):
            a, b = min(a, b), max(a, b)
            want = sum(int(x[j]) * pow(p.step[0].item(), int(j - a), m) for j in range(a, b)) % m
            assert p.stretch(pre, np.array([a]), np.array([b]))[0] == want


def sample(rng, n=400):
    words = ["a", "b", "c", "D", "é", "the", "\x00", "x-y", "中文", "New", "york", "city"]
    out = []
    for _ in range(n):
        t = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", " new york city "]) for _ in range(rng.randint(0, 30)))
        out.append((rng.choice(["en", "de", None, "und", ""]), t))
    return out + [("en", None), (None, None), ("en", ""), ("fr", "a b"), ("en", "the the the the the the the the the the the the")] + [("de", "same text here")] * 60


@pytest.mark.parametrize("bits", [64, 9, 4])
def test_random_texts(table, bits):
    docs = sample(random.Random(bits))
    assert rows_of(collocations(table(docs), bits=bits)) == brute(docs)


def test_parameters(table):
    docs = sample(random.Random(3), 150)
    assert rows_of(collocations(table(docs), max_words=4, min_count=3, best=7)) == brute(docs, 4, 3, 7)
    assert rows_of(collocations(table(docs), max_words=2, min_count=5, best=50)) == brute(docs, 2, 5, 50)


def test_nothing_to_find(table):
    assert rows_of(collocations(table([]))) == []
    assert rows_of(collocations(table([("en", "one two three"), ("en", None)]))) == []


def test_long_words_and_texts(table):
    word = "w" * 30_000
    docs = [("en", " ".join([word, "next"] * 12)), ("en", "a b c " * 50_000)]
    assert rows_of(collocations(table(docs))) == brute(docs)


def test_query(spark, sf_docs):
    docs = [(r["lang"], r["text"]) for r in sf_docs.collect()]
    got = rows_of(op13_collocations(spark, SF))
    assert got == brute(docs) and len(got) > 50
