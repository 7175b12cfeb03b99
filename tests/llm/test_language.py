import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm import language
from tessera.llm.language import END, ORDER, START, identify, op7_language_id, train, words_of


def brute_model(texts):
    """Interpolated Kneser-Ney over plain dictionaries."""
    counts = {ORDER: Counter()}
    for t in texts:
        for w in words_of(t):
            p = START * (ORDER - 1) + w + END
            counts[ORDER].update(p[i:i + ORDER] for i in range(len(w) + 1))
    for k in range(ORDER - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    return counts


def brute_prob(counts, letters, gram, k=ORDER):
    if k == 0:
        return 1 / (letters + 1)
    g = gram[len(gram) - k:]
    lower = brute_prob(counts, letters, gram, k - 1)
    c = counts[k]
    n1, n2 = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
    d = min(n1 / (n1 + 2 * n2), 0.95) if n1 else 0.5
    after = {x: v for x, v in c.items() if x[:-1] == g[:-1]}
    total = sum(after.values())
    if not total:
        return lower
    return max(c[g] - d, 0) / total + d * len(after) / total * lower


def test_probabilities_equal_plain_kneser_ney(spark):
    texts = ["the cat sat on the mat", "the dog ate the cat", "a bat"]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)] + [(9, "Über", "de")], "doc_id long, text string, lang string")
    model = train(df)
    counts = brute_model(texts)
    both = set(counts[1]) | set(brute_model(["Über"])[1])
    grams = ["the" + END, START + "ca" + "t", "zzzz", START * 3 + "t", "e" + "at" + "x"]
    got = model.log_prob(grams)[:, model.langs.index("en")]
    assert np.allclose(got, [math.log(brute_prob(counts, len(both), g)) for g in grams], rtol=1e-5)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op7_language_id(spark, sf).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    assert len(held) > 100
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97


def test_edges(spark, make_docs, monkeypatch):
    monkeypatch.setattr(language, "MEMO", 5)
    rng = random.Random(1)
    docs = make_docs([None, "", "123 _ ! ² Ⅷ", "the cat", "the cat", (None, "the cat"), " ".join(rng.choice(["the", "cat", "ß"]) for _ in range(60000))])
    model = train(docs)
    got = identify(docs, model).collect()
    assert sorted(r["lang_pred"] for r in got) == ["en"] * 4 + ["und"] * 3
    assert all((r["score"] == 0) == (r["lang_pred"] == "und") for r in got)
    nothing = train(docs.limit(0))
    assert {r["lang_pred"] for r in identify(docs, nothing).collect()} == {"und"}
    assert identify(docs.limit(0), model).collect() == []


def test_foreign_texts_are_rejected(spark, make_docs):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["the", "cat", "sat", "on", "a", "mat"]) for _ in range(50)) for _ in range(200)]
    docs = make_docs([*texts, "xqzv jjkw pfffg qqq " * 10])
    model = train(docs.filter("doc_id < 200"))
    from pyspark.sql import functions as F
    got = {r["doc_id"]: r["rejected"] for r in identify(docs, model, F.col("doc_id") < 200).collect()}
    assert got[200] and sum(got[i] for i in range(200)) <= 1
