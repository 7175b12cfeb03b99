import itertools
import random
import zlib

import numpy as np

from tessera.llm import toxicity
from tessera.llm.toxicity import DECAY, LENGTH, Classifier, TextKernel, op3_toxicity, score, subsequence_kernel, train, units_of


def brute_kernel(s, t):
    total = 0.0
    for a in itertools.combinations(range(len(s)), LENGTH):
        for b in itertools.combinations(range(len(t)), LENGTH):
            if all(s[i] == t[j] for i, j in zip(a, b)):
                total += DECAY ** (a[-1] - a[0] + 1 + b[-1] - b[0] + 1)
    return total


def codes(w, width):
    return np.array([[ord(c) for c in w] + [-1] * (width - len(w))])


def test_kernel_equals_its_definition():
    rng = random.Random(1)
    for _ in range(40):
        s, t = ("".join(rng.choice("abc") for _ in range(rng.randrange(1, 8))) for _ in range(2))
        assert np.isclose(subsequence_kernel(codes(s, 9), codes(t, 8))[0], brute_kernel(s, t))


def test_units_tolerate_insertions():
    assert "^idiot" in units_of("You id*iot!") and "^idiot" in units_of("such an i d i o t here") and "^stupid" in units_of("S-t-u-p-i-d")
    assert units_of("") == set() and units_of(" -- ") == set()
    assert all(len(u) <= toxicity.LONGEST for u in units_of("x" * 1000))


def test_held_out_quality_and_obfuscation(spark):
    sf = "/root/testdata/sf0.1"
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op3_toxicity(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
               and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [(truth[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    hits = sum(p for y, p in held if y)
    assert hits / sum(y for y, _ in held) > 0.88, "recall"
    assert sum(p for y, p in held if not y) / sum(1 - y for y, _ in held) < 0.01, "false alarms"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = train(docs, labels)
    clean = "Thatea anou esreer to it eran for nder thatorwh reorou of the oresre"
    k = TextKernel(model.landmarks)
    s = model.score(k([clean, clean + " idiot moron", clean + " idxiot and st-upid", clean + " i d i o t m.o.r.o.n", ""]))
    assert s[0] < 0.3 and s[4] < 0.3 and (s[1:4] >= 0.3).all(), s


def test_edges(spark, make_docs, monkeypatch):
    monkeypatch.setattr(toxicity, "MEMO", 20)
    rng = random.Random(7)
    voc = [f"{a}{b}{c}" for a, b, c in itertools.product(["pla", "mer", "ton"], ["ki", "ro", "sa"], ["", "n", "l"])]
    docs, labels = [], []
    for i in range(200):
        bad = i % 4 == 0
        docs.append((i, " ".join(rng.choice(voc) for _ in range(30)) + (" scoundrel" if bad else "")))
        labels.append((i, int(bad)))
    docs += [(900, None), (901, ""), (902, "x" * 100_000), (903, "a scoundrel, a scoundrel"), (903, "a scoundrel, a scoundrel"), (None, "q")]
    labels += [(None, 1), (5, None), (5, 0), (901, 0)]
    d = make_docs(docs)
    y = spark.createDataFrame([(i, t, 9) for i, t in labels], "doc_id long, toxic int, score int")
    model = train(d, y)
    got = score(d, model, keep=["doc_id", "source"]).collect()
    assert len(got) == len(docs)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r["score"])
    assert all(by[i][0] >= 0.3 for i in range(0, 200, 4)) and all(by[i][0] < 0.3 for i in range(200) if i % 4)
    assert by[900] == by[901] and by[900][0] < 0.3 and min(by[903]) >= 0.3
    assert score(d.limit(0), model).collect() == []
    none = train(d, y.limit(0))
    assert {r["score"] for r in score(d, none).collect()} == {0.0}
    assert isinstance(train(d, y.filter("toxic = 1")), Classifier)


def test_units_by_patterns():
    """The units as regular expressions state them."""
    import random
    import re
    from tessera.llm.toxicity import MARK, _pieces, units_of
    spaced = re.compile(r"(?<!\S)\w(?:\s+\w(?!\S)){2,}")
    rng = random.Random(8)
    letters = ["a", "B", "é", "_", "1", ".", "*", " ", " ", " ", "\n", "\xa0", "\x1c", "id", "iot", "²", "x" * 30, "- "]
    for _ in range(3000):
        text = "".join(rng.choices(letters, k=rng.randint(0, 25)))
        low, want = text.lower(), set()
        for c in re.findall(r"\S+", low):
            want.update(_pieces(c))
        for m in spaced.finditer(low):
            want.update(_pieces(m[0]))
        want.discard(MARK)
        assert units_of(text) == want, text
