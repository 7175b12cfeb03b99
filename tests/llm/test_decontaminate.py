import hashlib
import random
import re

from tessera.llm.decontaminate import decontaminate, op10_decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute(docs, items, window=13):
    wins = {}
    for iid, t in items:
        w = WORD.findall(low(t))
        for s in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[s:s + window]), set()).add(iid)
    sizes = {len(w) for w in wins}
    out = []
    for did, t in docs:
        w = WORD.findall(low(t))
        hit, found = set(), set()
        for k in sizes:
            for s in range(len(w) - k + 1):
                if (m := wins.get(tuple(w[s:s + k]))):
                    hit.update(range(s, s + k))
                    found |= m
        ids = sorted(map(str, found))
        out.append((did, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_matches_brute_force_on_the_tables(spark):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute(docs, items)
    assert rows(op10_decontaminate(spark, sf)) == want
    assert any(r[5] for r in want)


def test_edge_cases(spark, make_docs):
    rng = random.Random(1)
    voc = ["Aa", "bé", "c3", "dd", "ee"]
    items = [(1, " ".join(rng.choice(voc) for _ in range(20))), (10, "aa bé"), (2, None), (3, " -- "), (4, "aa bé"), (5, "q" * 3000)]
    docs = [(1, None), (2, ""), (3, "aa-BÉ aa bé"), (3, "aa bé"), (3, "aa bé"), (None, "x aa bé y"), (4, items[0][1] + " zz " + items[0][1]), (5, "q" * 3000)]
    docs += [(100 + i, " ".join(rng.choice(voc) for _ in range(rng.choice([1, 12, 13, 200])))) for i in range(30)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert rows(decontaminate(make_docs(docs), bench)) == brute(docs, items)
    assert rows(decontaminate(make_docs(docs), bench.limit(0))) == brute(docs, [])
    assert rows(decontaminate(make_docs(docs).limit(0), bench)) == []


def test_proximity(spark, make_docs):
    bench = spark.createDataFrame([(1, "one two three four")], "item_id long, text string")
    d = make_docs(["one two x three four", "one x x x x two three four", "one two three four"])
    got = {r["doc_id"]: r["n_items"] for r in decontaminate(d, bench, slop=1).collect()}
    assert got == {0: 1, 1: 0, 2: 1}
