import hashlib
import random
import zlib

from tessera.llm import sharding
from tessera.llm.sharding import minimax_cuts, op1_sharding, running_sizes, shard


def greedy(sizes, capacity):
    n, left = 1, capacity
    for s in sizes:
        if s > capacity:
            return 10**9
        if s > left:
            n, left = n + 1, capacity
        left -= s
    return n


def smallest(sizes, shards):
    low, high = 0, sum(sizes)
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (low, mid) if greedy(sizes, mid) <= shards else (mid, high)
    return high


def check(docs, rows, shards=16):
    size = {}
    for _, t in docs:
        k = hashlib.sha256((t or "").encode()).hexdigest()
        size[k] = size.get(k, 0) + len((t or "").encode()) + 1
    ordered = [size[k] for k in sorted(size)]
    got = sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in rows), key=str)
    assert got == sorted(((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in docs), key=str)
    loads, slots, home = {}, {}, {}
    for r in rows:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
        loads[r["shard"]] = loads.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert home.setdefault((r["size"], r["text_crc32"]), r["shard"]) == r["shard"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if docs:
        assert max(loads.values()) == smallest(ordered, shards)


def test_query_is_minimax(spark):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(docs, op1_sharding(spark, sf).collect())


def test_edges(spark, make_docs):
    rng = random.Random(4)
    docs = [(None, None), (1, ""), (1, "a"), (1, "a"), (2, "é" * 500), (None, "a")]
    check(docs, shard(make_docs(docs)).collect())
    docs += [(i, "copy" * 30) for i in range(80)] + [(i, "x" * rng.randrange(400)) for i in range(100, 220)] + [(500, "z" * 30000)]
    check(docs, shard(make_docs(docs)).collect())
    check(docs, shard(make_docs(docs), shards=3).collect(), 3)
    assert shard(make_docs(docs).limit(0)).collect() == []


def test_search_over_coarse_summaries(spark, monkeypatch):
    """With few buckets the search needs several rounds and must stay exact."""
    monkeypatch.setattr(sharding, "BUCKETS", 16 ** 3 + 1000)
    rng = random.Random(9)
    for shards in (1, 2, 5, 16):
        sizes = [rng.choice([rng.randrange(1, 50), rng.randrange(1, 5000), 10**9]) for _ in range(700)]
        groups = spark.createDataFrame([(f"{i:08x}", s) for i, s in enumerate(sizes)], "key string, size long")
        capacity, ends = minimax_cuts(running_sizes(groups), shards)
        assert capacity == smallest(sizes, shards)
        assert ends[-1] == sum(sizes) and len(ends) <= shards
        assert max(b - a for a, b in zip([0, *ends], ends)) == capacity
