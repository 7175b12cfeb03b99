"""The manifest against a plain tree."""
import hashlib
import random
import zlib

import pytest

from tessera.llm import manifest as m
from pyspark.sql import functions as F

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """(root, siblings (left, right) of each node, level by level)."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, a in enumerate(at):
            lo = a - a % 8
            proofs[i].append(("".join(nodes[lo:a]), "".join(nodes[a + 1:lo + 8])))
        nodes = [h(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]
        at = [a // 8 for a in at]
    return nodes[0], proofs


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)"""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    out, subs = [], []
    for g in names:
        inside = sorted(groups[g], key=lambda r: (-(1 << 63) if r[0] is None else r[0], leaf(r)))
        sub, proofs = tree([leaf(r) for r in inside])
        subs.append(sub)
        out.append((inside, sub, proofs))
    if not subs:
        return []
    root, above = tree(subs)
    res = []
    for (inside, sub, proofs), up in zip(out, above):
        for r, p in zip(inside, proofs):
            p = p + up
            bad = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                bad = (*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))
            x = leaf(bad)
            for a, b in p:
                x = h(a, x, b)
            res.append((r[0], leaf(r), sub, root, h(*(a + b for a, b in p)), x, x == root))
    return res


def key(rows):
    return sorted(map(str, map(tuple, rows)))


@pytest.fixture(scope="module")
def query(spark, tmp_path_factory):
    def run(rows):
        path = str(tmp_path_factory.mktemp("manifest"))
        spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, uid long, grp string, place long") \
            .repartition(3).write.parquet(f"{path}/documents.parquet")
        got = m.op11_manifest(spark, path)
        assert got.columns == COLUMNS
        return got.collect()
    return run


@pytest.mark.parametrize("n", [0, 1, 2, 8, 9, 64, 65, 520, 1300])
def test_sizes(query, n):
    rng = random.Random(n)
    ids = rng.sample(range(-3 * n, 10**rng.choice([3, 6, 18]) + n), n)
    rows = [(i, rng.choice(["a", None, ""]), rng.choice(["en", "de", None, "", "é"][:rng.choice([1, 5])]), rng.choice([None, 5]), rng.choice([None, "", "Abc é", "abc", "X" * 50])) for i in ids]
    assert key(query(rows)) == key(brute(rows))


def test_repeated_and_null_ids(query):
    rng = random.Random(1)
    rows = [(rng.choice([None, 1, 2, 3, 70, -(1 << 63), (1 << 63) - 1]), "s", rng.choice(["en", None]), 1, rng.choice(["A", "b", "C"])) for _ in range(300)]
    rows += [(7, "s", "en", 1, "Same")] * 200
    assert key(query(rows)) == key(brute(rows))


def test_many_groups(query):
    rows = [(i, "s", f"lang{i % 150}", i, f"Text {i}") for i in range(400)]
    assert key(query(rows)) == key(brute(rows))


def test_directory_levels(spark, query, monkeypatch):
    monkeypatch.setattr(m, "TOP", 2)
    monkeypatch.setattr(m, "FAN_BITS", 2)
    rng = random.Random(9)
    rows = [(rng.randint(-2000, 4000), "s", rng.choice(["en", "de"]), 1, f"T{i}") for i in range(500)]
    assert key(query(rows)) == key(brute(rows))


def test_very_long_text(query):
    rows = [(3, "s", "en", 2_000_000, "Ab " * 700_000), (4, "s", "en", 1, "")]
    assert key(query(rows)) == key(brute(rows))


def test_whole_table(spark):
    path = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = m.op11_manifest(spark, path).collect()
    assert key(got) == key(brute(rows))
    assert 0 < sum(r["verified"] for r in got) < len(got)


def test_a_changed_leaf_breaks_only_its_proof(spark):
    docs = spark.range(100).select(F.col("id"), F.concat(F.lit("t"), F.col("id")).alias("t"), F.lit("g").alias("g"))
    rows = m.manifest(docs, m.digest(F.col("id"), F.col("t")), group=F.col("g"), id_=F.col("id"))
    good = rows.select((m.fold(F.col("leaf"), F.col("proof")) == F.col("root")).alias("ok"), "place", "id").collect()
    assert all(r["ok"] and r["place"] == r["id"] for r in good) and len(good) == 100
    assert rows.filter(m.fold(m.digest(F.lit("other")), F.col("proof")) == F.col("root")).count() == 0
