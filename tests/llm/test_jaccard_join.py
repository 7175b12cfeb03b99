import random
import re

import numpy as np
import pytest

from tessera.llm.jaccard_join import Levels, jaccard_components, op9_jaccard_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs):
    sets = []
    for _, t in docs:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set()))
    up = list(range(len(docs)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    holders = {}
    for i, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(i)
    for i, s in enumerate(sets):
        count = {}
        for g in s:
            for j in holders[g]:
                if j < i:
                    count[j] = count.get(j, 0) + 1
        for j, c in count.items():
            if 100 * c >= 90 * (len(s) + len(sets[j]) - c):
                up[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return sorted([(d, len(s), low.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(docs, sets))], key=str)


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_matches_brute_force_on_the_tables(spark):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(docs)
    assert rows(op9_jaccard_join(spark, sf)) == want
    assert any(r[0] != r[2] for r in want)


def family(rng, n, edits, length):
    base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
    out = [" ".join(base)]
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(1, edits + 1)):
            i = rng.randrange(len(w))
            r = rng.random()
            if r < .5:
                w[i] = f"x{rng.randrange(10**6)}"
            elif r < .75:
                w.insert(i, "ins")
            else:
                del w[i]
        out.append(" ".join(w))
    return out


def test_families_and_edges(spark, make_docs):
    rng = random.Random(5)
    texts = [None, "", "  \t", "a", "A", "a b", "a b", "a b c", "a B c", "a b c d"]
    for length in (9, 10, 11, 12, 20, 60, 100, 300):
        texts += family(rng, 12, max(1, length // 30), length)
    texts += family(rng, 60, 6, 80)  # parts that only chains join
    long = family(rng, 2, 3, 20000)
    texts += long + [long[0]]
    docs = list(enumerate(texts)) + [(3, texts[20]), (None, "a b c")]
    rng.shuffle(docs)
    assert rows(jaccard_components(make_docs(docs))) == brute(docs)
    assert rows(jaccard_components(make_docs(docs).limit(0))) == []


def test_blocks_of_a_cluster(spark, make_docs, monkeypatch):
    from tessera.llm import jaccard_join
    monkeypatch.setattr(jaccard_join, "BLOCK", 7)
    rng = random.Random(8)
    docs = list(enumerate(family(rng, 80, 5, 70) + family(rng, 40, 3, 45)))
    assert rows(jaccard_components(make_docs(docs))) == brute(docs)


def keys_of(levels, sets):
    flat = [np.sort(np.array(list(s), np.uint64)) for s in sets]
    size = np.array([len(s) for s in flat])
    who, key = levels.keys(np.repeat(np.arange(len(sets)), size), np.concatenate(flat), size)
    out = [set() for _ in sets]
    for w, k in zip(who.tolist(), key.tolist()):
        out[w].add(k)
    return out


@pytest.mark.parametrize("num", [50, 80, 90, 95])
def test_linked_sets_share_a_key(num):
    """Pairs at the very threshold, short sets above all: there the proof is tightest."""
    rng, levels, sets = random.Random(num), Levels(num, 100), []
    for _ in range(3000):
        both, a, b = rng.choice([rng.randint(1, 30), rng.randint(1, 300)]), 0, 0
        while 100 * both >= num * (both + a + b + 1):
            a, b = (a + 1, b) if rng.random() < .5 else (a, b + 1)
        new = [rng.getrandbits(64) for _ in range(both + a + b)]
        sets += [set(new[:both + a]), set(new[:both] + new[both + a:])]
    keys = keys_of(levels, sets)
    assert all(x & y for x, y, s, t in zip(keys[::2], keys[1::2], sets[::2], sets[1::2]) if s != t)


@pytest.mark.parametrize("num", [80, 90])
def test_unrelated_sets_share_no_key(num):
    rng = random.Random(3)
    keys = keys_of(Levels(num, 100), [{rng.getrandbits(64) for _ in range(rng.randint(1, 500))} for _ in range(2000)])
    assert len(set().union(*keys)) == sum(map(len, keys))


@pytest.mark.parametrize("num", [50, 80, 90, 95])
def test_linked_sets_share_one_of_their_rarest_keys(num):
    """By any order of the keys; those that only one set holds leave less room."""
    rng, levels, flat = random.Random(num), Levels(num, 100), []
    for _ in range(1500):
        both, a, b = rng.choice([rng.randint(1, 30), rng.randint(1, 300)]), 0, 0
        while 100 * both >= num * (both + a + b + 1):
            a, b = (a + 1, b) if rng.random() < .5 else (a, b + 1)
        new = [rng.getrandbits(64) for _ in range(both + a + b)]
        flat += [np.sort(np.array(x, np.uint64)) for x in (new[:both + a], new[:both] + new[both + a:])]
    size = np.array([len(s) for s in flat])
    who, key, kind, room = levels.keys(np.repeat(np.arange(len(flat)), size), np.concatenate(flat), size, ranked=True)
    held = [{} for _ in flat]
    for w, k, c, r in zip(who.tolist(), key.tolist(), kind.tolist(), room.tolist()):
        held[w].setdefault(c, (r, []))[1].append(k)
    count, dropped = dict(zip(*[x.tolist() for x in np.unique(key, return_counts=True)])), 0
    first = []
    for x in held:
        first.append(set())
        for r, keys in x.values():
            first[-1].update(sorted(keys, key=lambda k: (count[k], k))[:r])
            dropped += len(keys) > r
    assert dropped > 100
    assert all(x & y for x, y, s, t in zip(first[::2], first[1::2], flat[::2], flat[1::2]) if s.tolist() != t.tolist())


def test_common_passages_chain_no_clusters(spark, make_docs, monkeypatch):
    """Texts that only have a few lines in common are not compared block by block."""
    from tessera.llm import jaccard_join
    rng, made = random.Random(9), []
    blocks = jaccard_join._blocks
    monkeypatch.setattr(jaccard_join, "_blocks", lambda *a: made.append(1) or blocks(*a))
    lines = [" ".join(f"c{i}x{j}" for j in range(12)) for i in range(6)]
    texts = [" ".join([*rng.sample(lines, 2), *(f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(20, 60)))]) for _ in range(300)]
    docs = list(enumerate(texts + family(rng, 12, 2, 60)))
    assert rows(jaccard_components(make_docs(docs))) == brute(docs)
    assert not made


def test_large_groups_block_by_block(spark, make_docs, monkeypatch):
    from tessera.llm import jaccard_join
    for name, size in (("SMALL", 2), ("SCREEN", 9), ("BLOCK", 5)):
        monkeypatch.setattr(jaccard_join, name, size)
    rng, made = random.Random(10), []
    blocks = jaccard_join._blocks
    monkeypatch.setattr(jaccard_join, "_blocks", lambda *a: made.append(1) or blocks(*a))
    docs = list(enumerate(family(rng, 70, 6, 70) + family(rng, 40, 4, 45)))
    assert rows(jaccard_components(make_docs(docs))) == brute(docs)
    assert len(made) == 2


def test_component_rounds_have_no_joins(spark):
    """The driver holds the plan of each round: one scan, no join."""
    from tessera.functions import components
    e = spark.createDataFrame([(2, 1), (3, 2)], "a long, b long")
    plan = components._small_star(components._large_star(e)).distinct()._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Scan") == 1
