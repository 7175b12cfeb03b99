"""Sketches of the Jaccard join never rule out a link, and screening keeps what links connect."""
import numpy as np
import pandas as pd
import pytest

from tessera.llm import jaccard_join as jj


def family(rng, sizes):
    """Sets, some of them slightly changed copies of earlier ones."""
    out = []
    for i, n in enumerate(sizes):
        t = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        if i % 3:
            old = out[int(rng.integers(len(out)))]
            t = np.concatenate([old[: len(old) - len(old) // (8 + 20 * (i % 2))], t[: len(old) // 20]])
        out.append(np.unique(t))
    return out


@pytest.mark.parametrize("num, den", [(80, 100), (90, 100), (30, 100)])
def test_screening_keeps_links(num, den):
    rng = np.random.default_rng(num)
    sets = family(rng, rng.integers(1, 900, 120))
    n = [len(s) for s in sets]
    sketch = [jj._sketch(s) for s in sets]
    pairs = [(i, j) for i in range(len(sets)) for j in range(i)]
    bits = jj._differing(pd.Series([sketch[i] for i, _ in pairs]), pd.Series([sketch[j] for _, j in pairs]))
    links, ruled_out = [], 0
    for (i, j), b in zip(pairs, bits):
        both = len(np.intersect1d(sets[i], sets[j]))
        assert b <= n[i] + n[j] - 2 * both
        if den * both >= num * (n[i] + n[j] - both):
            links.append((i, j))
        ruled_out += b * (den + num) > (n[i] + n[j]) * (den - num)
    assert links and (ruled_out > 0.5 * len(pairs) or num < 80)  # sketches say little about low similarities

    rows = pd.DataFrame({"side": 0, "vid": range(100, 100 + len(sets)), "n": n, "comp": range(100, 100 + len(sets)), "sketch": sketch})
    kept = jj._screened(num, den)(pd.concat([rows, rows.assign(side=1)]))
    assert len(kept) < len(sets)  # never all pairs
    root = {v: v for v in rows.vid}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v
    for a, b in kept.itertuples(index=False):
        root[top(a)] = top(b)
    assert all(top(100 + i) == top(100 + j) for i, j in links)
    same = rows.assign(comp=7)  # parts already joined give nothing
    assert jj._screened(num, den)(pd.concat([same, same.assign(side=1)])).empty
