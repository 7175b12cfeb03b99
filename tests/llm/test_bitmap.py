"""Bitmaps of hashes: small sets get few bits, and no member is ever missed."""
import os

import numpy as np
import pytest

from tessera.llm import bitmap, decontaminate, jaccard_join


def longs(spark, values):
    return spark.createDataFrame([(int(v),) for v in values], "term long")


@pytest.mark.parametrize("bits", [6, 12, 26])
@pytest.mark.parametrize("n", [0, 1, 700])
def test_members_stay_and_few_others(spark, n, bits):
    rng = np.random.default_rng(n + bits)
    members = rng.integers(-(1 << 63), (1 << 63) - 1, n, dtype=np.int64)
    made = bitmap.make_bitmap(longs(spark, members), bits)
    assert len(made) * 64 <= 1 << bits
    assert bitmap.in_bitmap(made, members.view(np.uint64)).all()
    if bits == 26:
        assert len(made) * 64 <= 2 * bitmap.SPARE * max(n, 1)
        others = rng.integers(0, 1 << 63, 100_000, dtype=np.uint64)
        assert bitmap.in_bitmap(made, others).mean() <= 2 / bitmap.SPARE


def test_repeated_and_negative_terms(spark):
    made = bitmap.make_bitmap(longs(spark, [5, 5, -1]), 10)
    assert bitmap.in_bitmap(made, np.array([5, (1 << 64) - 1], np.uint64)).all()


@pytest.fixture
def shared(spark, monkeypatch):
    """The broadcasts made meanwhile: (path of the driver's file, its size)."""
    made, make = [], type(spark.sparkContext).broadcast

    def noted(self, value):
        b = make(self, value)
        made.append((b._path, os.path.getsize(b._path)))
        return b
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", noted)
    return made


TEXTS = [" ".join(f"w{(i * 7 + j) % 97}x{i % 5}" for j in range(60)) for i in range(12)]


def near(make_docs, spark):
    return jaccard_join.components(make_docs(TEXTS + TEXTS[:3] + [TEXTS[4] + " tail"]), n=3)


def cut(make_docs, spark):
    from tessera.llm.suffix_array import duplicate_ranges
    return duplicate_ranges(make_docs(TEXTS + TEXTS[:3]))


def clean(make_docs, spark):
    items = spark.createDataFrame([(1, TEXTS[0][:200])], "item_id long, text string")
    return decontaminate.contamination(make_docs(TEXTS), items)


@pytest.mark.parametrize("query", [near, cut, clean])
def test_broadcasts_are_small_and_go(spark, make_docs, shared, query):
    out = query(make_docs, spark)
    assert shared
    assert max(size for _, size in shared) < 1 << 20  # 8 MB and 16 MB before
    assert not [p for p, _ in shared if os.path.exists(p)]
    assert out.collect()  # what is returned reads none of them
