"""Packing against the tokenizers library and a piece-by-piece packer."""
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm.packing import Ids, Runs, op12_packing, pack, pack_histogram, sequences

from .conftest import SF

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
LIBRARY = Tokenizer.from_file(PATH)


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [2]


def piece_by_piece(sizes, capacity):
    """Number of sequences when the rule is applied to one piece at a time."""
    one, other, bins = [], [], 0
    for s in sorted((s for s in sizes if 3 * s > capacity), reverse=True):
        fits = [g for g in one if g >= s]
        if fits:
            one.remove(min(fits))
            other.append(min(fits) - s)
        else:
            one.append(capacity - s)
            bins += 1
    other += one
    for s in sorted((s for s in sizes if 3 * s <= capacity), reverse=True):
        fits = [g for g in other if g >= s]
        if fits:
            other.remove(min(fits))
            other.append(min(fits) - s)
        else:
            other.append(capacity - s)
            bins += 1
    return bins


def check(rows, texts, capacity=1024):
    """All pieces are right, and every sequence is gapless and within the capacity."""
    by_seq, by_doc = {}, {}
    for d, piece, start, length, crc, seq, offset in rows:
        by_seq.setdefault(seq, []).append((offset, length))
        by_doc.setdefault(d, []).append((piece, start, length, crc))
    for d, text in texts:
        ids = np.array(library(text), "<u4")
        at = 0
        got = sorted(by_doc.pop(d))
        for i, (piece, start, length, crc) in enumerate(got):
            assert (piece, start) == (i, at) and crc == zlib.crc32(ids[at:at + length].tobytes())
            assert length == capacity or i == 0
            at += length
        assert at == len(ids) and (len(got) == 1 or len(ids) > capacity)
    assert not by_doc
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_seq)


ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "a b  ", "\n a\n\nb \t c", "x<|endoftext|>y z", " <|endoftext|> ", "<|endoftext|>", "it's don't 've 's",
       "a b c　d", "a\x1cb c \x1fd", "\u0085 x \u0085", "é ñ ß 12 3४", "a" * 5000, " ".join(["word"] * 4000), "ha퟿b 🙂 🙂🙂", "᠎ a​ b", "a \n", "\n a", "a, b. c; d, ", "a \x01, b", "\x01 a", "a \x01b, c", "é, ñ. x,y, 1, 2. ..., a.. b, ,"]


def test_ids_are_the_library_s():
    ids = Ids(open(PATH, "rb").read(), PATTERN)
    rng = random.Random(5)
    alphabet = ["a", "B", " ", " ", " ", "\n", "\t", " ", "1", ".", "'s", "é", "中", "🙂", "<|endoftext|>", " ", "\x1d", "\u0085", " ", " ", " "]
    texts = ODD + ["".join(rng.choices(alphabet, k=rng.randint(1, 40))) for _ in range(3000)]
    for part in (texts, texts[::-1]):
        flat, bounds = ids(pa.array(part))
        assert [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [library(t)[:-1] for t in part]


def test_every_blank_code_point():
    ids = Ids(open(PATH, "rb").read(), PATTERN)
    texts = [s for c in map(chr, [*range(0x3100), *range(0xFE00, 0x10000)]) if not "\ud800" <= c <= "\udfff"
             for s in (f"a {c}b", f"a{c} b", f"a {c} b")]
    flat, bounds = ids(pa.array(texts))
    want = [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]
    assert [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == want


@pytest.mark.parametrize("seed", range(8))
def test_histogram_packs_like_piece_by_piece(seed):
    rng = random.Random(seed)
    capacity = rng.choice([12, 30, 100, 1024])
    sizes = [rng.randint(1, rng.choice([capacity, capacity // 2, capacity // 4])) for _ in range(rng.choice([0, 1, 50, 600]))]
    sizes += [rng.randint(1, capacity)] * rng.choice([0, 1, 7, 200])
    count = {s: sizes.count(s) for s in set(sizes)}
    rows, bins = pack_histogram(count, capacity)
    assert bins == piece_by_piece(sizes, capacity) >= -(-sum(sizes) // capacity)
    runs, held = Runs(rows), {}
    for s, c in count.items():
        seq, off = runs.place(np.full(c, s), np.arange(c))
        for b, o in zip(seq.tolist(), off.tolist()):
            held.setdefault(b, []).append((o, s))
    assert sorted(held) == list(range(bins))
    for parts in held.values():
        at = 0
        for o, s in sorted(parts):
            assert o == at
            at += s
        assert at <= capacity


def test_large_pieces_are_matched_optimally():
    from functools import lru_cache
    rng = random.Random(2)
    for _ in range(30):
        sizes = tuple(sorted(rng.randint(35, 90) for _ in range(rng.randint(1, 9))))

        @lru_cache(None)
        def best(left):
            if not left:
                return 0
            return 1 + min([best(left[1:])] + [best(left[1:i] + left[i + 1:]) for i in range(1, len(left)) if left[0] + left[i] <= 100])
        assert pack_histogram({s: sizes.count(s) for s in sizes}, 100)[1] == best(sizes)


def test_odd_texts(spark, make_docs):
    rows = [*enumerate(ODD), (100, None), (None, "no id"), (101, "same text"), (102, "same text")]
    out = pack(make_docs(rows), PATH, PATTERN)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    check([tuple(r) for r in out.collect()], rows)
    repeated = pack(make_docs([(1, "a b"), (1, "a b"), (1, None)]), PATH, PATTERN, capacity=4)
    assert sorted((r["length"], r["sequence_id"], r["offset"]) for r in repeated.collect()) == [(1, 0, 3), (3, 0, 0), (3, 1, 0)]
    assert pack(make_docs([]), PATH, PATTERN).collect() == []


def test_sequences_hold_the_ids(spark, make_docs):
    rows = [(i, f"document {i} " + "word " * (i * 7)) for i in range(40)]
    got = sequences(pack(make_docs(rows), PATH, PATTERN, capacity=64, ids=True)).collect()
    ids = [r["ids"] for r in got]
    assert all(len(x) <= 64 for x in ids)
    assert sorted(i for x in ids for i in x) == sorted(i for _, t in rows for i in library(t))
    assert sorted({d for r in got for d in r["doc_ids"]}) == list(range(40))


def test_query(spark, sf_docs):
    texts = [(r["doc_id"], r["text"]) for r in sf_docs.collect()]
    used = check([tuple(r) for r in op12_packing(spark, SF).collect()], texts)
    sizes = []
    for _, t in texts:
        n = len(library(t))
        sizes += [1024] * ((n - 1) // 1024) + [(n - 1) % 1024 + 1]
    assert used == piece_by_piece(sizes, 1024)
