import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tessera.llm import bpe, token_counts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def json_library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(open(RANKS, "rb").read(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(open(JSON, "rb").read(), public_tokenizers.PATTERN)


def strange():
    rng = random.Random(2)
    out = ["", " ", "\n\n \t x", "it's we'll I'D", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "é" * 700, "ab" * 900, "=" * 1000, " " * 3000 + "x", "a" * 257, "😀👍🏽 x́", "\x00\x1c\x1d\x1e\x1f\x85᠎​ 　"]
    for _ in range(300):
        out.append("".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(32, 127), rng.randrange(0xA0, 0x500), rng.randrange(0x4E00, 0x9FFF), 32, 32, 10])) for _ in range(rng.randrange(1, 80))))
    return out


def ids_of(coded):
    return np.frombuffer(coded, "<u4").tolist()


def test_codec_equals_the_library(codec, library, sf_docs):
    texts = strange() + [r["text"] for r in sf_docs.select("text").collect()]
    for t, c in zip(texts, codec.encode(texts)):
        assert ids_of(c) == library.encode_ordinary(t), t[:60]
        assert codec.decode(c) == t.encode()


def every_character():
    for lo in range(0, 0x110000, 500):
        yield "".join(f"a{chr(c)}{chr(c)} {chr(c)}1 {chr(c)}  {chr(c)}" for c in range(lo, min(lo + 500, 0x110000)) if not 0xD800 <= c < 0xE000)


def test_every_character(codec, counter, library, json_library):
    texts = list(every_character())
    bad = [i for i, (t, c) in enumerate(zip(texts, codec.encode(texts))) if ids_of(c) != library.encode_ordinary(t)]
    assert not bad
    want = [len(e.ids) for e in json_library.encode_batch(texts, add_special_tokens=False)]
    assert counter.count(texts) == want


def test_counts_equal_the_library(counter, json_library, sf_docs):
    texts = strange() + [r["text"] for r in sf_docs.select("text").collect()]
    assert counter.count(texts) == [len(e.ids) for e in json_library.encode_batch(texts, add_special_tokens=False)]
    assert len(counter.proven) > 40_000


def test_memo_is_bounded(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 50)
    texts = strange()[-40:]
    assert [ids_of(c) for c in codec.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_queries(spark, make_docs, library, json_library):
    docs = [(i, t) for i, t in enumerate(strange()[:40])] + [(None, None), (3, "dup"), (3, "dup")]
    got = sorted((tuple(r) for r in bpe.encode_digests(make_docs(docs), RANKS, public_tokenizers.PATTERN).collect()), key=str)
    want = []
    for d, t in docs:
        ids = library.encode_ordinary(t or "")
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    back = bpe.decode(bpe.encode(make_docs(docs), RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    assert sorted((r["doc_id"], bytes(r["bytes"])) for r in back.collect() if r["doc_id"] is not None) == sorted((d, (t or "").encode()) for d, t in docs if d is not None)
    n = sorted((tuple(r) for r in token_counts.token_counts(make_docs(docs), JSON, public_tokenizers.PATTERN, limit=100).collect()), key=str)
    want = []
    for d, t in docs:
        k = len(json_library.encode(t or "", add_special_tokens=False).ids)
        want.append((d, len((t or "").encode()), k, k > 100))
    assert n == sorted(want, key=str)
    empty = make_docs(docs).limit(0)
    assert bpe.encode_digests(empty, RANKS, public_tokenizers.PATTERN).count() == 0
    assert token_counts.token_counts(empty, JSON, public_tokenizers.PATTERN).count() == 0
