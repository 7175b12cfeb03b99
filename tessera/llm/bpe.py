"""Byte-level BPE encoding and decoding with segment trees.

Every pre-token (a match of the split pattern) is merged on its own.  A segment tree over its
byte positions holds at leaf i the rank of the pair that starts there, and at every inner node
the smallest (rank, position) below: the root is the leftmost pair of smallest rank.  A merge
takes the root, joins the two live neighbours and makes three point updates (the pair before,
the pair itself, the pair swallowed), each logarithmic in the length.

``Merger.encode_many`` merges many pre-tokens in step: one tree per row of an array, one merge
per row and round, so numpy does the point updates of all rows at once.  Long pre-tokens
(over ``WIDE`` bytes) get a tree of their own in plain lists; both follow the same rule.

Texts are read whole, in blocks; a bounded memo keeps the ids of recent pre-tokens.  Only the
vocabulary file (of fixed size) is broadcast.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import ship_package
from .textnum import docs, kept

WIDE = 256
MEMO = 400_000
NONE = np.int64(1) << np.int64(60)
BLOCK_CHARS = 1 << 20


class Merger:
    """BPE merges.  ``pairs``: (left id, right id, rank) rows; ``made``: id that the merge of
    each rank makes; ``byte_ids``: id of each single byte."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, made: np.ndarray, byte_ids: np.ndarray):
        self.made, self.byte_ids = made.astype(np.int64), byte_ids.astype(np.int64)
        bits = max(4, int(4 * max(1, len(left))).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NONE, np.int64)
        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        slot, todo = self._slot(key), np.arange(len(key))
        while len(todo):  # open addressing, all pairs of a round at once
            s = slot[todo]
            free = self.keys[s] < 0
            self.keys[s[free]] = key[todo[free]]
            done = self.keys[s] == key[todo]
            self.ranks[s[done]] = rank[todo[done]]
            todo = todo[~done]
            slot[todo] = (slot[todo] + 1) & self.mask
        self.lookup = dict(zip(key.tolist(), rank.tolist()))

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 32) | right
        slot = self._slot(key)
        out = np.full(len(key), NONE, np.int64)
        todo = np.arange(len(key))
        while len(todo):
            held = self.keys[slot[todo]]
            hit = held == key[todo]
            out[todo[hit]] = self.ranks[slot[todo[hit]]]
            todo = todo[~hit & (held >= 0)]
            slot[todo] = (slot[todo] + 1) & self.mask
        return out

    # ------------------------------------------------------------- many trees in step
    def _rows(self, pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in order, count per piece) for pieces of at most ``width`` bytes."""
        n = len(pieces)
        lens = np.fromiter(map(len, pieces), np.int64, n)
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        place = np.arange(width)
        inside = place < lens[:, None]
        tok = np.zeros((n, width), np.int64)
        tok[inside] = self.byte_ids[flat]
        nxt = np.broadcast_to(place + 1, (n, width)).copy()
        prv = np.broadcast_to(place - 1, (n, width)).copy()
        tree = np.full((n, 2 * width), NONE, np.int64)
        paired = np.flatnonzero((place + 1 < lens[:, None]).ravel())
        flat_tok = tok.ravel()
        rank = self.rank_of(flat_tok[paired], flat_tok[paired + 1])
        row, col = paired // width, paired % width
        tree[row, width + col] = np.where(rank < NONE, rank * width + col, NONE)
        s = width // 2
        while s:
            np.minimum(tree[:, 2 * s:4 * s:2], tree[:, 2 * s + 1:4 * s:2], out=tree[:, s:2 * s])
            s //= 2
        alive = inside.ravel().copy()
        tree, nxt, prv = tree.ravel(), nxt.ravel(), prv.ravel()
        act = np.flatnonzero(tree[1::2 * width] < NONE)
        while len(act):
            at, root = act * width, act * (2 * width)
            best = tree[root + 1]
            i = best % width
            j = nxt[at + i]
            k, p = nxt[at + j], prv[at + i]
            new = self.made[best // width]
            flat_tok[at + i] = new
            nxt[at + i] = k
            alive[at + j] = False
            has_k, has_p = k < lens[act], p >= 0
            prv[(at + k)[has_k]] = i[has_k]
            after = np.full(len(act), NONE, np.int64)
            after[has_k] = self.rank_of(new[has_k], flat_tok[(at + k)[has_k]])
            before = self.rank_of(flat_tok[(at + p)[has_p]], new[has_p])
            tree[root + width + i] = np.where(after < NONE, after * width + i, NONE)
            tree[root + width + j] = NONE
            pp = p[has_p]
            tree[root[has_p] + width + pp] = np.where(before < NONE, before * width + pp, NONE)
            for base, leaf in ((root, j), (root, i), (root[has_p], pp)):
                node = (width + leaf) >> 1
                while len(node) and node[0] >= 1:
                    c = base + 2 * node
                    tree[base + node] = np.minimum(tree[c], tree[c + 1])
                    node >>= 1
            act = act[tree[root + 1] < NONE]
        return flat_tok[alive], alive.reshape(n, width).sum(1)

    # ------------------------------------------------------------- one long pre-token
    def _one(self, piece: bytes) -> list[int]:
        n, rank = len(piece), self.lookup.get
        tok = [int(self.byte_ids[b]) for b in piece]
        width = 1 << (n - 1).bit_length()
        far = 1 << 60
        tree = [far] * (2 * width)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))

        def leaf(a: int, b: int) -> int:
            r = rank(tok[a] << 32 | tok[b])
            return far if r is None else r * width + a
        for a in range(n - 1):
            tree[width + a] = leaf(a, a + 1)
        for x in range(width - 1, 0, -1):
            tree[x] = min(tree[2 * x], tree[2 * x + 1])

        def put(a: int, v: int) -> None:
            x = width + a
            tree[x] = v
            x >>= 1
            while x:
                l, r = tree[2 * x], tree[2 * x + 1]
                v = l if l < r else r
                if tree[x] == v:
                    return
                tree[x] = v
                x >>= 1
        dead = bytearray(n)
        while tree[1] < far:
            best, i = divmod(tree[1], width)
            j = nxt[i]
            k, p = nxt[j], prv[i]
            tok[i] = int(self.made[best])
            nxt[i] = k
            dead[j] = 1
            put(j, far)
            if k < n:
                prv[k] = i
                put(i, leaf(i, k))
            else:
                put(i, far)
            if p >= 0:
                put(p, leaf(p, i))
        return [t for t, d in zip(tok, dead) if not d]

    def encode_many(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece, merged on its own."""
        out: list = [None] * len(pieces)
        by: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if len(p) > WIDE:
                out[i] = np.array(self._one(p), np.int64)
            elif len(p) < 2:
                out[i] = self.byte_ids[np.frombuffer(p, np.uint8)]
            else:
                by.setdefault(1 << (len(p) - 1).bit_length(), []).append(i)
        for width, idx in by.items():
            step = max(1, (1 << 19) // width)
            for s in range(0, len(idx), step):
                part = idx[s:s + step]
                ids, count = self._rows([pieces[i] for i in part], width)
                for i, x in zip(part, np.split(ids, np.cumsum(count)[:-1])):
                    out[i] = x
        return out


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes -> rank of a rank file (one base64 token and its rank per line)."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


def rank_merger(ranks: dict[bytes, int]) -> Merger:
    """Any two tokens whose bytes together are a token can merge, at that token's rank."""
    left, right, rank = [], [], []
    for token, r in ranks.items():
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None:
                left.append(a)
                right.append(b)
                rank.append(r)
    made = np.arange(max(ranks.values()) + 1)
    byte_ids = np.array([ranks[bytes([b])] for b in range(256)])
    return Merger(np.array(left), np.array(right), np.array(rank), made, byte_ids)


class Codec:
    """Encoder and decoder for a rank file and a split pattern."""

    def __init__(self, data: bytes, pattern: str):
        import regex
        self.ranks = read_ranks(data)
        self.split = regex.compile(pattern).findall
        self.merger = rank_merger(self.ranks)
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for token, r in self.ranks.items():
            self.bytes_of[r] = token
        self.memo: dict[str, bytes] = {}

    def learn(self, pieces: set[str]) -> None:
        """Put the ids (little-endian unsigned 32-bit) of new pre-tokens into the memo."""
        rest = []
        for p in pieces:
            r = self.ranks.get(p.encode())
            if r is None:
                rest.append(p)
            else:
                self.memo[p] = r.to_bytes(4, "little")
        for p, ids in zip(rest, self.merger.encode_many([p.encode() for p in rest])):
            self.memo[p] = ids.astype("<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each whole text as little-endian unsigned 32-bit integers."""
        split = [self.split(t) for t in texts]
        every = set().union(*split)
        new = every.difference(self.memo)
        if len(self.memo) + len(new) > MEMO:
            self.memo.clear()
            new = every
        self.learn(new)
        get = self.memo.__getitem__
        return [b"".join(map(get, s)) for s in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def shared_codec(shared, pattern: str) -> Codec:
    """One codec per worker process and vocabulary."""
    data = shared.value
    return kept(("codec", hashlib.sha256(data).digest(), pattern), lambda: Codec(data, pattern))


def text_blocks(col: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) for runs of whole texts of about BLOCK_CHARS characters; null: empty."""
    n, lo = len(col), 0
    while lo < n:
        texts, size = [], 0
        while lo + len(texts) < n and (not texts or size < BLOCK_CHARS):
            t = col[lo + len(texts)].as_py() or ""
            texts.append(t)
            size += len(t)
        yield lo, texts
        lo += len(texts)


def _encoded(shared, pattern: str, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared_codec(shared, pattern)
        for batch in batches:
            for lo, texts in text_blocks(batch.column(1)):
                coded = codec.encode(texts)
                ids = batch.column(0).slice(lo, len(texts))
                count = pa.array([len(c) // 4 for c in coded], pa.int64())
                if digests:
                    yield pa.RecordBatch.from_arrays(
                        [ids, count, pa.array([hashlib.sha256(c).hexdigest() for c in coded]),
                         pa.array([hashlib.sha256(codec.decode(c)).hexdigest() for c in coded])], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                else:
                    values = np.frombuffer(b"".join(coded), "<u4").astype(np.int32)
                    offs = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded])]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([ids, count, pa.ListArray.from_arrays(pa.array(offs), pa.array(values))], ["doc_id", "n_tokens", "token_ids"])
    return run


def _decoded(shared, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared_codec(shared, pattern)
        for batch in batches:
            out = [codec.decode(np.asarray(x.as_py() or [], "<u4").tobytes()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "bytes"])
    return run


def _share(spark: SparkSession, path: str):
    ship_package(spark)
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(documents: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, token_ids of every row (null text: no ids); extra columns are left out,
    rows with equal ids stay separate.  ``path``: rank file, read on the driver."""
    shared = _share(documents.sparkSession, path)
    return docs(documents, id_col, text_col).mapInArrow(_encoded(shared, pattern, False), "doc_id long, n_tokens long, token_ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, bytes of rows that ``encode`` made."""
    shared = _share(encoded.sparkSession, path)
    return encoded.select("doc_id", "token_ids").mapInArrow(_decoded(shared, pattern), "doc_id long, bytes binary")


def encode_digests(documents: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, decode what was encoded, and return the digests of both."""
    shared = _share(documents.sparkSession, path)
    return docs(documents, id_col, text_col).mapInArrow(
        _encoded(shared, pattern, True), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return encode_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
