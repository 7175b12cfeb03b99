"""Exact token counts by the whole-token shortcut.

Offline, every string of the vocabulary is encoded alone; those that come back as one token
are *proven*: a pre-token in that set counts 1 without any merge.  Only the other pre-tokens
are merged (segment trees of ``bpe.Merger``), and a bounded memo keeps their counts.

Special tokens are matched in the text first, as the library does by default: each match is
one token, and the stretches between are counted on their own.  Null texts are empty.  Rows
with equal ids stay separate; extra columns are left out.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .bpe import MEMO, Merger, _share, text_blocks
from .textnum import docs, kept


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1
    bytes stand for themselves, the others take the code points from 256 on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(free)) for b in range(256)]


def merger_of(spec: dict) -> Merger:
    """Merges of a vocabulary file (byte-level BPE, parsed JSON)."""
    vocab = spec["model"]["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    ids = np.array([[vocab[a], vocab[b]] for a, b in merges], np.int64).reshape(-1, 2)
    made = np.array([vocab[a + b] for a, b in merges], np.int64)
    return Merger(ids[:, 0], ids[:, 1], np.arange(len(merges)), made, np.array([vocab[c] for c in byte_letters()]))


class Counter:
    """Token counts of one vocabulary file (byte-level BPE, JSON)."""

    def __init__(self, data: bytes, pattern: str):
        import regex
        spec = json.loads(data)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        self.merger = merger_of(spec)
        self.split = regex.compile(pattern).findall
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.proven = self._prove(vocab, {c: b for b, c in enumerate(letters)}, set(special))
        self.memo: dict[str, int] = {}

    def _prove(self, vocab: dict, byte_of: dict, special: set) -> frozenset:
        """Vocabulary strings that encode alone as one token."""
        words, raw = [], []
        for v in vocab:
            if v in special:
                continue
            b = bytes(byte_of[c] for c in v)
            try:
                words.append(b.decode())
            except UnicodeDecodeError:  # part of a character: never a whole pre-token
                continue
            raw.append(b)
        return frozenset(w for w, ids in zip(words, self.merger.encode_many(raw)) if len(ids) == 1)

    def count(self, texts: list[str]) -> list[int]:
        proven, memo = self.proven, self.memo
        ones, rest = [], []
        for t in texts:
            n, parts = 0, [t]
            if self.special is not None:
                parts = self.special.split(t)
                n = len(parts) - 1
            left: list[str] = []
            for part in parts:
                pre = self.split(part)
                other = [p for p in pre if p not in proven]
                n += len(pre) - len(other)
                left += other
            ones.append(n)
            rest.append(left)
        new = set().union(*rest).difference(memo)
        if len(memo) + len(new) > MEMO:
            memo.clear()
            new = set().union(*rest)
        new = list(new)
        for p, ids in zip(new, self.merger.encode_many([p.encode() for p in new])):
            memo[p] = len(ids)
        return [n + sum(map(memo.__getitem__, left)) for n, left in zip(ones, rest)]


def _counted(shared, pattern: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = shared.value
        counter = kept(("counter", hashlib.sha256(data).digest(), pattern), lambda: Counter(data, pattern))
        for batch in batches:
            for lo, texts in text_blocks(batch.column(1)):
                n = counter.count(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(texts)), pa.array([len(t.encode()) for t in texts], pa.int64()),
                     pa.array(n, pa.int64()), pa.array([x > limit for x in n])], ["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return run


def token_counts(documents: DataFrame, path: str, pattern: str, *, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) of every row.  ``path``: the
    vocabulary file, read on the driver; ``pattern``: its pre-token pattern."""
    shared = _share(documents.sparkSession, path)
    return docs(documents, id_col, text_col).mapInArrow(
        _counted(shared, pattern, limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
