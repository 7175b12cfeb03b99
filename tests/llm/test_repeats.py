import hashlib
import random
import re

import numpy as np
import pytest

from tessera.llm import repeats, suffix_array, suffix_tree

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FAR = -(1 << 63)


def brute_bytes(docs, w=100):
    """docs: (doc_id, text), all different; order by (id, given position)."""
    raw = [(d, (t or "").encode()) for d, t in docs]
    order = sorted(range(len(raw)), key=lambda i: (FAR if raw[i][0] is None else raw[i][0]))
    seen, out = set(), {}
    for i in order:
        d, b = raw[i]
        hit = np.zeros(len(b) + 1, np.int64)
        for s in range(len(b) - w + 1):
            x = b[s:s + w]
            if x in seen:
                hit[s] += 1
                hit[s + w if s + w <= len(b) else len(b)] -= 1
            else:
                seen.add(x)
        gone = np.cumsum(hit)[:len(b)] > 0
        edges = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        kept = bytes(np.frombuffer(b, np.uint8)[~gone]) if len(b) else b""
        out[i] = (d, len(b), int(gone.sum()), edges, hashlib.sha256(kept).hexdigest())
    return sorted(out.values(), key=str)


def brute_words(docs, w=13):
    split = [(d, WORD.findall(t or "")) for d, t in docs]
    first = {}
    for d, x in split:
        d = FAR if d is None else d
        for s in range(len(x) - w + 1):
            k = tuple(x[s:s + w])
            first[k] = min(first.get(k, d), d)
    out = []
    for d, x in split:
        gone = set()
        for s in range(len(x) - w + 1):
            if first[tuple(x[s:s + w])] < (FAR if d is None else d):
                gone.update(range(s, s + w))
        out.append((d, len(x), len(gone), hashlib.sha256(" ".join(v for i, v in enumerate(x) if i not in gone).encode()).hexdigest()))
    return sorted(out, key=str)


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_induced_sorting_is_a_suffix_sort(monkeypatch):
    rng = np.random.default_rng(1)
    for n, k, items in [(1, 5, 100), (2, 3, 100), (40, 2, 7), (300, 3, 20), (2000, 4, 100), (2000, 200, 10**6), (500, 1, 3)]:
        for _ in range(8):
            t = np.concatenate([rng.integers(1, k + 1, n), [0]])
            for wide in (4096, 0):
                monkeypatch.setattr(suffix_array, "WIDE", wide)
                got = np.concatenate(list(suffix_array.sorted_suffixes(t, k + 1, items)))
                x = t.tolist()
                assert got.tolist() == sorted(range(n + 1), key=lambda i: x[i:])


def test_names_are_sorted_by_few_vector_steps(monkeypatch):
    """Large alphabets, random and with long repeats: as many sorts as the longest repeat has bits."""
    rng = np.random.default_rng(2)
    part = rng.integers(1, 9000, 1500)
    for t in (rng.integers(1, 9000, 4000), np.tile(part, 3), np.tile([5, 7000], 1000), np.ones(900, np.int64)):
        t, sorts = np.append(t, 0), []
        with monkeypatch.context() as m:
            m.setattr(suffix_array.np, "argsort", lambda *a, f=np.argsort, **k: sorts.append(1) or f(*a, **k))
            got = suffix_array._doubled(t)
        x = t.tolist()
        assert got.tolist() == sorted(range(len(t)), key=lambda i: x[i:])
        assert len(sorts) <= 2 + len(t).bit_length()


def test_contents_are_hashed_for_picked_stretches_only():
    scan = repeats.Scanner(suffix_array.SPEC)
    buf = np.random.default_rng(3).integers(97, 123, 4000).astype(np.uint8)
    sym, offs = scan.symbols(buf, np.array([0, 1500, 4000]))
    whole = scan.stretches(sym, offs, lambda k: k % np.uint64(3) != 0)
    picked = scan.stretches(sym, offs, lambda k: k % np.uint64(3) != 0, live=lambda k, recurs, before, after: k % np.uint64(2) == 0)
    some = whole[2] % np.uint64(2) == 0
    assert 0 < some.sum() < len(some)
    assert all((a[some] == b).all() for a, b in zip(whole, picked))


def test_queue_spills_and_keeps_the_order():
    q = suffix_array.RunQueue(3, 5)
    for i in range(10):
        q.deal(np.array([1, 2, 1]), np.array([3 * i, 3 * i + 1, 3 * i + 2]))
    want = [x for i in range(10) for x in (3 * i, 3 * i + 2)]
    assert np.concatenate(list(q.parts(1))).tolist() == want
    assert np.concatenate(list(q.parts(1, reverse=True))).tolist() == want[::-1]
    assert np.concatenate(list(q.take(1))).tolist() == want and not list(q.take(1)) and not list(q.take(0))
    q.close()


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_queries_match_brute_force(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = brute_bytes(docs)
    assert rows(suffix_array.op4_suffix_array(spark, sf)) == want
    assert sum(r[2] for r in want) > 10_000
    want = brute_words(docs)
    assert rows(suffix_tree.op8_suffix_tree(spark, sf)) == want
    assert sum(r[2] for r in want) > 1_000


def hard_docs():
    rng = random.Random(3)

    def prose(n):
        return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9))) for _ in range(n))
    line = "Licensed under the very common licence, version 3, see the file."
    passage = prose(70)
    docs = [(None, passage + " nullé"), (1, None), (2, ""), (3, "x" * 99), (4, "x" * 100), (5, "y" * 350), (6, "ab" * 300), (7, "ba" * 130),
            (8, "x" * 5000), (9, " ".join(["same"] * 60)), (10, " ".join(["same"] * 40)), (11, "tick tock " * 30), (12, "a\x00b" * 90), (13, "a\x00b" * 50)]
    for i in range(20, 60):
        parts = [prose(rng.randrange(1, 40))]
        if rng.random() < .6:
            w = passage.split()
            a = rng.randrange(0, 20)
            parts.append(" ".join(w[a:a + rng.randrange(10, 50)]))
        parts += [line, prose(rng.randrange(1, 30))]
        if rng.random() < .3:
            parts.append(parts[0])
        docs.append((i, " ".join(parts)))
    docs += [(100 + i, docs[25][1]) for i in range(12)]
    docs += [(200, docs[30][1] * 3), (-5, docs[31][1])]
    return docs


def test_hard_cases(spark, make_docs):
    docs = hard_docs()
    assert rows(suffix_array.dedup_digests(make_docs(docs))) == brute_bytes(docs)
    assert rows(suffix_tree.dedup_digests(make_docs(docs))) == brute_words(docs)
    empty = make_docs(docs).limit(0)
    assert rows(suffix_array.dedup_digests(empty)) == [] and rows(suffix_tree.dedup_digests(empty)) == []


def test_small_memory_and_pieces(spark, make_docs, monkeypatch):
    """Runs on disk, several prefix groups, pieces of long texts and hot keys change nothing."""
    import types

    docs = hard_docs()
    for mod, name, value in ((suffix_array, "ITEMS", 50), (suffix_tree, "GROUP", 20)):
        monkeypatch.setattr(mod, name, value)
    shard_rng = random.Random(1)
    base = "".join(shard_rng.choice("ab") for _ in range(400))
    texts = [base[i:i + 260] for i in range(0, 130, 10)]
    n = np.array([len(t) - 99 for t in texts])
    data = np.frombuffer("".join(t + "\0" for t in texts).encode(), np.uint8)
    start = np.concatenate([[0], np.cumsum(n + 100)[:-1]])
    place = np.array([[i % 5, 0, 1000 * i] for i in range(len(texts))])
    shard = repeats.Shard(data, start, n, place)
    seen, want = {}, []
    for i, t in enumerate(texts):
        for s in range(len(t) - 99):
            seen.setdefault(t[s:s + 100], []).append((i % 5, 1000 * i + s))
    for i, t in enumerate(texts):
        want += [min(seen[t[s:s + 100]]) != (i % 5, 1000 * i + s) for s in range(len(t) - 99)]
    assert suffix_array.repeated_windows(shard).tolist() == want
    assert isinstance(repeats, types.ModuleType)
    sym = np.array([shard_rng.randrange(2) for _ in range(600)], np.uint64)
    wins = repeats.Shard(sym, np.array([0, 300]), np.array([287, 287]), np.array([[4, 0, 0], [2, 0, 0]]))
    first = {}
    at, owner = wins.windows()
    ids = wins.place[:, 0][owner]
    for p, d in zip(at.tolist(), ids.tolist()):
        k = tuple(sym[p:p + 13].tolist())
        first[k] = min(first.get(k, d), d)
    assert suffix_tree.repeated_windows(wins).tolist() == [first[tuple(sym[p:p + 13].tolist())] < d for p, d in zip(at.tolist(), ids.tolist())]
    scan = repeats.Scanner(suffix_array.SPEC)
    raw = np.frombuffer((docs[40][1] * 4).encode(), np.uint8)
    offs = np.array([0, 150, 150, len(raw)])
    whole = scan.stretches(*scan.symbols(raw, offs))
    monkeypatch.setattr(repeats, "PIECE", 64)
    pieces = scan.stretches(*scan.symbols(raw, offs))
    spread = [sorted((s + i, int(k)) for s, c, k in zip(*(y.tolist() for y in x[:3])) for i in range(c)) for x in (whole, pieces)]
    assert spread[0] == spread[1]


def test_recurring_keys_are_found():
    rng = random.Random(11)
    scan = repeats.Scanner(suffix_array.SPEC)
    for _ in range(60):
        unit = bytes(rng.randrange(97, 123) for _ in range(rng.randrange(1, 150)))
        raw = bytes(rng.randrange(97, 123) for _ in range(rng.randrange(0, 150))) + (unit * 200)[:rng.randrange(50, 500)] + bytes(rng.randrange(97, 123) for _ in range(100))
        sym, offs = scan.symbols(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        grams = scan._grams(sym)
        for s, c, k, _, r in zip(*(x.tolist() for x in scan.stretches(sym, offs, recurring=True))):
            assert r == (int((grams[s:s + c - 1 + suffix_array.SPEC.span] == np.uint64(k)).sum()) > 1)


def test_hot_keys_change_nothing(spark, make_docs):
    rng = random.Random(6)
    line = "this line is in nearly every document of the corpus, sixty bytes"
    docs = [(i, "".join(rng.choice("abcdefgh ") for _ in range(200)) + line + "".join(rng.choice("abcdefgh ") for _ in range(200))) for i in range(120)]
    docs += [(500 + i, docs[i][1][100:400]) for i in range(10)]
    assert rows(suffix_array.dedup_digests(make_docs(docs))) == brute_bytes(docs)


def test_rewriting_keeps_all_columns(spark, make_docs):
    docs = hard_docs()
    frame = make_docs(docs)
    for mod, brute in ((suffix_array, brute_bytes), (suffix_tree, brute_words)):
        out = mod.remove_duplicates(frame)
        assert out.columns == frame.columns
        got = out.collect()
        assert len(got) == len(docs) and all(r["id"] == 7 and r["uid"] == 8 for r in got)
        text = {r["doc_id"]: r["text"] for r in got}
        assert text[1] is None and text[3] == "x" * 99 and len(text[200]) < len(dict(docs)[200])


def lines_twice():
    """(u + L + L + P, v + L + P) for lines L about as long as the room beside the key m-gram, so
    that its key recurs in the first text only and the shared windows hold its second place."""
    rng = random.Random(17)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9)))
    docs = []
    for words in (False, True):
        for n in range(4, 10) if words else range(30, 72, 2):
            for _ in range(6):
                line = " ".join(word() for _ in range(n)) + " " if words else "".join(rng.choice("abcdefghij") for _ in range(n))
                u, v, p = (" ".join(word() for _ in range(k)) + " " for k in (20, 20, 9))
                pair = [u + line + line + p + word(), v + line + p + word()]
                docs += [(len(docs) + i, t) for i, t in enumerate(pair[::rng.choice((1, -1))])]
    return docs


def test_partner_of_a_recurring_key_is_found(spark, make_docs):
    docs = lines_twice()
    assert rows(suffix_array.dedup_digests(make_docs(docs))) == brute_bytes(docs)
    assert rows(suffix_tree.dedup_digests(make_docs(docs))) == brute_words(docs)


def test_half_windows_of_every_place():
    """Two contents of one key that share a window share a half window."""
    docs = [t for _, t in lines_twice()] + [t or "" for _, t in hard_docs()]
    for spec in (suffix_array.SPEC, suffix_tree.SPEC):
        scan = repeats.Scanner(spec)
        held = []
        for t in docs:
            raw = np.frombuffer(t.encode(), np.uint8)
            sym, offs = scan.symbols(raw, np.array([0, len(raw)]))
            start, count, key, _, _, before, after, _, size, more = scan.stretches(sym, offs, lambda k: np.ones(len(k), bool), every=True)
            assert len(size) == len(start) and size.sum() == len(more)
            cut = np.split(more, np.cumsum(size)[:-1]) if len(size) else []
            for s, n, k, *h, rest in zip(start.tolist(), count.tolist(), key.tolist(), before.tolist(), after.tolist(), cut):
                held.append((k, {sym[i:i + spec.window].tobytes() for i in range(s, s + n)}, {*h, *rest.tolist()} - {0}))
        by_key = {}
        for k, w, h in held:
            by_key.setdefault(k, []).append((w, h))
        met = 0
        for group in by_key.values():
            for i, (w, h) in enumerate(group):
                for w2, h2 in group[:i]:
                    if w & w2:
                        met += 1
                        assert h & h2
        assert met > 50
