"""The pipeline against a brute-force version of every stage, each on its own input."""
import hashlib
import re

import numpy as np
import pytest

import corpus_pipeline
from tessera.llm import toxicity
from .test_decontaminate import brute as brute_contamination

SF = "/root/testdata/sf0.01"


def cut_bytes(docs, w=100):
    seen, out = set(), []
    for d, t in sorted(docs):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - w + 1):
            x = b[s:s + w]
            if x in seen:
                gone[s:s + w] = True
            seen.add(x)
        out.append((d, np.frombuffer(b, np.uint8)[~gone].tobytes().decode("utf-8", "ignore") if gone.any() else t))
    return out


@pytest.fixture(scope="module")
def steps(spark):
    from tessera.session import stage_table
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        result = stage_table(stage(spark, docs, SF))
        out.append((name, docs, result))
        docs = result
    return out


def pairs(df):
    return sorted((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


def test_order_and_columns(steps, spark):
    names = [n for n, _, _ in steps]
    assert names == ["toxicity", "near_duplicates", "repeated_passages", "contaminated", "tokens"]
    cols = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert all(r.columns == cols for _, _, r in steps[:-1])


def test_toxic_documents_go(steps, spark):
    _, before, after = steps[0]
    model = toxicity.train(before, spark.read.parquet(f"{SF}/labels.parquet").filter(~toxicity.held_out()))
    kernel = toxicity.TextKernel(model.landmarks)
    rows = pairs(before)
    score = model.score(kernel([t for _, t in rows]))
    assert pairs(after) == [r for r, s in zip(rows, score) if s < 0.3]
    assert len(rows) > len(pairs(after)) > 0.8 * len(rows)


def test_one_of_each_group_stays(steps):
    _, before, after = steps[1]
    rows = pairs(before)
    assert pairs(after) == firsts(rows)


def test_repeats_are_cut(steps):
    _, before, after = steps[2]
    assert pairs(after) == cut_bytes(pairs(before))
    changed = {r["doc_id"]: (r["text"], r["n_chars"]) for r in after.collect()}
    old = {r["doc_id"]: (r["text"], r["n_chars"]) for r in before.collect()}
    assert all(n == (old[d][1] if t == old[d][0] else len(t)) for d, (t, n) in changed.items())


def test_contaminated_documents_go(steps, spark):
    _, before, after = steps[3]
    rows = pairs(before)
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {r[0] for r in brute_contamination(rows, items) if r[5]}
    assert pairs(after) == [r for r in rows if r[0] not in bad]


def test_tokens_round_trip(steps):
    _, before, after = steps[4]
    want = {d: hashlib.sha256(t.encode()).hexdigest() for d, t in pairs(before)}
    assert {r["doc_id"]: r["decoded_sha256"] for r in after.collect()} == want
    assert all(re.fullmatch("[0-9a-f]{64}", r["ids_sha256"]) for r in after.collect())


def test_run_gives_the_last_stage(steps, spark):
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(corpus_pipeline.run(spark, SF)) == key(steps[-1][2])


def test_repeated_rows_and_nulls(spark, make_docs):
    text = " ".join(f"w{i}" for i in range(60))
    docs = make_docs([(1, text), (1, text), (2, text + " more"), (None, text), (3, None), (4, ""), (4, ""), (5, "x")])
    from tessera.llm.jaccard_join import drop_near_duplicates
    got = drop_near_duplicates(docs)
    assert got.columns == docs.columns
    assert sorted((str(r["doc_id"]), r["text"]) for r in got.collect()) == sorted([("None", text), ("3", None), ("4", ""), ("4", ""), ("5", "x")], key=lambda r: (r[0], r[1] or ""))
    from tessera.llm.decontaminate import drop_contaminated
    bench = spark.createDataFrame([(1, text)], "item_id long, text string")
    assert sorted(str(r["doc_id"]) for r in drop_contaminated(docs, bench).collect()) == ["3", "4", "4", "5"]


def firsts(docs, n=5, num=80, den=100):
    """(doc_id, text) of the first of each group of near duplicates, by all pairs that share a shingle."""
    sets = []
    for _, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    up, holders = list(range(len(docs))), {}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, s in enumerate(sets):
        count = {}
        for g in s:
            for j in holders.setdefault(g, []):
                count[j] = count.get(j, 0) + 1
            holders[g].append(i)
        for j, c in count.items():
            if den * c >= num * (len(s) + len(sets[j]) - c):
                up[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(docs):
        low[root(i)] = min(low.get(root(i), d), d)
    return sorted((d, t) for i, (d, t) in enumerate(docs) if low[root(i)] == d)


def test_near_copies_at_five_words_and_four_fifths_go(spark, make_docs):
    rng = np.random.default_rng(4)
    texts = []
    for length in (30, 60, 120, 300):
        base = [f"w{x}" for x in rng.integers(0, 10**6, length)]
        texts.append(" ".join(base))
        for share in (.05, .15, .2, .3):
            more = [f"x{x}" for x in rng.integers(0, 10**6, int(share * length))]
            texts += [" ".join(base + more), " ".join(base[int(share * length):])]
        for k in (length // 60, length // 50, length // 40, length // 25):
            changed = list(base)
            for i in rng.choice(length, k, replace=False):
                changed[i] = f"y{i}"
            texts.append(" ".join(changed))
    docs = list(enumerate(texts))
    assert pairs(corpus_pipeline._near_duplicates(spark, make_docs(docs), SF)) == firsts(docs)
    copy = [(1, texts[13]), (2, texts[13] + " " + " ".join(f"z{i}" for i in range(9)))]
    assert pairs(corpus_pipeline._near_duplicates(spark, make_docs(copy), SF)) == copy[:1]
    table = spark.read.parquet(f"{SF}/documents.parquet")
    got = pairs(corpus_pipeline._near_duplicates(spark, table, SF))
    assert got == firsts(pairs(table)) and len(got) < len(firsts(pairs(table), 3, 90))


CLASHES = ["keep", "froms", "tos", "__id", "__th", "__mark", "__text", "__froms", "__tos", "__toxicity", "id", "th", "uid", "term", "key", "score",
           "s1", "vid", "component", "name", "text_", "c0", "c1", "n", "y", "lang_hash", "first", "rows"]


def test_every_clashing_name_survives_every_stage(spark):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(i, t, "en", "s", len(t or ""), *[f"{c}{i}" for c in CLASHES]) for i, t in enumerate([words, words + " more", words, None, "", "you idiot"])]
    cols = ["doc_id", "text", "lang", "source", "n_chars", *CLASHES]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES))
    from tessera.llm.suffix_tree import remove_duplicates
    stages = [f for _, f in corpus_pipeline.STAGES[:-1]] + [lambda spark, d, sf: remove_duplicates(d)]
    for stage in stages:
        out = stage(spark, docs, SF)
        assert out.columns == cols
        for r in out.collect():
            assert [r[c] for c in CLASHES] == [f"{c}{r['doc_id']}" for c in CLASHES]
    assert corpus_pipeline._tokens(spark, docs, SF).count() == len(rows)
