"""Near-duplicates against all pairs; components against union-find."""

import random

import numpy as np
import pyarrow as pa
import pytest

from stockrecon.llm import superminhash as S
from stockrecon.llm.components import components
from stockrecon.llm.hashing import shingle_sets

DOCS = "doc_id long, text string"


def sets_of(text, size):
    w = (text or "").encode().lower().split()
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def brute(rows, size):
    sets = [sets_of(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc), doc)
    return {doc: (len(sets[i]), least[root(i)], doc == least[root(i)]) for i, (doc, _) in enumerate(rows)}


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 4)))
    texts = [None, "", "  \n", "One", "one", "one two", "ONE  two\n", "two one"]
    for _ in range(25):
        base = [word() for _ in range(rng.randrange(5, 120))]
        texts.append(" ".join(base))
        for _ in range(rng.randrange(0, 6)):
            copy = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 8))):
                copy[rng.randrange(len(copy))] = word()
            texts.append(rng.choice([" ", "\n"]).join(copy))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("size", [2, 5])
def test_components_equal_all_pairs(spark, size):
    rows = corpus(size)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in S.components_of(spark.createDataFrame(rows, DOCS), size).collect()}
    assert got == brute(rows, size)


def test_large_groups_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "GROUP_NODES", 6)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(80):
        copy = list(base)
        for _ in range(10):
            copy[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in S.components_of(spark.createDataFrame(rows, DOCS), 2).collect()}
    assert got == brute(rows, 2)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for share in (0.2, 0.5, 0.8):
        for _ in range(30):
            both = rng.integers(0, 2**63, 400, dtype=np.uint64)
            n = int(400 * share)
            a = np.unique(both[: n + (400 - n) // 2])
            b = np.unique(np.concatenate([both[:n], both[n + (400 - n) // 2 :]]))
            s = S.signatures([a, b])
            errors.append((s[0] == s[1]).mean() - share)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < (0.25 / S.POSITIONS) ** 0.5


def test_signatures_do_not_depend_on_chunks(monkeypatch):
    rng = np.random.default_rng(2)
    sets = [rng.integers(0, 2**63, n, dtype=np.uint64) for n in (1, 2, 7, 300, 2000)]
    whole = S.signatures(sets)
    monkeypatch.setattr(S, "CHUNK", 64)
    assert (S.signatures(sets) == whole).all()
    assert (whole != S.FREE).all()


def test_shingles_do_not_cross_texts_or_slices(monkeypatch):
    from stockrecon.llm import hashing

    texts = [t for _, t in corpus(9)]
    whole = [s for _, found in shingle_sets(pa.array(texts), 2) for s in found]
    monkeypatch.setattr(hashing, "SLICE_BYTES", 50)
    parts = [s for _, found in shingle_sets(pa.array(texts), 2) for s in found]
    assert all((a == b).all() for a, b in zip(whole, parts)) and len(whole) == len(parts) == len(texts)
    assert [len(s) for s in whole] == [len(sets_of(t, 2)) for t in texts]


def test_components_of_graph(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000, i) for i in range(1001, 1100)]
    edges += [(i, i + 1) for i in range(2000, 2060)] + [(5, 5), (None, 3)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {x: root(x) for x in parent}


def test_keep_one_of_each_group(spark):
    long_ = " ".join(f"w{i}" for i in range(40))
    rows = [(3, long_, 1), (2, long_ + " end", 1), (7, "lone words here", 2), (7, "lone words here", 2), (None, long_, 5), (9, None, 0)]
    docs = spark.createDataFrame(rows, DOCS + ", kept int")
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 7, 9]


def test_no_documents(spark):
    assert S.components_of(spark.createDataFrame([], DOCS)).count() == 0


def long_text(seed, n=30):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


def test_rows_are_kept_by_text_not_by_id(spark):
    """Different texts under one doc_id, or under none, are judged each; only repeats fold."""
    a, b, c, d = map(long_text, range(4))
    rows = [(1, a, "x"), (1, b, "y"), (2, c, "z"), (None, a + " more", "p"), (None, d, "q"), (None, "", "r"), (None, None, "s"),
            (5, d, "t"), (3, b, "u"), (3, "", "v"), (3, "", "w"), (6, c, "6"), (2, c, "z")]
    docs = spark.createDataFrame(rows, DOCS + ", _word string").repartition(3)
    kept = sorted((r.doc_id is None, r.doc_id or 0, r.text or "", r._word) for r in S.keep_one(docs).collect())
    assert kept == sorted(
        (i is None, i or 0, t or "", w)
        for i, t, w in [(1, a, "x"), (1, b, "y"), (2, c, "z"), (5, d, "t"), (None, "", "r"), (None, None, "s"), (3, "", "v"), (3, "", "w")]
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_keep_one_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    texts = [t for _, t in corpus(seed + 20)]
    rows = [(rng.choice([None, *range(60)]), t) for t in texts + rng.sample(texts, 12)]
    unique = list(dict.fromkeys(rows))
    found = brute(list(enumerate(t for _, t in unique)), 5)
    groups = {}
    for i, (doc, text) in enumerate(unique):
        groups.setdefault(found[i][1], []).append((doc is None, doc or 0, text))
    # Of each group of texts with shingles a row of the least doc_id stays; of blank rows all do.
    kept = [(r.doc_id is None, r.doc_id or 0, r.text) for r in S.keep_one(spark.createDataFrame(rows, DOCS)).collect()]
    blank = [r for r in kept if not (r[2] or "").strip()]
    assert len(blank) == sum(not (t or "").strip() for _, t in rows)
    full = [r for r in kept if (r[2] or "").strip()]
    wanted = [g for g in groups.values() if (g[0][2] or "").strip()]
    assert len(full) == len(wanted)
    for group in wanted:
        (stays,) = [r for r in full if r in group]
        assert stays[:2] == min(group, key=lambda g: g[:2])[:2]
