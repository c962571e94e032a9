"""Lexical search against scoring every document alone."""

import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from stockrecon.llm import lexical as X

DOCS = "doc_id long, text string, score string, rank string"
ITEMS = "item_id long, text string, doc_id string"


def terms(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(X.TERM, lowered)


def plain(items, docs, k=20):
    """The contract in loops; rows of one item are joined."""
    found = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    found = [(doc_id, c, sum(c.values())) for doc_id, c in found if c]
    total, size = len(found), sum(n for _, _, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    asked = {}
    for item_id, text in set(items):
        asked.setdefault(item_id, Counter()).update(terms(text))
    result = []
    for item_id, wanted in asked.items():
        scored = []
        for doc_id, c, n in found:
            m = 75 + 25 * n * total // size
            score = sum(
                q * math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t, q in wanted.items() if c[t]
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        best = sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:k]
        result += [(item_id, rank, doc_id, -score) for rank, (score, _, doc_id) in enumerate(best, 1)]
    return sorted(result, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def searched(spark, items, docs, **more):
    found = X.search(
        spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS),
        spark.createDataFrame([(d, t, "x", "y") for d, t in docs], DOCS).repartition(3),
        **more,
    )
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def corpus(seed, size):
    rng = random.Random(seed)
    words = ["the", "The", "Éa", "日本", "a1", "b", "c-d", "x_y", "_", "zz", "q", "\x7f"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(12))) for _ in range(size // 3)]
    docs = [(rng.randrange(size), rng.choice(texts)) for _ in range(size)]  # many copies, repeated ids
    items = [(i, " ".join(rng.choices(words + ["nowhere"], k=rng.randrange(1, 6)))) for i in range(12)]
    return items, docs


@pytest.mark.parametrize("seed,more", [(1, {}), (2, {"postings": 7}), (3, {"k": 3}), (4, {"bits": 15})])
def test_equal_to_scoring_every_document(spark, seed, more):
    items, docs = corpus(seed, 150)
    expected = plain(items, docs, more.get("k", 20))
    assert len(expected) > 30 and searched(spark, items, docs, **more) == expected


def test_defined_cases(spark):
    docs = [(5, "Cat cat"), (None, "cat CAT"), (3, "cat cat"), (3, "cat cat"), (9, None), (8, ""), (7, "dog -- "), (2, "bird")]
    items = [(1, "cat"), (1, "cat"), (None, "dog dog"), (2, "nothing here"), (3, None), (4, ""), (1, "dog")]
    found = searched(spark, items, docs)
    assert found == plain(items, docs)
    assert [row[2] for row in found if row[0] == 1] == [7, 3, 3, 5, None]
    assert searched(spark, items, []) == searched(spark, [], docs) == []


def test_long_text(spark):
    docs = [(1, "cat dog " * 800_000), (2, "x" * 5_000_000 + " cat"), (3, "dog")] + [(i, "mouse") for i in range(4, 30)]
    items = [(1, "cat"), (2, "dog dog"), (3, "x" * 5_000_000)]
    assert searched(spark, items, docs) == plain(items, docs)


def test_a_class_is_one_row_with_its_least_members(spark):
    rows = [(i, "cat dog", "", "") for i in range(50, 0, -1)] + [(99, "cat dog dog", "", "")]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    found = X.bags(docs, b"\xff" * 4096, 15)
    merged = X.classes(found, 51, 103, 4).collect()
    assert sorted(row["members"] for row in merged) == [[1, 2, 3, 4], [99]]


def test_weights_in_parts(monkeypatch):
    """Dense parts of few items and products of few terms give the same best documents."""
    rows = pa.table({"item_id": [1, 1, 2, 3, None], "term": ["a", "b", "b", "c", "a"], "weight": [5, 7, 7, 9, 5]})
    batch = pa.record_batch(
        [pa.array([100, 90, 80]), pa.array([["a", "b"], ["b", "c", "zz"], ["zz"]]), pa.array([[1, 2], [3, 1, 4], [1]]),
         pa.array([[4, 7], [5, None], [6]])],
        names=["m", "terms", "tfs", "members"],
    )

    def best():
        return [b.to_pylist() for b in X.scorer(rows, 2)(iter([batch, batch]))]

    whole = best()
    monkeypatch.setattr(X, "CELLS", 3)
    monkeypatch.setattr(X, "PRODUCTS", 1)
    assert best() == whole and len(whole[0]) == 8
