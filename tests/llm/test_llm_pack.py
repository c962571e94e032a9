"""Token ids against the tokenizers library; packing keeps every id in one place."""

import random
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stockrecon.llm import bin_slack as B
from stockrecon.llm.tokens import Encoder, default_ranks

DOCS = "doc_id long, text string"
HARD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a\n b", "a\n\n  b\t c ", "it's ' s don't", "x<|endoftext|> y", "é b  c",
    "tab\t word", "\r\n", "123 45a b6", "日本語 テキスト", "a\x1cb \x1cc", "!!! ### $$$ a!!! b###", "word" * 300, " lead", "trail\n",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def random_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice("ab  \n\té's1!<|>") for _ in range(rng.randrange(60))) for _ in range(n)]


def test_ids_equal_the_library(library):
    texts = HARD + random_texts(500)
    ids, bounds = Encoder(default_ranks()).encode(texts)
    for text, a, b in zip(texts, bounds[:-1], bounds[1:]):
        assert ids[a:b].tolist() == [*library.encode(text, add_special_tokens=False).ids, 0], repr(text)


def test_forgetting_words_changes_nothing(monkeypatch):
    from stockrecon.llm import tokens

    texts = HARD + random_texts(100, 2)
    whole, _ = Encoder(default_ranks()).encode(texts)
    monkeypatch.setattr(tokens, "KEPT_WORDS", 3)
    small = Encoder(default_ranks())
    assert np.concatenate([small.encode([t])[0] for t in texts]).tolist() == whole.tolist()


@pytest.mark.parametrize("seed", range(8))
def test_best_fill_is_optimal(seed):
    rng = random.Random(seed)
    counts = np.zeros(20, np.int64)
    for _ in range(4):
        counts[rng.randrange(1, 20)] = rng.randrange(1, 4)
    room = rng.randrange(1, 40)
    sizes = np.flatnonzero(counts).tolist()
    sums = {sum(n * s for n, s in zip(taken, sizes)) for taken in product(*(range(counts[s] + 1) for s in sizes))}
    used = B.best_fill(counts, room)
    assert all(n <= counts[s] for s, n in used.items())
    assert sum(s * n for s, n in used.items()) == max(x for x in sums if x <= room)


def check_packed(rows, expected, length):
    """Every id once, pieces gapless within documents and sequences."""
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for places in by_sequence.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at and 0 < size <= length
            at += size
        assert at <= length
    assert set(by_sequence) == set(range(len(by_sequence)))
    assert set(by_doc) == set(expected)
    for doc, ids in expected.items():
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    return sum(length - sum(size for _, size in p) for p in by_sequence.values())


def test_packing_is_an_exact_cover(spark, library):
    rng = random.Random(7)
    texts = HARD + [" ".join(rng.choice(("of", "thing", "a", "éa")) for _ in range(rng.randrange(1, 90))) for _ in range(300)] + [None]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS).repartition(5)
    expected = {i: [*library.encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    padding = check_packed(B.pack(docs, length=64).collect(), expected, 64)
    assert padding <= 2 * 64


def test_repeated_rows_null_ids_and_ids_themselves(spark):
    docs = spark.createDataFrame([(1, "a b", 5), (1, "a b", 5), (None, "c", 1)], DOCS + ", length int")
    rows = B.pack(docs, length=16, with_ids=True).collect()
    assert Counter(r.doc_id for r in rows) == {1: 2, None: 1}
    assert all(len(r.ids) == r.length and r.ids[-1] == 0 for r in rows)
    assert len({(r.sequence_id, r.offset) for r in rows}) == 3


def test_no_documents(spark):
    assert B.pack(spark.createDataFrame([], DOCS)).count() == 0


def test_plan_gives_every_rank_one_place():
    rng = np.random.default_rng(3)
    counts = np.concatenate([[0], rng.integers(0, 200, 1023)])
    rows = B.plan(counts, 10)
    for size in np.flatnonzero(counts):
        mine = rows[rows[:, 0] == size]
        assert mine[0, 1] == 0 and (mine[1:, 1] == mine[:-1, 2]).all() and mine[-1, 2] == counts[size]
    fill = Counter()
    for size, a, b, sequence, per, _ in rows.tolist():
        for s in range((b - a) // per):
            fill[sequence + s] += size * per
    assert max(fill.values()) <= 1024 and sorted(fill) == list(range(10, 10 + len(fill)))
    # No packing needs fewer sequences than there are remainders beyond half a sequence.
    bound = max(-(-int((counts * np.arange(1024)).sum()) // 1024), int(counts[513:].sum()))
    assert len(fill) <= 1.02 * bound
