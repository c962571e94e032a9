"""Phrase mining against plain counting; Misra-Gries summaries against their guarantee."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from stockrecon.llm import phrases as P

DOCS = "doc_id long, text string, lang string, rank string, phrase string"


def plain(docs, threshold, listed=P.LISTED):
    """The contract in loops."""
    f, n = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    rows = []
    for (lang, phrase), a in f.items():
        if len(phrase) < 2 or a < threshold:
            continue
        longer = [b for (other, p), b in f.items() if other == lang and b >= threshold and len(p) > len(phrase)
                  and phrase in {p[i : i + len(phrase)] for i in range(len(p) - len(phrase) + 1)}]
        if any(100 * b >= 50 * a for b in longer):
            continue
        cuts = [(f[lang, phrase[:k]], f[lang, phrase[k:]]) for k in range(1, len(phrase))]
        scores = [1_000_000 * a * a // (x * y) for x, y in cuts]
        k = scores.index(min(scores))
        rows.append((lang, -scores[k], -a, " ".join(phrase).encode(), *cuts[k]))
    ranks, result = Counter(), []
    for lang, score, a, phrase, left, right in sorted(rows):
        ranks[lang] += 1
        if ranks[lang] <= listed:
            result.append((lang, ranks[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(result)


def mined(spark, docs, **more):
    rows = [(i, text, lang, "x", "y") for i, (text, lang) in enumerate(docs)]
    found = P.collocations(spark.createDataFrame(rows, DOCS), **more)
    return sorted(tuple(row) for row in found.collect())


def random_docs(seed, count, words="a b the B é  x 日本 d-e f"):
    rng, words = random.Random(seed), words.split(" ")
    ends = [" ", " ", " ", "\t", "  ", ". ", "\n", "!", ";\x0b"]
    return [
        ("".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randrange(60))), rng.choice(["en", "de", None, "und"]))
        for _ in range(count)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_plain_counting(spark, seed):
    docs = random_docs(seed, 60)
    expected = plain(docs, 5)
    assert expected and mined(spark, docs, threshold=5) == expected


def test_cut_ranking(spark):
    docs = random_docs(3, 60)
    assert mined(spark, docs, threshold=3, listed=4) == plain(docs, 3, 4)


def test_defined_cases(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(None, "en"), ("", None), (" \n.", "de")]) == []
    repeated = [("Big Cat", "en")] * 10 + [("big", "en"), ("cat. dog", "fr")]
    assert mined(spark, repeated) == [("en", 1, "big cat", 10, 11, 10, 21, 909_090)]


def test_long_text_in_parts_and_long_word(spark):
    word = "w" * 5_000_000
    docs = [("one two three. " * 400_000, "en"), (f"{word} z " * 3, "de")]
    found = mined(spark, docs, threshold=3)
    assert [row[:2] + row[3:] for row in found] == [
        ("de", 1, 3, 3, 3, 6, 1_000_000),
        ("en", 1, 400_000, 400_000, 400_000, 1_200_000, 1_000_000),
    ]
    assert found[1][2] == "one two three"


def test_portions_do_not_change_counts(monkeypatch):
    docs = random_docs(5, 40)
    batch = pa.record_batch([pa.array([l or "und" for _, l in docs]), pa.array([t for t, _ in docs])], names=["lang", "text"])

    def total():
        counts = Counter()

        def made(portion):
            keys, few, _ = portion.take()
            at = 0
            for lang, text, size in portion.phrases(keys):
                for row in zip(lang.to_pylist(), text.to_pylist(), size.to_pylist()):
                    counts[row] += int(few[at])
                    at += 1
            yield from ()

        assert not list(P._by_portions([batch, batch], made))
        return counts

    whole = total()
    for name, value in (("KEPT_WORDS", 4), ("KEPT_GRAMS", 7), ("JOINED_BYTES", 11), ("_STEP", 3)):
        monkeypatch.setattr(P, name, value)
    assert total() == whole


@pytest.mark.parametrize("seed", range(6))
def test_every_frequent_name_survives(seed):
    rng = np.random.default_rng(seed)
    names = (rng.zipf(1.3, 6000) % 3000).astype(np.uint32)
    threshold = 10
    summary = P.MisraGries(len(names) // threshold + 1)
    for part in np.array_split(names, 300):
        summary.merge(*np.unique(part, return_counts=True))
    found, counts = np.unique(names, return_counts=True)
    left = summary.survivors(threshold)
    assert set(found[counts >= threshold]) <= set(left)
    assert len(left) <= summary.capacity and summary.lowered < threshold


def test_summary_with_few_counters_lowers_them():
    summary = P.MisraGries(2)
    for _ in range(50):
        summary.merge(np.array([1, 2, 3, 4], np.uint32), np.array([9, 1, 1, 1]))
    assert summary.lowered > 0 and set(summary.survivors(450)) == {1}


def test_full_bitmap_lets_more_through_but_counts_exactly(spark):
    docs = random_docs(7, 50)
    df = spark.createDataFrame([(0, t, l, "", "") for t, l in docs], DOCS)
    few = {tuple(r) for r in P.frequent(df, 4, bits=15).collect()}
    assert few == {tuple(r) for r in P.frequent(df, 4).collect()}
