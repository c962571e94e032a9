"""Quality rules: counts against plain loops, exact bounds, certified cutoffs."""

import random
from collections import Counter
from math import comb

import pytest
from pyspark.sql import functions as F

from stockrecon.llm import risk_rules as R

DOCS = "doc_id long, text string, lang string"
LABELS = "doc_id long, quality int, toxic int"


def brute(text):
    text = text or ""
    words = text.encode().split()
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (
        len(words),
        sum(len(w.decode()) for w in words),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
    )


TEXTS = [
    None,
    "",
    " \t\n\x0b\f\r ",
    "one",
    "a b c a b c",
    "a a a a a",
    "x y z x y z x y z q",
    "same line\nsame line\n\n \nother\nsame line",
    "  é ü ## $5 <b>|</b>\r\nÉ",
    " ".join(["tok"] * 60),
    " ".join(f"w{i}" for i in range(60)),
    " ".join(f"w{i % 40}" for i in range(20_000)),
]


def test_counts_equal_plain_loops(spark):
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice("ab \n\t#é") for _ in range(rng.randrange(80))) for _ in range(150)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: r for r in R.judge(docs, spark.createDataFrame([], LABELS)).collect()}
    for i, text in enumerate(texts):
        n = brute(text)
        assert (got[i].n_words, got[i].word_chars, got[i].n_symbols, got[i].n_dup_lines, got[i].n_repeat_words) == n
        assert got[i].base_failed == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        assert got[i].kept == (not got[i].base_failed)


@pytest.mark.parametrize("n,alpha,delta", [(0, 0.01, 0.05), (100, 0.01, 0.05), (500, 0.01, 0.05), (2000, 0.005, 0.003), (300, 0.2, 0.01)])
def test_allowed_rejections_are_exact(spark, n, alpha, delta):
    got = spark.range(1).select(R.allowed_rejections(F.lit(n).cast("long"), alpha, delta).alias("k")).first()["k"]
    total, best = 0.0, -1
    for k in range(n + 1):
        total += comb(n, k) * alpha**k * (1 - alpha) ** (n - k)
        if total > delta:
            break
        best = k
    assert got == best


def _measured(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, stratum string, rates array<int>")


def test_cutoff_parts_bad_from_good_and_is_certified(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(8000):
        good = i % 5 != 0
        rate = rng.randrange(0, 60) if good else rng.randrange(300, 600)
        rows.append((i, "en", [rate, 0, 0, rng.randrange(100)]))
        labels.append((i, int(good), 0))
    limits = R.cutoffs(_measured(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    assert len(limits) == 1 and limits[0].stratum == "en"
    assert 59 <= limits[0].limits[0] < 300  # all bad above, all good below
    assert limits[0].limits[1] is None and limits[0].limits[2] is None  # useless rules stay off


def test_false_rejections_stay_below_the_bound(spark):
    """Where good and bad overlap, the certified cutoff loses at most alpha of the good.

    Only one rule has a proposal, so it may spend the whole of alpha."""
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(12_000):
        good = i % 2 == 0
        rate = min(1000, int(rng.gauss(100 if good else 160, 50)))
        rows.append((i, "en", [max(0, rate), 0, 0, 0]))
        labels.append((i, int(good), 0))
    limit = R.cutoffs(_measured(spark, rows), spark.createDataFrame(labels, LABELS), alpha=0.04).first().limits[0]
    fresh = [rng.gauss(100, 50) for _ in range(200_000)]
    assert limit is not None and 0.01 < sum(x > limit for x in fresh) / len(fresh) <= 0.04


def test_few_labels_give_no_cutoff(spark):
    rows = [(i, "en", [500 if i % 2 else 0, 0, 0, 0]) for i in range(200)]
    labels = [(i, 1 - i % 2, 0) for i in range(200)]
    assert R.cutoffs(_measured(spark, rows), spark.createDataFrame(labels, LABELS)).count() == 0


def test_repeated_labels_and_rows_certify_nothing_more(spark):
    """The bound counts documents, not rows."""
    rows = [(i, "en", [rate, 0, 0, 0]) for i in range(400) for rate in [(i * 7) % 50 + 400 * (i % 4 == 0)]]
    labels = [(i, int(i % 4 != 0), 0) for i in range(400)]
    once = R.cutoffs(_measured(spark, rows), spark.createDataFrame(labels, LABELS), alpha=0.02, delta=0.01).collect()
    often = R.cutoffs(_measured(spark, rows * 5), spark.createDataFrame(labels * 60, LABELS), alpha=0.02, delta=0.01).collect()
    assert once == often == []
    loose = [R.cutoffs(_measured(spark, r), spark.createDataFrame(x, LABELS), alpha=0.2, delta=0.05).collect()
             for r, x in ((rows, labels), (rows * 5, labels * 60))]
    assert loose[0] == loose[1] != []


def test_contradicting_labels_count_as_bad(spark):
    rows = [(i, "en", [i % 2 * 500, 0, 0, 0]) for i in range(4000)]
    good = [(i, 1, 0) for i in range(4000)]
    found = R.cutoffs(_measured(spark, rows), spark.createDataFrame(good + [(i, 0, 0) for i in range(1, 4000, 2)], LABELS))
    assert [r.limits[0] for r in found.collect()] == [0]


def test_keep_and_judge_agree(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(1500):
        good = i % 3 != 0
        words = [f"w{rng.randrange(10**6)}" + ("#" * rng.randrange(4, 9) if not good else "") for _ in range(55)]
        rows.append((i, " ".join(words[: rng.choice([40, 55, 55, 55])]), rng.choice(["en", None])))
        if i % 5:
            labels.append((i, int(good), 0))
    docs, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)
    judged = {r.doc_id: r for r in R.judge(docs, marks, alpha=0.1).collect()}
    kept = {r.doc_id for r in R.keep(docs, marks, alpha=0.1).collect()}
    assert kept == {i for i, r in judged.items() if r.kept}
    assert any(not r.base_failed and not r.kept for r in judged.values())
    assert all(r.kept for i, r in judged.items() if i % 3 and not r.base_failed)


def test_nulls_ties_and_clashing_columns(spark):
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame(
        [(1, text, None, 7, "x"), (1, text, None, 7, "x"), (None, text, "en", None, None), (2, None, "en", 1, "y")],
        DOCS + ", n_words int, Measures string",
    )
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0), (9, 0, 0), (1, 1, 1), (1, 1, 1)], LABELS)
    kept = R.keep(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "None"]


def test_empty_tables(spark):
    assert R.judge(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).count() == 0
