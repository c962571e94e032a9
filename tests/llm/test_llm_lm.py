"""Language model: gradients, carried state, exact base scores, held-out gain."""

import random
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest

from stockrecon.llm import gru
from stockrecon.llm import lm_score as L

DOCS = "doc_id long, text string"


def small(n_words=10, per_class=4, n_open=3, hidden=5):
    network = gru.Network(gru.Layout(n_words, per_class, n_open), hidden)
    for name in network.NAMES:
        setattr(network, name, getattr(network, name).astype(np.float64))
    return network


def total(network, texts, steps):
    return gru.score(network, texts, 3, steps).sum()


def test_probabilities_add_up():
    network = small()
    states = np.random.default_rng(1).standard_normal((1, 5))
    n = network.layout
    mass = sum(np.exp(network.log_probabilities(states, np.array([i]))[0][0]) for i in range(n.ids))
    assert mass == pytest.approx(1, abs=1e-5)


def test_gradients_equal_differences():
    network = small()
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, network.layout.ids, n) for n in (7, 5, 1)]
    grow = small().load(np.zeros(len(network.vector())))
    for name in grow.NAMES:
        setattr(grow, name, getattr(grow, name).astype(np.float64))
    reading = gru.Lanes(texts, 3, 7, network)
    inputs, targets, live, h = reading.window()
    states, kept = network.run(inputs, h, live)
    reading.move(states)
    assert reading.window() is None
    used = np.arange(3)[None, :] < live[:, None]
    _, back = network.log_probabilities(states[used].astype(float), targets[used], grow)
    spread = np.zeros(states.shape)
    spread[used] = back
    network.gradient(kept, inputs, live, spread, grow)
    for name in network.NAMES:
        weights = getattr(network, name)
        flat = weights.reshape(-1)
        for at in rng.choice(flat.size, min(6, flat.size), replace=False):
            if flat[at] < -1e8:
                continue
            old, step = flat[at], 3e-3
            flat[at] = old + step
            more = total(network, texts, 7)
            flat[at] = old - step
            less = total(network, texts, 7)
            flat[at] = old
            assert getattr(grow, name).reshape(-1)[at] == pytest.approx(-(more - less) / 2 / step, abs=2e-3), name


def test_state_is_carried_across_windows():
    network = gru.Network(gru.Layout(10, 4, 3), 5)
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 13, n) for n in (40, 3, 17, 1, 40, 8)]
    whole = gru.score(network, texts, 6, 100)
    for lanes, steps in ((6, 7), (2, 5), (1, 1)):
        assert np.allclose(gru.score(network, texts, lanes, steps), whole, rtol=1e-4)


def test_windows_share_memory_and_leave_nothing_behind():
    rng = np.random.default_rng(4)
    used = gru.Network(gru.Layout(10, 4, 3), 5)
    kept_states = []
    for lengths, steps in (([9, 6, 2], 7), ([3, 1], 7), ([8, 8, 1], 5)):
        fresh = gru.Network(gru.Layout(10, 4, 3), 5)
        texts, found = [rng.integers(0, 13, n) for n in lengths], []
        for network in (used, fresh):
            grow = gru.Network(network.layout, 5).load(np.zeros(len(network.vector())))
            inputs, targets, live, h = gru.Lanes(texts, len(texts), steps, network).window()
            states, kept = network.run(inputs, h, live)
            lives = np.arange(len(h))[None, :] < live[:, None]
            logs, back = network.log_probabilities(states[lives], targets[lives], grow)
            spread = np.full(states.shape, np.nan, np.float32)
            spread[lives] = back
            network.gradient(kept, inputs, live, spread, grow)
            found.append((states[lives], logs, grow.vector(), kept[0]))
        for ours, theirs in zip(found[0][:3], found[1][:3]):
            assert np.array_equal(ours, theirs)
        kept_states.append(found[0][3])
        assert np.array_equal(used.states(inputs, h, live)[lives], fresh.states(inputs, h, live)[lives])
    # The largest window came first; the others lie where it lay.
    assert all(np.shares_memory(kept_states[0], other) for other in kept_states[1:])


def test_large_sums_leave_the_gates_finite():
    network = gru.Network(gru.Layout(10, 4, 3), 5)
    network.x *= 1e4
    window = np.arange(13)[:, None], np.zeros((1, 5), np.float32), np.ones(13, int)
    states, kept = network.run(*window)
    assert all(np.isfinite(a).all() for a in (states, *kept)) and np.abs(states).max() <= 1
    states = states.copy()
    assert np.array_equal(network.states(*window), states)


@pytest.mark.parametrize("ids", [5, 70_000])
def test_rows_of_repeated_ids_add_up(ids):
    rng = np.random.default_rng(6)
    values, at = rng.standard_normal((400, 3)), rng.permutation(400)[:300]
    rows = np.minimum(rng.geometric(0.1, 300) - 1, ids - 1)
    table, expected = np.zeros((ids, 3)), np.zeros((ids, 3))
    gru._add_rows(table, rows, values, at)
    np.add.at(expected, rows, values[at])
    assert np.allclose(table, expected)


def test_training_learns_order():
    layout = gru.Layout(6, 3, 2)
    network = gru.Network(layout, 16)
    texts = [np.array([0, 1, 2, 3, 4, 5, 6, 7] * 6) for _ in range(800)]
    before = gru.score(network, texts[:1], 1, 8)[0]
    gru.train(network, texts, 16, 16, 0.02)
    assert gru.score(network, texts[:1], 1, 8)[0] > 0.2 * before


def test_training_reads_every_token_and_carries_the_state(monkeypatch):
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 13, n) for n in (400, 3, 97, 1, 96, 250, 0)]
    network = gru.Network(gru.Layout(10, 4, 3), 5)
    seen, starts, ran, learnt = [], [], network.run, network.log_probabilities
    monkeypatch.setattr(network, "run", lambda ids, h, live: starts.append(np.abs(h).sum(axis=1) > 0) or ran(ids, h, live))
    monkeypatch.setattr(network, "log_probabilities", lambda s, t, grow: seen.extend(t.tolist()) or learnt(s, t, grow))
    gru.train(network, texts, 2, 96, 0.02)
    assert Counter(seen) == Counter(np.concatenate(texts).tolist())
    # A window starts from zero once for each text and from a carried state otherwise.
    assert sum((~s).sum() for s in starts) == 6 and sum(s.sum() for s in starts) == 4 + 1 + 2


def test_training_takes_whole_texts(spark):
    docs = spark.createDataFrame([(i, "a b c " * 700) for i in range(5)], DOCS)
    known = L.vocabulary(L.counts(docs))
    rows = L.read_texts(docs, spark.sparkContext.broadcast(known)).collect()
    assert [len(r.ids) for r in rows] == [2_101] * 5


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    tongues = [[f"{a}{b}" for b in "abcdefghij"] for a in ("the", "un", "der", "zz")]
    rows = []
    for i in range(n):
        tongue = tongues[i % 4]
        rows.append((i, " ".join(rng.choice(tongue) if rng.random() < 0.97 else f"rare{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 60)))))
    return rows + [(5000, None), (5001, "  "), (None, "Thea THEB"), (7, "thea"), (7, "thea"), (5002, "unb " * 3000)]


def test_base_scores_are_exact_and_the_network_beats_them(spark, monkeypatch):
    monkeypatch.setattr(L, "KNOWN", 60)
    monkeypatch.setattr(L, "CLOSED", 30)
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], DOCS + ", score double")
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0 for i, _ in rows]
    words = [[*(t or "").lower().split(), ""] for _, t in rows]
    counts = Counter(w for ws, out in zip(words, held) if not out for w in ws)
    n, v = sum(counts.values()), len(counts)
    expected = sorted(
        (str(i), out, len(ws), sum(w in counts for w in ws), n, round(sum(log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 4))
        for (i, _), ws, out in zip(rows, words, held)
    )
    got = L.score(docs).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == expected
    unseen = [r for r in got if r.held_out and r.doc_id not in (5000, 5001)]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def log10_by_loops(words, known, network, counts, total, distinct):
    """The score of one text, token by token from the formulas of a gated recurrent network."""
    h, n = np.zeros(network.hidden), network.layout
    size, result, last = network.hidden, 0.0, n.ids
    rank = {w: i for i, w in enumerate(known.words)}
    in_class = Counter(zlib.crc32(w[-2:]) % L.OPEN for w in (c.encode() for c in counts) if rank.get(w, n.n_words) >= n.n_words)
    tokens = Counter()
    for word, times in counts.items():
        if rank.get(word.encode(), n.n_words) >= n.n_words:
            tokens[zlib.crc32(word.encode()[-2:]) % L.OPEN] += times
    for word in (w.encode() for w in words):
        x = network.x[last].astype(float)
        gates = 1 / (1 + np.exp(-(h @ network.u + x[: 2 * size])))
        z, r = gates[:size], gates[size:]
        h = (1 - z) * h + z * np.tanh((r * h) @ network.v + x[2 * size :])
        closed = rank.get(word, n.n_words) < n.n_words
        ending = zlib.crc32(word[-2:]) % L.OPEN
        k = rank[word] // n.per_class if closed else n.closed + ending
        logits = np.exp(h @ network.c + network.d)
        p = logits[k] / logits.sum()
        if closed:
            inside = np.exp(h @ network.w[k] + network.e[k])
            p *= inside[rank[word] % n.per_class] / inside.sum()
            last = rank[word]
        else:
            p *= (counts[word.decode()] + L.SMOOTH) / (tokens[ending] + L.SMOOTH * (in_class[ending] + 1))
            last = n.n_words + ending
        result += log10(p)
    return result


def test_scores_equal_plain_loops(spark, monkeypatch):
    for name, value in (("KNOWN", 60), ("CLOSED", 30)):
        monkeypatch.setattr(L, name, value)
    rows, kept, learn, count = corpus(), {}, L.trained_weights, L.vocabulary
    monkeypatch.setattr(L, "trained_weights", lambda *a: kept.setdefault("weights", learn(*a)))
    monkeypatch.setattr(L, "vocabulary", lambda *a: kept.setdefault("known", count(*a)))
    got = L.score(spark.createDataFrame(rows, DOCS)).collect()
    network = kept["known"].network().load(kept["weights"])
    words = [[*(t or "").lower().split(), ""] for _, t in rows]
    counts = Counter(w for (i, _), ws in zip(rows, words) if i is not None and zlib.crc32(str(i).encode()) % 10 for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    by_hand = sorted((str(i), len(ws), log10_by_loops(ws, kept["known"], network, counts, total, distinct)) for (i, _), ws in zip(rows, words))
    found = sorted((str(r.doc_id), r.n_tokens, r.score) for r in got)
    assert [f[:2] for f in found] == [b[:2] for b in by_hand]
    assert [f[2] for f in found] == pytest.approx([b[2] for b in by_hand], rel=1e-4)
    moved = np.abs(kept["weights"] - kept["known"].network().vector())
    assert moved.max() > 0.01


def test_no_training_documents(spark):
    first = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    rows = L.score(spark.createDataFrame([(first, "a b")], DOCS)).collect()
    assert len(rows) == 1 and rows[0].held_out and rows[0].train_tokens == 0 and rows[0].n_known == 0
    assert rows[0].base_score == 0.0 and rows[0].score <= 0.0


def test_no_documents(spark):
    assert L.score(spark.createDataFrame([], DOCS)).count() == 0


def test_words_of():
    assert L.words_of("A\x0bÉb\xa0c\n") == [b"a", "Éb\xa0c".encode(), b""]
