"""Pfair: releases, deadlines and less than one block of deviation; nothing is lost."""

import random

import pytest

from stockrecon.llm import pfair as P

DOCS = "doc_id long, text string, source string"


def plan(spark, weights, period):
    frame = spark.createDataFrame(list(weights.items()), "source string, weight double")
    return P.schedule(frame, period).collect()


@pytest.mark.parametrize("seed", range(4))
def test_deviation_stays_below_one_block(spark, seed):
    rng = random.Random(seed)
    weights = {f"s{i}": rng.random() ** 3 + 0.001 for i in range(rng.choice([1, 2, 7, 20]))}
    rows = plan(spark, weights, 200)
    assert sorted(r.slot for r in rows) == list(range(200))
    turns = {r.source: r.turns for r in rows}
    total = sum(weights.values())
    for source, n in turns.items():
        assert abs(n - 200 * weights[source] / total) <= 2 + len(weights) * weights[source] / total
    done = dict.fromkeys(turns, 0)
    for r in sorted(rows, key=lambda r: r.slot):
        assert r.turn == done[r.source]
        assert r.turn * 200 // r.turns <= r.slot < -(-(r.turn + 1) * 200 // r.turns)
        done[r.source] += 1
        for source, n in turns.items():
            assert abs(done[source] - n * (r.slot + 1) / 200) < 1


def test_more_sources_than_slots(spark):
    rows = plan(spark, {f"s{i}": 1.0 for i in range(30)}, 10)
    assert len(rows) == 30 and {r.turns for r in rows} == {1}


def corpus(spark):
    rng = random.Random(1)
    rows = [(i, "x" * rng.randrange(0, 300), "hot" if i % 3 else f"s{i % 7}") for i in range(900)]
    rows += [(5000, None, None), (None, "yy", "hot"), (7, "again", "s0"), (7, "again", "s0")]
    return spark.createDataFrame(rows, DOCS)


def test_blocks_follow_running_sizes(spark, monkeypatch):
    monkeypatch.setattr(P, "RUN_ROWS", 50)
    light = P._sizes(corpus(spark))
    rows = P.blocks(light, P._runs(light), block_chars=1000).collect()
    assert len(rows) == 904
    by_source = {}
    for r in sorted(rows, key=lambda r: (r.source, r.place, -1 if r.doc_id is None else r.doc_id, r.size)):
        before = by_source.get(r.source, 0)
        assert r.block == before // 1000
        by_source[r.source] = before + r.size


def test_mix_keeps_every_row_and_the_weights(spark):
    docs = corpus(spark)
    weights = {"hot": 0.5, "s1": 0.25, "s2": 0.25}
    rows = P.mix(docs, weights, block_chars=500, period=100).collect()
    assert sorted(map(str, (r.doc_id for r in rows))) == sorted(map(str, (r.doc_id for r in docs.collect())))
    slots = {}
    for r in rows:
        assert slots.setdefault(r.slot, (r.source, r.block)) == (r.source, r.block)
    # While all sources last, each prefix of slots is within a block of the shares.
    shares = {r.source: r.turns / r.period for r in P.schedule(P._with_targets(P.weights_of(docs), spark.createDataFrame(list(weights.items()), "source string, weight double")), 100).collect()}
    last = min(max(s for s, (x, _) in slots.items() if x == source) for source in ("hot", "s1", "s2"))
    for source in ("hot", "s1", "s2"):
        done = 0
        for slot in range(last + 1):
            done += slots.get(slot, ("", 0))[0] == source
            assert abs(done - shares[source] * (slot + 1)) < 1


def test_in_order_keeps_columns_and_rows(spark):
    docs = corpus(spark).selectExpr("*", "1 AS mix_slot", "2 AS slot")
    ordered = P.in_order(docs)
    assert ordered.columns == docs.columns
    key = lambda r: (str(r.doc_id), str(r.text))
    assert sorted(map(key, ordered.collect())) == sorted(map(key, docs.collect()))


def test_in_order_follows_the_mix(spark):
    docs = corpus(spark).where("doc_id IS NOT NULL AND doc_id <> 7")
    slot = {r.doc_id: (r.slot, r.place) for r in P.mix(docs).collect()}
    order = [slot[r.doc_id] for r in P.in_order(docs).collect()]
    assert order == sorted(order)


def test_no_documents(spark):
    empty = spark.createDataFrame([], DOCS)
    assert P.mix(empty).count() == 0 and P.in_order(empty).count() == 0


def laid(spark, rows):
    frame = spark.createDataFrame(rows, "source string, target double, weight double, blocks long")
    found = sorted((r.step, r.slot, r.source, r.block) for r in P.timetable(frame).collect())
    assert [r[0] for r in found] == list(range(sum(r[3] for r in rows)))
    return found


@pytest.mark.parametrize("n,blocks", [(1, 500), (20, 3_000), (100, 1_500), (500, 1_200)])
def test_turns_stay_within_one_block_of_the_targets_themselves(spark, monkeypatch, n, blocks):
    monkeypatch.setattr(P, "FOLD_BLOCKS", 300)
    monkeypatch.setattr(P, "ROW_BLOCKS", 900)
    rest = 0.5 / (n - 1) if n > 1 else None
    shares = {"s0": 0.5} | {f"s{i}": rest for i in range(1, n)}
    rows = [(s, 0.5 if s == "s0" else None, 1.0, blocks // 2 if s == "s0" else blocks // 2 // (n - 1) + 1) for s in shares]
    done = dict.fromkeys(shares, 0)
    for step, slot, source, block in laid(spark, rows)[: blocks // 2]:
        assert block == done[source] and (n == 1 or slot == step)
        done[source] += 1
        for s in {"s0", source, f"s{step % n}"} if n > 1 else ():
            assert abs(done[s] - (slot + 1) * shares[s]) < 1 + 1e-9


def test_turns_keep_proportions_when_a_source_has_run_out(spark):
    rows = laid(spark, [("a", 0.5, 1.0, 10), ("b", 0.3, 1.0, 200), ("c", 0.2, 1.0, 3)])
    assert len({slot for _, slot, _, _ in rows}) == 213
    for _, slot, source, k in rows:
        w = {"a": 0.5, "b": 0.3, "c": 0.2}[source]
        assert k / w - 1 < slot < (k + 1) / w + 1


def test_prefixes_of_a_mix_follow_the_targets(spark):
    rows = [(i, "x" * 100, f"s{i % 20}") for i in range(12_000)]
    weights = {"s0": 0.5}
    slots = {(r.source, r.block): r.slot for r in P.mix(spark.createDataFrame(rows, DOCS), weights, block_chars=100).collect()}
    order = sorted((slot, source) for (source, _), slot in slots.items())
    done = 0
    for slot, source in order[:1_100]:
        done += source == "s0"
        assert abs(done - 0.5 * (slot + 1)) < 1
    assert [s for s, _ in order[:1_100]] == list(range(1_100))


def test_sources_without_a_share_come_last(spark):
    rows = [(i, "x" * 100, f"s{i % 3}") for i in range(90)]
    slots = {(r.source, r.block): r.slot for r in P.mix(spark.createDataFrame(rows, DOCS), {"s0": 0.9, "s1": 0.1}, block_chars=100).collect()}
    assert len(slots) == len(set(slots.values())) == 90
    assert min(s for (x, _), s in slots.items() if x == "s2") > max(s for (x, _), s in slots.items() if x != "s2")
