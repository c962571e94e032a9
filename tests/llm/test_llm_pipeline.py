"""The pipeline against what plain loops keep, and its stages one by one."""

import random
import tempfile
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from stockrecon.llm import bin_slack, pfair
from stockrecon.llm.common import durable

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


def corpus():
    """Rows, labels and the ids that should stay: good, long enough, first of their copies."""
    rng = random.Random(8)
    rows, labels, stay = [], [], set()

    def prose(n):
        return ["".join(rng.choice("aeioudnrstlm") for _ in range(rng.randrange(2, 8))) for _ in range(n)]

    def add(text, good, clean):
        i = len(rows)
        rows.append((i, text, rng.choice(("en", "de")), f"src{rng.randrange(4)}", len(text)))
        if i % 2:
            labels.append((i, int(good), 0))
        if clean:
            stay.add(i)
        return i

    for k in range(240):
        words = prose(rng.randrange(60, 140))
        add(" ".join(words) + ".", True, True)
        if k % 6 == 0:  # a copy in other white space and case, and a near copy
            add("\n".join(w.upper() if w == words[3] else w for w in words) + ".", True, False)
            add(" ".join(words[:-1]) + " changed.", True, False)
        if k % 5 == 0:
            add(" ".join(w + rng.choice(("$$$", "###", "&&&")) for w in prose(80)), False, False)
        if k % 8 == 0:
            add(" ".join(prose(20)), True, False)  # too short for the base rule
    return rows, labels, stay


@pytest.fixture(scope="module")
def folder(spark):
    path = tempfile.mkdtemp(prefix="corpus-")
    rows, labels, stay = corpus()
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{path}/labels.parquet")
    return path, {r[0]: r[1] for r in rows}, stay


def test_stages_keep_columns_and_clean_documents(spark, folder):
    path, texts, stay = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "quality rules", "MinHash near-dedup", "mixing sources to target weights", "packing"]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        after = durable(stage(spark, docs, path), f"test-{number}")
        assert after.columns == docs.columns
        kept = {r.doc_id: r.text for r in after.select("doc_id", "text").collect()}
        assert stay <= set(kept) and all(texts[i] == t for i, t in kept.items())
        docs = after
    assert set(kept) == stay


def test_run_packs_exactly_the_kept_documents(spark, folder):
    path, texts, stay = folder
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, filled = defaultdict(list), defaultdict(int)
    for r in corpus_pipeline.run(spark, path).collect():
        pieces[r.doc_id].append(r)
        filled[r.sequence_id] += r.length
    assert set(pieces) == stay and max(filled.values()) <= 1024
    for i, parts in pieces.items():
        ids, at = [*library.encode(texts[i], add_special_tokens=False).ids, 0], 0
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == at and r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)


def test_prefixes_of_the_sequences_have_the_target_shares(spark, monkeypatch):
    monkeypatch.setattr(pfair, "BLOCK_CHARS", 3_000)
    monkeypatch.setattr(bin_slack, "RANGE_BLOCKS", 4)
    rng = random.Random(3)
    rows = []
    for i in range(1_500):
        source = "hot" if i % 10 < 8 else "ab"[i % 2]
        words = rng.randrange(1_500, 3_000) if i % 40 == 0 else rng.randrange(5, 200)
        rows.append((i, " ".join(rng.choice(("thing", "of", "little")) for _ in range(words)), "en", source, 0))
    docs = spark.createDataFrame(rows, DOCS)
    sizes = {r.source: r.weight for r in corpus_pipeline.target_weights(docs).collect()}
    target = {s: w / sum(sizes.values()) for s, w in sizes.items()}
    left = {s: sum(len(r[1]) for r in rows if r[3] == s) for s in target}
    assert left["hot"] / sum(left.values()) > target["hot"] + 0.15
    stored = durable(corpus_pipeline.mixture(spark, docs, "").repartition(7), "shuffled")
    source = {r[0]: r[3] for r in rows}
    by_sequence = defaultdict(lambda: defaultdict(int))
    for r in corpus_pipeline.packing(spark, stored, "").collect():
        by_sequence[r.sequence_id][source[r.doc_id]] += r.length
    whole = {s: sum(x[s] for x in by_sequence.values()) for s in target}
    done, total, checked = dict.fromkeys(target, 0), 0, 0
    for number in range(len(by_sequence)):
        for s, n in by_sequence[number].items():
            done[s] += n
        total = sum(done.values())
        if any(done[s] > 0.9 * whole[s] for s in target):
            break
        # One block and the longest document beside it, and a range that is not finished.
        if total > 30_000:
            checked += 1
            for s in target:
                assert abs(done[s] / total - target[s]) < 0.1, (number, s)
    assert set(by_sequence) == set(range(len(by_sequence))) and checked > 10


def test_packing_follows_the_mix_of_the_stage_before(spark, monkeypatch):
    monkeypatch.setattr(pfair, "BLOCK_CHARS", 500)
    monkeypatch.setattr(bin_slack, "RANGE_BLOCKS", 1)
    rows = [(i, f"thing {i} " * 30, "en", None if i % 7 == 0 else "ab"[i % 2], 0) for i in range(200)]
    docs = spark.createDataFrame(rows, DOCS)

    def first_half(mixed):
        packed = corpus_pipeline.packing(spark, durable(mixed.repartition(3), "mixed"), "").collect()
        middle = max(r.sequence_id for r in packed) // 2
        return sum(rows[r.doc_id][3] == "a" for r in packed if r.sequence_id < middle)

    # Another mix gives other sequences, and without one there are none.
    much, little = (first_half(pfair.with_weights(docs, {"a": a, "b": 1 - a, "": 0.01})) for a in (0.9, 0.1))
    assert much > 1.5 * little
    monkeypatch.setattr(corpus_pipeline, "target_weights", lambda docs: spark.createDataFrame([("a", 0.9), ("b", 0.1), ("", 0.01)], "source string, weight double"))
    assert first_half(corpus_pipeline.mixture(spark, docs, "")) == much
    with pytest.raises(ValueError, match="not mixed"):
        corpus_pipeline.packing(spark, docs, "")


def test_weights_stay_with_stored_documents(spark, tmp_path):
    docs = spark.createDataFrame([(1, "x", "en", 'a "b"', 1), (2, "y", "en", None, 1)], DOCS)
    weights = {'a "b"': 0.1 + 0.2, "": 3.0}
    pfair.with_weights(docs, weights).write.parquet(f"{tmp_path}/docs")
    stored = spark.read.parquet(f"{tmp_path}/docs")
    assert pfair.weights_with(stored) == weights and stored.columns == docs.columns
    assert pfair.weights_with(pfair.with_weights(docs, {})) == {}


def test_no_documents(spark):
    path = tempfile.mkdtemp(prefix="corpus-")
    spark.createDataFrame([], DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{path}/labels.parquet")
    assert corpus_pipeline.run(spark, path).count() == 0
