"""Site quality: the regression, the shrinkage and held-out accuracy."""

import random

import numpy as np

from stockrecon.llm import site_quality as Q

DOCS = "doc_id long, text string, lang string, source string"
LABELS = "doc_id long, quality int, toxic int"


def corpus(n=1500, seed=1):
    rng = random.Random(seed)
    rows, labels, truth = [], [], {}
    for i in range(n):
        site = i % 10
        good = rng.random() < (0.1 if site == 0 else 0.9)
        words = ["".join(rng.choice("aeioudnrst") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(5, 90))]
        text = " ".join(words) + "." if good else " ".join(w + rng.choice(("$$$", "###", "&&&")) for w in words)
        rows.append((i, text, "en" if i % 2 else "de", f"src{site}"))
        truth[i] = good
        if i % 3 == 0:
            labels.append((i, int(good), 0))
    return rows, labels, truth


def test_held_out_accuracy(spark):
    rows, labels, truth = corpus()
    got = {r.doc_id: r for r in Q.classify(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)).collect()}
    rest = [i for i in truth if i % 3]
    assert sum(got[i].kept == truth[i] for i in rest) / len(rest) > 0.97
    rates = {r.host: r.site_rate for r in got.values()}
    assert rates["src0"] < 0.3 and min(v for k, v in rates.items() if k != "src0") > 0.7


def test_sparse_sites_shrink(spark):
    rows, labels, _ = corpus()
    rows += [(9000, rows[0][1], "fr", "lonely"), (9001, "x $$$ ###", "xx", "src1")]
    got = {r.doc_id: r for r in Q.classify(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)).collect()}
    overall = np.mean([r.site_rate for r in got.values()])
    assert abs(got[9000].site_rate - overall) < 0.15  # one document tells little of its site
    near = [r.site_rate for r in got.values() if r.host == "src1" and r.path == "en"]
    assert abs(got[9001].site_rate - np.mean(near)) < 0.15  # a new path takes after its host


def test_posterior_formula(spark):
    light = spark.createDataFrame(
        [("a", "x", [0.0], 1), ("a", "x", [0.0], 1), ("a", "y", [0.0], 0), ("b", "x", [0.0], 0), ("b", "x", [0.0], 0), ("b", "z", [0.0], 1)],
        "host string, path string, features array<double>, quality int",
    )
    model = Q.posteriors(light, np.array([]), 0.0)
    rows = {(r.host, r.path): r for r in model.sites.collect()}
    assert (rows["a", "x"].n, rows["a", "x"].good) == (2, 2.0) and (rows["b", "x"].n, rows["b", "x"].good) == (2, 0.0)
    assert (rows["a", "y"].host_n, rows["a", "y"].host_good) == (3, 2.0)
    assert model.rate == (3 + 0.5) / 7 and model.path_strength >= Q.WEAKEST


def test_regression_recovers_weights():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((20_000, 3))
    p = 1 / (1 + np.exp(-(x @ [2.0, -1.0, 0.0] + 0.5)))
    weights, _ = Q.fit(x, (rng.random(len(x)) < p).astype(float))
    assert np.allclose(weights, [2, -1, 0], atol=0.1)


def test_bounded_sample(spark):
    rows, labels, _ = corpus(300)
    light = Q._light(spark.createDataFrame(rows, DOCS), "source", "lang")
    x, good = Q.sample(light, spark.createDataFrame(labels, LABELS), rows=40)
    assert len(x) == len(good) == 40


def test_one_class_keeps_all(spark):
    rows, labels, _ = corpus(60)
    only = spark.createDataFrame([(i, 1, 0) for i, _, _ in labels], LABELS)
    assert all(r.kept for r in Q.classify(spark.createDataFrame(rows, DOCS), only).collect())


def test_nulls_repeats_and_clashing_columns(spark):
    rows, labels, _ = corpus(300)
    rows = [(*r, 1, "x") for r in rows] + [(None, None, None, None, None, None), (0, *rows[0][1:], 1, "x")]
    docs = spark.createDataFrame(rows, DOCS + ", n int, features string")
    told = spark.createDataFrame(labels + [(3, 1, 0), (None, 1, 0), (4, None, 1)], LABELS)
    kept = Q.keep(docs, told)
    assert kept.columns == docs.columns
    judged = Q.classify(docs, told)
    assert judged.count() == 302 and kept.count() == judged.where("kept").count()


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


def logit(p):
    p = min(max(p, 1e-6), 1 - 1e-6)
    return np.log(p / (1 - p))


def test_rates_and_verdicts_equal_plain_loops(spark):
    """Every document against the sums over the others of its path and host."""
    rng = random.Random(4)
    rows, labels, _ = corpus(400, 3)
    rows += [(i, rows[i][1], "fr", f"src{i % 10}") for i in rng.sample(range(400), 40)]  # repeated ids at other sites
    rows += [(None, "no id $$$", None, None), (None, None, None, "src1")]
    labels = labels + [(3, 0, 0), (3, 1, 0)]
    docs, told = spark.createDataFrame(rows, DOCS).repartition(5), spark.createDataFrame(labels, LABELS)
    light = Q._light(docs, "source", "lang")
    marked, known = Q.labelled(light, told)
    model = Q.model_of(marked, known)
    got = [r.asDict() for r in Q.decide(marked.withColumn("label", marked["quality"]), model).collect()]
    assert len(got) == len(rows)
    for r in got:
        llr = model.intercept + sum(w * x for w, x in zip(model.weights, r["features"]))
        r["llr"] = min(max(llr, -30), 30)
        r["own"] = float(r["label"]) if r["label"] is not None else round(sigmoid(r["llr"] + logit(model.share)), 6)
    for r in got:
        host = [o for o in got if o is not r and o["host"] == r["host"]]
        path = [o for o in host if o["path"] == r["path"]]
        host_rate = (sum(o["own"] for o in host) + model.host_strength * model.rate) / (len(host) + model.host_strength)
        rate = (sum(o["own"] for o in path) + model.path_strength * host_rate) / (len(path) + model.path_strength)
        assert abs(r["site_rate"] - rate) < 1e-7
        quality = sigmoid(r["llr"] + logit(rate))
        assert abs(r["quality"] - quality) < 1e-6
        assert r["kept"] == (r["quality"] >= Q.KEEP_FROM)
    stays = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["host"], r["path"]) for r in got if r["kept"])
    kept = Q.keep(docs, told).collect()
    assert stays == sorted((r.doc_id is None, r.doc_id or 0, r.source or "", r.lang or "") for r in kept)


def test_own_label_does_not_bear_on_the_own_prior(spark):
    """Two equal texts on a site, one labelled: its label may not move its own rate."""
    text = " ".join(f"w{i}" for i in range(60))
    rows, labels, _ = corpus(400, 3)
    rows += [(9001, text, "en", "x"), (9002, text, "en", "x"), (9003, text, "en", "y"), (9004, text, "en", "y")]
    told = spark.createDataFrame(labels + [(9001, 1, 0), (9003, 0, 0)], LABELS)
    got = {r.doc_id: r.site_rate for r in Q.classify(spark.createDataFrame(rows, DOCS), told).collect()}
    assert abs(got[9001] - got[9003]) < 1e-9 and got[9002] > got[9004]


def test_real_hosts_and_paths_may_be_named(spark):
    rows, labels, _ = corpus(300)
    docs = spark.createDataFrame([(i, t, f"www.{s}.org", f"/{p}/") for i, t, p, s in rows], "doc_id long, text string, site string, folder string")
    told = spark.createDataFrame(labels, LABELS)
    one = {r.doc_id: r.quality for r in Q.classify(docs, told, "site", "folder").collect()}
    two = {r.doc_id: r.quality for r in Q.classify(spark.createDataFrame(rows, DOCS), told).collect()}
    assert one == two


def test_no_documents(spark):
    empty, none = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert Q.classify(empty, none).count() == 0 and Q.keep(empty, none).count() == 0
