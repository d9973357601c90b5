import math

from pyspark.sql import functions as F

from topiclens.operators import topics as TP


def test_u_mass_always_together_is_zero(spark):
    # terms a, b appear together in half of the 10 documents
    doc_terms = spark.createDataFrame([(d, t) for d in range(5) for t in ("a", "b")] + [(d, "c") for d in range(5, 10)],
                                      "doc_id long, term string")
    top = spark.createDataFrame([(0, "a", 1), (0, "b", 2)], "topic int, term string, rank int")
    v = TP.u_mass(doc_terms, top, 10).first()["coherence"]
    assert abs(v) < 1e-9
    v1 = TP.u_mass(doc_terms, top, 10, smoothing="plus_one").first()["coherence"]
    assert abs(v1 - math.log(6 / 5)) < 1e-12


def test_u_mass_matches_brute_force(spark):
    import itertools
    import random

    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(8)]
    docs = {d: set(rnd.sample(vocab, rnd.randint(1, 5))) for d in range(40)}
    doc_terms = spark.createDataFrame([(d, t) for d, ts in docs.items() for t in ts], "doc_id long, term string")
    ranked = {0: vocab[:5], 1: vocab[3:]}
    top = spark.createDataFrame([(k, t, i + 1) for k, ts in ranked.items() for i, t in enumerate(ts)],
                                "topic int, term string, rank int")
    got = {r.topic: r.coherence for r in TP.u_mass(doc_terms, top, 40).collect()}
    for k, ts in ranked.items():
        scores = []
        for i, j in itertools.combinations(range(len(ts)), 2):  # j after i: i is the higher-ranked term
            wi, wj = ts[j], ts[i]
            dij = sum(1 for s in docs.values() if wi in s and wj in s)
            dj = sum(1 for s in docs.values() if wj in s)
            scores.append(math.log((dij / 40 + 1e-12) / (dj / 40)))
        assert abs(got[k] - sum(scores) / len(scores)) < 1e-9


def topic_term(spark):
    rows = [(0, "a", 0.5), (0, "b", 0.5), (1, "b", 0.25), (1, "c", 0.75), (2, "a", 0.5), (2, "b", 0.5)]
    return spark.createDataFrame(rows, "topic int, term string, p double")


def test_jsd(spark):
    d = {(r.topic_a, r.topic_b): r.jsd for r in TP.topic_distance(topic_term(spark)).collect()}
    assert abs(d[(0, 2)]) < 1e-12
    p, q = {"a": 0.5, "b": 0.5}, {"b": 0.25, "c": 0.75}
    ref = 0.0
    for w in "abc":
        pw, qw = p.get(w, 0), q.get(w, 0)
        m = (pw + qw) / 2
        ref += 0.5 * ((pw * math.log(pw / m) if pw else 0) + (qw * math.log(qw / m) if qw else 0))
    assert abs(d[(0, 1)] - ref) < 1e-12
    assert 0 <= d[(0, 1)] <= math.log(2)


def test_relevance_and_saliency(spark):
    tt = topic_term(spark)
    tf = spark.createDataFrame([("a", 10), ("b", 30), ("c", 60)], "term string, freq long")
    rel = TP.term_relevance(tt, tf, lam=1.0, n=1).collect()
    # lambda = 1 ranks by p(w|t)
    assert {(r.topic, r.term) for r in rel} == {(0, "a"), (1, "c"), (2, "a")}
    dt = spark.createDataFrame([(1, 0, 1.0), (2, 1, 1.0), (3, 2, 1.0)], "doc_id long, topic int, p double")
    prev = TP.topic_prevalence(dt)
    assert abs(sum(r.share for r in prev.collect()) - 1) < 1e-12
    sal = TP.term_saliency(tt, prev, tf, n=3).collect()
    assert [r["rank"] for r in sal] == [1, 2, 3]


def test_topic_map_2d(spark):
    tt = topic_term(spark)
    dt = spark.createDataFrame([(1, 0, 1.0), (2, 1, 1.0), (3, 2, 1.0)], "doc_id long, topic int, p double")
    m = {r.topic: (r.x, r.y) for r in TP.topic_map_2d(TP.topic_distance(tt), TP.topic_prevalence(dt)).collect()}
    # identical topics 0 and 2 land on the same point
    assert abs(m[0][0] - m[2][0]) < 1e-9 and abs(m[0][1] - m[2][1]) < 1e-9


def test_u_mass_of_two_hundred_terms_matches_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(9)
    n_docs, n_top = 300, 200
    has = rng.random((n_docs, n_top + 20)) < rng.random(n_top + 20) * 0.5
    has[0] = True  # every term is somewhere
    rows = [(int(i), f"w{j:03d}") for i, j in zip(*np.nonzero(has))]
    doc_terms = spark.createDataFrame(rows, "doc_id long, term string").repartition(4)
    top = spark.createDataFrame([(t, f"w{j + 20 * t:03d}", j + 1) for t in range(2) for j in range(n_top)], "topic int, term string, rank int")
    got = {r.topic: r.coherence for r in TP.u_mass(doc_terms, top, n_docs).collect()}
    for t in range(2):
        x = has[:, 20 * t:20 * t + n_top].astype(float)
        both, one = x.T @ x / n_docs, x.mean(axis=0)
        want = np.mean([np.log((both[i, j] + 1e-12) / one[j]) for i in range(n_top) for j in range(i)])
        assert abs(got[t] - want) < 1e-9
    models = top.select(F.when(F.col("topic") == 0, 7).otherwise(8).alias("model"), "topic", "term", "rank")
    by_model = TP.coherence_of_models(doc_terms, models.unionByName(models.filter("topic = 0").withColumn("model", F.lit(8))), n_docs)
    both = {r.model: r.coherence for r in by_model.collect()}
    assert abs(both[7] - got[0]) < 1e-12 and abs(both[8] - (got[0] + got[1]) / 2) < 1e-12
    plan = by_model._jdf.queryExecution().toString()
    assert plan.count("== Physical Plan ==") == 1


def test_fold_in_sends_plain_numbers_and_keeps_every_document(spark):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(3)
    terms = [f"w{i}" for i in range(40)]
    model = [(t, w, float(p)) for t in ("a", "b", "c") for w, p in zip(terms, rng.dirichlet(np.ones(40))) if p > 0.004]
    docs = [(d, w, int(rng.integers(1, 9))) for d in [*range(300), None] for w in rng.choice(terms, 1 + (d or 0) % 30, False)]
    docs += [(0, terms[0], 2), (0, terms[0], 2), (1000, "unknown", 5)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # documents go on in later batches
    try:
        out = TP.fold_in(spark.createDataFrame(docs, "doc_id long, term string, tf long"),
                         spark.createDataFrame(model, "topic string, term string, p double"), ["a", "b", "c"], 4)
        sent = out._jdf.queryExecution().optimizedPlan().toString()
        got = {(r["doc_id"], r["topic"]): r["p"] for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "collect_list" not in sent
    p_of = {(t, w): p for t, w, p in model}
    seen = 0
    for d, rows in pd.DataFrame([(-1 if d is None else d, w, n) for d, w, n in docs]).groupby(0):
        p = np.array([[p_of.get((t, w), 0.0) for t in "abc"] for w in rows[1]])
        tf, p = rows[2].to_numpy(float)[p.any(axis=1)], p[p.any(axis=1)]
        if not len(p):
            continue
        seen += 1
        theta = np.full(3, 1 / 3)
        for _ in range(4):
            theta = (tf[:, None] * p * theta / (p * theta).sum(axis=1, keepdims=True)).sum(axis=0) / tf.sum()
        assert np.allclose([got[None if d == -1 else d, t] for t in "abc"], theta, atol=1e-12)
    assert len(got) == 3 * seen and (1000, "a") not in got
