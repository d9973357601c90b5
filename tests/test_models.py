import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from topiclens.operators import vocabulary as VO
from topiclens.plans import models as MD


def test_lda_separates_planted_topics(spark):
    rng = np.random.default_rng(0)
    a = [f"alpha{i}" for i in range(10)]
    b = [f"beta{i}" for i in range(10)]
    docs = [(i, list(rng.choice(a if i < 100 else b, 30))) for i in range(200)]
    toks = spark.createDataFrame(docs, "doc_id long, tokens array<string>")
    counts = VO.term_counts(toks)
    vocab = VO.filter_extremes(VO.build_vocabulary(counts), 200, keep_n=100)
    terms = MD.vocabulary_terms(vocab)
    vec = MD.count_vectors(toks, terms, out_col="features")
    model = MD.lda_fit(vec, 2, seed=16, max_iter=30, optimizer="em")
    top = MD.describe_topics(model, terms, 5).collect()
    groups = {}
    for r in top:
        groups.setdefault(r.topic, set()).add(r.term[:4])
    assert sorted(tuple(sorted(v)) for v in groups.values()) == [("alph",), ("beta",)]
    dt = MD.doc_topics(model, vec).groupBy("doc_id").agg(F.sum("p").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-6 for r in dt)


def test_tfidf_vectors_match_long_form(spark):
    toks = spark.createDataFrame([(1, ["a", "b", "b"]), (2, ["a", "c"]), (3, ["c"])], "doc_id long, tokens array<string>")
    counts = VO.term_counts(toks)
    vocab = VO.filter_extremes(VO.build_vocabulary(counts), 3, keep_n=100)
    terms = MD.vocabulary_terms(vocab)
    vec = MD.tfidf_vectors(MD.count_vectors(toks, terms), MD.log2_idf(vocab, 3))
    long = {(r.doc_id, r.term_id): r.weight for r in VO.tfidf(VO.bag_of_words(counts, vocab), vocab, 3).collect()}
    for r in vec.select("doc_id", vector_to_array("features").alias("f")).collect():
        for i, v in enumerate(r.f):
            assert abs(v - long.get((r.doc_id, i), 0.0)) < 1e-12


def features(spark):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(0, 1, (30, 5)), rng.normal(6, 1, (30, 5))])
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, v array<double>")
    return df.select("id", array_to_vector("v").alias("features"))


def test_kmeans_best_of(spark):
    model, costs = MD.kmeans_best_of(features(spark), 2, n_init=3)
    best = float(model.summary.trainingCost)
    assert all(best <= c + 1e-9 for _, c in costs)
    pred = model.transform(features(spark)).select("id", "prediction").collect()
    first = {r.prediction for r in pred if r.id < 30}
    assert len(first) == 1


def test_pca_components_and_variance(spark):
    df = features(spark)
    out = MD.pca_reduce(df, 3)
    assert [c for c in out.columns if c.startswith("C")] == ["C0", "C1", "C2"]
    ev = [r.ratio for r in MD.explained_variance(df).orderBy("component").collect()]
    assert all(a >= b - 1e-12 for a, b in zip(ev, ev[1:])) and abs(sum(ev) - 1) < 1e-9
    frac = MD.pca_reduce(df, 0.5)
    assert len([c for c in frac.columns if c.startswith("C")]) >= 1


def test_doc_topics_make_the_vectors_once(spark):
    from topiclens.plans import queries as Q

    plan = Q.doc_topics(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and "documents.parquet" not in plan and "text#" not in plan
