import numpy as np
from pyspark.ml.clustering import LDA
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from topiclens.operators import lda as LD
from topiclens.plans import models as MD

N_TERMS = 40


def corpus(spark, n=230, parts=3):
    """Sparse and dense vectors of one to forty terms, equal ones and some without any term."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(n):
        ids = np.sort(rng.choice(N_TERMS, 1 + i % N_TERMS, replace=False))
        weights = rng.random(len(ids)) * 2
        v = Vectors.sparse(N_TERMS, [] if i % 23 == 0 else ids, [] if i % 23 == 0 else weights)
        rows.append((i, Vectors.dense(v.toArray()) if i % 17 == 0 else v))
    rows += [rows[5]] * 3 + [rows[0]]
    schema = StructType([StructField("id", LongType()), StructField("features", VectorUDT())])
    return MD.checkpointed(spark.createDataFrame(rows, schema).repartition(parts).select(
        F.monotonically_increasing_id().alias("row"), "features"))


def mllib(data, k, max_iter):
    lda = LDA(k=k, seed=16, maxIter=max_iter, optimizer="online", featuresCol="features", subsamplingRate=1.0)
    return lda.setDocConcentration([1.0 / k]).setTopicConcentration(1.0 / k).fit(data)


def test_fits_in_shared_passes_are_mllibs(spark):
    data = corpus(spark)
    wants = {k: mllib(data, k, 4) for k in (2, 3, 5)}
    for records in ("10000", "7"):  # whole partitions, and copies of a row in two batches
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
        try:
            found = LD.fit_online(data, list(wants), N_TERMS, 16, 4)
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        for (k, want), got in zip(wants.items(), found):
            assert np.allclose(got.topics, want.topicsMatrix().toArray().T, rtol=1e-7, atol=0)
            assert np.allclose(got.alpha, want.estimatedDocConcentration().toArray(), rtol=1e-7, atol=0)
            for a, b in zip(got.describeTopics(6).orderBy("topic").collect(), want.describeTopics(6).orderBy("topic").collect()):
                assert (a.topic, a.termIndices) == (b.topic, b.termIndices)
                assert np.allclose(a.termWeights, b.termWeights, rtol=1e-7, atol=0)


def test_late_documents_go_on_in_other_blocks(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(2)
    n, k = 120, 3
    lists = [np.sort(rng.choice(N_TERMS, 1 + i % 30, replace=False)).astype(np.int32) for i in range(n)]
    features = pa.array([{"type": 0, "size": N_TERMS, "indices": ids, "values": rng.random(len(ids)) + 0.1} for ids in lists],
                        pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))]))
    batch = pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(n // 2), 2)), features], ["row", "features"])
    beta, alpha = rng.random((N_TERMS, k)) ** 3 + 1e-3, np.full(k, 1 / k)
    one = LD._sums_of_task(iter([batch]), [beta], [alpha], 99)
    monkeypatch.setattr(LD, "BLOCK_CELLS", 64)
    monkeypatch.setattr(LD, "LATE", 0.5)
    many = LD._sums_of_task(iter([batch]), [beta], [alpha], 99)
    assert one[:2] == many[:2] == (n, n)
    assert np.allclose(one[2][0], many[2][0], rtol=1e-12) and np.allclose(one[3][0], many[3][0], rtol=1e-12)


def test_a_corpus_without_terms_keeps_its_first_topics(spark):
    schema = StructType([StructField("row", LongType()), StructField("features", VectorUDT())])
    data = MD.checkpointed(spark.createDataFrame([(i, Vectors.sparse(4, [], [])) for i in range(9)], schema))
    got = LD.fit_online(data, [2], 4, 16, 2)[0]
    assert np.allclose(got.topics, mllib(data, 2, 2).topicsMatrix().toArray().T, rtol=1e-12)


def test_sweep_reads_the_corpus_once_an_iteration(spark):
    """The jobs of three models are about those of one: no fit has passes of its own."""
    data = corpus(spark)
    terms = [f"w{i}" for i in range(N_TERMS)]
    doc_terms = spark.createDataFrame([(d, terms[(d * 7 + j) % N_TERMS]) for d in range(40) for j in range(12)], "doc_id long, term string")
    jobs = {}
    for ks in ([2], [2, 3, 4]):
        spark.sparkContext.setJobGroup(f"sweep of {ks}", "")
        out = MD.coherence_sweep(data, terms, doc_terms, 40, ks, max_iter=8, top_n=5)
        jobs[len(ks)] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"sweep of {ks}"))
        assert sorted(r.num_topics for r in out.collect()) == ks
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] > 8 and jobs[3] - jobs[1] <= 8


def test_vocabulary_goes_to_the_vectors_in_one_piece(spark, monkeypatch):
    docs = spark.createDataFrame([(1, ["b", "a\x00", "b", "zz"]), (2, [])], "doc_id long, tokens array<string>")
    with monkeypatch.context() as m:
        m.setattr(MD.CountVectorizerModel, "_new_java_array", None)  # a call for every term
        rows = MD.count_vectors(docs, ["a\x00", "b", "c d"], out_col="v").orderBy("doc_id").collect()
    assert [r.v for r in rows] == [Vectors.sparse(3, [0, 1], [1.0, 2.0]), Vectors.sparse(3, [], [])]
