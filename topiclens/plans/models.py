"""Model jobs on ``pyspark.ml``.

The fitting loops run on the driver, but every pass over the data is a distributed job
(MLlib aggregates partial sums per partition); only k x d model tables reach the driver.
Inputs are checkpointed to the shared ``spark.checkpoint.dir`` before iterative fits, so
a lost executor recomputes from the checkpoint and not from the raw scan.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import kmeans as KM
from ..operators import lda as LD
from ..operators import pca as PC
from ..operators import topics as TP
from ..operators.nearest import nearest_centroid
from ..session import ensure_checkpoint_dir, materialize

def checkpointed(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the session's shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


# ---------------------------------------------------------------------------
# Vectors
# ---------------------------------------------------------------------------


def vocabulary_terms(vocab_ids: DataFrame) -> list[str]:
    """Terms in term_id order (the vocabulary is bounded by ``keep_n``)."""
    return [r[0] for r in vocab_ids.orderBy("term_id").select("term").collect()]


def count_vectors(tokens: DataFrame, terms: list[str], tokens_col: str = "tokens",
                  out_col: str = "counts") -> DataFrame:
    """A3 as sparse vectors: ``CountVectorizerModel`` built from a fixed vocabulary."""
    sc = tokens.sparkSession.sparkContext
    mark = next((m for m in map(chr, range(32)) if not any(m in t for t in terms)), None)
    if not terms or mark is None or not all(terms):
        cv = CountVectorizerModel.from_vocabulary(terms, inputCol=tokens_col, outputCol=out_col)
        return cv.transform(tokens)
    # one text that the JVM takes apart: ``from_vocabulary`` makes a call for every term
    listed = sc._jvm.org.apache.commons.lang3.StringUtils.split(mark.join(terms), mark)
    cv = CountVectorizerModel._create_from_java_class("org.apache.spark.ml.feature.CountVectorizerModel", listed)
    return cv.setInputCol(tokens_col).setOutputCol(out_col)._set(vocabSize=len(terms)).transform(tokens)


def tfidf_vectors(counts: DataFrame, idf: list[float], in_col: str = "counts",
                  out_col: str = "features", normalize: bool = True) -> DataFrame:
    """A4 as sparse vectors: counts x idf weights (``ElementwiseProduct``), then L2 norm.

    Sparse in, sparse out, JVM only.  ``idf[i]`` is the weight of term ``i``.
    """
    scaled_col = out_col if not normalize else "_scaled"
    ep = ElementwiseProduct(scalingVec=DenseVector(idf), inputCol=in_col, outputCol=scaled_col)
    out = ep.transform(counts)
    if normalize:
        out = Normalizer(p=2.0, inputCol=scaled_col, outputCol=out_col).transform(out).drop(scaled_col)
    return out


def log2_idf(vocab_ids: DataFrame, n_docs: int) -> list[float]:
    """``log2(N/df)`` per term id."""
    return [math.log2(n_docs / r[1]) for r in vocab_ids.orderBy("term_id").select("term_id", "df").collect()]


# ---------------------------------------------------------------------------
# LDA (M8-M12)
# ---------------------------------------------------------------------------


def lda_fit(vectors: DataFrame, k: int, seed: int = 16, max_iter: int = 50, features: str = "features",
            optimizer: str = "online", passes: float = 1.0, checkpoint: bool = True):
    """M8: LDA with library-default-like settings: alpha = eta = 1/k, online optimizer.

    Every iteration draws ``passes`` times as many documents as the corpus has (all of it by
    default), from partitions of the input's own size, so the share of documents that no
    iteration draws is about exp(-passes * max_iter), whatever the corpus.  The input is
    checkpointed (``checkpoint=False``: it has been already), so that the same seed gives the same model.
    """
    data = checkpointed(vectors.select(features)) if checkpoint else vectors.select(features)
    lda = LDA(k=k, seed=seed, maxIter=max_iter, optimizer=optimizer, featuresCol=features)
    if optimizer == "online":
        # symmetric 1/k priors; EM needs priors > 1 and keeps Spark's automatic choice
        lda.setDocConcentration([1.0 / k]).setTopicConcentration(1.0 / k)
        lda.setSubsamplingRate(min(1.0, passes))
    return lda.fit(data)


def describe_topics(model, terms: list[str], n: int = 40) -> DataFrame:
    """``(topic, rank, term, weight)`` top ``n`` terms per topic."""
    d = model.describeTopics(n)
    e = d.select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("pos", "tw"))
    spark = d.sparkSession
    # the described terms only: k x n of the vocabulary's
    told = sorted({i for r in d.select("termIndices").collect() for i in r[0]})
    vocab = spark.createDataFrame([(i, terms[i]) for i in told], "term_id int, term string")
    return (e.select("topic", (F.col("pos") + 1).alias("rank"), F.col("tw.termIndices").alias("term_id"),
                     F.col("tw.termWeights").alias("weight"))
            .join(F.broadcast(vocab), "term_id").select("topic", "rank", "term", "weight"))


def doc_topics(model, vectors: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """M9: ``(doc_id, topic, p)`` = p(t|d)."""
    t = model.transform(vectors)
    return t.select(id_col, F.posexplode(vector_to_array("topicDistribution")).alias("topic", "p"))


def topic_report(model, terms: list[str], doc_terms: DataFrame, n_docs: int, n: int = 40,
                 coherence_terms: int = 20) -> DataFrame:
    """Per topic, its top ``n`` terms with weights and its u_mass coherence."""
    return TP.topic_report(describe_topics(model, terms, max(n, coherence_terms)), doc_terms, n_docs, n, coherence_terms)


def lda_fits(vectors: DataFrame, ks: list[int], n_terms: int, seed: int = 16, max_iter: int = 50, features: str = "features"):
    """M8 for every k of ``ks``: the models of :func:`lda_fit` (online, whole corpus), an iteration of all in one pass."""
    data = checkpointed(vectors.select(F.monotonically_increasing_id().alias("row"), F.col(features).alias("features")))
    return LD.fit_online(data, ks, n_terms, seed, max_iter)


def coherence_sweep(vectors: DataFrame, terms: list[str], doc_terms: DataFrame, n_docs: int,
                    ks: list[int], seed: int = 16, max_iter: int = 30, top_n: int = 20) -> DataFrame:
    """``(num_topics, coherence)`` for each k (mean u_mass over topics, rounded to 2)."""
    tops = None
    for k, model in zip(ks, lda_fits(vectors, ks, len(terms), seed, max_iter)):
        top = describe_topics(model, terms, top_n)
        named = top.select(F.lit(int(k)).alias("model"), "topic", "term", "rank")
        tops = named if tops is None else tops.unionByName(named)
    # k x top_n rows for every model: small, written once; the corpus is read once for all of them
    found = TP.coherence_of_models(doc_terms, materialize(tops, "top_terms"), n_docs, n_top=top_n)
    return found.select(F.col("model").alias("num_topics"), F.round("coherence", 2).alias("coherence"))


# ---------------------------------------------------------------------------
# Scaling, PCA, KMeans
# ---------------------------------------------------------------------------


def standard_scale(df: DataFrame, features: str = "features", out: str = "scaled", ddof: int = 1) -> DataFrame:
    """M1: zero mean, unit variance (``ddof=0`` rescales to the population std)."""
    model = StandardScaler(withMean=True, withStd=True, inputCol=features, outputCol=out).fit(df)
    res = model.transform(df)
    if ddof == 0:
        n = df.count()
        f = ((n - 1) / n) ** 0.5 if n > 1 else 1.0
        res = res.withColumn(out, array_to_vector(F.transform(vector_to_array(out), lambda x: x / f)))
    return res


def _vector_column(df: DataFrame, features: str):
    return F.col(features).cast("array<double>") if df.schema[features].dataType.typeName() == "array" else vector_to_array(features)


def components(df: DataFrame, n_components: int | float, features: str = "features", scale: bool = True) -> PC.Components:
    """The principal components of a vector (or array) column; see :mod:`operators.pca`."""
    return PC.principal_components(KM.point_table(df, features), n_components, scale)


def pca_reduce(df: DataFrame, n_components: int | float, features: str = "features",
               out: str = "pca", scale: bool = True, name_prefix: str | None = "C") -> DataFrame:
    """M2/M3: PCA after scaling by the population std; ``n_components`` is a count or a variance fraction.

    Signs are fixed so that each component's largest-magnitude loading is positive.
    """
    found = components(df, n_components, features, scale)
    res = df.withColumn(out, found.project(_vector_column(df, features)))
    if name_prefix:
        res = res.select(*[c for c in res.columns if c != out],
                         *[F.col(out)[j].alias(f"{name_prefix}{j}") for j in range(len(found.variances))])
    return res


def explained_variance(df: DataFrame, features: str = "features", scale: bool = True,
                       n_components: int | float | None = None) -> DataFrame:
    """``(component, variance, ratio, cumulative)`` (default: of every component)."""
    want = len(df.select(_vector_column(df, features)).filter(F.col(features).isNotNull()).first()[0]) if n_components is None \
        else n_components
    found = components(df, want, features, scale)
    upto = found.ratios.cumsum()
    rows = [(i, float(v), float(r), float(c)) for i, (v, r, c) in enumerate(zip(found.variances, found.ratios, upto))]
    return df.sparkSession.createDataFrame(rows, "component int, variance double, ratio double, cumulative double")


def project_2d(df: DataFrame, features: str = "features", id_col: str = "id") -> DataFrame:
    """``(id, x, y)`` 2-D coordinates for inspection (PCA on scaled features)."""
    p = pca_reduce(df.select(id_col, features), 2, features, name_prefix=None)
    return p.select(id_col, F.col("pca")[0].alias("x"), F.col("pca")[1].alias("y"))


@dataclass(frozen=True)
class KMeansSummary:
    trainingCost: float
    costs: list
    iterations: list


@dataclass(frozen=True)
class KMeansFit:
    """The cheapest of several k-means restarts; ``centres`` is a written table ``(word_id, centroid)``."""

    centres: DataFrame
    summary: KMeansSummary
    features: str = "features"

    def transform(self, df: DataFrame, prediction: str = "prediction") -> DataFrame:
        """``df`` plus the id of the nearest centre (ties to the smallest id, null for a null vector)."""
        vec = F.col(self.features)
        if df.schema[self.features].dataType.typeName() != "array":
            vec = vector_to_array(vec)
        found = nearest_centroid(df.withColumn("_x", vec), self.centres, "_x")
        return found.withColumnRenamed("word_id", prediction).drop("_x", "dist")


def kmeans_best_of(df: DataFrame, k: int, n_init: int = 30, seed: int = 16, features: str = "features",
                   max_iter: int = 300, tol: float = 1e-4, start_rows: int = 20_000):
    """M4: ``n_init`` restarts moved together, one scan per iteration; the lowest cost is kept.

    Restart ``i`` starts from k-means++ with seed ``seed + i`` on a sample of at most about ``start_rows``
    points.  Returns ``(fit, costs)`` with the ``(seed, cost)`` of every restart.  Null vectors take no part.
    """
    points = KM.point_table(df, features)
    centres, costs, taken, best = KM.best_of(points, k, n_init, seed, max_iter, tol, start_rows)
    listed = [(seed + i, float(c)) for i, c in enumerate(costs)]
    summary = KMeansSummary(float(costs[best]), listed, [int(x) for x in taken])
    return KMeansFit(KM.centre_rows(df.sparkSession, centres[best]), summary, features), listed


def dictionary_size(n: int, n_words="sqrt") -> int:
    """``"sqrt"``: floor(sqrt(#descriptors)); at least 2 words, at most one per descriptor."""
    return max(1, min(n, max(2, math.isqrt(n) if n_words == "sqrt" else int(n_words))))


def visual_dictionary(descriptors: DataFrame, n_words="sqrt", seed: int = 16, n_init: int = 15, vec_col: str = "descriptor",
                      batch_rows: int = 14 * 256, rows_per_word: int = 4, max_steps: int = 100) -> DataFrame:
    """M5: mini-batch k-means dictionary ``(word_id, centroid, seen)``, a written table.

    A batch has about ``batch_rows`` descriptors, or ``rows_per_word`` for each word if that is more.
    Assigning every descriptor is a separate step (:func:`operators.nearest.nearest_centroid`).
    """
    points = KM.point_table(descriptors, vec_col)
    k = dictionary_size(points.count(), n_words)
    return KM.mini_batch(points, k, max(batch_rows, rows_per_word * k), n_init, seed, max_steps)


def embed_images(images: DataFrame, make_predict_fn, dim: int, in_dim: int, batch_size: int = 64,
                 pixels: str = "pixels") -> DataFrame:
    """M7: batch inference with a user-supplied model (``predict_batch_udf``).

    ``make_predict_fn()`` returns ``fn(batch: np.ndarray[n, in_dim]) -> np.ndarray[n, dim]``; it
    is built once per Python worker and fed fixed-size Arrow batches.
    """
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql.types import ArrayType, FloatType

    udf = predict_batch_udf(make_predict_fn, return_type=ArrayType(FloatType()), batch_size=batch_size,
                            input_tensor_shapes=[[in_dim]])
    return images.withColumn("embedding", udf(F.col(pixels).cast("array<float>")))


def integer_projection_model(in_dim: int, out_dim: int):
    """A network with a fixed weight table: ReLU(x W), W[i, j] = (7 i + 13 j) mod 11 - 5 (exact in float32)."""
    def make():
        import numpy as np

        w = ((7 * np.arange(in_dim)[:, None] + 13 * np.arange(out_dim)[None, :]) % 11 - 5).astype(np.float32)

        def predict(x):
            return np.maximum(x.reshape(len(x), -1) @ w, 0.0)

        return predict

    return make
