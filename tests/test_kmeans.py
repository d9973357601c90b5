import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from topiclens.operators import kmeans as KM
from topiclens.operators import nearest as NE
from topiclens.plans import models as MD


def table(spark, x, parts=3):
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, x array<double>").repartition(parts)


def blobs(rng, n, k, dim, spread=0.6):
    centres = rng.normal(0, 4, (k, dim))
    return centres[rng.integers(0, k, n)] + rng.normal(0, spread, (n, dim))


def brute_nearest(x, c, round_to=9):
    d = np.round(((x[:, None, :] - c[None]) ** 2).sum(axis=2), round_to)
    return d.argmin(axis=1), d.min(axis=1)


def numpy_lloyd(x, centres, max_iter, tol):
    centres = centres.copy()
    for _ in range(max_iter):
        at = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        new = np.array([x[at == j].mean(axis=0) if (at == j).any() else centres[j] for j in range(len(centres))])
        moved = ((new - centres) ** 2).sum()
        centres = new
        if moved <= tol:
            break
    return centres, ((x[:, None, :] - centres[None]) ** 2).sum(axis=2).min(axis=1).sum()


def test_restarts_together_equal_restarts_alone(spark):
    rng = np.random.default_rng(2)
    x = blobs(rng, 400, 6, 5, 2.5)
    points = KM.point_table(table(spark, x), "x")
    starts = np.stack([x[rng.choice(400, 6, replace=False)] for _ in range(5)])
    centres, costs, taken = KM.lloyd(points, starts, 60, 1e-9)
    for r in range(5):
        want, cost = numpy_lloyd(x, starts[r], 60, 1e-9)
        assert np.allclose(centres[r], want) and abs(costs[r] - cost) < 1e-6 * cost
        alone = KM.lloyd(points, starts[r:r + 1], 60, 1e-9)
        assert np.allclose(alone[0][0], centres[r]) and alone[2][0] == taken[r]
    assert len(set(taken)) > 1  # restarts that settle leave earlier


def test_sums_cross_row_and_batch_limits(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x, c = rng.normal(size=(300, 4)), rng.normal(size=(2, 9, 4))
    points = KM.point_table(table(spark, x), "x")
    whole = KM.partial_sums(points, c)
    monkeypatch.setattr(KM, "ROW_VALUES", 12)
    monkeypatch.setattr(KM, "PAIR_VALUES", 60)
    monkeypatch.setattr(KM, "ONE_HOT_CENTRES", 0)
    cut = KM.partial_sums(points, c)
    for a, b in zip(whole, cut):
        assert np.allclose(a, b)
    assert whole[1].sum() == 600


def test_best_cost_is_no_worse_than_separate_fits(spark):
    rng = np.random.default_rng(8)
    df = table(spark, blobs(rng, 1500, 9, 6, 1.5)).select(array_to_vector("x").alias("features"))
    fit, costs = MD.kmeans_best_of(df, 9, n_init=12)
    assert len(costs) == 12 and fit.summary.trainingCost == min(c for _, c in costs)
    single = [KMeans(k=9, seed=16 + i, maxIter=100).fit(df).summary.trainingCost for i in range(4)]
    assert fit.summary.trainingCost <= 1.001 * min(single)


def test_degenerate_points(spark):
    x = np.zeros((50, 3))
    x[40:] = 1.0
    fit, costs = MD.kmeans_best_of(table(spark, x), 3, n_init=2, features="x")
    assert fit.summary.trainingCost == 0 and fit.centres.count() == 3
    with pytest.raises(ValueError, match="clusters"):
        MD.kmeans_best_of(table(spark, x[:2]), 3, n_init=1, features="x")
    with_null = table(spark, x).unionByName(spark.createDataFrame([(99, None)], "id long, x array<double>"))
    fit, _ = MD.kmeans_best_of(with_null, 2, n_init=2, features="x")
    pred = {r["id"]: r["prediction"] for r in fit.transform(with_null).collect()}
    assert pred[99] is None and pred[0] != pred[45] and len(pred) == 51


def test_mini_batch_is_close_to_lloyd(spark):
    points = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    desc = points.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice(
        F.col("embedding").cast("array<double>"), i * 8 + 1, 8))).alias("descriptor"))
    words = MD.visual_dictionary(desc, "sqrt", n_init=3)
    x = np.array([r[0] for r in desc.collect()])
    k = words.count()
    assert k == int(len(x) ** 0.5) and words.agg(F.sum("seen")).first()[0] > 0
    c = np.array([r["centroid"] for r in words.orderBy("word_id").collect()])
    cost = NE.nearest_rows(x, np.arange(k), c, None)[1].sum()
    full = KMeans(k=k, seed=16, maxIter=40).fit(desc.select(array_to_vector("descriptor").alias("features"))).summary.trainingCost
    assert cost <= 1.05 * full


def test_mini_batch_as_table_equals_matrix(spark):
    rng = np.random.default_rng(5)
    points = KM.point_table(table(spark, blobs(rng, 900, 8, 3)), "x")
    small = KM.mini_batch(points, 8, 200, 2, 16, max_steps=6, spread_k=0)
    large = KM.mini_batch(points, 8, 200, 2, 16, max_steps=6, spread_k=0, model_values=4)
    a, b = ({r["word_id"]: (r["seen"], np.round(r["centroid"], 9).tolist()) for r in t.collect()} for t in (small, large))
    assert a == b and sum(n for n, _ in a.values()) > 600


def test_two_level_search_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    c = np.round(blobs(rng, 3000, 40, 4), 2)
    c[100:200] = c[0]  # equal centres: the smallest id wins
    x = np.concatenate((np.round(blobs(rng, 1500, 40, 4), 2), c[::100], np.full((2, 4), np.nan)))
    pts = table(spark, x).unionByName(spark.createDataFrame([(-1, None)], "id long, x array<double>"))
    centres = table(spark, c).select(F.col("id").cast("int").alias("word_id"), F.col("x").alias("centroid"))
    got = {r["id"]: (r["word_id"], r["dist"]) for r in NE.nearest_centroid(pts, centres, "x", model_values=100).collect()}
    matrix = {r["id"]: (r["word_id"], r["dist"]) for r in NE.nearest_centroid(pts, centres, "x").collect()}
    want, dist = brute_nearest(x[:-2], c)
    assert len(got) == len(x) + 1 and got[-1] == (None, None) == got[len(x) - 1]
    for i in range(len(x) - 2):
        assert got[i] == (want[i], dist[i]) == matrix[i]


def test_hundred_thousand_centres(spark, monkeypatch):
    monkeypatch.setattr(NE, "GROUP_POINTS", 40)  # popular cells are cut into several groups
    monkeypatch.setattr(NE, "PART_CENTRES", 150)
    rng = np.random.default_rng(7)
    c = rng.normal(size=(100_000, 3))
    x = np.concatenate((rng.normal(size=(300, 3)), np.repeat(c[:1], 200, axis=0)))
    rows = spark.range(100_000, numPartitions=4)
    cols = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(c)], "word_id int, centroid array<double>")
    assert rows.count() == 100_000
    got = {r["id"]: (r["word_id"], r["dist"]) for r in NE.nearest_centroid(table(spark, x), cols, "x", model_values=1000).collect()}
    want, dist = brute_nearest(x, c)
    assert [got[i] for i in range(500)] == list(zip(want, dist))
