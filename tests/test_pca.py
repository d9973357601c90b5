import numpy as np
import pytest
from pyspark.sql import functions as F

from topiclens.operators import pca as PC
from topiclens.plans import models as MD


def frame(spark, x, parts=3):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, x array<double>").repartition(parts)


def reference(x, scaled=True):
    x = x - x.mean(axis=0)
    if scaled:
        s = x.std(axis=0)
        x = x / np.where(s > 0, s, 1)
    _, s, v = np.linalg.svd(x, full_matrices=False)
    return s ** 2 / len(x), v.T


def planted(rng, n, dim, k, noise=0.2):
    return rng.normal(size=(n, k)) * np.linspace(6, 2, k) @ rng.normal(size=(k, dim)) + noise * rng.normal(size=(n, dim))


@pytest.mark.parametrize("gram_dim", [1024, 4])
def test_components_equal_svd(spark, monkeypatch, gram_dim):
    monkeypatch.setattr(PC, "BLOCK_VALUES", 70)
    rng = np.random.default_rng(1)
    x = planted(rng, 250, 40, 6)
    x[:, 7] = 3.0  # constant
    df = frame(spark, x).unionByName(spark.createDataFrame([(999, None)], "id long, x array<double>"))
    values, vectors = reference(x)
    found = PC.principal_components(df, 4, gram_dim=gram_dim)
    assert np.allclose(found.variances, values[:4], rtol=1e-5)
    assert np.allclose(np.abs((found.vectors * vectors[:, :4]).sum(axis=0)), 1, atol=1e-4)
    assert abs(found.total - 39) < 1e-9 and np.allclose(found.vectors.T @ found.vectors, np.eye(4), atol=1e-9)
    for share in (0.3, 0.9, 0.999):
        k = int((np.cumsum(values) < share * values.sum()).sum()) + 1
        assert len(PC.principal_components(df, share, gram_dim=gram_dim).variances) == k
    out = {r["id"]: r["p"] for r in df.withColumn("p", found.project(F.col("x"))).collect()}
    want = (x - x.mean(axis=0)) / found.scale @ found.vectors
    assert out[999] is None and np.allclose([out[i] for i in range(250)], want)


def test_four_thousand_dimensions(spark):
    rng = np.random.default_rng(2)
    x = planted(rng, 200, 4096, 5)
    values, _ = reference(x)
    found = PC.principal_components(frame(spark, x, 2), 3)
    assert np.allclose(found.variances, values[:3], rtol=1e-4) and found.vectors.shape == (4096, 3)
    assert abs(found.total - 4096) < 1e-6


def test_few_tasks_for_the_gramian(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 12))
    df = frame(spark, x, 20).select("x")
    g = PC.gramian(df, np.zeros(12), np.ones(12), 60)
    assert np.allclose(g, x.T @ x)
    assert PC.principal_components(df.limit(1), 2).variances.max() == 0
    with pytest.raises(ValueError, match="no vectors"):
        PC.principal_components(df.limit(0), 2)


def test_reduced_table_and_ratios(spark):
    rng = np.random.default_rng(4)
    x = planted(rng, 120, 8, 3)
    df = frame(spark, x)
    v = MD.explained_variance(df, "x").orderBy("component").collect()
    values, _ = reference(x)
    assert np.allclose([r["variance"] for r in v], values) and abs(v[-1]["cumulative"] - 1) < 1e-12
    out = MD.pca_reduce(df, 2, "x")
    assert out.columns == ["id", "x", "C0", "C1"] and out.count() == 120
    two = MD.project_2d(df, "x")
    assert two.columns == ["id", "x", "y"]
