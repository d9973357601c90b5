"""Principal components of scaled vectors, for narrow and wide data.

* Up to ``GRAM_DIM`` dimensions: every task adds up the Gramian of its scaled rows by matrix products.
  Tasks are first merged until each reads several times as many rows as there are dimensions, so
  the partial Gramians are smaller than the data; their row blocks are summed in two levels by key.
  The d x d result (at most 8 MB) is decomposed on the driver.
* Wider: a randomised range finder.  A basis of a few more columns than the components wanted is
  multiplied by the covariance in one scan per iteration (each task sends d x columns values in
  blocks, summed in two levels), until the leading variances no longer change.

Scaling uses the population standard deviation; a constant dimension is scaled by 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .nearest import vectors_of

GRAM_DIM = 1024
BLOCK_VALUES = 1 << 16
MERGE_PARTS = 32
EXTRA_COLUMNS = 16


@dataclass(frozen=True)
class Components:
    """``vectors`` (d x k) of the scaled data, their ``variances`` and the ``total`` variance of all d."""

    mean: np.ndarray
    scale: np.ndarray
    vectors: np.ndarray
    variances: np.ndarray
    total: float

    @property
    def ratios(self) -> np.ndarray:
        return self.variances / self.total if self.total else np.zeros_like(self.variances)

    def first(self, k: int) -> Components:
        return Components(self.mean, self.scale, self.vectors[:, :k], self.variances[:k], self.total)

    def project(self, vec: Column) -> Column:
        """The components of an array column (null for a null vector)."""
        mean, scale, vectors = self.mean, self.scale, self.vectors

        @F.pandas_udf("array<double>")
        def run(x: pd.Series) -> pd.Series:
            some = x.notna().to_numpy()
            out = pd.Series([None] * len(x), dtype=object)
            if some.any():
                rows = (np.stack(x[some].to_numpy()) - mean) / scale @ vectors
                out[np.flatnonzero(some)] = list(rows)
            return out

        return run(vec)


def _block_sums(points: DataFrame, make, shape: tuple[int, int]) -> tuple[DataFrame, int]:
    """``(b, s)``: the sum over all rows of a matrix that ``make`` gives for each batch, in blocks of rows from ``b`` on."""
    rows, width = shape
    per = max(1, BLOCK_VALUES // width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            total += make(batch.column("x"))
        for a in range(0, rows, per):
            yield pa.RecordBatch.from_pydict({"b": np.array([a], np.int32), "s": [total[a:a + per].ravel().tolist()]})

    parts = points.select("x").mapInArrow(run, "b int, s array<double>")
    spread = F.spark_partition_id() % MERGE_PARTS
    merged = parts.withColumn("part", spread).groupBy("b", "part").agg(Summarizer.sum(array_to_vector("s")).alias("s"))
    return merged.groupBy("b").agg(Summarizer.sum(F.col("s")).alias("s")), per


def _summed(points: DataFrame, make, shape: tuple[int, int]) -> np.ndarray:
    blocks, per = _block_sums(points, make, shape)
    total = np.zeros(shape)
    for row in blocks.collect():
        total[row["b"]:row["b"] + per] = row["s"].toArray().reshape(-1, shape[1])
    return total


def _fixed_signs(vectors: np.ndarray) -> np.ndarray:
    """Each component's largest-magnitude loading is positive."""
    lead = vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])]
    return vectors * np.where(lead < 0, -1.0, 1.0)


def _gramian_job(points: DataFrame, mean: np.ndarray, scale: np.ndarray, n: int):
    """The input merged until each task reads more rows than there are dimensions, and what a batch adds."""
    dim = len(mean)
    tasks = points.rdd.getNumPartitions()
    few = max(1, min(tasks, n // (4 * dim) + 1))

    def make(column):
        x = (vectors_of(column, dim)[1] - mean) / scale
        return x.T @ x

    return points.coalesce(few) if few < tasks else points, make, (dim, dim)


def gramian(points: DataFrame, mean: np.ndarray, scale: np.ndarray, n: int) -> np.ndarray:
    """Sum over the rows of the outer products of the scaled vectors, d x d."""
    return _summed(*_gramian_job(points, mean, scale, n))


def gramian_rows(points: DataFrame, mean: np.ndarray, scale: np.ndarray, n: int) -> DataFrame:
    """``(dim_i, row)`` of the Gramian as a table, for any width."""
    dim = len(mean)
    blocks, _ = _block_sums(*_gramian_job(points, mean, scale, n))
    listed = blocks.select("b", vector_to_array("s").alias("s"))
    rows = F.transform(F.sequence(F.lit(0), (F.size("s") / dim - 1).cast("int")), lambda i: F.struct(
        (F.col("b") + i).alias("dim_i"), F.slice(F.col("s"), i * dim + 1, dim).alias("row")))
    return listed.select(F.explode(rows).alias("r")).select("r.*")


def principal_components(points: DataFrame, want: int | float, scaled: bool = True, seed: int = 16,
                         max_iter: int = 60, tol: float = 1e-7, gram_dim: int = GRAM_DIM) -> Components:
    """Leading components of ``points(x ARRAY<DOUBLE>)``: ``want`` of them, or those that reach a share below 1.

    Null vectors take no part.  ``ValueError`` for an empty table.
    """
    points = points.select("x").filter("x is not null")
    if points.isEmpty():
        raise ValueError("no vectors")
    v = array_to_vector("x")
    row = points.agg(F.count(F.lit(1)).alias("n"), Summarizer.mean(v).alias("m"), Summarizer.variance(v).alias("v")).first()
    n = int(row["n"])
    mean = row["m"].toArray()
    variance = row["v"].toArray() * ((n - 1) / n if n > 1 else 0.0)
    scale = np.where(variance > 0, np.sqrt(variance), 1.0) if scaled else np.ones(len(mean))
    total = float((variance / scale ** 2).sum())
    dim = len(mean)
    share = isinstance(want, float) and want < 1

    def enough(variances: np.ndarray) -> int:
        if not share:
            return min(int(want), len(variances))
        return min(len(variances), int((np.cumsum(variances) < want * total).sum()) + 1)

    if dim <= gram_dim:
        values, vectors = np.linalg.eigh(gramian(points, mean, scale, n) / n)
        values, vectors = np.maximum(values[::-1], 0.0), vectors[:, ::-1]
        k = enough(values)
        return Components(mean, scale, _fixed_signs(vectors[:, :k]), values[:k], total)

    def covariance_times(basis: np.ndarray) -> np.ndarray:
        def make(column):
            x = (vectors_of(column, dim)[1] - mean) / scale
            return x.T @ (x @ basis)

        return _summed(points, make, basis.shape) / n

    rng = np.random.default_rng(seed)
    columns = min(dim, (32 if share else int(want)) + EXTRA_COLUMNS)
    basis = np.linalg.qr(rng.standard_normal((dim, columns)))[0]
    before = np.zeros(columns)
    for _ in range(max_iter):
        image = covariance_times(basis)
        values, turn = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
        values, turn = np.maximum(values[::-1], 0.0), turn[:, ::-1]
        vectors = basis @ turn
        k = enough(values)
        settled = len(before) == len(values) and np.abs(values[:k] - before[:k]).max() <= tol * max(values[0], 1e-300)
        short = share and values[:max(1, len(values) - EXTRA_COLUMNS)].sum() < want * total and len(values) < min(dim, n)
        if settled and not short:
            return Components(mean, scale, _fixed_signs(vectors[:, :k]), values[:k], total)
        before = values
        grown = image @ turn
        if settled and short:  # the share is not reached: twice the columns
            more = min(dim, 2 * len(values)) - len(values)
            grown = np.concatenate((grown, rng.standard_normal((dim, more))), axis=1)
        basis = np.linalg.qr(grown)[0]
    return Components(mean, scale, _fixed_signs(vectors[:, :k]), values[:k], total)
