"""M8 for several numbers of topics at once: online variational Bayes, all models in the same passes.

The models are those of MLlib's online optimizer (``pyspark.ml.clustering.LDA``: same draws, priors, stopping rule
and steps, in its order), so that each equals a fit of its own up to the order of sums.  What differs is the work:

* models with one seed draw the same documents, so an iteration reads the corpus once for all of them;
* a document drawn several times in an iteration is inferred once and counted that often (its start depends on the
  partition only);
* documents of like length are inferred together as one block of matrices, and leave it when they have converged.

A task holds one block, and the sums of all models (``sum(ks)`` values per term).  Those are added up by term range
among the executors; the driver holds the models, as it does in MLlib.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

# MLlib's fixed settings of the online optimizer
GAMMA_SHAPE, TAU0, KAPPA, MAX_CHANGE = 100.0, 1024.0, 0.51, 1e-3
BLOCK_CELLS = 32_768  # (document, term) cells inferred together
LATE = 0.125  # share of a block's documents that may go on later
TERM_RANGE = 2_048  # terms of one row of sums
SLICE_ROWS = 4_096  # drawn rows whose cells are held at once
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class JavaRandom:
    """``java.util.Random``, which deals MLlib's seeds."""

    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)

    def _next32(self) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
        return _signed(self.state >> 16, 32)

    def next_long(self) -> int:
        return _signed((self._next32() << 32) + self._next32(), 64)


def _signed(x: int, bits: int) -> int:
    x &= (1 << bits) - 1
    return x - (1 << bits) if x >> (bits - 1) else x


def gamma_draws(seed: int, n: int, shape: float = GAMMA_SHAPE) -> np.ndarray:
    """``n`` draws of Gamma(shape, 1 / shape) as Breeze makes them from a Mersenne twister of this (64-bit) seed."""
    seed &= (1 << 64) - 1
    source = np.random.RandomState(np.array([seed >> 32, seed & 0xFFFFFFFF], dtype=np.int64))
    words: list[int] = []
    spare: list[float] = []

    def uniform() -> float:
        if len(words) < 2:
            words[:0] = source.randint(0, 1 << 32, size=64, dtype=np.uint32)[::-1].tolist()
        high, low = words.pop() >> 6, words.pop() >> 6
        return ((high << 26) | low) * 2.0 ** -52

    def normal() -> float:
        if spare:
            return spare.pop()
        angle, radius = 2 * math.pi * uniform(), math.sqrt(-2 * math.log(uniform()))
        spare.append(radius * math.sin(angle))
        return radius * math.cos(angle)

    d = shape - 1.0 / 3.0
    c = 1.0 / math.sqrt(9.0 * d)
    out = np.empty(n)
    for i in range(n):
        while True:
            x = normal()
            v = 1.0 + c * x
            if v <= 0:
                continue
            v = v * v * v
            u = uniform()
            if u < 1.0 - 0.0331 * x * x * x * x or math.log(u) < 0.5 * x * x + d * (1.0 - v + math.log(v)):
                break
        out[i] = d * v / shape
    return out


def _first_topics(spark: SparkSession, seed: int, n: int) -> np.ndarray:
    """The same draws in bulk (topics x terms of them), made by Breeze itself."""
    jvm = spark.sparkContext._jvm
    source = jvm.org.apache.commons.math3.random.MersenneTwister()
    words = spark.sparkContext._gateway.new_array(jvm.int, 2)
    seed &= (1 << 64) - 1
    words[0], words[1] = _signed(seed >> 32, 32), _signed(seed, 32)
    source.setSeed(words)
    gamma = jvm.breeze.stats.distributions.Gamma(GAMMA_SHAPE, 1.0 / GAMMA_SHAPE,
                                                 jvm.breeze.stats.distributions.RandBasis(source))
    drawn = gamma.samplesVector(n, jvm.scala.reflect.ClassTag.Double()).data()
    buffer = jvm.java.nio.ByteBuffer.allocate(8 * n)
    buffer.asDoubleBuffer().put(drawn)
    return np.frombuffer(buffer.array(), dtype=">f8").astype(np.float64)


def digamma(x: np.ndarray) -> np.ndarray:
    y = x + 6.0
    f = 1.0 / (y * y)
    tail = f * (1 / 12 - f * (1 / 120 - f * (1 / 252 - f * (1 / 240 - f * (1 / 132 - f * (691 / 32760 - f / 12))))))
    t = x * (x + 5.0)  # 1/x + 1/(x + 5) and so on, in pairs
    return np.log(y) - 0.5 / y - tail - (2.0 * x + 5.0) * (1.0 / t + 1.0 / (t + 4.0) + 1.0 / (t + 6.0))


def trigamma(x: np.ndarray) -> np.ndarray:
    y = x + 6.0
    f = 1.0 / (y * y)
    tail = (1.0 + f * (1 / 6 - f * (1 / 30 - f * (1 / 42 - f * (1 / 30 - f * (5 / 66 - f * (691 / 2730 - f * 7 / 6))))))) / y
    return tail + f / 2 + sum(1.0 / (x + i) ** 2 for i in range(6))


def _expected_log(weights: np.ndarray) -> np.ndarray:
    """E[log p] of Dirichlet distributions, one per row."""
    both = digamma(np.concatenate([weights, weights.sum(axis=-1, keepdims=True)], axis=-1))
    return both[..., :-1] - both[..., -1:]


def _infer(words: np.ndarray, counts: np.ndarray, beta: np.ndarray, alpha: np.ndarray, gamma: np.ndarray, leave: float):
    """The variational step of a block of documents, from ``gamma`` (D x k) on until at most a share ``leave`` of them
    has not converged: ``(documents done, their E[log theta], per cell of them its count over its norm, documents
    left, their gamma)``.  ``words`` and ``counts`` are D x L, padded by zero counts; ``beta`` is exp(E[log beta]),
    term by topic."""
    n, k = gamma.shape
    logs, shares = np.empty((n, k)), np.empty(counts.shape)
    at, c = np.arange(n), counts
    cells = np.ascontiguousarray(beta[words].transpose(0, 2, 1))  # D x k x L: the sums below run along a row

    def share() -> np.ndarray:
        norm = np.matmul(theta[:, None, :], cells)[:, 0, :]
        norm += 1e-100
        return np.divide(c, norm, out=norm)

    theta = np.exp(_expected_log(gamma))
    ratio = share()
    unmet, done = np.ones(n, bool), np.zeros(n, bool)
    while True:
        new = theta * np.vecdot(cells, ratio[:, None, :]) + alpha
        log = _expected_log(new)
        theta = np.exp(log)
        ratio = share()
        met = unmet & ~(np.abs(new - gamma).sum(axis=1) / k > MAX_CHANGE)
        gamma = new
        if met.any():
            logs[at[met]] = log[met]
            shares[at[met]] = ratio[met]
            done[at[met]] = True
            unmet &= ~met
            left = int(np.count_nonzero(unmet))
            if left <= leave * n:
                return np.flatnonzero(done), logs[done], shares[done], at[unmet], gamma[unmet]
            if left < 0.8 * len(unmet):
                at, c, cells, gamma, theta, ratio = (x[unmet] for x in (at, c, cells, gamma, theta, ratio))
                unmet = np.ones(left, bool)


@dataclass
class _Model:
    """One model while it is fitted: ``weights`` is topic by term, ``alpha`` the documents' prior, ``eta`` the terms'."""

    k: int
    weights: np.ndarray
    alpha: np.ndarray
    eta: float

    def step(self, rho: float, sums: np.ndarray, beta: np.ndarray, log_sum: np.ndarray, n_docs: float) -> None:
        """MLlib's update of the topics (the batch is as large as the corpus) and of the documents' prior."""
        self.weights = (1 - rho) * self.weights + rho * (sums * beta.T + self.eta)
        alpha = self.alpha
        slope = n_docs * (log_sum / n_docs - _expected_log(alpha))
        c, q = n_docs * trigamma(alpha.sum()), -n_docs * trigamma(alpha)
        b = (slope / q).sum() / (1.0 / c + (1.0 / q).sum())
        moved = alpha + rho * -(slope - b) / q
        if (moved > 0).all():
            self.alpha = moved


@dataclass(frozen=True)
class TopicModel:
    """A fitted model: ``topics`` is topic by term, not normalised; ``alpha`` the documents' prior."""

    spark: SparkSession
    topics: np.ndarray
    alpha: np.ndarray

    def describeTopics(self, maxTermsPerTopic: int = 10) -> DataFrame:
        """As MLlib's: ``(topic, termIndices, termWeights)``, equal weights by index."""
        rows = []
        for topic, weights in enumerate(self.topics / self.topics.sum(axis=1, keepdims=True)):
            best = np.argsort(-weights, kind="stable")[:maxTermsPerTopic]
            rows.append((topic, best.tolist(), weights[best].tolist()))
        return self.spark.createDataFrame(rows, "topic int, termIndices array<int>, termWeights array<double>")


def _cells(batch: pa.RecordBatch):
    """``(times, first, length, words, counts)`` of the different documents of a batch (copies of a row are neighbours)."""
    ids = batch.column("row").to_numpy()
    lead = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
    times = np.diff(np.append(lead, len(ids)))
    docs = batch.column("features").take(pa.array(lead))
    if docs.null_count:
        raise ValueError("a document has no vector")
    kind, size, indices, values = docs.flatten()
    length = pc.fill_null(pc.list_value_length(values), 0).to_numpy().astype(np.int64)
    first = np.cumsum(length) - length
    counts = values.flatten().to_numpy()
    if not (np.isfinite(counts).all() and (counts >= 0).all()):
        raise ValueError("a document has a weight that is negative or not finite")
    words = np.arange(len(counts)) - np.repeat(first, length)  # the places of dense vectors
    words[np.repeat(kind.to_numpy() == 0, length)] = indices.flatten().to_numpy()
    return times, first, length, words, counts


def _blocks(docs: np.ndarray, length: np.ndarray) -> list[np.ndarray]:
    """The places of ``docs`` in order of length, as many at once as make ``BLOCK_CELLS`` padded cells."""
    order = np.argsort(length[docs], kind="stable")
    out, at = [], 0
    while at < len(order):
        rest = order[at:at + BLOCK_CELLS]
        n = max(1, int(np.searchsorted(np.arange(1, len(rest) + 1) * length[docs[rest]], BLOCK_CELLS, side="right")))
        out.append(rest[:n])
        at += n
    return out


def _sums_of_task(batches: Iterator[pa.RecordBatch], betas: list[np.ndarray], alphas: list[np.ndarray], seed: int):
    """``(drawn rows, drawn rows with terms, per model its sums topic by term, per model its sum of E[log theta])``."""
    start = gamma_draws(seed, max(len(a) for a in alphas))
    rows = n_docs = 0
    sums = [np.zeros(beta.shape[::-1]) for beta in betas]
    log_sums = [np.zeros(len(a)) for a in alphas]
    for part in (b.slice(at, SLICE_ROWS) for b in batches for at in range(0, b.num_rows, SLICE_ROWS)):
        times, first, length, words, counts = _cells(part)
        rows += part.num_rows
        found = np.concatenate(([0], np.cumsum(counts > 0)))
        filled = np.flatnonzero(found[first + length] > found[first])
        n_docs += int(times[filled].sum())
        for beta, alpha, total, log_sum in zip(betas, alphas, sums, log_sums):
            docs, gamma = filled, np.tile(start[:len(alpha)], (len(filled), 1))
            while len(docs):
                blocks, left = _blocks(docs, length), []
                for block in blocks:
                    some = docs[block]
                    held = np.arange(length[some[-1]]) < length[some, None]
                    cell = np.where(held, first[some, None] + np.arange(held.shape[1]), 0)
                    # documents that converge late go on together with those of the other blocks
                    ended, logs, shares, late, state = _infer(
                        words[cell], np.where(held, counts[cell], 0.0), beta, alpha, gamma[block], LATE if len(blocks) > 1 else 0.0)
                    left.append((some[late], state))
                    log_sum += times[some[ended]] @ logs
                    weight = np.exp(logs) * times[some[ended], None]
                    inside = held[ended]
                    flat = words[cell[ended][inside]]
                    for j in range(len(alpha)):
                        np.add.at(total[j], flat, (shares * weight[:, j, None])[inside])
                docs, gamma = (np.concatenate(x) for x in zip(*left))
    return rows, n_docs, sums, log_sums


@contextmanager
def _shuffles_removed(spark: SparkSession):
    """What queries made in here shuffle goes when they end: the disk holds the sums of one pass, not of all."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def _pass(data: DataFrame, models: list[_Model], betas: list[np.ndarray], draw_seed: int, start_seed: int):
    """One drawing of the corpus for all models: the sums of all tasks."""
    sc = data.sparkSession.sparkContext
    shared = sc.broadcast((betas, [m.alpha for m in models]))
    schema = StructType([StructField("range", IntegerType()), StructField("sums", ArrayType(DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, alphas = shared.value
        rows, n_docs, sums, log_sums = _sums_of_task(batches, held, alphas, start_seed + TaskContext.get().partitionId())
        if not rows:
            return

        def row(name: int, values: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([name], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))],
                ["range", "sums"])

        yield row(-1, np.concatenate([[float(rows), float(n_docs)], *log_sums]))
        if n_docs:
            for i, lo in enumerate(range(0, held[0].shape[0], TERM_RANGE)):
                yield row(i, np.concatenate([s[:, lo:lo + TERM_RANGE].ravel() for s in sums]))

    with _shuffles_removed(data.sparkSession):
        drawn = data.sample(withReplacement=True, fraction=1.0, seed=draw_seed).mapInArrow(run, schema)
        found = drawn.groupBy("range").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums")).toArrow()
    shared.destroy()
    by_range = {i: s.values.to_numpy() for i, s in zip(found.column("range").to_pylist(), found.column("sums"))}
    if -1 not in by_range:
        return 0, 0, [], []
    head = by_range.pop(-1)
    log_sums = np.split(head[2:], np.cumsum([m.k for m in models])[:-1])
    every = np.concatenate([by_range[i].reshape(sum(m.k for m in models), -1) for i in sorted(by_range)], axis=1) if by_range else None
    sums = np.split(every, np.cumsum([m.k for m in models])[:-1]) if by_range else []
    return head[0], head[1], sums, log_sums


def fit_online(data: DataFrame, ks: list[int], n_terms: int, seed: int, max_iter: int) -> list[TopicModel]:
    """Models with ``ks`` topics, alpha = eta = 1/k at first, of ``data(row, features)``: ``features`` are vectors of
    ``n_terms`` weights, ``row`` tells rows apart.

    ``data`` must give the same rows in the same partitions at each reading (a checkpoint), as the draws go by partition.
    """
    spark = data.sparkSession
    random = JavaRandom(seed)
    first = _first_topics(spark, random.next_long(), max(ks) * n_terms)
    models = [_Model(k, first[:k * n_terms].reshape(k, n_terms), np.full(k, 1.0 / k), 1.0 / k) for k in ks]
    steps = 0
    for _ in range(max_iter):
        draw_seed, state = random.next_long(), random.state
        betas = [np.ascontiguousarray(np.exp(_expected_log(m.weights)).T) for m in models]
        rows, n_docs, sums, log_sums = _pass(data, models, betas, draw_seed, random.next_long())
        if not rows:  # nothing was drawn: MLlib takes no seed of a start and counts no step
            random.state = state
            continue
        steps += 1
        if n_docs:
            for m, s, beta, log_sum in zip(models, sums, betas, log_sums):
                m.step((TAU0 + steps) ** -KAPPA, s, beta, log_sum, n_docs)
    return [TopicModel(spark, m.weights, m.alpha) for m in models]
