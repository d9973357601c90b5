"""M4, M5: k-means with all restarts in one scan, and mini-batch k-means for dictionaries.

* ``lloyd`` moves the centres of every restart together: an iteration reads the points once, each
  Arrow batch is compared with the centres of all restarts still moving by matrix products, and
  a task sends one row of sums, counts and cost per restart and block of centres; rows are summed by
  key.  A restart that no longer moves leaves the tensor.
* ``mini_batch`` follows the centres through batches of the points: a centre moves towards its batch
  members with rate 1/(points seen so far).  Points are dealt into batches once; a step reads its
  own batch only.  A model of at most ``MODEL_VALUES`` numbers is summed like a restart, a larger
  one stays a table (nearest centre by cells, sums by key, one written table per step).

Starts are chosen by greedy k-means++ on a bounded sample of ``start_rows`` points; everything
else covers all points.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .indexing import with_global_index
from .nearest import MODEL_VALUES, nearest_centroid, nearest_rows, vectors_of
from .sampling import TOP_K_MAX, seeded_hash

ROW_VALUES = 1 << 16  # numbers in one row of partial sums
PAIR_VALUES = 1 << 20  # point-centre distances held at once
ONE_HOT_CENTRES = 1024


def point_table(df: DataFrame, vec_col: str) -> DataFrame:
    """``x ARRAY<DOUBLE>`` of the non-null vectors (array or ``VectorUDT``), written once."""
    kind = df.schema[vec_col].dataType.typeName()
    x = F.col(vec_col).cast("array<double>") if kind == "array" else vector_to_array(vec_col)
    return materialize(df.select(x.alias("x")).filter("x is not null"), "points")


@dataclass(frozen=True)
class Moments:
    n: int
    dim: int
    variance: float  # mean over the dimensions, population


def moments(points: DataFrame) -> Moments:
    if points.isEmpty():
        return Moments(0, 0, 0.0)
    v = array_to_vector("x")
    row = points.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d"), Summarizer.variance(v).alias("v")).first()
    n = int(row["n"])
    spread = float(row["v"].toArray().mean()) * (n - 1) / n if n > 1 else 0.0
    return Moments(n, int(row["d"] or 0), spread)


def partial_sums(points: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums (R, k, d), counts (R, k) and costs (R,) of the points nearest to each centre, in one scan."""
    restarts, k, dim = centres.shape
    flat = centres.reshape(restarts * k, dim)
    square = (flat ** 2).sum(axis=1)
    per = max(1, ROW_VALUES // (dim + 1))  # centres in one row of sums

    def run(batches):
        sums = np.zeros((restarts, k, dim + 1))
        cost = np.zeros(restarts)
        rows = max(1, PAIR_VALUES // (restarts * k))
        for batch in batches:
            _, whole = vectors_of(batch.column("x"), dim)
            for lo in range(0, len(whole), rows):
                x = whole[lo:lo + rows]
                own = (x ** 2).sum(axis=1)
                near = (square - 2 * (x @ flat.T)).reshape(len(x), restarts, k)
                at = near.argmin(axis=2)
                cost += np.maximum(0.0, np.take_along_axis(near, at[:, :, None], 2)[:, :, 0] + own[:, None]).sum(axis=0)
                one = np.column_stack((x, np.ones(len(x))))
                if restarts * k <= ONE_HOT_CENTRES:  # all sums of the block by one matrix product
                    member = np.zeros((len(x), restarts, k))
                    np.put_along_axis(member, at[:, :, None], 1.0, 2)
                    sums += (member.reshape(len(x), -1).T @ one).reshape(sums.shape)
                    continue
                for r in range(restarts):
                    order = np.argsort(at[:, r], kind="stable")
                    hit, first = np.unique(at[order, r], return_index=True)
                    sums[r, hit] += np.add.reduceat(one[order], first, axis=0)
        for r in range(restarts):
            for b, a in enumerate(range(0, k, per)):
                values = sums[r, a:a + per].ravel()
                yield pa.RecordBatch.from_pydict({
                    "r": np.array([r], np.int32), "b": np.array([b], np.int32),
                    "s": [np.append(values, cost[r] if b == 0 else 0.0).tolist()]})

    parts = points.select("x").mapInArrow(run, "r int, b int, s array<double>")
    sums, cost = np.zeros((restarts, k, dim + 1)), np.zeros(restarts)
    for row in parts.groupBy("r", "b").agg(Summarizer.sum(array_to_vector("s")).alias("s")).collect():
        values, a = row["s"].toArray(), row["b"] * per  # the model's own size: restarts x k x (d + 1)
        sums[row["r"], a:a + per] = values[:-1].reshape(-1, dim + 1)
        cost[row["r"]] += values[-1]
    return sums[:, :, :dim], sums[:, :, dim], cost


def lloyd(points: DataFrame, starts: np.ndarray, max_iter: int, tol: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centres, costs and iterations of every restart from its start.

    A restart stops when its centres' squared moves sum to at most ``tol`` (or after ``max_iter``
    iterations).  A centre without points stays where it is.
    """
    centres = starts.astype(np.float64).copy()
    taken = np.zeros(len(centres), dtype=np.int64)
    moving = np.arange(len(centres))
    while len(moving) and taken[moving[0]] < max_iter:
        sums, counts, _ = partial_sums(points, centres[moving])
        new = np.where(counts[:, :, None] > 0, sums / np.maximum(counts, 1)[:, :, None], centres[moving])
        moves = ((new - centres[moving]) ** 2).sum(axis=(1, 2))
        centres[moving] = new
        taken[moving] += 1
        moving = moving[moves > tol]
    return centres, partial_sums(points, centres)[2], taken


def spread_start(sample: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Greedy k-means++: each next centre is the best of a few draws in proportion to the squared distance."""
    trials = 2 + int(math.log(k))
    square = (sample ** 2).sum(axis=1)

    def away(rows: np.ndarray) -> np.ndarray:
        return np.maximum(0.0, square[None] - 2 * (sample[rows] @ sample.T) + square[rows][:, None])

    chosen = [int(rng.integers(len(sample)))]
    least = away(np.array(chosen))[0]
    while len(chosen) < k:
        total = least.sum()
        draws = (np.searchsorted(np.cumsum(least), rng.random(trials) * total, side="right") if total > 0
                 else rng.integers(len(sample), size=trials))
        draws = np.minimum(draws, len(sample) - 1)
        left = np.minimum(least[None], away(draws))
        best = int(left.sum(axis=1).argmin())
        chosen.append(int(draws[best]))
        least = left[best]
    return sample[chosen]


def bounded_sample(points: DataFrame, n: int, rows: int, seed: int) -> np.ndarray:
    """About ``rows`` points (all, if there are not more) drawn evenly; the only points that reach the driver."""
    some = points if n <= rows else points.sample(fraction=rows / n, seed=seed)
    got = some.select("x").toArrow().column("x").combine_chunks()
    dim = len(got[0]) if len(got) else 0
    return vectors_of(got, dim)[1]


def best_of(points: DataFrame, k: int, n_init: int, seed: int, max_iter: int, tol: float, start_rows: int
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """``(centres of every restart, costs, iterations, number of the cheapest)``; ``tol`` is relative to the variance."""
    size = moments(points)
    if size.n < k:
        raise ValueError(f"{k} clusters of {size.n} points")
    sample = bounded_sample(points, size.n, max(start_rows, 4 * k), seed)
    starts = np.stack([spread_start(sample, k, np.random.default_rng(seed + i)) for i in range(n_init)])
    centres, costs, taken = lloyd(points, starts, max_iter, tol * size.variance)
    return centres, costs, taken, int(costs.argmin())


def centre_rows(spark, centres: np.ndarray) -> DataFrame:
    """``(word_id, centroid)`` of one model, written as a table."""
    table = pa.table({"word_id": pa.array(np.arange(len(centres)), pa.int32()),
                      "centroid": pa.array(centres.tolist(), pa.list_(pa.float64()))})
    return materialize(spark.createDataFrame(table), "centres")


# ---------------------------------------------------------------------------
# Mini-batches
# ---------------------------------------------------------------------------


@dataclass
class Batches:
    """Points dealt into numbered folders; a step reads one of them."""

    spark: object
    path: str
    used: int

    def read(self, step: int) -> DataFrame:
        return self.spark.read.schema("x array<double>, u double, batch int").parquet(self.path).filter(
            F.col("batch") == step % self.used)


def deal(points: DataFrame, n: int, batch_rows: int, max_steps: int, seed: int) -> Batches:
    """Each point in one of ``ceil(n / batch_rows)`` batches by a seeded draw; only those that the steps can reach are written."""
    batches = max(1, math.ceil(n / batch_rows))
    used = min(batches, max_steps)
    spark = points.sparkSession
    dealt = (points.withColumn("u", F.rand(seed)).withColumn("batch", F.floor(F.col("u") * batches).cast("int"))
             .filter(F.col("batch") < used))
    files = max(1, batch_rows // 100_000)
    path = scratch_path(spark, "batches")
    dealt.repartition("batch", F.pmod(F.xxhash64("u"), F.lit(files))).write.partitionBy("batch").parquet(path)
    return Batches(spark, path, used)


def _pulled(centres: np.ndarray, seen: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    total = seen + counts
    moved = (centres * seen[:, None] + sums) / np.maximum(total, 1)[:, None]
    return np.where(counts[:, None] > 0, moved, centres), total


def table_step(batch: DataFrame, centres: DataFrame, model_values: int = MODEL_VALUES) -> DataFrame:
    """One mini-batch step on a table ``(word_id, centroid, seen)``; adds the batch's ``cost`` per centre."""
    found = nearest_centroid(batch.select("x"), centres, "x", round_to=None, model_values=model_values)
    sums = found.groupBy("word_id").agg(F.count(F.lit(1)).alias("_n"), F.sum("dist").alias("_cost"),
                                        vector_to_array(Summarizer.sum(array_to_vector("x"))).alias("_s"))
    total = F.col("seen") + F.col("_n")
    moved = F.zip_with("centroid", "_s", lambda c, s: (c * F.col("seen") + s) / total)
    joined = centres.drop("cost").join(sums, "word_id", "left")
    return joined.select("word_id", F.coalesce(moved, "centroid").alias("centroid"),
                         F.coalesce(total, "seen").alias("seen"), F.coalesce("_cost", F.lit(0.0)).alias("cost"))


def _random_start(batches: Batches, k: int, seed: int) -> DataFrame:
    """``(word_id, centroid, seen)``: k points of the first batches in seeded order, numbered without one big task."""
    need, step, rows = 0, 0, None
    while step < batches.used and need < k:
        part = batches.read(step)
        rows = part if rows is None else rows.unionByName(part)
        need, step = rows.count(), step + 1
    order = seeded_hash("u", seed)
    if k <= TOP_K_MAX:
        some = rows.orderBy(order, "u").limit(k).withColumn("word_id", F.monotonically_increasing_id())
    else:
        some = with_global_index(rows.withColumn("_h", order), ["_h", "u"], "word_id").filter(F.col("word_id") < k)
    return some.select(F.col("word_id").cast("int").alias("word_id"), F.col("x").alias("centroid"), F.lit(0).cast("long").alias("seen"))


def mini_batch(points: DataFrame, k: int, batch_rows: int, n_init: int, seed: int, max_steps: int = 100,
               patience: int = 10, start_rows: int = 10_752, spread_k: int = 1024,
               model_values: int = MODEL_VALUES) -> DataFrame:
    """``(word_id, centroid, seen)`` after mini-batch steps from the best of ``n_init`` starts.

    Steps end when the smoothed batch cost has not fallen for ``patience`` steps, or after ``max_steps``.
    Up to ``spread_k`` centres the starts are k-means++ on ``start_rows`` points and the cheapest on another
    such sample goes on; beyond, the starts are k points each and are judged on the first batch.
    """
    spark, n = points.sparkSession, points.count()
    if n < k:
        raise ValueError(f"{k} clusters of {n} points")
    batches = deal(points, n, batch_rows, max_steps, seed)
    dim = points.agg(F.max(F.size("x"))).first()[0]
    if k <= spread_k and k * dim <= model_values:
        sample = bounded_sample(points, n, max(start_rows, 4 * k), seed)
        judge = bounded_sample(points, n, max(start_rows, 4 * k), seed + 1)
        starts = [spread_start(sample, k, np.random.default_rng(seed + i)) for i in range(n_init)]
        ids = np.arange(k)
        costs = [nearest_rows(judge, ids, s, None)[1].sum() for s in starts]
        centres = starts[int(np.argmin(costs))]
    else:
        starts = [materialize(_random_start(batches, k, seed + i), "start") for i in range(n_init)]
        first = batches.read(0).select("x")
        costs = [nearest_centroid(first, s, "x", None, model_values=model_values).agg(F.sum("dist")).first()[0] for s in starts]
        table = starts[int(np.argmin(costs))]
        centres = None
    if centres is None and k * dim <= model_values:
        centres = np.array([r["centroid"] for r in table.orderBy("word_id").collect()])
    seen = np.zeros(k)
    share = min(1.0, 2.0 * batch_rows / (n + 1))
    smooth = lowest = None
    stale = 0
    for step in range(max_steps):
        batch = batches.read(step)
        if centres is not None:
            sums, counts, cost = partial_sums(batch, centres[None])
            centres, seen = _pulled(centres, seen, sums[0], counts[0])
            rows, cost = counts.sum(), float(cost[0])
        else:
            before = table.agg(F.sum("seen")).first()[0]
            table = materialize(table_step(batch, table, model_values), "centres")
            after = table.agg(F.sum("seen").alias("n"), F.sum("cost").alias("c")).first()
            rows, cost = after["n"] - before, after["c"]
        mean = cost / max(1, rows)
        smooth = mean if smooth is None else smooth * (1 - share) + mean * share
        stale = 0 if lowest is None or smooth < lowest else stale + 1
        lowest = smooth if lowest is None else min(lowest, smooth)
        if stale >= patience:
            break
    if centres is None:
        return table.select("word_id", "centroid", "seen")
    counted = spark.createDataFrame(pa.table({"word_id": pa.array(np.arange(k), pa.int32()), "seen": pa.array(seen.astype(np.int64))}))
    return materialize(centre_rows(spark, centres).join(counted, "word_id"), "centres")
