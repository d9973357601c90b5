"""The nearest centre of every point, exactly, for models of any size.

A model of at most ``MODEL_VALUES`` numbers (its size is counted first) travels to the tasks as
one matrix and points stay where they are.  A larger model stays a table and is searched in two
levels, without ever being collected:

1. at most ``PIVOTS`` of the centres are pivots (the only rows that reach the driver); every
   centre belongs to the cell of its nearest pivot, which keeps its smallest and largest radius;
2. a point is compared with the centres of its own cell, which bounds its distance from above;
3. the triangle inequality bounds its distance to any centre of another cell from below by
   ``max(D - largest radius, smallest radius - D)`` (D: distance to that cell's pivot); the point
   is sent on only to cells whose bound does not exceed what it has found;
4. the smallest (distance, id) over a point's cells is its answer.

Cells meet their points by key.  A cell with many centres is cut into parts of ``PART_CENTRES``,
one with many points into groups of ``GROUP_POINTS`` (both by counted numbers), so no group
grows with the data.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from ..session import materialize

MODEL_VALUES = 1 << 20  # centres x dimension sent to the tasks as one matrix
PIVOTS = 512
PART_CENTRES = 4096
GROUP_POINTS = 50_000
# Distances (and differences) held at once by a comparison.
CENTROID_BLOCK_VALUES = 1 << 20


def nearest_rows(x: np.ndarray, ids: np.ndarray, matrix: np.ndarray, round_to: int | None,
                 block_values: int = CENTROID_BLOCK_VALUES) -> tuple[np.ndarray, np.ndarray]:
    """``(id, squared distance)`` of the nearest row of ``matrix`` for each row of ``x``.

    ``ids`` ascend; ties (after rounding) go to the smallest id.  Matrix products find the candidates
    within rounding error of the smallest distance, whose distances are then taken from differences.
    A row with a non-finite value gets id -1 and distance NaN.
    """
    best, dist = np.full(len(x), -1, dtype=np.int64), np.full(len(x), np.nan)
    if not len(x) or not len(ids):
        return best, dist
    square = (matrix ** 2).sum(axis=1)
    grain = 0.0 if round_to is None else 2 * 10.0 ** -round_to
    step = max(1, min(len(ids), block_values))
    rows = max(1, block_values // step)
    pairs = max(1, block_values // max(1, matrix.shape[1]))
    for lo in range(0, len(x), rows):
        part = x[lo:lo + rows]
        own = (part ** 2).sum(axis=1)
        near = np.full(len(part), np.inf)
        at = np.full(len(part), -1, dtype=np.int64)
        for a in range(0, len(ids), step):
            rough = square[None, a:a + step] - 2 * (part @ matrix[a:a + step].T)
            slack = grain + 1e-12 * (own + square[a:a + step].max())
            r, c = np.nonzero(rough <= (np.minimum(rough.min(axis=1), near - own) + slack)[:, None])
            for k in range(0, len(r), pairs):
                rr, cc = r[k:k + pairs], c[k:k + pairs] + a
                d = ((part[rr] - matrix[cc]) ** 2).sum(axis=1)
                d = np.round(d, round_to) if round_to is not None else d
                order = np.lexsort((cc, d, rr))
                first = order[np.unique(rr[order], return_index=True)[1]]
                nearer = d[first] < near[rr[first]]
                near[rr[first[nearer]]], at[rr[first[nearer]]] = d[first[nearer]], cc[first[nearer]]
        found = at >= 0
        best[lo:lo + rows] = np.where(found, ids[at], -1)
        dist[lo:lo + rows] = np.where(found, near, np.nan)
    return best, dist


def vectors_of(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the non-null vectors of a list column, and the vectors as rows."""
    some = np.flatnonzero(~np.asarray(column.is_null()))
    flat = column.drop_null().flatten().to_numpy(zero_copy_only=False)
    return some, flat.reshape(len(some), dim)


def _placed(values: np.ndarray, some: np.ndarray, good: np.ndarray, size: int, kind: pa.DataType) -> pa.Array:
    out, none = np.zeros(size, dtype=values.dtype), np.ones(size, dtype=bool)
    out[some], none[some] = values, ~good
    return pa.array(out, kind, mask=none)


def _with_matrix(points: DataFrame, rows: list, round_to: int | None, block_values: int) -> DataFrame:
    ids = np.array([r["word_id"] for r in rows], dtype=np.int64)
    matrix = np.array([r["c"] for r in rows], dtype=np.float64)
    names = points.columns[:-1]

    def assign(batches):
        for batch in batches:
            some, x = vectors_of(batch.column("_vec"), matrix.shape[1])
            word, dist = nearest_rows(x, ids, matrix, round_to, block_values)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), _placed(word, some, word >= 0, n, pa.int32()),
                 _placed(dist, some, word >= 0, n, pa.float64())], [*names, "word_id", "dist"])

    schema = StructType([*points.schema.fields[:-1], StructField("word_id", IntegerType()), StructField("dist", DoubleType())])
    return points.mapInArrow(assign, schema)


def _in_cells(points: DataFrame, centres: DataFrame, k: int, dim: int, round_to: int | None, block_values: int) -> DataFrame:
    spark = points.sparkSession
    chosen = centres.orderBy(F.xxhash64("word_id"), "word_id").limit(min(PIVOTS, math.isqrt(k) + 1)).collect()
    pivots = np.array([r["c"] for r in chosen], dtype=np.float64)
    cells = np.arange(len(pivots), dtype=np.int64)

    def to_cell(batches):
        for batch in batches:
            _, x = vectors_of(batch.column("c"), dim)
            cell, square = nearest_rows(x, cells, pivots, None, block_values)
            yield pa.RecordBatch.from_arrays([batch.column("word_id"), batch.column("c"), pa.array(cell, pa.int32()),
                                              pa.array(np.sqrt(square))], ["word_id", "c", "cell", "radius"])

    kept = materialize(centres.mapInArrow(to_cell, "word_id int, c array<double>, cell int, radius double"), "centre_cells")
    size, low, high = np.zeros(len(cells), np.int64), np.full(len(cells), np.inf), np.full(len(cells), -np.inf)
    for r in kept.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("radius").alias("a"), F.max("radius").alias("b")).collect():
        size[r["cell"]], low[r["cell"]], high[r["cell"]] = r["n"], r["a"], r["b"]
    parts = np.maximum(1, -(-size // PART_CENTRES))
    numbered = materialize(points.withColumn("_row", F.monotonically_increasing_id()), "points")

    def routes(with_bound: bool):
        def run(batches):
            for batch in batches:
                some, x = vectors_of(batch.column("_vec"), dim)
                finite = np.isfinite(x).all(axis=1)
                some, x = some[finite], x[finite]
                home, _ = nearest_rows(x, cells, pivots, None, block_values)
                if with_bound:
                    reach = np.sqrt(batch.column("dist").to_numpy(zero_copy_only=False)[some])
                    who, cell = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                    step = max(1, block_values // (len(cells) * dim))
                    for a in range(0, len(x), step):
                        d = np.sqrt(((x[a:a + step, None, :] - pivots[None]) ** 2).sum(axis=2))
                        bound = np.maximum(d - high, low - d)
                        slack = 1e-6 * (1 + reach[a:a + step])
                        w, c = np.nonzero((bound <= (reach[a:a + step] + slack)[:, None]) & (size > 0))
                        other = c != home[a:a + step][w]
                        who.append(w[other] + a)
                        cell.append(c[other])
                    who, cell = np.concatenate(who), np.concatenate(cell)
                else:
                    who, cell = np.arange(len(x)), home
                again = parts[cell]
                part = np.arange(int(again.sum())) - np.repeat(np.cumsum(again) - again, again)
                who, cell = np.repeat(who, again), np.repeat(cell, again)
                at = pa.array(some[who])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_row").take(at), batch.column("_vec").take(at), pa.array(cell, pa.int32()),
                     pa.array(part, pa.int32())], ["_row", "_vec", "cell", "part"])
        return run

    def compare(given: pa.Table, block: pa.Table) -> pa.Table:
        order = np.argsort(block.column("word_id").to_numpy())
        ids = block.column("word_id").to_numpy()[order].astype(np.int64)
        matrix = vectors_of(block.column("c").combine_chunks(), dim)[1][order]
        word, dist = nearest_rows(vectors_of(given.column("_vec").combine_chunks(), dim)[1], ids, matrix, round_to, block_values)
        return pa.table({"_row": given.column("_row"), "word_id": pa.array(word, pa.int32()),
                         "dist": pa.array(np.where(word < 0, np.inf, dist))})

    def searched(routed: DataFrame) -> DataFrame:
        counts = routed.groupBy("cell", "part").agg(F.count(F.lit(1)).alias("n")).withColumn(
            "groups", F.ceil(F.col("n") / GROUP_POINTS).cast("int")).drop("n")
        sizes = materialize(counts, "cell_points")  # one row per part of a cell
        spread = F.pmod(F.xxhash64("_row"), F.col("groups")).cast("int").alias("salt")
        left = routed.join(sizes, ["cell", "part"]).select("_row", "_vec", "cell", "part", spread)
        cut = spark.createDataFrame([(int(c), int(parts[c])) for c in cells], "cell int, parts int")  # at most PIVOTS rows
        right = (kept.join(F.broadcast(cut), "cell").withColumn("part", F.pmod(F.xxhash64("word_id"), "parts").cast("int"))
                 .join(sizes, ["cell", "part"]).select("word_id", "c", "cell", "part", F.explode(
                     F.sequence(F.lit(0), F.col("groups") - 1)).alias("salt")))
        keys = ["cell", "part", "salt"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
            compare, "_row long, word_id int, dist double")

    slim = numbered.select("_row", "_vec")
    kind = "_row long, _vec array<double>, cell int, part int"
    least = F.min(F.struct("dist", "word_id")).alias("least")
    home = materialize(searched(slim.mapInArrow(routes(False), kind)).groupBy("_row").agg(least)
                       .select("_row", "least.*"), "home_cells")
    onwards = slim.join(home.select("_row", "dist"), "_row").mapInArrow(routes(True), kind)
    other = searched(materialize(onwards, "other_cells"))
    best = home.unionByName(other).groupBy("_row").agg(least)
    word, dist = F.col("least.word_id"), F.col("least.dist")
    return numbered.join(best, "_row", "left").select(*points.columns[:-1], word.alias("word_id"), dist.alias("dist"))


def nearest_centroid(points: DataFrame, centroids: DataFrame, vec_col: str = "vec", round_to: int | None = 9,
                     block_values: int = CENTROID_BLOCK_VALUES, model_values: int = MODEL_VALUES) -> DataFrame:
    """``points`` plus ``word_id`` (nearest centroid, ties to the smallest id) and ``dist``
    (squared Euclidean distance).

    ``centroids(word_id, centroid)`` is a fitted model with unique ids.  A null vector, or one with a
    non-finite value, gets nulls.  Memory is bounded by ``block_values`` for any number of centroids.
    """
    centres = centroids.select(F.col("word_id").cast("int").alias("word_id"),
                               F.col("centroid").cast("array<double>").alias("c"))
    size = centres.agg(F.count(F.lit(1)).alias("k"), F.max(F.size("c")).alias("d")).first()
    if not size["k"]:
        raise ValueError("no centroids")
    given = points.withColumn("_vec", F.col(vec_col).cast("array<double>"))
    if size["k"] * size["d"] <= model_values:
        return _with_matrix(given, centres.orderBy("word_id").collect(), round_to, block_values)
    return _in_cells(given, centres, size["k"], size["d"], round_to, block_values)
