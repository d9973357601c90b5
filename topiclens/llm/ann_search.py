"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing.

Vectors are scaled by the largest norm and get one more coordinate that makes them unit
vectors; a query is scaled to a unit vector, so the largest inner product is the smallest
Euclidean distance.  A table hashes a vector by ``m`` Gaussian (2-stable) projections cut into
cells of width ``WIDTH``.  For a query with projection p, a neighbour at cosine rho projects to
about N(rho * p, 1 - rho^2), so the chance that it lies in a cell is a difference of two normal
distribution functions, and the chance of a bucket is the product over the projections.
Buckets are visited in the order of that chance until the visited chance reaches ``SUCCESS`` per
table; candidates of all tables are merged and ranked by the exact inner product.

``rho`` is estimated on a sample of at most ``SAMPLE`` vectors.  ``m`` grows with the logarithm of
the number of vectors, so buckets keep their size.  Every vector is indexed.

Equal vectors are one entry with its smallest ids (more than ``k`` + 1 can never be returned), so a
vector that a third of all rows share is one candidate.  Buckets are dealt to groups of about
``GROUP`` vectors; a group that holds more is split into parts, and queries are dealt in chunks, so no
task holds an unbounded group; a bucket travels only to the chunks that probe it.  The buckets
that a query probes stay an array per query and group: a pair of query and bucket is never a row.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .arrow_text import mix64

K = 20
TABLES = 2
WIDTH = 1.5
SUCCESS = 0.74
BUCKET = 64
BRANCH = 3.3
GROUP = 16384
PROBE_QUERIES = 128  # queries that one task hashes and probes
QUERY_CHUNK = 4096
SAMPLE = 2048
SEED = 1234


@dataclass
class Family:
    """The hash tables: projections, offsets and the neighbour's assumed cosine."""

    norm: float
    rho: float
    projections: list[np.ndarray]
    offsets: list[np.ndarray]

    def project(self, v: np.ndarray, table: int, query: bool) -> np.ndarray:
        """Projections of raw vectors (rows), after the step to unit vectors."""
        if query:
            unit = v / np.linalg.norm(v, axis=1, keepdims=True)
            last = np.zeros(len(v))
        else:
            unit = v / self.norm
            last = np.sqrt(np.maximum(0.0, 1.0 - (unit ** 2).sum(axis=1)))
        return np.column_stack((unit, last)) @ self.projections[table]

    def bucket(self, cells: np.ndarray, table: int) -> np.ndarray:
        key = np.full(len(cells), np.uint64(table + 1))
        for j in range(cells.shape[1]):
            key = mix64(key * np.uint64(31) + cells[:, j].astype(np.int64).view(np.uint64))
        return key.view(np.int64)

    def probes(self, p: np.ndarray, table: int) -> np.ndarray:
        """Buckets of one query in the order of their chance, up to ``SUCCESS`` together."""
        spread = math.sqrt(max(1e-6, 1 - self.rho ** 2))
        offset, cells, chances = self.offsets[table], [], []
        for j, x in enumerate(p):
            centre = self.rho * x
            lo = math.floor((centre - 4 * spread + offset[j]) / WIDTH)
            hi = math.floor((centre + 4 * spread + offset[j]) / WIDTH)
            edges = [0.5 * (1 + math.erf(((c * WIDTH - offset[j]) - centre) / (spread * math.sqrt(2))))
                     for c in range(lo, hi + 2)]
            chance = np.maximum(np.diff(edges), 1e-12)
            order = np.argsort(-chance, kind="stable")
            cells.append(np.arange(lo, hi + 1)[order])
            chances.append(np.log(chance[order]))
        picks = _best_first(chances, SUCCESS)
        chosen = np.column_stack([cells[j][picks[:, j]] for j in range(len(cells))])
        return self.bucket(chosen, table)


def _best_first(logs: list[np.ndarray], success: float) -> np.ndarray:
    """Index combinations by falling sum of logs until their chances add up to ``success``."""
    if math.prod(map(len, logs)) <= 1 << 16:
        total = logs[0]
        for more in logs[1:]:
            total = (total[:, None] + more[None, :]).ravel()
        order = np.argsort(-total, kind="stable")
        stop = int(np.searchsorted(np.cumsum(np.exp(total[order])), success)) + 1
        return np.column_stack(np.unravel_index(order[:stop], [len(x) for x in logs]))
    first = (0,) * len(logs)
    heap, out, reached = [(-sum(x[0] for x in logs), first, 0)], [], 0.0
    while heap and reached < success:
        cost, pick, low = heapq.heappop(heap)
        out.append(pick)
        reached += math.exp(-cost)
        for j in range(low, len(logs)):  # each combination has one predecessor
            if pick[j] + 1 < len(logs[j]):
                step = logs[j][pick[j]] - logs[j][pick[j] + 1]
                heapq.heappush(heap, (cost + step, (*pick[:j], pick[j] + 1, *pick[j + 1:]), j))
    return np.array(out, dtype=np.int64)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(flat, pa.ChunkedArray):
        return np.zeros((0, 0))
    n = len(flat)
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, v`` (doubles) of the rows that take part."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    given = vectors.select(F.col(key).cast("long").alias("id"), v.alias("v")).filter("id is not null and v is not null")
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    given = given.filter((F.size("v") > 0) & sound).filter(F.exists("v", lambda x: x != 0.0))
    return given


def _entries(given: DataFrame, k: int) -> DataFrame:
    """``rid, ids, v``: one row per different vector, with its k + 1 smallest ids."""
    order = Window.partitionBy("v").orderBy("id")
    few = given.distinct().withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1)
    return few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")) \
        .select(F.col("ids")[0].alias("rid"), "ids", "v")


def fit(entries: DataFrame, k: int, tables: int, n: int) -> Family:
    """Norm from all vectors; rho from a sample of at most ``SAMPLE``, which does not grow."""
    norm = math.sqrt(entries.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()[0])
    sample = np.array([r["v"] for r in entries.orderBy(F.xxhash64("rid"), "rid").limit(SAMPLE).select("v").collect()])
    unit = sample / norm
    query = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    cosine = query @ unit.T
    np.fill_diagonal(cosine, -np.inf)
    rank = min(max(1, math.ceil(k * len(sample) / n)), max(1, len(sample) - 1))
    near = np.sort(cosine, axis=1)[:, -rank]
    near = near[np.isfinite(near)]
    rho = float(np.clip(np.median(near), 0.0, 0.999)) if len(near) else 0.0
    m = max(1, round(math.log(max(n / BUCKET, BRANCH)) / math.log(BRANCH)))
    rng = np.random.default_rng(SEED)
    return Family(norm, rho, [rng.normal(size=(sample.shape[1] + 1, m)) for _ in range(tables)],
                  [rng.uniform(0, WIDTH, size=m) for _ in range(tables)])


def _group_of(bucket: np.ndarray, groups: int) -> np.ndarray:
    return (mix64(bucket.view(np.uint64)) % np.uint64(groups)).astype(np.int32)


def _grouped(batch: pa.RecordBatch, bucket: np.ndarray, groups: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(bucket), pa.array(_group_of(bucket, groups))],
                                      [*batch.schema.names, "bucket", "grp"])


def _hash_members(family: Family, tables: int, groups: int):
    def run(batches):
        for batch in batches:
            v = _matrix(batch.column("v"))
            for t in range(tables):
                if len(v):
                    cells = np.floor((family.project(v, t, False) + family.offsets[t]) / WIDTH)
                    yield _grouped(batch, family.bucket(cells, t), groups)

    return run


def _hash_queries(family: Family, tables: int, groups: int):
    """Of each query and group the buckets to visit, in one row."""

    def run(batches):
        for batch in batches:
            v, rid = _matrix(batch.column("v")), batch.column("rid").to_numpy()
            p = [family.project(v, t, True) if len(v) else [] for t in range(tables)]
            for i, r in enumerate(rid):
                found = np.unique(np.concatenate([family.probes(p[t][i], t) for t in range(tables)]))
                group = _group_of(found, groups)
                order = np.argsort(group, kind="stable")
                own, first = np.unique(group[order], return_index=True)
                ends = np.append(first, len(found)).astype(np.int32)
                yield pa.RecordBatch.from_pydict({"rid": np.full(len(own), r), "grp": own, "buckets": pa.ListArray.from_arrays(
                    pa.array(ends), pa.array(found[order]))})

    return run


def _probed(key: tuple, held: pa.Table, queries: pa.Table) -> pa.Table:
    """The queries of a chunk with those of their buckets that a group holds; and, with a null query, all of these."""
    rids, buckets = [], []
    if held.num_rows and queries.num_rows:
        there = np.sort(held.column("buckets").combine_chunks().flatten().to_numpy())
        met = np.zeros(len(there), dtype=bool)
        for r, asked in zip(queries.column("rid").to_pylist(), queries.column("buckets")):
            own = asked.values.to_numpy()
            at = np.minimum(np.searchsorted(there, own), len(there) - 1)
            own, at = own[there[at] == own], at[there[at] == own]
            met[at] = True
            if len(own):
                rids.append(r)
                buckets.append(own)
        rids.append(None)
        buckets.append(there[met])
    return pa.table({"grp": pa.array([key[0].as_py()] * len(rids), pa.int32()), "chunk": pa.array([key[1].as_py()] * len(rids), pa.int32()),
                     "rid": pa.array(rids, pa.int64()), "buckets": pa.array(buckets, pa.list_(pa.int64()))})


def _rank(k: int):
    def rank(key: tuple, members: pa.Table, queries: pa.Table) -> pa.Table:
        out = {"rid": [], "id": [], "score": []}
        if members.num_rows and queries.num_rows:
            x, q = _matrix(members.column("v")), _matrix(queries.column("v"))
            bucket, at = np.unique(members.column("bucket").to_numpy(), return_inverse=True)
            ids = members.column("ids").to_pylist()
            least = np.array([i[0] for i in ids])
            copies = np.array([len(i) for i in ids])
            probed, rids = queries.column("buckets"), queries.column("rid").to_pylist()
            for a in range(0, len(q), 64):  # bounded score blocks
                scores = q[a:a + 64] @ x.T
                for row, r in enumerate(range(a, min(a + 64, len(q)))):
                    seen = np.isin(bucket, probed[r].values.to_numpy())[at]
                    own = np.flatnonzero(seen)
                    own = own[np.unique(least[own], return_index=True)[1]]  # a vector may come from two tables
                    s = scores[row][own]
                    if len(own) > k + 1:
                        bar = np.partition(s, len(s) - k - 1)[len(s) - k - 1]
                        own = own[s >= bar - 1e-9 * max(1.0, abs(bar))]
                    exact = (x[own] * q[r]).sum(axis=1)  # the same sum whatever block a pair is in
                    order = np.lexsort((least[own], -exact))
                    pairs = sorted((-e, i) for e, o in zip(exact[order].tolist(), own[order].tolist()) for i in ids[o]) \
                        if copies[own].max(initial=1) > 1 else \
                        list(zip((-exact[order]).tolist(), least[own][order].tolist()))
                    for score, i in pairs[:k + 1]:
                        out["rid"].append(rids[r])
                        out["id"].append(i)
                        out["score"].append(-score)
        return pa.table({"rid": pa.array(out["rid"], pa.int64()), "id": pa.array(out["id"], pa.int64()),
                         "score": pa.array(out["score"], pa.float64())})

    return rank


def nearest(vectors: DataFrame, is_query: Column, k: int = K, tables: int = TABLES, key: str = "vec_id",
            vector: str = "embedding") -> DataFrame:
    """The ``k`` nearest found of each query: ``query_id, rank, vec_id, score``.

    ``is_query`` is a condition on ``id``.  Nearness is the inner product in double precision;
    ties go to the smaller id; a query is not its own neighbour.  Rows with a null id, and
    vectors that are null, empty, zero or hold null or non-finite components take no part.
    Vectors of each length have an index of their own and meet only their like.  Rows that
    repeat an id and vector count once.
    An empty table gives an empty result.  Other columns are not read.
    """
    spark = vectors.sparkSession
    given = usable(vectors, key, vector)
    schema = "query_id long, rank int, vec_id long, score double"
    lengths = [r["d"] for r in given.select(F.size("v").alias("d")).distinct().orderBy("d").collect()]
    if not lengths:
        return spark.createDataFrame([], schema)
    if len(lengths) > 1:
        given = materialize(given, "ann_lengths")
    parts = [_nearest_alike(given.filter(F.size("v") == d), is_query, k, tables) for d in lengths]
    if len(parts) == 1:
        return parts[0]
    # an id may stand at vectors of several lengths: its neighbours are ranked together
    best = Window.partitionBy("query_id", "vec_id").orderBy(F.desc("score"))
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return reduce(DataFrame.unionAll, parts).withColumn("r", F.row_number().over(best)).filter("r = 1") \
        .withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def _nearest_alike(given: DataFrame, is_query: Column, k: int, tables: int) -> DataFrame:
    """``nearest`` for usable vectors (``id, v``) of one length."""
    given = materialize(given, "ann_vectors")
    entries = materialize(_entries(given, k), "ann_entries")
    asked = given.filter(is_query).select("id", "v")
    asked = asked.join(entries.select("rid", "v"), "v").select("id", "rid").distinct()
    asked = materialize(asked, "ann_queries")
    n = entries.count()
    family = fit(entries, k, tables, n)

    groups = max(1, math.ceil(tables * n / GROUP))
    hashed = entries.mapInArrow(_hash_members(family, tables, groups), "rid long, ids array<long>, v array<double>, bucket long, grp int")
    held = hashed.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.collect_set("bucket").alias("buckets"))
    directory = materialize(held.select("grp", F.ceil(F.col("n") / (2 * GROUP)).cast("int").alias("parts"), "buckets"), "ann_buckets")
    parts = directory.select("grp", "parts")
    queries = asked.select("rid").distinct().count()
    chunks = max(1, math.ceil(queries / QUERY_CHUNK))

    chunk = F.pmod(F.xxhash64("rid"), F.lit(chunks)).cast("int")
    heads = asked.select("rid").distinct().join(entries.select("rid", "v"), "rid")
    # small rows, dear tasks: their number follows the queries and not the bytes
    probers = max(1, math.ceil(queries / PROBE_QUERIES))
    probes = heads.repartition(probers, "rid").mapInArrow(_hash_queries(family, tables, groups), "rid long, grp int, buckets array<long>")
    listed = directory.select("grp", "buckets", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    found = listed.groupBy("grp", "chunk").cogroup(probes.withColumn("chunk", chunk).groupBy("grp", "chunk")) \
        .applyInArrow(_probed, "grp int, chunk int, rid long, buckets array<long>")
    probed = materialize(found, "ann_probes")
    needed = probed.filter("rid is null").select("chunk", F.explode("buckets").alias("bucket"))
    sent = hashed.join(needed, "bucket").join(parts, "grp").select(
        "grp", F.pmod(F.xxhash64("rid"), F.col("parts")).cast("int").alias("part"), "chunk", "bucket", "ids", "v")
    asking = probed.filter("rid is not null").join(parts, "grp") \
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).join(heads.select("rid", "v"), "rid").select(
        *[F.col(c).alias(c) for c in ("grp", "part", "chunk", "rid", "v", "buckets")])  # own columns: both sides come from probed
    found = sent.groupBy("grp", "part", "chunk").cogroup(asking.groupBy("grp", "part", "chunk")) \
        .applyInArrow(_rank(k), "rid long, id long, score double")

    order = Window.partitionBy("rid").orderBy(F.desc("score"), "id")
    best = found.dropDuplicates(["rid", "id"]).withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1)
    answers = asked.withColumnRenamed("id", "query_id").join(best.drop("r"), "rid").filter("query_id != id")
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return answers.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", F.col("id").alias("vec_id"), "score")
