import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from topiclens.llm import ann_search
from topiclens.llm.ann_search import _best_first, nearest


def brute(rows, k=20):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good.setdefault((i, tuple(v)), None)
    pairs = list(good)
    out = {}
    for i, v in pairs:
        if i % 20 == 0:
            s = sorted((-float(np.dot(np.array(v), np.array(w))), j) for j, w in pairs if j != i)
            out[i] = s[:k]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(0, i, v) for i, v in rows], "bucket int, vec_id long, embedding array<float>")


def check(got, want, recall, k=20):
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(by) <= set(want)
    hits = total = 0
    for q, nearest_ in want.items():
        found = sorted(by.get(q, []))
        assert [r for r, _, _ in found] == list(range(1, len(found) + 1)) and len(found) <= k
        assert all(a[2] > b[2] or (a[2] == b[2] and a[1] < b[1]) for a, b in zip(found, found[1:]))
        hits += len({v for _, v, _ in found} & {v for _, v in nearest_})
        total += len(nearest_)
    assert hits >= recall * total, hits / max(total, 1)


def test_recall_on_the_test_table(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.select("vec_id", "embedding").collect()]
    got = nearest(vectors, F.col("id") % 20 == 0).collect()
    x = np.array([v for _, v in rows], dtype=np.float64)
    ids = np.array([i for i, _ in rows])
    want = {}
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        order = [j for j in np.lexsort((ids, -s)) if j != i][:20]
        want[int(ids[i])] = [(-s[j], int(ids[j])) for j in order]
    check(got, want, 0.9)
    exact = {(int(i), int(j)): s for i in ids[ids % 20 == 0] for s, j in want[int(i)]}
    for r in got:
        if (r["query_id"], r["vec_id"]) in exact:
            assert abs(r["score"] + exact[r["query_id"], r["vec_id"]]) < 1e-9


def test_clusters_ties_nulls_and_copies(spark):
    rng = random.Random(2)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(12)]
    rows = [(i, [c + rng.gauss(0, 0.1) for c in centres[i % 12]]) for i in range(600)]
    rows += [(1000 + i, centres[3]) for i in range(300)]  # a large group of copies
    rows = [(i, np.array(v, dtype=np.float32).astype(float).tolist()) for i, v in rows]
    rows += [(2000, None), (2020, []), (2040, [0.0] * 8), (2060, [float("nan")] + [1.0] * 7), (2080, [None] + [1.0] * 7),
             (2100, [float("inf")] + [1.0] * 7), (None, [1.0] * 8), (40, rows[40][1]), (2120, [1.0, 2.0])]
    got = nearest(frame(spark, rows), F.col("id") % 20 == 0).collect()
    check(got, brute([r for r in rows if r[0] != 2120]), 0.9)
    assert {r["query_id"] for r in got} >= {1000, 1020, 1040}


def test_few_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.0]), (20, [0.0, 2.0])]
    got = nearest(frame(spark, rows), F.col("id") % 20 == 0, k=20).collect()
    check(got, brute(rows), 0.0)
    assert nearest(frame(spark, []), F.col("id") % 20 == 0).collect() == []
    assert nearest(frame(spark, [(0, None)]), F.col("id") % 20 == 0).collect() == []
    assert nearest(frame(spark, [(0, [1.0])]), F.col("id") % 20 == 0).collect() == []


def test_best_first_order_by_heap_and_by_grid():
    rng = np.random.default_rng(1)
    for sizes in ([5] * 7, [3, 4]):  # beyond and below the grid's limit
        logs = []
        for n in sizes:
            p = rng.dirichlet(np.ones(n) * 0.4)
            logs.append(np.log(np.sort(p)[::-1] + 1e-12))
        picks = _best_first(logs, 0.6)
        chance = np.exp([sum(logs[j][i] for j, i in enumerate(row)) for row in picks])
        assert (np.diff(chance) <= 1e-12).all() and chance.sum() >= 0.6 > chance[:-1].sum()
        assert len({tuple(r) for r in picks.tolist()}) == len(picks)


def test_vectors_of_two_lengths(spark):
    """Each length is searched among its like; the minority gets its rows too."""
    rng = np.random.default_rng(5)
    long = [(i, [float(x) for x in rng.normal(size=16)]) for i in range(0, 300)]
    short = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(1000, 1060)]
    got = nearest(frame(spark, long + short), F.col("id") % 20 == 0).collect()
    single = frame(spark, [(i, v) for i, v in short]).selectExpr("vec_id", "embedding").collect()
    rows = {r["vec_id"]: r["embedding"] for r in single}
    ours = [r for r in got if r["query_id"] >= 1000]
    assert {r["query_id"] for r in got} == {i for i, _ in long + short if i % 20 == 0}
    check(ours, brute(list(rows.items())), 0.9)
    assert all((r["query_id"] >= 1000) == (r["vec_id"] >= 1000) for r in got)


def test_probes_are_a_row_per_query_and_group():
    rng = np.random.default_rng(5)
    v = rng.normal(size=(30, 8))
    family = ann_search.Family(float(np.linalg.norm(v, axis=1).max()), 0.5, [rng.normal(size=(9, 4)) for _ in range(2)],
                               [rng.uniform(0, ann_search.WIDTH, size=4) for _ in range(2)])
    batch = pa.RecordBatch.from_pydict({"rid": pa.array(range(30), pa.int64()), "v": pa.array(v.tolist())})
    rows = pa.Table.from_batches(list(ann_search._hash_queries(family, 2, 3)([batch]))).to_pylist()
    assert len(rows) <= 30 * 3 and len({(r["rid"], r["grp"]) for r in rows}) == len(rows)
    for i in range(30):
        want = {int(b) for t in range(2) for b in family.probes(family.project(v, t, True)[i], t)}
        assert sorted(b for r in rows if r["rid"] == i for b in r["buckets"]) == sorted(want) and len(want) > 9


def test_groups_in_parts_find_the_same(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in x_]) for i, x_ in enumerate(rng.normal(size=(400, 6)))]
    whole = sorted(nearest(frame(spark, rows), F.col("id") % 20 == 0).collect())
    monkeypatch.setattr(ann_search, "GROUP", 20)
    monkeypatch.setattr(ann_search, "QUERY_CHUNK", 6)
    assert sorted(nearest(frame(spark, rows), F.col("id") % 20 == 0).collect()) == whole
