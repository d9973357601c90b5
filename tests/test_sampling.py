import hashlib

import pytest

from pyspark.sql import functions as F

from topiclens.operators import sampling as SA
from topiclens.operators.indexing import with_global_index, with_running_sum


def test_global_index_dense(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("v")).repartition(5)
    got = with_global_index(df, ["v"], "ix").collect()
    assert sorted(r.ix for r in got) == list(range(1000))
    assert all(r.ix == r.v for r in got)


def test_running_sum(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(50)], "k long, v long").repartition(4)
    got = {r.k: r.running for r in with_running_sum(df, "k", "v").collect()}
    acc = 0
    for i in range(50):
        acc += i % 3
        assert got[i] == acc


def test_sample_n_repeatable_and_partition_free(spark):
    df = spark.range(0, 500).withColumnRenamed("id", "doc_id")
    a = [r.doc_id for r in SA.sample_n(df, "doc_id", 37).collect()]
    b = [r.doc_id for r in SA.sample_n(df.repartition(7), "doc_id", 37).collect()]
    assert len(a) == 37 and sorted(a) == sorted(b)
    ref = sorted(range(500), key=lambda i: (hashlib.md5(f"{i}:16".encode()).hexdigest(), i))[:37]
    assert sorted(a) == sorted(ref)


def test_stratified_sample(spark):
    rows = [(i, "big" if i < 300 else f"s{i % 3}") for i in range(330)]
    df = spark.createDataFrame(rows, "photo_id long, label string")
    out = SA.stratified_sample_n(df, "label", "photo_id", 5)
    counts = {r.label: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts == {"big": 5, "s0": 5, "s1": 5, "s2": 5}
    assert SA.stratified_sample_n(df, "label", "photo_id", 0).count() == 330
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def brute_chunk_sample(rows, size, match, seed=16):
    per = int(size / 20)
    out, total = [], 0
    for c in range(0, (len(rows) + size - 1) // size):
        chunk = [r for r in rows[c * size:(c + 1) * size] if match(r)]
        chunk.sort(key=lambda r: (hashlib.md5(f"{r[0]}:{seed}".encode()).hexdigest(), r))
        take = chunk[:per]
        out += [(r, c) for r in take]
        total += len(take)
        if total >= size:
            break
    return out


def test_chunk_sample_equals_brute_force(spark):
    rows = [(i, (i * 37) % 11) for i in range(2000)]
    df = spark.createDataFrame(rows, "k long, stars long").repartition(3)
    for size in (100, 39):
        got = SA.chunk_sample(df, ["k"], F.col("stars") < 4, size, F.col("k"))
        got = sorted((r.k, r.stars, r.chunk) for r in got.collect())
        ref = sorted((r[0], r[1], c) for r, c in brute_chunk_sample(rows, size, lambda r: r[1] < 4))
        assert got == ref


def test_semi_and_anti_join_plan(spark):
    big = spark.range(0, 1000).withColumnRenamed("id", "business_id")
    ids = spark.createDataFrame([(1,), (5,)], "business_id long")
    semi = SA.semi_join(big, ids, "business_id", broadcast_right=True)
    assert semi.count() == 2
    assert "BroadcastHashJoin" in semi._jdf.queryExecution().executedPlan().toString()
    assert SA.anti_join(big, ids, "business_id").count() == 998


def test_sample_n_large_path_equals_top_k(spark, monkeypatch):
    df = spark.range(0, 300).withColumnRenamed("id", "doc_id")
    small = sorted(r.doc_id for r in SA.sample_n(df, "doc_id", 50).collect())
    monkeypatch.setattr(SA, "TOP_K_MAX", 10)
    big = sorted(r.doc_id for r in SA.sample_n(df.repartition(4), "doc_id", 50).collect())
    assert small == big


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_global_index_of_a_million_rows_with_payload(spark, adaptive):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        n = 1_000_000
        df = spark.range(n).select((F.col("id") * 7919 % n).alias("v"), F.md5(F.col("id").cast("string")).alias("payload"))
        got = with_global_index(df, ["v"], "ix")
        row = got.agg(F.count(F.lit(1)), F.count_distinct("ix"), F.min("ix"), F.max("ix"),
                      F.count_if(F.col("ix") != F.col("v"))).first()
        assert tuple(row) == (n, n, 0, n - 1, 0)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_large_sample_and_vocabulary_are_exact(spark):
    from topiclens.operators.vocabulary import filter_extremes

    df = spark.range(300_000).withColumnRenamed("id", "doc_id").withColumn("x", F.rand(1))
    got = SA.sample_n(df, "doc_id", 150_000)
    assert got.count() == 150_000 == got.select("doc_id").distinct().count()
    vocab = spark.range(1_000_000).select(F.concat(F.lit("t"), F.col("id")).alias("term"), (F.col("id") % 50 + 1).alias("df"),
                                          F.lit(1).cast("long").alias("cf"))
    kept = filter_extremes(vocab, 100, 1, 1.0, 1_000_000)
    row = kept.agg(F.count(F.lit(1)), F.count_distinct("term_id"), F.max("term_id")).first()
    assert tuple(row) == (1_000_000, 1_000_000, 999_999)


def test_threshold_sample_equals_window(spark, monkeypatch):
    rows = [(i, None if i % 50 == 0 else "hot" if i % 3 else f"s{i % 7}") for i in range(4000)] + [(17, "hot"), (17, "hot")]
    df = spark.createDataFrame(rows, "photo_id long, label string").withColumn("cut", F.lit("x"))
    for n in (1, 30, 700, 5000):
        want = sorted(map(str, SA.stratified_sample_n(df, "label", "photo_id", n).collect())) if n <= 1000 else sorted(map(str, df.collect()))
        monkeypatch.setattr(SA, "GROUP_LIMIT_MAX", 0)
        got = sorted(map(str, SA.stratified_sample_n(df.repartition(5), "label", "photo_id", n).collect()))
        monkeypatch.undo()
        assert got == want


def test_threshold_sample_of_a_hot_label(spark):
    df = spark.range(1_000_000).select(F.col("id").alias("k"), F.when(F.col("id") % 100 > 0, "hot").otherwise("cold").alias("label"))
    got = SA.stratified_sample_n(df, "label", "k", 100_000)
    assert {r["label"]: r["count"] for r in got.groupBy("label").count().collect()} == {"hot": 100_000, "cold": 10_000}
    want = df.filter("label = 'hot'").orderBy(SA.seeded_hash("k", 16), "k").limit(100_000)
    assert got.filter("label = 'hot'").select("k").exceptAll(want.select("k")).count() == 0
    assert SA.stratified_sample_n(df.limit(0), "label", "k", 100_000).count() == 0


def test_chunk_sample_reads_a_prefix(spark, monkeypatch):
    rows = [(None if i % 97 == 0 else i // 5, i, (i * 37) % 11, "p") for i in range(30_000)]
    df = spark.createDataFrame(rows, "a long, k long, stars long, payload string").repartition(6)
    size, seen = 100, []
    full = SA.with_global_index
    monkeypatch.setattr(SA, "with_global_index", lambda d, *a, **b: seen.append(d.count()) or full(d, *a, **b))
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for limit, few in ((4, 100_000), (1, 3), (0, 100_000)):  # many, few and no matches
        monkeypatch.setattr(SA, "FEW_CHUNKS", few)
        seen.clear()
        got = SA.chunk_sample(df, ["a", "k"], F.col("stars") < limit, size, F.col("k"))
        got = sorted((r.k, r.chunk) for r in got.collect())
        flat = [(r[1], r[2]) for r in ordered]
        assert got == sorted((r[0], c) for r, c in brute_chunk_sample(flat, size, lambda r: r[1] < limit))
        assert seen[0] < 30_000 / 5 and (limit > 0 or seen[-1] == 30_000)


def test_prefix_filter_is_pushed_down(spark, tmp_path):
    spark.range(1000).select(F.col("id").alias("k")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = df.filter(SA._up_to(["k"], df.schema, df.filter("k = 5").first()))
    assert plan.count() == 6 and "LessThanOrEqual(k,5)" in plan._jdf.queryExecution().executedPlan().toString()
