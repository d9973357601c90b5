import random

from topiclens.operators import clusters as CU


def cont_from_matrix(spark, m):
    rows = [(i, j, int(m[i][j])) for i in range(len(m)) for j in range(len(m[0])) if m[i][j]]
    return spark.createDataFrame(rows, "label_code int, cluster int, n long")


def mapping(spark, m, leftover="smallest_missing"):
    got = {r.cluster: r.label_code for r in CU.match_clusters(cont_from_matrix(spark, m), leftover).collect()}
    return [got[c] for c in sorted(got)]


def test_match_clusters_losers_get_smallest_missing(spark):
    assert mapping(spark, [[9, 8, 7], [1, 2, 1], [1, 1, 2]]) == [0, 1, 1]
    assert mapping(spark, [[9, 8, 7], [1, 2, 1], [1, 1, 2]], "one_to_one") == [0, 1, 2]


def test_match_clusters_tied_purity_loses_nobody(spark):
    assert mapping(spark, [[0, 5, 0], [5, 0, 0], [0, 0, 5]]) == [1, 0, 2]


def ari_of(spark, a, b):
    df = spark.createDataFrame(list(zip(a, b)), "label_code int, cluster int")
    return CU.adjusted_rand_index(CU.contingency(df)).first()[0]


def brute_ari(a, b):
    from itertools import combinations

    pairs = list(combinations(range(len(a)), 2))
    same_a = [a[i] == a[j] for i, j in pairs]
    same_b = [b[i] == b[j] for i, j in pairs]
    n11 = sum(x and y for x, y in zip(same_a, same_b))
    sa, sb, p = sum(same_a), sum(same_b), len(pairs)
    exp = sa * sb / p
    den = (sa + sb) / 2 - exp
    return 1.0 if den == 0 else (n11 - exp) / den


def test_ari_identical_symmetric_relabelled(spark):
    a = [0, 0, 1, 1, 2, 2, 2]
    assert ari_of(spark, a, a) == 1.0
    assert ari_of(spark, a, [5, 5, 3, 3, 9, 9, 9]) == 1.0
    rnd = random.Random(3)
    for _ in range(3):
        x = [rnd.randrange(3) for _ in range(30)]
        y = [rnd.randrange(4) for _ in range(30)]
        v = ari_of(spark, x, y)
        assert abs(v - ari_of(spark, y, x)) < 1e-12
        assert abs(v - brute_ari(x, y)) < 1e-12


def test_evaluate_never_increases_label_count(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 2), (2, 2), (2, 2)], "label_code int, cluster int")
    cont, ari, raw = CU.evaluate_clusters(df)
    assert cont.select("cluster").distinct().count() <= 3
    assert -1 <= ari.first()[0] <= 1 and -1 <= raw.first()[0] <= 1


def test_label_codes_sorted(spark):
    df = spark.createDataFrame([("menu",), ("food",), ("drink",), ("food",)], "label string")
    got = {r.label: r.label_code for r in CU.label_codes(df, "label").collect()}
    assert got == {"drink": 0, "food": 1, "menu": 2}


def test_nearest_centroid_blocks(spark):
    pts = spark.createDataFrame([(1, [0.0, 0.0]), (2, [5.0, 5.1]), (3, [2.5, 2.5])], "id long, vec array<double>")
    cen = spark.createDataFrame([(7, [0.0, 0.0]), (3, [5.0, 5.0]), (9, [5.0, 5.0])], "word_id int, centroid array<double>")
    for block in (1 << 18, 2, 1):
        got = {r.id: r.word_id for r in CU.nearest_centroid(pts, cen, block_values=block).collect()}
        # ties go to the smallest id: point 3 is equally far from all -> 3
        assert got == {1: 7, 2: 3, 3: 3}


def test_long_to_wide_and_histogram(spark):
    a = spark.createDataFrame([(1, 0), (1, 0), (1, 2), (2, 1)], "image_id long, word_id int")
    h = CU.bovw_histogram(a)
    ids = spark.createDataFrame([(1,), (2,), (3,)], "image_id long")
    wide = {r.image_id: (r.w0, r.w1, r.w2) for r in CU.long_to_wide(h, "image_id", "word_id", "cnt", [0, 1, 2], ids).collect()}
    assert wide == {1: (2, 0, 1), 2: (0, 1, 0), 3: (0, 0, 0)}


def test_covariance_matches_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.normal(size=(20, 4))
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, vec array<double>")
    long = CU.explode_vector(df, "id", "vec")
    cov = {(r.dim_i, r.dim_j): r.cov for r in CU.covariance_long(long, 4).collect()}
    ref = np.cov(x, rowvar=False)
    for (i, j), v in cov.items():
        assert abs(v - ref[i, j]) < 1e-10
    scaled = CU.standard_scale_long(long)
    stats = scaled.groupBy("dim").agg({"value": "avg"}).collect()
    assert all(abs(r[1]) < 1e-12 for r in stats)


def test_null_label_has_code_minus_one(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a")], "id long, label string")
    got = {r["id"]: r["label_code"] for r in CU.label_codes(df, "label").collect()}
    assert got == {1: 1, 2: -1, 3: 0}
    assert CU.distinct_labels(df, "label").first()[0] == 2


def test_square_confusion_with_codes_on_one_side_only(spark):
    cont = spark.createDataFrame([(0, 0, 3), (0, 4, 1), (2, 0, 2)], "label_code int, cluster int, n long")
    got = {r["label_code"]: tuple(r)[1:] for r in CU.confusion_wide(cont).collect()}
    assert got == {0: (3, 0, 1), 2: (2, 0, 0), 4: (0, 0, 0)}


def test_dense_rows(spark):
    cells = spark.createDataFrame([(1, 2, 0.5), (1, 0, 1.5), (2, 999, 2.0)], "doc_id long, term_id int, weight double")
    rows = spark.createDataFrame([(1,), (2,), (3,)], "doc_id long")
    got = {r["doc_id"]: r["row"] for r in CU.long_to_dense(cells, "doc_id", "term_id", "weight", 1000, rows).collect()}
    assert all(len(v) == 1000 for v in got.values()) and got[1][:3] == [1.5, 0, 0.5] and got[2][999] == 2.0 and not any(got[3])


def test_dense_rows_are_summed_where_they_are_laid_out(spark):
    cells = spark.createDataFrame([(1, 0, 0.5), (1, 4999, 2.0), (2, 7, -1.0), (2, 8, 1.0), (None, 3, 4.0)],
                                  "doc_id long, term_id int, weight double")
    rows = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "doc_id long")
    got = CU.long_to_dense(cells, "doc_id", "term_id", "weight", 5000, rows, CU.dense_sums,
                           "width int, n_nonzero int, total double, by_place double")
    want = [(1, 5000, 2, 2.5, 10000.5), (2, 5000, 2, 0.0, 1.0), (2, 5000, 2, 0.0, 1.0), (3, 5000, 0, 0.0, 0.0), (None, 5000, 0, 0.0, 0.0)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert CU.long_to_dense(cells, "doc_id", "term_id", "weight", 0, rows.limit(0), CU.dense_sums,
                            "width int, n_nonzero int, total double, by_place double").collect() == []
