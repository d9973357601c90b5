"""Golden cases for edges that plain data does not meet."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from topiclens.functions import image as IM
from topiclens.operators import cleaning as CL
from topiclens.operators import clusters as CU
from topiclens.operators import topics as TP
from topiclens.operators.profile import suggest_types
from topiclens.plans import models as MD
from topiclens.plans import stages as ST


def test_a_type_of_equal_size_never_wins(spark):
    df = spark.createDataFrame([(5_000_000_001, 70_000, 300, 0, 5_000_000_000, 2.0)],
                               "big long, i int, s short, b byte, exact long, f double") \
        .union(spark.createDataFrame([(1, 0, 0, 100, 0, 3.0)], "big long, i int, s short, b byte, exact long, f double"))
    got = {r["column_name"]: r["numpy_type"] for r in suggest_types(df).collect()}
    assert got == {"big": "int64", "i": "int32", "s": "int16", "b": "int8", "exact": "float32", "f": "uint8"}


def test_a_word_with_two_tags_comes_out_once(spark):
    tokens = spark.createDataFrame([(1, 0, "light"), (1, 1, "run")], "doc_id long, pos int, term string")
    lex = spark.createDataFrame([("light", "light", "NOUN"), ("light", "alight", "ADJ"), ("run", "run", "VERB")],
                                "token string, lemma string, pos string")
    got = CL.clean_tokens(tokens, lexicon=lex, pos_to_keep=["NOUN", "ADJ"]).collect()
    assert [tuple(r) for r in got] == [(1, 0, "alight")]
    assert CL.clean_tokens(tokens, lexicon=lex).count() == 2


def test_no_division_by_zero(spark):
    one = spark.createDataFrame([(0, 0)], "label_code int, cluster int")
    assert CU.adjusted_rand_index(CU.contingency(one)).first()[0] == 1.0
    est = spark.createDataFrame([(0, "a", 0.0), (1, "a", 0.0)], "topic int, term string, est_freq double")
    assert [r["share"] for r in TP.term_topic_distribution(est).collect()] == [0.0, 0.0]
    tt = spark.createDataFrame([(0, "a", 0.0), (0, "b", 1.0)], "topic int, term string, p double")
    prev = spark.createDataFrame([(0, 1.0, 1.0)], "topic int, size double, share double")
    tf = spark.createDataFrame([("a", 1), ("b", 1)], "term string, freq long")
    assert TP.term_saliency(tt, prev, tf, n=None).count() == 2
    single = spark.createDataFrame([(1, [1.0, 2.0])], "id long, v array<double>")
    assert [r["cov"] for r in CU.covariance(single, "v").collect()] == [None] * 3


def test_empty_image(spark):
    df = spark.createDataFrame([([],), ([1, 2, 3],), (None,)], "pixels array<int>")
    assert [r[0] for r in df.select(IM.to_gray("pixels")).collect()] == [[], [2], None]


def test_pca_scales_by_the_population_std(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, 3)) * [1, 5, 2]
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, v array<double>") \
        .select("id", array_to_vector("v").alias("features"))
    got = MD.pca_reduce(df, 3).orderBy("id").toPandas()[["C0", "C1", "C2"]].to_numpy()
    z = (x - x.mean(0)) / x.std(0)
    assert abs((got ** 2).sum() - (z ** 2).sum()) < 1e-6


def test_wide_covariance(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 700))
    df = spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>")
    got = CU.covariance(df, "v").filter("dim_i < 2").toPandas()
    want = np.cov(x.T)
    assert np.allclose(got["cov"], [want[i, j] for i, j in zip(got["dim_i"], got["dim_j"])])


def test_nearest_centroid_with_nulls_and_ties(spark):
    pts = spark.createDataFrame([(0, [0.0, 0.0]), (1, None), (2, [9.0, 9.0])], "id int, v array<double>")
    cen = spark.createDataFrame([(5, [1.0, 0.0]), (3, [0.0, 1.0]), (4, [9.0, 8.0])], "word_id int, centroid array<double>")
    for block in (1, 1 << 20):
        got = {r["id"]: (r["word_id"], r["dist"]) for r in CU.nearest_centroid(pts, cen, "v", block_values=block).collect()}
        assert got == {0: (3, 1.0), 1: (None, None), 2: (4, 1.0)}


def test_sparse_vectors_keep_empty_rows(spark):
    long = spark.createDataFrame([(1, 7, 0.5), (1, 2, 0.25)], "doc_id long, term_id int, weight double")
    rows = spark.createDataFrame([(1,), (2,)], "doc_id long")
    got = {r["doc_id"]: (r["indices"], r["weights"]) for r in CU.long_to_vector(long, "doc_id", "term_id", "weight", rows).collect()}
    assert got == {1: ([2, 7], [0.25, 0.5]), 2: ([], [])}


def test_parts_of_speech_need_a_lexicon(spark):
    df = spark.createDataFrame([(1, ["a"])], "doc_id long, tokens array<string>")
    with pytest.raises(ValueError, match="lexicon"):
        ST.TokenCleaner(posToKeep=["NOUN"]).transform(df)


def test_images_without_words_count(spark):
    found = spark.createDataFrame([(1, 0, 2), (1, 1, 1), (2, 1, 1), (3, None, 0)], "image_id long, word_id int, cnt long")
    assert ST.TfidfWeighter().fit(found).getOrDefault("nImages") == 3


def test_lda_draws_from_the_whole_corpus(spark):
    rows = [(i, ["a", "b"] if i % 2 else ["c", "d"]) for i in range(40)]
    vec = MD.count_vectors(spark.createDataFrame(rows, "doc_id long, tokens array<string>"), ["a", "b", "c", "d"])
    model = MD.lda_fit(vec.withColumnRenamed("counts", "features"), 2, max_iter=3)
    assert model.topicsMatrix().numRows == 4
    assert model.getOrDefault("subsamplingRate") == 1.0


def test_shared_folder_is_required_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from topiclens.session import ensure_checkpoint_dir

    fake = SimpleNamespace(sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"),
                           conf=SimpleNamespace(get=lambda *a: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(fake)


def test_rectangular_blur(spark):
    from topiclens.operators import images as IO

    img = spark.createDataFrame([(1, 3, 4, 1, list(range(0, 120, 10)))],
                                "image_id long, height int, width int, n_channels int, pixels array<int>")
    x = np.arange(0, 120, 10, dtype=float).reshape(3, 4)
    k = IO.gaussian_kernel(3, 0.0)
    padded = np.pad(x, ((0, 0), (1, 1)), mode="reflect")
    want = sum(k[i] * padded[:, i:i + 4] for i in range(3))
    got = IO.blur_values(img, (3, 1)).first()["values"]
    assert np.allclose(np.array(got).reshape(3, 4), want)
    staged = ST.Blurer(ksize=3).transform(img).first()["pixels"]
    assert staged == IO.blur_images(img, 3).first()["pixels"]


def test_scaled_pca_keeps_the_asked_variance(spark, tmp_path):
    from pyspark.ml import PipelineModel

    rng = np.random.default_rng(2)
    x = rng.normal(size=(80, 4)) @ np.diag([5, 1, 1, 1])
    x[:, 1] = x[:, 0] + 0.1 * x[:, 1]
    df = spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>").select(array_to_vector("v").alias("features"))
    model = ST.ScaledPCA(nComponents=0.7).fit(df)
    z = (x - x.mean(0)) / x.std(0)
    ratios = np.sort(np.linalg.eigvalsh(np.cov(z.T)))[::-1]
    k = int((np.cumsum(ratios / ratios.sum()) < 0.7).sum()) + 1
    assert model.transform(df).first()["pca"].size == k
    model.write().overwrite().save(str(tmp_path / "pca"))
    assert PipelineModel.load(str(tmp_path / "pca")).transform(df).first()["pca"].size == k
    assert ST.ScaledPCA(nComponents=3.0).fit(df).transform(df).first()["pca"].size == 3


def test_images_loader(spark):
    from topiclens.plans import queries as Q

    folder = Q.write_patch_pngs(spark, "/root/testdata/sf0.001")
    photos = spark.createDataFrame([("0",), ("1",), ("none",)], "photo_id string")
    rows = ST.ImagesLoader(photosDir=folder, suffix=".png").transform(photos).collect()
    assert sorted(r["image_id"] for r in rows) == ["0", "1"] and all(len(r["pixels"]) == 64 for r in rows)
