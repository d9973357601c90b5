import numpy as np

from topiclens.functions import image as IM
from topiclens.operators import images as IO


def gray_df(spark, imgs):
    rows = [(i, img.shape[0], img.shape[1], 1, [int(v) for v in img.ravel()]) for i, img in enumerate(imgs)]
    return spark.createDataFrame(rows, IO.IMAGE_SCHEMA)


def test_one_level_image_unchanged(spark):
    img = np.full((4, 4), 7)
    df = gray_df(spark, [img])
    assert IO.equalize_images(df).first()["pixels"] == [7] * 16
    assert {r.v for r in IO.equalize_long(IO.pixels_long(df)).collect()} == {7}


def test_equalize_long_equals_numpy(spark):
    rng = np.random.default_rng(0)
    imgs = [rng.integers(0, 256, size=(6, 5)) for _ in range(3)]
    df = gray_df(spark, imgs)
    by_row = {r.image_id: r.pixels for r in IO.equalize_images(df).collect()}
    long = IO.equalize_long(IO.pixels_long(df)).collect()
    for r in long:
        assert by_row[r.image_id][r.y * 5 + r.x] == r.v
    assert min(min(v) for v in by_row.values()) == 0 and max(max(v) for v in by_row.values()) == 255


def test_gaussian_kernel():
    k = IO.gaussian_kernel(3)
    assert abs(sum(k) - 1) < 1e-12 and k[0] == k[2] and k[1] > k[0]
    assert IO.gaussian_kernel(1) == [1.0]


def test_blur_long_equals_numpy(spark):
    rng = np.random.default_rng(1)
    imgs = [rng.integers(0, 256, size=(6, 7)) for _ in range(2)]
    df = gray_df(spark, imgs)
    for border in ("reflect_101", "reflect"):
        long = {(r.image_id, r.y, r.x): r.v for r in IO.blur_long(IO.pixels_long(df), 6, 7, 3, 0.0, border).collect()}
        for i, img in enumerate(imgs):
            ref = IO._blur_np(img, 3, 0.0, border)
            for (y, x), v in np.ndenumerate(ref):
                assert abs(long[(i, y, x)] - v) < 1e-9


def test_gray_swap_resize_center(spark):
    # one 1x2 BGR image: pixel 0 = (b=10, g=20, r=30), pixel 1 = (0, 0, 255)
    df = spark.createDataFrame([([10, 20, 30, 0, 0, 255],)], "p array<int>")
    g = df.select(IM.to_gray("p", "BGR")).first()[0]
    assert g == [round(0.299 * 30 + 0.587 * 20 + 0.114 * 10), round(0.299 * 255)]
    assert df.select(IM.swap_channels(IM.swap_channels("p"))).first()[0] == [10, 20, 30, 0, 0, 255]
    assert df.select(IM.swap_channels("p")).first()[0] == [30, 20, 10, 255, 0, 0]
    c = df.select(IM.center_channels("p", [1.0, 2.0, 3.0])).first()[0]
    assert c == [9.0, 18.0, 27.0, -1.0, -2.0, 252.0]
    sq = spark.createDataFrame([(list(range(16)), 4, 4, 1)], "p array<int>, h int, w int, c int")
    assert sq.select(IM.resize_nearest("p", "h", "w", "c", 2, 2)).first()[0] == [0, 2, 8, 10]


def test_descriptors_and_top(spark):
    rng = np.random.default_rng(2)
    df = gray_df(spark, [rng.integers(0, 256, size=(8, 8)), np.zeros((8, 8), dtype=int)])
    d = IO.extract_descriptors(df, cell=4, bins=8)
    rows = d.collect()
    assert all(r.image_id == 0 for r in rows)  # the flat image has no descriptor
    assert all(abs(sum(v * v for v in r.descriptor) - 1) < 1e-5 for r in rows)
    top = IO.top_descriptors(d, 2).collect()
    assert len(top) == min(2, len(rows))
