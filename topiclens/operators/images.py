"""Image operators: histogram equalisation (I2), Gaussian blur (I3), local descriptors.

Two forms of each:

* a *long* form on ``(image_id, y, x, v)`` pixel tables, written with joins, windows and
  aggregates (SQL-checkable; fine for small patches);
* an *image-row* form (one row per image, ``pixels ARRAY<INT>``) run with numpy on Arrow
  batches: Spark splits the images over tasks; memory per task is one batch of images.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

IMAGE_SCHEMA = "image_id long, height int, width int, n_channels int, pixels array<int>"


def gaussian_kernel(ksize: int, sigma: float = 0.0) -> list[float]:
    """1-D Gaussian weights; ``sigma <= 0`` gives ``0.3*((k-1)*0.5-1)+0.8``."""
    if ksize < 1 or ksize % 2 == 0:
        raise ValueError("ksize must be odd and positive")
    if sigma <= 0:
        sigma = 0.3 * ((ksize - 1) * 0.5 - 1) + 0.8
    c = (ksize - 1) / 2
    w = [math.exp(-((i - c) ** 2) / (2 * sigma * sigma)) for i in range(ksize)]
    s = sum(w)
    return [x / s for x in w]


def reflect_index(i, n, border: str = "reflect_101"):
    """Border index for a Column or an int: ``reflect_101`` (gfedcb|abcdefgh|gfedcba, the
    usual default) or ``reflect`` (fedcba|abcdefgh|hgfedcb)."""
    if border == "reflect_101":
        lo = -i
        hi = 2 * (n - 1) - i
    elif border == "reflect":
        lo = -i - 1
        hi = 2 * n - 1 - i
    else:
        raise ValueError("border must be 'reflect_101' or 'reflect'")
    if isinstance(i, int) and isinstance(n, int):
        return lo if i < 0 else (hi if i >= n else i)
    return F.when(i < 0, lo).when(i >= n, hi).otherwise(i)


# ---------------------------------------------------------------------------
# Long forms
# ---------------------------------------------------------------------------


def pixels_long(images: DataFrame, pixels: str = "pixels") -> DataFrame:
    """``(image_id, y, x, v)`` of one-channel images."""
    e = images.select("image_id", "width", F.posexplode(pixels).alias("i", "v"))
    return e.select("image_id", (F.col("i") / F.col("width")).cast("int").alias("y"),
                    (F.col("i") % F.col("width")).alias("x"), "v")


def equalize_long(px: DataFrame) -> DataFrame:
    """I2 on ``(image_id, y, x, v)``: ``lut[v] = round((cdf(v) - h0) * 255 / (total - h0))``
    with ``h0`` the count of the lowest level present; a one-level image is unchanged."""
    levels = px.groupBy("image_id", "v").agg(F.count(F.lit(1)).alias("h"))
    per_img = Window.partitionBy("image_id")  # at most 256 levels per image
    cdf = levels.select(
        "image_id", "v", "h",
        F.sum("h").over(per_img.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)).alias("cdf"),
        F.sum("h").over(per_img).alias("total"),
        F.min_by("h", "v").over(per_img).alias("h0"))
    lut = cdf.select("image_id", "v", F.when(F.col("total") == F.col("h0"), F.col("v")).otherwise(
        F.round((F.col("cdf") - F.col("h0")) * 255.0 / (F.col("total") - F.col("h0")))).cast("int").alias("v_eq"))
    return px.join(lut, ["image_id", "v"]).select("image_id", "y", "x", F.col("v_eq").alias("v"))


def blur_long(px: DataFrame, height: int, width: int, ksize: int, sigma: float = 0.0,
              border: str = "reflect_101") -> DataFrame:
    """I3 on ``(image_id, y, x, v)`` (images of one size): ``(image_id, y, x, v)`` with
    ``v = sum(w_dy * w_dx * src)`` before any rounding.  The stencil (k x k weights) is a
    literal array; each output pixel reads k*k source pixels by an equi-join."""
    k = gaussian_kernel(ksize, sigma)
    r = ksize // 2
    # the k*k stencil is a literal array, generated per pixel (no join)
    stencil = F.array(*[F.struct(F.lit(dy - r).alias("dy"), F.lit(dx - r).alias("dx"),
                                 F.lit(k[dy] * k[dx]).alias("w"))
                        for dy in range(ksize) for dx in range(ksize)])
    out = px.select("image_id", "y", "x", F.explode(stencil).alias("s")).select(
        "image_id", "y", "x", "s.dy", "s.dx", "s.w")
    out = out.select("image_id", "y", "x", "w",
                     reflect_index(F.col("y") + F.col("dy"), F.lit(height), border).alias("sy"),
                     reflect_index(F.col("x") + F.col("dx"), F.lit(width), border).alias("sx"))
    src = px.select("image_id", F.col("y").alias("sy"), F.col("x").alias("sx"), F.col("v").alias("sv"))
    return (out.join(src, ["image_id", "sy", "sx"])
            .groupBy("image_id", "y", "x").agg(F.sum(F.col("w") * F.col("sv")).alias("v")))


# ---------------------------------------------------------------------------
# Image-row forms (numpy on Arrow batches)
# ---------------------------------------------------------------------------


def _equalize_np(img: np.ndarray) -> np.ndarray:
    hist = np.bincount(img.ravel(), minlength=256)
    nz = np.nonzero(hist)[0]
    if len(nz) == 0:
        return img
    h0 = hist[nz[0]]
    total = img.size
    if total == h0:
        return img
    cdf = np.cumsum(hist)
    lut = np.floor((cdf - h0) * 255.0 / (total - h0) + 0.5).clip(0, 255).astype(np.int32)
    return lut[img]


def kernel_size(ksize) -> tuple[int, int]:
    """``(width, height)`` of a kernel given as one odd number or as that pair."""
    width, height = (ksize, ksize) if isinstance(ksize, int) else (int(ksize[0]), int(ksize[-1]))
    return width, height


def _blur_np(img: np.ndarray, ksize, sigma: float, border: str) -> np.ndarray:
    kw, kh = kernel_size(ksize)
    across, down = np.array(gaussian_kernel(kw, sigma)), np.array(gaussian_kernel(kh, sigma))
    mode = "reflect" if border == "reflect_101" else "symmetric"
    padded = np.pad(img.astype(np.float64), ((kh // 2,) * 2, (kw // 2,) * 2), mode=mode)
    h, w = img.shape
    tmp = sum(down[i] * padded[i:i + h, :] for i in range(kh))
    return sum(across[i] * tmp[:, i:i + w] for i in range(kw))


def _map_gray(images: DataFrame, fn) -> DataFrame:
    def run(batches):
        for pdf in batches:
            out = []
            for h, w, px in zip(pdf["height"], pdf["width"], pdf["pixels"]):
                img = np.asarray(px, dtype=np.int32).reshape(int(h), int(w))
                out.append(fn(img).astype(np.int64).ravel().tolist())
            pdf = pdf.copy()
            pdf["pixels"] = out
            yield pdf

    return images.select("image_id", "height", "width", "n_channels", "pixels").mapInPandas(run, IMAGE_SCHEMA)


def equalize_images(images: DataFrame) -> DataFrame:
    """I2 on one-row-per-image gray images."""
    return _map_gray(images, _equalize_np)


def blur_values(images: DataFrame, ksize, sigma: float = 0.0, border: str = "reflect_101") -> DataFrame:
    """I3 before rounding: ``(image_id, height, width, values)`` with ``values`` an array of doubles."""
    def run(batches):
        for pdf in batches:
            out = pdf[["image_id", "height", "width"]].copy()
            out["values"] = [_blur_np(np.asarray(px, dtype=np.int32).reshape(int(h), int(w)), ksize, sigma, border)
                             .ravel().tolist() for h, w, px in zip(pdf["height"], pdf["width"], pdf["pixels"])]
            yield out

    given = images.select("image_id", "height", "width", "pixels")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in given.schema.fields[:3])
    return given.mapInPandas(run, kinds + ", values array<double>")


def blur_images(images: DataFrame, ksize, sigma: float = 0.0, border: str = "reflect_101") -> DataFrame:
    """I3 on one-row-per-image gray images; output rounded half up and clipped to 0-255.

    ``ksize`` is one odd number or ``(width, height)``."""
    return _map_gray(images, lambda im: np.floor(_blur_np(im, ksize, sigma, border) + 0.5).clip(0, 255))


DESCRIPTOR_SCHEMA = "image_id long, desc_ix int, energy double, descriptor array<float>"


def extract_descriptors(images: DataFrame, cell: int = 4, bins: int = 8,
                        contrast_threshold: float = 0.04) -> DataFrame:
    """M6: dense local descriptors, ``(image_id, desc_ix, energy, descriptor)``.

    Each ``cell x cell`` block of a gray image gives a histogram of gradient orientations
    (``bins`` bins weighted by gradient magnitude, L2-normalised).  Blocks whose mean
    gradient magnitude, scaled to 0-1, is below ``contrast_threshold`` are dropped.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, w = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("height", "width"))
            for size in sorted(set(zip(h.tolist(), w.tolist()))):
                same = np.flatnonzero((h == size[0]) & (w == size[1]))
                step = max(1, IMAGE_VALUES // max(1, size[0] * size[1]))
                for lo in range(0, len(same), step):
                    some = batch.take(pa.array(same[lo:lo + step]))
                    px = some.column("pixels").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                    yield _cell_histograms(some.column("image_id"), px.reshape(-1, *size), cell, bins, contrast_threshold)

    return images.select(F.col("image_id").cast("long"), "height", "width", "pixels").mapInArrow(run, DESCRIPTOR_SCHEMA)


IMAGE_VALUES = 1 << 22  # pixels held at once by extract_descriptors


def _cell_histograms(ids: pa.Array, img: np.ndarray, cell: int, bins: int, threshold: float) -> pa.RecordBatch:
    """Descriptors of images of one size: gradients of all of them, then one weighted count over (image, cell, bin)."""
    n, rows, cols = len(img), img.shape[1] // cell, img.shape[2] // cell
    if min(img.shape[1:]) < 2 or not rows * cols:  # no gradient, or no whole cell
        n = rows = cols = 0
    used = img[:n]
    gy, gx = np.gradient(used, axis=(1, 2)) if n else (used, used)  # exact: pixels are whole numbers
    mag = np.sqrt(gx * gx + gy * gy)[:, :rows * cell, :cols * cell] / 255.0
    # an angle on the border of two bins belongs to the upper one, whatever the rounding of the arc tangent
    angle = (np.arctan2(gy, gx) % (2 * np.pi)) / (2 * np.pi) * bins + 1e-9
    turn = np.minimum(angle.astype(np.int64), bins - 1)[:, :rows * cell, :cols * cell]
    y, x = np.arange(rows * cell) // cell, np.arange(cols * cell) // cell
    at = (np.arange(n)[:, None, None] * rows + y[None, :, None]) * cols + x[None, None, :]
    cells = n * rows * cols
    hist = np.bincount((at * bins + turn).ravel(), weights=mag.ravel(), minlength=cells * bins).reshape(cells, bins)
    energy = np.bincount(at.ravel(), weights=mag.ravel(), minlength=cells)
    kept = np.flatnonzero(energy / (cell * cell) >= threshold)
    owner = kept // max(1, rows * cols)
    rank = np.arange(len(kept)) - np.searchsorted(owner, owner)
    norm = np.linalg.norm(hist[kept], axis=1, keepdims=True)
    unit = (hist[kept] / np.where(norm > 0, norm, 1)).astype(np.float32)
    flat = pa.ListArray.from_arrays(pa.array(np.arange(len(kept) + 1) * bins, pa.int32()), pa.array(unit.ravel()))
    return pa.RecordBatch.from_arrays([ids.take(pa.array(owner)).cast(pa.int64()), pa.array(rank, pa.int32()), pa.array(energy[kept]), flat],
                                      ["image_id", "desc_ix", "energy", "descriptor"])


def top_descriptors(desc: DataFrame, nfeatures: int = 0, strength: str = "energy") -> DataFrame:
    """The ``nfeatures`` strongest descriptors per image (0 keeps all)."""
    if not nfeatures:
        return desc
    w = Window.partitionBy("image_id").orderBy(F.col(strength).desc(), F.col("desc_ix"))
    return desc.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= nfeatures).drop("_r")


def descriptor_energy(vec) -> "F.Column":
    """Strength of a descriptor: its L2 norm."""
    c = F.col(vec) if isinstance(vec, str) else vec
    return F.sqrt(F.aggregate(F.transform(c.cast("array<double>"), lambda x: x * x), F.lit(0.0), lambda a, x: a + x))

