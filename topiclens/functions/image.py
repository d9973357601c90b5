"""Per-image array expressions.

An image is ``(height, width, n_channels, pixels ARRAY<INT>)`` with pixels row-major and
channels interleaved, the layout of Spark's ``image`` source (BGR order there).  These are
built-in higher-order functions, so they run in the JVM inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 8-bit luma weights of ITU-R BT.601 in 14-bit fixed point
# (0.299 R + 0.587 G + 0.114 B, rounded half up), as used for 8-bit colour-to-gray.
GRAY_SHIFT = 14
GRAY_R, GRAY_G, GRAY_B = 4899, 9617, 1868


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def image_bytes_to_array(data) -> Column:
    """``BINARY`` image bytes (unsigned) to ``ARRAY<INT>``: the hex string is split in
    two-character pieces by one regex, then each piece is converted (no per-element
    re-evaluation of the whole string)."""
    pieces = F.regexp_extract_all(F.hex(_c(data)), F.lit("[0-9A-F]{2}"), 0)
    return F.transform(pieces, lambda h: F.conv(h, 16, 10).cast("int"))


def to_gray(pixels, order: str = "BGR") -> Column:
    """3-channel interleaved pixels to one gray level per pixel."""
    if order not in ("BGR", "RGB"):
        raise ValueError("order must be 'BGR' or 'RGB'")
    p = _c(pixels)
    r_off, b_off = (2, 0) if order == "BGR" else (0, 2)
    n = (F.size(p) / 3).cast("int")

    def gray(i):
        base = i * 3 + 1
        r = F.element_at(p, base + r_off)
        g = F.element_at(p, base + 1)
        b = F.element_at(p, base + b_off)
        return F.shiftright(r * GRAY_R + g * GRAY_G + b * GRAY_B + (1 << (GRAY_SHIFT - 1)), GRAY_SHIFT)

    none = F.array().cast("array<int>")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), gray)).when(n == 0, none)


def swap_channels(pixels) -> Column:
    """I4: BGR <-> RGB on 3-channel interleaved pixels."""
    p = _c(pixels)
    return F.transform(p, lambda v, i: F.element_at(p, i - (i % 3) + (2 - (i % 3)) + 1))


def resize_nearest(pixels, height, width, channels, out_h: int, out_w: int) -> Column:
    """Nearest-neighbour resize: out(y, x) = in(floor(y*h/H), floor(x*w/W))."""
    p, h, w, ch = _c(pixels), _c(height), _c(width), _c(channels)

    def pick(i):
        y = (i / (out_w * ch)).cast("int")
        x = ((i % (out_w * ch)) / ch).cast("int")
        c = i % ch
        sy = F.floor(y * h / out_h).cast("int")
        sx = F.floor(x * w / out_w).cast("int")
        return F.element_at(p, (sy * w + sx) * ch + c + 1)

    return F.transform(F.sequence(F.lit(0), out_h * out_w * ch - 1), pick)


def center_channels(pixels, means: list[float]) -> Column:
    """Subtract a constant per channel (``means`` in the pixel's channel order)."""
    p = _c(pixels)
    m = F.array(*[F.lit(float(v)) for v in means])
    k = len(means)
    return F.transform(p, lambda v, i: v.cast("double") - F.element_at(m, (i % k) + 1))
