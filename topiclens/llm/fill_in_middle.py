"""Fill-in-middle transformation by displacement scatter.

A text of n tokens (a run of ASCII letters, or one other code point) is cut at two places drawn
from a hash of its document's id, and its three parts are reordered behind the marks ``<P>``,
``<S>`` and ``<M>``.  All texts of a batch are moved together on their byte buffer:

1. token starts are scanned once, and every cut becomes a byte place;
2. at each part's first byte a difference array holds by how much the shift changes there; its
   cumulative sum is the output shift of every byte of the batch;
3. one numpy scatter writes all bytes to place plus shift, and the marks between them.

``restored`` goes the other way with the same arrays: the marks found in an output tell where each
part lies, and a gather reads every byte of the text from its place in the output.

Shifts are summed in chunks of ``CHUNK`` bytes, so the working memory beside the texts and their
token places does not depend on a text's length.  Nothing is shuffled.

Defined results: null and empty texts are the empty text (form ``plain``); a text that holds one
of the marks stays ``plain``, so every output can be undone; a null id is hashed as an empty
number; equal ids get equal draws, repeated rows equal results; an empty table gives an empty one.
Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .arrow_text import Texts, slices, texts_of

CHUNK = 1 << 20
PLAIN, PSM, SPM = "plain", "psm", "spm"

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARKS = {name: np.frombuffer(f"<{name}>".encode(), np.uint8) for name in "PSM"}
_IN_MARK = np.zeros(256, dtype=bool)
_IN_MARK[list(b"PSM")] = True


@dataclass(frozen=True)
class Shares:
    """Percentages: texts left as they are, and suffix-first outputs among the rest."""

    seed: int = 1
    plain: int = 10
    suffix_first: int = 20


def _compact(column) -> Texts:
    """Texts whose byte ranges follow each other without gaps."""
    t = texts_of(column)
    size = t.end - t.start
    if int(size.sum()) == len(t.buf):
        return t
    buf = np.concatenate([t.buf[a:b] for a, b in zip(t.start, t.end)] or [t.buf[:0]])
    end = np.cumsum(size)
    return Texts(buf, end - size, end)


def _marks_in(buf: np.ndarray) -> np.ndarray:
    """Byte places at which one of the three marks starts."""
    if len(buf) < 3:
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero((buf[:-2] == 60) & _IN_MARK[buf[1:-1]] & (buf[2:] == 62))


def _token_starts(t: Texts) -> np.ndarray:
    starts = (t.buf & 0xC0) != 0x80
    letter = _LETTER[t.buf]
    starts[1:] &= ~(letter[1:] & letter[:-1])
    starts[t.start[t.end > t.start]] = True
    return np.flatnonzero(starts)


def _code_points(t: Texts, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Code points in each byte range [lo, hi)."""
    begins = np.append((t.buf & 0xC0) != 0x80, False)
    edges = np.stack((lo, hi), axis=1).ravel()
    sums = np.add.reduceat(begins, edges, dtype=np.int64)[::2] if len(edges) else np.zeros(0, np.int64)
    return np.where(hi > lo, sums, 0)


def shifts(places: np.ndarray, amounts: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """``(lo, hi, shift of each byte)`` in chunks; from ``places[i]`` on a byte moves by ``amounts[i]``.

    ``places`` ascend; of several at one byte the last holds.
    """
    change = np.diff(amounts, prepend=0)
    carry = 0
    for lo in range(0, size, CHUNK):
        hi = min(size, lo + CHUNK)
        a, b = np.searchsorted(places, (lo, hi))
        steps = np.zeros(hi - lo, dtype=np.int64)
        np.add.at(steps, places[a:b] - lo, change[a:b])
        steps[0] += carry
        moved = np.cumsum(steps)
        carry = int(moved[-1])
        yield lo, hi, moved


@dataclass(frozen=True)
class Parts:
    """Where the three parts of each text lie in it, and which form its output has."""

    start: np.ndarray
    first_cut: np.ndarray
    second_cut: np.ndarray
    end: np.ndarray
    form: np.ndarray  # 0 plain, 1 psm, 2 spm

    def moves(self, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Part starts in text order and their shifts, for outputs that begin at ``base``."""
        prefix, suffix = self.first_cut - self.start, self.end - self.second_cut
        psm, cut = self.form == 1, self.form > 0
        to_prefix = np.where(psm, base + 3, base + suffix + 6)
        to_suffix = np.where(psm, base + prefix + 6, base + 3)
        to_middle = base + prefix + suffix + 9
        places = np.stack((self.start, self.first_cut, self.second_cut), axis=1)
        targets = np.stack((to_prefix, to_middle, to_suffix), axis=1)
        plain = base[:, None] + places - self.start[:, None]
        return places.ravel(), (np.where(cut[:, None], targets, plain) - places).ravel()


def _cut(t: Texts, h: np.ndarray, shares: Shares) -> tuple[np.ndarray, Parts]:
    starts = _token_starts(t)
    first, last = np.searchsorted(starts, t.start), np.searchsorted(starts, t.end)
    n = last - first
    draws = h[:2] % (n + 1)
    places = np.append(starts, len(t.buf))

    def byte_of(token: np.ndarray) -> np.ndarray:
        return np.where(token < n, places[first + np.minimum(token, n)], t.end)

    marked = np.searchsorted(_marks_in(t.buf), np.stack((t.start, np.maximum(t.start, t.end - 2))))
    plain = (n == 0) | (marked[1] > marked[0]) | (h[2] % 100 >= 100 - shares.plain)
    form = np.where(plain, 0, np.where(h[3] % 100 < shares.suffix_first, 2, 1))
    return n, Parts(t.start, byte_of(draws.min(axis=0)), byte_of(draws.max(axis=0)), t.end, form)


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.string(), len(offsets) - 1,
                                 [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def transform(t: Texts, h: np.ndarray, shares: Shares = Shares()) -> dict[str, pa.Array]:
    """Outputs and measures of a compact batch; ``h`` holds four hash values per text."""
    n, parts = _cut(t, h, shares)
    cut = parts.form > 0
    offsets = np.concatenate(([0], np.cumsum(t.end - t.start + 9 * cut)))
    out = np.empty(int(offsets[-1]), dtype=np.uint8)
    places, amounts = parts.moves(offsets[:-1])
    for lo, hi, moved in shifts(places, amounts, len(t.buf)):
        out[np.arange(lo, hi) + moved] = t.buf[lo:hi]
    base, prefix, suffix = offsets[:-1], parts.first_cut - t.start, t.end - parts.second_cut
    psm = parts.form == 1
    for name, at in (("P", np.where(psm, base, base + 3 + suffix)), ("S", np.where(psm, base + 3 + prefix, base)),
                     ("M", base + 6 + prefix + suffix)):
        for k, byte in enumerate(_MARKS[name]):
            out[at[cut] + k] = byte
    return {
        "n": pa.array(n, pa.int64()),
        "form": pa.array(np.array([PLAIN, PSM, SPM], dtype=object)[parts.form], pa.string()),
        "prefix_chars": pa.array(_code_points(t, t.start, parts.first_cut), pa.int64(), mask=~cut),
        "middle_chars": pa.array(_code_points(t, parts.first_cut, parts.second_cut), pa.int64(), mask=~cut),
        "output": _strings(out, offsets),
    }


def restore(t: Texts, form: np.ndarray) -> pa.Array:
    """The texts of a compact batch of outputs, from the outputs and their forms alone."""
    marks = _marks_in(t.buf)
    cut = form > 0
    first = np.searchsorted(marks, t.start)
    if (np.searchsorted(marks, np.maximum(t.start, t.end - 2))[cut] - first[cut] != 3).any():
        raise ValueError("an output does not hold exactly three marks")
    marks = np.append(marks, [0, 0, 0])
    second, third = marks[np.where(cut, first + 1, -1)], marks[np.where(cut, first + 2, -1)]
    one, two, middle = second - t.start - 3, third - second - 3, t.end - third - 3  # sizes in output order
    prefix, suffix = np.where(form == 1, one, two), np.where(form == 1, two, one)
    size = np.where(cut, prefix + suffix + middle, t.end - t.start)
    offsets = np.concatenate(([0], np.cumsum(size)))
    at = offsets[:-1]
    parts = Parts(at, np.where(cut, at + prefix, at), np.where(cut, at + prefix + middle, at), offsets[1:], form)
    text = np.empty(int(offsets[-1]), dtype=np.uint8)
    places, amounts = parts.moves(t.start)
    for lo, hi, moved in shifts(places, amounts, len(text)):
        text[lo:hi] = t.buf[np.arange(lo, hi) + moved]
    return _strings(text, offsets)


def fill_in_middle(docs: DataFrame, shares: Shares = Shares()) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` per row (the last: the reordered text)."""
    id_field = docs.schema["doc_id"]
    digest = F.sha2(F.concat(F.lit(f"{shares.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    hashed = docs.select("doc_id", "text", digest.alias("digest"))
    given = hashed.select("doc_id", "text", *(F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i}")
                                              for i in range(4)))
    names = ["n", "form", "prefix_chars", "middle_chars", "output"]
    fields = [StructField(c, StringType() if c in ("form", "output") else LongType()) for c in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                h = np.stack([batch.column(f"h{i}").to_numpy(zero_copy_only=False) for i in range(4)])
                out = transform(_compact(batch.column("text")), h, shares)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(out[c] for c in names)], ["doc_id", *names])

    return given.mapInArrow(run, StructType([id_field, *fields]))


def restored(outputs: DataFrame) -> DataFrame:
    """All columns of ``fill_in_middle`` and ``text``, rebuilt from ``output`` and ``form``."""
    schema = StructType([*outputs.schema.fields, StructField("text", StringType())])
    names = outputs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "output"):
                kinds = np.array([(PLAIN, PSM, SPM).index(x) for x in batch.column("form").to_pylist()], dtype=np.int64)
                text = restore(_compact(batch.column("output")), kinds)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), text], [*names, "text"])

    return outputs.mapInArrow(run, schema)
