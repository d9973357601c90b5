"""Words and lines of an Arrow string column as numpy arrays.

A batch of texts arrives as one UTF-8 buffer.  Word borders, word hashes and window hashes
are computed on that buffer with vectorised numpy; no Python string is made per word.
A word is a maximal run of bytes outside ``\\x20 \\x09-\\x0D``, so ``bytes.split()`` cuts
the same words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_U64 = np.uint64
_CHUNK = 1 << 20  # bytes hashed at once: bounds the temporary arrays for any text length

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, size=256, dtype=np.uint64) * _U64(2) + _U64(1)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_BASE = int(_rng.integers(2**60, 2**62)) * 2 + 1
_BASE_INV = pow(_BASE, -1, 2**64)
_POWERS: list[np.ndarray] = []


def _power_tables() -> list[np.ndarray]:
    if not _POWERS:
        for base in (_BASE, _BASE_INV):
            steps = np.full(_CHUNK + 1, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS.append(np.multiply.accumulate(steps))
    return _POWERS


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective bit mixer, so that every bit of a hash depends on every input bit."""
    h = h ^ (h >> _U64(31))
    h = h * _U64(0x9E3779B97F4A7C15)
    h = h ^ (h >> _U64(29))
    h = h * _U64(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U64(32))


@dataclass
class Texts:
    """Byte ranges of the texts of one batch (a null text is empty)."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    def bytes(self, i: int) -> bytes:
        return self.buf[self.start[i]:self.end[i]].tobytes()


@dataclass
class Spans:
    """Words (or lines) in text order: byte range, and ``first[i]:first[i+1]`` per text."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def texts_of(column) -> Texts:
    """The texts of an Arrow string column, without copying a contiguous one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        if isinstance(column, pa.ChunkedArray):  # zero chunks
            column = pa.array([], pa.string())
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        z = np.zeros(n, dtype=np.int64)
        return Texts(np.zeros(0, dtype=np.uint8), z, z)
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32, count=n + 1 + column.offset)
    off = off[column.offset:].astype(np.int64)
    lo, hi = int(off[0]), int(off[-1])
    buf = np.frombuffer(data, dtype=np.uint8, count=hi)[lo:] if data is not None and hi else np.zeros(0, np.uint8)
    start, end = off[:-1] - lo, off[1:] - lo
    if column.null_count:
        end = np.where(np.asarray(column.is_null()), start, end)
    return Texts(buf, start, end)


def runs_of(t: Texts, inside: np.ndarray) -> Spans:
    """Maximal runs of ``inside`` bytes that stay in one text."""
    if not len(t.buf):
        z = np.zeros(0, dtype=np.int64)
        return Spans(z, z, np.zeros(len(t) + 1, dtype=np.int64))
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    full = t.end > t.start
    begins[t.start[full]] = inside[t.start[full]]
    ends[t.end[full] - 1] = inside[t.end[full] - 1]
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.append(np.searchsorted(s, t.start), len(s))
    return Spans(s, e, np.maximum.accumulate(first))


def words_of(t: Texts) -> Spans:
    return runs_of(t, ~IS_SPACE[t.buf])


def lines_of(t: Texts) -> Spans:
    """All ``\\n``-split lines, empty ones included (a text of k breaks has k + 1 lines)."""
    breaks = np.flatnonzero(t.buf == 10)
    lo, hi = np.searchsorted(breaks, t.start), np.searchsorted(breaks, t.end)
    counts = hi - lo + 1
    first = np.concatenate(([0], np.cumsum(counts))).astype(np.int64)
    start, end = np.empty(first[-1], np.int64), np.empty(first[-1], np.int64)
    start[first[:-1]], end[first[1:] - 1] = t.start, t.end
    used = np.repeat(lo, counts - 1) + _ramp(counts - 1)
    at = np.repeat(first[:-1], counts - 1) + _ramp(counts - 1)
    end[at], start[at + 1] = breaks[used], breaks[used] + 1
    return Spans(start, end, first)


def _ramp(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for every count c, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts)


def span_hashes(t: Texts, spans: Spans, lower: bool = False) -> np.ndarray:
    """A 64-bit hash per span: polynomial over its bytes, mixed with the length.

    ``lower`` folds A-Z.  Spans are hashed in chunks of bytes, so a text of any length
    needs bounded temporary memory.
    """
    table = _BYTE_LOWER if lower else _BYTE
    power, inverse = _power_tables()
    out = np.zeros(len(spans.start), dtype=np.uint64)
    i, n = 0, len(out)
    while i < n:
        lo = int(spans.start[i])
        j = int(np.searchsorted(spans.end, lo + _CHUNK, side="right"))
        if j <= i:  # one span longer than a chunk
            hi = int(spans.end[i])
            h = 0
            for k, at in enumerate(range(lo, hi, _CHUNK)):
                part = table[t.buf[at:min(hi, at + _CHUNK)]]
                piece = int((part * power[:len(part)]).sum(dtype=np.uint64))
                h += piece * pow(_BASE, k * _CHUNK, 2**64)
            out[i] = h % 2**64
            i += 1
            continue
        part = table[t.buf[lo:int(spans.end[j - 1])]] * power[:int(spans.end[j - 1]) - lo]
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(part, dtype=np.uint64)))
        s, e = spans.start[i:j] - lo, spans.end[i:j] - lo
        out[i:j] = (total[e] - total[s]) * inverse[s]
        i = j
    return mix64(out + (spans.end - spans.start).astype(np.uint64) * _U64(0xD6E8FEB86659FD93))


def window_hashes(word_hash: np.ndarray, at: np.ndarray, width: int, lane: int = 0) -> np.ndarray:
    """Hash of the ``width`` words from each position of ``at`` (multilinear, then mixed)."""
    coef = np.random.default_rng(77_000 + lane).integers(1, 2**63, size=width, dtype=np.uint64)
    coef = coef * _U64(2) + _U64(1)
    acc = np.zeros(len(at), dtype=np.uint64)
    for k in range(width):
        acc += word_hash[at + k] * coef[k]
    return mix64(acc)


def window_starts(spans: Spans, width: int) -> np.ndarray:
    """Word positions at which a window of ``width`` words of one text starts."""
    room = np.maximum(spans.counts - width + 1, 0)
    return np.repeat(spans.first[:-1], room) + _ramp(room)


def slices(batch: pa.RecordBatch | pa.Table, column: str, limit: int = 4 << 20):
    """Cut a batch into row ranges of about ``limit`` text bytes (at least one row each)."""
    t = texts_of(batch.column(column))
    size = np.cumsum(t.end - t.start)
    at = 0
    while at < len(t):
        before = size[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(size, before + limit, side="right")))
        yield batch.slice(at, stop - at)
        at = stop
