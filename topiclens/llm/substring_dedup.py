"""Substring dedup with difference-cover anchors.

A window of ``n`` consecutive words is a repeat when the same words also start a window in
a document with a smaller ``doc_id``.  Hashing all windows of a corpus is dear, so:

0. *Whole copies.*  A document whose text equals that of a smaller doc_id loses all its words
   at once (if it has a window at all); only first copies go on.
1. *Anchors.*  D is a difference cover modulo ``period``: for any shift d some a, b in D
   have a - b = d (mod period).  Two equal windows at any two positions i, j therefore
   share a step t < period with i + t and j + t both at cover positions.  Only the
   ``n - period + 1`` words at cover positions are hashed (3 of 7 positions).
2. *Shared anchors.*  Hashes, distinct per block, are shuffled; those seen in two blocks
   go back to their blocks.
3. *Extension.*  Each shared anchor is extended to the windows that hold it.  These are
   hashed whole (96 bits), and the smallest doc_id of every window is found.
4. *Removal.*  Windows with a smaller doc_id in another block come back; repeats inside a
   block are found in the block.  Words under any repeated window are removed.

All steps are shuffles of hashes.  A passage of a third of all rows sends one row per
block, and the grouped streams keep one row of state, whatever the group's size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .arrow_text import Spans, span_hashes, texts_of, window_hashes, window_starts, words_of
from .blocks import BLOCK_BYTES, block_count, dealt, lookup

WINDOW = 13
PERIOD = 7


def difference_cover(period: int) -> list[int]:
    """A small set D with {a - b mod period : a, b in D} = all residues (smallest-first search)."""
    from itertools import combinations

    for size in range(1, period + 1):
        for rest in combinations(range(1, period), size - 1):
            cover = (0, *rest)
            if len({(a - b) % period for a in cover for b in cover}) == period:
                return list(cover)
    return list(range(period))


def _anchor_starts(words: Spans, n: int, period: int) -> np.ndarray:
    """Cover positions (counted in the text) at which an anchor of a text of >= n words starts."""
    width = n - period + 1
    at = window_starts(words, width)
    counts = words.counts
    owner = np.repeat(np.arange(len(counts)), np.maximum(counts - width + 1, 0))
    in_cover = np.zeros(period, dtype=bool)
    in_cover[difference_cover(period)] = True
    return at[in_cover[(at - words.first[owner]) % period] & (counts[owner] >= n)]


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _known(table: pa.Table) -> np.ndarray:
    """Which rows have a doc_id (rows without one neither remove nor lose words)."""
    return ~np.asarray(table.column("doc_id").combine_chunks().is_null())


def _ids(table: pa.Table) -> np.ndarray:
    return table.column("doc_id").combine_chunks().fill_null(0).to_numpy(zero_copy_only=False)


def _split(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The documents of a block, and which of them are marked as later copies."""
    mark = np.asarray(table.column("mark").combine_chunks())
    docs, marks = table.filter(pa.array(~mark)), table.filter(pa.array(mark))
    copy = np.zeros(docs.num_rows, dtype=bool)
    if marks.num_rows:
        told = set(zip(marks.column("doc_id").to_pylist(), marks.column("text").to_pylist()))
        ids = {d for d, _ in told}
        t = texts_of(docs.column("text"))
        for i, d in enumerate(docs.column("doc_id").to_pylist()):
            copy[i] = d in ids and (d, hashlib.sha256(t.bytes(i)).hexdigest()) in told
    return docs, copy


def _firsts(table: pa.Table) -> pa.Table:
    docs, copy = _split(table)
    return docs.filter(pa.array(~copy)) if copy.any() else docs


def _words(table: pa.Table):
    t = texts_of(table.column("text"))
    words = words_of(t)
    return t, words, span_hashes(t, words)


def _anchors(n: int, period: int):
    def anchors(key: tuple, table: pa.Table) -> pa.Table:
        _, words, wh = _words(_firsts(table))
        at = _anchor_starts(words, n, period)
        h = np.unique(window_hashes(wh, at, n - period + 1, lane=1))
        block = np.full(len(h), key[0].as_py(), dtype=np.int32)
        return pa.table({"h": _signed(h), "block": block})

    return anchors


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a stream sorted by h: the rows whose h comes twice or more (one row of state)."""
    held, held_sent = None, False  # the last row seen, and whether it has been sent
    for batch in batches:
        h = batch.column("h").to_numpy()
        block = batch.column("block").to_numpy()
        if not len(h):
            continue
        same = h[1:] == h[:-1]
        hit = np.zeros(len(h), dtype=bool)
        hit[1:] |= same
        hit[:-1] |= same
        out_h, out_b = [], []
        if held is not None and h[0] == held[0]:
            hit[0] = True
            if not held_sent:
                out_h, out_b = [np.array([held[0]])], [np.array([held[1]], dtype=np.int32)]
        held, held_sent = (h[-1], block[-1]), bool(hit[-1])
        out_h.append(h[hit])
        out_b.append(block[hit])
        yield pa.RecordBatch.from_pydict({"h": np.concatenate(out_h), "block": np.concatenate(out_b)})


def _extended(n: int, period: int):
    def extended(key: tuple, docs: pa.Table, shared: pa.Table) -> pa.Table:
        empty = pa.table({"w": np.zeros(0, np.int64), "v": np.zeros(0, np.int64), "doc": np.zeros(0, np.int64)})
        if not docs.num_rows or not shared.num_rows:
            return empty
        docs = _firsts(docs)
        _, words, wh = _words(docs)
        at = _anchor_starts(words, n, period)
        width = n - period + 1
        hit = at[np.isin(_signed(window_hashes(wh, at, width, lane=1)), shared.column("h").to_numpy())]
        # a window starting up to period - 1 words before a shared anchor holds that anchor
        mark = np.zeros(len(wh) + 1, dtype=np.int64)
        np.add.at(mark, np.maximum(hit - (period - 1), 0), 1)
        np.add.at(mark, hit + 1, -1)
        near = np.cumsum(mark)[:-1] > 0
        starts = window_starts(words, n)
        starts = starts[near[starts]]
        doc_of = np.repeat(np.arange(docs.num_rows), words.counts)[starts] if len(starts) else starts
        known = _known(docs)[doc_of]
        starts, ids = starts[known], _ids(docs)[doc_of[known]]
        if not len(starts):
            return empty
        w = window_hashes(wh, starts, n, lane=2)
        v = window_hashes(wh, starts, n, lane=3) >> np.uint64(33)
        order = np.lexsort((ids, v, w))
        w, v, ids = w[order], v[order], ids[order]
        first = np.ones(len(w), dtype=bool)
        first[1:] = (w[1:] != w[:-1]) | (v[1:] != v[:-1])
        packed = (v[first] << np.uint64(32)) | np.uint64(key[0].as_py() if key[0].as_py() is not None else 0)
        return pa.table({"w": _signed(w[first]), "v": _signed(packed), "doc": ids[first]})

    return extended


def _preceded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a stream sorted by (window, doc): rows whose doc is not the window's smallest."""
    last = None  # (w, high half of v, smallest doc)
    for batch in batches:
        w, v, doc = (batch.column(c).to_numpy() for c in ("w", "v", "doc"))
        if not len(w):
            continue
        high = v >> np.int64(32)
        first = np.ones(len(w), dtype=bool)
        first[1:] = (w[1:] != w[:-1]) | (high[1:] != high[:-1])
        goes_on = last is not None and last[0] == w[0] and last[1] == high[0]
        group = np.cumsum(first) - 1
        least = doc[first]
        if goes_on:
            least = least.copy()
            least[0] = last[2]
        hit = doc > least[group]
        last = (w[-1], high[-1], least[-1])
        yield pa.RecordBatch.from_pydict(
            {"w": w[hit], "block": (v[hit] & np.int64(0xFFFFFFFF)).astype(np.int32)})


def _removed(n: int):
    def removed(key: tuple, docs: pa.Table, later: pa.Table) -> pa.Table:
        docs, copy = _split(docs)
        t, words, wh = _words(docs)
        rows = docs.num_rows
        gone = np.zeros(len(wh) + 1, dtype=np.int64)
        starts = window_starts(words, n)
        if len(starts):
            doc_of = np.repeat(np.arange(rows), words.counts)[starts]
            known = (_known(docs) & ~copy)[doc_of]
            starts, ids = starts[known], _ids(docs)[doc_of[known]]
        if len(starts):
            w = window_hashes(wh, starts, n, lane=2)
            v = window_hashes(wh, starts, n, lane=3) >> np.uint64(33)
            order = np.lexsort((ids, v, w))
            ws, vs, ds = w[order], v[order], ids[order]
            first = np.ones(len(ws), dtype=bool)
            first[1:] = (ws[1:] != ws[:-1]) | (vs[1:] != vs[:-1])
            least = ds[first][np.cumsum(first) - 1]
            hit = ds > least
            if later.num_rows:
                hit |= np.isin(_signed(ws[first]), later.column("w").to_numpy())[np.cumsum(first) - 1]
            covered = starts[order][hit]
            np.add.at(gone, covered, 1)
            np.add.at(gone, covered + n, -1)
        keep = np.cumsum(gone)[:-1] == 0
        keep &= ~np.repeat(copy & (words.counts >= n), words.counts)
        total = np.concatenate(([0], np.cumsum(~keep)))
        lost = total[words.first[1:]] - total[words.first[:-1]]
        kept = []
        for i in range(rows):
            own = t.bytes(i).split()
            if lost[i]:
                flags = keep[words.first[i]:words.first[i + 1]].tolist()
                own = [x for x, k in zip(own, flags) if k]
            kept.append(b" ".join(own))
        return pa.table({
            "doc_id": docs.column("doc_id"), "n_words": words.counts.astype(np.int64),
            "n_removed": lost.astype(np.int64), "text": pa.array(kept, pa.binary()).cast(pa.string())})

    return removed


def _later_copies(given: DataFrame) -> DataFrame:
    """A marked row (doc_id, SHA-256 of the text) per document whose text a smaller doc_id has."""
    prints = materialize(given.filter("doc_id is not null and text is not null")
                         .select("doc_id", F.sha2("text", 256).alias("text")), "copies")
    first = prints.groupBy("text").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"),
                                       F.count(F.lit(1)).alias("n"))
    first = materialize(first.filter("least < most").drop("most"), "first_copies")
    return (lookup(prints, first, "text", prints.count()).filter("doc_id > least")
            .select("doc_id", "text", F.lit(True).alias("mark")).distinct())


def substring_dedup(docs: DataFrame, n: int = WINDOW, period: int = PERIOD,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, text`` (the kept words, one space apart).

    Words are runs outside ``\\x20 \\x09-\\x0D``.  Null or empty text: no words, empty text.
    A null ``doc_id`` has no order, so such a row keeps all words and removes none.  Rows that
    repeat a ``doc_id`` do not remove each other's words (neither id is smaller).  Only
    ``doc_id`` and ``text`` are read; other columns, whatever their names, do not matter.
    An empty table gives an empty table.
    """
    if not 1 <= period <= n:
        raise ValueError("period must lie between 1 and the window")
    given = docs.select("doc_id", "text", F.lit(False).alias("mark"))
    blocks = dealt(given.union(_later_copies(given)), block_count(given, block_bytes=block_bytes))
    anchors = blocks.groupBy("block").applyInArrow(_anchors(n, period), "h long, block int")
    shared = (anchors.repartition("h").sortWithinPartitions("h")
              .mapInArrow(_shared, "h long, block int"))
    windows = (blocks.groupBy("block").cogroup(shared.groupBy("block"))
               .applyInArrow(_extended(n, period), "w long, v long, doc long"))
    later = (windows.repartition("w")
             .sortWithinPartitions("w", F.shiftright("v", 32), "doc")
             .mapInArrow(_preceded, "w long, block int"))
    return (blocks.groupBy("block").cogroup(later.groupBy("block"))
            .applyInArrow(_removed(n), "doc_id long, n_words long, n_removed long, text string"))
