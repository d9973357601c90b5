"""Packing token sequences: shortest-pack-first over the length histogram.

1. Texts are tokenised and cut into pieces of at most ``max_len`` ids (a document's ids plus
   an end id); each piece knows its rank among the pieces of its length in its task.
2. The histogram of piece lengths (at most ``max_len`` numbers, whatever the input) reaches
   the driver, which packs counts and not pieces: lengths go longest first into the open
   pattern with the most room, splitting a pattern's count where it is larger.
3. Patterns become ranges of ranks per length (at most two patterns per length value are
   added, so the table is bounded by ``max_len``), and each piece finds its sequence and
   offset by its global rank among the pieces of its length.

A length that a third of all documents share is ranked without a sort: counts per (task,
length) are summed, and a rank is the task's start plus the rank inside the task.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .arrow_text import slices, span_hashes, texts_of, words_of

MAX_LEN = 4096
END_ID = 2
CACHE_WORDS = 400_000

# Fixed value: the tokenizer's own rule for cutting a word into pieces.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def _byte_alphabet() -> dict[int, str]:
    """Byte-level BPE writes each byte as a printable character."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in plain}
    for k, b in enumerate(x for x in range(256) if x not in table):
        table[b] = chr(256 + k)
    return table


class WordTokenizer:
    """Ids of white-space separated words, kept for words seen before.

    The tokenizer cuts at white space first, so a text's ids are its words' ids in order.
    The caches hold at most ``CACHE_WORDS`` entries and start anew beyond that.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.alphabet = _byte_alphabet()
        self.pieces: dict[str, list[int]] = {}
        self.reset()

    def reset(self) -> None:
        self.index: dict[int, int] = {}
        self.ids = np.zeros(0, dtype=np.uint32)
        self.start = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)

    def _piece(self, piece: str) -> list[int]:
        found = self.pieces.get(piece)
        if found is None:
            if len(self.pieces) >= CACHE_WORDS:
                self.pieces.clear()
            shown = piece.encode().decode("latin-1").translate(self.alphabet)
            found = self.pieces[piece] = [x.id for x in self.tokenizer.model.tokenize(shown)]
        return found

    def encode_words(self, words: list[str]) -> list[list[int]]:
        normal = self.tokenizer.normalizer.normalize_str(" ".join(words)).split(" ")
        if len(normal) != len(words):  # a word with other white space inside
            normal = [self.tokenizer.normalizer.normalize_str(w) for w in words]
        out = []
        for word, form in zip(words, normal):
            # Latin letters only take the short way; other scripts the tokenizer's own
            if " " in form or (form and max(form) > "ɏ") or any(s in word for s in self.specials):
                out.append(self.tokenizer.encode(word, add_special_tokens=False).ids)
            else:
                out.append([i for p in _PIECES.findall(form) for i in self._piece(p)])
        return out

    def encode(self, batch, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
        """``(ids, counts)``: all ids of the batch's texts, and the number per text."""
        t = texts_of(batch.column(text))
        words = words_of(t)
        codes, distinct = pd.factorize(span_hashes(t, words))
        first = np.full(len(distinct), -1, dtype=np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
        if len(self.index) > CACHE_WORDS:
            self.reset()
        get = self.index.get
        at = np.fromiter((get(h, -1) for h in distinct.tolist()), np.int64, len(distinct))
        new = np.flatnonzero(at < 0)
        if len(new):
            spans = zip(words.start[first[new]].tolist(), words.end[first[new]].tolist())
            encoded = self.encode_words([t.buf[a:b].tobytes().decode() for a, b in spans])
            size = np.fromiter(map(len, encoded), np.int64, len(encoded))
            flat = np.fromiter((i for e in encoded for i in e), np.uint32, int(size.sum()))
            at[new] = np.arange(len(new)) + len(self.size)
            self.index.update(zip(distinct[new].tolist(), at[new].tolist()))
            self.start = np.concatenate((self.start, len(self.ids) + np.cumsum(size) - size))
            self.size = np.concatenate((self.size, size))
            self.ids = np.concatenate((self.ids, flat))
        at = at[codes] if len(codes) else np.zeros(0, np.int64)
        size = self.size[at]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        where = np.arange(total) + np.repeat(self.start[at] - (ends - size), size)
        through = np.concatenate(([0], ends))
        return self.ids[where], through[words.first[1:]] - through[words.first[:-1]]


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def _cut(path: str, max_len: int, end_id: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _tokenizer(path)
        task = TaskContext.get().partitionId()
        seen = np.zeros(max_len + 1, dtype=np.int64)  # pieces of each length so far in this task
        for whole in batches:
            for batch in slices(whole, "text"):
                flat, counts = own.encode(batch)
                docs = len(counts)
                size = counts + 1
                ids = np.full(len(flat) + docs, end_id, dtype="<u4")
                ids[np.arange(len(flat)) + np.repeat(np.arange(docs), counts)] = flat
                pieces = -(-size // max_len)
                doc = np.repeat(np.arange(docs), pieces)
                nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = nth * max_len
                length = np.minimum(size[doc] - start, max_len)
                at = (np.cumsum(size) - size)[doc] + start
                view = memoryview(ids).cast("B")
                crc = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip(at.tolist(), (at + length).tolist())]
                order = np.argsort(length, kind="stable")
                by = length[order]
                begins = np.searchsorted(by, by)
                rank = np.empty(len(doc), dtype=np.int64)
                rank[order] = np.arange(len(by)) - begins + seen[by]
                seen += np.bincount(length, minlength=max_len + 1)
                columns = {"doc_id": batch.column("doc_id").take(pa.array(doc)), "start": start, "length": length,
                           "ids_crc32": np.array(crc, dtype=np.int64), "doc_tokens": size[doc],
                           "task": np.full(len(doc), task, dtype=np.int32), "rank": rank}
                if with_ids:
                    columns["ids"] = pa.ListArray.from_arrays(
                        pa.array(np.append(at, len(ids)).astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_pydict(columns)

    return cut


@dataclass
class Pattern:
    """``count`` sequences that each hold ``items``: (length, how often), longest first."""

    items: tuple[tuple[int, int], ...]
    count: int


def pack_histogram(histogram: dict[int, int], max_len: int = MAX_LEN) -> list[Pattern]:
    """Shortest-pack-first: longest lengths first, each into the patterns with the most room."""
    open_patterns: dict[int, list[Pattern]] = {}
    rooms: list[int] = []  # a heap of -room; may hold rooms that are used up

    def put(room: int, pattern: Pattern) -> None:
        if room not in open_patterns:
            open_patterns[room] = []
            heapq.heappush(rooms, -room)
        open_patterns[room].append(pattern)

    for length in sorted(histogram, reverse=True):
        left = int(histogram[length])
        while left:
            while rooms and not open_patterns[-rooms[0]]:
                del open_patterns[-heapq.heappop(rooms)]
            room = -rooms[0] if rooms else 0
            if room < length:
                put(max_len - length, Pattern(((length, 1),), left))
                break
            pattern = open_patterns[room].pop()
            used = min(left, pattern.count)
            if pattern.count > used:
                open_patterns[room].append(Pattern(pattern.items, pattern.count - used))
            *rest, (last, times) = pattern.items
            items = (*rest, (last, times + 1)) if last == length else (*pattern.items, (length, 1))
            put(room - length, Pattern(items, used))
            left -= used
    return [p for ps in open_patterns.values() for p in ps]


@dataclass
class Slots:
    """Ranges of ranks per length: where the range starts, and the sequences it fills."""

    length: np.ndarray
    first_rank: np.ndarray
    times: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    used: np.ndarray  # ids in each of the range's sequences

    @staticmethod
    def of(patterns: list[Pattern]) -> Slots:
        rows, base = [], 0
        for p in patterns:
            used = sum(a * b for a, b in p.items)
            offset = 0
            for length, times in p.items:
                rows.append((length, base, times, offset, p.count, used))
                offset += length * times
            base += p.count
        rows.sort()
        a = np.array(rows, dtype=np.int64).reshape(-1, 6)
        slots = a[:, 2] * a[:, 4]
        before = np.cumsum(slots) - slots
        fresh = np.ones(len(a), dtype=bool)
        fresh[1:] = a[1:, 0] != a[:-1, 0]
        first = before - (before[fresh][np.cumsum(fresh) - 1] if len(a) else 0)
        return Slots(a[:, 0], first, a[:, 2], a[:, 1], a[:, 3], a[:, 5])

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sequence, offset and the sequence's fill for pieces of these lengths and global ranks."""
        lo = np.searchsorted(self.length, length, side="left")
        hi = np.searchsorted(self.length, length, side="right")
        row = np.empty(len(length), dtype=np.int64)
        for value in np.unique(length):
            own = np.flatnonzero(length == value)
            a, b = lo[own[0]], hi[own[0]]
            row[own] = a + np.searchsorted(self.first_rank[a:b], rank[own], side="right") - 1
        step = rank - self.first_rank[row]
        return (self.sequence[row] + step // self.times[row],
                self.offset[row] + step % self.times[row] * length, self.used[row])


def pack_documents(docs: DataFrame, tokenizer_path: str, max_len: int = MAX_LEN, end_id: int = END_ID,
                   with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded_to``.

    A document's ids are the tokenizer's plus ``end_id``; a document longer than ``max_len``
    is cut into full pieces and a rest.  ``start`` counts the document's ids before the piece;
    pieces of a sequence follow each other from offset 0 without a gap.  ``padded_to`` is
    ``max_len``, or the sequence's own length where that is a power of two.  ``with_ids``
    adds the ids (array of int).  Null and empty texts hold the end id alone; null and
    repeated ids pack like any other row; an empty table gives an empty one.  Other columns
    than ``doc_id`` and ``text`` are not read.
    """
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task int, rank long"
    pieces = docs.select("doc_id", "text").mapInArrow(
        _cut(tokenizer_path, max_len, end_id, with_ids), schema + (", ids array<int>" if with_ids else ""))
    pieces = materialize(pieces, "pieces")
    per_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = Slots.of(pack_histogram(histogram, max_len))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(starts, ["length", "task"])
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else [])]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank, before = (batch.column(c).to_numpy() for c in ("length", "rank", "before"))
            sequence, offset, used = slots.place(length, rank + before)
            padded = np.where(used & (used - 1) == 0, used, max_len)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(sequence), pa.array(offset), pa.array(padded)],
                [*columns, "sequence_id", "offset", "padded_to"])

    out = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    out += (", ids array<int>" if with_ids else "") + ", sequence_id long, offset long, padded_to long"
    return ranked.mapInArrow(place, out)
