"""Line-first cleaning: rules judge lines, failed lines go, and documents that lose too much are rejected.

A line (text between ``\\n``) fails when one of these holds:

* symbols: its ``#*$%&|<>`` characters exceed ``max_symbols_per_word`` per word;
* navigation: at least ``min_separators`` of its words are separators (``| > » • · /`` alone)
  and they are more than ``max_separator_share`` of its words, or the whole line is one of
  the ``NAVIGATION`` labels;
* shouting: at least ``min_shout_words`` words, and most of its ASCII letters are upper case;
* repeated punctuation: ``!!`` or ``??`` after more than ``max_repeated_marks`` of its words;
* boilerplate: it holds one of the ``BOILERPLATE`` phrases (A-Z folded);
* no closing mark: ``min_unclosed_words`` to ``max_unclosed_words`` words whose last character is neither
  a sentence mark of any script, a closing bracket or quotation mark nor a colon, semicolon or ellipsis
  (the text's last line may be cut off anywhere, a longer line is a paragraph, and Thai and Lao
  close sentences without a mark, so a line that ends in one of these scripts does not fail).

The phrase and label lists are English; the other rules hold for any script.

Lines without a word are neutral and stay.  A document is rejected when its words fail
``base_failed`` (too few words, or too many words in repeated 5-word windows) or when the
words of failed lines are more than ``max_lost`` of all its words.

Everything is counted on the Arrow text buffer with numpy: no shuffle, one pass, and whole
texts in bounded slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from .arrow_text import IS_SPACE, Spans, Texts, lines_of, slices, span_hashes, texts_of, window_hashes, \
    window_starts, words_of

BOILERPLATE = [
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy",
    "uses cookies", "accept cookies", "enable javascript", "lorem ipsum", "click here", "subscribe to our", "sign up for our",
]
NAVIGATION = [
    "home", "next", "previous", "back", "menu", "skip to content", "log in", "login", "sign in", "sign up",
    "contact", "about", "search", "share", "read more", "top", "sitemap", "archive", "tags",
]


def _closing_points() -> list[int]:
    """Code points that may end a line: by Unicode's sentence-terminal property and its classes of closing marks,
    colons, semicolons and ellipses, and all of the scripts that close sentences without a mark."""
    mark = regex.compile(r"[\p{Sentence_Terminal}\p{Pe}\p{Pf}:;\"'\u2026\uFF1A\uFF1B\u061B\p{Script=Thai}\p{Script=Lao}]")
    return [c for c in range(0x20000) if not 0xD800 <= c < 0xE000 and mark.match(chr(c))]


CLOSING = _closing_points()

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_CLOSING = np.array(CLOSING)
_SEPARATORS = [b"|", b">", b"/", "»".encode(), "•".encode(), "·".encode()]


SLICE_BYTES = 1 << 20  # text judged at once: prefix sums take eight bytes for each of these


@dataclass(frozen=True)
class Rules:
    max_symbols_per_word: float = 0.3
    min_separators: int = 2
    max_separator_share: float = 0.2
    min_shout_words: int = 3
    min_shout_share: float = 0.7
    max_repeated_marks: float = 0.3
    min_unclosed_words: int = 4
    max_unclosed_words: int = 30
    max_lost: float = 0.5
    min_words: int = 10
    repeat_width: int = 5
    max_repeat_percent: int = 20


def _sums(flags: np.ndarray) -> np.ndarray:
    """Prefix sums with a leading 0: the count in [a, b) is s[b] - s[a]."""
    return np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))


def _phrase_lines(t: Texts, lines: Spans, phrases: list[str]) -> np.ndarray:
    """Lines that hold one of the phrases (A-Z folded)."""
    hit = np.zeros(len(lines.start), dtype=bool)
    lowered = t.buf.tobytes().lower()
    for phrase in phrases:
        needle = phrase.encode()
        at = lowered.find(needle)
        while at >= 0:
            k = int(np.searchsorted(lines.start, at, side="right")) - 1
            if k >= 0 and at + len(needle) <= lines.end[k]:
                hit[k] = True
                at = lowered.find(needle, int(lines.end[k]))
            else:
                at = lowered.find(needle, at + 1)
    return hit


def _label_lines(t: Texts, lines: Spans, first: np.ndarray, counts: np.ndarray, words: Spans) -> np.ndarray:
    """Lines whose words are exactly one navigation label."""
    labels = {x.encode() for x in NAVIGATION}
    longest = max(len(x.split()) for x in labels)
    hit = np.zeros(len(lines.start), dtype=bool)
    for k in np.flatnonzero((counts > 0) & (counts <= longest)):
        a, b = int(words.start[first[k]]), int(words.end[first[k] + counts[k] - 1])
        if b - a <= 40:
            hit[k] = b" ".join(t.buf[a:b].tobytes().lower().split()) in labels
    return hit


def _last_points(t: Texts, ends: np.ndarray) -> np.ndarray:
    """The code points that end at the byte places ``ends``."""
    at = ends - 1
    point, shift = np.zeros(len(ends), dtype=np.int64), np.zeros(len(ends), dtype=np.int64)
    for _ in range(3):
        inner = (t.buf[at] & 0xC0) == 0x80
        point += np.where(inner, (t.buf[at] & 0x3F).astype(np.int64) << shift, 0)
        shift += 6 * inner
        at = at - inner
    lead = t.buf[at].astype(np.int64)
    mask = np.array([0x7F, 0x1F, 0x0F, 0x07])[shift // 6]
    return point + ((lead & mask) << shift)


def failed_lines(t: Texts, words: Spans, lines: Spans, rules: Rules) -> tuple[np.ndarray, np.ndarray]:
    """``(failed, words per line)`` for all lines of the batch."""
    first = np.searchsorted(words.start, lines.start)
    counts = np.searchsorted(words.start, lines.end) - first
    some = counts > 0
    at_least_one = np.maximum(counts, 1)

    def inside(flags: np.ndarray) -> np.ndarray:
        s = _sums(flags)
        return s[lines.end] - s[lines.start]

    failed = inside(SYMBOLS[t.buf]) > rules.max_symbols_per_word * at_least_one

    width = words.end - words.start
    separator = np.zeros(len(width), dtype=bool)
    for mark in _SEPARATORS:
        same = width == len(mark)
        for k, byte in enumerate(mark):
            same[same] = t.buf[words.start[same] + k] == byte
        separator |= same
    s = _sums(separator)
    bars = s[first + counts] - s[first]
    failed |= (bars >= rules.min_separators) & (bars > rules.max_separator_share * at_least_one)
    failed |= _label_lines(t, lines, first, counts, words)

    letters, upper = inside(_LETTER[t.buf]), inside(_UPPER[t.buf])
    failed |= (counts >= rules.min_shout_words) & (letters > 0) & (upper > rules.min_shout_share * letters)

    double = np.zeros(len(t.buf), dtype=bool)
    if len(t.buf) > 1:
        double[1:] = (t.buf[1:] == t.buf[:-1]) & ((t.buf[1:] == 33) | (t.buf[1:] == 63))
    marked = np.zeros(len(width), dtype=bool)
    marked[width > 1] = double[words.end[width > 1] - 1]
    s = _sums(marked)
    failed |= (counts >= 2) & (s[first + counts] - s[first] > rules.max_repeated_marks * at_least_one)

    failed |= _phrase_lines(t, lines, BOILERPLATE)

    unclosed = (counts >= rules.min_unclosed_words) & (counts <= rules.max_unclosed_words)
    ends = words.end[first[unclosed] + counts[unclosed] - 1]
    unclosed[unclosed] = ~np.isin(_last_points(t, ends), _CLOSING)
    unclosed[lines.first[1:] - 1] = False
    failed |= unclosed
    return failed & some, counts


def _repeat_words(t: Texts, words: Spans, width: int) -> np.ndarray:
    """Per text: words under a window of ``width`` words that comes twice or more in the text."""
    starts = window_starts(words, width)
    if not len(starts):
        return np.zeros(len(t), dtype=np.int64)
    h = window_hashes(span_hashes(t, words), starts, width, lane=5)
    own = np.repeat(np.arange(len(t)), np.maximum(words.counts - width + 1, 0))
    order = np.lexsort((h, own))
    hs, os = h[order], own[order]
    same = (hs[1:] == hs[:-1]) & (os[1:] == os[:-1])
    twice = np.zeros(len(h), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    mark = np.zeros(len(words.start) + 1, dtype=np.int64)
    at = starts[order[twice]]
    mark[at] += 1  # starts are distinct, so plain indexing adds each once
    mark[at + width] -= 1
    covered = _sums(np.cumsum(mark)[:-1] > 0)
    return covered[words.first[1:]] - covered[words.first[:-1]]


def _dup_lines(t: Texts, lines: Spans, counts: np.ndarray) -> np.ndarray:
    """Per text: lines with a word that equal an earlier line of the text."""
    some = np.flatnonzero(counts > 0)
    own = lines.owner[some]
    h = span_hashes(t, Spans(lines.start[some], lines.end[some], lines.first))
    order = np.lexsort((some, h, own))
    again = (h[order][1:] == h[order][:-1]) & (own[order][1:] == own[order][:-1])
    return np.bincount(own[order][1:][again], minlength=len(t)).astype(np.int64)


def measure(t: Texts, rules: Rules) -> tuple[dict, np.ndarray, Spans]:
    """Per-text counts and verdicts, the failed lines, and the lines."""
    words, lines = words_of(t), lines_of(t)
    failed, counts = failed_lines(t, words, lines, rules)
    n = words.counts.astype(np.int64)

    def per_text(flags: np.ndarray) -> np.ndarray:
        s = _sums(flags)
        return s[t.end] - s[t.start]

    lost = _sums(np.where(failed, counts, 0))
    lost = lost[lines.first[1:]] - lost[lines.first[:-1]]
    repeats = _repeat_words(t, words, rules.repeat_width)
    base = (n < rules.min_words) | (100 * repeats > rules.max_repeat_percent * n)
    out = {
        "n_words": n,
        "word_chars": per_text(~IS_SPACE[t.buf] & ((t.buf & 0xC0) != 0x80)),
        "n_symbols": per_text(SYMBOLS[t.buf]),
        "n_dup_lines": _dup_lines(t, lines, counts),
        "n_repeat_words": repeats.astype(np.int64),
        "n_lost_words": lost,
        "base_failed": base,
        "kept": ~base & (lost <= rules.max_lost * n),
    }
    return out, failed, lines


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lost_words",
            "base_failed", "kept"]
_MEASURE_FIELDS = [StructField(c, BooleanType() if c in ("base_failed", "kept") else LongType()) for c in MEASURES]


def quality_measures(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per input row: ``doc_id`` and ``MEASURES``.

    Null and empty texts have no words: all counts 0, ``base_failed`` true, ``kept`` false.
    Null ids are returned as they are, repeated rows give repeated results, and an empty
    table gives an empty one.  Only ``doc_id`` and ``text`` are read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                out, _, _ = measure(texts_of(batch.column("text")), rules)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *(pa.array(out[c]) for c in MEASURES)], ["doc_id", *MEASURES])

    given = docs.select("doc_id", "text")
    return given.mapInArrow(run, StructType([given.schema["doc_id"], *_MEASURE_FIELDS]))


def clean_documents(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The kept documents, without their failed lines (all columns; ``n_chars``, if there, recounted).

    Null, empty and blank texts fail ``base_failed`` and go; null ids and repeated rows are judged like any
    other; an empty table gives an empty one.
    """
    names = docs.columns
    given = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text = f"c{names.index('text')}"
    n_chars = f"c{names.index('n_chars')}" if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text, SLICE_BYTES):
                t = texts_of(batch.column(text))
                out, failed, lines = measure(t, rules)
                kept = np.flatnonzero(out["kept"])
                cleaned = []
                for i in kept:
                    a, b = int(lines.first[i]), int(lines.first[i + 1])
                    if not failed[a:b].any():
                        cleaned.append(t.bytes(i))
                        continue
                    stay = (np.flatnonzero(~failed[a:b]) + a).tolist()
                    cleaned.append(b"\n".join(t.buf[lines.start[k]:lines.end[k]].tobytes() for k in stay))
                rows = batch.take(pa.array(kept))
                arrays = {c: rows.column(c) for c in rows.schema.names}
                arrays[text] = pa.array(cleaned, pa.binary()).cast(pa.string())
                if n_chars:
                    sizes = pc.utf8_length(arrays[text])
                    arrays[n_chars] = sizes.cast(rows.schema.field(n_chars).type)
                yield pa.RecordBatch.from_arrays([arrays[c] for c in rows.schema.names], rows.schema.names)

    return given.mapInArrow(run, given.schema).toDF(*names)
