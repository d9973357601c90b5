"""License scans: exact phrases, and fuzzy search for short notices.

A text becomes its words (``[0-9a-z]`` and characters beyond ASCII, A-Z folded) with one space
around each.  Two kinds of entries are searched there:

* base phrases: every place where the phrase's words stand consecutively;
* notices: stretches within ``errors`` edits (characters inserted, lost or replaced) of a known
  notice.  A notice that may hold e edits is split into e + 1 pieces.  Any stretch within e edits
  leaves one piece untouched (pigeonhole), so an exact hit of a piece is the only place where a
  match can lie.  All pieces of all notices and all phrases are found in one run of an
  Aho-Corasick automaton over the text; around each hit, shifted by the piece's offset and
  widened by e, the ``regex`` library's bounded-error matching ({e<=k}, best match) verifies
  the edits and gives the span.

A candidate window has a fixed length, so the work for a text follows its length and its hits.
Every row is judged by itself: nothing is shuffled.

Defined results: null, empty and word-free texts have no words, places or labels (score 0, empty
strings, null first and last word); matches of one notice that overlap are one (fewest edits, then
leftmost); null ids are returned, repeated rows give repeated results; an empty table gives an
empty one.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

# The base phrases with their labels.
PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]

# Well-known opening or closing words of public licenses, with labels of our own.
NOTICES = [
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "licensed under the gnu general public license version"),
    ("gpl", "under the terms of the gnu general public license as published by"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose"),
    ("mpl", "subject to the terms of the mozilla public license"),
    ("epl", "under the terms of the eclipse public license"),
    ("boost", "free of charge to any person or organization obtaining a copy of the software"),
    ("zlib", "in no event will the authors be held liable for any damages arising from the use"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc0", "dedicated to the public domain under cc0 1 0"),
    ("cc-by", "licensed under a creative commons attribution"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("reserved", "all rights reserved no part of this publication may be reproduced"),
]

LETTERS_PER_ERROR = 16
MOST_ERRORS = 4

_FOLD = bytearray(b" " * 128 + bytes(range(128, 256)))
_FOLD[48:58] = b"0123456789"
_FOLD[97:123] = _FOLD[65:91] = b"abcdefghijklmnopqrstuvwxyz"


def flat_words(raw: bytes) -> str:
    """The words of a text with one space before, between and after them (``" "``: no word)."""
    padded = np.frombuffer(b" " + raw.translate(bytes(_FOLD)) + b" ", dtype=np.uint8)
    stay = np.ones(len(padded), dtype=bool)
    stay[1:] = (padded[1:] != 32) | (padded[:-1] != 32)
    return padded[stay].tobytes().decode()


def errors_allowed(notice: str) -> int:
    return max(1, min(MOST_ERRORS, len(notice) // LETTERS_PER_ERROR))


def pieces(padded: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` neighbouring pieces of nearly equal length, with their offsets."""
    edges = [len(padded) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, padded[a:b]) for a, b in zip(edges[:-1], edges[1:])]


@dataclass(frozen=True)
class Match:
    label: str
    notice: int
    start: int  # characters of the flat text
    end: int
    edits: int


@dataclass
class Scanner:
    """The compiled entries; built once per task."""

    phrases: list[tuple[str, str]]
    notices: list[tuple[str, str]]
    fuzzy: list = field(init=False)
    automaton: ahocorasick.Automaton = field(init=False)

    def __post_init__(self):
        entries: dict[str, list] = {}
        for i, (_, phrase) in enumerate(self.phrases):
            entries.setdefault(f" {phrase} ", []).append((i, None))
        self.fuzzy = []
        for i, (_, notice) in enumerate(self.notices):
            errors = errors_allowed(notice)
            padded = f" {notice} "
            self.fuzzy.append((regex.compile(f"(?:{regex.escape(padded, literal_spaces=True)}){{e<={errors}}}", regex.BESTMATCH), errors, len(padded)))
            for offset, piece in pieces(padded, errors):
                entries.setdefault(piece, []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for text, uses in entries.items():
            self.automaton.add_word(text, (len(text), uses))
        if entries:
            self.automaton.make_automaton()

    def scan(self, flat: str) -> tuple[list[tuple[int, int]], list[Match]]:
        """``(start, phrase)`` of every base place, and the notices found, both by start."""
        places, candidates = [], {}
        if not len(self.automaton):
            return places, []
        for last, (size, uses) in self.automaton.iter(flat):
            start = last + 1 - size
            for i, offset in uses:
                if offset is None:
                    places.append((start, i))
                else:
                    candidates.setdefault(i, []).append(start - offset)
        places.sort()
        matches = [m for i, starts in candidates.items() for m in self._verify(flat, i, sorted(set(starts)))]
        return places, sorted(matches, key=lambda m: (m.start, m.notice))

    def _verify(self, flat: str, i: int, starts: list[int]) -> list[Match]:
        pattern, errors, size = self.fuzzy[i]
        found: list[Match] = []
        k = 0
        while k < len(starts):
            first = starts[k]
            while k + 1 < len(starts) and starts[k + 1] <= first + 2 * errors:
                k += 1  # alignments this close can only show one and the same match
            m = pattern.search(flat, max(0, first - errors), min(len(flat), starts[k] + size + errors))
            k += 1
            if m is None:
                continue
            new = Match(self.notices[i][0], i, m.start(), m.end(), sum(m.fuzzy_counts))
            if found and new.start < found[-1].end - 1:  # neighbours may share the space between them
                if new.edits < found[-1].edits:
                    found[-1] = new
            else:
                found.append(new)
        return found


class WordPlaces:
    """Word numbers of ascending character places, counted onwards from the last one asked."""

    def __init__(self, flat: str):
        self.flat, self.at, self.spaces = flat, 0, 0

    def of(self, place: int) -> int:
        if place < self.at:
            self.at, self.spaces = 0, 0
        self.spaces += self.flat.count(" ", self.at, place)
        self.at = place
        return self.spaces - 1


_FIELDS = StructType([
    StructField("n_words", LongType()), StructField("n_base", LongType()), StructField("first_word", LongType()),
    StructField("last_word", LongType()), StructField("base_labels", StringType()), StructField("labels", StringType()),
    StructField("score", DoubleType()),
    StructField("matches", ArrayType(StructType([
        StructField("label", StringType()), StructField("notice", LongType()), StructField("first_word", LongType()),
        StructField("last_word", LongType()), StructField("edits", LongType())]))),
])


def judge(raw: bytes, scanner: Scanner) -> dict:
    """The row of one text: counts, labels, score and the notices with their word spans."""
    flat = flat_words(raw)
    places, found = scanner.scan(flat)
    words = WordPlaces(flat)
    base = {scanner.phrases[i][0] for _, i in places}
    ends = [words.of(places[0][0] + 1), words.of(places[-1][0] + 1)] if places else [None, None]
    matches, score = [], 1.0 if places else 0.0
    for m in found:
        first = m.start + (flat[m.start] == " ")
        last = m.end - (flat[m.end - 1] == " ")
        matches.append({"label": m.label, "notice": m.notice, "first_word": words.of(first),
                        "last_word": words.of(last), "edits": m.edits})
        score = max(score, 1 - m.edits / scanner.fuzzy[m.notice][2])
    return {
        "n_words": flat.count(" ") - 1, "n_base": len(places), "first_word": ends[0], "last_word": ends[1],
        "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(base | {m["label"] for m in matches})),
        "score": score, "matches": matches,
    }


def license_scan(docs: DataFrame, phrases: list[tuple[str, str]] = PHRASES,
                 notices: list[tuple[str, str]] = NOTICES) -> DataFrame:
    """One row per document: ``doc_id``, counts, labels, ``score`` and ``matches``.

    ``first_word`` and ``last_word`` are the smallest and largest starts of base places;
    ``score`` is 1 with a base place, else 1 minus the smallest share of edits of a notice found,
    else 0.  ``matches`` holds label, number of the notice, word span (inclusive) and edits.
    Phrases and notices are given as lower-case words with single spaces.
    """
    for _, text in [*phrases, *notices]:
        if not re.fullmatch(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+( [^\x00-\x2F\x3A-\x60\x7B-\x7F]+)*", text):
            raise ValueError(f"not lower-case words with single spaces: {text!r}")
    schema = StructType([docs.schema["doc_id"], *_FIELDS.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        scanner = Scanner(phrases, notices)
        kinds = to_arrow_schema(_FIELDS)
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            rows = [judge(x.as_py() or b"", scanner) for x in texts]
            columns = [pa.array([r[f.name] for r in rows], f.type) for f in kinds]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *kinds.names])

    return docs.select("doc_id", "text").mapInArrow(run, schema)
