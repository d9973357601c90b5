import random
import re

import pytest

from topiclens.llm.license_scan import NOTICES, PHRASES, Scanner, errors_allowed, flat_words, license_scan, pieces

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def base(text):
    w = words(text)
    places = [(i, label) for label, phrase in PHRASES for p in [phrase.split()]
              for i in range(len(w)) if w[i:i + len(p)] == p]
    return len(w), len(places), sorted({x for _, x in places}), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None)


def least_edits(pattern, text):
    """Fewest edits between the pattern and any stretch of the text, by dynamic programming."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row[0] = row[0], i
        for j, c in enumerate(text, 1):
            last, row[j] = row[j], min(last + (p != c), row[j] + 1, row[j - 1] + 1)
    return min(row)


def edited(rng, text, edits):
    s = list(text)
    for _ in range(edits):
        at = rng.randrange(len(s))
        kind = rng.randrange(3)
        if kind == 0:
            s[at] = rng.choice("abcxyz")
        elif kind == 1:
            s.insert(at, rng.choice("abcxyz"))
        else:
            del s[at]
    return "".join(s)


FILLER = "lorem ipsum dolor license sit amet general public consectetur permission is under the terms"


def test_pieces_cover_the_notice():
    for _, notice in NOTICES:
        got = pieces(f" {notice} ", errors_allowed(notice))
        assert "".join(p for _, p in got) == f" {notice} " and len(got) == errors_allowed(notice) + 1
        assert min(len(p) for _, p in got) >= 8


def test_every_notice_within_its_edits_is_found_and_none_beyond():
    rng = random.Random(3)
    scanner = Scanner(PHRASES, NOTICES)
    for round_ in range(6):
        for i, (label, notice) in enumerate(NOTICES):
            text = f"{FILLER} {edited(rng, notice, round_)} {FILLER}"
            flat = flat_words(text.encode())
            found = {m.notice for m in scanner.scan(flat)[1]}
            for j, (_, other) in enumerate(NOTICES):
                assert (j in found) == (least_edits(f" {other} ", flat) <= errors_allowed(other)), (text, other)


TEXTS = [None, "", "...", "MIT License", "the mit\nLICENSE, mit license mit-license", "Apache   License general public license",
         "mitlicense mit x license", "Released under the MIT Licence.", "Relaesed under teh MIT License",
         "ÄMIT license äpfel mit license", "PERMISSION is hereby granted, free of charge, to any person obtaining a copy",
         "Permission is herebx granted; free of charg, to any person obtainng a copy " * 3, "mit license " * 20_000, "x" * 200_000]


def test_rows_equal_brute_force(spark):
    rows = [(i, t, "l", 0) for i, t in enumerate(TEXTS)] + [(None, "mit license", "l", 0), (3, TEXTS[3], "l", 0)]
    got = license_scan(spark.createDataFrame(rows, "doc_id long, text string, labels string, score int")).collect()
    assert len(got) == len(rows)
    for r in got:
        text = "mit license" if r["doc_id"] is None else TEXTS[r["doc_id"]]
        n, places, labels, first, last = base(text)
        assert (r["n_words"], r["n_base"], r["base_labels"], r["first_word"], r["last_word"]) == (n, places, ",".join(labels), first, last)
        assert set(labels) <= set(r["labels"].split(",")) | {""} and 0 <= r["score"] <= 1
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[7]["labels"] == "mit" and by_id[7]["base_labels"] == "" and by_id[7]["matches"][0]["edits"] == 1
    assert by_id[8]["labels"] == "mit" and by_id[8]["n_base"] == 1
    assert [(m["first_word"], m["last_word"], m["edits"]) for m in by_id[10]["matches"]] == [(0, 12, 0)]
    assert [(m["first_word"], m["last_word"], m["edits"]) for m in by_id[11]["matches"]] == [(0, 12, 3), (13, 25, 3), (26, 38, 3)]
    assert by_id[0]["labels"] == "" and by_id[0]["score"] == 0


def test_own_entries_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "Some Secret house rules apply here")], "doc_id int, text string")
    got = license_scan(docs, [], [("house", "secret house rules apply")]).collect()
    assert got[0]["labels"] == "house" and got[0]["n_base"] == 0
    assert license_scan(docs, [], []).collect()[0]["labels"] == ""
    with pytest.raises(ValueError, match="lower-case"):
        license_scan(docs, [("x", "Not Lower")])
    assert license_scan(docs.limit(0)).collect() == []
