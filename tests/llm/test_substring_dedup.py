import hashlib
import random

import pytest

from topiclens.llm.substring_dedup import difference_cover, substring_dedup


def brute(rows, n=13):
    first = {}
    for d, text in rows:
        w = (text or "").encode().split()
        for i in range(len(w) - n + 1):
            if d is not None:
                k = tuple(w[i:i + n])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, text in rows:
        w = (text or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            if d is not None and first[tuple(w[i:i + n])] < d:
                for j in range(i, i + n):
                    gone[j] = True
        kept = b" ".join(x for x, g in zip(w, gone) if not g).decode()
        out.append((d, len(w), sum(gone), kept))
    return sorted(out, key=repr)


def corpus(seed=3, docs=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}é" for i in range(400)] + ["a", "b"]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for d in range(docs):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 120))]
        if d % 3 == 0:
            at, lo = rng.randint(0, len(words)), rng.randint(0, 30)
            words[at:at] = passage[lo:lo + rng.randint(10, 30)]
        rows.append((d * 7 % 113, rng.choice([" ", "\n", " \t "]).join(words)))
    rows += [(900, rows[5][1]), (901, rows[5][1] + " tail"), (902, None), (903, ""), (None, rows[5][1]),
             (5, rows[5][1]), (5, rows[5][1]), (904, "a " * 300), (905, "a " * 40), (906, "long" * 400_000)]
    return rows


@pytest.mark.parametrize("period", [7, 5])
def test_difference_cover_has_every_difference(period):
    cover = difference_cover(period)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


@pytest.mark.parametrize("block_bytes", [2_000, 1 << 22])
def test_equals_brute_force(spark, block_bytes):
    rows = corpus()
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, block string, h int")
    got = [tuple(r) for r in substring_dedup(df, block_bytes=block_bytes).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert substring_dedup(df).collect() == []


def test_query_on_test_table(spark):
    from topiclens.llm.queries import op6_substring_dedup

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = [(d, n, r, hashlib.sha256(t.encode()).hexdigest()) for d, n, r, t in brute(rows)]
    got = op6_substring_dedup(spark, sf).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert sum(r for _, _, r, _ in want) > 0
